"""Byte-level BPE by a contiguous rank array: encoding and decoding with a public vocabulary."""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices

# Fixed values of the byte-level format: the pattern that splits texts, with white space and the
# printable characters that stand for themselves.
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
PRINTABLE = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))

# Parts up to which the ranks of a piece are scanned; longer pieces take a heap.
SHORT_PARTS = 96
# Pieces of text that a worker remembers before it starts anew.
REMEMBERED = 200_000

NO_RANK = 1 << 60

_ID = np.dtype(np.int32)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: itself, or one from U+0100 on."""
    printable = {b for low, high in PRINTABLE for b in range(low, high + 1)}
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteBPE:
    """A vocabulary in the JSON form of byte-level BPE; its truncation and padding are not used."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        own = {i: bytes(map(letters.__getitem__, token)) for token, i in vocab.items() if token not in self.specials}
        self.bytes_of = defaultdict(bytes, own)
        self.bytes_of |= {i: content.encode() for content, i in self.specials.items()}
        self.first = [vocab[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        self._vocab, self._merges = vocab, spec["model"]["merges"]
        self.split = regex.compile(SPLIT_PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) or r"(?!)")
        self.known = _Pieces(self)

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        """Merges by pair of ids: the rank in the high bits, the merged id in the low ones."""
        vocab, merges = self._vocab, (m if isinstance(m, list) else m.split(" ") for m in self._merges)
        return {(vocab[a], vocab[b]): rank << 20 | vocab[a + b] for rank, (a, b) in enumerate(merges)}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the pair of the lowest rank, leftmost first, becomes one part, until none is left."""
        parts = [self.first[b] for b in piece]
        if len(parts) > SHORT_PARTS:
            return self._merge_long(parts)
        rank = self.pairs.get
        ranks = [rank(p, NO_RANK) for p in zip(parts, parts[1:], strict=False)]
        while ranks and (least := min(ranks)) != NO_RANK:
            at = ranks.index(least)
            parts[at] = least & 0xFFFFF
            del parts[at + 1], ranks[at]
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), NO_RANK)
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same for pieces so long that scanning would take time in the square of their length."""
        n, rank = len(parts), self.pairs.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank((parts[i], parts[i + 1]), NO_RANK)) != NO_RANK]
        heapify(heap)
        while heap:
            least, at = heappop(heap)
            other = after[at]
            if parts[at] < 0 or other >= n or rank((parts[at], parts[other])) != least:
                continue  # one of the two has been merged since
            parts[at], parts[other] = least & 0xFFFFF, -1
            after[at] = after[other]
            if after[at] < n:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < n and (r := rank((parts[left], parts[after[left]]))) is not None:
                    heappush(heap, (r, left))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text, special tokens included, as 32-bit numbers."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, split = self.known.__getitem__, self.split.findall
        if not self.specials or not self.special.search(text):
            return np.frombuffer(b"".join(map(known, split(text))), _ID)
        parts, at = [], 0
        for found in self.special.finditer(text):
            parts.extend(map(known, split(text[at : found.start()])))
            parts.append(_ID.type(self.specials[found[0]]).tobytes())
            at = found.end()
        parts.extend(map(known, split(text[at:])))
        return np.frombuffer(b"".join(parts), _ID)

    def decode(self, ids: list[int]) -> str:
        """The text of the ids; bytes that are not UTF-8 become U+FFFD, unknown ids nothing."""
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


class _Pieces(dict):
    """Ids of pieces as bytes of 32-bit numbers, merged when first asked for."""

    def __init__(self, bpe: ByteBPE) -> None:
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = self[piece] = np.array(self.bpe.merge(piece.encode()), _ID).tobytes()
        return ids


_loaded: dict[int, ByteBPE] = {}


def _load(source: str) -> ByteBPE:
    """The vocabulary, once per worker."""
    key = hash(source)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ByteBPE(source)
    return _loaded[key]


_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
_DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _source(docs: DataFrame, tokenizer: str):
    """The vocabulary file, read by the driver: its size does not depend on the data."""
    with open(tokenizer, encoding="utf-8") as file:
        return docs.sparkSession.sparkContext.broadcast(file.read())


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids) per row of ``docs``: the whole text as ids of the vocabulary file ``tokenizer``.

    Null and empty texts have no ids; repeated rows stay; further columns are not read.
    """
    shared = _source(docs, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(shared.value)
        for batch in slices(batches):
            encoded = [bpe.encode(t.as_py() or "") for t in batch.column("text")]
            offsets = np.concatenate(([0], np.cumsum([len(e) for e in encoded]))).astype(np.int32)
            flat = np.concatenate(encoded) if encoded else np.empty(0, _ID)
            yield batch_of(_ENCODED, [batch.column("doc_id"), pa.ListArray.from_arrays(offsets, flat)])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded) per row of (doc_id, ids); special tokens appear as their text."""
    shared = _source(encoded, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _load(shared.value)
        for batch in slices(batches):
            texts = [bpe.decode(ids.values.to_numpy().tolist() if ids.is_valid else []) for ids in batch.column("ids")]
            yield batch_of(_DECODED, [batch.column("doc_id"), batch.column("ids"), texts])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids array<int>, decoded string")
