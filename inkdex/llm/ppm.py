"""Scoring texts with a byte model: prediction by partial matching, pretrained on the corpus.

The model is a trie of byte contexts with the counts of the bytes that follow. It is never held whole
anywhere: chunks of documents list the contexts they meet, tasks that own a part of the trie sum up the
counts, work out the probabilities, and answer each chunk with those it asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices, words_of
from inkdex.session import settle

# Bytes of context. A context and the byte after it make a key of ORDER + 1 bytes, at most eight.
ORDER = 5
# Bytes of text that a chunk holds, or one document if that is longer.
CHUNK_BYTES = 8 << 20
# Words that a worker remembers before it starts anew.
REMEMBERED = 400_000

END = b"\n"
_TEXT, _GRAM, _WORD, _LOW = range(4)
_BYTE = np.uint64(8)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def stream_of(words: list[bytes]) -> bytes:
    """A text as the model reads it: its words with single spaces, then the end."""
    return b" ".join(words) + END


def gram_keys(streams: list[bytes], order: int = ORDER) -> np.ndarray:
    """Key of every byte of the streams: the ``order`` bytes before it (ends before the first) and itself."""
    if not streams:
        return np.empty(0, np.uint64)
    padding = END * order
    data = b"".join([END * (7 - order), *(padding + s for s in streams)])
    lengths = np.array([len(s) + order for s in streams])
    starts = np.cumsum(lengths) - lengths
    # Every eight bytes read as one number, of which the last order + 1 are the key.
    keys = np.ndarray((len(data) - 7,), ">u8", data, 0, (1,)).astype(np.uint64)
    keys &= np.uint64((1 << 8 * (order + 1)) - 1)
    own = np.ones(len(keys) + order, bool)
    for place in range(order):
        own[starts + place] = False
    return keys[own[order:]]


def gram_part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that owns a key: by the last two bytes of its context, so that orders from two up are whole."""
    suffix = (keys >> _BYTE & np.uint64(0xFFFF)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
    return (suffix % np.uint64(parts)).astype(np.int64)


def word_part(keys: np.ndarray, parts: int) -> np.ndarray:
    return (keys % np.uint64(parts)).astype(np.int64)


def trie_log10(keys: np.ndarray, counts: np.ndarray, low: np.ndarray, order: int = ORDER) -> np.ndarray:
    """log10 of the probability of each key's last byte after its context.

    ``counts`` are those of the distinct ``keys`` in training, 0 for keys only asked for; ``low[a, b]``
    counts byte b after byte a. All trained keys of the last two context bytes must be among the keys.
    A byte seen n times of N after a context with q different bytes has (2n - 1) / 2N; with the rest,
    q / 2N, the model escapes to the context shortened by its first byte, where the bytes seen
    after the longer one are excluded from n, N and q. Below order 0, the bytes left are equally likely.
    """
    trained = counts > 0
    tables = {order: (keys[trained], counts[trained].astype(np.float64))}
    for k in range(order - 1, 1, -1):
        longer, n = tables[k + 1]
        short, where = np.unique(longer & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        tables[k] = short, np.bincount(where, n, len(short))
    if order >= 1:
        tables[1] = np.flatnonzero(low.ravel()).astype(np.uint64), low.ravel()[low.ravel() > 0].astype(np.float64)
    bottom = low.sum(axis=0)
    tables[0] = np.flatnonzero(bottom).astype(np.uint64), bottom[bottom > 0].astype(np.float64)

    def find(table: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(table, asked), max(len(table) - 1, 0))
        return at, table[at] == asked if len(table) else np.zeros(len(asked), bool)

    result = np.zeros(len(keys))
    left, out_n, out_q = np.arange(len(keys)), np.zeros(len(keys)), np.zeros(len(keys))
    for k in range(order, -1, -1):
        if not len(left):
            break
        table, n = tables[k]
        contexts, where = np.unique(table >> _BYTE, return_inverse=True)
        total, different = np.bincount(where, n, len(contexts)), np.bincount(where, minlength=len(contexts))
        asked = keys[left] & np.uint64((1 << 8 * (k + 1)) - 1)
        at, seen = find(contexts, asked >> _BYTE)
        all_n, all_q = np.zeros(len(left)), np.zeros(len(left))
        all_n[seen], all_q[seen] = total[at[seen]] - out_n[left[seen]], different[at[seen]] - out_q[left[seen]]
        at_key, hit = find(table, asked)
        result[left[hit]] += np.log10((2 * n[at_key[hit]] - 1) / (2 * all_n[hit]))
        escaped = ~hit & (all_q > 0)
        result[left[escaped]] += np.log10(all_q[escaped] / (2 * all_n[escaped]))
        # What the next shorter context excludes: the bytes seen after this one, with their counts there.
        if k:
            shorter, m = tables[k - 1]
            at_short, _ = find(shorter, table & np.uint64((1 << 8 * k) - 1))
            excluded = np.bincount(where, m[at_short], len(contexts)) if len(table) else np.zeros(0)
            out_n[left], out_q[left] = 0, 0
            out_n[left[seen]], out_q[left[seen]] = excluded[at[seen]], different[at[seen]]
        else:
            out_q[left] = len(table)
        left = left[~hit]
    result[left] -= np.log10(256 - out_q[left])
    return result


def _packed(values: np.ndarray) -> bytes:
    return zstandard.compress(values.tobytes())


def _unpacked(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences, byte by byte of equal weight, which compress well."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _packed(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _unpacked_keys(data: bytes) -> np.ndarray:
    planes = _unpacked(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)


def _in_parts(keys: np.ndarray, owners: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the ascending keys of each part."""
    order = np.argsort(owners, kind="stable")
    cuts = np.flatnonzero(np.diff(owners[order])) + 1
    for places in np.split(order, cuts):
        if len(places):
            yield int(owners[places[0]]), places


_CHUNKS = pa.schema(
    [
        ("chunk", pa.string()),
        ("kind", pa.int32()),
        ("part", pa.int32()),
        ("keys", pa.binary()),
        ("counts", pa.binary()),
        ("low_keys", pa.list_(pa.int32())),
        ("low_counts", pa.list_(pa.int64())),
        ("doc_ids", pa.list_(pa.int64())),
        ("learned", pa.list_(pa.bool_())),
        ("texts", pa.binary()),
        ("lengths", pa.binary()),
    ]
)
_CHUNKS_SQL = (
    "chunk string, kind int, part int, keys binary, counts binary, low_keys array<int>, low_counts array<bigint>, "
    "doc_ids array<bigint>, learned array<boolean>, texts binary, lengths binary"
)


class _Packer:
    """Chunks of documents, and what each asks and knows of the trie and of the words."""

    def __init__(self, name: str, parts: int, order: int) -> None:
        self.name, self.parts, self.order, self.hashes, self.number = name, parts, order, _Hashes(), 0
        self.clear()

    def clear(self) -> None:
        self.doc_ids, self.learned, self.streams, self.words, self.size = [], [], [], [], 0
        if len(self.hashes) > REMEMBERED:
            self.hashes.clear()

    def add(self, doc_id: int | None, learned: bool, text: str | None) -> None:
        words = words_of(text)
        self.doc_ids.append(doc_id)
        self.learned.append(learned)
        self.streams.append(stream_of(words))
        self.words.append(np.fromiter(map(self.hashes.__getitem__, [*words, END]), np.uint64, len(words) + 1))
        self.size += len(self.streams[-1])

    def rows(self) -> Iterator[pa.RecordBatch]:
        name = f"{self.name}-{self.number}"
        self.number += 1
        blank = dict.fromkeys(_CHUNKS.names)

        def row(**values) -> pa.RecordBatch:
            return batch_of(_CHUNKS, [[v] for v in (blank | {"chunk": name} | values).values()])

        lengths = np.array([len(s) for s in self.streams], np.int64)
        texts = zstandard.compress(b"".join(self.streams))
        yield row(kind=_TEXT, doc_ids=self.doc_ids, learned=self.learned, texts=texts, lengths=_packed(lengths))
        learned = [s for s, known in zip(self.streams, self.learned, strict=True) if known]
        others = [s for s, known in zip(self.streams, self.learned, strict=True) if not known]
        seen, n = np.unique(gram_keys(learned, self.order), return_counts=True)
        low = np.bincount((seen & np.uint64(0xFFFF)).astype(np.int64), n, 1 << 16)
        used = np.flatnonzero(low)
        yield row(kind=_LOW, low_keys=used, low_counts=low[used].astype(np.int64))
        asked = np.unique(gram_keys(others, self.order))
        yield from self._lists(row, _GRAM, seen, n, asked, gram_part)
        words = [w for w, known in zip(self.words, self.learned, strict=True) if known]
        seen, n = np.unique(np.concatenate([*words, np.empty(0, np.uint64)]), return_counts=True)
        words = [w for w, known in zip(self.words, self.learned, strict=True) if not known]
        asked = np.unique(np.concatenate([*words, np.empty(0, np.uint64)]))
        yield from self._lists(row, _WORD, seen, n, asked, word_part)
        self.clear()

    def _lists(self, row, kind: int, seen, n, asked, owner) -> Iterator[pa.RecordBatch]:
        keys = np.union1d(seen, asked)
        counts = np.zeros(len(keys), np.int64)
        counts[np.searchsorted(keys, seen)] = n
        for part, places in _in_parts(keys, owner(keys, self.parts)):
            yield row(kind=kind, part=part, keys=_packed_keys(keys[places]), counts=_packed(counts[places]))


_ANSWERS = pa.schema([("chunk", pa.string()), ("kind", pa.int32()), ("part", pa.int32()), ("values", pa.binary()), ("n", pa.int64())])
_ANSWERS_SQL = "chunk string, kind int, part int, values binary, n bigint"

_SCORES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("learned", pa.bool_()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("train_tokens", pa.int64()),
        ("base_score", pa.float64()),
        ("score", pa.float64()),
    ]
)
_SCORES_SQL = (
    "doc_id bigint, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)


def score_texts(docs: DataFrame, learn: Column, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Score all rows of ``docs`` (doc_id, text) with models of the rows where ``learn`` holds.

    Tokens are the words, A-Z in lower case, then one end. ``score`` is the log10 probability that the
    byte model gives the words with single spaces between them and the end. ``base_score`` adds up
    log10((c + 1) / (N + V + 1)) over the tokens: c is a token's count in training, N that of all
    (``train_tokens``), V the number of different ones; ``n_known`` tokens have c > 0. Words count by
    a 64-bit hash. Learned texts count themselves.

    Null and empty texts are an end alone; a null ``learn`` is false; repeated rows are learned as
    often as they are there; with nothing to learn, every byte has 1/256; an empty table gives no rows.
    """
    if not 2 <= order <= 7:
        raise ValueError("order must be between 2 and 7")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = F.coalesce(learn, F.lit(False)).alias("learned")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), known, F.col("text").cast("string").alias("text"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(str(TaskContext.get().partitionId()), parts, order)
        for batch in slices(batches):
            for doc_id, learned, text in zip(*batch.columns, strict=True):
                packer.add(doc_id.as_py(), learned.as_py(), text.as_py())
                if packer.size >= chunk_bytes:
                    yield from packer.rows()
        if packer.doc_ids:
            yield from packer.rows()

    chunks = settle(rows.mapInArrow(pack, _CHUNKS_SQL), "chunks")
    pairs = F.explode(F.arrays_zip("low_keys", "low_counts")).alias("low")
    low = chunks.where(F.col("kind") == _LOW).select(pairs).groupBy("low.low_keys").agg(F.sum("low.low_counts").alias("n"))
    dense = np.zeros(1 << 16, np.int64)
    for key, n in low.collect():  # pairs of bytes: 65,536 at most
        dense[key] = n
    shared = spark.sparkContext.broadcast(dense.reshape(256, 256))

    def answer(key: tuple, table: pa.Table) -> pa.Table:
        kind, part = key[0].as_py(), key[1].as_py()
        lists = [_unpacked_keys(k) for k in table.column("keys").to_pylist()]
        keys = np.unique(np.concatenate(lists))
        places = [np.searchsorted(keys, own) for own in lists]
        counts = np.zeros(len(keys), np.int64)
        for at, own in zip(places, table.column("counts").to_pylist(), strict=True):
            counts[at] += _unpacked(own, np.int64)
        values = trie_log10(keys, counts, shared.value, order).astype(np.float32) if kind == _GRAM else counts
        answers = [[c, kind, part, _packed(values[at]), None] for c, at in zip(table.column("chunk").to_pylist(), places, strict=True)]
        if kind == _WORD:  # what the part holds of N (part -1) and of V (part -2)
            answers += [[None, kind, -1, None, int(counts.sum())], [None, kind, -2, None, int((counts > 0).sum())]]
        return pa.Table.from_batches([batch_of(_ANSWERS, list(zip(*answers, strict=True)))])

    asked = chunks.where(F.col("kind").isin(_GRAM, _WORD)).select("chunk", "kind", "part", "keys", "counts")
    answers = settle(asked.groupBy("kind", "part").applyInArrow(answer, _ANSWERS_SQL), "answers")
    sums = dict(answers.where("part < 0").groupBy("part").agg(F.sum("n")).collect())
    tokens, different = sums.get(-1, 0), sums.get(-2, 0)

    def score(text: pa.Table, told: pa.Table) -> pa.Table:
        lengths = _unpacked(text.column("lengths")[0].as_py(), np.int64)
        data = zstandard.decompress(text.column("texts")[0].as_py())
        ends = np.cumsum(lengths)
        streams = [data[e - n : e] for n, e in zip(lengths.tolist(), ends.tolist(), strict=True)]
        parts_of = {(k, p): v for k, p, v in zip(*(told.column(c).to_pylist() for c in ("kind", "part", "values")), strict=True)}

        def values(kind: int, keys: np.ndarray, owner, dtype) -> np.ndarray:
            codes, asked = pd.factorize(keys)  # one pass through a hash table instead of a search for each key
            ascending = np.argsort(asked)
            asked = asked[ascending]
            found = np.empty(len(asked), dtype)
            for part, places in _in_parts(asked, owner(asked, parts)):
                found[ascending[places]] = _unpacked(parts_of[kind, part], dtype)
            return found[codes]

        logs = values(_GRAM, gram_keys(streams, order), gram_part, np.float32)
        scores = np.add.reduceat(logs, ends - lengths, dtype=np.float64)
        hashes = _Hashes()
        listed = [[*s[: -len(END)].split(), END] for s in streams]
        n_tokens = np.array([len(tokens_) for tokens_ in listed])
        first = np.cumsum(n_tokens) - n_tokens
        flat = np.concatenate([np.fromiter(map(hashes.__getitem__, tokens_), np.uint64, len(tokens_)) for tokens_ in listed])
        counts = values(_WORD, flat, word_part, np.int64)
        base = np.add.reduceat(np.log10((counts + 1) / (tokens + different + 1)), first)
        n_known = np.add.reduceat((counts > 0).astype(np.int64), first)
        columns = [
            text.column("doc_ids")[0].as_py(),
            text.column("learned")[0].as_py(),
            n_tokens,
            n_known,
            np.full(len(lengths), tokens, np.int64),
            base,
            scores,
        ]
        return pa.Table.from_batches([batch_of(_SCORES, columns)])

    texts = chunks.where(F.col("kind") == _TEXT).select("chunk", "doc_ids", "learned", "texts", "lengths")
    told = answers.where("chunk IS NOT NULL").select("chunk", "kind", "part", "values")
    return texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(score, _SCORES_SQL)
