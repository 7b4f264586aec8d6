"""Token ids in files: an adaptive context-mixing range coder over independent, checksummed blocks.

The ids of a block are dealt to many lanes, which are coded side by side, one id of each at a time, so that
every operation is one on arrays. The lanes share what the block's model has learned so far.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from inkdex.llm.common import batch_of, slices

# Most ids of a block, most lanes of a block, fewest ids of a lane if there are several, and ids after which a
# segment is written (a document is never cut).
BLOCK_IDS, LANES, LANE_IDS, SEGMENT_IDS = 2 << 20, 8192, 256, 8 << 20
# Words whose ids a worker remembers before it starts anew, bytes of texts it takes at a time, and words that the
# library is given at a time.
REMEMBERED, TEXT_BYTES, LEARNED = 1_000_000, 8 << 20, 10_000

MAGIC = b"IDX2"

# Orders 1 and 2: by the id before, and by hash of the two before, the id that is expected and how sure it is
# (1 to 7, 0: none). Both are kept in one number, the sureness above _SURE bits.
_SLOTS, _SURE, _ID = 1 << 16, 28, (1 << 28) - 1
# How sure an expected id is next, by whether it came true (8) and how sure it was; given up below 1.
_NEXT = np.array([0, 0, 1, 1, 2, 2, 3, 3, 1, 2, 3, 4, 5, 6, 7, 7]) << _SURE
# Contexts of the weights: sureness of order 1 (3 bits), of order 2 (3 bits), whether both expect the same.
_CONTEXTS = 128
_FIRST, _SECOND = np.arange(_CONTEXTS) >> 3 & 7, np.arange(_CONTEXTS) & 7
_SAME = np.arange(_CONTEXTS) >= 64
_WORD, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


class _Model:
    """What the lanes of a block have learned, and the state of each; ids are numbers below ``size``.

    Order 0 are counts of the block's ids so far. An id that order 1 or 2 expects has its weight added to its
    count: the odds that such expectations have come true, by how sure both are. Counts and weights are
    worked out anew after 1, 2, 3, 4, 6, 8, 12, ... steps.
    """

    def __init__(self, lanes: int, size: int, decodes: bool) -> None:
        self.size, self.decodes = size, decodes
        self.most = max(1 << 16, 16 * size)
        self.counts, self.tally = np.zeros(size, np.int64), np.zeros(4 * _CONTEXTS, np.int64)
        self.expected = np.zeros(size + 1 + _SLOTS, np.int64)
        self.low, self.range = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.last = self.before = np.full(lanes, size, np.int64)
        self.learned, self.due = 0, 1
        self.weigh()

    def weigh(self) -> None:
        seen = int(self.counts.sum())
        self.widths = 1 + self.counts * (self.most - self.size) // max(seen, 1)
        ends = np.cumsum(self.widths)
        self.starts, self.total = ends - self.widths, int(ends[-1])
        if self.decodes:
            self.id_at = np.repeat(np.arange(self.size, dtype=np.int32), self.widths)
        tally = self.tally.reshape(2, 2, _CONTEXTS)  # order 2 came true, order 1 came true, context
        tries = tally.sum(axis=(0, 1)) + 2
        first = np.where(_FIRST > 0, tally[:, 1].sum(axis=0), 0) / tries
        second = np.where((_SECOND > 0) & ~_SAME, tally[1].sum(axis=0), 0) / tries
        rest = np.maximum(1 - first - second, 1 / 32) / self.total
        self.first, self.second = (first / rest).astype(np.int64), (second / rest).astype(np.int64)

    def step(self, coder, matrix: np.ndarray, step: int, n: int) -> None:
        """One id of each of the first ``n`` lanes: row ``step`` of the matrix, which ``coder`` reads or fills."""
        if step == self.due:
            self.counts += np.bincount(matrix[self.learned : step].ravel(), minlength=self.size)
            self.weigh()
            self.learned, self.due = step, step + max((1 << step.bit_length() - 1) // 2, 1)
        if n < len(self.last):
            for name in ("low", "range", "last", "before"):
                setattr(self, name, getattr(self, name)[:n])
        place = np.empty((2, n), np.int64)
        place[0] = self.last
        place[1] = ((self.last * 0x9E3779B1 ^ self.before * 0x85EBCA77) >> 9 & _SLOTS - 1) + (self.size + 1)
        told = self.expected.take(place)
        guess, sure = told & _ID, told >> _SURE
        one, two = guess
        context = sure[0] << 3 | sure[1]
        context += (one == two) * 64
        first, second = self.first.take(context), self.second.take(context)
        unit = self.range // (first + second + self.total).view(np.uint64)
        if coder.decodes:
            matrix[step, :n] = coder.find(self, unit, one, two, first, second)
        ids = matrix[step, :n]
        met = guess == ids
        self.low += (self.starts.take(ids) + first * (one < ids) + second * (two < ids)).view(np.uint64) * unit
        np.multiply(unit, (self.widths.take(ids) + first * met[0] + second * met[1]).view(np.uint64), out=self.range)
        small = np.flatnonzero(self.range <= _LOW)
        if len(small):
            coder.shift(small, _settle(self, small))
        context += met[0] * _CONTEXTS
        context += met[1] * (2 * _CONTEXTS)
        self.tally += np.bincount(context, minlength=4 * _CONTEXTS)
        sure += met * 8
        kept = _NEXT.take(sure)
        np.copyto(guess, ids, where=kept == 0)
        # Of lanes that have the same context the surest stays, of equal ones the larger id.
        self.expected[place] = 0
        np.maximum.at(self.expected, place.ravel(), (np.maximum(kept, 1 << _SURE) | guess).ravel())
        self.before, self.last = self.last, ids


def _settle(model: _Model, lanes: np.ndarray) -> np.ndarray:
    """Take the upper half off lows whose range lies below 2**32; a range that the halves cut is cut to its longer part."""
    low, width = model.low.take(lanes), model.range.take(lanes)
    below = (np.uint64(0) - low) & _LOW  # up to the next multiple of 2**32
    cut = (below > 0) & (below < width)
    upper = cut & (width - below > below)
    low += below * upper
    width = np.where(upper, width - below, np.where(cut, below, width))
    model.low[lanes], model.range[lanes] = low << _WORD, width << _WORD
    return low >> _WORD


class _Encoder:
    decodes = False

    def __init__(self, lanes: int, steps: int) -> None:
        self.out, self.used = np.zeros((lanes, steps + 1), np.uint32), np.zeros(lanes, np.int64)

    def shift(self, lanes: np.ndarray, words: np.ndarray) -> None:
        used = self.used.take(lanes)
        self.out[lanes, used] = words
        self.used[lanes] = used + 1

    def finish(self, lows: np.ndarray) -> np.ndarray:
        self.shift(np.arange(len(lows)), lows + _LOW >> _WORD)
        return self.out[np.arange(self.out.shape[1]) < self.used[:, None]]


class _Decoder:
    decodes = True

    def __init__(self, words: np.ndarray, lengths: np.ndarray) -> None:
        width = int(lengths.max()) + 1  # what follows the last word is 0
        data = np.zeros((len(lengths), width), np.uint64)
        data[np.arange(width) < lengths[:, None]] = words
        self.data, self.at = data.ravel(), np.arange(2, data.size, width)
        self.code = data[:, 0] << _WORD | data[:, 1]

    def find(self, model: _Model, unit: np.ndarray, one: np.ndarray, two: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        value = ((self.code[: len(unit)] - model.low) // unit).view(np.int64)
        # Weights stand before the counts of their ids; take off what of them lies below the value.
        value -= np.minimum(np.maximum(value - model.starts.take(one) - second * (two < one), 0), first)
        value -= np.minimum(np.maximum(value - model.starts.take(two), 0), second)
        return model.id_at.take(value, mode="clip")

    def shift(self, lanes: np.ndarray, words: np.ndarray) -> None:
        at = self.at.take(lanes)
        self.code[lanes] = self.code.take(lanes) << _WORD | self.data.take(at, mode="clip")
        self.at[lanes] = at + 1


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and the place of each id among them."""
    most = int(ids.max())
    if most > 16 * len(ids):
        return np.unique(ids, return_inverse=True)
    met = np.zeros(most + 1, bool)
    met[ids] = True
    return np.flatnonzero(met), (np.cumsum(met) - 1).take(ids)


def _encode_block(ids: np.ndarray) -> bytes:
    """Number of distinct ids and length of the head; head under zlib: distinct ids less the one before, words of each lane; words."""
    distinct, places = _numbered(ids)
    steps = -(-len(ids) // min(max(len(ids) // LANE_IDS, 1), LANES))
    lanes = -(-len(ids) // steps)
    matrix = np.zeros((lanes, steps), np.int64)
    matrix.ravel()[: len(ids)] = places
    matrix, short = np.ascontiguousarray(matrix.T), len(ids) - (lanes - 1) * steps  # only the last lane is shorter
    model, coder = _Model(lanes, len(distinct), False), _Encoder(lanes, steps)
    lows = model.low
    for step in range(steps):
        model.step(coder, matrix, step, lanes - (step >= short))
    words = coder.finish(lows)
    head = zlib.compress(np.concatenate((np.diff(distinct, prepend=0), coder.used)).astype("<u4").tobytes())
    return struct.pack("<II", len(distinct), len(head)) + head + words.astype("<u4").tobytes()


def _decode_block(data: bytes, total: int) -> np.ndarray:
    size, length = struct.unpack_from("<II", data)
    head = np.frombuffer(zlib.decompress(data[8 : 8 + length]), "<u4")
    distinct, lengths = np.cumsum(head[:size], dtype=np.int64).astype(np.uint32), head[size:].astype(np.int64)
    words = np.frombuffer(data, "<u4", offset=8 + length)
    lanes = len(lengths)
    steps = -(-total // min(max(total // LANE_IDS, 1), LANES))
    short = total - (lanes - 1) * steps
    matrix = np.zeros((steps, lanes), np.int64)
    model, coder = _Model(lanes, size, True), _Decoder(words, lengths)
    for step in range(steps):
        model.step(coder, matrix, step, lanes - (step >= short))
    return distinct.take(matrix.T.ravel()[:total])


def encode_ids(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """Ids below 2**28 as bytes: a head, one entry per block, and the blocks.

    Head: "IDX2", ids per block, ids in all. An entry: length and crc32 of the block's bytes, crc32 of
    its ids. Every block starts from the same state and can be read by itself.
    """
    blocks = [ids[at : at + block_ids] for at in range(0, len(ids), block_ids)]
    coded = [_encode_block(b) for b in blocks]
    entries = [(len(c), zlib.crc32(c), zlib.crc32(b.astype("<u4").tobytes())) for c, b in zip(coded, blocks, strict=True)]
    head = MAGIC + struct.pack("<IQ", block_ids, len(ids))
    return head + b"".join(struct.pack("<III", *e) for e in entries) + b"".join(coded)


def decode_ids(data: bytes) -> np.ndarray:
    """Inverse of ``encode_ids``; a block that does not have its checksums raises ValueError."""
    size = struct.calcsize("<IQ")
    if data[:4] != MAGIC:
        raise ValueError("not a file of coded ids")
    block_ids, total = struct.unpack("<IQ", data[4 : 4 + size])
    n = -(-total // block_ids)
    at = 4 + size
    entries = [struct.unpack_from("<III", data, at + 12 * i) for i in range(n)]
    at += 12 * n
    ids = np.empty(total, np.uint32)
    for i, (length, check, ids_check) in enumerate(entries):
        coded = data[at : at + length]
        if zlib.crc32(coded) != check:
            raise ValueError("a block of coded ids is damaged")
        block = _decode_block(coded, min(block_ids, total - i * block_ids)).astype("<u4")
        if zlib.crc32(block.tobytes()) != ids_check:
            raise ValueError("a block of coded ids is damaged")
        ids[i * block_ids :][: len(block)] = block
        at += length
    return ids


class WordIds(dict):
    """Ids of texts word by word, as little-endian bytes; a word is what ASCII white space sets apart.

    The library's vocabulary drops nothing but white space and never joins words across it, so a text has
    the ids of its words. Words that are not remembered are given to the library, many as one text. Where
    they end there is told by the ids that close a piece, if words of letters have one piece each, or by a
    mark of one id between them, which no word has that does not hold the mark itself. Letters and one
    stop after them are looked up apart, if the vocabulary cuts there and has no added token with that stop.
    """

    MARK, STOPS = b"\x01", (b".", b",", b";", b":", b"!", b"?")

    def __init__(self, source: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        self.tokenizer = Tokenizer.from_str(source)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        suffix, vocabulary = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.closes, self.marks = np.zeros((2, max(vocabulary.values()) + 1), bool)
        if suffix:
            self.closes[[i for piece, i in vocabulary.items() if piece.endswith(suffix)]] = True
        mark = self.ids_of(self.MARK)
        if len(mark) == 1:
            self.marks[mark] = True
        added = "".join(token.content for token in self.tokenizer.get_added_tokens_decoder().values())
        cut = [s for s in self.STOPS if self.ids_of(b"word" + s).tolist() == [*self.ids_of(b"word"), *self.ids_of(s)]]
        self.apart = frozenset(s for s in cut if s.decode() not in added)

    def ids_of(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text.decode()], add_special_tokens=False)[0].ids, "<u4")

    def __missing__(self, word: bytes) -> bytes:
        if word[-1:] in self.apart and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1:]]
        value = self[word] = self.ids_of(word).tobytes()
        return value

    def learn(self, words: list[bytes]) -> None:
        """Remember the ids of words; what this leaves out is found one by one."""
        if len(self) > REMEMBERED:
            self.clear()
        new = {w[:-1] if w[-1:] in self.apart and w[:-1].isalpha() else w for w in words if w not in self}
        new = [w for w in new if w not in self]
        self._learn([w for w in new if w.isalpha()], b" ", self.closes, 0)
        self._learn([w for w in new if w not in self and self.MARK not in w], b" " + self.MARK + b" ", self.marks, 1)

    def _learn(self, words: list[bytes], between: bytes, last: np.ndarray, extra: int) -> None:
        """``last`` tells the ids at which words end, the last ``extra`` of which are not the word's."""
        for at in range(0, len(words), LEARNED):
            some = words[at : at + LEARNED]
            ids = self.ids_of(between.join([*some, b""]))
            ends = 4 * (np.flatnonzero(last.take(ids)) + 1)
            if len(ends) == len(some):
                coded, stops = ids.tobytes(), ends.tolist()
                for word, start, stop in zip(some, [0, *stops], stops):
                    self[word] = coded[start : stop - 4 * extra]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, none of them null, in a row, and how many each has."""
        words = pc.ascii_split_whitespace(texts)
        held = words.flatten().dictionary_encode()
        distinct = held.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        self.learn(distinct)
        coded = [self[w] for w in distinct]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        starts = np.concatenate(([0], np.cumsum(lengths)))
        lists = pa.LargeListArray.from_arrays(starts, np.frombuffer(b"".join(coded), "<u4"))
        ids = lists.take(held.indices).flatten().to_numpy()
        before = np.concatenate(([0], np.cumsum(lengths.take(held.indices.to_numpy()))))
        ends = np.cumsum(pc.list_value_length(words).to_numpy())
        return ids, np.diff(before.take(ends), prepend=0)

    def encode(self, text: str) -> bytes:
        return self.encode_all(pa.array([text]))[0].tobytes()


_loaded: dict[int, WordIds] = {}


def _load(source: str) -> WordIds:
    key = hash(source)
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = WordIds(source)
    return _loaded[key]


_SEGMENTS = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int64())),
        ("payload", pa.binary()),
    ]
)
_SEGMENTS_SQL = "part int, segment int, n_ids bigint, doc_ids array<bigint>, counts array<bigint>, payload binary"


def _of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches (doc_id, text) in slices of one text and less than TEXT_BYTES of others."""
    for batch in batches:
        cells = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(), dtype=np.int64) // TEXT_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            if start < stop:
                yield batch.slice(start, stop - start)


def write_ids(docs: DataFrame, tokenizer: str, end_id: int, path: str) -> None:
    """Encode all rows of ``docs`` (doc_id, text) and write their ids to the folder ``path``.

    ``tokenizer`` is a JSON vocabulary of the tokenizers library that drops white space; ``end_id``
    follows the ids of each document. The folder holds Parquet files whose rows are segments:
    part and segment number them in ascending order of doc_id (null first; equal ids by a hash of the
    text, then by text), doc_ids and counts say how many ids each document has, and payload holds the
    ids as ``encode_ids`` codes them. Null and empty texts have the end id alone, repeated rows are
    written each, an empty table makes no segments.
    """
    with open(tokenizer, encoding="utf-8") as file:  # its size does not depend on the data
        shared = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part, number = _load(shared.value), TaskContext.get().partitionId(), 0
        doc_ids, coded, size = [], [], 0

        def segment() -> pa.RecordBatch:
            payload = encode_ids(np.concatenate(coded))
            return batch_of(_SEGMENTS, [[part], [number], [size], [doc_ids], [list(map(len, coded))], [payload]])

        for batch in _of_texts(batches):
            ids, counts = words.encode_all(batch.column(1))
            stops = np.cumsum(counts)
            ids, stops = np.insert(ids, stops, end_id), (stops + np.arange(1, len(stops) + 1)).tolist()
            for doc_id, start, stop in zip(batch.column(0).to_pylist(), [0, *stops], stops):
                doc_ids.append(doc_id)
                coded.append(ids[start:stop])
                size += stop - start
                if size >= SEGMENT_IDS:
                    yield segment()
                    doc_ids, coded, size, number = [], [], 0, number + 1
        if doc_ids:
            yield segment()

    tag = F.xxhash64("text")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 2, 1)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text)
    rows = rows.repartitionByRange(parts, "doc_id", tag).sortWithinPartitions("doc_id", tag, "text")
    rows.mapInArrow(run, _SEGMENTS_SQL).write.parquet(path)


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(part, segment, first): how many ids the segments before hold."""
    sizes = spark.read.parquet(path).select("part", "segment", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    # One row per part; the parts are the partitions of the writing job.
    parts = parts.withColumn("base", F.sum("ids").over(Window.orderBy("part")) - F.col("ids")).drop("ids")
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("segment")) - F.col("n_ids")
    return sizes.withColumn("inside", inside).join(parts, "part").select("part", "segment", (F.col("base") + F.col("inside")).alias("first"))


_READ = [("part", pa.int32()), ("segment", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
_READ_SQL = "part int, segment int, doc_id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"


def read_ids(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of a folder that ``write_ids`` has written.

    Columns: part, segment, doc_id, ``before`` (ids of the segment before the document), n_tokens,
    ids_crc32 (of the ids as little-endian unsigned 32-bit numbers), and with ``with_ids`` the ids.
    """
    schema = pa.schema([*_READ, *([("ids", pa.list_(pa.int32()))] if with_ids else [])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            row = batch.to_pylist()[0]
            ids = decode_ids(row["payload"]).astype("<u4", copy=False)
            counts = np.array(row["counts"], np.int64)
            ends = np.cumsum(counts)
            checks = [zlib.crc32(ids[end - n : end]) for n, end in zip(counts.tolist(), ends.tolist(), strict=True)]
            n = len(checks)
            columns = [[row["part"]] * n, [row["segment"]] * n, row["doc_ids"], ends - counts, counts, checks]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(np.concatenate(([0], ends)).astype(np.int32), ids.astype(np.int32)))
            yield batch_of(schema, columns)

    sql = _READ_SQL + (", ids array<int>" if with_ids else "")
    return spark.read.parquet(path).select("part", "segment", "doc_ids", "counts", "payload").mapInArrow(run, sql)
