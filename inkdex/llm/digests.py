"""Document fingerprints: quartile bucket digests of hashed byte triplets, and how alike two are."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices
from inkdex.session import settle

BUCKETS = 512

# Steps of the length code: bytes grow by this factor from one code to the next.
LENGTH_STEP = 1.5
# What one step of length counts against one bucket that is one quartile off, and the most it counts.
LENGTH_WEIGHT, LENGTH_STEPS = 4, 16


def digest(text: str | None, buckets: int = BUCKETS) -> bytes:
    """One byte for the length, then two bits per bucket: the quartile of its count among all buckets.

    Counts are of the bytes' triplets, hashed. Texts below three bytes have no triplet, so only their
    length tells them apart; null is empty. ``buckets`` is a power of two from 4 to 65,536.
    """
    data = (text or "").encode()
    octets = np.frombuffer(data, np.uint8).astype(np.uint32)
    mixed = (octets[:-2] << np.uint32(16)) | (octets[1:-1] << np.uint32(8)) | octets[2:] if len(data) > 2 else octets[:0]
    hashed = (mixed * np.uint32(2654435761)) >> np.uint32(33 - buckets.bit_length())
    counts = np.bincount(hashed, minlength=buckets)
    marks = [buckets // 4 - 1, buckets // 2 - 1, 3 * buckets // 4 - 1]
    low, middle, high = np.partition(counts, marks)[marks]
    codes = (counts > low).astype(np.uint8) + (counts > middle) + (counts > high)
    packed = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    length = int(np.log(len(data)) / np.log(LENGTH_STEP)) + 1 if data else 0
    return bytes([min(length, 255)]) + packed.astype(np.uint8).tobytes()


def _codes(value: bytes) -> np.ndarray:
    packed = np.frombuffer(value, np.uint8)[1:]
    return np.stack([packed >> shift & 3 for shift in (0, 2, 4, 6)]).astype(np.int16)


def likeness(one: bytes, other: bytes) -> float:
    """1 for equal digests, less by every quartile and length step that lies between them, 0 at worst."""
    a, b = _codes(one), _codes(other)
    steps = min(abs(one[0] - other[0]), LENGTH_STEPS)
    apart = int(np.abs(a - b).sum()) + LENGTH_WEIGHT * steps
    return 1.0 - apart / (3 * a.size + LENGTH_WEIGHT * LENGTH_STEPS)


_DIGESTS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary())])


def digests(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, digest) per row of ``docs``; a null text is empty, repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch_of(_DIGESTS, [batch.column("doc_id"), [digest(t.as_py(), buckets) for t in batch.column("text")]])

    return _rows(docs).mapInArrow(run, "doc_id bigint, digest binary")


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))


_COMPARED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.binary()),
        ("digest", pa.binary()),
        ("edited_digest", pa.binary()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)
_COMPARED_SQL = (
    "doc_id bigint, n_chars bigint, edited_sha256 binary, digest binary, edited_digest binary, "
    "near_edited double, near_next double"
)
# An end of a partition: its first (0) and its last (1) document, with their texts.
_ENDS = pa.schema([("part", pa.int32()), ("end", pa.int32()), ("text", pa.string())])


def _compared(doc_id: int | None, text: str, own: bytes, following: str, theirs: bytes, buckets: int) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    changed = digest(edited, buckets)
    sha = hashlib.sha256(edited.encode()).digest()
    return doc_id, len(text), sha, own, changed, likeness(own, changed), likeness(own, theirs)


def compare_with_next(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Digests of each text, of an edit of it, and of the next text, compared.

    The next document is the one after it by doc_id (null first; equal ids by a hash of the text, then
    by text), after the last the first. The edit replaces the last half of the code points by the
    first of the next text. Returns doc_id, n_chars, edited_sha256, digest, edited_digest, near_edited,
    near_next. Null texts are empty, repeated rows are compared like any others, a single document is
    its own next, an empty table gives no rows.

    One exchange sorts the texts by range. A task compares what lies in its partition and hands on the
    first and the last document, whose comparison over the edge of the partition comes second.
    """
    spark = docs.sparkSession
    tag = F.xxhash64("text")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = _rows(docs).repartitionByRange(parts, "doc_id", tag).sortWithinPartitions("doc_id", tag, "text")
    schema = pa.schema([*_COMPARED, *_ENDS])
    blank, no_end = [None] * len(_COMPARED), [None] * len(_ENDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in slices(batches):
            done = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = digest(text, buckets)
                if last is None:
                    done.append([*blank, part, 0, text])
                else:
                    done.append([*_compared(*last, text, own, buckets), *no_end])
                last = doc_id, text, own
            if done:
                yield batch_of(schema, list(zip(*done, strict=True)))
        if last is not None:
            yield batch_of(schema, [[v] for v in [last[0], *blank[1:], part, 1, last[1]]])

    stored = settle(ordered.mapInArrow(run, f"{_COMPARED_SQL}, part int, end int, text string"), "compared")
    within = stored.where("part IS NULL").drop("part", "end", "text")
    used = sorted(r.part for r in stored.where("end = 0").select("part").collect())  # one row per partition
    following = spark.createDataFrame(list(zip(used, used[1:] + used[:1], strict=True)), "part int, next_part int")
    lasts = stored.where("end = 1").select("part", "doc_id", "text").join(F.broadcast(following), "part")
    firsts = stored.where("end = 0").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))

    def over_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for doc_id, text, later in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                made = _compared(doc_id, text, digest(text, buckets), later, digest(later, buckets), buckets)
                yield batch_of(_COMPARED, [[v] for v in made])

    pairs = lasts.join(firsts, "next_part").select("doc_id", "text", "next_text")
    return within.unionByName(pairs.mapInArrow(over_edges, _COMPARED_SQL))
