"""Near-duplicates by SimHash: byte-position inverted index, count filter, exact check."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, components, slices, unused, words_of
from inkdex.operators.joins import join_by_weight
from inkdex.session import settle, settle_sized

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3

# Two fingerprints that differ in three bits differ in three of the eight bytes at most, so five
# positions hold equal bytes.
BYTES = 8

# Rows of one posting list that a task takes at once; longer lists are cut into blocks. The number
# grows with the index so that no more than LONG_LISTS lists can be longer.
BLOCK_ROWS = 4096
LONG_LISTS = 500_000


def shingle_hashes(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> np.ndarray:
    """Hash of each word shingle of a text, repeats included; a text of fewer words is one shingle, none without words."""
    words = words_of(text)
    if not words:
        return np.empty(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    n = max(len(words) - shingle_words + 1, 1)
    spans = zip(starts[:n].tolist(), (ends[-n:] - 1).tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles, repeats included; 0 without words."""
    hashes = shingle_hashes(text, shingle_words, seed)
    n = len(hashes)
    if not n:
        return 0
    ones = np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


_FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("fp", pa.int64())])


def tag_of_text() -> Column:
    """With doc_id, tells the texts of one id apart."""
    return F.xxhash64(F.col("text").cast("string"))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, tag, fp) per row of ``docs``; fp holds the 64 bits as a signed number, tag hashes the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [fingerprint(t.as_py(), shingle_words, seed) for t in batch.column("text")]
            signed = np.array(values, dtype=np.uint64).view(np.int64)
            yield batch_of(_FINGERPRINTS, [batch.column("doc_id"), batch.column("tag"), signed])

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), tag_of_text().alias("tag"), F.col("text").cast("string").alias("text")]
    return docs.select(*columns).mapInArrow(run, "doc_id bigint, tag bigint, fp bigint")


def equal_bytes(differing: np.ndarray) -> np.ndarray:
    """Positions at which two fingerprints hold the same byte, from the bits they differ in."""
    folded = differing | differing >> np.uint64(4)
    folded |= folded >> np.uint64(2)
    folded |= folded >> np.uint64(1)  # the lowest bit of a byte now tells whether any of it differs
    return BYTES - np.bitwise_count(folded & np.uint64(0x0101010101010101))


def _linked(one: np.uint64 | np.ndarray, many: np.ndarray, max_bits: int) -> np.ndarray:
    """Count filter, then the check: pairs of fewer than ``BYTES - max_bits`` equal bytes go, of the others the bits are counted."""
    differing = many ^ one
    near = equal_bytes(differing) >= BYTES - max_bits
    near[near] = np.bitwise_count(differing[near]) <= max_bits
    return near


def _forest(values: np.ndarray, max_bits: int) -> Iterator[tuple[np.uint64, np.ndarray]]:
    """Links that connect what all links of ``values`` connect: each value is reached once."""
    left = values
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            one = reached.pop()
            near = _linked(one, left, max_bits)
            if near.any():
                found, left = left[near], left[~near]
                reached.extend(found)
                yield one, found


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges_of_lists(max_bits: int):
    """Rows sorted by list to links, list by list; a list may go over several batches."""

    def links(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        a, b = [], []
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
        pairs = starts[ends - starts == 2]
        near = _linked(values[pairs], values[pairs + 1], max_bits)
        a.append(values[pairs[near]])
        b.append(values[pairs[near] + 1])
        long = ends - starts > 2
        for start, end in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            for one, found in _forest(np.unique(values[start:end]), max_bits):
                a.append(np.full(len(found), one))
                b.append(found)
        return batch_of(_EDGES, [np.concatenate(x).view(np.int64) for x in (a, b)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_keys, kept = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.concatenate([kept_keys, batch.column("list").to_numpy()])
            values = np.concatenate([kept, batch.column("fp").to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if whole:
                yield links(keys[:whole], values[:whole])
            kept_keys, kept = keys[whole:], values[whole:]
        if len(kept):
            yield links(kept_keys, kept)

    return run


def chosen_positions(max_bits: int = MAX_BITS) -> list[tuple[int, ...]]:
    """Sets of byte positions, of which any two fingerprints of at most ``max_bits`` differing bits agree at one set or more."""
    if not 0 <= max_bits <= 5:
        raise ValueError("max_bits must be between 0 and 5")
    positions = range(min(max_bits + 3, BYTES))
    return list(combinations(positions, BYTES - max_bits - (BYTES - len(positions))))


def _keyed(prints: DataFrame, bits: str, max_bits: int, *columns: str) -> DataFrame:
    """(*columns, key): a row for each list that a fingerprint in the column ``bits`` belongs to; a key tells the number of its positions and the bytes there."""

    def key(number: int, chosen: tuple[int, ...]):
        packed = F.lit(number).cast("bigint")
        for p in chosen:
            packed = F.shiftleft(packed, 8).bitwiseOR(F.shiftrightunsigned(bits, 8 * p).bitwiseAND(F.lit(0xFF)))
        return packed

    keys = F.array(*(key(n, c) for n, c in enumerate(chosen_positions(max_bits))))
    return prints.select(*columns, F.explode(keys).alias("key"))


def fingerprint_links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) of at most ``max_bits`` differing bits.

    Not all pairs, but enough to connect everything that pairs connect. The inverted index lists
    fingerprints by their bytes at some positions. A linked pair has equal bytes at ``8 - max_bits``
    positions or more; so of any ``max_bits + 3`` positions it shares three. Lists are therefore kept
    for the triples of six positions (with three bits), which tells far more pairs apart than
    single bytes do. Members of a list are tallied over all eight positions, pairs below the minimum
    are dropped, the others are checked bit by bit. A list too long for one task is cut into blocks, and each pair
    of blocks is a list of its own, so nothing is left out.
    """
    rows = _keyed(distinct, "fp", max_bits, "fp")
    lengths = settle(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "lists")
    total = lengths.agg(F.sum("n")).first()[0] or 0
    block = max(BLOCK_ROWS, total // LONG_LISTS)
    long = lengths.where(F.col("n") > block).select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    cut = rows.join(F.broadcast(long), "key", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cut = cut.select("fp", "key", own.alias("own"), other.alias("other"))
    # The name of a list: its key, and for a long one the two blocks that meet.
    name = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    lists = cut.select(name.alias("list"), "fp").repartition("list").sortWithinPartitions("list", "fp")
    return lists.mapInArrow(_edges_of_lists(max_bits), "a bigint, b bigint")


def simhash_classes(docs: DataFrame, max_bits: int = MAX_BITS, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, tag, fp, component, component_id) per row of ``docs``.

    Documents of one fingerprint are one class; classes within ``max_bits`` of each other are linked.
    ``component`` is the smallest fingerprint and ``component_id`` the smallest doc_id that links reach. Null and empty texts have the
    fingerprint 0 and are linked like any other; repeated rows stay; a row without an id keeps its
    fingerprint and gets the smallest id of its component, null if that has none; an empty table
    gives no rows. Columns other than doc_id and text are not read.
    """
    rows = settle(fingerprints(docs, shingle_words, seed), "fingerprints")
    classes = settle(
        rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows")), "classes"
    )
    return components_of(rows, classes, fingerprint_links(classes.select("fp"), max_bits))


def lists_between(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(list, number, bits, fp, component): of the lists of ``prints`` (bits, fp, component) those of several components, long ones cut into blocks.

    Two rows within ``max_bits`` of each other share a list, and first that whose ``number`` is that of the first positions they agree at.
    """
    columns = ["bits", "fp", "component"]
    rows = _keyed(prints, "bits", max_bits, *columns)
    several = [F.count(F.lit(1)).alias("n"), F.min("component").alias("least"), F.max("component").alias("most")]
    lengths = settle(rows.groupBy("key").agg(*several).where("least <> most").select("key", "n"), "lists")
    cut = join_by_weight(rows, lengths, "key", "n").withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    width = 8 * len(chosen_positions(max_bits)[0])
    cut = cut.select(*columns, "key", F.shiftright("key", width).alias("number"), own.alias("own"), other.alias("other"))
    return cut.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("list"), "number", *columns)


def components_of(rows: DataFrame, classes: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, tag, fp, component, component_id) per row of ``rows`` (doc_id, tag, fp).

    ``classes`` has the smallest doc_id (``first``) and the number of ``rows`` per fp; ``links`` (a, b) join values of fp.
    """
    joined = components(links).withColumnRenamed("node", "fp")
    named = classes.join(joined, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    sizes = named.groupBy("component").agg(F.min("first").alias("component_id"), F.count(F.lit(1)).alias("classes"))
    named = join_by_weight(settle(named, "classes"), settle(sizes, "components"), "component", "classes")
    named = settle(named.select("fp", "rows", "component", "component_id"), "classes")
    return join_by_weight(rows, named, "fp", "rows").select("doc_id", "tag", "fp", "component", "component_id")


def keep_first(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``simhash_classes`` makes the first of their group.

    That is the row of the smallest doc_id of each component; a row without an id only if its component has
    none. Of several such rows in a component, one stays, that of the smallest hash of its text, of equal texts that of the
    smallest hash of its columns.
    """
    return keep_first_found(docs, settle(simhash_classes(docs, max_bits), "found"))


def keep_first_found(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``keep_first`` by the stored components ``found`` (doc_id, tag, component, component_id)."""
    first = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("component", "doc_id").agg(F.min("tag").alias("tag"))
    rows = found.groupBy("doc_id", "tag").agg(F.count(F.lit(1)).alias("rows"))
    first = first.select(F.col("doc_id").alias("first_id"), F.col("tag").alias("first_tag"))
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tag") == F.col("first_tag"))
    kept = rows.join(first.distinct(), same, "left")
    marks = kept.select("doc_id", "tag", "rows", F.col("first_tag").isNotNull().alias("kept")).where("NOT kept OR rows > 1")
    own_id, own_tag, kept, content = unused(docs, "_id", "_tag", "_kept", "_content")
    marks = marks.select(F.col("doc_id").alias(own_id), F.col("tag").alias(own_tag), F.col("kept").alias(kept))
    marks, small = settle_sized(marks, "marks")
    if small:
        marks = F.broadcast(marks)
    own = docs["doc_id"].cast("bigint").eqNullSafe(F.col(own_id)) & (tag_of_text() == F.col(own_tag))
    plain = docs.join(marks, own, "left_anti")
    repeated = docs.join(marks.where(F.col(kept)), own)
    # Of rows equal in id and text the one of the smallest hash of all columns that can be hashed.
    hashed = F.xxhash64(*(F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()))
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(content)
    one = repeated.select(own_id, own_tag, row, hashed.alias(kept)).groupBy(own_id, own_tag).agg(F.min_by(content, kept).alias(content))
    return plain.unionByName(one.select(f"{content}.*"))


def hex_fingerprint(fp: Column) -> Column:
    """The 64 bits as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
