"""Near-duplicates by the Jaccard similarity of word shingles: SimHash and MinHash bands propose pairs, the sets decide."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, components, remove, slices
from inkdex.llm.simhash import (
    MAX_BITS,
    SEED,
    _linked,
    chosen_positions,
    components_of,
    fingerprint,
    fingerprint_links,
    keep_first_found,
    lists_between,
    shingle_hashes,
    tag_of_text,
)
from inkdex.operators.joins import join_by_weight
from inkdex.session import settle, settle_sized

SHINGLE_WORDS = 5
LEAST = 0.8

# A pair of similarity s shares none of the bands with probability (1 - s^ROWS)^BANDS: 6e-7 at 0.8.
BANDS, ROWS = 36, 5

# Of the 180 minima a pair of similarity 0.8 shares 144, give or take 5.4; a member that shares fewer than so many with a leader is not
# compared with it, but with all members of other components afterwards.
LEAST_SHARED = 122

# Members of one list that a task takes at once, and pairs that it holds; longer lists are cut into blocks.
BLOCK_ROWS, PAIRS = 4096, 1 << 17

# Shingles of members that a block holds where members come with their sets.
BLOCK_SHINGLES = 1 << 21

# Times that a list's members are gathered about one of them, before those left over are compared with all.
LEADERS = 16

# Members of which any may lead.
FEW = 8

# Classes of values by which sets that cannot be alike are told before they are compared.
TALLIES = 1024

# Bytes of a fingerprint at each set of positions that operator 10's lists are kept for.
_CHOSEN = np.array([sum(0xFF << 8 * p for p in chosen) for chosen in chosen_positions()], np.uint64)

_PICK = np.random.default_rng(SEED)
_FACTORS, _MASKS = (_PICK.integers(0, 1 << 64, (BANDS * ROWS, 1), dtype=np.uint64) for _ in range(2))
_FACTORS |= np.uint64(1)


def shingle_set(text: str | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The different shingles of a text, ascending by hash."""
    return np.unique(shingle_hashes(text, shingle_words))


def minima_of(hashes: np.ndarray) -> np.ndarray:
    """The least value of every hash function over the set ``hashes``."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for start in range(0, len(hashes), 2048):
        least = np.minimum(least, ((hashes[start : start + 2048] ^ _MASKS) * _FACTORS).min(axis=1))
    return least


def bands_of(minima: np.ndarray) -> list[int]:
    """One signed key per band, of the bytes that the signature has of it: so a list holds just those whose signatures agree there."""
    signature = signature_of(minima)
    keys = [xxhash.xxh64_intdigest(signature[n * ROWS : (n + 1) * ROWS], n) for n in range(BANDS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def signature_of(minima: np.ndarray) -> bytes:
    """One byte of each minimum."""
    return (minima >> np.uint64(32)).astype(np.uint8).tobytes()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets that are not empty."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


_ROWS = pa.schema(
    [("doc_id", pa.int64()), ("tag", pa.int64()), ("fp", pa.int64()), ("n", pa.int64()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary()), ("bits", pa.int64())]
)
_SETS = pa.schema([("fp", pa.int64()), ("shingles", pa.binary())])
_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _set_hashes(docs: DataFrame, shingle_words: int, least: float) -> DataFrame:
    """(doc_id, tag, fp, n, bands, signature, bits) per row: fp hashes the set of n shingles, tag the text; bits are its SimHash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t.as_py(), shingle_words) for t in batch.column("text")]
            prints = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) if len(s) else 0 for s in sets], np.uint64)
            # One shingle more or less takes a smaller set below the least similarity.
            minima = [minima_of(s) if len(s) / (len(s) + 1) >= least or (len(s) - 1) / max(len(s), 1) >= least else None for s in sets]
            bands = [[] if m is None else bands_of(m) for m in minima]
            signatures = [None if m is None else signature_of(m) for m in minima]
            sizes = [len(s) for s in sets]
            bits = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64).view(np.int64)
            yield batch_of(_ROWS, [batch.column("doc_id"), batch.column("tag"), prints.view(np.int64), sizes, bands, signatures, bits])

    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), tag_of_text().alias("tag"), F.col("text").cast("string").alias("text")]
    schema = "doc_id bigint, tag bigint, fp bigint, n bigint, bands array<bigint>, signature binary, bits bigint"
    return docs.select(*columns).mapInArrow(run, schema)


def _sets(docs: DataFrame, samples: DataFrame, shingle_words: int) -> DataFrame:
    """(fp, shingles) per row of ``samples`` (fp, _id, _tag), which name one row of ``docs`` each; repeated rows count once."""
    samples, small = settle_sized(samples, "samples")
    if small:
        samples = F.broadcast(samples)
    own = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (tag_of_text() == F.col("_tag"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = [shingle_set(t.as_py(), shingle_words).tobytes() for t in batch.column("text")]
            yield batch_of(_SETS, [batch.column("fp"), sets])

    texts = docs.select("doc_id", "text").join(samples, own).select("fp", F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "fp bigint, shingles binary").groupBy("fp").agg(F.any_value("shingles").alias("shingles"))


def _alike(signatures: np.ndarray, sizes: np.ndarray, one: int, others: np.ndarray, least: float) -> np.ndarray:
    """Those of the places ``others`` whose sets may be ``least`` similar to the one at ``one``."""
    ratio = np.minimum(sizes[others], sizes[one]) / np.maximum(sizes[others], sizes[one])
    others = others[ratio >= least]
    return others[(signatures[others] == signatures[one]).sum(axis=1) >= LEAST_SHARED]


def _gathered(signatures: np.ndarray, sizes: np.ndarray, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Members about leaders: (place, places alike), each member once.

    The leader of many is the member most like what most members have at each place: where many texts are copies of
    one with changes of their own, that is the text they were copied from. Of few it is the first.
    """
    left = np.arange(len(signatures))
    for _ in range(LEADERS):
        if len(left) < 2:
            return
        leader = int(left[0])
        if len(left) >= FEW:
            own = signatures[left]
            usual = np.array([np.bincount(column).argmax() for column in own.T])
            leader = int(left[(own == usual).sum(axis=1).argmax()])
        left = left[left != leader]
        near = _alike(signatures, sizes, leader, left, least)
        yield leader, near
        left = np.setdiff1d(left, near, assume_unique=True)


def _overlaps(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """How many values the ascending set ``one`` shares with each of the other sets, none of them empty."""
    flat, starts = np.concatenate(others), np.cumsum([0, *(len(x) for x in others[:-1])])
    found = one[np.minimum(np.searchsorted(one, flat), len(one) - 1)] == flat
    return np.add.reduceat(found, starts, dtype=np.int64)


def _between(band: int, signatures: np.ndarray, sizes: np.ndarray, groups: np.ndarray, sets: list, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """``_links_between`` of a list of a band: a pair is tried only in the first of the bands that it shares."""

    def first_here(one: int, others: np.ndarray) -> np.ndarray:
        equal = (signatures[others] == signatures[one]).reshape(-1, BANDS, ROWS).all(axis=2)
        return equal[:, band] & (equal.argmax(axis=1) == band)

    return _links_between(first_here, sizes, groups, sets, least)


def _links_between(tried, sizes: np.ndarray, groups: np.ndarray, sets: list, least: float) -> Iterator[tuple[int, np.ndarray]]:
    """Links that connect all groups of a list that its members connect, decided by the sets: (place, places).

    Members of all groups but the largest meet those of the others that ``tried`` (place, places) marks.
    """
    _, own = np.unique(groups, return_inverse=True)
    largest, left, tallies = np.bincount(own).argmax(), np.ones(len(own), bool), None
    for one in np.flatnonzero(own != largest).tolist():
        left[one] = False
        others = np.flatnonzero(left & (own != own[one]))
        others = others[np.minimum(sizes[others], sizes[one]) >= least * np.maximum(sizes[others], sizes[one])]
        others = others[tried(one, others)]
        if len(others):
            tallies = _tallies(sets, sizes) if tallies is None else tallies
            others = others[_may_share(tallies, sizes, one, others, least)]
        if len(others):
            both = _overlaps(sets[one], [sets[k] for k in others])
            others = others[both / (sizes[others] + sizes[one] - both) >= least]
            # One link to a group is enough.
            _, first = np.unique(own[others], return_index=True)
            others = others[first]
            yield one, others
            own[np.isin(own, own[others])] = own[one]


def _tallies(sets: list, sizes: np.ndarray) -> np.ndarray:
    """How many values of each set fall into each of some classes of values, no more than ``TALLIES``."""
    classes = min(TALLIES, 1 << int(sizes.max()).bit_length())
    return np.array([np.bincount((s & np.uint64(classes - 1)).astype(np.int64), minlength=classes) for s in sets], np.int32)


def _may_share(tallies: np.ndarray, sizes: np.ndarray, one: int, others: np.ndarray, least: float) -> np.ndarray:
    """Whether sets can be ``least`` similar: they share no more of a class than the smaller of its two numbers. No such pair is dropped."""
    most = np.minimum(tallies[others], tallies[one]).sum(axis=1)
    return most / (sizes[others] + sizes[one] - most) >= least


def _pairs_of_lists(pairs):
    """Rows sorted by list, the first column, to the pairs of fp that ``pairs`` finds in the other columns of a list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, held = [], [], 0
        current, members = None, []

        def ended() -> None:
            nonlocal held
            if len(members) > 1:
                for one, other in pairs(*zip(*members, strict=True)):
                    a.append(one)
                    b.append(other)
                    held += len(one)

        for batch in slices(batches, 1024):
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != current:
                    ended()
                    current, members = key, []
                    if held >= PAIRS:
                        yield batch_of(_PAIRS, [np.concatenate(a), np.concatenate(b)])
                        a, b, held = [], [], 0
                members.append(row)
        ended()
        if held:
            yield batch_of(_PAIRS, [np.concatenate(a), np.concatenate(b)])

    return run


def _of_members(least: float):
    """``pairs`` of ``_pairs_of_lists`` about leaders, or between components if members have a component, a band and a set."""

    def pairs(fps: tuple, sizes: tuple, signatures: tuple, *more: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fps, sizes = (np.array(x, np.int64) for x in (fps, sizes))
        signs = np.frombuffer(b"".join(signatures), np.uint8).reshape(len(fps), -1)
        if more:
            groups, bands, sets = more
            found = _between(bands[0], signs, sizes, np.array(groups, np.int64), [np.frombuffer(x, "<u8") for x in sets], least)
        else:
            found = _gathered(signs, sizes, least)
        for one, others in found:
            if len(others):
                yield np.minimum(fps[others], fps[one]), np.maximum(fps[others], fps[one])

    return pairs


def _lists(classes: DataFrame) -> DataFrame:
    """(key, fp, band, length): the lists of two members and more; only keys go through the exchanges."""
    keyed = classes.select(F.posexplode("bands").alias("band", "key"), "fp")
    lengths = settle(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("length")).where("length > 1"), "lengths")
    return settle(join_by_weight(keyed, lengths, "key", "length"), "lists")


def _candidates(lists: DataFrame, members: DataFrame, least: float, between: bool) -> DataFrame:
    """Pairs of ``members`` (fp, n, signature) that share a list and may be alike, about leaders; long lists are cut into blocks.

    With ``between`` they are links between components: members also have their ``component`` and ``set``, lists the ``band`` and the
    sum of their ``shingles``, and the sets are compared where the lists lie, so that only links leave a task.
    """
    blocks, columns = F.col("length") / BLOCK_ROWS, ["fp", "n", "signature"]
    if between:
        blocks, columns = F.greatest(blocks, F.col("shingles") / BLOCK_SHINGLES), [*columns, "component", "band", "set"]
    cut = lists.select("key", "fp", *(["band"] if between else []), F.ceil(blocks).cast("int").alias("blocks")).join(members, "fp")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    cut = cut.select(*columns, "key", own.alias("own"), other.alias("other"))
    name = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    dealt = cut.select(name.alias("list"), *columns).repartition("list").sortWithinPartitions("list", "fp")
    return dealt.mapInArrow(_pairs_of_lists(_of_members(least)), "a bigint, b bigint").where("a < b").distinct()


def _parted(lists: DataFrame, members: DataFrame) -> DataFrame:
    """(key, fp, band, length, shingles) of those lists whose ``members`` are in several components."""
    parted = lists.join(members.select("fp", "component", "n"), "fp").groupBy("key")
    several = [F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("rows"), F.sum("n").alias("shingles")]
    parted = settle(parted.agg(*several).where("least <> most").select("key", "rows", "shingles"), "parted")
    return join_by_weight(lists, parted, "key", "rows").drop("rows")


def _near_bits(rows: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of sets whose texts have equal or linked SimHash fingerprints, enough to connect what these connect."""
    prints = settle(rows.select("bits", "fp").distinct(), "prints")
    named = settle(prints.groupBy("bits").agg(F.min("fp").alias("named"), F.count(F.lit(1)).alias("rows")), "named")
    same = join_by_weight(prints, named, "bits", "rows").select(F.col("named").alias("a"), F.col("fp").alias("b"))
    links = fingerprint_links(named.select(F.col("bits").alias("fp")))
    one, other = (named.select(F.col("bits").alias(side), F.col("named").alias(f"_{side}")) for side in ("a", "b"))
    near = links.join(one, "a").join(other, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))
    pairs = same.unionByName(near).where("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _near_members(names: tuple, bits: tuple, fps: tuple, groups: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(list, fp) of the members of a list that have a member of another component within three bits."""
    bits, fps, groups = (np.array(x, np.int64) for x in (bits, fps, groups))
    bits = bits.view(np.uint64)
    near = np.zeros(len(bits), bool)
    for one in range(len(bits)):
        if not near[one]:
            found = np.flatnonzero(_linked(bits[one], bits, MAX_BITS))
            found = found[groups[found] != groups[one]]
            near[found] = True
            near[one] = len(found) > 0
    if near.any():
        yield np.full(near.sum(), names[0]), fps[near]


def _bits_between(least: float):
    """``pairs`` of ``_pairs_of_lists``: links between components of one of operator 10's lists, decided by the sets."""

    def pairs(fps: tuple, sizes: tuple, groups: tuple, bits: tuple, numbers: tuple, sets: tuple) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        fps, sizes, groups, bits = (np.array(x, np.int64) for x in (fps, sizes, groups, bits))
        bits = bits.view(np.uint64)

        def first_here(one: int, others: np.ndarray) -> np.ndarray:
            near = _linked(bits[one], bits[others], MAX_BITS)
            apart = bits[others] ^ bits[one]
            return near & (((apart[:, None] & _CHOSEN) == 0).argmax(axis=1) == numbers[0])

        for one, others in _links_between(first_here, sizes, groups, [np.frombuffer(x, "<u8") for x in sets], least):
            yield np.minimum(fps[others], fps[one]), np.maximum(fps[others], fps[one])

    return pairs


def _near_lists(rows: DataFrame, members: DataFrame) -> DataFrame:
    """(list, number, bits, fp): members of operator 10's lists that are within three bits of one of another component (``members``: fp, component)."""
    prints = settle(rows.select("bits", "fp").distinct().join(members.select("fp", "component"), "fp"), "prints")
    lists = settle(lists_between(prints), "lists")
    dealt = lists.select("list", F.col("list").alias("name"), "bits", "fp", "component").repartition("list").sortWithinPartitions("list", "fp")
    near = dealt.mapInArrow(_pairs_of_lists(_near_members), "a bigint, b bigint").distinct()
    near = settle(lists.join(near.select(F.col("a").alias("list"), F.col("b").alias("fp")), ["list", "fp"], "left_semi"), "near")
    remove(lists)
    return near.drop("component")


def _linked_by_bits(near: DataFrame, members: DataFrame, least: float) -> DataFrame:
    """Links between components of ``near`` lists, ``members`` (fp, n, component, set) with their sets."""
    met = near.join(members, "fp").select("list", "fp", "n", "component", "bits", "number", "set")
    dealt = met.repartition("list").sortWithinPartitions("list", "fp")
    return dealt.mapInArrow(_pairs_of_lists(_bits_between(least)), "a bigint, b bigint").where("a < b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The pairs whose sets are at least ``least`` similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            near = []
            for one, other in zip(batch.column("one"), batch.column("other"), strict=True):
                a, b = (np.frombuffer(x.as_py(), "<u8") for x in (one, other))
                near.append(min(len(a), len(b)) / max(len(a), len(b)) >= least and similarity(a, b) >= least)
            near = pa.array(near, pa.bool_())
            yield batch_of(_PAIRS, [batch.column(c).filter(near) for c in ("a", "b")])

    one = sets.select(F.col("fp").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("fp").alias("b"), F.col("shingles").alias("other"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other").mapInArrow(run, "a bigint, b bigint")


def shingle_classes(docs: DataFrame, least: float = LEAST, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, tag, fp, component, component_id) per row of ``docs``, as ``simhash.simhash_classes`` gives them.

    Texts of equal sets of shingles are one class. Classes are linked if the Jaccard similarity of their sets is
    ``least`` (0.8 or more) at least. SimHash, by ``simhash``'s index and count filter, and bands of MinHash values propose classes, and the
    sets themselves decide, so no link is wrong. A pair is missed only if it is proposed by neither: one of just 0.8 shares no band six times in ten
    million, a closer one more rarely.
    First the members of each list of a band meet leaders among them, and fingerprints the links that connect them; then, in lists of either kind that
    this leaves in different components, all members of different components meet, and their sets come along, so that only links leave the list. Null
    and empty texts are one class; repeated rows are one class, and each has its row; an empty table gives no rows; other columns are not read.
    """
    if not 0.8 <= least <= 1:
        raise ValueError("least must be between 0.8 and 1")
    rows = settle(_set_hashes(docs, shingle_words, least), "shingles")
    same = [F.any_value(c).alias(c) for c in ("n", "bands", "signature")]
    sample = F.min(F.struct("doc_id", "tag")).alias("sample")
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows"), sample, *same), "classes")
    lists = _lists(classes)
    members = classes.where("signature IS NOT NULL").select("fp", "n", "signature")

    def sets_of(named: DataFrame) -> DataFrame:
        samples = classes.join(named, "fp").select("fp", F.col("sample.doc_id").alias("_id"), F.col("sample.tag").alias("_tag"))
        return settle(_sets(docs.select("doc_id", "text"), samples, shingle_words), "sets")

    proposed = settle(_candidates(lists, members, least, False).unionByName(_near_bits(rows)).distinct(), "pairs")
    sets = sets_of(proposed.select(F.explode(F.array("a", "b")).alias("fp")).distinct())
    links = settle(_verified(proposed, sets, least), "links")
    joined = components(links).withColumnRenamed("node", "fp")
    members = members.join(joined, "fp", "left")
    members = settle(members.withColumn("component", F.coalesce("component", "fp")), "members")
    parted = settle(_parted(lists, members), "parted")
    near = _near_lists(rows, members)
    met = sets_of(parted.select("fp").unionByName(near.select("fp")).distinct())
    members = members.join(met.withColumnRenamed("shingles", "set"), "fp")
    links = links.unionByName(settle(_candidates(parted, members, least, True), "links"))
    links = links.unionByName(settle(_linked_by_bits(near, members.select("fp", "n", "component", "set"), least), "links"))
    for table in (lists, proposed, sets, parted, near, met):
        remove(table)
    return components_of(rows.select("doc_id", "tag", "fp"), classes.select("fp", "first", "rows"), links)


def keep_first(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that ``shingle_classes`` makes the first of their group, chosen as by ``simhash.keep_first``."""
    return keep_first_found(docs, settle(shingle_classes(docs, least), "found"))
