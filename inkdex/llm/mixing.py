"""Mixing sources to target weights: a low-discrepancy schedule of shuffled blocks of equal length."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, count_words, numbered, unused
from inkdex.operators.joins import join_by_weight
from inkdex.session import settle, settle_sized

# Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
# A source gives at most this many times its words, and so does each of its documents.
MOST_TIMES = 3
# Words of a block; sources below LEAST_BLOCKS such blocks have shorter ones.
BLOCK_WORDS = 1024
LEAST_BLOCKS = 64
SEED = 7

# Multiples of 2**64 / golden ratio, modulo 2**64, over 2**64 are the golden-ratio points.
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
# Pieces of [0, 1) by which points meet the intervals of the sources.
_CELLS = 1 << 14
# Slots, sources, and documents of a source that are put in order in one group.
_GROUP, _DOCUMENTS = 20_000, 2_000


@dataclass(frozen=True)
class Mix:
    """``documents``: one row per document. ``schedule``: one row (slot, source_no, turn, block) per slot."""

    documents: DataFrame
    schedule: DataFrame
    sources: DataFrame


def text_tag(seed: int = SEED) -> Column:
    """Hash that shuffles documents and, with doc_id, tells rows of one id apart."""
    return F.xxhash64(F.lit(seed), F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """Add ``weight`` and ``target`` (words) to sources (source, source_size), with their ``source_no``.

    Sources take the weights in the order of their code points, null last. Targets share the words of
    all sources by weight; one stops at ``most_times`` times its source's words, and what it leaves
    is shared among the others in the same way, until none is above.
    """
    ranked = numbered(sources, F.col("source").asc_nulls_last()).withColumnRenamed("number", "source_no")
    step = F.pmod("source_no", F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*map(F.lit, weights)), step + 1).cast("bigint")
    ranked = settle(ranked.withColumn("weight", weight), "sources")
    full = F.col("source_size") * most_times
    totals = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, free = totals["words"] or 0, totals["weight"] or 0
    level = words / free if free else 0.0
    while True:
        above = F.col("weight") * F.lit(level) >= full
        rest = ranked.agg(
            F.sum(F.when(above, full).otherwise(0)).alias("full"), F.sum(F.when(above, 0).otherwise(F.col("weight"))).alias("free")
        ).first()
        if not rest["free"] or rest["free"] == free:
            break
        free, level = rest["free"], (words - rest["full"]) / rest["free"]
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level), full.cast("double")))


_POINTS = pa.schema([("slot", pa.int64()), ("point", pa.float64()), ("cell", pa.int32())])


def _points(spark, slots: int) -> DataFrame:
    """Golden-ratio points of the slots 0 ... slots - 1, to 53 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column(0).to_numpy()
            point = (((slot.astype(np.uint64) + np.uint64(1)) * _GOLDEN) >> np.uint64(11)) / float(1 << 53)
            yield batch_of(_POINTS, [slot, point, (point * _CELLS).astype(np.int32)])

    return spark.range(slots).mapInArrow(run, "slot bigint, point double, cell int")


def slot_schedule(sources: DataFrame) -> DataFrame:
    """(slot, source_no, turn, block) for sources (source_no, blocks, quota) numbered from 0.

    Slot i goes to the source whose part of [0, 1), as long as its share of all quotas, holds the
    i-th point. ``turn`` ranks the slots of a source; the turn's block is the turn modulo ``blocks``.
    Slots after the quota of their source are left out, and there are as many slots as it takes for
    every source to get its quota.
    """
    spark = sources.sparkSession
    asked = settle(sources.where("quota > 0").select("source_no", "blocks", "quota"), "quotas")
    total = asked.agg(F.sum("quota")).first()[0]
    if total is None:
        return spark.createDataFrame([], "slot bigint, source_no bigint, turn bigint, block bigint")
    # Running sums over sources in two steps, so that no group holds them all.
    group = F.expr(f"source_no div {_GROUP}").alias("part")
    before = asked.groupBy(group).agg(F.sum("quota").alias("part_quota"))
    before = before.withColumn("base", F.sum("part_quota").over(Window.orderBy("part")) - F.col("part_quota"))
    inside = F.sum("quota").over(Window.partitionBy("part").orderBy("source_no"))
    ends = asked.select("*", group).withColumn("end", inside).join(before, "part")
    ends = ends.withColumn("high", (F.col("base") + F.col("end")) / F.lit(float(total)))
    ends = ends.withColumn("low", (F.col("base") + F.col("end") - F.col("quota")) / F.lit(float(total)))
    low_cell = F.floor(F.col("low") * _CELLS).cast("int")
    high_cell = F.least(F.floor(F.col("high") * _CELLS).cast("int"), F.lit(_CELLS - 1))
    intervals = ends.select("source_no", "blocks", "quota", "low", "high", F.explode(F.sequence(low_cell, high_cell)).alias("cell"))
    intervals = settle(intervals, "intervals")

    def dealt(slots: int) -> DataFrame:
        inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
        return _points(spark, slots).join(intervals, "cell").where(inside).select("slot", "source_no", "blocks", "quota")

    slots = total
    while True:
        schedule = settle(dealt(slots), "slots")
        counts = schedule.groupBy("source_no").agg(F.count(F.lit(1)).alias("n"))
        missing = F.col("quota") - F.coalesce("n", F.lit(0))
        more = F.ceil((missing + 1) / F.col("quota") * F.lit(float(total)))
        extra = asked.join(counts, "source_no", "left").where(missing > 0).agg(F.max(more)).first()[0]
        if extra is None:
            break
        slots += int(extra)
    # The rank of a slot: those of its source in earlier stretches of slots, and those before it in its own.
    stretch = F.expr(f"slot div {_GROUP}").alias("stretch")
    schedule = schedule.select("*", stretch)
    earlier = schedule.groupBy("source_no", "stretch").agg(F.count(F.lit(1)).alias("n"))
    earlier = earlier.withColumn("first", F.sum("n").over(Window.partitionBy("source_no").orderBy("stretch")) - F.col("n"))
    rank = F.row_number().over(Window.partitionBy("source_no", "stretch").orderBy("slot")) - 1
    turns = schedule.withColumn("rank", rank).join(earlier.drop("n"), ["source_no", "stretch"])
    turns = turns.withColumn("turn", F.col("first") + F.col("rank")).where("turn < quota")
    return turns.select("slot", "source_no", "turn", F.pmod("turn", "blocks").alias("block"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most_times: int = MOST_TIMES,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> Mix:
    """Mix all rows of ``docs`` (doc_id, source, text) so that sources meet their targets.

    The documents of a source stand in one line, shuffled by a hash, and the line is cut into blocks
    of ``block_words`` words (shorter for small sources, and at the end). The schedule's turns take
    the blocks in this order, over again if need be. ``Mix.documents`` has doc_id, tag, source, size,
    source_size, target and ``taken``, the words of the document that lie in blocks, as often as
    those are taken; no word is taken more than ``most_times`` times.

    Null texts have no words; null is a source; documents and sources without words take nothing;
    repeated rows are documents of their own; empty tables give none. Reruns agree, because only
    ids, texts and names decide.
    """
    word_count = count_words(F.col("text").cast("string")).alias("size")
    name = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("key")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_tag(seed).alias("tag"), name, word_count)
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    totals = rows.groupBy("key").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    source = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias("source")
    sources = source_targets(totals.select("*", source), weights, most_times)

    # A small source has LEAST_BLOCKS blocks or, below that many words, one block per word.
    words = F.greatest(F.least(F.lit(block_words), F.expr(f"source_size div {LEAST_BLOCKS}")), F.lit(1)).cast("bigint")
    sources = sources.withColumn("block_words", words)
    sources = sources.withColumn("blocks", F.ceil(F.col("source_size") / F.col("block_words")).cast("bigint"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = F.round((F.col("target") - rounds * F.col("source_size")) / F.col("block_words")).cast("bigint")
    quota = F.least(rounds * F.col("blocks") + rest, F.col("blocks") * most_times)
    sources = settle(sources.withColumn("quota", quota), "sources")
    schedule = settle(slot_schedule(sources), "schedule")

    # Where each document begins in its source's line: by groups of the hash, then within a group.
    about = sources.select("key", "source", "rows", "source_no", "source_size", "target", "block_words")
    placed = join_by_weight(rows, about, "key", "rows").drop("key")
    groups = F.expr(f"rows div {_DOCUMENTS}") + 1
    bucket = F.floor((F.shiftrightunsigned("tag", 11) / F.lit(float(1 << 53))) * groups).cast("bigint")
    placed = settle(placed.withColumn("bucket", bucket), "placed")
    sums = placed.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("base", F.sum("words").over(Window.partitionBy("source_no").orderBy("bucket")) - F.col("words"))
    running = F.sum("size").over(
        Window.partitionBy("source_no", "bucket").orderBy("tag", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, 0)
    )
    line = placed.withColumn("running", running).join(sums.drop("words"), ["source_no", "bucket"])
    line = line.withColumn("start", F.col("base") + F.col("running") - F.col("size"))
    line = line.withColumn("stop", F.col("start") + F.col("size"))
    spans = F.sequence(F.expr("start div block_words"), F.expr("(stop - 1) div block_words"))
    pieces = line.where("size > 0").select("row", "source_no", "start", "stop", "block_words", F.explode(spans).alias("block"))
    low, high = F.col("block") * F.col("block_words"), (F.col("block") + 1) * F.col("block_words")
    held = (F.least("stop", high) - F.greatest("start", low)).alias("held")
    times = schedule.groupBy("source_no", "block").agg(F.count(F.lit(1)).alias("times"))
    taken = pieces.select("row", "source_no", "block", held).join(times, ["source_no", "block"])
    taken = taken.groupBy("row").agg(F.sum(F.col("held") * F.col("times")).alias("taken"))
    result = placed.join(taken, "row", "left").withColumn("taken", F.coalesce("taken", F.lit(0)).cast("bigint"))
    columns = ["doc_id", "tag", "source", "size", "source_size", "target", "taken"]
    return Mix(result.select(*columns), schedule, sources)


def repeat_taken(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, with all their columns, each as often as the mix takes its words.

    The number is rounded, but is one at least where a word is taken; rows of which none is taken go,
    rows without words stay once. Rows equal in id and text share what is taken of them evenly.
    """
    mixed = mix(docs, **settings).documents.groupBy("doc_id", "tag")
    mixed = mixed.agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    times = F.when(F.col("size") == 0, 1).when(F.col("taken") == 0, 0)
    times = times.otherwise(F.greatest(F.round(F.col("taken") / F.greatest("size", F.lit(1))), F.lit(1))).cast("int")
    own_id, own_tag, number, copy = unused(docs, "_id", "_tag", "_times", "_copy")
    mixed = mixed.select(F.col("doc_id").alias(own_id), F.col("tag").alias(own_tag), times.alias(number))
    mixed, small = settle_sized(mixed, "times")
    own = docs["doc_id"].cast("bigint").eqNullSafe(F.col(own_id)) & (text_tag(settings.get("seed", SEED)) == F.col(own_tag))
    joined = docs.join(F.broadcast(mixed) if small else mixed, own).where(F.col(number) > 0)
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), number))).select(*(F.col(f"`{c}`") for c in docs.columns))
