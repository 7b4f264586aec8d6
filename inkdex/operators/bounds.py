"""Best results first: upper bounds of scores by block of documents, so that most postings need not be joined.

A term frequency is a share of the document, so documents of like length have like scores. They are dealt to blocks by
length, eight classes to a doubling, and within a class by hash. Of each frequent term the greatest weight in each block is
kept: no document of a block scores more than the sum of these. Blocks are small, since one unusual document lifts the
bound of its whole block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CLASSES_PER_DOUBLING = 8

# Documents that a block is meant to hold, and the classes that hold most documents.
BLOCK_DOCUMENTS, USUAL_CLASSES = 32, 32

# Document frequency from which a term has bounds; the postings of rarer ones are few.
FREQUENT = 1024

# The first blocks that are searched have room for so many times the results asked for, the next for so many times more.
ROOM, MORE = 4, 8

# A bound is a sum in another order than the score's.
SLACK = 1 + 1e-9


def spread_for(n_docs: int) -> int:
    """Blocks of a class of documents."""
    return n_docs // (BLOCK_DOCUMENTS * USUAL_CLASSES) + 1


def document_block(doc_len: Column, doc_id: Column, spread: int) -> Column:
    length = F.floor(F.log2(doc_len.cast("double")) * CLASSES_PER_DOUBLING)
    return (length * spread + F.pmod(F.xxhash64(doc_id), F.lit(spread))).cast("bigint")


def posting_bounds(postings: DataFrame, spread: int, frequent: int = FREQUENT) -> DataFrame:
    """``(term, block, most, n, spread)``: greatest weight and number of the postings of each frequent term in a block."""
    blocks = document_block(F.col("doc_len"), F.col("doc_id"), spread).alias("block")
    summed = postings.where(F.col("df") >= frequent).groupBy("term", blocks)
    return summed.agg(F.max("tfidf").alias("most"), F.count(F.lit(1)).alias("n")).withColumn("spread", F.lit(spread))


def query_blocks(bounds: DataFrame, known: DataFrame) -> DataFrame:
    """``(query_id, block, bound, room)``: blocks that hold all known terms ``(query_id, term, weight, n_known)`` of a query.

    ``room`` is how many documents of the block can be results at most.
    """
    rows = bounds.join(known, "term")
    met = rows.groupBy("query_id", "n_known", "block").agg(
        F.count(F.lit(1)).alias("n_terms"), (F.sum(F.col("most") * F.col("weight")) * SLACK).alias("bound"), F.min("n").alias("room")
    )
    return met.where("n_terms = n_known").select("query_id", "block", "bound", "room")


def promising(blocks: DataFrame, room: int) -> DataFrame:
    """``blocks`` with ``first``: whether a block is among those of the greatest bounds of its query that have ``room`` together.

    That takes ``room`` blocks at most, so up to a thousand Spark ranks no more than these of a partition.
    """
    order = Window.partitionBy("query_id").orderBy(F.desc("bound"), "block")
    ranked = blocks.withColumn("place", F.row_number().over(order)).where(F.col("place") <= room)
    earlier = Window.partitionBy("query_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    chosen = ranked.withColumn("before", F.coalesce(F.sum("room").over(earlier), F.lit(0))).where(F.col("before") < room)
    told = chosen.select("query_id", "block", F.lit(True).alias("first"))
    return blocks.join(told, ["query_id", "block"], "left").withColumn("first", F.coalesce("first", F.lit(False)))


def still_open(blocks: DataFrame, best: DataFrame, top: int) -> DataFrame:
    """Blocks not searched yet that can still change the ``best`` results (query_id, score, rank) found so far."""
    least = best.where(F.col("rank") == top).select("query_id", F.col("score").alias("least"))
    rest = blocks.where("NOT first").join(least, "query_id", "left")
    return rest.where("least IS NULL OR bound >= least").select("query_id", "block", "bound", "room")
