"""What several operators share: words, binary columns of Arrow batches, order, and graph components."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkdex.operators.joins import join_by_weight
from inkdex.session import settle

# A word is a run of anything but these six bytes: space, tab, line feed, vertical tab, form feed, return.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def find_package(spark: SparkSession) -> None:
    """Let Python workers on the driver's machine find this package where the driver did.

    On a cluster the package is installed or sent along with the job like any other.
    """
    known, root = spark.sparkContext.environment, str(Path(__file__).parents[2])
    paths = known.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def words_of(text: str | None) -> list[bytes]:
    """Words in UTF-8 with A-Z in lower case; ``bytes`` methods know ASCII only, which is the rule."""
    return text.encode().lower().split() if text else []


def count_words(text: Column) -> Column:
    """Number of words as bigint; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("bigint")


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of an id written as text, modulo ``divisor``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor).cast("bigint"))


def remove(stored: DataFrame) -> None:
    """Remove the folder of a table that ``settle`` wrote, once nothing reads it any more."""
    files = stored.inputFiles()
    if files:
        spark = stored.sparkSession
        folder = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it no column of ``df``, whatever the case of letters."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    arrays = [c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices of few rows, so that little is held in Python at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the undirected edges (a, b): one row (node, component) per node.

    ``component`` is the smallest node that can be reached. Nodes of any type that sorts and hashes;
    nulls and loops are no edges; repeated edges change nothing; no edges give no rows.

    Every round sends each node to the neighbour of the smallest hash (or itself) and goes on with the
    edges between the nodes that are left, a fraction of them whatever the shape, since each round
    hashes anew. Choices are minima, summed up before the exchange, and joins by node take the nodes
    of many edges apart, so a node that a third of all edges meet is no bottleneck.
    """
    spark = edges.sparkSession
    schema = edges.selectExpr("a AS node", "b AS component").schema
    current = settle(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    moves = []
    while not current.isEmpty():
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def rank(node: str) -> Column:
            return F.struct(F.xxhash64(F.lit(len(moves)), node).alias("h"), F.col(node).alias("id"))

        best = F.least(F.min(rank("b")), F.first(rank("a")))["id"]
        move = settle(both.groupBy("a").agg(best.alias("to"), F.count(F.lit(1)).alias("degree")), "move")
        moves.append(move.withColumnRenamed("a", "node"))
        left = join_by_weight(current, move.withColumnRenamed("to", "left"), "a", "degree").select("b", "left")
        right = move.select(F.col("a").alias("b"), F.col("to").alias("right"), "degree")
        both_sides = join_by_weight(settle(left, "left"), right, "b", "degree")
        current = settle(
            both_sides.where("left <> right")
            .select(F.least("left", "right").alias("a"), F.greatest("left", "right").alias("b"))
            .distinct(),
            "edges",
        )
    if not moves:
        return spark.createDataFrame([], schema)
    roots = None
    for move in reversed(moves):
        steps = move.groupBy(F.col("to")).agg(F.count(F.lit(1)).alias("rows"))
        if roots is None:
            keyed = steps.withColumn("root", F.col("to"))
        else:
            keyed = steps.join(roots.withColumnRenamed("node", "to"), "to", "left")
            keyed = keyed.withColumn("root", F.coalesce("root", "to"))
        roots = settle(join_by_weight(move.select("node", "to"), settle(keyed, "roots"), "to", "rows").select("node", "root"), "roots")
    smallest = roots.groupBy("root").agg(F.min("node").alias("component"), F.count(F.lit(1)).alias("rows"))
    return join_by_weight(roots, settle(smallest, "smallest"), "root", "rows").select("node", "component")


def numbered(df: DataFrame, *order: str | Column) -> DataFrame:
    """``df`` with a bigint column ``number``: 0, 1, ... by ``order``, equal rows in any order.

    A sort by range; only one count per partition is collected.
    """
    low = (1 << 33) - 1  # monotonically_increasing_id counts within a partition below this bit
    at = F.monotonically_increasing_id().alias("_at")
    rows = settle(df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", at), "sorted")
    part = F.shiftright("_at", 33).cast("int").alias("_part")
    counts = sorted((r["_part"], r["count"]) for r in rows.groupBy(part).count().collect())
    offsets, total = [], 0
    for number, count in counts:
        offsets.append((number, total))
        total += count
    offsets = F.broadcast(df.sparkSession.createDataFrame(offsets, "_part int, _offset bigint"))
    place = (F.col("_offset") + F.col("_at").bitwiseAND(F.lit(low))).alias("number")
    return rows.withColumn("_part", part).join(offsets, "_part").select(*df.columns, place)
