"""Documents stored by id, so that one is read without the others."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkdex.functions.headers import HEAD_CHARACTERS, head
from inkdex.session import settle_sized

STORE, STORE_LAYOUT = "documents", "documents_layout"

# Stored parts are read often and take most of the disk: a fifth to a third less of it than by default.
CODEC = "compression", "zstd"

# Size of the store's parts, in bytes of text. A shard is a directory that a fetch can skip, a group is a set of
# ids that is kept together in one file where it fits.
SHARD_BYTES = 2 << 30
GROUP_BYTES = 128 << 20
MAX_SHARDS = 4096

# Ids of a list up to which each is a filter of its own (Spark gives Parquet only the range of a longer IN); more become a table.
PUSHED_IDS = 200


def is_blank(text: Column) -> Column:
    """Whether a text holds nothing but blanks and control characters."""
    return ~text.rlike(r"[^\x00-\x20]")


def shard_of_id(doc_id: Column, shards: int) -> Column:
    """Directory number of a document in the store."""
    return F.pmod(F.xxhash64(doc_id), F.lit(shards)).cast("int")


@dataclass(frozen=True)
class DocumentStore:
    """Rows ``(doc_id, head, is_blank, text, shard)``, and ``part`` if documents have several rows, stored in ``shards`` directories.

    What a fetch returns has a row per row of the document, in no order. Ids that the store does not hold, and null,
    bring nothing; an id asked for twice brings its rows once.
    """

    rows: DataFrame
    shards: int

    def fetch(self, ids: list | DataFrame) -> DataFrame:
        """``(doc_id, text, is_blank)``, and ``part`` if there is one, of the given ids."""
        return self._of(ids, [*self._part(), "text", "is_blank"])

    def heads(self, ids: list | DataFrame) -> DataFrame:
        """``(doc_id, head)`` of the given ids; no text is read. Of documents of several rows it is each row's beginning, with ``part``."""
        return self._of(ids, [*self._part(), "head"])

    def _part(self) -> list[str]:
        return ["part"] if "part" in self.rows.columns else []

    def _of(self, ids: list | DataFrame, columns: list[str]) -> DataFrame:
        """Rows of other directories are not read, row groups without the ids are skipped by their ranges and Bloom filters.

        A DataFrame ``(doc_id)`` of up to 64 MB is broadcast, so that no text is exchanged; more ids are exchanged with the texts.
        """
        rows = self.rows.select("doc_id", *columns, "shard")
        if isinstance(ids, DataFrame):
            # Stored before its shards are listed: there are MAX_SHARDS of them at most.
            ids, small = settle_sized(ids.select("doc_id").where("doc_id IS NOT NULL").distinct(), "ids")
            used = ids.select(shard_of_id(self._own(F.col("doc_id")), self.shards).alias("shard")).distinct().collect()
            near = rows.where(F.col("shard").isin([row.shard for row in used]))
            return near.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi").drop("shard")
        ids = list(dict.fromkeys(one for one in ids if one is not None))
        if not ids:
            return rows.where(F.lit(False)).drop("shard")
        if len(ids) > PUSHED_IDS:
            kind = self.rows.select("doc_id").schema
            return self._of(rows.sparkSession.createDataFrame([(one,) for one in ids], kind), columns)
        # Literals are hashed by the same expression as the stored ids.
        shards = rows.sparkSession.range(1).select(*(shard_of_id(self._own(F.lit(one)), self.shards) for one in ids)).first()
        near = rows.where(F.col("shard").isin(sorted(set(shards))))
        return near.where(_either([F.col("doc_id") == F.lit(one) for one in ids])).drop("shard")

    def _own(self, doc_id: Column) -> Column:
        """An id as the type that the store holds, since equal numbers of two types have two hashes."""
        return doc_id.cast(self.rows.schema["doc_id"].dataType)


def _either(conditions: list[Column]) -> Column:
    """One condition, nested no deeper than it must be."""
    while len(conditions) > 2:
        conditions = [reduce(or_, conditions[at : at + 2]) for at in range(0, len(conditions), 2)]
    return reduce(or_, conditions)


def build_store(docs: DataFrame, out: str, shards: int | None = None) -> None:
    """Store ``docs`` (doc_id, text, and ``part`` if a row is a part of a document) below ``out``, laid out for fetches by id.

    The texts are measured first, unless ``shards`` tells the number of directories, and exchanged once, by shard and group
    of ids; adaptive execution splits the groups that a document of very many rows makes large. Within a file
    they are sorted by id. Files carry Bloom filters of the ids, and the head is a column of its own. Every row is kept,
    those without an id or a text too; other columns are left out.
    """
    spark = docs.sparkSession
    part = ["part"] if "part" in docs.columns else []
    groups = 1
    if shards is None:
        n_bytes = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
        shards = min(MAX_SHARDS, n_bytes // SHARD_BYTES + 1)
        groups = n_bytes // shards // GROUP_BYTES + 1
    texts = docs.select("doc_id", *part, head(F.col("text"), HEAD_CHARACTERS).alias("head"), is_blank(F.col("text")).alias("is_blank"), "text")
    # Numbers of shard and group must not be cut from the same bits.
    group = F.pmod(F.hash("doc_id"), F.lit(groups))
    placed = texts.withColumn("shard", shard_of_id(F.col("doc_id"), shards)).withColumn("group", group)
    laid_out = placed.hint("rebalance", "shard", "group").drop("group").sortWithinPartitions("shard", "doc_id", *part)
    writer = laid_out.write.option(*CODEC).option("parquet.bloom.filter.enabled#doc_id", "true").partitionBy("shard")
    writer.mode("overwrite").parquet(f"{out}/{STORE}")
    spark.range(1).select(F.lit(shards).alias("shards")).coalesce(1).write.mode("overwrite").parquet(f"{out}/{STORE_LAYOUT}")


def load_store(spark: SparkSession, out: str) -> DocumentStore:
    """The documents stored below ``out``."""
    shards = spark.read.parquet(f"{out}/{STORE_LAYOUT}").first().shards
    return DocumentStore(spark.read.parquet(f"{out}/{STORE}"), shards)
