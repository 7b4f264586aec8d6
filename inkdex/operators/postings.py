"""The index as search sees it: posting rows, and one row per term."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkdex.operators.bitmaps import Numbering
from inkdex.operators.index import document_frequencies


def shard_of(term: Column, shards: int) -> Column:
    """Directory number of a term in the stored index."""
    return F.pmod(F.xxhash64(term), F.lit(shards)).cast("int")


@dataclass(frozen=True)
class Index:
    """Postings ``(term, doc_id, tfidf, ...)`` and vocabulary ``(term, df)``.

    With ``shards`` the postings are stored in that many directories by hash of the term. ``positions`` are the
    positional postings ``(term, doc_id, block, at)``, if there are any, stored in ``position_shards``, and ``bounds``
    the greatest weights ``(term, block, most, n)`` in blocks of documents, dealt by ``spread``. ``bitmaps`` are the documents
    of frequent terms ``(term, bucket, bitmap)``, by their ``numbering``, stored in ``bitmap_shards``.
    """

    postings: DataFrame
    vocabulary: DataFrame
    shards: int | None = None
    positions: DataFrame | None = None
    position_shards: int | None = None
    bounds: DataFrame | None = None
    spread: int | None = None
    bitmaps: DataFrame | None = None
    bitmap_shards: int | None = None
    numbering: Numbering | None = None

    @staticmethod
    def of(index: Index | DataFrame) -> Index:
        """An index from bare posting rows; the vocabulary is counted from them."""
        return index if isinstance(index, Index) else Index(index, document_frequencies(index))

    def frequencies(self, terms: list[str]) -> dict[str, int]:
        """Document frequency of those of a query's own terms that the index holds."""
        rows = self.vocabulary.where(F.col("term").isin(terms)).select("term", "df").collect()
        return {row.term: row.df for row in rows}

    def postings_of(self, terms: list[str]) -> DataFrame:
        """Postings of literal terms: other directories are not listed, other row groups not read."""
        return _of_terms(self.postings, self.shards, terms)

    def positions_of(self, terms: list[str]) -> DataFrame:
        """Positional postings of literal terms."""
        return _of_terms(self.positions, self.position_shards, terms)

    def bitmaps_of(self, terms: list[str]) -> DataFrame:
        """Bitmaps of literal terms."""
        return _of_terms(self.bitmaps, self.bitmap_shards, terms)

    def postings_near(self, terms: DataFrame, few_terms: bool) -> DataFrame:
        """At least the postings of the terms of a stored table."""
        return _near_terms(self.postings, self.shards, terms, few_terms)

    def positions_near(self, terms: DataFrame, few_terms: bool) -> DataFrame:
        """At least the positional postings of the terms of a stored table."""
        return _near_terms(self.positions, self.position_shards, terms, few_terms)


def _of_terms(rows: DataFrame, shards: int | None, terms: list[str]) -> DataFrame:
    found = rows.where(F.col("term").isin(terms))
    if shards:
        found = found.where(F.col("shard").isin([shard_of(F.lit(t), shards) for t in terms]))
    return found


def _near_terms(rows: DataFrame, shards: int | None, terms: DataFrame, few_terms: bool) -> DataFrame:
    """Rows of other directories and other hashes of terms are left out.

    Only the directories of these terms are listed, there are ``shards`` of them at most. If the
    terms fit a broadcast, the rows of others are dropped as they are read, by hash: a join by a
    number is several times as fast as one by a text, and few rows are left for the latter.
    """
    if shards and shards > 1:
        used = terms.select(shard_of(F.col("term"), shards).alias("shard")).distinct().collect()
        rows = rows.where(F.col("shard").isin([row.shard for row in used]))
    if few_terms:
        hashes = F.broadcast(terms.select(F.xxhash64("term").alias("term_hash")).distinct())
        rows = rows.join(hashes, F.xxhash64("term") == F.col("term_hash"), "left_semi")
    return rows
