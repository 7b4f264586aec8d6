"""Titles for results: dictionary, then the header of the text, then a fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.functions.headers import HEAD_CHARACTERS, head, title_from_head, untitled
from inkdex.functions.text import score_text
from inkdex.operators.parts import has_parts, part_heads
from inkdex.session import settle, settle_sized
from inkdex.sources.store import DocumentStore


def heads(docs: DataFrame, characters: int = HEAD_CHARACTERS) -> DataFrame:
    """``(doc_id, head)``: the first ``characters`` of each document, over its rows if there is a column ``part``."""
    if has_parts(docs):
        return part_heads(docs, characters)
    return docs.select("doc_id", head(F.col("text"), characters).alias("head"))


def extract_titles(docs: DataFrame, characters: int = HEAD_CHARACTERS) -> DataFrame:
    """``(doc_id, title)`` from the header of each document, null where there is none."""
    return heads(docs, characters).select("doc_id", title_from_head(F.col("head")).alias("title"))


def lookup_titles(results: DataFrame, titles: DataFrame) -> DataFrame:
    """Results with the dictionary title, null where there is none."""
    named = titles.select(F.col("doc_id").alias("title_id"), "title")
    return results.join(named, F.col("doc_id").cast("string") == F.col("title_id"), "left").drop("title_id")


def found_titles(results: DataFrame, titles: DataFrame, docs: DataFrame | DocumentStore) -> DataFrame:
    """``(doc_id, title)`` read from the texts of those results that the dictionary does not name.

    Of a ``DocumentStore`` only the heads of those results are read, and no text, unless documents have several rows.
    """
    missing = lookup_titles(results.select("doc_id").distinct(), titles).where("title is null").select("doc_id")
    if isinstance(docs, DocumentStore):
        found = part_heads(docs.fetch(missing), HEAD_CHARACTERS) if has_parts(docs.rows) else docs.heads(missing)
    else:
        missing, small = settle_sized(missing, "untitled")
        # An inner join keeps the cut below itself: only heads are exchanged, if anything is.
        found = heads(docs).join(F.broadcast(missing) if small else missing, "doc_id")
    found = found.select("doc_id", title_from_head(F.col("head")).alias("title"))
    # Stored before it is filtered, so that the extraction does not run once more in the filter.
    return settle(found, "titles").where("title is not null")


def resolve_titles(results: DataFrame, titles: DataFrame, docs: DataFrame | DocumentStore) -> DataFrame:
    """Results with a ``title`` for every row."""
    results = settle(results, "results")  # read twice below
    found = found_titles(results, titles, docs)
    named = lookup_titles(results, titles)
    both = named.join(found.withColumnRenamed("title", "found"), "doc_id", "left")
    return both.withColumn("title", F.coalesce("title", "found", untitled(F.col("doc_id")))).drop("found")


def remember_titles(titles: DataFrame, found: DataFrame) -> DataFrame:
    """The dictionary with newly found titles; entries it already has stay as they are."""
    new = found.select(F.col("doc_id").cast("string").alias("doc_id"), "title")
    return titles.select("doc_id", "title").unionByName(new.join(titles, "doc_id", "left_anti"))


def as_displayed(results: DataFrame) -> DataFrame:
    """``(title, doc_id, score, score_text)``."""
    return results.select("title", "doc_id", "score", score_text(F.col("score")).alias("score_text"))
