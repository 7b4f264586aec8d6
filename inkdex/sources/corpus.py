"""Documents from text files or tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkdex.functions.text import DOCUMENT_SUFFIX, doc_id_from_file_name, file_name
from inkdex.session import settle_sized
from inkdex.sources.store import DocumentStore, is_blank

# Named corpus sizes, in documents.
PRESETS = {"small": 100, "half": 4000, "all": None}


def read_table(spark: SparkSession, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` from a parquet table with one row per document."""
    return spark.read.parquet(path).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def read_lines(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``(doc_id, text, part)`` with one row per line; large files are split among tasks.

    A document has many rows here, in the order of ``part``: index it with ``whole=False``. Phrases,
    offsets and headers go over line breaks, so those operators take ``join_lines`` of it.
    """
    return _read(spark, path, limit, whole=False)


def join_lines(rows: DataFrame, part: str = "part") -> DataFrame:
    """``(doc_id, text)`` with one row per document: its rows in the order of ``part``, joined by line breaks.

    A document must fit a row then; null texts are left out.
    """
    lines = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct(part, "text"))).alias("lines"))
    texts = F.filter(F.col("lines")["text"], lambda t: t.isNotNull())
    return lines.select("doc_id", F.array_join(texts, "\n").alias("text"))


def read_whole(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """``(doc_id, text)`` with one row per file."""
    return _read(spark, path, limit, whole=True)


def _read(spark: SparkSession, path: str, limit: int | None, whole: bool) -> DataFrame:
    paths = path if limit is None else _first_paths(spark, path, limit)
    lines = spark.read.text(paths, wholetext=whole)
    name = file_name(F.col("_metadata.file_name"))
    columns = [doc_id_from_file_name(name).alias("doc_id"), F.col("value").alias("text")]
    if not whole:
        at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
        columns.append(at.alias("part"))
    return lines.select(*columns)


def _first_paths(spark: SparkSession, path: str, limit: int) -> list[str]:
    """Paths of the first ``limit`` documents by name, so that no other file is opened."""
    names = corpus_manifest(spark, path).where(F.col("name").endswith(DOCUMENT_SUFFIX))
    first = names.orderBy("name", "path").limit(limit).select("path").collect()
    if not first:
        raise ValueError(f"no {DOCUMENT_SUFFIX} files in {path}")
    return [row.path for row in first]


def corpus_manifest(spark: SparkSession, path: str) -> DataFrame:
    """``(type, name, path, length, modified)`` of every non-empty file, without opening any.

    Spark's file sources leave out files of zero length.
    """
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.lit("FILE").alias("type"),
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("path"),
        F.col("length"),
        F.col("modificationTime").alias("modified"),
    )


def first_documents(docs: DataFrame, limit: int | None) -> DataFrame:
    """All rows of the first ``limit`` documents of a table, by id as text."""
    if limit is None:
        return docs
    ids = docs.select("doc_id").distinct()
    first = ids.orderBy(F.col("doc_id").cast("string")).limit(limit)
    return docs.join(first, "doc_id", "left_semi")


def count_documents(docs: DataFrame) -> DataFrame:
    """One row ``n_docs``: documents in the corpus, including those without any token."""
    return docs.agg(F.count_distinct("doc_id").alias("n_docs"))


def fetch_documents(docs: DataFrame | DocumentStore, ids: list | DataFrame) -> DataFrame:
    """Whole texts of the given ids, with a mark for those that hold nothing but blanks.

    A list of ids is pushed into the scan; a DataFrame ``(doc_id)`` is joined. Of a table all ids are read; a
    ``DocumentStore`` reads only the directories of those asked for.
    """
    if isinstance(docs, DocumentStore):
        return docs.fetch(ids)
    if isinstance(ids, DataFrame):
        # Few ids are broadcast, so that no text is exchanged.
        ids, small = settle_sized(ids.select("doc_id").distinct(), "ids")
        wanted = docs.join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")
    else:
        wanted = docs.where(F.col("doc_id").isin(ids))
    return wanted.withColumn("is_blank", is_blank(F.col("text")))
