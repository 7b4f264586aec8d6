"""A pipeline over documents: toxic ones go, near-duplicates go, sources are mixed, texts become ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkdex.llm import bpe, mixing, shingles, toxicity
from inkdex.llm.common import find_package, remainder
from inkdex.session import new_folder


# Python workers live as long as the pipeline; what a stage has freed goes back to the system instead of being kept for the next one.
WORKERS = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576"}


def _ready(spark: SparkSession) -> None:
    find_package(spark)
    for name, value in WORKERS.items():
        spark.sparkContext.environment.setdefault(name, value)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose score for toxicity is below 1/2.

    The model learns from the labelled documents that ``docs`` holds, except those kept for testing.
    Rows without an id are scored by their text like any others; texts that are null are clean.
    """
    _ready(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(remainder(F.col("doc_id"), 5) != 0)
    model = toxicity.fit(docs, labels.select("doc_id", F.col("toxic").alias("label")))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: the one of the smallest id.

    Documents are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or more. Operator 10's SimHash index proposes
    pairs, MinHash bands those further apart than its three bits, and the sets decide all of them that could connect two groups. A row without an id stays if no row of its group has one; rows that are equal in id and text, and
    rows without ids of one group, stay once.
    """
    _ready(spark)
    return shingles.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Give each document as often as the mix takes its words, rounded, and once if it takes any.

    Documents of which the mix takes nothing go; that is how a source comes down to its target. Documents
    without words are no part of a mix of words and stay.
    """
    _ready(spark)
    return mixing.repeat_taken(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the ids of each text."""
    _ready(spark)
    encoded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encoded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("encoding", encode),
]

# Learned scores and linked groups are not SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = new_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
