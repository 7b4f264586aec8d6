"""Build, store and load an index."""

from __future__ import annotations

from dataclasses import dataclass, replace
from time import perf_counter
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from inkdex.functions.weights import inverse_document_frequency, term_frequency
from inkdex.operators.bitmaps import Numbering, term_bitmaps
from inkdex.operators.bounds import posting_bounds, spread_for
from inkdex.operators.index import normalize_tf, spread, term_frequencies, tfidf_index, vocabulary
from inkdex.operators.parts import has_parts
from inkdex.operators.positions import term_positions
from inkdex.operators.postings import Index, shard_of
from inkdex.session import freeing, settle
from inkdex.sources.corpus import count_documents
from inkdex.sources.stage_text import postings_of_text
from inkdex.sources.store import CODEC, build_store

# Stages and the folder each one writes.
STAGES = ["all", "job1", "job2", "job3"]
TOKENS, TF, POSTINGS, POSITIONS, BOUNDS, BITMAPS = "tokens", "index", "tfidf", "positions", "bounds", "bitmaps"
VOCABULARY, LAYOUT, RUNS = "vocabulary", "layout", "runs"
SNAPSHOTS, PUBLISHED = "snapshots", "published"
PUBLISHED_SCHEMA = "number bigint, snapshot string"
# Directories without any file have no schema of their own.
BITMAPS_SCHEMA = "term string, bucket bigint, bitmap binary, span bigint, base bigint, least_df bigint, shard int"
RUNS_SCHEMA = "stage string, records_in bigint, records_out bigint, seconds double"

# Size of the stored index's parts, in postings. A shard is a directory that a query can skip, a
# group is a set of terms that is kept together in one file where it fits.
SHARD_POSTINGS = 16_000_000
GROUP_POSTINGS = 4_000_000
MAX_SHARDS = 4096


@dataclass(frozen=True)
class StageRun:
    """What one stage read and wrote."""

    stage: str
    records_in: int
    records_out: int
    seconds: float


def build_index(
    source: DataFrame, out: str, stage: str = "all", n_docs: int | None = None, whole: bool = True
) -> list[StageRun]:
    """Run one stage or all of them; each replaces its own folder below ``out``.

    ``source`` is the corpus for ``all`` and ``job1``, the token counts for ``job2``, and the
    normalised frequencies for ``job3``, where ``n_docs`` has to be given. For ``all`` the documents
    are counted if ``n_docs`` is not given. ``whole`` tells whether a corpus row is a whole document,
    see ``term_frequencies``; if the count shows that documents have several rows, this is an error.
    """
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}, not {stage!r}")
    spark = source.sparkSession
    runs = []
    rows = source
    if stage in ("all", "job1"):
        runs.append(_write_tokens(rows, f"{out}/{TOKENS}", whole))
        counted = count_documents(source).first().n_docs if whole or n_docs is None else None
        if whole and counted != runs[-1].records_in:
            raise ValueError("documents have several rows, or no id: build with whole=False")
        n_docs = counted if n_docs is None else n_docs
        rows = spark.read.parquet(f"{out}/{TOKENS}")
    if stage in ("all", "job2"):
        runs.append(_write_tf(rows, f"{out}/{TF}"))
        rows = spark.read.parquet(f"{out}/{TF}")
    if stage in ("all", "job3"):
        if not n_docs:
            raise ValueError("the number of documents must be given, and must not be zero")
        runs.append(_write_postings(rows, out, n_docs, stage == "all"))
    told = spark.createDataFrame([(r.stage, r.records_in, r.records_out, r.seconds) for r in runs], RUNS_SCHEMA)
    told.coalesce(1).write.mode("overwrite").parquet(f"{out}/{RUNS}")
    return runs


def _observed(rows: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _write_tokens(docs: DataFrame, path: str, whole: bool) -> StageRun:
    start = perf_counter()
    docs, read = _observed(docs)
    counts, written = _observed(term_frequencies(docs, whole))
    with freeing(docs.sparkSession):
        counts.write.mode("overwrite").option(*CODEC).parquet(path)
    return StageRun("job1", read.get["rows"], written.get["rows"], perf_counter() - start)


def _write_tf(counts: DataFrame, path: str) -> StageRun:
    start = perf_counter()
    counts, read = _observed(counts)
    tf, written = _observed(normalize_tf(counts))
    tf.write.mode("overwrite").option(*CODEC).parquet(path)
    return StageRun("job2", read.get["rows"], written.get["rows"], perf_counter() - start)


def _write_postings(tf: DataFrame, out: str, n_docs: int, own: bool = False) -> StageRun:
    """Vocabulary first, then the postings, laid out for lookups by term. ``own`` rows are as ``normalize_tf`` gave them.

    The postings are exchanged once, by shard and group of terms; adaptive execution splits the groups
    that a very common term makes large. Within a file they are sorted, so that the row groups
    of other terms are skipped.
    """
    start = perf_counter()
    spark = tf.sparkSession
    _write_vocabulary(tf, n_docs, out)
    terms = spark.read.parquet(f"{out}/{VOCABULARY}")
    n_postings, shards, groups = _sized(terms)

    # What follows from other columns of a row is worked out after the exchange instead of being exchanged and sorted.
    idf = inverse_document_frequency(F.lit(n_docs), F.col("df"))
    frequency = term_frequency(F.col("n"), F.col("doc_len")) if own else F.col("tf")
    weights = {"idf": idf, "tfidf": frequency * idf}
    postings, written = _observed(tfidf_index(tf, n_docs, terms).drop(*weights))
    if own:
        weights["tf"] = frequency
    # By length within a term, as the best results are sought.
    order = ["term", *(["doc_len"] if "doc_len" in postings.columns else []), "doc_id"]
    _lay_out(postings, shards, groups, order, f"{out}/{POSTINGS}", weights)
    _write_layout(spark, out, n_docs, shards)
    return StageRun("job3", n_postings, written.get["rows"], perf_counter() - start)


def _write_vocabulary(tf: DataFrame, n_docs: int, out: str) -> None:
    with freeing(tf.sparkSession):
        vocabulary(tf, n_docs).orderBy("term").write.mode("overwrite").parquet(f"{out}/{VOCABULARY}")


def _sized(terms: DataFrame) -> tuple[int, int, int]:
    """Postings of a stored vocabulary, and the shards and groups of terms that hold them."""
    with freeing(terms.sparkSession):
        n_postings = terms.agg(F.sum("df")).first()[0] or 0
    return n_postings, *_divided(terms.sparkSession, n_postings)


def _write_layout(spark: SparkSession, out: str, n_docs: int, shards: int) -> None:
    settings = [F.lit(n_docs).cast("bigint").alias("n_docs"), F.lit(shards).alias("shards")]
    spark.range(1).select(settings).coalesce(1).write.mode("overwrite").parquet(f"{out}/{LAYOUT}")


def import_index(spark: SparkSession, path: str, out: str, n_docs: int | None = None, id_type: str = "string") -> None:
    """Store the index that a text form holds, see ``read_postings_text``, below ``out``, laid out as ``build_index`` does.

    The text has the weights alone, so the vocabulary is counted from it; ``n_docs`` is the number of documents of the
    corpus, if it is known, and else that of the documents that have a posting. An id that is not of ``id_type`` is an error, and
    so is a text without any posting. Such an index is searched like any other; bounds and positions need more than it has.
    """
    rows, plain = postings_of_text(spark, path)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast(id_type))
    if not plain:
        rows = settle(rows, "imported")
    # Read for all ids before anything is replaced.
    seen = F.max(F.xxhash64("doc_id")) if n_docs is not None else F.count_distinct("doc_id")
    with freeing(spark):
        first = rows.agg(seen.alias("seen"), F.count(F.lit(1)).alias("n")).first()
    if not first.n:
        raise ValueError(f"no postings in {path}")
    n_docs = first.seen if n_docs is None else n_docs
    _write_vocabulary(rows, n_docs, out)
    _, shards, groups = _sized(spark.read.parquet(f"{out}/{VOCABULARY}"))
    _lay_out(rows, shards, groups, ["term", "doc_id"], f"{out}/{POSTINGS}")
    _write_layout(spark, out, n_docs, shards)


def build_snapshot(
    source: DataFrame,
    out: str,
    n_docs: int | None = None,
    whole: bool = True,
    positions: bool = False,
    bounds: bool = False,
    store: bool = False,
    bitmaps: bool = False,
) -> str:
    """Build a new index of a corpus in a folder of its own below ``out``, and publish it when all of it is written.

    Until then, and if the build fails, ``current_snapshot`` is the one before, and searches of it go on undisturbed, also
    those that began earlier. ``positions``, ``bounds``, ``store`` and ``bitmaps`` build these beside the index. Returns the folder. Earlier
    folders stay until they are removed.
    """
    folder = f"{out}/{SNAPSHOTS}/{uuid4().hex}"
    build_index(source, folder, n_docs=n_docs, whole=whole)
    if positions:
        build_positions(source, folder)
    if bounds:
        build_bounds(source.sparkSession, folder)
    if bitmaps:
        build_bitmaps(source.sparkSession, folder)
    if store:
        build_store(source, folder)
    publish_snapshot(source.sparkSession, out, folder)
    return folder


def publish_snapshot(spark: SparkSession, out: str, folder: str) -> None:
    """Make a folder that ``build_snapshot`` wrote below ``out`` the current one; an earlier one, to go back to it.

    The list of what was published only grows, by one file that appears as a whole. Of two that are published at the same time
    one becomes the current one.
    """
    number = _published(spark, out).agg(F.coalesce(F.max("number"), F.lit(0)) + 1).first()[0]
    row = spark.createDataFrame([(number, folder.rsplit("/", 1)[-1])], PUBLISHED_SCHEMA)
    row.coalesce(1).write.mode("append").parquet(f"{out}/{PUBLISHED}")


def current_snapshot(spark: SparkSession, out: str) -> str:
    """Folder of the index published last below ``out``, for ``load_index`` and ``load_store``."""
    last = _published(spark, out).orderBy(F.desc("number"), "snapshot").first()
    if last is None:
        raise ValueError(f"nothing was published below {out}")
    return f"{out}/{SNAPSHOTS}/{last.snapshot}"


def _published(spark: SparkSession, out: str) -> DataFrame:
    try:
        return spark.read.schema(PUBLISHED_SCHEMA).parquet(f"{out}/{PUBLISHED}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISHED_SCHEMA)


def _divided(spark: SparkSession, n_postings: int) -> tuple[int, int]:
    """Shards of an index, and groups of terms in each."""
    shards = min(MAX_SHARDS, n_postings // SHARD_POSTINGS + 1)
    # A small index still has a few groups for every core.
    return shards, max(n_postings // GROUP_POSTINGS, 8 * spark.sparkContext.defaultParallelism) // shards + 1


def _lay_out(rows: DataFrame, shards: int, groups: int, order: list[str], path: str, more: dict[str, Column] | None = None) -> None:
    """Write rows by shard and group of terms, sorted within each file.

    Columns of ``more`` are worked out where rows are written; one that the rows have already is not exchanged.
    """
    more = more or {}
    columns = [more.get(c, F.col(c)).alias(c) for c in rows.columns] + [value.alias(c) for c, value in more.items() if c not in rows.columns]
    # Shard and group as one number, to exchange less.
    lot = shard_of(F.col("term"), shards) * groups + F.pmod(F.hash("term"), F.lit(groups))
    placed = rows.drop(*more).withColumn("lot", lot).hint("rebalance", "lot")
    laid_out = placed.withColumn("shard", F.floor(F.col("lot") / groups).cast("int")).drop("lot").sortWithinPartitions("shard", *order)
    with freeing(rows.sparkSession):
        laid_out.select(*columns, "shard").write.partitionBy("shard").mode("overwrite").option(*CODEC).parquet(path)


def build_positions(docs: DataFrame, out: str) -> StageRun:
    """Store the positional postings of ``docs`` beside the index below ``out``, laid out as its postings are.

    A row of ``docs`` is a whole document, or a part of one if there is a column ``part``.
    """
    start = perf_counter()
    spark = docs.sparkSession
    _, shards, groups = _sized(spark.read.parquet(f"{out}/{VOCABULARY}"))
    docs, read = _observed(docs)
    rows, written = _observed(term_positions(docs if has_parts(docs) else spread(docs)))
    _lay_out(rows, shards, groups, ["term", "doc_id", "block"], f"{out}/{POSITIONS}")
    return StageRun("positions", read.get["rows"], written.get["rows"], perf_counter() - start)


def build_bounds(spark: SparkSession, out: str) -> None:
    """Store the bounds of the index below ``out`` beside it, from its own postings."""
    n_docs = spark.read.parquet(f"{out}/{LAYOUT}").first().n_docs
    rows = posting_bounds(spark.read.parquet(f"{out}/{POSTINGS}"), spread_for(n_docs))
    rows.sortWithinPartitions("term").write.mode("overwrite").parquet(f"{out}/{BOUNDS}")


def build_bitmaps(spark: SparkSession, out: str) -> None:
    """Store the bitmaps of the frequent terms of the index below ``out`` beside it, laid out as its postings are."""
    n_docs = spark.read.parquet(f"{out}/{LAYOUT}").first().n_docs
    postings, terms = (spark.read.parquet(f"{out}/{name}") for name in (POSTINGS, VOCABULARY))
    _, shards, groups = _sized(terms)
    rows = term_bitmaps(postings, terms, Numbering.of(postings, n_docs))
    _lay_out(rows, shards, groups, ["term", "bucket"], f"{out}/{BITMAPS}")


def load_index(spark: SparkSession, out: str, positions: bool = False, bounds: bool = False, bitmaps: bool = False) -> Index:
    """The index stored below ``out``, all parts of it; with ``positions``, ``bounds`` and ``bitmaps`` what ``build_positions``,
    ``build_bounds`` and ``build_bitmaps`` stored.
    """
    layout = spark.read.parquet(f"{out}/{LAYOUT}").first()
    index = Index(spark.read.parquet(f"{out}/{POSTINGS}"), spark.read.parquet(f"{out}/{VOCABULARY}"), layout.shards)
    if positions:
        rows = spark.read.parquet(f"{out}/{POSITIONS}")
        index = replace(index, positions=rows, position_shards=layout.shards)
    if bounds:
        rows = spark.read.parquet(f"{out}/{BOUNDS}")
        kept = rows.select("spread").head()
        index = replace(index, bounds=rows, spread=kept.spread if kept else 1)
    if bitmaps:
        rows = spark.read.schema(BITMAPS_SCHEMA).parquet(f"{out}/{BITMAPS}")
        kept = rows.select("span", "base", "least_df").head()
        if kept:  # none, if no term is frequent
            index = replace(index, bitmaps=rows, bitmap_shards=layout.shards, numbering=Numbering(*kept))
    return index
