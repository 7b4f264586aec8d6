"""The three indexing stages and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkdex.functions.text import pieces, run_length, run_term, term_runs, tokens
from inkdex.functions.weights import inverse_document_frequency, term_frequency
from inkdex.operators.joins import HOT_KEYS, join_by_weight
from inkdex.session import settle

# Postings per block of the nested form. A term with more is held in several rows.
BLOCK_POSTINGS = 65_536

# Bytes of a text beyond which its tokens are counted piece by piece, and code points of a piece.
LONG_TEXT, PIECE = 4 << 20, 1 << 20


def spread(rows: DataFrame) -> DataFrame:
    """Deal a plain scan of few input splits evenly to the cores.

    Splits are cut by bytes, but a row group is read by one of them: of a table of a few large row groups most splits
    are empty, and most cores would be idle. A scan of at least twice as many splits as cores, as any large one
    has, is returned unchanged, and so is one without any.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if 0 < rows.rdd.getNumPartitions() < 2 * cores else rows


def term_frequencies(docs: DataFrame, whole: bool = True) -> DataFrame:
    """Stage 1: ``(doc_id, term, n)``.

    With ``whole`` a row is a whole document, ``doc_id`` is unique, and the counts are final within
    the row: there is no exchange, and the document length comes along as ``doc_len``. Otherwise a
    document may span any number of rows; the counts of each row are summed by document and term,
    partial sums first.

    A text of more than ``LONG_TEXT`` bytes is cut into pieces that are dealt to the cores, since the list of its tokens
    would take many times its size in one task and sorting it more than in proportion. Only counts of its pieces are exchanged.
    """
    long = F.coalesce(F.octet_length("text") > LONG_TEXT, F.lit(False))
    counts = _row_counts(spread(docs.select("doc_id", "text").where(~long))).unionByName(_long_counts(docs.where(long), whole))
    if whole:
        return counts
    return counts.groupBy("doc_id", "term").agg(F.sum("n").alias("n"))


def _long_counts(docs: DataFrame, whole: bool) -> DataFrame:
    """Counts of rows with long texts, one row per row of ``docs`` and term if ``whole``; else those of their pieces."""
    cut = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), pieces(F.col("text"), PIECE).alias("pieces"))
    doc_len = F.aggregate("pieces", F.lit(0).cast("bigint"), lambda n, piece: n + F.size(tokens(piece)))
    cut = cut.select("doc_id", "row", "pieces", doc_len.alias("row_len"))
    rows = cut.select("doc_id", "row", "row_len", F.explode_outer("pieces").alias("text")).where("text is not null")
    # By the text, so that a task that runs again deals them as before; as many tasks as that, however few bytes there are.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = _row_counts(rows.repartition(parts, F.xxhash64("text")), "row", "row_len")
    if not whole:
        return counts.drop("row", "row_len")
    summed = counts.groupBy("doc_id", "row", "term").agg(F.sum("n").alias("n"), F.max("row_len").alias("doc_len"))
    return summed.drop("row")


def _row_counts(docs: DataFrame, *more: str) -> DataFrame:
    """``(doc_id, term, n, doc_len, *more)`` of each row by itself."""
    # Staged selects: with one select the optimizer would tokenise again above the generator. The
    # outer form of explode: for the inner one it infers a filter on the array, pushes it to the scan
    # and tokenises there as well.
    cut = docs.select("doc_id", *more, tokens(F.col("text")).alias("tokens"))
    runs = cut.select("doc_id", *more, F.size("tokens").cast("bigint").alias("doc_len"), term_runs(F.col("tokens")).alias("runs"))
    rows = runs.select("doc_id", *more, F.explode_outer("runs").alias("run"), "doc_len").where("run is not null")
    return rows.select("doc_id", run_term(F.col("run")).alias("term"), run_length(F.col("run")).alias("n"), "doc_len", *more)


def document_lengths(docs: DataFrame, whole: bool = True) -> DataFrame:
    """``(doc_id, doc_len)`` of the documents that have tokens."""
    lengths = docs.select("doc_id", F.size(tokens(F.col("text"))).cast("bigint").alias("doc_len"))
    if not whole:
        lengths = lengths.groupBy("doc_id").agg(F.sum("doc_len").alias("doc_len"))
    return lengths.where("doc_len > 0")


def normalize_tf(counts: DataFrame) -> DataFrame:
    """Stage 2: ``(doc_id, term, n, doc_len, tf)``.

    Where stage 1 carried the document length this is a projection. Otherwise the length is summed
    from the counts, which should be a stored table, and joined by document; a document of very many
    terms does not fall to one task.
    """
    if "doc_len" not in counts.columns:
        sums = counts.groupBy("doc_id").agg(F.sum("n").alias("doc_len"), F.count(F.lit(1)).alias("n_terms"))
        sums = settle(sums.where("doc_len <> 0"), "lengths")
        counts = join_by_weight(counts, sums, "doc_id", "n_terms")
    tf = term_frequency(F.col("n"), F.col("doc_len"))
    return counts.select("doc_id", "term", "n", "doc_len", tf.alias("tf"))


def document_frequencies(tf: DataFrame) -> DataFrame:
    """``(term, df)``: entries of each term, those without a number included."""
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(tf: DataFrame, n_docs: int | DataFrame) -> DataFrame:
    """``(term, df, idf)`` of every term."""
    return document_frequencies(tf).withColumn("idf", inverse_document_frequency(_scalar(n_docs), F.col("df")))


def tfidf_index(tf: DataFrame, n_docs: int | DataFrame, terms: DataFrame | None = None, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Stage 3: the inverted index, one row per posting.

    ``n_docs`` is a number or a DataFrame of one row and column. ``terms`` is the stored
    ``vocabulary``; without it one is written to the shared folder. ``tf`` is read once for the
    vocabulary and twice for the join, so it should be a stored table.
    """
    terms = settle(vocabulary(tf, n_docs), "vocabulary") if terms is None else terms
    weighted = join_by_weight(tf.where("tf is not null"), terms, "term", "df", hot_keys)
    kept = [c for c in ("n", "doc_len") if c in tf.columns]
    return weighted.select("term", "doc_id", *kept, "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("tfidf"))


def vocabulary_size(index: DataFrame) -> DataFrame:
    """One row ``n_terms``."""
    return index.select("term").distinct().agg(F.count(F.lit(1)).alias("n_terms"))


def posting_blocks(index: DataFrame, block_postings: int = BLOCK_POSTINGS) -> DataFrame:
    """Nested form: ``(term, block, n_blocks, df, postings array<struct<doc_id, tfidf>>)``.

    A term of more than ``block_postings`` documents has as many rows as keep each of them near that
    size; its documents are divided by hash, and sorted within the row. No list grows with the data.
    """
    n_blocks = F.ceil(F.col("df") / block_postings).cast("bigint")
    block = F.pmod(F.xxhash64("doc_id"), n_blocks)
    lists = index.groupBy("term", block.alias("block"), n_blocks.alias("n_blocks"), "df").agg(
        F.sort_array(F.collect_list(F.struct("doc_id", "tfidf"))).alias("postings")
    )
    return lists.select("term", "block", "n_blocks", "df", "postings")


def flatten_blocks(blocks: DataFrame) -> DataFrame:
    """``(term, doc_id, tfidf, df)`` from the nested form."""
    return blocks.select("term", F.explode("postings").alias("p"), "df").select("term", "p.doc_id", "p.tfidf", "df")


def _scalar(n_docs: int | DataFrame) -> Column:
    return n_docs.scalar() if isinstance(n_docs, DataFrame) else F.lit(n_docs)
