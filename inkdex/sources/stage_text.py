"""Tab-separated text forms of the three stages, and their lenient readers."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkdex.functions.text import after_last, before_last, parse_double, parse_int
from inkdex.session import freeing, settle_sized

# What a key and a number are packed into one field with, cut at the last of it.
WORD_AT_DOC, DOC_EQUALS_TF, DOC_COLON_SCORE = "@", "=", ":"

# Number of a block and of all blocks of its term, at the end of a line that holds one of several.
BLOCK_MARK = r"\t([0-9]{1,9})/([0-9]{1,9})\z"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(value, line_at)``; ``line_at`` orders lines by file and by place in the file."""
    at = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select("value", at.alias("line_at"))


def last_by_line(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The value on the last line of each key; partial maxima are taken before the exchange."""
    return rows.groupBy(key).agg(F.max_by(value, "line_at").alias(value))


def _two_fields(spark: SparkSession, path: str) -> DataFrame:
    """First and second field of every line that has a non-empty second field or later ones."""
    # The pattern also finds tabs before a line break at the end; few lines have either.
    ends = [F.col("value").endswith(end) for end in ("\t", "\n", "\r", "\u0085", "\u2028", "\u2029")]
    value = F.when(reduce(or_, ends), F.regexp_replace("value", "\t+$", "")).otherwise(F.col("value"))
    fields = spark.read.text(path).select(F.split(value, "\t").alias("f"))
    return fields.where(F.size("f") >= 2).select(F.col("f")[0].alias("key"), F.col("f")[1].alias("item"))


def read_tokens_text(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, term, n)`` from ``word@docId <tab> n``; malformed lines are dropped."""
    rows = _two_fields(spark, path).where(F.contains("key", F.lit("@")))
    return rows.select(
        after_last(F.col("key"), WORD_AT_DOC).alias("doc_id"),
        before_last(F.col("key"), WORD_AT_DOC).alias("term"),
        parse_int(F.col("item")).alias("n"),
    ).where("n is not null")


def fitting(column: Column, forbidden: str) -> Column:
    """A column as text; a value that the format cannot hold stops the job instead of being lost."""
    text = column.cast("string")
    error = F.raise_error(F.concat(F.lit("the text form cannot hold: "), text))
    return F.when(text.rlike(forbidden), error.cast("string")).otherwise(text)


def write_tokens_text(tokens: DataFrame, path: str) -> None:
    """Lines that ``read_tokens_text`` reads back; an id with ``@``, a tab or a line break is an error."""
    key = F.concat_ws("@", fitting(F.col("term"), "[\\t\\n\\r]"), fitting(F.col("doc_id"), "[@\\t\\n\\r]"))
    _write_lines(tokens, path, key, F.col("n").cast("string"))


def read_tf_text(spark: SparkSession, path: str) -> DataFrame:
    """``(term, doc_id, tf)`` from ``word <tab> docId=tf``.

    A line with two fields but no number keeps its row with a null ``tf``: it counts towards the
    document frequency of its term and has no posting.
    """
    rows = _two_fields(spark, path)
    packed = F.contains("item", F.lit("="))
    return rows.select(
        F.col("key").alias("term"),
        F.when(packed, before_last(F.col("item"), DOC_EQUALS_TF)).alias("doc_id"),
        F.when(packed, parse_double(after_last(F.col("item"), DOC_EQUALS_TF))).alias("tf"),
    )


def write_tf_text(tf: DataFrame, path: str) -> None:
    """Lines that ``read_tf_text`` reads back; an id with a tab or a line break is an error."""
    item = F.concat_ws("=", fitting(F.col("doc_id"), "[\\t\\n\\r]"), F.col("tf").cast("string"))
    _write_lines(tf, path, fitting(F.col("term"), "[\\t\\n\\r]"), item)


def _write_lines(rows: DataFrame, path: str, *fields) -> None:
    with freeing(rows.sparkSession):
        rows.select(F.concat_ws("\t", *fields).alias("value")).write.mode("overwrite").text(path)


def read_postings_text(spark: SparkSession, path: str) -> DataFrame:
    """``(term, doc_id, tfidf)`` from ``term <tab> doc:score,doc:score``.

    A line may end in ``<tab> block/blocks``, as ``write_postings_text`` marks those of a term that has several; without the
    mark it is the only one of its term. The last line of a term tells the number of its blocks, and lines of another number are
    out of date; of the others the last line of each block wins, then the last score of a document. Entries without a number are
    skipped. Lines never meet, so a term may have any number of documents.

    The lines are read twice, first for the terms of which lines or entries may compete, see ``_contested``. Only the entries of
    these are exchanged. An export that was not changed since has none.
    """
    return postings_of_text(spark, path)[0]


def postings_of_text(spark: SparkSession, path: str) -> tuple[DataFrame, bool]:
    """``read_postings_text``, and whether nothing is exchanged for it, so that it may be read again at the cost of a scan."""
    lines = _posting_lines(spark, path)
    contested, few = settle_sized(_contested(lines), "contested")
    none = contested.isEmpty()
    contested = F.broadcast(contested) if few else contested
    own = F.xxhash64("term") == F.col("term_hash")
    plain = _scored(lines.join(contested, own, "left_anti")).drop("at")
    # Without any such term adaptive execution leaves this part out.
    others = lines.join(contested, own, "left_semi")
    others = _scored(others if none else _last_lines(_latest_lines(others)))
    return plain.unionByName(others.groupBy("term", "doc_id").agg(F.max_by("tfidf", "at").alias("tfidf"))), none


def _posting_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(term, block, n_blocks, entries, line_at)``, a row per line."""
    tab = F.instr("value", F.lit("\t"))
    cut = text_lines(spark, path).where(tab > 0).select(
        F.substring_index("value", "\t", 1).alias("term"), F.col("value").substr(tab + 1, F.length("value")).alias("rest"), "line_at"
    )

    def mark(group: int, without: int):
        return F.coalesce(F.nullif(F.regexp_extract("rest", BLOCK_MARK, group), F.lit("")).cast("int"), F.lit(without))

    return cut.select(
        "term", mark(1, 0).alias("block"), mark(2, 1).alias("n_blocks"), F.regexp_replace("rest", BLOCK_MARK, "").alias("entries"), "line_at"
    )


def _contested(lines: DataFrame) -> DataFrame:
    """``(term_hash)`` of at least those terms of which not every entry stands by itself.

    A term is left out if it has one line for each of its blocks, all of one number of blocks, no line names a document twice, and one and
    the same function of the id tells the block of each entry, so that no two lines name the same document. The function is
    what ``posting_blocks`` divides documents by, for ids that are texts, bigints or ints. Only a row of numbers per line is exchanged.
    """
    packed = F.filter(F.split("entries", ","), lambda entry: F.contains(entry, F.lit(DOC_COLON_SCORE)))
    ids = F.transform(packed, lambda entry: before_last(entry, DOC_COLON_SCORE))
    cut = lines.select(F.xxhash64("term").alias("term_hash"), "block", "n_blocks", ids.alias("ids"))

    def divided(of):
        home = F.forall("ids", lambda one: F.pmod(F.xxhash64(of(one)), F.col("n_blocks")) == F.col("block"))
        return F.when(F.col("n_blocks") > 1, home).otherwise(F.col("block") == 0)

    functions = {"text": lambda one: one, "bigint": lambda one: one.try_cast("bigint"), "int": lambda one: one.try_cast("int")}
    told = cut.select(
        "term_hash",
        "block",
        "n_blocks",
        (F.size(F.array_distinct("ids")) < F.size("ids")).alias("repeated"),
        *(divided(of).alias(name) for name, of in functions.items()),
    )
    # By term, so that the blocks of a term are counted where they are.
    blocks = told.repartition("term_hash").groupBy("term_hash", "block")
    worst = [F.min("n_blocks").alias("least"), F.max("n_blocks").alias("most"), F.max("repeated").alias("repeated")]
    worst += [F.min(name).alias(name) for name in functions]
    terms = blocks.agg(F.count(F.lit(1)).alias("n"), *worst).groupBy("term_hash")
    worst[:2] = [F.min("least").alias("least"), F.max("most").alias("most")]
    found = terms.agg(F.max("n").alias("n"), *worst)
    return found.where(f"n > 1 OR least <> most OR repeated OR NOT ({' OR '.join(functions)})").select("term_hash")


def _scored(lines: DataFrame) -> DataFrame:
    """``(term, doc_id, tfidf, at)``: entries that have a number; ``at`` orders those of a term."""
    entries = lines.select("term", "block", F.posexplode(F.split("entries", ",")).alias("at", "entry"))
    scored = entries.where(F.contains("entry", F.lit(DOC_COLON_SCORE))).select(
        "term",
        before_last(F.col("entry"), DOC_COLON_SCORE).alias("doc_id"),
        parse_double(after_last(F.col("entry"), DOC_COLON_SCORE)).alias("tfidf"),
        # Block and place as one number, which is grouped by hash; a struct would be sorted.
        F.shiftleft(F.col("block").cast("bigint"), 32).bitwiseOR(F.col("at").cast("bigint")).alias("at"),
    )
    return scored.where("tfidf is not null")


def _latest_lines(lines: DataFrame) -> DataFrame:
    """The lines of the number of blocks that the last line of their term tells."""
    # Terms of which there are lines of several numbers of blocks, with the number that counts.
    numbers = lines.groupBy("term", "n_blocks").agg(F.max("line_at").alias("line_at"))
    dated = numbers.groupBy("term").agg(F.max_by("n_blocks", "line_at").alias("latest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    dated, few = settle_sized(dated.select("term", "latest"), "dated")
    return lines.join(F.broadcast(dated) if few else dated, "term", "left").where("latest IS NULL OR n_blocks = latest")


def _last_lines(lines: DataFrame) -> DataFrame:
    """``(term, block, entries)``: the last line of each block; only lines of blocks that have several are exchanged."""
    several = lines.groupBy("term", "block").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("term", "block")
    several, few = settle_sized(several, "several")
    own = lines.select("term", "block", "entries", "line_at")
    if several.isEmpty():
        return own.drop("line_at")
    several = F.broadcast(several) if few else several
    last = own.join(several, ["term", "block"], "left_semi").groupBy("term", "block").agg(F.max_by("entries", "line_at").alias("entries"))
    return own.join(several, ["term", "block"], "left_anti").drop("line_at").unionByName(last)


def write_postings_text(blocks: DataFrame, path: str, compression: str = "none") -> None:
    """One line per posting block, sorted by term within each file; exchanges nothing.

    A term of one block has a plain line, the blocks of other terms are marked, see ``read_postings_text``. An id with
    a comma, a tab or a line break is an error. ``compression`` is a codec of Spark's text files, such as ``gzip``; the reader knows it
    by the names of the files, of which each is then read by one task.
    """
    entry = F.transform(
        "postings", lambda p: F.concat_ws(":", fitting(p["doc_id"], "[,\\t\\n\\r]"), p["tfidf"].cast("string"))
    )
    mark = F.when(F.col("n_blocks") > 1, F.concat_ws("/", F.col("block").cast("string"), F.col("n_blocks").cast("string")))
    line = F.concat_ws("\t", fitting(F.col("term"), "[\\t\\n\\r]"), F.array_join(entry, ","), mark)
    with freeing(blocks.sparkSession):
        lines = blocks.sortWithinPartitions("term", "block").select(line.alias("value"))
        # Ids and scores hardly get shorter by more effort.
        lines.write.mode("overwrite").option("zlib.compress.level", "BEST_SPEED").text(path, compression)
