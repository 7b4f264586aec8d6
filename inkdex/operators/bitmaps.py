"""Documents of frequent terms as bitmaps, so that what several terms share is known before their postings are joined.

Every document has a number. Ids that are integers in a dense range are numbered by themselves, others by a hash into a range
four times as long as the corpus, so no table of numbers is needed and each posting tells its own. Of equal
hashes a bitmap tells too much, never too little, and the search looks at the documents themselves in any case.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkdex.operators.joins import join_by_weight
from inkdex.session import settle_sized

# A term of one document in so many has bitmaps. A bitmap goes over 32,768 numbers, so one holds hundreds of documents of it.
SHARE = 64

# Numbers per document, at most where ids number themselves, about where they are hashed.
ROOM = 4

_WORDS = "transform(sequence(0, 1023), i -> cast(conv(hex(substring(bitmap, i * 4 + 1, 4)), 16, 10) AS bigint))"


@dataclass(frozen=True)
class Numbering:
    """Documents are numbered from 1 to ``span``, and a last number is for a document without an id.

    ``base`` is the smallest id where ids number themselves, and null where they are hashed. Terms of ``least_df`` documents have bitmaps.
    """

    span: int
    base: int | None
    least_df: int

    @staticmethod
    def of(postings: DataFrame, n_docs: int, share: int = SHARE) -> Numbering:
        least, room = n_docs // share + 1, ROOM * max(n_docs, 1)
        if dict(postings.dtypes)["doc_id"] in ("tinyint", "smallint", "int", "bigint"):
            ends = postings.agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).first()
            if ends["first"] is not None and ends["last"] - ends["first"] < room:
                return Numbering(ends["last"] - ends["first"] + 1, ends["first"], least)
        return Numbering(room, None, least)

    def number(self, doc_id: Column) -> Column:
        own = F.pmod(F.xxhash64(doc_id), F.lit(self.span)) if self.base is None else doc_id.cast("bigint") - F.lit(self.base)
        return F.coalesce(own, F.lit(self.span)).cast("bigint") + 1


def term_bitmaps(postings: DataFrame, terms: DataFrame, numbering: Numbering) -> DataFrame:
    """``(term, bucket, bitmap, span, base, least_df)``: the documents of each frequent term, by bucket of their numbers.

    ``postings`` and the vocabulary ``terms`` (term, df) are stored tables. Bitmaps are made before the exchange, so a term
    that most documents hold sends a few bytes for each of them.
    """
    frequent = terms.where(F.col("df") >= numbering.least_df).select("term", "df")
    rows = join_by_weight(postings.select("term", "doc_id"), frequent, "term", "df")
    number = numbering.number(F.col("doc_id"))
    placed = rows.select("term", F.bitmap_bucket_number(number).alias("bucket"), F.bitmap_bit_position(number).alias("bit"))
    maps = placed.groupBy("term", "bucket").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
    base = F.lit(numbering.base).cast("bigint").alias("base")
    return maps.select("*", F.lit(numbering.span).cast("bigint").alias("span"), base, F.lit(numbering.least_df).cast("bigint").alias("least_df"))


def common_documents(bitmaps: DataFrame, n_terms: int) -> DataFrame:
    """``(bucket, bitmap)`` of the documents that all of the ``n_terms`` terms of ``bitmaps`` hold; buckets without any are left out."""
    met = bitmaps.groupBy("bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count(F.lit(1)).alias("n_terms"))
    return met.where((F.col("n_terms") == n_terms) & (F.bitmap_count("bitmap") > 0)).select("bucket", "bitmap")


def of_documents(rows: DataFrame, numbering: Numbering, common: DataFrame) -> DataFrame:
    """Those of ``rows`` (doc_id, ...) whose documents are in ``common``; all, if that is too large to be sent to them."""
    common, small = settle_sized(common.select(F.col("bucket").alias("_bucket"), F.expr(_WORDS).alias("_words")), "common")
    if not small:
        return rows
    number = numbering.number(F.col("doc_id"))
    bit = F.bitmap_bit_position(number).cast("int")
    word = F.col("_words")[F.floor(bit / 32).cast("int")]
    # Words are four bytes, the first one highest; within a byte the lowest bit is the first.
    place = (F.lit(24) - F.floor(bit % 32 / 8).cast("int") * 8) + bit % 8
    held = (F.bitmap_bucket_number(number) == F.col("_bucket")) & (F.getbit(word, place) == 1)
    return rows.join(F.broadcast(common), held).drop("_bucket", "_words")
