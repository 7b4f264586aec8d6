"""Documents of several rows, as ``read_lines`` gives them: matches and headers over the edges of rows.

A document reads as its rows in the order of ``part``, joined by line breaks, rows without a text left out. No text
is put together for that: of each row only what stands about the terms of the query is taken on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.functions.text import TOKEN_ANY_CASE
from inkdex.operators.joins import join_by_weight
from inkdex.operators.positions import overlaps_itself
from inkdex.operators.running import totals_before
from inkdex.session import settle


def has_parts(docs: DataFrame) -> bool:
    """Whether a row of ``docs`` is a part of a document."""
    return "part" in docs.columns


def _pieces(rows: DataFrame, terms: list[str]) -> DataFrame:
    """Rows cut at the tokens that are terms: ``(doc_id, part, at, gap, gap_tokens, token, after, chars, tokens)``.

    A piece is the ``gap`` before such a token and the ``token``; the last piece of a row has a null token and
    its line break. ``after`` tells whether an underscore follows the token.
    """
    regex = f"(?i)(?<![A-Za-z0-9])(?:{'|'.join(dict.fromkeys(terms))})(?![A-Za-z0-9])"
    found = rows.where("text IS NOT NULL").select(
        "doc_id", "part", F.split("text", regex).alias("gaps"), F.regexp_extract_all("text", F.lit(regex), F.lit(0)).alias("matched")
    )
    after = F.transform("gaps", lambda g: g.startswith("_"))
    zipped = F.arrays_zip("gaps", "matched", F.slice(after, 2, F.greatest(F.size("gaps"), F.lit(1))).alias("after"))
    pieces = found.select("doc_id", "part", F.posexplode(zipped).alias("at", "piece"))
    rows = pieces.select("doc_id", "part", "at", F.col("piece.gaps").alias("gap"), F.col("piece.matched").alias("token"), "piece.after")
    gap_tokens = F.regexp_count("gap", F.lit(TOKEN_ANY_CASE)).cast("bigint")
    rows = rows.select("*", gap_tokens.alias("gap_tokens"))
    chars = F.length("gap") + F.coalesce(F.length("token"), F.lit(1))
    tokens = F.col("gap_tokens") + F.when(F.col("token").isNull(), 0).otherwise(1)
    # Of a gap with tokens of its own no match holds anything; the underscore before a token is all that counts.
    kept = F.when(F.col("gap_tokens") == 0, F.col("gap"))
    before = F.col("gap").endswith("_").alias("before")
    return rows.select(
        "doc_id", "part", "at", kept.alias("gap"), "gap_tokens", before, F.length("gap").alias("gap_chars"), "token", "after",
        chars.cast("bigint").alias("chars"), tokens.cast("bigint").alias("tokens"),
    )


def part_matches(rows: DataFrame, terms: list[str]) -> DataFrame:
    """``(doc_id, first, start, end, matched)``: matches of the terms next to each other, ``first`` the number of the first token.

    Tokens and characters are numbered over the whole document by running totals. A match is found where every
    term proposes the same first token, so a group holds one match and no document is a group; only for a phrase
    that could overlap itself, such as ``a b a``, the matches of a document meet, of which those that overlap an earlier one go.
    """
    placed = totals_before(_pieces(rows, terms), "doc_id", ["part", "at"], ["chars", "tokens"])
    number = F.col("tokens_before") + F.col("gap_tokens")
    start = F.col("chars_before") + F.col("gap_chars")
    offsets = F.create_map(
        *(c for t in dict.fromkeys(terms) for c in (F.lit(t), F.array(*(F.lit(o) for o, other in enumerate(terms) if other == t))))
    )
    last = len(terms) - 1
    is_term = F.col("token").isNotNull()
    # Blank ends of rows stand within the matches that begin at any of the tokens before.
    blank = F.when((~is_term) & (F.col("gap_tokens") == 0) & F.lit(last > 0), F.sequence(F.lit(1), F.lit(max(last, 1))))
    offset = F.explode(F.when(is_term, offsets[F.lower("token")]).otherwise(blank)).alias("offset")
    proposed = placed.select("doc_id", "part", "at", "gap", "before", "token", "after", number.alias("number"), start.alias("start"), offset)
    fits = F.col("token").isNull() | (
        ~((F.col("offset") == 0) & F.col("before")) & ~((F.col("offset") == last) & F.coalesce("after", F.lit(False)))
    )
    text = F.when(F.col("token").isNull(), F.concat("gap", F.lit("\n")))
    text = text.when(F.col("offset") == 0, F.col("token")).otherwise(F.concat("gap", "token"))
    piece = F.struct("number", F.col("token").isNotNull().alias("is_term"), "part", "at", F.coalesce(text, F.lit("")).alias("text"))
    met = proposed.where(fits).groupBy("doc_id", (F.col("number") - F.col("offset")).alias("first")).agg(
        F.count("token").alias("n"),
        F.min(F.when(F.col("token").isNotNull(), F.col("start"))).alias("start"),
        F.max(F.col("start") + F.length("token")).alias("end"),
        F.array_join(F.sort_array(F.collect_list(piece))["text"], "").alias("matched"),
    )
    found = met.where(F.col("n") == len(terms)).select("doc_id", "first", "start", "end", "matched")
    if not overlaps_itself(terms):
        return found
    one = F.struct("first", "start", "end", "matched")
    lists = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(one)).alias("all"))
    none = F.slice("all", 1, 0)
    kept = F.aggregate(
        "all",
        none,
        lambda seen, m: F.when(
            (F.size(seen) == 0) | (m["first"] >= F.element_at(seen, -1)["first"] + len(terms)), F.array_append(seen, m)
        ).otherwise(seen),
    )
    return lists.select("doc_id", F.explode(kept).alias("m")).select("doc_id", "m.*")


def part_offsets(rows: DataFrame, terms: list[str]) -> DataFrame:
    """``match_offsets`` of documents of several rows."""
    ordered = totals_before(part_matches(rows, terms).withColumn("one", F.lit(1).cast("bigint")), "doc_id", ["first"], ["one"])
    ordered = settle(ordered, "matches")
    counts = settle(ordered.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_matches")), "counts")
    return join_by_weight(ordered, counts, "doc_id", "n_matches").select(
        "doc_id",
        (F.col("one_before") + 1).cast("int").alias("match_no"),
        F.col("n_matches").cast("int").alias("n_matches"),
        "start",
        "end",
        "matched",
    )


def part_heads(rows: DataFrame, characters: int) -> DataFrame:
    """``(doc_id, head)``: the first characters of documents of several rows.

    Rows that begin beyond the head are dropped by their place in the document, so a head is made of few rows.
    """
    head = F.substring("text", 1, characters).alias("head")
    sized = rows.where("text IS NOT NULL").select("doc_id", "part", head, (F.length("text") + 1).cast("bigint").alias("chars"))
    # The row that begins right after the head brings the line break at its end.
    placed = totals_before(sized, "doc_id", ["part"], ["chars"]).where(F.col("chars_before") <= characters)
    lists = placed.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("part", "head"))).alias("rows"))
    return lists.select("doc_id", F.substring(F.array_join(F.col("rows")["head"], "\n"), 1, characters).alias("head"))
