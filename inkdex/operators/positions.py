"""Positional postings: where each term stands in each document, and phrases found without reading a text.

Tokens are numbered in text order. The texts themselves are cut here, before any change of case, because
a phrase is an affair of ASCII words. An underscore belongs to a word but to no token, so each
occurrence carries a mark if one stands right before it and another if one stands right after it: a phrase
neither begins at a token of the first kind nor ends at one of the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkdex.functions.text import run_term
from inkdex.operators.running import totals_before

# Tokens of a document whose positions one row holds at most.
BLOCK_TOKENS = 65_536

# An occurrence is 4 * its number within the block, plus the marks.
AFTER_UNDERSCORE, BEFORE_UNDERSCORE = 1, 2

_MARKED = "_?[A-Za-z0-9]+_?"
# Sorted occurrences of one term and block, such as "of 000000 000016,of 000000 000092".
_RUN = r"([a-z0-9]++ [0-9]++) [0-9]++(?:,\1 [0-9]++)*+"


def marked_tokens(text: Column) -> Column:
    """Tokens of a raw text in order, with the underscores that touch them."""
    # Doubled, so that an underscore between two tokens is seen by both.
    apart = F.when(F.contains(text, F.lit("_")), F.replace(text, F.lit("_"), F.lit("_ _"))).otherwise(text)
    return F.regexp_extract_all(apart, F.lit(_MARKED), F.lit(0))


def term_positions(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(term, doc_id, block, at array<int>)``: ascending occurrences of each term in each block of a document.

    A row of ``docs`` is a whole document, or a part of one if there is a column ``part`` (as
    ``read_lines`` gives it): then tokens are numbered over all parts in order, and a block may have a row
    for each of its parts. Occurrences are sorted and cut into terms within the row of the text; nothing is exchanged
    for that.
    """
    cut = docs.select("doc_id", *(["part"] if "part" in docs.columns else []), marked_tokens(F.col("text")).alias("tokens"))
    if "part" in docs.columns:
        sized = cut.select("doc_id", "part", "tokens", F.coalesce(F.size("tokens"), F.lit(0)).cast("bigint").alias("n")).where("n > 0")
        cut = totals_before(sized, "doc_id", ["part"], ["n"]).select("doc_id", "tokens", F.col("n_before").alias("base"))
    else:
        cut = cut.select("doc_id", "tokens", F.lit(0).cast("bigint").alias("base"))

    def occurrence(token: Column, number: Column) -> Column:
        place = F.col("base") + number
        marks = F.when(token.startswith("_"), AFTER_UNDERSCORE).otherwise(0) + F.when(token.endswith("_"), BEFORE_UNDERSCORE).otherwise(0)
        own = (place % block_tokens) * 4 + marks
        digits = (F.lpad(F.floor(place / block_tokens).cast("string"), 8, "0"), F.lpad(own.cast("string"), 10, "0"))
        marked = F.concat_ws(" ", F.lower(F.replace(token, F.lit("_"), F.lit(""))), *digits)
        # Most tokens have no mark and lie in the first block: fewer steps.
        plain = F.concat(F.lower(token), F.lit(f" {0:08d} "), F.lpad((place * 4).cast("string"), 10, "0"))
        return F.when((place < block_tokens) & ~F.contains(token, F.lit("_")), plain).otherwise(marked)

    in_order = F.array_join(F.sort_array(F.transform("tokens", occurrence)), ",")
    runs = cut.select("doc_id", F.regexp_extract_all(in_order, F.lit(_RUN), F.lit(0)).alias("runs"))
    rows = runs.select("doc_id", F.explode_outer("runs").alias("run")).where("run is not null")
    at = F.transform(F.split("run", ","), lambda one: F.substring_index(one, " ", -1).cast("int"))
    block = F.split("run", " ")[1].cast("bigint")
    return rows.select(run_term(F.col("run")).alias("term"), "doc_id", block.alias("block"), at.alias("at"))


def overlaps_itself(terms: list[str]) -> bool:
    """Whether two occurrences of a phrase can share tokens."""
    return any(terms[n:] == terms[: len(terms) - n] for n in range(1, len(terms)))


def _starts(at: Column, block: Column, offset: Column, n_terms: Column, block_tokens: int) -> Column:
    """Where a phrase would begin for each occurrence of the term at ``offset`` in it."""
    first, last = offset == 0, offset == n_terms - 1
    fits = F.filter(
        at,
        lambda x: (~first | (x.bitwiseAND(F.lit(AFTER_UNDERSCORE)) == 0)) & (~last | (x.bitwiseAND(F.lit(BEFORE_UNDERSCORE)) == 0)),
    )
    return F.transform(fits, lambda x: block * block_tokens + F.shiftright(x, 2) - offset)


def starts_of(occurrences: DataFrame, keys: list[str], block_tokens: int) -> DataFrame:
    """``(*keys, starts)``: ascending starts of phrases, a row per key and block of starts.

    ``occurrences`` has the keys, ``at``, ``block``, the term's ``offset`` in the phrase and ``n_terms`` of the phrase. A
    start that every offset proposes is a match; starts of a block meet in one group, wherever the terms stand.
    """
    proposed = occurrences.select(
        *keys, "n_terms", _starts(F.col("at"), F.col("block"), F.col("offset"), F.col("n_terms"), block_tokens).alias("starts")
    )
    blocks = F.array_distinct(F.transform("starts", lambda s: F.floor(s / block_tokens)))
    dealt = proposed.select(*keys, "n_terms", "starts", F.explode(blocks).alias("start_block"))
    own = F.filter("starts", lambda s: F.floor(s / block_tokens) == F.col("start_block"))
    met = dealt.groupBy(*keys, "n_terms", "start_block").agg(F.sort_array(F.flatten(F.collect_list(own))).alias("all"))
    # Each offset proposes a start once, so a match stands n_terms times in a row.
    matches = F.filter("all", lambda s, i: F.get("all", i + F.col("n_terms") - 1) == s)
    return met.select(*keys, "n_terms", matches.alias("starts")).where(F.size("starts") > 0)


def phrase_starts(positions: DataFrame, terms: list[str], block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(doc_id, starts)`` of a literal phrase, see ``starts_of``; ``positions`` holds those of its terms at least."""
    told = F.create_map(
        *(c for t in dict.fromkeys(terms) for c in (F.lit(t), F.array(*(F.lit(o) for o, other in enumerate(terms) if other == t))))
    )
    rows = positions.where(F.col("term").isin(list(dict.fromkeys(terms))))
    occurrences = rows.select("doc_id", "block", "at", F.explode(told[F.col("term")]).alias("offset"), F.lit(len(terms)).alias("n_terms"))
    return starts_of(occurrences, ["doc_id"], block_tokens).drop("n_terms")


def apart(starts: Column, n_terms: int) -> Column:
    """Number of matches one after the other among ascending ``starts``, which may overlap."""
    none = F.struct(F.lit(0).alias("n"), F.lit(-1).cast("bigint").alias("free"))
    return F.aggregate(
        starts,
        none,
        lambda seen, s: F.when(s >= seen["free"], F.struct((seen["n"] + 1).alias("n"), (s + n_terms).alias("free"))).otherwise(seen),
        lambda seen: seen["n"],
    )


def phrase_counts(positions: DataFrame, terms: list[str], block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """``(doc_id, n_matches)`` of the documents that hold a literal phrase.

    Matches do not overlap. Only for a phrase that could overlap itself, such as ``a b a``, do all starts of a document meet.
    """
    found = phrase_starts(positions, terms, block_tokens)
    if overlaps_itself(terms):
        found = found.groupBy("doc_id").agg(F.sort_array(F.flatten(F.collect_list("starts"))).alias("starts"))
        return found.select("doc_id", apart(F.col("starts"), len(terms)).alias("n_matches"))
    return found.groupBy("doc_id").agg(F.sum(F.size("starts")).cast("int").alias("n_matches"))
