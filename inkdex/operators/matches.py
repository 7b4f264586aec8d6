"""Where a query stands in the texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkdex.functions.text import TOKEN_ANY_CASE, phrase_regex, split_terms
from inkdex.operators.index import spread
from inkdex.operators.joins import join_at_documents, join_by_weight
from inkdex.operators.parts import has_parts, part_matches, part_offsets
from inkdex.operators.positions import BLOCK_TOKENS, phrase_counts, starts_of, term_positions
from inkdex.operators.postings import Index
from inkdex.operators.search import with_phrases
from inkdex.session import settle, settle_sized
from inkdex.sources.store import DocumentStore

# Matches of a document that are placed in its text at once.
BLOCK_MATCHES = 65_536


def match_counts(docs: DataFrame, query: str | None, index: Index | None = None) -> DataFrame:
    """``(doc_id, n_matches)`` of every document; a query without tokens has no matches.

    With the positional postings of an ``index`` no text is read, only the ids of ``docs``. With a column ``part`` a
    row is a part of a document, and each document is counted once.
    """
    terms = split_terms(query)
    if not terms:
        none = docs.select("doc_id", F.lit(0).alias("n_matches"))
        return none.distinct() if has_parts(docs) else none
    if index is not None and index.positions is not None:
        found = phrase_counts(index.positions_of(terms), terms)
    elif has_parts(docs):
        found = part_matches(docs, terms).groupBy("doc_id").agg(F.count(F.lit(1)).cast("int").alias("n_matches"))
    else:
        return spread(docs.select("doc_id", "text")).select("doc_id", F.regexp_count("text", F.lit(phrase_regex(terms))).alias("n_matches"))
    ids = docs.select("doc_id")
    if has_parts(docs):
        ids = ids.distinct()
    return ids.join(found, "doc_id", "left").select("doc_id", F.coalesce("n_matches", F.lit(0)).alias("n_matches"))


def match_offsets(docs: DataFrame, query: str | None) -> DataFrame:
    """``(doc_id, match_no, n_matches, start, end, matched)``, one row per match in text order.

    ``[start, end)`` counts characters (code points) from 0. A row of ``docs`` is a whole document, or with a
    column ``part`` a part of one; the parts in order are joined by line breaks, over which matches may go.

    The text is cut at the matches; the place of a match is the sum of the lengths before it. Only
    lengths leave the row of the text, and they are summed by a window over the document.
    """
    terms = split_terms(query)
    if not terms:
        return _offsets(docs.where(F.lit(False)), "$^")
    if has_parts(docs):
        return part_offsets(docs, terms)
    return _offsets(docs, phrase_regex(terms))


def _offsets(docs: DataFrame, regex: str) -> DataFrame:
    texts = spread(docs.select("doc_id", "text"))
    found = texts.select("doc_id", "text", F.regexp_extract_all("text", F.lit(regex), F.lit(0)).alias("matched"))
    # A text without a match is not searched a second time.
    gaps = F.when(F.size("matched") > 0, F.transform(F.split("text", regex), F.length)).alias("gap")
    cut = found.select("doc_id", F.size("matched").alias("n_matches"), "matched", gaps).select(
        "doc_id", "n_matches", F.arrays_zip("gap", "matched").alias("parts")
    )
    # The text after the last match is a part without a match. The outer form keeps the optimizer
    # from matching once more in an inferred filter.
    parts = cut.select("doc_id", "n_matches", F.posexplode_outer("parts").alias("at", "part"))
    rows = parts.where("part.matched is not null").select("doc_id", "n_matches", "at", "part.gap", "part.matched")
    so_far = F.sum(F.col("gap") + F.length("matched")).over(_in_text_order())
    return rows.withColumn("end", so_far).select(
        "doc_id",
        (F.col("at") + 1).alias("match_no"),
        "n_matches",
        (F.col("end") - F.length("matched")).alias("start"),
        "end",
        "matched",
    )


def match_offsets_batch(
    results: DataFrame, docs: DataFrame | DocumentStore, queries: DataFrame, index: Index | None = None, block_matches: int = BLOCK_MATCHES
) -> DataFrame:
    """``(query_id, doc_id, match_no, n_matches, start, end, matched)``: ``match_offsets`` of each result of a batch.

    ``results`` holds ``(query_id, doc_id)``, as ``search_batch`` and ``phrase_search_batch`` give them; pairs that are there
    twice are placed once. ``queries`` holds ``(query_id, query)`` with unique ids. A row of ``docs`` is a whole document of
    an id of its own. Results without a match, of unknown documents and of queries without tokens have no row.

    All phrases are found at once, in the positional postings of the ``index``, or in those made of the documents among the
    results. Then each of these texts is cut once, whatever the number of queries it answers, and tokens become characters.
    """
    if has_parts(docs.rows if isinstance(docs, DocumentStore) else docs):
        raise ValueError("rows must be whole documents: put them together with join_lines")
    asked = with_phrases(results.select("query_id", "doc_id").distinct(), queries, 1).where("terms IS NOT NULL")
    asked, few_asked = settle_sized(asked, "asked")
    texts = _texts_of(docs, asked.select("doc_id").distinct())
    found = settle(_apart(_phrases(asked, texts, index)), "found")
    # A document may answer most queries: its phrases are dealt to groups of bounded size.
    totals = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_phrases"), F.sum(F.size("firsts")).alias("n_firsts"))
    dealt = join_by_weight(found, settle(totals, "totals"), "doc_id", "n_phrases")
    block = F.pmod(F.xxhash64("terms"), F.ceil(F.col("n_firsts") / block_matches).cast("bigint")).alias("block")
    lists = dealt.groupBy("doc_id", block).agg(F.collect_list(F.struct("terms", "firsts")).alias("phrases")).drop("block")
    lists, few_lists = settle_sized(lists, "lists")
    placed = texts.join(F.broadcast(lists) if few_lists else lists, "doc_id").select("doc_id", F.explode(_placed()).alias("phrase"))
    placed = placed.select("doc_id", F.col("phrase.terms").alias("terms"), F.col("phrase.places").alias("places"))
    met = placed.join(F.broadcast(asked) if few_asked else asked, ["doc_id", "terms"])
    rows = met.select("query_id", "doc_id", F.size("places").alias("n_matches"), F.posexplode("places").alias("at", "place"))
    return rows.select("query_id", "doc_id", (F.col("at") + 1).alias("match_no"), "n_matches", "place.start", "place.end", "place.matched")


def _texts_of(docs: DataFrame | DocumentStore, ids: DataFrame) -> DataFrame:
    """``(doc_id, text)`` of a stored table of ids; texts are exchanged only if the ids do not fit a broadcast."""
    if isinstance(docs, DocumentStore):
        return docs.fetch(ids).select("doc_id", "text")
    ids, few = settle_sized(ids, "ids")
    return spread(docs.select("doc_id", "text")).join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def _phrases(asked: DataFrame, texts: DataFrame, index: Index | None) -> DataFrame:
    """``(doc_id, terms, starts)`` of every phrase asked of a document, a row per block of starts; one asked twice is found once."""
    phrases = asked.select("doc_id", "terms").distinct()
    wanted = phrases.select("doc_id", "terms", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("offset", "term"))
    wanted, few = settle_sized(wanted, "wanted")
    if index is not None and index.positions is not None:
        terms, few_terms = settle_sized(wanted.select("term").distinct(), "terms")
        positions = index.positions_near(terms, few_terms)
    else:
        positions = settle(term_positions(texts), "positions")
    met = join_at_documents(positions.select("term", "doc_id", "block", "at"), wanted, few)
    return starts_of(met, ["doc_id", "terms"], BLOCK_TOKENS).drop("n_terms")


def _apart(starts: DataFrame) -> DataFrame:
    """``(doc_id, terms, firsts)``: first tokens of the matches of a phrase in a document, one after the other."""
    lists = starts.groupBy("doc_id", "terms").agg(F.sort_array(F.flatten(F.collect_list("starts"))).alias("all"))
    n_terms = F.size("terms")
    overlaps = F.exists(
        F.sequence(F.lit(1), n_terms),
        lambda n: (n < n_terms) & (F.slice("terms", n + 1, n_terms) == F.slice("terms", F.lit(1), n_terms - n)),
    )
    kept = F.aggregate(
        "all",
        F.slice("all", 1, 0),
        lambda seen, s: F.when((F.size(seen) == 0) | (s >= F.get(seen, F.size(seen) - 1) + n_terms), F.array_append(seen, s)).otherwise(seen),
    )
    return lists.select("doc_id", "terms", F.when(overlaps, kept).otherwise(F.col("all")).alias("firsts"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often and however deep in it the value is used."""
    return F.transform(F.array(value), body)[0]


def _placed() -> Column:
    """``phrases`` of a row with ``places``, the characters of their matches in its ``text``.

    Places are sums of the widths of gaps and tokens. Sums are kept for about the square root of as many blocks of tokens
    as there are tokens, so that a place takes the widths of one block.
    """
    gaps, tokens_ = F.split("text", TOKEN_ANY_CASE), F.regexp_extract_all("text", F.lit(TOKEN_ANY_CASE), F.lit(0))
    none = F.lit(0).cast("bigint")

    def total(widths: Column) -> Column:
        return F.aggregate(widths, none, lambda done, width: done + width)

    def in_blocks(cut: Column) -> Column:
        # The gap after the last token has no token, and no place depends on it.
        widths = F.zip_with(cut["gaps"], cut["tokens"], lambda g, t: (F.length(g) + F.coalesce(F.length(t), F.lit(0))).cast("bigint"))
        return _let(F.struct(widths.alias("widths"), F.ceil(F.sqrt(F.size(widths))).cast("int").alias("root")), lambda w: with_sums(cut, w))

    def with_sums(cut: Column, w: Column) -> Column:
        blocks = F.sequence(F.lit(0), w["root"])
        sums = F.transform(blocks, lambda b: total(F.slice(w["widths"], b * w["root"] + 1, w["root"])))
        return _let(sums, lambda s: _let(F.transform(blocks, lambda b: total(F.slice(s, F.lit(1), b))), lambda bases: phrases(cut, w, bases)))

    def phrases(cut: Column, w: Column, bases: Column) -> Column:
        def end(token: Column) -> Column:
            block = F.floor(token / w["root"]).cast("int")
            return F.get(bases, block) + total(F.slice(w["widths"], block * w["root"] + 1, token - block * w["root"] + 1))

        def matched(first: Column, n_terms: Column) -> Column:
            pieces = F.transform(
                F.sequence(F.lit(0), n_terms - 1),
                lambda n: F.concat(F.when(n == 0, "").otherwise(F.get(cut["gaps"], first + n)), F.get(cut["tokens"], first + n)),
            )
            return F.array_join(pieces, "")

        def place(first: Column, n_terms: Column) -> Column:
            return F.struct(
                (end(first) - F.length(F.get(cut["tokens"], first))).alias("start"),
                end(first + n_terms - 1).alias("end"),
                matched(first, n_terms).alias("matched"),
            )

        return F.transform(
            "phrases",
            lambda p: F.struct(
                p["terms"].alias("terms"),
                F.transform(p["firsts"], lambda first: place(first.cast("int"), F.size(p["terms"]))).alias("places"),
            ),
        )

    return _let(F.struct(gaps.alias("gaps"), tokens_.alias("tokens")), in_blocks)


def _in_text_order(column: str = "at"):
    return Window.partitionBy("doc_id").orderBy(column).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def match_navigation(offsets: DataFrame) -> DataFrame:
    """Each match with the start of the next and the previous one, round the ends, and its label."""
    order = Window.partitionBy("doc_id").orderBy("match_no")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return offsets.select(
        "*",
        F.coalesce(F.lead("start").over(order), F.first("start").over(whole)).alias("next_start"),
        F.coalesce(F.lag("start").over(order), F.last("start").over(whole)).alias("prev_start"),
        F.format_string("Match %d of %d", "match_no", "n_matches").alias("status"),
    )


def nest_offsets(offsets: DataFrame) -> DataFrame:
    """``(doc_id, spans array<struct<start, end>>)``; a list is no longer than its text."""
    return offsets.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
