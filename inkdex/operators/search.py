"""Ranked AND search and phrase search, for one query or a table of queries."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkdex.functions.text import phrase_pattern, phrase_regex, split_terms, tokens
from inkdex.operators.bitmaps import common_documents, of_documents
from inkdex.operators.bounds import FREQUENT, MORE, ROOM, document_block, promising, query_blocks, still_open
from inkdex.operators.index import spread
from inkdex.operators.joins import join_at_documents, join_blocks, join_by_weight
from inkdex.operators.parts import has_parts, part_matches
from inkdex.operators.positions import BLOCK_TOKENS, phrase_starts, starts_of, term_positions
from inkdex.operators.postings import Index
from inkdex.session import settle, settle_sized, side
from inkdex.sources.store import DocumentStore

# Postings of the rarest term of a query up to which they are broadcast: 64 MB for ids of 300 bytes.
BROADCAST_POSTINGS = 200_000

# Postings of all terms of a query up to which they are grouped as they are.
GROUPED_POSTINGS = 1_000_000


def best_first(results: DataFrame, *keys: str) -> DataFrame:
    """Order by score, then by id, so that equal scores have a defined order."""
    return results.orderBy(*keys, F.desc("score"), "doc_id")


def search(index: Index | DataFrame, query: str | None) -> DataFrame:
    """``(doc_id, score)`` of the documents that hold every known term of a query, best first.

    Terms the index does not hold are ignored. A repeated term counts each time. A ``limit`` on the
    result takes the place of the full sort.
    """
    return best_first(_hits(Index.of(index), split_terms(query)))


def _hits(index: Index, terms: list[str]) -> DataFrame:
    """Unordered hits.

    The postings of all terms come from one scan, however many terms there are. If the rarest term
    has few documents, these are broadcast, and the postings of the common terms are only filtered
    where they lie; with bitmaps they are filtered by the documents that all frequent terms share. What is left is grouped
    by document. Scores are added in query order, so that
    equal documents have equal sums.
    """
    weights = Counter(terms)
    df = index.frequencies(list(weights))
    if not df:
        return index.postings.select("doc_id", F.col("tfidf").alias("score")).where(F.lit(False))
    known = [term for term in weights if term in df]
    rarest = min(known, key=lambda term: (df[term], term))
    if len(known) == 1:
        return index.postings_of(known).select("doc_id", (F.col("tfidf") * weights[rarest]).alias("score"))
    postings = index.postings_of(known).select("term", "doc_id", "tfidf")
    if df[rarest] <= BROADCAST_POSTINGS and sum(df.values()) > GROUPED_POSTINGS:
        some, small = settle_sized(index.postings_of([rarest]).select("doc_id"), "rarest")
        if small:
            postings = postings.join(F.broadcast(some), "doc_id", "left_semi")
    elif index.bitmaps is not None:
        postings = _in_all(index, postings, [term for term in known if df[term] >= index.numbering.least_df])
    told = F.create_map(*(F.lit(x) for at, term in enumerate(known) for x in (term, f"{at:06d} {weights[term]}")))
    note = F.split(told[F.col("term")], " ")
    part = F.struct(note[0].alias("pos"), (F.col("tfidf") * note[1].cast("int")).alias("score"))
    # A list holds one entry per term of the query.
    found = postings.groupBy("doc_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    total = F.aggregate(F.col("parts")["score"], F.lit(0.0), lambda done, score: done + score)
    return found.where(F.size("parts") == len(known)).select("doc_id", total.alias("score"))


def _in_all(index: Index, postings: DataFrame, frequent: list[str]) -> DataFrame:
    """At least the postings of documents that hold all the ``frequent`` terms of a query, by their bitmaps."""
    if len(frequent) < 2:
        return postings
    return of_documents(postings, index.numbering, common_documents(index.bitmaps_of(frequent), len(frequent)))


def phrase_search(
    index: Index | DataFrame, docs: DataFrame | DocumentStore | None, query: str | None, limit: int | None = None
) -> DataFrame:
    """``(doc_id, score)`` of all documents that an end user's query finds, best first.

    With one term this is ``search``. With more, quoted or not, the terms must also stand next to
    each other in the text. ``limit`` keeps that many of the best.

    If the index has positional postings, the phrase is found in them, no text is read and ``docs`` may be None.
    Otherwise the pattern is tested in the scan of the texts and only ids are joined to the hits, so no text is exchanged;
    of a ``DocumentStore`` only texts that hold all the words are read.
    A row of ``docs`` is a whole document, or a part of one if there is a column ``part``; phrases go over its edges.
    """
    index, terms = Index.of(index), split_terms(query)
    hits = _hits(index, terms)
    if len(terms) > 1:
        hits, adjacent = _adjacent(index, docs, hits, terms)
        hits = hits.join(adjacent, "doc_id", "left_semi")
    found = best_first(hits)
    return found if limit is None else found.limit(limit)


def _adjacent(index: Index, docs: DataFrame | DocumentStore | None, hits: DataFrame, terms: list[str]) -> tuple[DataFrame, DataFrame]:
    """Hits, and the ids of at least those of them that hold the terms next to each other."""
    if index.positions is not None:
        hits, rows = _near_hits(index, hits, terms)
        return hits, phrase_starts(rows, terms).select("doc_id").distinct()
    if isinstance(docs, DocumentStore):
        hits = settle(hits, "hits")
        docs = docs.fetch(hits.select("doc_id"))
    elif not has_parts(docs):
        docs = spread(docs.select("doc_id", "text"))
    if has_parts(docs):
        return hits, part_matches(docs, terms).select("doc_id").distinct()
    return hits, docs.where(F.col("text").rlike(phrase_regex(terms))).select("doc_id").distinct()


def _near_hits(index: Index, hits: DataFrame, terms: list[str]) -> tuple[DataFrame, DataFrame]:
    """Hits, and at least the positions of the terms in them: few hits filter the positions of common terms where they lie."""
    rows = index.positions_of(list(dict.fromkeys(terms)))
    if sum(index.frequencies(list(dict.fromkeys(terms))).values()) > GROUPED_POSTINGS:
        hits, small = settle_sized(hits, "hits")
        if small:
            rows = rows.join(F.broadcast(hits.select("doc_id")), "doc_id", "left_semi")
    return hits, rows


def search_batch(index: Index | DataFrame, queries: DataFrame, top: int | None = None) -> DataFrame:
    """``search`` for a table ``(query_id, query)``: ``(query_id, doc_id, score)``.

    With ``top`` only the best results of each query are kept, numbered by ``rank``. If the index has bounds, postings of
    blocks of documents that cannot hold any of the best are neither joined nor grouped.
    """
    index = Index.of(index)
    if top is None:
        return best_first(_batch_hits(index, _Asked.of(index, queries)), "query_id")
    asked = _Asked.of(index, queries)
    if index.bounds is None:
        return best_first(_best(_batch_hits(index, asked), top), "query_id")
    # A query of a rare term has few candidates as it is.
    bounded = F.col("df") >= FREQUENT
    groups = asked.leads.groupBy(bounded.alias("bounded")).count().collect()
    found = [
        _best_of_blocks(index, asked.only(bounded), top) if row.bounded else _best(_batch_hits(index, asked.only(~bounded)), top)
        for row in groups
    ]
    if not found:
        return best_first(_best(_batch_hits(index, asked), top), "query_id")
    return best_first(reduce(DataFrame.unionByName, found), "query_id")


def _best_of_blocks(index: Index, asked: _Asked, top: int) -> DataFrame:
    """The best hits: those of the most promising blocks of documents, then, in growing steps, of those that can still hold better ones."""
    best, room = None, ROOM * top
    left = settle(query_blocks(index.bounds, asked.known), "blocks")
    while best is None or not left.isEmpty():
        blocks = settle(promising(left, room), "blocks")
        found = _best(_batch_hits(index, asked, blocks.where("first").select("query_id", "block")), top)
        best = settle(found if best is None else _best(best.unionByName(found).drop("rank"), top), "best")
        left, room = settle(still_open(blocks, best, top), "open"), MORE * room
    return best


def phrase_search_batch(
    index: Index | DataFrame, docs: DataFrame | DocumentStore | None, queries: DataFrame, limit: int | None = None
) -> DataFrame:
    """``phrase_search`` for a table ``(query_id, query)``: ``(query_id, doc_id, score)``.

    ``limit`` keeps that many of the best of each query that is a phrase. If the index has positional postings,
    no text is read and ``docs`` may be None; for documents of several rows without them, those of the hits are made.
    Of a ``DocumentStore`` only the texts of hits are read.
    """
    index = Index.of(index)
    hits, small = settle_sized(with_phrases(_batch_hits(index, _Asked.of(index, queries)), queries), "hits")
    phrases = hits.where("terms IS NOT NULL")
    if isinstance(docs, DocumentStore) and index.positions is None:
        docs = docs.fetch(phrases.select("doc_id"))
    if index.positions is not None:
        terms, few = settle_sized(phrases.select(F.explode("terms").alias("term")).distinct(), "terms")
        best = _standing_together(index.positions_near(terms, few), phrases)
    elif has_parts(docs):
        found = phrases.select("doc_id").distinct()
        texts = docs.join(side(found, small), "doc_id", "left_semi")
        best = _standing_together(settle(term_positions(texts), "positions"), phrases)
    else:
        # Hits by themselves: with the pattern of its query each would take many times its size in a broadcast.
        cut = queries.select("query_id", tokens(F.col("query")).alias("terms")).where(F.size("terms") > 1)
        patterns, few = settle_sized(cut.select("query_id", phrase_pattern(F.col("terms")).alias("pattern")), "patterns")
        wanted = side(phrases.select("query_id", "doc_id", "score"), small)
        best = docs.select("doc_id", "text").join(wanted, "doc_id").join(side(patterns, few), "query_id")
        best = best.where(F.expr("text rlike pattern")).select("query_id", "doc_id", "score")
    if limit is not None:
        best = _best(best, limit).drop("rank")
    words = hits.where("terms IS NULL").select("query_id", "doc_id", "score")
    return best_first(words.unionByName(best), "query_id")


def _standing_together(positions: DataFrame, phrases: DataFrame) -> DataFrame:
    """Those hits ``(query_id, doc_id, score, terms)`` whose terms stand next to each other, by positional postings."""
    wanted = phrases.select("query_id", "doc_id", "score", F.size("terms").alias("n_terms"), F.posexplode("terms").alias("offset", "term"))
    wanted, few = settle_sized(wanted, "wanted")
    met = join_at_documents(positions.select("term", "doc_id", "block", "at"), wanted, few)
    return starts_of(met, ["query_id", "doc_id", "score"], BLOCK_TOKENS).select("query_id", "doc_id", "score").distinct()


def with_phrases(hits: DataFrame, queries: DataFrame, least: int = 2) -> DataFrame:
    """Hits with the ``terms`` of their query in order, null for a query of fewer than ``least`` tokens."""
    cut = queries.select("query_id", tokens(F.col("query")).alias("terms"))
    phrases, few = settle_sized(cut.select("query_id", F.when(F.size("terms") >= least, F.col("terms")).alias("terms")), "phrases")
    if few:
        return hits.join(F.broadcast(phrases), "query_id")
    # A query may have most of the hits.
    hits = settle(hits, "hits")
    counts = hits.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_hits"))
    phrases = settle(phrases.join(counts, "query_id"), "phrases")
    return join_by_weight(hits, phrases, "query_id", "n_hits").drop("n_hits")


# Places up to which Spark drops the other rows of a group in every partition, before they are exchanged.
PARTIAL_RANKS = 1000

# Groups that the hits of a query are ranked in first if more places are asked for.
RANK_BLOCKS = 256


def _best(hits: DataFrame, top: int) -> DataFrame:
    """The ``top`` best hits of each query; no more than that of a partition or block are ranked together."""
    best_of = [F.desc("score"), F.col("doc_id")]
    if top > PARTIAL_RANKS:
        block = F.pmod(F.xxhash64("doc_id"), F.lit(RANK_BLOCKS)).alias("block")
        place = F.row_number().over(Window.partitionBy("query_id", "block").orderBy(*best_of))
        hits = hits.select("*", block).withColumn("place", place).where(F.col("place") <= top).drop("block", "place")
    order = Window.partitionBy("query_id").orderBy(*best_of)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def query_terms(queries: DataFrame) -> DataFrame:
    """``(query_id, term, weight, pos)``: each distinct term of each query, with its first place."""
    cut = queries.select("query_id", tokens(F.col("query")).alias("terms"))
    rows = cut.select("query_id", F.posexplode("terms").alias("pos", "term"))
    return rows.groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("weight"), F.min("pos").alias("pos"))


@dataclass(frozen=True)
class _Asked:
    """A table of queries as search sees it: its terms, those that the index knows, and one row per query that has any."""

    terms: DataFrame
    few_terms: bool
    known: DataFrame
    leads: DataFrame
    few_leads: bool

    @staticmethod
    def of(index: Index, queries: DataFrame) -> _Asked:
        """Two queries of one id are an error."""
        if not queries.groupBy("query_id").count().where("count > 1").isEmpty():
            raise ValueError("query_id must be unique")
        terms, few_terms = settle_sized(query_terms(queries), "terms")
        known = _known(index, terms, few_terms)
        leads, few_leads = settle_sized(_leads(known), "leads")
        known = known.select("query_id", "term", "weight").join(leads.select("query_id", "n_known"), "query_id")
        return _Asked(terms, few_terms, known, leads, few_leads)

    def only(self, condition: Column) -> _Asked:
        """The queries whose row in ``leads`` meets a condition."""
        leads = self.leads.where(condition)
        return replace(self, leads=leads, known=self.known.join(leads.select("query_id"), "query_id", "left_semi"))


def _batch_hits(index: Index, asked: _Asked, allowed: DataFrame | None = None) -> DataFrame:
    """``(query_id, doc_id, score)``, unordered; ``allowed`` (query_id, block) names the blocks to search, all if None."""
    leads, few_leads = asked.leads, asked.few_leads
    postings = index.postings_near(asked.terms, asked.few_terms)
    if allowed is None:
        candidates = _candidates(postings.select("term", "doc_id", "tfidf"), leads, few_leads)
    else:
        allowed, few = settle_sized(allowed, "allowed")
        # First by what any query allows of a term, where the postings lie; then by query.
        lists = asked.known.select("query_id", "term").join(side(allowed, few), "query_id")
        lists, few_lists = settle_sized(lists.select("term", "block").distinct(), "lists")
        postings = postings.withColumn("block", document_block(F.col("doc_len"), F.col("doc_id"), index.spread))
        postings = postings.join(side(lists, few_lists), ["term", "block"], "left_semi")
        candidates = _candidates(postings.select("term", "doc_id", "tfidf", "block"), leads, few_leads)
        candidates = candidates.join(side(allowed, few), ["query_id", "block"], "left_semi")
    postings = postings.select("term", "doc_id", "tfidf")
    weighted = F.col("tfidf") * F.col("weight")
    part = F.named_struct(F.lit("pos"), "pos", F.lit("score"), weighted)
    single = candidates.where("n_known = 1").select("query_id", "doc_id", weighted.alias("score"))

    # Every other term of a candidate must be there too: look its posting up by term and document.
    pairs = candidates.where("n_known > 1").select(
        "query_id", "doc_id", "n_known", part.alias("lead"), F.explode("others").alias("other")
    )
    pairs = pairs.select("query_id", "doc_id", "n_known", "lead", "other.term", "other.weight", "other.pos")
    pairs, few_pairs = settle_sized(pairs, "pairs")
    found = join_at_documents(postings, pairs, few_pairs)
    parts = found.groupBy("query_id", "doc_id", "n_known", "lead").agg(F.collect_list(part).alias("rest"))
    # Scores are added in query order, so that equal documents have equal sums.
    in_order = F.sort_array(F.concat(F.array("lead"), "rest"))["score"]
    total = F.aggregate(in_order, F.lit(0.0), lambda done, score: done + score)
    complete = parts.where(F.size("rest") == F.col("n_known") - 1)
    return single.unionByName(complete.select("query_id", "doc_id", total.alias("score")))


def _known(index: Index, terms: DataFrame, few_terms: bool) -> DataFrame:
    """Query terms that the index holds, with their document frequency."""
    vocabulary = index.vocabulary.select("term", "df")
    if few_terms:
        return vocabulary.join(F.broadcast(terms), "term")
    # A term may be in most of the queries.
    asked = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n_queries"))
    known = settle(asked.join(vocabulary, "term"), "known")
    return join_by_weight(terms, known, "term", "n_queries")


def _leads(known: DataFrame) -> DataFrame:
    """One row per query that has a known term: its rarest term, and the others as a list."""
    rows = known.select("query_id", F.struct("df", "term", "weight", "pos").alias("known"))
    # The list is as long as the query has terms.
    by_query = rows.groupBy("query_id").agg(F.sort_array(F.collect_list("known")).alias("known"))
    others = F.slice("known", F.lit(2), F.size("known")).alias("others")
    leads = by_query.select("query_id", F.size("known").alias("n_known"), F.col("known")[0].alias("rarest"), others)
    return leads.select("query_id", "n_known", "rarest.*", "others")


def _candidates(postings: DataFrame, leads: DataFrame, few_leads: bool) -> DataFrame:
    """Postings of each query's rarest term, with the row of the query."""
    if few_leads:
        return postings.join(F.broadcast(leads), "term")
    # A term may lead many queries and have many documents at once: cut both sides into blocks.
    asked = settle(leads.groupBy("term", "df").agg(F.count(F.lit(1)).alias("n_leads")), "asked")
    left = join_by_weight(postings, asked, "term", "df")
    right = join_by_weight(leads.drop("df"), asked, "term", "n_leads")
    return join_blocks(left, right, "term", ("df", "doc_id"), ("n_leads", "query_id"))
