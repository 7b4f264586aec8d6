import itertools
import re
from dataclasses import replace
from functools import reduce

import pytest
from conftest import ordered, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

import inkdex as ix
from inkdex import session
from inkdex.operators import bounds, joins
from inkdex.operators import search as search_module

SEARCH = {
    "wizard": [("1", 0.115847), ("10", 0.081093)],
    "Wizard OZ": [("1", 0.231694), ("10", 0.162186)],
    '"of oz"': [("1", 0.429736)],
    "oz wizard": [("1", 0.231694), ("10", 0.162186)],
    "wizard wizard": [("1", 0.231694), ("10", 0.162186)],
    "wizard zzz": [("1", 0.115847), ("10", 0.081093)],
    "zzz": [],
    " ": [],
    "the": [("1", 0.0), ("10", 0.0), ("notes", 0.0), ("notes2", 0.0)],
}
PHRASE = {
    **{q: [] for q in SEARCH},
    "wizard": SEARCH["wizard"],
    '"of oz"': SEARCH['"of oz"'],
    "oz wizard": [("1", 0.231694)],
    "the": SEARCH["the"],
}


@pytest.mark.parametrize("query", list(SEARCH))
def test_search(index, query):
    assert ordered(ix.search(index, query)) == SEARCH[query]


@pytest.mark.parametrize("query", list(PHRASE))
def test_phrase_search(index, docs, query):
    assert ordered(ix.phrase_search(index, docs, query)) == PHRASE[query]


def test_missing_query(index, docs):
    assert ordered(ix.search(index, None)) == [] == ordered(ix.phrase_search(index, docs, None))


def test_search_on_bare_postings(index):
    assert ordered(ix.search(index.postings, "wizard oz")) == SEARCH["Wizard OZ"]


def test_search_without_broadcast(index, docs, monkeypatch):
    monkeypatch.setattr(search_module, "BROADCAST_POSTINGS", 0)
    for query in SEARCH:
        assert ordered(ix.search(index, query)) == SEARCH[query]


def test_term_order_does_not_matter(index):
    found = [ordered(ix.search(index, " ".join(p))) for p in itertools.permutations(["wizard", "oz", "of", "the"])]
    assert all(f == found[0] for f in found) and found[0]


@pytest.fixture(scope="module")
def asked(spark):
    return spark.createDataFrame(list(enumerate(SEARCH)), "query_id bigint, query string")


def expected(results):
    return sorted((i, *row) for i, found in enumerate(results.values()) for row in found)


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, -1])
def test_batches(index, docs, asked, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(session, "BROADCAST_BYTES", broadcast_bytes)
    assert rows(ix.search_batch(index, asked)) == expected(SEARCH)
    assert rows(ix.phrase_search_batch(index, docs, asked)) == expected(PHRASE)


def test_batch_with_blocks_smaller_than_the_groups(index, spark, monkeypatch):
    from inkdex.operators import joins

    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(joins.join_blocks, "__defaults__", (1,))
    same = spark.createDataFrame([(i, "the wizard") for i in range(6)], "query_id bigint, query string")
    found = rows(ix.search_batch(index, same))
    assert found == sorted((i, *row) for i in range(6) for row in SEARCH["wizard"])


def test_batch_top(index, asked):
    found = ix.search_batch(index, asked, top=1)
    assert rows(found, "query_id", "doc_id", "rank") == sorted(
        (i, f[0][0], 1) for i, f in enumerate(SEARCH.values()) if f
    )


def test_search_on_imported_postings(spark, index, tmp_path):
    ix.write_postings_text(ix.posting_blocks(index.postings, 1), str(tmp_path / "p"))
    imported = ix.read_postings_text(spark, str(tmp_path / "p"))
    assert rows(imported) == rows(index.postings, "term", "doc_id", "tfidf")
    assert ordered(ix.search(imported, "wizard oz")) == SEARCH["Wizard OZ"]


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    """Forty documents whose scores for ``a b`` fall with the id; every third holds the phrase."""
    texts = [(i, ("a b " if i % 3 == 0 else "b a ") + "c " * i) for i in range(40)] + [(99, "nothing here")]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    out = str(tmp_path_factory.mktemp("library"))
    ix.build_index(docs, out)
    return docs, ix.load_index(spark, out), texts


@pytest.mark.parametrize("limit", [None, 2, 3, 13, 100])
def test_phrase_limit(library, limit):
    docs, index, texts = library
    found = ix.phrase_search(index, docs, "a b", limit)
    want = [i for i, t in texts if re.search(r"\ba b\b", t)][:limit]
    assert [row.doc_id for row in found.collect()] == want


def test_phrase_search_exchanges_no_text(library):
    docs, index, _ = library
    plan = ix.phrase_search(index, docs, "a b")._jdf.queryExecution().optimizedPlan().toString()
    scan = next(line for line in plan.splitlines() if "RLIKE" in line)
    assert "Filter" in scan and "Join" not in scan


def test_scans_do_not_grow_with_the_query(library):
    _, index, _ = library

    def scans(query):
        return ix.search(index, query)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")

    assert scans("a b") == scans("a b c") <= 2


def test_the_rarest_term_filters_first(library, monkeypatch):
    _, index, _ = library
    plain = ordered(ix.search(index, "a b c"))
    monkeypatch.setattr(search_module, "GROUPED_POSTINGS", 0)
    assert ordered(ix.search(index, "a b c")) == plain and plain


def test_query_ids_are_unique(library, spark):
    _, index, _ = library
    with pytest.raises(ValueError):
        ix.search_batch(index, spark.createDataFrame([(1, "a"), (1, "b")], "query_id bigint, query string"))


def test_phrase_limit_in_a_batch(library, spark):
    docs, index, texts = library
    asked = spark.createDataFrame([(1, "a b"), (2, "a"), (3, '"b a c"')], "query_id bigint, query string")
    found = ix.phrase_search_batch(index, docs, asked, limit=5).collect()
    by_query = {q: [r.doc_id for r in found if r.query_id == q] for q in (1, 2, 3)}
    assert by_query[1] == [0, 3, 6, 9, 12]
    assert len(by_query[2]) == 40
    holds = {i for i, t in texts if re.search(r"\bb a c\b", t)}
    assert by_query[3] == [r.doc_id for r in ix.search(index, "b a c").collect() if r.doc_id in holds][:5]


def test_phrase_results_are_search_results(library):
    docs, index, _ = library
    assert set(rows(ix.phrase_search(index, docs, "a b"))) <= set(rows(ix.search(index, "a b")))


def test_best_of_a_query_is_cut_before_the_exchange(index, asked):
    plan = ix.search_batch(index, asked, top=2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Partial")


@pytest.fixture(scope="module")
def long_and_short(spark, tmp_path_factory):
    """Index with bounds of documents of very different lengths."""
    out = str(tmp_path_factory.mktemp("bounded"))
    texts = [(n, " ".join(f"w{(n * m) % 97} of the" if m % 3 == 0 else f"w{m % 50}" for m in range(1 + (n * n) % 400))) for n in range(400)]
    texts += [(1000 + n, "of the" if n < 3 else "another") for n in range(300)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    ix.build_index(docs, out)
    index = ix.load_index(spark, out)
    return replace(index, bounds=bounds.posting_bounds(index.postings, 8, 20).cache(), spread=8)


ASKED = ["of the", "of", "the of the w3", "w7 w9 of", "zzz", "w96 w1 of the", " ", "of zzz"]


@pytest.mark.parametrize("top", [3, 5000])
def test_bounds_change_no_result(spark, long_and_short, top, monkeypatch):
    monkeypatch.setattr(search_module, "FREQUENT", 20)
    queries = spark.createDataFrame(list(enumerate(ASKED)), "query_id bigint, query string")
    plain = ix.search_batch(replace(long_and_short, bounds=None), queries, top)
    assert ordered(ix.search_batch(long_and_short, queries, top)) == ordered(plain)


def test_bounds_leave_most_postings_out(spark, long_and_short, monkeypatch):
    """Of the documents that hold both terms a fifth at most is in blocks that are searched."""
    searched, hits = [], search_module._batch_hits

    def watched(index, asked, allowed=None):
        searched.append(allowed.select("block"))
        return hits(index, asked, allowed)

    monkeypatch.setattr(search_module, "_batch_hits", watched)
    queries = spark.createDataFrame([(1, "of the")], "query_id bigint, query string")
    asked = search_module._Asked.of(long_and_short, queries)
    assert search_module._best_of_blocks(long_and_short, asked, 5).count() == 5
    rows = long_and_short.postings_of(["of", "the"])
    place = bounds.document_block(F.col("doc_len"), F.col("doc_id"), long_and_short.spread)
    inside = rows.withColumn("block", place).join(reduce(DataFrame.union, searched).distinct(), "block")
    assert 0 < inside.count() <= rows.count() / 5


def test_no_bound_is_below_a_score(long_and_short):
    place = bounds.document_block(F.col("doc_len"), F.col("doc_id"), long_and_short.spread)
    rows = long_and_short.postings.withColumn("block", place).join(long_and_short.bounds, ["term", "block"])
    assert rows.where("tfidf > most").isEmpty() and not rows.isEmpty()


def test_ranks_beyond_the_partial_ones(spark, index, monkeypatch):
    monkeypatch.setattr(search_module, "PARTIAL_RANKS", 1)
    queries = spark.createDataFrame([(1, "the"), (2, "wizard")], "query_id bigint, query string")
    found = ordered(ix.search_batch(index, queries, top=2))
    assert [(q, d, r) for q, d, _, r in found] == [(1, "1", 1), (1, "10", 2), (2, "1", 1), (2, "10", 2)]


def test_pairs_too_many_to_broadcast_exchange_only_postings_of_their_documents(spark, index, asked, monkeypatch):
    expected = rows(ix.search_batch(index, asked))
    monkeypatch.setattr(search_module, "settle_sized", lambda df, purpose: (session.settle(df, purpose), False))
    monkeypatch.setattr(search_module, "BROADCAST_POSTINGS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = ix.search_batch(index, asked)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert rows(hits) == expected and "LeftSemi" in plan and "SortMergeJoin" in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_join_at_documents_is_a_join(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(session, "BROADCAST_BYTES", broadcast_bytes)
    left = spark.range(60).select(F.when(F.col("id") % 3 > 0, "a").alias("term"), F.when(F.col("id") % 7 > 0, F.col("id") % 5).alias("doc_id"), F.col("id").alias("l"))
    right = spark.range(20).select(F.when(F.col("id") % 4 > 0, "a").otherwise("b").alias("term"), F.when(F.col("id") > 0, F.col("id") % 3).alias("doc_id"), F.col("id").alias("r"))
    expected = rows(left.join(right, ["term", "doc_id"]), "term", "doc_id", "l", "r")
    for few in (True, False):
        assert rows(joins.join_at_documents(left, right, few), "term", "doc_id", "l", "r") == expected


def test_what_is_too_large_to_broadcast_is_not_broadcast_for_its_small_files(spark, monkeypatch):
    """Spark goes by the size of files; of equal rows that is far less than what they take in the driver's memory."""
    monkeypatch.setattr(session, "BROADCAST_BYTES", 1 << 16)
    postings = spark.range(50).selectExpr("'of' AS term", "id AS doc_id", "0.5D AS tfidf")
    wanted = spark.range(20_000).selectExpr("id % 50 AS query_id", "'of' AS term", "id % 50 AS doc_id")
    stored, few = session.settle_sized(wanted, "pairs")
    met = joins.join_at_documents(postings, stored, few)
    assert not few and "SortMergeJoin [" in met._jdf.queryExecution().executedPlan().toString()
    assert met.count() == 20_000


def test_hits_are_broadcast_without_their_patterns(spark, index, docs):
    """The pattern of a query is sent once, not with each of its hits."""
    queries = spark.createDataFrame([(1, "wizard of oz"), (2, "the oz"), (3, "oz")], "query_id bigint, query string")
    found = ix.phrase_search_batch(index, docs, queries)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "array_join" not in plan
    want = [(q, r.doc_id) for q, query in ((1, "wizard of oz"), (2, "the oz"), (3, "oz")) for r in ix.phrase_search(index, docs, query).collect()]
    assert sorted((r.query_id, r.doc_id) for r in found.collect()) == sorted(want) and len(want) > 2
