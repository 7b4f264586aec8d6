"""Positional postings and documents of several rows, against plain matching of whole texts."""

import random
import re

import pytest
from conftest import ordered, rows
from test_search import PHRASE

import inkdex as ix
from inkdex.operators import positions as positions_module
from inkdex.operators import search as search_module
from inkdex.operators.running import totals_before

EDGES = "(?<![A-Za-z0-9_]){}(?![A-Za-z0-9_])"


def plain(text, terms):
    pattern = EDGES.format("[^a-zA-Z0-9]+".join(terms))
    return [(m.start(), m.end(), m[0]) for m in re.finditer(pattern, text, re.IGNORECASE | re.ASCII)]


def positional(spark, docs):
    stored = ix.term_positions(docs).cache()
    tf = ix.normalize_tf(ix.term_frequencies(docs, whole="part" not in docs.columns))
    postings = ix.tfidf_index(tf, 10).cache()
    return ix.Index(postings, ix.vocabulary(postings, 10), positions=stored)


@pytest.fixture(scope="module")
def stored(spark, docs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("positional"))
    ix.build_index(docs, out, n_docs=3)
    run = ix.build_positions(docs, out)
    assert (run.stage, run.records_in) == ("positions", 5)
    return ix.load_index(spark, out, positions=True)


@pytest.mark.parametrize("query", list(PHRASE))
def test_phrase_search_without_texts(stored, query):
    assert ordered(ix.phrase_search(stored, None, query)) == PHRASE[query]


def test_few_hits_filter_the_positions(stored, monkeypatch):
    monkeypatch.setattr(search_module, "GROUPED_POSTINGS", 0)
    assert ordered(ix.phrase_search(stored, None, "oz wizard")) == PHRASE["oz wizard"]


def test_batch_without_texts(spark, stored):
    queries = spark.createDataFrame(list(enumerate(PHRASE)), "query_id bigint, query string")
    expected = sorted((n, *hit) for n, query in enumerate(PHRASE) for hit in PHRASE[query])
    assert rows(ix.phrase_search_batch(stored, None, queries)) == expected


def test_counts_read_no_text(spark, stored, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/docs")
    table = spark.read.parquet(f"{tmp_path}/docs")
    for query in ("wizard", "oz wizard", "of oz", "zzz", " "):
        found = ix.match_counts(table, query, stored)
        assert rows(found) == rows(ix.match_counts(table, query))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "text" not in re.findall(r"docs.*ReadSchema: (\S+)", plan.replace("\n", " "))[:1]
    assert "text:string" not in ix.match_counts(table, "of oz", stored)._jdf.queryExecution().executedPlan().toString()


def some_texts(n, seed, empty=False):
    """Short texts of few characters, so that phrases, repeats and underscores meet in all ways."""
    pick = random.Random(seed)
    words = ["a", "A", "b", "a_", "_b", "_", ".", "é", "K", "İa", "ab", "\n", "b"]
    return ["".join(pick.choice(words) + pick.choice([" ", " ", "", "\n"]) for _ in range(pick.randrange(0 if empty else 1, 14))) for _ in range(n)]


@pytest.mark.parametrize("block", [1, 3, 65_536])
def test_positions_equal_plain_matching(spark, block):
    texts = some_texts(150, block)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    stored = ix.term_positions(docs, block).cache()
    for terms in (["a"], ["a", "b"], ["a", "a"], ["a", "b", "a"]):
        expected = {i: len(plain(t, terms)) for i, t in enumerate(texts)}
        found = {r.doc_id: r.n_matches for r in positions_module.phrase_counts(stored, terms, block).collect()}
        assert found == {i: n for i, n in expected.items() if n}


def test_parts_equal_the_whole_text(spark):
    pick = random.Random(4)
    texts = [[None if pick.random() < 0.1 else t for t in some_texts(pick.randrange(1, 6), n, empty=True)] for n in range(60)]
    cut = [(i, p, t) for i, parts in enumerate(texts) for p, t in enumerate(parts)]
    parts = spark.createDataFrame(cut, "doc_id bigint, part bigint, text string").repartition(3)
    whole = {i: "\n".join(t for t in own if t is not None) for i, own in enumerate(texts)}
    index = positional(spark, parts)
    bare = ix.Index(index.postings, index.vocabulary)
    queries = ["a", "a b", "a a", "a b a"]
    phrases = {}
    for number, query in enumerate(queries):
        expected = sorted((i, n + 1, *m) for i, text in whole.items() for n, m in enumerate(plain(text, query.split())))
        assert rows(ix.match_offsets(parts, query), "doc_id", "match_no", "start", "end", "matched") == expected
        counts = sorted((i, len(plain(text, query.split()))) for i, text in whole.items())
        assert rows(ix.match_counts(parts, query)) == counts == rows(ix.match_counts(parts, query, index))
        hits = [r[0] for r in rows(ix.search(index, query), "doc_id")]
        phrases[number] = [(i,) for i in hits if " " not in query or dict(counts)[i]]
        assert rows(ix.phrase_search(index, None, query), "doc_id") == phrases[number]
        assert rows(ix.phrase_search(bare, parts, query), "doc_id") == phrases[number]
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id bigint, query string")
    expected = sorted((number, *hit) for number, own in phrases.items() for hit in own)
    assert rows(ix.phrase_search_batch(bare, parts, asked), "query_id", "doc_id") == expected
    assert rows(ix.phrase_search_batch(index, None, asked), "query_id", "doc_id") == expected


def test_lines_of_files(spark, corpus):
    lines = ix.read_lines(spark, corpus)
    assert rows(ix.match_offsets(lines, "of oz")) == [("1", 1, 2, 11, 16, "of Oz"), ("1", 2, 2, 25, 31, "of: oz")]
    assert rows(ix.match_offsets(lines, "oz wizard"), "doc_id", "matched") == [("1", "Oz\nWIZARD")]
    index = ix.Index.of(ix.tfidf_index(ix.normalize_tf(ix.term_frequencies(lines, whole=False)), 3))
    assert ordered(ix.phrase_search(index, lines, "oz wizard")) == [("1", 0.231694)]


def test_heads_over_rows(spark):
    texts = {1: "x\n" * 2000 + "Title: Late", 2: "Title:\n\n Two,\nAuthor: B", 3: "", 4: "nothing\nTitle: Four\nmore", 5: "é" * 1490 + "\nTitle: cut off"}
    cut = [(i, p, line) for i, text in texts.items() for p, line in enumerate(text.split("\n"))] + [(4, 99, None)]
    parts = spark.createDataFrame(cut, "doc_id bigint, part bigint, text string").repartition(4)
    whole = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    assert rows(ix.heads(parts)) == rows(ix.heads(whole))
    assert rows(ix.heads(parts, 5)) == rows(ix.heads(whole, 5))
    titles = [(r.doc_id, r.title) for r in ix.extract_titles(parts).orderBy("doc_id").collect()]
    assert titles == [(r.doc_id, r.title) for r in ix.extract_titles(whole).orderBy("doc_id").collect()]


def test_totals_of_a_key_that_holds_nearly_all_rows(spark):
    sizes = [(7, n, n % 5) for n in range(3000)] + [(k, 0, 1) for k in range(5)] + [(None, 0, 3)]
    table = spark.createDataFrame(sizes, "k bigint, at bigint, size bigint").repartition(7)
    found = totals_before(table, "k", ["at"], ["size"])
    assert rows(found.where("k = 7"), "at", "size_before") == [(n, sum(m % 5 for m in range(n))) for n in range(3000)]
    assert found.count() == 3005
