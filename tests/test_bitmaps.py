from dataclasses import replace

import pytest
from conftest import ordered
from pyspark.sql import functions as F

import inkdex as ix
from inkdex import session
from inkdex.operators import search as search_module
from inkdex.operators.bitmaps import Numbering, common_documents, term_bitmaps

QUERIES = ["of the of every", "of odd even", "rare odd of", "of the zzz", "third"]


TEXT = """concat_ws(' ', 'every', if(id % 5 > 0, 'of', ''), if(id % 7 > 0, 'the', ''), if(id % 2 = 1, 'odd', 'even'),
    if(id % 3 = 0, 'third third', ''), if(id IN (3, 41, 2001), 'rare', ''), concat('w', id))"""


def built(spark, folder, kind):
    # Over 32,768 numbers, so that there is more than one bucket.
    number = F.col("id") * 3 - 70
    docs = spark.range(0, 12_000, 1, 8).select((number.cast("string") if kind == "text" else number).alias("doc_id"), F.expr(TEXT).alias("text"))
    ix.build_index(docs, folder)
    ix.build_bitmaps(spark, folder)
    return ix.load_index(spark, folder, bitmaps=True)


@pytest.fixture(scope="module", params=["dense", "text"])
def mapped(request, spark, tmp_path_factory):
    return request.param, built(spark, str(tmp_path_factory.mktemp(request.param)), request.param)


def test_ids_number_themselves_where_they_are_dense(mapped):
    kind, index = mapped
    assert (index.numbering.base is not None) == (kind == "dense")
    assert index.bitmaps.select("bucket").distinct().count() > 1
    assert {r.term for r in index.bitmaps.select("term").distinct().collect()} == {"every", "of", "the", "odd", "even", "third"}


def test_bitmaps_change_no_result(mapped):
    _, index = mapped
    for query in QUERIES:
        assert ordered(ix.search(index, query)) == ordered(ix.search(replace(index, bitmaps=None), query)), query


def test_only_postings_of_results_are_grouped(mapped):
    kind, index = mapped
    terms = ["of", "odd", "third"]
    met = search_module._in_all(index, index.postings_of(terms), terms)
    hits = ix.search(replace(index, bitmaps=None), " ".join(terms))
    assert met.join(hits, "doc_id").count() == 3 * hits.count() > 0
    others = met.join(hits, "doc_id", "left_anti").count()
    # Equal hashes let a few others through.
    assert others == 0 if kind == "dense" else others < index.postings_of(terms).count() / 10
    assert kind != "dense" or search_module._in_all(index, met, ["odd", "even"]).isEmpty()


def test_the_bitmaps_hold_what_the_postings_hold(mapped):
    kind, index = mapped
    counted = {r.term: r.n for r in index.bitmaps.groupBy("term").agg(F.sum(F.bitmap_count("bitmap")).alias("n")).collect()}
    df = index.frequencies(list(counted))
    assert all(counted[t] == df[t] if kind == "dense" else df[t] / 2 < counted[t] <= df[t] for t in counted)


def test_too_many_buckets_are_not_sent(mapped, monkeypatch):
    _, index = mapped
    monkeypatch.setattr(session, "BROADCAST_BYTES", 0)
    rows = index.postings_of(["of", "odd"])
    assert search_module._in_all(index, rows, ["of", "odd"]).count() == rows.count()
    assert ordered(ix.search(index, "of odd")) == ordered(ix.search(replace(index, bitmaps=None), "of odd"))


def test_a_document_without_an_id(spark):
    rows = spark.createDataFrame([("a", 1), ("a", None), ("b", None), ("b", 2)], "term string, doc_id int")
    terms = spark.createDataFrame([("a", 2), ("b", 2)], "term string, df bigint")
    numbering = Numbering.of(rows, 3)
    assert (numbering.base, numbering.span) == (1, 2)
    maps = common_documents(term_bitmaps(rows, terms, numbering), 2)
    assert [r.n for r in maps.select(F.bitmap_count("bitmap").alias("n")).collect()] == [1]


def test_no_term_is_frequent(spark, tmp_path):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), "id").alias("text"))
    ix.build_index(docs, str(tmp_path))
    ix.build_bitmaps(spark, str(tmp_path))
    index = ix.load_index(spark, str(tmp_path), bitmaps=True)
    assert index.bitmaps is None and [r.doc_id for r in ix.search(index, "w7").collect()] == [7]


def test_sparse_ids_are_hashed(spark):
    rows = spark.createDataFrame([("a", -(2**63)), ("b", 2**63 - 1)], "term string, doc_id bigint")
    assert Numbering.of(rows, 2).base is None and Numbering.of(rows, 2).span == 8
    assert Numbering.of(rows.where("false"), 2).base is None
