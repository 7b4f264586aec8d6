import math

import pytest
from conftest import rows
from pyspark.sql import functions as F

import inkdex as ix
from inkdex.operators import joins

L3, L32 = math.log(3), math.log(1.5)
GOLDEN = sorted(
    (term, doc, n, length, df, round(idf, 6), round(n / length * idf, 6))
    for term, doc, n, length, df, idf in [
        ("a", "10", 1, 5, 1, L3),
        ("here", "10", 1, 5, 1, L3),
        ("nontxt", "notes", 1, 2, 1, L3),
        ("of", "1", 2, 7, 1, L3),
        ("other", "notes2", 1, 2, 1, L3),
        ("oz", "1", 2, 7, 2, L32),
        ("oz", "10", 1, 5, 2, L32),
        ("the", "1", 1, 7, 4, 0.0),
        ("the", "10", 1, 5, 4, 0.0),
        ("the", "notes", 1, 2, 4, 0.0),
        ("the", "notes2", 1, 2, 4, 0.0),
        ("wizard", "1", 2, 7, 2, L32),
        ("wizard", "10", 1, 5, 2, L32),
    ]
)
COLUMNS = ["term", "doc_id", "n", "doc_len", "df", "idf", "tfidf"]


def test_stored_index(index):
    assert rows(index.postings, *COLUMNS) == GOLDEN


@pytest.mark.parametrize("hot_keys", [1, 2, 5, 50_000])
def test_index_does_not_depend_on_what_is_hot(docs, hot_keys):
    tf = ix.normalize_tf(ix.term_frequencies(docs))
    assert rows(ix.tfidf_index(tf, 3, hot_keys=hot_keys), *COLUMNS) == GOLDEN


def test_lines_give_the_same_index(spark, corpus):
    lines = ix.read_lines(spark, corpus)
    counts = ix.term_frequencies(lines, whole=False)
    assert counts.columns == ["doc_id", "term", "n"]
    assert rows(ix.tfidf_index(ix.normalize_tf(counts), 3), *COLUMNS) == GOLDEN


def test_document_lengths(spark, corpus, docs):
    expected = [("1", 7), ("10", 5), ("notes", 2), ("notes2", 2)]
    assert rows(ix.document_lengths(docs)) == expected
    assert rows(ix.document_lengths(ix.read_lines(spark, corpus), whole=False)) == expected


def test_count_of_documents_includes_those_without_tokens(docs):
    assert ix.count_documents(docs).first().n_docs == 5


def test_n_docs_as_a_dataframe(docs):
    tf = ix.normalize_tf(ix.term_frequencies(docs))
    by_number = rows(ix.tfidf_index(tf, 5), *COLUMNS)
    assert rows(ix.tfidf_index(tf, ix.count_documents(docs)), *COLUMNS) == by_number


def test_tf_of_a_document_sums_to_one(docs):
    sums = ix.normalize_tf(ix.term_frequencies(docs)).groupBy("doc_id").agg(F.sum("tf").alias("s"))
    assert {round(r.s, 12) for r in sums.collect()} == {1.0}


def test_posting_blocks(index):
    whole = ix.posting_blocks(index.postings)
    assert whole.count() == 8 and {r.n_blocks for r in whole.collect()} == {1}
    small = ix.posting_blocks(index.postings, 1)
    assert {r.term: r.n_blocks for r in small.collect()}["the"] == 4
    flat = rows(index.postings, "term", "doc_id", "tfidf", "df")
    assert rows(ix.flatten_blocks(whole)) == flat == rows(ix.flatten_blocks(small))


def test_vocabulary_size(index):
    assert ix.vocabulary_size(index.postings).first().n_terms == 8


def test_stages_alone(spark, docs, tmp_path):
    out = str(tmp_path)
    first = ix.build_index(docs, out, "job1")
    second = ix.build_index(spark.read.parquet(f"{out}/tokens"), out, "job2")
    third = ix.build_index(spark.read.parquet(f"{out}/index"), out, "job3", n_docs=3)
    assert [(r.stage, r.records_in, r.records_out) for r in first + second + third] == [
        ("job1", 5, 13),
        ("job2", 13, 13),
        ("job3", 13, 13),
    ]
    assert rows(ix.load_index(spark, out).postings, *COLUMNS) == GOLDEN


def test_stage_replaces_its_own_output_only(spark, docs, tmp_path):
    out = str(tmp_path)
    ix.build_index(docs, out, n_docs=3)
    ix.build_index(docs.where("doc_id = '1'"), out, "job1")
    assert spark.read.parquet(f"{out}/tokens").count() == 4
    assert spark.read.parquet(f"{out}/index").count() == 13


def test_bad_arguments(spark, docs, tmp_path):
    with pytest.raises(ValueError):
        ix.build_index(docs, str(tmp_path), "job4")
    with pytest.raises(ValueError):
        ix.build_index(docs, str(tmp_path), "job3")
    with pytest.raises(ValueError):
        ix.build_index(docs.where(F.lit(False)), str(tmp_path))
    with pytest.raises(ValueError):
        ix.build_index(docs.union(docs), str(tmp_path))


def test_build_from_lines(spark, corpus, tmp_path):
    ix.build_index(ix.read_lines(spark, corpus), str(tmp_path), n_docs=3, whole=False)
    index = ix.load_index(spark, str(tmp_path))
    assert rows(index.postings, *COLUMNS) == GOLDEN
    assert rows(index.vocabulary, "term", "df") == rows(ix.document_frequencies(index.postings))


def test_index_is_laid_out_by_shard(spark, docs, tmp_path, monkeypatch):
    from inkdex.plans import build

    monkeypatch.setattr(build, "SHARD_POSTINGS", 2)
    ix.build_index(docs, str(tmp_path), n_docs=3)
    index = ix.load_index(spark, str(tmp_path))
    assert index.shards == 7
    assert rows(index.postings, *COLUMNS) == GOLDEN
    plan = index.postings_of(["wizard"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan or "PartitionFilters: [(shard" in plan
    assert "EqualTo(term,wizard)" in plan
    assert rows(ix.search(index, "wizard oz"), "doc_id") == [("1",), ("10",)]
    assert index.postings_of(["wizard"]).count() == 2


def test_join_by_weight_is_a_join(spark):
    left = spark.createDataFrame([(k, v) for k in "aaaaaabbc" for v in range(3)], "k string, v int")
    keyed = left.groupBy("k").agg(F.count(F.lit(1)).alias("w"))
    keyed = keyed.unionByName(spark.createDataFrame([("zz", 0)], "k string, w bigint"))
    expected = rows(left.join(keyed, "k"), "k", "v", "w")
    for hot in (1, 2, 3, 100):
        assert rows(joins.join_by_weight(left, keyed, "k", "w", hot), "k", "v", "w") == expected


def test_join_blocks_is_a_join(spark):
    left = spark.range(40).select(F.when(F.col("id") < 30, "a").otherwise("b").alias("k"), F.col("id").alias("l"))
    right = spark.range(50).select(F.when(F.col("id") < 45, "a").otherwise("c").alias("k"), F.col("id").alias("r"))
    a = left.groupBy("k").agg(F.count(F.lit(1)).alias("n_left"))
    b = right.groupBy("k").agg(F.count(F.lit(1)).alias("n_right"))
    counts = a.join(b, "k")
    expected = rows(left.join(right, "k"), "k", "l", "r")
    for size in (1, 4, 1000):
        found = joins.join_blocks(left.join(counts, "k"), right.join(counts, "k"), "k", ("n_left", "l"), ("n_right", "r"), size)
        assert rows(found, "k", "l", "r") == expected


def test_what_follows_from_a_posting_is_not_exchanged(spark, monkeypatch, docs, tmp_path):
    """The weights are worked out where the postings are written."""
    from inkdex.plans import build

    seen, write = [], build._lay_out
    monkeypatch.setattr(build, "_lay_out", lambda rows, *more: (seen.append(rows.columns), write(rows, *more)))
    build.build_index(docs, str(tmp_path), n_docs=3)
    assert seen == [["term", "doc_id", "n", "doc_len", "tf", "df"]]
    stored = build.load_index(spark, str(tmp_path)).postings
    assert stored.columns == ["term", "doc_id", "n", "doc_len", "tf", "df", "idf", "tfidf", "shard"]
    assert stored.where("tfidf <> tf * idf OR idf <> greatest(0.0D, ln(3.0D / df))").isEmpty() and not stored.isEmpty()


def test_tf_of_own_rows_is_not_exchanged(spark, monkeypatch, docs, tmp_path):
    """A frequency that another stage gave may be any number, and is stored as it is."""
    from pyspark.sql.classic.dataframe import DataFrame

    from inkdex.plans import build

    seen, hint = [], DataFrame.hint
    monkeypatch.setattr(DataFrame, "hint", lambda df, *more: (seen.append(df.columns), hint(df, *more))[1])
    build.build_index(docs, str(tmp_path), n_docs=3)
    assert seen == [["term", "doc_id", "n", "doc_len", "df", "lot"]]
    own = spark.read.parquet(f"{tmp_path}/index").withColumn("tf", F.col("tf") + 1)
    build.build_index(own, str(tmp_path), "job3", 3)
    stored = build.load_index(spark, str(tmp_path)).postings
    assert rows(stored, "term", "doc_id", "tf") == rows(own, "term", "doc_id", "tf")
    assert stored.where("tfidf <> tf * idf").isEmpty()


def test_stored_parts_are_zstd(spark, docs, tmp_path):
    import pyarrow.parquet as pq

    ix.build_index(docs, str(tmp_path), n_docs=3)
    ix.build_positions(docs, str(tmp_path))
    ix.build_store(docs, str(tmp_path))
    for part in ("tokens", "index", "tfidf", "positions", "documents"):
        files = [pq.ParquetFile(file).metadata for file in (tmp_path / part).rglob("*.parquet")]
        assert {file.row_group(0).column(0).compression for file in files if file.num_row_groups} == {"ZSTD"}
