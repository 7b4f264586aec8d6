"""Documents stored by id, against the table they were stored from."""

import os
import random
import time

import pytest
from conftest import ordered, rows
from pyspark.sql import functions as F
from test_search import PHRASE

import inkdex as ix
from inkdex import session
from inkdex.plans import build as build_module
from inkdex.sources import stage_text
from inkdex.sources import store as store_module


def made(spark, n=400):
    texts = [(i, f"Title: Book {i}\nof the text {i % 7}" if i % 9 else " \n\t") for i in range(n)]
    return spark.createDataFrame([*texts, (None, "no id"), (n, None), (n + 1, ""), (5, "again")], "doc_id bigint, text string")


@pytest.fixture(scope="module")
def table(spark):
    return made(spark).cache()


@pytest.fixture(scope="module")
def store(spark, table, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("store"))
    ix.build_store(table, out, shards=16)
    return ix.load_store(spark, out)


def test_every_row_is_kept(table, store):
    assert sorted(store.rows.select("doc_id", "text").collect(), key=str) == sorted(table.collect(), key=str)


@pytest.mark.parametrize("ids", [[3], [5, 9, 3, 3, None], [], [99999], list(range(0, 400, 20)), list(range(300)), [400, 401]])
def test_fetch_equals_the_scan(spark, table, store, ids):
    def plain(df):
        return sorted(map(str, df.select("doc_id", "text", "is_blank").collect()))

    as_table = spark.createDataFrame([(i,) for i in ids], "doc_id bigint")
    expected = plain(ix.fetch_documents(table, as_table))
    assert plain(ix.fetch_documents(store, ids)) == plain(ix.fetch_documents(store, as_table)) == expected


def test_many_ids_without_broadcast(spark, table, store, monkeypatch):
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    ids = table.select("doc_id")
    found = store.fetch(ids).select("doc_id", "text").collect()
    assert sorted(found, key=str) == sorted(table.where("doc_id IS NOT NULL").collect(), key=str)


def explained(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_fetch_reads_only_its_directories(spark, store):
    plan = explained(store.fetch(list(range(20))))
    assert "PartitionFilters" in plan and "shard" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "Or(EqualTo(doc_id,2),EqualTo(doc_id,3))" in plan and "Exchange" not in plan
    few = explained(store.fetch(spark.createDataFrame([(3,), (7,)], "doc_id bigint")))
    assert "BroadcastHashJoin" in few and "SortMergeJoin" not in few and "hashpartitioning" not in few
    one = store.fetch([3])
    assert len(one.collect()) == 1
    scan = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().apply("numFiles").value() == 1 < len(store.rows.inputFiles())


def test_heads_read_no_text(store):
    plan = explained(store.heads([3, 5]))
    assert "ReadSchema: struct<doc_id:bigint,head:string>" in plan
    assert rows(store.heads([3])) == [(3, "Title: Book 3\nof the text 3")]


def test_text_ids(spark, tmp_path):
    table = spark.createDataFrame([("1", "a"), ("01", "b"), ("x" * 3000, "c"), ("", "d")], "doc_id string, text string")
    ix.build_store(table, str(tmp_path), shards=4)
    store = ix.load_store(spark, str(tmp_path))
    assert rows(store.fetch(["1", "", "x" * 3000]), "text") == [("a",), ("c",), ("d",)]


def test_clashing_columns_are_left_out(spark, tmp_path):
    table = spark.createDataFrame([(1, "a", 9, "h", True)], "doc_id bigint, text string, shard int, head string, is_blank boolean")
    ix.build_store(table, str(tmp_path))
    assert rows(ix.load_store(spark, str(tmp_path)).fetch([1])) == [(1, "a", False)]


def test_empty_table(spark, tmp_path):
    ix.build_store(made(spark).limit(0), str(tmp_path), shards=2)
    rows_ = spark.createDataFrame([], "doc_id bigint, head string, is_blank boolean, text string, shard int")
    assert store_module.DocumentStore(rows_, 2).fetch([1, 2]).collect() == []


def test_documents_of_several_rows(spark, tmp_path):
    lines = spark.createDataFrame([(1, n, f"line {n}") for n in range(50)] + [(2, 0, "x")], "doc_id bigint, part int, text string")
    ix.build_store(lines, str(tmp_path), shards=3)
    store = ix.load_store(spark, str(tmp_path))
    assert rows(store.fetch([1]), "part", "text") == sorted((n, f"line {n}") for n in range(50))
    titles = spark.createDataFrame([], "doc_id string, title string")
    results = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    assert rows(ix.found_titles(results, titles, store)) == rows(ix.found_titles(results, titles, lines))


@pytest.fixture(scope="module")
def golden_store(spark, docs, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("golden"))
    ix.build_store(docs, out, shards=4)
    return ix.load_store(spark, out)


@pytest.mark.parametrize("query", list(PHRASE))
def test_phrase_search_reads_hits_only(index, golden_store, query):
    assert ordered(ix.phrase_search(index, golden_store, query)) == PHRASE[query]


def test_batch_reads_hits_only(spark, index, golden_store):
    queries = spark.createDataFrame(list(enumerate(PHRASE)), "query_id bigint, query string")
    expected = sorted((n, *hit) for n, query in enumerate(PHRASE) for hit in PHRASE[query])
    assert rows(ix.phrase_search_batch(index, golden_store, queries)) == expected


def test_titles_from_heads(spark, table, store):
    titles = spark.createDataFrame([("3", "known")], "doc_id string, title string")
    results = spark.createDataFrame([(i, 1.0) for i in range(3, 40)], "doc_id bigint, score double").where("doc_id <> 5")
    once = table.where("doc_id <> 5")
    assert rows(ix.resolve_titles(results, titles, store)) == rows(ix.resolve_titles(results, titles, once))


def batch(spark, texts, phrases):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    queries = spark.createDataFrame(list(enumerate(phrases)), "query_id bigint, query string")
    results = queries.crossJoin(docs.select("doc_id"))  # a handful of rows: every query has every document as a result
    expected = sorted(
        (q, *row) for q, phrase in enumerate(phrases) for row in rows(ix.match_offsets(docs, phrase))
    )
    return docs, queries, results, expected


def test_batch_of_offsets_equals_single_queries(spark, monkeypatch):
    draw = random.Random(7)
    texts = ["".join(draw.choice(["a", "B", "ab", " ", "_", "é", "𝄞", "\n", ". ", "İ"]) for _ in range(60)) for _ in range(6)] + ["", None, "a"]
    docs, queries, results, expected = batch(spark, texts, ["a", "a a", "a b a", "b", "", "a b", "zzz", "A a", None])
    assert rows(ix.match_offsets_batch(results, docs, queries)) == expected and len(expected) > 30
    assert rows(ix.match_offsets_batch(results.union(results), docs, queries, block_matches=2)) == expected
    positions = ix.Index(None, None, positions=ix.term_positions(docs).cache())
    assert rows(ix.match_offsets_batch(results, docs, queries, positions)) == expected
    monkeypatch.setattr(session, "BROADCAST_BYTES", -1)
    assert rows(ix.match_offsets_batch(results, docs, queries)) == expected


def test_batch_of_offsets_in_a_long_text(spark, tmp_path):
    text = " ".join(f"w{n % 100} é" for n in range(30_000))
    docs, queries, results, expected = batch(spark, [text, "w5"], ["w5", "w99 w0"])
    ix.build_store(docs, str(tmp_path))
    found = ix.match_offsets_batch(results, ix.load_store(spark, str(tmp_path)), queries)
    assert rows(found) == expected and len(expected) > 500


def test_batch_of_offsets_refuses_parts(spark):
    lines = spark.createDataFrame([(1, 0, "x")], "doc_id bigint, part int, text string")
    with pytest.raises(ValueError):
        ix.match_offsets_batch(lines, lines, lines)


def test_long_terms_have_many_lines(spark, index, tmp_path):
    blocks = ix.posting_blocks(index.postings, 1)
    ix.write_postings_text(blocks, str(tmp_path))
    lines = [r.value for r in spark.read.text(str(tmp_path)).collect()]
    assert any(line.endswith("/2") for line in lines) and len(lines) == blocks.count()
    expected = rows(index.postings, "term", "doc_id", "tfidf")
    assert rows(ix.read_postings_text(spark, str(tmp_path)), "term", "doc_id", "tfidf") == expected
    with pytest.raises(Exception, match="cannot hold"):
        ix.write_postings_text(blocks.withColumn("term", F.lit("a\tb")), f"{tmp_path}/bad")


def test_the_last_export_of_a_term_counts(spark, tmp_path):
    for name, lines in {
        "a": ["x\t1:0.5,2:0.25\t0/2", "x\t3:1.0\t1/2", "y\t1:1.0\t0/2", "y\t2:1.0\t1/2", "z\t1:1.0"],
        "b": ["x\t4:2.0\t1/2", "y\t5:3.0", "z\t7:bad,8:1.5\t0/2", "z\t9:1.0,9:4.0\t1/2", "w\t1:1.0\t1/x"],
    }.items():
        (tmp_path / name).write_text("\n".join(lines))
    found = rows(ix.read_postings_text(spark, str(tmp_path)))
    assert found == [("x", "1", 0.5), ("x", "2", 0.25), ("x", "4", 2.0), ("y", "5", 3.0), ("z", "8", 1.5), ("z", "9", 4.0)]


def test_import(spark, index, tmp_path):
    ix.write_postings_text(ix.posting_blocks(index.postings, 1), f"{tmp_path}/text")
    ix.import_index(spark, f"{tmp_path}/text", f"{tmp_path}/index", n_docs=3)
    stored = ix.load_index(spark, f"{tmp_path}/index")
    for query in ("wizard", "oz the", "the zzz", ""):
        assert ordered(ix.search(stored, query)) == ordered(ix.search(index, query))
    assert rows(stored.vocabulary) == rows(index.vocabulary)


def test_import_of_nothing_or_of_other_ids(spark, tmp_path):
    (tmp_path / "t").write_text("term\tno score\n")
    with pytest.raises(ValueError):
        ix.import_index(spark, str(tmp_path / "t"), f"{tmp_path}/index")
    (tmp_path / "u").write_text("term\ta1:0.5\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ix.import_index(spark, str(tmp_path / "u"), f"{tmp_path}/index", id_type="bigint")


def test_a_failed_build_leaves_the_index_as_it_is(spark, docs, tmp_path, monkeypatch):
    out = str(tmp_path)
    with pytest.raises(ValueError):
        ix.current_snapshot(spark, out)
    first = ix.build_snapshot(docs, out, n_docs=3, positions=True, bounds=True, store=True)
    index = ix.load_index(spark, ix.current_snapshot(spark, out), positions=True, bounds=True)
    before = ordered(ix.search(index, "oz"))
    new = docs.where("doc_id = '1'")

    def stopped(*_):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(build_module, "_write_postings", stopped)
        with pytest.raises(RuntimeError):
            ix.build_snapshot(new, out)
    assert ix.current_snapshot(spark, out) == first
    assert ordered(ix.search(ix.load_index(spark, first), "oz")) == before
    second = ix.build_snapshot(new, out)
    assert ix.current_snapshot(spark, out) == second != first
    assert len(ordered(ix.search(ix.load_index(spark, second), "oz"))) == 1
    # A search that began before goes on, and one can go back.
    assert ordered(ix.search(index, "oz")) == before
    assert rows(ix.load_store(spark, first).fetch(["1"]), "doc_id") == [("1",)]
    ix.publish_snapshot(spark, out, first)
    assert ix.current_snapshot(spark, out) == first


def test_entries_of_an_export_are_exchanged_only_where_they_compete(spark, tmp_path):
    """Exports of ids of each type as they were written need no exchange; terms whose blocks, lines or entries repeat a document do."""
    for kind in ("string", "bigint", "int"):
        rows_ = spark.range(300).select(F.lit("w").alias("term"), F.col("id").cast(kind).alias("doc_id"), (F.col("id") / 7).alias("tfidf"))
        blocks = ix.posting_blocks(rows_.withColumn("df", F.lit(300).cast("bigint")), 50)
        ix.write_postings_text(blocks, f"{tmp_path}/{kind}", "gzip")
        assert all(name.endswith(".gz") for name in os.listdir(f"{tmp_path}/{kind}") if name.startswith("part-"))
        found, plain = stage_text.postings_of_text(spark, f"{tmp_path}/{kind}")
        assert plain and rows(found) == rows(rows_.withColumn("doc_id", F.col("doc_id").cast("string")))
        assert "ShuffleExchange" not in _after_running(found)
    lines = ["a\t1:0.5,2:0.25", "b\t1:1.0,1:2.0", "c\t1:1.0,2:1.0\t0/2", "c\t1:3.0\t1/2", "d\t1:1.0", "d\t2:1.0", "e\t5:1.0\t3/0", "f\t1:2.0\t7/1"]
    (tmp_path / "odd").mkdir()
    (tmp_path / "odd" / "t").write_text("\n".join(lines))
    found, plain = stage_text.postings_of_text(spark, f"{tmp_path}/odd")
    hashes = {r.term_hash for r in stage_text._contested(stage_text._posting_lines(spark, f"{tmp_path}/odd")).collect()}
    named = {r.term for r in spark.createDataFrame([(t,) for t in "abcdef"], "term string").collect() if xxhash(spark, r.term) in hashes}
    assert not plain and {"b", "c", "d"} <= named and "a" not in named
    want = [("a", "1", 0.5), ("a", "2", 0.25), ("b", "1", 2.0), ("c", "1", 3.0), ("c", "2", 1.0), ("d", "2", 1.0), ("e", "5", 1.0), ("f", "1", 2.0)]
    assert rows(found) == want


def xxhash(spark, text):
    return spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]


def _after_running(df):
    """Plan of a DataFrame as adaptive execution left it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


def test_exchanges_do_not_outlive_what_is_stored(spark, docs, tmp_path, monkeypatch):
    """Exchanges of an import are removed step by step, nothing of it is stored twice, and the setting is as before."""
    before = spark.conf.get(session.FREE_EXCHANGES, None)
    seen = []
    settle = build_module.settle
    monkeypatch.setattr(build_module, "settle", lambda df, purpose="settled": seen.append(purpose) or settle(df, purpose))
    ix.build_index(docs, f"{tmp_path}/own", n_docs=3)
    blocks = ix.posting_blocks(spark.read.parquet(f"{tmp_path}/own/tfidf"), 1)
    ix.write_postings_text(blocks, f"{tmp_path}/text")
    held = _exchange_files(spark)
    ix.import_index(spark, f"{tmp_path}/text", f"{tmp_path}/index")
    for _ in range(50):  # removed by a thread of its own
        if _exchange_files(spark) <= held:
            break
        time.sleep(0.2)
    assert _exchange_files(spark) <= held and "imported" not in seen
    assert spark.conf.get(session.FREE_EXCHANGES, None) == before
    want = [(r.term, r.doc_id) for r in ix.load_index(spark, f"{tmp_path}/own").postings.orderBy("term", "doc_id").collect()]
    assert want == [(r.term, r.doc_id) for r in ix.load_index(spark, f"{tmp_path}/index").postings.orderBy("term", "doc_id").collect()]


def _exchange_files(spark):
    """Files of exchanges on the disks of a local session."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum(os.path.basename(file).startswith("shuffle_") for file in files.split("\n"))
