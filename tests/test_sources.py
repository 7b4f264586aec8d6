import os

import pytest
from conftest import GOLDEN_FILES, rows
from pyspark.sql import functions as F

import inkdex as ix
from inkdex.session import settle, settle_sized, shared_dir


def write(folder, name, *lines):
    (folder / name).write_text("\n".join(lines), encoding="utf-8")
    return str(folder / name)


def test_whole_and_lines(spark, corpus, docs):
    names = {n.removesuffix(".txt"): t for n, t in GOLDEN_FILES.items()}
    assert dict(rows(docs)) == names
    lines = rows(ix.read_lines(spark, corpus), "doc_id", "text")
    assert ("1", "The Wizard of Oz") in lines and ("1", "WIZARD, of: oz!") in lines and len(lines) == 6


def test_names_with_special_characters(spark, tmp_path):
    for name in ("g +h.txt", "a b.txt", "x%41.txt"):
        write(tmp_path, name, "text")
    assert [r[0] for r in rows(ix.read_whole(spark, str(tmp_path)), "doc_id")] == ["a b", "g +h", "x%41"]
    manifest = ix.corpus_manifest(spark, str(tmp_path))
    assert [r[0] for r in rows(manifest, "name")] == ["a b.txt", "g +h.txt", "x%41.txt"]
    assert [r[0] for r in rows(ix.read_whole(spark, str(tmp_path), limit=2), "doc_id")] == ["a b", "g +h"]


def test_limit_takes_the_first_txt_files_by_name(spark, corpus):
    assert [r[0] for r in rows(ix.read_whole(spark, corpus, limit=2), "doc_id")] == ["1", "10"]
    assert {r[0] for r in rows(ix.read_lines(spark, corpus, limit=2), "doc_id")} == {"1", "10"}
    assert len(rows(ix.read_whole(spark, corpus, limit=ix.PRESETS["small"]))) == 3
    assert len(rows(ix.read_whole(spark, corpus, limit=ix.PRESETS["all"]))) == 5


def test_limit_without_documents(spark, tmp_path):
    write(tmp_path, "notes", "x")
    with pytest.raises(ValueError):
        ix.read_whole(spark, str(tmp_path), limit=3)


def test_first_documents(docs):
    assert [r[0] for r in rows(ix.first_documents(docs, 2), "doc_id")] == ["1", "10"]
    assert ix.first_documents(docs, None).count() == 5


def test_manifest(spark, corpus):
    found = rows(ix.corpus_manifest(spark, corpus), "type", "name", "length")
    assert found == sorted(("FILE", n, len(t)) for n, t in GOLDEN_FILES.items())


def test_fetch(spark, docs):
    found = rows(ix.fetch_documents(docs, ["1", "2"]), "doc_id", "is_blank")
    assert found == [("1", False), ("2", False)]
    blank = spark.createDataFrame([(1, " \n\t"), (2, "x")], "doc_id bigint, text string")
    assert rows(ix.fetch_documents(blank, blank.select("doc_id")), "doc_id", "is_blank") == [(1, True), (2, False)]


def test_tokens_text(spark, tmp_path):
    path = write(
        tmp_path, "t", "nodelimiter", "word@1\tabc", "a@b@7\t2", "word@2\t3\tmore", "noat\t4", "word@3\t", "word@4\t 5"
    )
    assert rows(ix.read_tokens_text(spark, path)) == [("2", "word", 3), ("7", "a@b", 2)]


def test_tf_text(spark, tmp_path):
    path = write(tmp_path, "t", "nodelimiter", "w\t1=0.5", "w\t1=x", "w\tnothing", "w\ta=b=0.25", "v\t", "v\t2=1.0E-2")
    tf = ix.read_tf_text(spark, path)
    assert rows(tf.where("tf is not null")) == [("v", "2", 0.01), ("w", "1", 0.5), ("w", "a=b", 0.25)]
    assert rows(ix.document_frequencies(tf)) == [("v", 1), ("w", 4)]
    index = ix.tfidf_index(tf, 8)
    assert rows(index, "term", "doc_id", "tf", "df") == [("v", "2", 0.01, 1), ("w", "1", 0.5, 4), ("w", "a=b", 0.25, 4)]


def test_postings_text(spark, tmp_path):
    path = write(
        tmp_path, "t", "nodelimiter", "w\t9:9.0", "w\t1:0.5,2:bad,3", "v\t1:0.5,1:0.7", "u\ta:b:1.0E-3,,:2", "e\t", "\t1:1.0"
    )
    expected = [("", "1", 1.0), ("u", "", 2.0), ("u", "a:b", 0.001), ("v", "1", 0.7), ("w", "1", 0.5)]
    assert rows(ix.read_postings_text(spark, path)) == expected


def test_text_round_trips(spark, docs, index, tmp_path):
    counts = ix.term_frequencies(docs)
    ix.write_tokens_text(counts, str(tmp_path / "tokens"))
    tokens = ix.read_tokens_text(spark, str(tmp_path / "tokens"))
    assert rows(tokens) == rows(counts, "doc_id", "term", "n")
    tf = ix.normalize_tf(tokens)
    ix.write_tf_text(tf, str(tmp_path / "tf"))
    read = ix.read_tf_text(spark, str(tmp_path / "tf"))
    assert sorted(map(tuple, read.collect())) == sorted(map(tuple, tf.select("term", "doc_id", "tf").collect()))
    assert rows(ix.tfidf_index(read, 3), "term", "doc_id", "tfidf") == rows(index.postings, "term", "doc_id", "tfidf")


def test_postings_file_is_in_term_order(spark, index, tmp_path):
    ix.write_postings_text(ix.posting_blocks(index.postings), str(tmp_path / "p"))
    for name in os.listdir(tmp_path / "p"):
        if name.startswith("part"):
            terms = [line.split("\t")[0] for line in (tmp_path / "p" / name).read_text().splitlines()]
            assert terms == sorted(terms)


def test_titles(spark, tmp_path):
    path = write(
        tmp_path,
        "titles.json",
        "﻿{",
        '"1": "First",',
        '  "2" : "Second: a "quoted" one",',
        '"3": "",',
        '"4": unquoted,',
        '"5" "no colon"',
        '"1": "Last wins"',
        "}",
    )
    assert rows(ix.read_titles(spark, path)) == [("1", "Last wins"), ("2", 'Second: a "quoted" one')]
    again = str(tmp_path / "again")
    ix.write_titles(ix.read_titles(spark, path), again)
    assert rows(ix.read_titles(spark, again)) == rows(ix.read_titles(spark, path))


def test_resolve_titles(spark):
    docs = spark.createDataFrame(
        [(1, "Title: From text\n"), (2, "Title: Header two,\nx"), (3, "no header")], "doc_id bigint, text string"
    )
    results = spark.createDataFrame([(1, 0.5), (2, 0.25), (3, 0.1), (4, 0.0)], "doc_id bigint, score double")
    titles = spark.createDataFrame([("1", "From dictionary")], "doc_id string, title string")
    shown = ix.as_displayed(ix.resolve_titles(results, titles, docs))
    assert rows(shown, "doc_id", "title", "score_text") == [
        (1, "From dictionary", "0.500000"),
        (2, "Header two", "0.250000"),
        (3, "Book #3", "0.100000"),
        (4, "Book #4", "0.000000"),
    ]
    found = ix.found_titles(results, titles, docs)
    assert rows(ix.remember_titles(titles, found)) == [("1", "From dictionary"), ("2", "Header two")]


class FakeSession:
    """A session of which only the folder settings matter."""

    def __init__(self, setting, master):
        self.conf = self.sparkContext = self
        self.setting, self.master, self.checkpoint = setting, master, None

    def get(self, name, default):
        return self.setting if name == "spark.checkpoint.dir" else default

    def getCheckpointDir(self):
        return self.checkpoint

    def setCheckpointDir(self, folder):
        self.checkpoint = folder


def test_shared_dir():
    assert shared_dir(FakeSession("s3a://shared/folder/", "yarn")) == "s3a://shared/folder"
    local = FakeSession(None, "local[4]")
    assert shared_dir(local) == shared_dir(local) == local.checkpoint
    with pytest.raises(ValueError):
        shared_dir(FakeSession(None, "yarn"))


def test_settle(spark):
    stored, small = settle_sized(spark.range(3).withColumn("t", F.lit("x")))
    assert small and stored.count() == 3 and settle(stored.limit(0)).columns == ["id", "t"]


def test_lines_joined_are_whole_documents(spark, corpus):
    joined = rows(ix.join_lines(ix.read_lines(spark, corpus)))
    assert joined == rows(ix.read_whole(spark, corpus))
    assert [r[3:5] for r in rows(ix.match_offsets(ix.join_lines(ix.read_lines(spark, corpus)), "oz wizard"))] == [(14, 23)]


def test_lines_are_not_indexed_as_documents(spark, corpus, tmp_path):
    with pytest.raises(ValueError):
        ix.build_index(ix.read_lines(spark, corpus), str(tmp_path), n_docs=2)
    with pytest.raises(ValueError):
        ix.build_index(ix.read_lines(spark, corpus), str(tmp_path), "job1")


def test_writers_lose_nothing(spark, tmp_path):
    """What a format cannot hold stops the job; what it can comes back, counts beyond 32 bits too."""
    good = spark.createDataFrame([("a:b,c", "the", 3_000_000_000)], "doc_id string, term string, n bigint")
    ix.write_tokens_text(good, str(tmp_path / "t"))
    assert rows(ix.read_tokens_text(spark, str(tmp_path / "t")), "doc_id", "term", "n") == [("a:b,c", "the", 3_000_000_000)]
    for bad in ("c\td", "c@d", "c\nd"):
        with pytest.raises(Exception, match="cannot hold"):
            ix.write_tokens_text(good.withColumn("doc_id", F.lit(bad)), str(tmp_path / "bad"))
    blocks = spark.createDataFrame([("w", 0, [("a,b", 0.5)])], "term string, block int, postings array<struct<doc_id:string,tfidf:double>>")
    with pytest.raises(Exception, match="cannot hold"):
        ix.write_postings_text(blocks, str(tmp_path / "bad"))
    for title in (("1", "two\nlines"), ('a"b', "title")):
        with pytest.raises(Exception, match="cannot hold"):
            ix.write_titles(spark.createDataFrame([title], "doc_id string, title string"), str(tmp_path / "bad"))


def test_lines_of_postings_are_not_exchanged(spark, tmp_path):
    """Of lines that come once only entries are, without a sort; of a block that comes again the last line counts."""
    (tmp_path / "a").write_text("x\t1:0.5,2:0.25\ny\t1:0.5\t0/2\ny\t3:1.5\t1/2\n")
    plan = ix.read_postings_text(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan and "max_by(entries" not in plan
    (tmp_path / "b").write_text("x\t1:0.75\ny\t1:NaN,1:nan,4:1e-3,a:b:2\t0/2\n")
    found = {(r.term, r.doc_id): str(r.tfidf) for r in ix.read_postings_text(spark, str(tmp_path)).collect()}
    assert found == {("x", "1"): "0.75", ("y", "1"): "nan", ("y", "4"): "0.001", ("y", "a:b"): "2.0", ("y", "3"): "1.5"}


def test_special_lines_of_frequencies(spark, tmp_path):
    (tmp_path / "a").write_text("t\ta=b=0.5\t\t\nu\t\t\nv\t1=\nw\t2=Infinity\nx\t=1\ny\t3=inf\nz\t4=nothing\n")
    found = {r.term: (r.doc_id, r.tf) for r in ix.read_tf_text(spark, str(tmp_path)).collect()}
    assert found == {"t": ("a=b", 0.5), "v": ("1", None), "w": ("2", float("inf")), "x": ("", 1.0), "y": ("3", None), "z": ("4", None)}
