"""Registered queries and the SQL they are checked against."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import inkdex as ix
from inkdex.functions.headers import head, untitled
from inkdex.functions.text import doc_id_from_file_name
from inkdex.operators.search import query_terms as cut_queries
from inkdex.session import new_folder, settle

try:
    import corpus_pipeline
    import inkdex.llm.queries as llm
except ModuleNotFoundError as missing:  # the subpackage, its pipeline, and what they alone import are optional
    if missing.name.split(".")[0] == "inkdex" and not missing.name.startswith("inkdex.llm"):
        raise
    warnings.warn(f"queries of inkdex.llm are left out: no module {missing.name}", stacklevel=1)
    corpus_pipeline = llm = None

TESTDATA = "/root/testdata/sf0.001"

# Derived data is stored once per application and input folder, as a user would build an index once
# and query it many times.
_stored: dict[tuple, object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make: Callable):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = make()
    return _stored[key]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ix.read_table(spark, f"{sf_dir}/documents.parquet")


def _built(spark: SparkSession, sf_dir: str) -> tuple[str, list]:
    """Folder of the index of the documents, and the runs of its stages."""

    def make():
        out = new_folder(spark, "documents")
        return out, ix.build_index(_documents(spark, sf_dir), out)

    return _once(spark, sf_dir, "index", make)


def _index(spark: SparkSession, sf_dir: str) -> ix.Index:
    return ix.load_index(spark, _built(spark, sf_dir)[0])


def _tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_built(spark, sf_dir)[0]}/index")


def _text_files(spark: SparkSession, sf_dir: str) -> str:
    """Folder of text files that hold the texts of all documents."""

    def make():
        out = new_folder(spark, "files")
        _documents(spark, sf_dir).select("text").write.text(out)
        return out

    return _once(spark, sf_dir, "files", make)


def _titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary file of the pages, read back: ids and addresses."""

    def make():
        out = new_folder(spark, "titles")
        pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
        ix.write_titles(pages.select(F.col("page_id").alias("doc_id"), F.col("url").alias("title")), out)
        return out

    return ix.read_titles(spark, _once(spark, sf_dir, "titles", make))


def _with_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with book headers of six forms before their own text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = F.concat_ws(" ", "source", "lang", F.col("doc_id").cast("string"))
    header = (
        F.when(F.col("doc_id") % 6 == 0, F.concat(F.lit("Title: "), name, F.lit(",\nAuthor: Nobody\n\n")))
        .when(F.col("doc_id") % 6 == 1, F.concat(F.lit("TITLE: "), name, F.lit(" Author: Nobody title: no\n")))
        .when(F.col("doc_id") % 6 == 2, F.concat(F.lit("x TiTle:"), name, F.lit("\r\nLanguage: en\n")))
        .when(F.col("doc_id") % 6 == 3, F.concat(F.lit("The Project Gutenberg EBook of "), name, F.lit(" This eBook is")))
        .when(F.col("doc_id") % 6 == 4, F.concat(F.lit("Title: \nThe Project Gutenberg eBook of "), name, F.lit("\n")))
        .otherwise(F.lit(""))
    )
    return docs.select("doc_id", F.concat(header, "text").alias("text"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Logarithms and sums differ in the last bit between engines."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


# Hand-written queries: an AND query, a single term, an unknown term, repeats, quotes, and blanks.
QUERIES = [
    (1, "of the"),
    (2, "license"),
    (3, "the la zzzunknown"),
    (4, "zzzunknown"),
    (5, ""),
    (6, "the the of"),
    (7, '"and of the"'),
    (8, " ,;- "),
]


def _queries(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(QUERIES, "query_id bigint, query string")


def _benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return items.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def entry(spark: SparkSession) -> DataFrame:
    """Index the documents and search them."""
    return ix.search(_index(spark, TESTDATA), "of the")


def term_frequency(spark, sf_dir):
    return ix.term_frequencies(_documents(spark, sf_dir)).select("doc_id", "term", "n")


def term_frequency_by_parts(spark, sf_dir):
    """Documents of several rows: a conversation is a document, a turn is a row."""
    turns = ix.read_table(spark, f"{sf_dir}/conversations.parquet", "conv_id")
    return ix.term_frequencies(turns, whole=False)


def doc_length(spark, sf_dir):
    return ix.document_lengths(_documents(spark, sf_dir))


def normalized_tf(spark, sf_dir):
    return _rounded(ix.normalize_tf(ix.term_frequencies(_documents(spark, sf_dir))), "tf")


def normalized_tf_by_parts(spark, sf_dir):
    """The document length is not at hand and has to be summed and joined."""
    turns = ix.read_table(spark, f"{sf_dir}/conversations.parquet", "conv_id")
    return _rounded(ix.normalize_tf(settle(ix.term_frequencies(turns, whole=False))), "tf")


def document_frequency(spark, sf_dir):
    return ix.document_frequencies(_tf(spark, sf_dir))


def corpus_count(spark, sf_dir):
    return ix.count_documents(_documents(spark, sf_dir))


def tfidf_index(spark, sf_dir):
    postings = _index(spark, sf_dir).postings.drop("shard")
    return _rounded(postings, "tf", "idf", "tfidf")


def tfidf_index_small_n(spark, sf_dir):
    """A given N below the frequency of many terms, so that idf is held at zero."""
    return _rounded(ix.tfidf_index(_tf(spark, sf_dir), 100), "tf", "idf", "tfidf")


def tfidf_index_pages(spark, sf_dir):
    """Another corpus, with N as a one-row DataFrame, and no stored vocabulary."""
    pages = ix.read_table(spark, f"{sf_dir}/pages.parquet", "page_id", "html")
    tf = settle(ix.normalize_tf(ix.term_frequencies(pages)))
    return _rounded(ix.tfidf_index(tf, ix.count_documents(pages)), "tf", "idf", "tfidf")


def tfidf_index_preset(spark, sf_dir):
    """The corpus cut to its small size before indexing."""
    limit = ix.PRESETS["small"]
    docs = ix.first_documents(_documents(spark, sf_dir), limit)
    tf = settle(ix.normalize_tf(ix.term_frequencies(docs)))
    return _rounded(ix.tfidf_index(tf, ix.count_documents(docs)), "tf", "idf", "tfidf")


def limited_corpus(spark, sf_dir):
    return ix.first_documents(_documents(spark, sf_dir), 100)


def postings(spark, sf_dir):
    blocks = ix.posting_blocks(_index(spark, sf_dir).postings)
    ids = F.transform("postings.doc_id", lambda d: d.cast("string"))
    return blocks.select("term", "block", "n_blocks", "df", F.array_join(ids, ",").alias("doc_ids"))


def postings_flat(spark, sf_dir):
    return _rounded(ix.flatten_blocks(ix.posting_blocks(_index(spark, sf_dir).postings, 100)), "tfidf")


def postings_roundtrip(spark, sf_dir):
    """Text export of the index, imported again."""

    def make():
        out = new_folder(spark, "postings")
        ix.write_postings_text(ix.posting_blocks(_index(spark, sf_dir).postings), out, "gzip")
        return out

    rows = ix.read_postings_text(spark, _once(spark, sf_dir, "postings", make))
    return _rounded(rows.withColumn("doc_id", F.col("doc_id").cast("bigint")), "tfidf")


def _blocked_text(spark: SparkSession, sf_dir: str) -> str:
    """Text export of the index in blocks of some hundred postings, so that common terms have many lines."""

    def make():
        out = new_folder(spark, "blocked")
        ix.write_postings_text(ix.posting_blocks(_index(spark, sf_dir).postings, 100), out, "gzip")
        return out

    return _once(spark, sf_dir, "blocked", make)


def postings_long_term(spark, sf_dir):
    """Terms of many lines of text, read back."""
    rows = ix.read_postings_text(spark, _blocked_text(spark, sf_dir))
    return _rounded(rows.withColumn("doc_id", F.col("doc_id").cast("bigint")), "tfidf")


def search_imported(spark, sf_dir):
    """A search of an index that was stored from its text form."""

    def make():
        out = new_folder(spark, "imported")
        ix.import_index(spark, _blocked_text(spark, sf_dir), out, id_type="bigint")
        return out

    index = ix.load_index(spark, _once(spark, sf_dir, "imported", make))
    return _rounded(ix.search(index, "of the"), "score")


def search_snapshot(spark, sf_dir):
    """The index published last: that of the pages was published before that of the documents."""

    def make():
        out = new_folder(spark, "published")
        ix.build_snapshot(ix.read_table(spark, f"{sf_dir}/pages.parquet", "page_id", "url"), out)
        ix.build_snapshot(_documents(spark, sf_dir), out)
        return out

    index = ix.load_index(spark, ix.current_snapshot(spark, _once(spark, sf_dir, "published", make)))
    return _rounded(ix.search_batch(index, _queries(spark)), "score")


def tokens_roundtrip(spark, sf_dir):
    def make():
        out = new_folder(spark, "tokens")
        ix.write_tokens_text(spark.read.parquet(f"{_built(spark, sf_dir)[0]}/tokens"), out)
        return out

    rows = ix.read_tokens_text(spark, _once(spark, sf_dir, "tokens", make))
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def tf_roundtrip(spark, sf_dir):
    def make():
        out = new_folder(spark, "tf")
        ix.write_tf_text(_tf(spark, sf_dir), out)
        return out

    rows = ix.read_tf_text(spark, _once(spark, sf_dir, "tf", make))
    return _rounded(rows.withColumn("doc_id", F.col("doc_id").cast("bigint")), "tf")


def vocabulary_size(spark, sf_dir):
    return ix.vocabulary_size(_index(spark, sf_dir).vocabulary)


def file_corpus_terms(spark, sf_dir):
    """Text files read line by line, counted over all files."""
    counts = ix.term_frequencies(ix.read_lines(spark, _text_files(spark, sf_dir)), whole=False)
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def file_corpus_terms_whole(spark, sf_dir):
    """The same with one row per file."""
    counts = ix.term_frequencies(ix.read_whole(spark, _text_files(spark, sf_dir)))
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def manifest(spark, sf_dir):
    files = ix.corpus_manifest(spark, _text_files(spark, sf_dir))
    return files.groupBy("type").agg(F.sum("length").alias("length"))


def run_counters(spark, sf_dir):
    return spark.read.parquet(f"{_built(spark, sf_dir)[0]}/runs").drop("seconds")


def query_terms(spark, sf_dir):
    return cut_queries(_benchmark_queries(spark, sf_dir)).select("query_id", "term", "weight", "pos")


def _search(query: str):
    return lambda spark, sf_dir: _rounded(ix.search(_index(spark, sf_dir), query), "score")


def _phrase(query: str, limit: int | None = None):
    return lambda spark, sf_dir: _rounded(
        ix.phrase_search(_index(spark, sf_dir), _documents(spark, sf_dir), query, limit), "score"
    )


def search_long(spark, sf_dir):
    """A query of some fifty words: the beginning of the first document."""
    docs = _documents(spark, sf_dir)
    words = docs.agg(F.min_by(F.substring("text", 1, 300), "doc_id")).first()[0]
    return _rounded(ix.search(_index(spark, sf_dir), words), "score")


def _conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents of several rows, put together in order."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return ix.join_lines(turns.select(F.col("conv_id").alias("doc_id"), "text", "turn"), "turn")


def phrase_search_parts(spark, sf_dir):
    """A phrase in documents of several rows, over the edges of rows as well."""
    docs = settle(_conversations(spark, sf_dir))
    index = settle(ix.tfidf_index(settle(ix.normalize_tf(ix.term_frequencies(docs))), ix.count_documents(docs)))
    return _rounded(ix.phrase_search(index, docs, "of the"), "score")


def match_offsets_parts(spark, sf_dir):
    return ix.match_offsets(_conversations(spark, sf_dir), "of the")


def _positional(spark: SparkSession, sf_dir: str) -> ix.Index:
    """Index of the documents with positional postings."""
    out = _built(spark, sf_dir)[0]
    _once(spark, sf_dir, "positions", lambda: ix.build_positions(_documents(spark, sf_dir), out))
    return ix.load_index(spark, out, positions=True)


def _store(spark: SparkSession, sf_dir: str) -> ix.DocumentStore:
    """The documents stored by id."""

    def make():
        out = new_folder(spark, "store")
        ix.build_store(_documents(spark, sf_dir), out, shards=16)
        return out

    return ix.load_store(spark, _once(spark, sf_dir, "store", make))


def document_fetch_store(spark, sf_dir):
    """Fetched from the store, of which only the directories of these ids are read."""
    return ix.fetch_documents(_store(spark, sf_dir), ix.search(_index(spark, sf_dir), "license").select("doc_id"))


def document_head_store(spark, sf_dir):
    """Heads of results, without reading a text."""
    return _store(spark, sf_dir).heads(ix.search(_index(spark, sf_dir), "of the").select("doc_id"))


def phrase_search_store(spark, sf_dir):
    """Only texts that hold both words are read."""
    return _rounded(ix.phrase_search(_index(spark, sf_dir), _store(spark, sf_dir), "of the"), "score")


def phrase_search_batch_store(spark, sf_dir):
    return _rounded(ix.phrase_search_batch(_index(spark, sf_dir), _store(spark, sf_dir), _queries(spark)), "score")


def match_offsets_batch(spark, sf_dir):
    """Where each query of a batch stands in each of its results."""
    results = ix.search_batch(_index(spark, sf_dir), _queries(spark))
    return ix.match_offsets_batch(results, _documents(spark, sf_dir), _queries(spark))


def match_offsets_batch_benchmark(spark, sf_dir):
    """Every benchmark item in the documents that hold it, from the positional postings and the store."""
    index, queries_ = _positional(spark, sf_dir), _benchmark_queries(spark, sf_dir)
    results = ix.phrase_search_batch(index, None, queries_)
    return ix.match_offsets_batch(results, _store(spark, sf_dir), queries_, index)


def _phrase_by_positions(query: str, limit: int | None = None):
    """No text is read: there are no documents to read it from."""
    return lambda spark, sf_dir: _rounded(ix.phrase_search(_positional(spark, sf_dir), None, query, limit), "score")


def phrase_search_batch_positions(spark, sf_dir):
    return _rounded(ix.phrase_search_batch(_positional(spark, sf_dir), None, _queries(spark)), "score")


def phrase_search_batch_benchmark_positions(spark, sf_dir):
    return _rounded(ix.phrase_search_batch(_positional(spark, sf_dir), None, _benchmark_queries(spark, sf_dir)), "score")


def match_count_positions(spark, sf_dir):
    return ix.match_counts(_documents(spark, sf_dir), "of the", _positional(spark, sf_dir))


def match_count_word_positions(spark, sf_dir):
    return ix.match_counts(_documents(spark, sf_dir), "the", _positional(spark, sf_dir))


def _lines_of(docs: DataFrame) -> DataFrame:
    """Documents cut into rows at line breaks."""
    return docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("part", "text"))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents of several rows, as they are stored."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return turns.select(F.col("conv_id").alias("doc_id"), F.col("turn").alias("part"), "text")


def _turns_index(spark: SparkSession, sf_dir: str) -> ix.Index:
    def make():
        out, turns = new_folder(spark, "turns"), _turns(spark, sf_dir)
        ix.build_index(turns, out, whole=False)
        ix.build_positions(turns, out)
        return out

    return ix.load_index(spark, _once(spark, sf_dir, "turns", make), positions=True)


def phrase_search_lines(spark, sf_dir):
    """A phrase over the edges of rows; the rows are not put together."""
    index = replace(_turns_index(spark, sf_dir), positions=None)
    return _rounded(ix.phrase_search(index, _turns(spark, sf_dir), "of the"), "score")


def phrase_search_lines_positions(spark, sf_dir):
    """The same from the positional postings of the rows."""
    return _rounded(ix.phrase_search(_turns_index(spark, sf_dir), None, "of the"), "score")


def phrase_search_batch_lines(spark, sf_dir):
    index = replace(_turns_index(spark, sf_dir), positions=None)
    return _rounded(ix.phrase_search_batch(index, _turns(spark, sf_dir), _queries(spark)), "score")


def match_offsets_lines(spark, sf_dir):
    return ix.match_offsets(_turns(spark, sf_dir), "of the")


def match_offsets_split_documents(spark, sf_dir):
    """Documents cut into lines have the same matches as whole ones."""
    return ix.match_offsets(_lines_of(_documents(spark, sf_dir)), "the")


def match_count_lines(spark, sf_dir):
    return ix.match_counts(_lines_of(_documents(spark, sf_dir)), "of the")


def title_extract_parts(spark, sf_dir):
    """Headers over lines that are rows."""
    return ix.extract_titles(_lines_of(_with_headers(spark, sf_dir)))


def document_fetch_blank(spark, sf_dir):
    """Fetched documents of which every third holds nothing but blanks."""
    docs = _documents(spark, sf_dir)
    blanked = docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.lit(" \t\n")).otherwise(F.col("text")))
    return ix.fetch_documents(blanked, ix.search(_index(spark, sf_dir), "license").select("doc_id"))


def ids_from_names(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    name = F.concat(F.col("doc_id").cast("string"), F.when(F.col("doc_id") % 2 == 0, ".txt").otherwise(".txt.txt"))
    return docs.select("doc_id", doc_id_from_file_name(name).alias("name_id"))


def _lines(spark: SparkSession, sf_dir: str, name: str, line) -> str:
    """Folder of a text file of one line per document."""

    def make():
        out = new_folder(spark, name)
        spark.read.parquet(f"{sf_dir}/documents.parquet").select(line.alias("value")).write.text(out)
        return out

    return _once(spark, sf_dir, name, make)


def malformed_tokens(spark, sf_dir):
    """Token lines of which some are broken, and counts beyond 32 bits."""
    doc_id = F.col("doc_id")
    line = (
        F.when(doc_id % 5 == 0, F.concat(F.lit("nodelimiter"), doc_id))
        .when(doc_id % 5 == 1, F.concat(F.lit("word@"), doc_id, F.lit("\tabc")))
        .otherwise(F.concat(F.lit("a@b@"), doc_id, F.lit("\t"), doc_id + 3_000_000_000))
    )
    rows = ix.read_tokens_text(spark, _lines(spark, sf_dir, "malformed_tokens", line))
    return rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))


def malformed_postings(spark, sf_dir):
    """Posting lines of which some entries are broken."""
    doc_id = F.col("doc_id")
    line = (
        F.when(doc_id % 4 == 0, F.concat(F.lit("nodelimiter"), doc_id))
        .when(doc_id % 4 == 1, F.concat(F.lit("w"), doc_id, F.lit("\t1:bad,2:0.5,,:")))
        .otherwise(F.concat(F.lit("w"), doc_id, F.lit("\t1:0.5,1:0.75,2:0.25")))
    )
    return ix.read_postings_text(spark, _lines(spark, sf_dir, "malformed_postings", line))


def malformed_tf(spark, sf_dir):
    """Frequency lines of which some have no number, no id or no second field."""
    doc_id = F.col("doc_id")
    line = (
        F.when(doc_id % 4 == 0, F.concat(F.lit("nodelimiter"), doc_id))
        .when(doc_id % 4 == 1, F.concat(F.lit("w"), doc_id, F.lit("\t"), doc_id, F.lit("=x")))
        .when(doc_id % 4 == 2, F.concat(F.lit("w"), doc_id, F.lit("\tnumberless")))
        .otherwise(F.concat(F.lit("w"), doc_id, F.lit("\ta="), doc_id, F.lit("=0.25")))
    )
    return ix.read_tf_text(spark, _lines(spark, sf_dir, "malformed_tf", line))


def stage_by_stage(spark, sf_dir):
    """The stages run one at a time, each twice: a stage replaces what it wrote before."""

    def make():
        out, docs = new_folder(spark, "stages"), _documents(spark, sf_dir)
        n_docs = ix.count_documents(docs).first().n_docs
        for _ in range(2):
            ix.build_index(docs, out, "job1", n_docs)
            ix.build_index(spark.read.parquet(f"{out}/tokens"), out, "job2")
            ix.build_index(spark.read.parquet(f"{out}/index"), out, "job3", n_docs)
        return out

    index = ix.load_index(spark, _once(spark, sf_dir, "stages", make))
    return _rounded(index.postings.drop("shard"), "tf", "idf", "tfidf")


def search_batch(spark, sf_dir):
    return _rounded(ix.search_batch(_index(spark, sf_dir), _queries(spark)), "score")


def search_batch_top_large(spark, sf_dir):
    """More results per query than Spark keeps in one group before an exchange."""
    return _rounded(ix.search_batch(_index(spark, sf_dir), _queries(spark), top=2000), "score")


def search_batch_top(spark, sf_dir):
    return _rounded(ix.search_batch(_index(spark, sf_dir), _queries(spark), top=20), "score")


def _bounded(spark: SparkSession, sf_dir: str) -> ix.Index:
    """Index of the documents with bounds of scores."""
    out = _built(spark, sf_dir)[0]
    _once(spark, sf_dir, "bounds", lambda: ix.build_bounds(spark, out))
    return ix.load_index(spark, out, bounds=True)


def search_batch_top_bounds(spark, sf_dir):
    """The best results, found without the postings of documents too long to be among them."""
    return _rounded(ix.search_batch(_bounded(spark, sf_dir), _queries(spark), top=20), "score")


def _mapped(spark: SparkSession, sf_dir: str) -> ix.Index:
    """Index of the documents with bitmaps of the frequent terms."""
    out = _built(spark, sf_dir)[0]
    _once(spark, sf_dir, "bitmaps", lambda: ix.build_bitmaps(spark, out))
    return ix.load_index(spark, out, bitmaps=True)


def _search_mapped(query: str):
    return lambda spark, sf_dir: _rounded(ix.search(_mapped(spark, sf_dir), query), "score")


def search_batch_benchmark(spark, sf_dir):
    """Every benchmark item is a query."""
    return _rounded(ix.search_batch(_index(spark, sf_dir), _benchmark_queries(spark, sf_dir)), "score")


def phrase_search_batch(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    return _rounded(ix.phrase_search_batch(_index(spark, sf_dir), docs, _queries(spark)), "score")


def phrase_search_batch_benchmark(spark, sf_dir):
    """Documents that hold the words of a benchmark item one after the other."""
    docs, queries_ = _documents(spark, sf_dir), _benchmark_queries(spark, sf_dir)
    return _rounded(ix.phrase_search_batch(_index(spark, sf_dir), docs, queries_), "score")


def document_fetch(spark, sf_dir):
    ids = ix.search(_index(spark, sf_dir), "license").select("doc_id")
    return ix.fetch_documents(_documents(spark, sf_dir), ids)


def document_head(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", head(F.col("text")).alias("head"))


def title_lookup(spark, sf_dir):
    """Titles from the dictionary or the fallback, with scores as displayed."""
    named = ix.lookup_titles(ix.search(_index(spark, sf_dir), "the"), _titles(spark, sf_dir))
    titled = named.withColumn("title", F.coalesce("title", untitled(F.col("doc_id"))))
    return _rounded(ix.as_displayed(titled), "score")


def title_extract(spark, sf_dir):
    return ix.extract_titles(_with_headers(spark, sf_dir))


def resolve_titles(spark, sf_dir):
    """Titles from the dictionary, the header, or the fallback."""
    results = ix.search(_index(spark, sf_dir), "of the")
    titled = ix.resolve_titles(results, _titles(spark, sf_dir), _with_headers(spark, sf_dir))
    return _rounded(titled, "score").select("doc_id", "score", "title")


def remember_titles(spark, sf_dir):
    """The dictionary after the titles of a search have been added to it."""
    results = ix.search(_index(spark, sf_dir), "of the")
    titles = _titles(spark, sf_dir)
    return ix.remember_titles(titles, ix.found_titles(results, titles, _with_headers(spark, sf_dir)))


def match_count(spark, sf_dir):
    return ix.match_counts(_documents(spark, sf_dir), "of the")


def match_offsets(spark, sf_dir):
    return ix.match_offsets(_documents(spark, sf_dir), "of the")


def match_offsets_word(spark, sf_dir):
    return ix.match_offsets(_documents(spark, sf_dir), "the")


def match_navigation(spark, sf_dir):
    return ix.match_navigation(ix.match_offsets(_documents(spark, sf_dir), '"of the"'))


def match_spans(spark, sf_dir):
    spans = ix.nest_offsets(ix.match_offsets(_documents(spark, sf_dir), "of the"))
    texts = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string")))
    return spans.select("doc_id", F.array_join(texts, ",").alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        term_frequency,
        term_frequency_by_parts,
        doc_length,
        normalized_tf,
        normalized_tf_by_parts,
        document_frequency,
        corpus_count,
        tfidf_index,
        tfidf_index_small_n,
        tfidf_index_pages,
        tfidf_index_preset,
        limited_corpus,
        postings,
        postings_flat,
        postings_roundtrip,
        postings_long_term,
        search_imported,
        search_snapshot,
        tokens_roundtrip,
        tf_roundtrip,
        vocabulary_size,
        file_corpus_terms,
        file_corpus_terms_whole,
        manifest,
        run_counters,
        query_terms,
        search_batch,
        search_batch_top,
        search_batch_top_large,
        search_batch_top_bounds,
        search_batch_benchmark,
        phrase_search_batch,
        phrase_search_batch_benchmark,
        document_fetch,
        document_head,
        title_lookup,
        title_extract,
        resolve_titles,
        remember_titles,
        match_count,
        match_offsets,
        match_offsets_word,
        match_navigation,
        match_spans,
        search_long,
        phrase_search_parts,
        match_offsets_parts,
        phrase_search_batch_positions,
        phrase_search_batch_benchmark_positions,
        match_count_positions,
        match_count_word_positions,
        phrase_search_lines,
        phrase_search_lines_positions,
        phrase_search_batch_lines,
        match_offsets_lines,
        match_offsets_split_documents,
        match_count_lines,
        title_extract_parts,
        document_fetch_blank,
        document_fetch_store,
        document_head_store,
        phrase_search_store,
        phrase_search_batch_store,
        match_offsets_batch,
        match_offsets_batch_benchmark,
        ids_from_names,
        malformed_tokens,
        malformed_postings,
        malformed_tf,
        stage_by_stage,
    ]
    return {query.__name__: query for query in named} | {
        "search_single": _search("license"),
        "search_and": _search("of the"),
        "search_and_rare": _search("the la"),
        "search_and_bitmaps": _search_mapped("of the"),
        "search_bitmaps_mixed": _search_mapped("the of and to zzzunknown the license"),
        "search_unknown_term": _search("the zzzunknown"),
        "search_only_unknown": _search("zzzunknown"),
        "search_repeated_term": _search("the the of"),
        "phrase_search": _phrase("of the"),
        "phrase_search_top": _phrase("of the", 100),
        "phrase_search_quoted": _phrase('"and of the"'),
        "phrase_search_single": _phrase('"license"'),
        "phrase_search_positions": _phrase_by_positions("of the"),
        "phrase_search_positions_top": _phrase_by_positions('"of the"', 100),
    } | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


# SQL building blocks: tokens, counts, lengths, frequencies, and the index of a table of texts.
def _index_ctes(table: str = "documents", doc_id: str = "doc_id", text: str = "text", n_docs: str = "") -> str:
    n_docs = n_docs or f"(SELECT count(DISTINCT {doc_id}) FROM {table})"
    return f"""
    toks AS (SELECT {doc_id} AS doc_id, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS term FROM {table}),
    tc AS (SELECT doc_id, term, count(*) AS n FROM toks GROUP BY ALL),
    dl AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS doc_len FROM tc GROUP BY ALL),
    tf AS (SELECT doc_id, term, n, doc_len, n::DOUBLE / doc_len AS tf FROM tc JOIN dl USING (doc_id)),
    dfs AS (SELECT term, count(*) AS df FROM tc GROUP BY ALL),
    ws AS (SELECT term, df, greatest(0.0::DOUBLE, ln({n_docs}::DOUBLE / df)) AS idf FROM dfs),
    idx AS (SELECT term, doc_id, n, doc_len, tf, df, idf, tf * idf AS tfidf FROM tf JOIN ws USING (term))"""


_IDX = "WITH " + _index_ctes()
_ROUNDED_IDX = """SELECT term, doc_id, n, doc_len, round(tf, 9) AS tf, df, round(idf, 9) AS idf,
    round(tfidf, 9) AS tfidf FROM idx"""


def _hits_ctes(queries_sql: str, docs: str = "documents") -> str:
    """Lenient AND search of a table of queries."""
    return f"""{_index_ctes(docs)},
    asked AS ({queries_sql}),
    qlists AS (SELECT query_id, regexp_extract_all(lower(query), '[a-z0-9]+') AS terms FROM asked),
    qtoks AS (SELECT query_id, unnest(terms) AS term, generate_subscripts(terms, 1) - 1 AS pos FROM qlists),
    qt AS (SELECT query_id, term, count(*) AS weight, CAST(min(pos) AS INTEGER) AS pos FROM qtoks GROUP BY ALL),
    qn AS (SELECT query_id, count(*) AS n_known FROM qt JOIN dfs USING (term) GROUP BY ALL),
    hits AS (
        SELECT query_id, doc_id, sum(tfidf * weight ORDER BY pos) AS score
        FROM qt JOIN idx USING (term) JOIN qn USING (query_id)
        GROUP BY query_id, doc_id, n_known HAVING count(*) = n_known)"""


def _phrase_ctes(queries_sql: str, docs: str = "documents") -> str:
    return f"""{_hits_ctes(queries_sql, docs)},
    patterns AS (
        SELECT query_id, len(terms) AS n_terms, '(?i)\\b' || array_to_string(terms, '[^a-zA-Z0-9]+') || '\\b' AS pattern
        FROM qlists),
    shown AS (
        SELECT query_id, doc_id, score
        FROM hits JOIN patterns USING (query_id) JOIN {docs} USING (doc_id)
        WHERE n_terms = 1 OR regexp_matches(text, pattern))"""


def _values() -> str:
    rows = ", ".join(f"({i}::BIGINT, '{q}')" for i, q in QUERIES)
    return f"SELECT * FROM (VALUES {rows}) AS q(query_id, query)"


def _one(query: str) -> str:
    return f"SELECT 1 AS query_id, '{query}' AS query"


_BENCHMARK = "SELECT item_id AS query_id, text AS query FROM benchmark"


def _search_sql(query: str) -> str:
    return f"WITH {_hits_ctes(_one(query))} SELECT doc_id, round(score, 9) AS score FROM hits"


def _phrase_sql(query: str) -> str:
    return f"WITH {_phrase_ctes(_one(query))} SELECT doc_id, round(score, 9) AS score FROM shown"


_TALKS = """talks AS (
    SELECT conv_id AS doc_id, string_agg(text, chr(10) ORDER BY turn, text) AS text FROM conversations GROUP BY conv_id)"""

_HEADERS = """books AS (
    SELECT doc_id, (CASE doc_id % 6
        WHEN 0 THEN 'Title: ' || name || ',' || chr(10) || 'Author: Nobody' || chr(10) || chr(10)
        WHEN 1 THEN 'TITLE: ' || name || ' Author: Nobody title: no' || chr(10)
        WHEN 2 THEN 'x TiTle:' || name || chr(13) || chr(10) || 'Language: en' || chr(10)
        WHEN 3 THEN 'The Project Gutenberg EBook of ' || name || ' This eBook is'
        WHEN 4 THEN 'Title: ' || chr(10) || 'The Project Gutenberg eBook of ' || name || chr(10)
        ELSE '' END) || text AS text
    FROM (SELECT *, source || ' ' || lang || ' ' || doc_id AS name FROM documents)),
heads AS (SELECT doc_id, substring(text, 1, 1500) AS h FROM books),
marks AS (
    SELECT doc_id, h,
        coalesce(nullif(strpos(h, 'Title: '), 0), nullif(strpos(h, 'TITLE: '), 0),
            nullif(strpos(lower(h), 'title:'), 0)) AS t,
        coalesce(nullif(strpos(h, 'The Project Gutenberg eBook of'), 0),
            nullif(strpos(h, 'The Project Gutenberg EBook of'), 0)) AS b
    FROM heads),
rests AS (
    SELECT doc_id,
        CASE WHEN substring(h, t + 6, 1) = ' ' THEN substring(h, t + 7) ELSE substring(h, t + 6) END AS line,
        substring(h, b + 30) AS banner
    FROM marks),
cuts AS (
    SELECT doc_id,
        trim(regexp_extract(line,
            '(?s)^(.*?)(Author:|Release Date:|Release date:|Language:|EBook #|\\[eBook #|Posting Date:|\\n|\\r|$)', 1),
            chr(32) || chr(9) || chr(10) || chr(13)) AS line,
        trim(regexp_extract(banner, '(?s)^(.*?)(\\n|This eBook|$)', 1), chr(32) || chr(9) || chr(13)) AS banner
    FROM rests),
headed AS (
    SELECT doc_id, coalesce(nullif(regexp_replace(line, '\\s*,$', ''), ''), nullif(banner, '')) AS title FROM cuts)"""

_MATCHES = """pieces AS (
    SELECT doc_id, regexp_extract_all(text, '{p}') AS m, string_split_regex(text, '{p}') AS g FROM documents),
parts AS (
    SELECT doc_id, len(m) AS n_matches, unnest(m) AS matched, unnest(g[1:len(m)]) AS gap,
        generate_subscripts(m, 1) AS match_no
    FROM pieces WHERE len(m) > 0),
ends AS (
    SELECT *, CAST(sum(length(gap) + length(matched)) OVER (PARTITION BY doc_id ORDER BY match_no) AS BIGINT) AS "end"
    FROM parts),
offsets AS (
    SELECT doc_id, CAST(match_no AS INTEGER) AS match_no, CAST(n_matches AS INTEGER) AS n_matches,
        "end" - length(matched) AS start, "end", matched
    FROM ends)"""
_OF_THE = r"(?i)\bof[^a-zA-Z0-9]+the\b"
_THE = r"(?i)\bthe\b"


def _batch_matches_sql(found: str) -> str:
    """Matches of each query in each of the rows (query_id, doc_id) of ``found``, for queries of at least one token."""
    return f"""told AS (
        SELECT query_id, doc_id, regexp_extract_all(text, pattern) AS m, string_split_regex(text, pattern) AS g
        FROM {found} JOIN patterns USING (query_id) JOIN documents USING (doc_id) WHERE n_terms > 0),
    parts AS (
        SELECT query_id, doc_id, len(m) AS n_matches, unnest(m) AS matched, unnest(g[1:len(m)]) AS gap,
            generate_subscripts(m, 1) AS match_no
        FROM told WHERE len(m) > 0),
    ends AS (
        SELECT *, CAST(sum(length(gap) + length(matched))
            OVER (PARTITION BY query_id, doc_id ORDER BY match_no) AS BIGINT) AS "end"
        FROM parts)
    SELECT query_id, doc_id, CAST(match_no AS INTEGER) AS match_no, CAST(n_matches AS INTEGER) AS n_matches,
        "end" - length(matched) AS start, "end", matched
    FROM ends"""


def oracle_sql() -> dict[str, str]:
    of_the = _MATCHES.replace("{p}", _OF_THE)
    turns = _index_ctes("conversations", "conv_id")
    first = "(SELECT * FROM documents ORDER BY CAST(doc_id AS VARCHAR) LIMIT 100)"
    term_totals = f"{_IDX} SELECT term, CAST(sum(n) AS BIGINT) AS n FROM tc GROUP BY term"
    tfidf_rows = f"{_IDX} SELECT term, doc_id, round(tfidf, 9) AS tfidf FROM idx"
    batch_phrases = f"WITH {_phrase_ctes(_values())} SELECT query_id, doc_id, round(score, 9) AS score FROM shown"
    items = f"WITH {_phrase_ctes(_BENCHMARK)} SELECT query_id, doc_id, round(score, 9) AS score FROM shown"
    talks = f"WITH {_TALKS}, {_phrase_ctes(_one('of the'), 'talks')} SELECT doc_id, round(score, 9) AS score FROM shown"
    talk_matches = f"WITH {_TALKS}, {of_the.replace('FROM documents', 'FROM talks')} SELECT * FROM offsets"
    best_20 = f"""WITH {_hits_ctes(_values())}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM hits)
        SELECT query_id, doc_id, round(score, 9) AS score, rank FROM ranked WHERE rank <= 20"""
    counted = "SELECT doc_id, CAST(len(regexp_extract_all(text, '{p}')) AS INTEGER) AS n_matches FROM documents"
    return {
        "phrase_search_batch_positions": batch_phrases,
        "phrase_search_batch_benchmark_positions": items,
        "match_count_positions": counted.replace("{p}", _OF_THE),
        "match_count_word_positions": counted.replace("{p}", _THE),
        "phrase_search_lines": talks,
        "phrase_search_lines_positions": talks,
        "phrase_search_batch_lines": f"""WITH {_TALKS}, {_phrase_ctes(_values(), "talks")}
            SELECT query_id, doc_id, round(score, 9) AS score FROM shown""",
        "match_offsets_lines": talk_matches,
        "match_offsets_split_documents": f"WITH {_MATCHES.replace('{p}', _THE)} SELECT * FROM offsets",
        "match_count_lines": counted.replace("{p}", _OF_THE),
        "title_extract_parts": f"WITH {_HEADERS} SELECT doc_id, title FROM headed",
        "phrase_search_positions": _phrase_sql("of the"),
        "phrase_search_positions_top": f"{_phrase_sql('of the')} ORDER BY shown.score DESC, doc_id LIMIT 100",
        "term_frequency": f"{_IDX} SELECT doc_id, term, n FROM tc",
        "term_frequency_by_parts": f"WITH {turns} SELECT doc_id, term, n FROM tc",
        "doc_length": f"{_IDX} SELECT doc_id, doc_len FROM dl",
        "normalized_tf": f"{_IDX} SELECT doc_id, term, n, doc_len, round(tf, 9) AS tf FROM tf",
        "normalized_tf_by_parts": f"WITH {turns} SELECT doc_id, term, n, doc_len, round(tf, 9) AS tf FROM tf",
        "document_frequency": f"{_IDX} SELECT term, df FROM dfs",
        "corpus_count": "SELECT count(DISTINCT doc_id) AS n_docs FROM documents",
        "tfidf_index": f"{_IDX} {_ROUNDED_IDX}",
        "tfidf_index_small_n": f"WITH {_index_ctes(n_docs='100')} {_ROUNDED_IDX}",
        "tfidf_index_pages": f"WITH {_index_ctes('pages', 'page_id', 'html')} {_ROUNDED_IDX}",
        "tfidf_index_preset": f"WITH small AS {first}, {_index_ctes('small')} {_ROUNDED_IDX}",
        "limited_corpus": f"SELECT doc_id, text FROM {first}",
        "postings": f"""{_IDX} SELECT term, 0::BIGINT AS block, 1::BIGINT AS n_blocks, df,
            string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS doc_ids FROM idx GROUP BY term, df""",
        "postings_flat": f"{_IDX} SELECT term, doc_id, round(tfidf, 9) AS tfidf, df FROM idx",
        "postings_roundtrip": tfidf_rows,
        "postings_long_term": tfidf_rows,
        "search_imported": _search_sql("of the"),
        "search_snapshot": f"WITH {_hits_ctes(_values())} SELECT query_id, doc_id, round(score, 9) AS score FROM hits",
        "document_fetch_store": f"""{_IDX} SELECT doc_id, text, false AS is_blank FROM documents
            WHERE doc_id IN (SELECT doc_id FROM tc WHERE term = 'license')""",
        "document_head_store": f"""WITH {_hits_ctes(_one("of the"))}
            SELECT doc_id, substring(text, 1, 1500) AS head FROM hits JOIN documents USING (doc_id)""",
        "phrase_search_store": _phrase_sql("of the"),
        "phrase_search_batch_store": f"""WITH {_phrase_ctes(_values())}
            SELECT query_id, doc_id, round(score, 9) AS score FROM shown""",
        "match_offsets_batch": f"WITH {_phrase_ctes(_values())}, {_batch_matches_sql('hits')}",
        "match_offsets_batch_benchmark": f"WITH {_phrase_ctes(_BENCHMARK)}, {_batch_matches_sql('shown')}",
        "tokens_roundtrip": f"{_IDX} SELECT doc_id, term, n FROM tc",
        "tf_roundtrip": f"{_IDX} SELECT term, doc_id, round(tf, 9) AS tf FROM tf",
        "vocabulary_size": f"{_IDX} SELECT count(*) AS n_terms FROM dfs",
        "file_corpus_terms": term_totals,
        "file_corpus_terms_whole": term_totals,
        "manifest": """SELECT 'FILE' AS type, CAST(sum(octet_length(encode(text)) + 1) AS BIGINT) AS length
            FROM documents""",
        "run_counters": f"""{_IDX}, c AS (SELECT count(*) AS rows FROM tc)
            SELECT 'job1' AS stage, (SELECT count(*) FROM documents) AS records_in, rows AS records_out FROM c
            UNION ALL SELECT 'job2', rows, rows FROM c UNION ALL SELECT 'job3', rows, rows FROM c""",
        "query_terms": f"WITH {_hits_ctes(_BENCHMARK)} SELECT query_id, term, weight, pos FROM qt",
        "search_single": _search_sql("license"),
        "search_and": _search_sql("of the"),
        "search_and_rare": _search_sql("the la"),
        "search_and_bitmaps": _search_sql("of the"),
        "search_bitmaps_mixed": _search_sql("the of and to zzzunknown the license"),
        "search_unknown_term": _search_sql("the zzzunknown"),
        "search_only_unknown": _search_sql("zzzunknown"),
        "search_repeated_term": _search_sql("the the of"),
        "search_batch": f"WITH {_hits_ctes(_values())} SELECT query_id, doc_id, round(score, 9) AS score FROM hits",
        "search_batch_top_bounds": best_20,
        "search_batch_top": best_20,
        "search_batch_benchmark": f"""WITH {_hits_ctes(_BENCHMARK)}
            SELECT query_id, doc_id, round(score, 9) AS score FROM hits""",
        "phrase_search": _phrase_sql("of the"),
        "phrase_search_top": f"{_phrase_sql('of the')} ORDER BY shown.score DESC, doc_id LIMIT 100",
        "search_long": f"""WITH {_hits_ctes("SELECT 1 AS query_id, arg_min(substring(text, 1, 300), doc_id) AS query FROM documents")}
            SELECT doc_id, round(score, 9) AS score FROM hits""",
        "search_batch_top_large": f"""WITH {_hits_ctes(_values())}, ranked AS (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM hits)
            SELECT query_id, doc_id, round(score, 9) AS score, rank FROM ranked WHERE rank <= 2000""",
        "phrase_search_parts": f"""WITH {_TALKS}, {_phrase_ctes(_one("of the"), "talks")}
            SELECT doc_id, round(score, 9) AS score FROM shown""",
        "match_offsets_parts": f"WITH {_TALKS}, {of_the.replace('FROM documents', 'FROM talks')} SELECT * FROM offsets",
        "document_fetch_blank": f"""{_IDX} SELECT doc_id,
            CASE WHEN doc_id % 3 = 0 THEN ' ' || chr(9) || chr(10) ELSE text END AS text, doc_id % 3 = 0 AS is_blank
            FROM documents WHERE doc_id IN (SELECT doc_id FROM tc WHERE term = 'license')""",
        "ids_from_names": """SELECT doc_id, doc_id || CASE WHEN doc_id % 2 = 0 THEN '' ELSE '.txt' END AS name_id
            FROM documents""",
        "malformed_tokens": "SELECT doc_id, 'a@b' AS term, doc_id + 3000000000 AS n FROM documents WHERE doc_id % 5 > 1",
        "malformed_tf": """SELECT 'w' || doc_id AS term, CASE doc_id % 4 WHEN 1 THEN doc_id::VARCHAR WHEN 3 THEN 'a=' || doc_id END AS doc_id,
            CASE WHEN doc_id % 4 = 3 THEN 0.25::DOUBLE END AS tf FROM documents WHERE doc_id % 4 > 0""",
        "stage_by_stage": f"{_IDX} {_ROUNDED_IDX}",
        "malformed_postings": """SELECT 'w' || doc_id AS term, unnest(ids) AS doc_id, unnest(scores) AS tfidf FROM (
            SELECT doc_id, CASE WHEN doc_id % 4 = 1 THEN ['2'] ELSE ['1', '2'] END AS ids,
                CASE WHEN doc_id % 4 = 1 THEN [0.5::DOUBLE] ELSE [0.75::DOUBLE, 0.25] END AS scores
            FROM documents WHERE doc_id % 4 > 0)""",
        "phrase_search_quoted": _phrase_sql('"and of the"'),
        "phrase_search_single": _phrase_sql('"license"'),
        "phrase_search_batch": f"""WITH {_phrase_ctes(_values())}
            SELECT query_id, doc_id, round(score, 9) AS score FROM shown""",
        "phrase_search_batch_benchmark": f"""WITH {_phrase_ctes(_BENCHMARK)}
            SELECT query_id, doc_id, round(score, 9) AS score FROM shown""",
        "document_fetch": f"""{_IDX} SELECT doc_id, text, false AS is_blank FROM documents
            WHERE doc_id IN (SELECT doc_id FROM tc WHERE term = 'license')""",
        "document_head": "SELECT doc_id, substring(text, 1, 1500) AS head FROM documents",
        "title_lookup": f"""WITH {_hits_ctes(_one("the"))}
            SELECT coalesce(url, 'Book #' || doc_id) AS title, doc_id, round(score, 9) AS score,
                printf('%.6f', score) AS score_text
            FROM hits LEFT JOIN pages ON page_id = doc_id""",
        "title_extract": f"WITH {_HEADERS} SELECT doc_id, title FROM headed",
        "resolve_titles": f"""WITH {_hits_ctes(_one("of the"))}, {_HEADERS}
            SELECT doc_id, round(score, 9) AS score, coalesce(url, title, 'Book #' || doc_id) AS title
            FROM hits LEFT JOIN pages ON page_id = doc_id LEFT JOIN headed USING (doc_id)""",
        "remember_titles": f"""WITH {_hits_ctes(_one("of the"))}, {_HEADERS}
            SELECT page_id::VARCHAR AS doc_id, url AS title FROM pages
            UNION ALL SELECT doc_id::VARCHAR, title FROM hits JOIN headed USING (doc_id)
            WHERE title IS NOT NULL AND doc_id NOT IN (SELECT page_id FROM pages)""",
        "match_count": f"""SELECT doc_id, CAST(len(regexp_extract_all(text, '{_OF_THE}')) AS INTEGER) AS n_matches
            FROM documents""",
        "match_offsets": f"WITH {of_the} SELECT * FROM offsets",
        "match_offsets_word": f"WITH {_MATCHES.replace('{p}', _THE)} SELECT * FROM offsets",
        "match_navigation": f"""WITH {of_the} SELECT *,
            coalesce(lead(start) OVER w, first_value(start) OVER w) AS next_start,
            coalesce(lag(start) OVER w, last_value(start) OVER (PARTITION BY doc_id ORDER BY match_no
                ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS prev_start,
            'Match ' || match_no || ' of ' || n_matches AS status
            FROM offsets WINDOW w AS (PARTITION BY doc_id ORDER BY match_no)""",
        "match_spans": f"""WITH {of_the} SELECT doc_id, string_agg(start || '-' || "end", ',' ORDER BY match_no) AS spans
            FROM offsets GROUP BY doc_id""",
    } | (llm.oracle_sql() if llm else {})
