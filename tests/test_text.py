import re

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from inkdex.functions import text as T
from inkdex.functions.headers import title_from_head, untitled
from inkdex.operators import index as index_module
from inkdex.operators.index import term_frequencies


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    "text, expected",
    [
        ("The Wizard of Oz\nWIZARD, of: oz!", ["the", "wizard", "of", "oz", "wizard", "of", "oz"]),
        ("  --  ", []),
        ("", []),
        ("École d'été 2nd_half", ["cole", "d", "t", "2nd", "half"]),
        ("a", ["a"]),
    ],
)
def test_tokens(spark, text, expected):
    assert one(spark, T.tokens(F.col("t")), t=text) == expected
    assert T.split_terms(text) == expected


def test_split_terms_of_nothing():
    assert T.split_terms(None) == [] == T.split_terms("  ,")


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aAbB1 ,_-é\n\t", max_size=40), min_size=1, max_size=5))
def test_counts_equal_plain_counting(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    expected = []
    for doc_id, text in enumerate(texts):
        found = re.findall("[a-z0-9]+", text.lower())
        expected += [(doc_id, term, found.count(term), len(found)) for term in sorted(set(found))]
    assert rows(term_frequencies(docs), "doc_id", "term", "n", "doc_len") == sorted(expected)


def test_a_term_repeated_very_often_is_counted(spark):
    docs = spark.range(1).select(F.col("id").alias("doc_id"), F.expr("concat(repeat('the ', 2000000), 'then')").alias("text"))
    assert rows(term_frequencies(docs), "term", "n", "doc_len") == [("the", 2000000, 2000001), ("then", 1, 2000001)]


@pytest.mark.parametrize("piece", [1, 7, 1000])
def test_long_texts_are_counted_in_pieces(spark, monkeypatch, piece):
    """Rows stay apart even if they have one id; letters that become longer in lower case, or ASCII, do not cut tokens."""
    monkeypatch.setattr(index_module, "LONG_TEXT", 20)
    monkeypatch.setattr(index_module, "PIECE", piece)
    texts = [(1, "the Wizard of\nOz, the wizard of Oz"), (1, "the the the the the the"), (None, "\u0130stanbul \U0001f600\u212aelvin 2nd_half 2nd_half"), (2, "short the")]
    texts += [(3, " ,;- " * 9), (4, None), (5, ""), (6, "x" * 90)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    expected, lines = [], []
    for doc_id, text in texts:
        found = re.findall("[a-z0-9]+", (text or "").lower())
        expected += [(str(doc_id), term, found.count(term), len(found)) for term in set(found)]
        lines += [(str(doc_id), term) for term in found]
    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")).alias("doc_id"), "text")
    assert rows(term_frequencies(named), "doc_id", "term", "n", "doc_len") == sorted(expected)
    summed = [(*key, lines.count(key)) for key in sorted(set(lines))]
    assert rows(term_frequencies(named, whole=False), "doc_id", "term", "n") == summed


def test_phrase_boundaries(spark):
    regex = T.phrase_regex(["wizard", "of"])
    texts = {"x_wizard of": False, "éwizard of": True, "Wizard -- OF.": True, "wizard off": False, "wizard of_": False}
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.text: r.hit for r in df.select("text", F.col("text").rlike(regex).alias("hit")).collect()}
    assert found == texts
    pattern = T.phrase_pattern(F.array(F.lit("wizard"), F.lit("of")))
    assert df.select(pattern.alias("p")).first().p == regex


@pytest.mark.parametrize("encoded, plain", [("a%20b.txt", "a b.txt"), ("g%20+h.txt", "g +h.txt"), ("1.txt", "1.txt")])
def test_file_name(spark, encoded, plain):
    assert one(spark, T.file_name(F.col("n")), n=encoded) == plain


@pytest.mark.parametrize("name, doc_id", [("1.txt", "1"), ("notes", "notes"), ("a.txt.txt", "a.txt"), (".txt", "")])
def test_doc_id(spark, name, doc_id):
    assert one(spark, T.doc_id_from_file_name(F.col("n")), n=name) == doc_id


@pytest.mark.parametrize(
    "text, value",
    [("0.5", 0.5), ("1.0E-5", 1e-5), (" 2 ", 2.0), ("x", None), ("", None), ("Infinity", float("inf")), ("inf", None)],
)
def test_parse_double(spark, text, value):
    assert one(spark, T.parse_double(F.col("t")), t=text) == value


@pytest.mark.parametrize("text, value", [("12", 12), ("-3", -3), ("+4", 4), (" 5", None), ("1.0", None), ("9999999999", 9999999999), ("9" * 19, None)])
def test_parse_int(spark, text, value):
    assert one(spark, T.parse_int(F.col("t")), t=text) == value


@pytest.mark.parametrize(
    "head, title",
    [
        ("The Project Gutenberg eBook of Alice, by X\nTitle: Alice in W,\nAuthor: C", "Alice in W"),
        ("TITLE: Big Author: B title: no", "Big"),
        ("x TiTle:Odd\r\nLanguage: en", "Odd"),
        ("The Project Gutenberg EBook of Moby This eBook is", "Moby"),
        ("Title: \nThe Project Gutenberg eBook of Zed\n", "Zed"),
        ("nothing", None),
        ("Title: ", None),
        ("Title: ,", None),
        ("Title:  Two,, ", "Two,"),
        ("Title: At the end", "At the end"),
        ("TITLE: second Title: first", "first"),
        ("", None),
    ],
)
def test_title_from_head(spark, head, title):
    assert one(spark, title_from_head(F.col("h")), h=head) == title


def test_untitled_and_score_text(spark):
    assert one(spark, untitled(F.col("d")), d="7") == "Book #7"
    assert one(spark, T.score_text(F.lit(0.1234564) + F.length("d") * 0.0), d="7") == "0.123456"
