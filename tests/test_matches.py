import re

from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import inkdex as ix


def test_offsets(docs):
    found = rows(ix.match_offsets(docs, "of oz"))
    assert found == [("1", 1, 2, 11, 16, "of Oz"), ("1", 2, 2, 25, 31, "of: oz")]


def test_counts(docs):
    assert rows(ix.match_counts(docs, "wizard")) == [("1", 2), ("10", 1), ("2", 0), ("notes", 0), ("notes2", 0)]
    assert rows(ix.match_counts(docs, "oz wizard"))[0] == ("1", 1)
    assert {n for _, n in rows(ix.match_counts(docs, " "))} == {0}


def test_no_tokens_no_matches(docs):
    assert ix.match_offsets(docs, '""').collect() == []


def test_navigation_goes_round(spark):
    docs = spark.createDataFrame([(1, "x a x a x"), (2, "x")], "doc_id bigint, text string")
    found = rows(ix.match_navigation(ix.match_offsets(docs, "x")), "doc_id", "start", "next_start", "prev_start", "status")
    assert found == [
        (1, 0, 4, 8, "Match 1 of 3"),
        (1, 4, 8, 0, "Match 2 of 3"),
        (1, 8, 0, 4, "Match 3 of 3"),
        (2, 0, 0, 0, "Match 1 of 1"),
    ]


def test_nested(docs):
    nested = ix.nest_offsets(ix.match_offsets(docs, "of oz")).first()
    assert [(s.start, s.end) for s in nested.spans] == [(11, 16), (25, 31)]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aAb ._é𝄞\n", max_size=30), min_size=1, max_size=4))
def test_offsets_equal_plain_matching(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    pattern = re.compile(r"(?<![A-Za-z0-9_])a[^a-zA-Z0-9]+b(?![A-Za-z0-9_])", re.IGNORECASE | re.ASCII)
    expected = [(i, m.start(), m.end(), m[0]) for i, t in enumerate(texts) for m in pattern.finditer(t)]
    assert rows(ix.match_offsets(docs, "a b"), "doc_id", "start", "end", "matched") == sorted(expected)
