"""Periodic runs against plain comparisons of words at every distance."""

import hashlib
import random
import zlib
from fractions import Fraction

import pytest

from inkdex.llm import queries, runs


def lyndon_by_hand(ranks):
    found = []
    for i in range(len(ranks)):
        j = i + 1
        while j < len(ranks) and ranks[j:] > ranks[i:]:
            j += 1
        found.append(j - i)
    return found


def runs_by_hand(words, least=24, periods=3):
    found, n = [], len(words)
    for q in range(1, n // periods + 1):
        j = 0
        while j < n - q:
            k = j
            while k < n - q and words[k] == words[k + q]:
                k += 1
            length = k - j + q
            if k > j and length >= max(least, periods * q):
                own = words[j : j + length]
                if all(own[: length - d] != own[d:] for d in range(1, q)):
                    found.append((j, length, q))
            j = max(k, j + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(pick, n, kinds):
    words = [pick.randrange(kinds) for _ in range(n)]
    if n and pick.random() < 0.7:
        a, p = pick.randrange(n), 1 + pick.randrange(7)
        for i in range(a, min(n, a + pick.randrange(60))):
            words[i] = words[a + (i - a) % p]
    return words


def test_lyndon_arrays_under_both_orders():
    pick = random.Random(3)
    for _ in range(2000):
        words = some_words(pick, pick.randrange(1, 16), pick.randrange(1, 4))
        kinds = sorted(set(words))
        ranks = [kinds.index(w) for w in words]
        for own in (ranks, [len(kinds) - 1 - r for r in ranks]):
            lengths, groups = runs.lyndon_groups(own)
            assert lengths == lyndon_by_hand(own)
            roots = [tuple(own[i : i + n]) for i, n in enumerate(lengths)]
            assert all((groups[i] == groups[j]) == (roots[i] == roots[j]) for i in range(len(own)) for j in range(i))


@pytest.mark.parametrize("least", [3, 6, 24])
def test_runs(least):
    pick = random.Random(least)
    for _ in range(1500):
        words = some_words(pick, pick.randrange(80), pick.randrange(1, 5))
        assert runs.runs_of(words, least) == runs_by_hand(words, least)


def test_words_of_many_runs():
    fibonacci, other = "a", "ab"
    while len(other) < 600:
        fibonacci, other = other, other + fibonacci
    for words in (list(other), list("ab" * 300), ["x"] * 500, list("aab" * 20 + "aabaab" + "b" * 40 + "ab" * 30)):
        assert runs.runs_of(words) == runs_by_hand(words)


def periodic(doc_id, words):
    h = zlib.crc32(str("" if doc_id is None else doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def row_by_hand(doc_id, text):
    words = periodic(doc_id, (text or "").encode().split())
    found = runs_by_hand(words)
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    rest = b" ".join(w for i, w in enumerate(words) if i not in gone)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    return doc_id, len(found), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(rest).hexdigest()


def test_query(spark, tmp_path):
    pick = random.Random(9)
    rows = [(i, " ".join(map(str, some_words(pick, pick.randrange(200), pick.choice([2, 3, 40, 500]))))) for i in range(120)]
    rows += [(3, None), (3, ""), (4, " \t\n"), (None, "x y " * 30), (None, None), (5, "é ü " * 26), (5, "é ü " * 26)]
    rows += [(1_000, "very long " * 3000 + " ".join(map(str, range(3000))) + " no more" * 500)]
    docs = spark.createDataFrame([(i, t, 1, "w") for i, t in rows], "doc_id bigint, text string, runs int, words string")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op13_runs(spark, str(tmp_path)).collect()
    long = [r for r in found if r.doc_id == 1_000]
    assert [(r.n_runs, r.start, r.length, r.period, r.exponent_milli) for r in long] == [(2, 0, 6000, 2, 3_000_000)]
    assert sorted(map(repr, map(tuple, (r for r in found if r.doc_id != 1_000)))) == sorted(repr(row_by_hand(*r)) for r in rows if r[0] != 1_000)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert runs.find_runs(none).collect() == []
