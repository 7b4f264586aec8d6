"""Operators on pages and embeddings, graph components, and the pipeline, against plain Python."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from inkdex.llm import covertree, extraction, queries, redirects, toxicity
from inkdex.llm.common import components, numbered, remainder

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def reach(edges):
    """Smallest node of each component."""
    label = {v: v for e in edges for v in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    return label


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(1, 1), (None, 2)],
        [(i, i + 1) for i in range(60)],
        [(0, i) for i in range(1, 90)] + [(200, 201), (201, 200), (200, 201)],
        [(int(a), int(b)) for a, b in np.random.default_rng(2).integers(0, 120, (90, 2))],
    ],
)
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    want = reach([e for e in edges if None not in e and e[0] != e[1]])
    assert {r.node: r.component for r in found} == want and len(found) == len(want)


def test_numbered(spark):
    df = spark.createDataFrame([(i * 7 % 50,) for i in range(50)], "k int").repartition(4)
    assert {r.k: r.number for r in numbered(df, "k").collect()} == {i: i for i in range(50)}


def page(i, url, canonical=None, refresh=None):
    link = f'<LINK href="{canonical}" rel=canonical>' if canonical else ""
    meta = f'<meta http-equiv="Refresh" content="0; URL=\'{refresh}\'">' if refresh else ""
    return i, url, f"<html><head>{link}{meta}</head><body>x</body></html>", "clash"


def test_url_verdicts(spark):
    rows = [
        page(1, "http://a.example.org/es/1"),  # blocked by rule
        page(2, "https://mirror.net/x", canonical="http://a.example.org/es/1"),  # its alias
        page(3, "https://mirror.net/y", refresh="/x"),  # alias of the alias
        page(4, "http://b.net/1", canonical="http://c.com/de/1"),  # alias of a blocked address without a page
        page(5, "http://b.net/2", canonical="http://c.com/de/2"),
        page(6, "http://C.com/fr/2", canonical="http://c.com/de/2"),  # allowed by rule, and saves page 5
        page(7, "http://www.example.org/en/123?x=1#y"),
        page(8, "http://EXAMPLE.org/en/2"),
        page(9, "http://notexample.org/es/"),  # no subdomain of example.org: the rule of org
        page(10, "http://x.net"),
        page(11, "no scheme"),
        (12, None, None, "clash"),
        (None, "http://x.net", "", "clash"),
        page(1, "http://a.example.org/es/1"),
        page(13, "http://from.net/a"),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, node string")
    moved = spark.createDataFrame([("http://from.net/a#top", "http://c.com/de/9"), (None, "x")], "from_url string, to_url string")
    got = sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in redirects.url_verdicts(pages, RULES, moved).collect()), key=str)
    assert got == sorted(
        [
            (1, "a.example.org", "/es/1", "example.org/es/", "block"),
            (1, "a.example.org", "/es/1", "example.org/es/", "block"),
            (2, "mirror.net", "/x", None, "block"),
            (3, "mirror.net", "/y", None, "block"),
            (4, "b.net", "/1", None, "block"),
            (5, "b.net", "/2", None, "allow"),
            (6, "c.com", "/fr/2", "com/fr/", "allow"),
            (7, "www.example.org", "/en/123", "example.org/en/1", "block"),
            (8, "example.org", "/en/2", "org/", "allow"),
            (9, "notexample.org", "/es/", "org/", "allow"),
            (10, "x.net", "", None, "allow"),
            (11, "", "", None, "allow"),
            (12, "", "", None, "allow"),
            (None, "x.net", "", None, "allow"),
            (13, "from.net", "/a", None, "block"),
        ],
        key=str,
    )
    assert redirects.url_verdicts(pages.limit(0), RULES).count() == 0
    with pytest.raises(ValueError):
        redirects.rule_of(F.col("host"), F.col("path"), [("allow", "/nothing")])


def made_page(i):
    body = "".join(f"<p>Sentence {k} of page {i}, with words enough to be a paragraph.</p>" for k in range(2 + i % 4))
    return (
        f"<html><head><title>T{i}</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav>"
        f"<div class=ad>Buy thing {i} now.</div><article><h1>Head {i}</h1>{body}</article><footer>&copy; {i} all rights</footer></body></html>"
    )


def test_extraction(spark):
    odd = [
        None,
        "",
        "no markup at all",
        "<p>unclosed <b>bold",
        "<<<>>> <!-- never ends",
        "<article><p>A &amp; B&nbsp;&#x43; &am</p><p> one\n two <br>three</article>",
    ]
    rows = [(i, f"u{i}", made_page(i), "x") for i in range(40)] + [(100 + i, None, h, "x") for i, h in enumerate(odd)] + [(None, "u", made_page(3), "x")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").repartition(3)
    model = extraction.fit(pages)
    got = {r.page_id: r.text for r in extraction.extract(pages, model).collect()}
    assert len(got) == len(rows)
    for i in range(40):
        want = [f"Head {i}", *(f"Sentence {k} of page {i}, with words enough to be a paragraph." for k in range(2 + i % 4))]
        assert got[i] == "\n".join(want)
    assert got[None] == got[3] and got[100] == got[101] == ""
    assert got[105] == "A & B C &am\none two three"
    assert extraction.fit(pages.limit(0)) is None
    assert {r.text for r in extraction.extract(pages, None).collect()} == {""}


def test_decoding_does_not_contradict_itself():
    page = extraction.Page("<div><section><p>a</p></section><p>b</p></div><p>c</p>")
    for seed in range(50):
        kept = extraction.decode(page, np.random.default_rng(seed).normal(size=len(page.elements)))
        for number, e in enumerate(page.elements[1:], 1):
            above = [e.parent]
            while above[-1] > 0:
                above.append(page.elements[above[-1]].parent)
            states = [bool(kept[number]), *(bool(kept[a]) for a in above)]
            assert sum(x != y for x, y in zip(states, states[1:])) <= 2 - states[-1]


def links_by_hand(rows, least):
    unit = []
    for _, v, label in rows:
        ok = label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)
        unit.append(np.array(v, float) / np.linalg.norm(v) if ok else None)
    edges = []
    for i in range(len(rows)):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                if unit[i] @ unit[j] >= least:
                    edges.append((j, i))
    n = collections.Counter(v for e in edges for v in e)
    root = reach(edges)
    members = collections.defaultdict(list)
    for i in range(len(rows)):
        members[root.get(i, i)].append(rows[i][0])
    first = {r: min((m for m in ids if m is not None), default=None) for r, ids in members.items()}
    return sorted(((rows[i][0], n[i], first[root.get(i, i)], rows[i][0] == first[root.get(i, i)]) for i in range(len(rows))), key=str)


def test_embeddings(spark):
    pick = np.random.default_rng(4)
    rows = []
    for label in (0, 0, 0, 1):
        for _ in range(6):
            centre = pick.normal(size=8)
            rows += [(len(rows) + k, (centre + pick.normal(size=8) * s).astype(np.float32).tolist(), label) for k, s in enumerate([0, 0.02, 0.05, 0.1, 0.1, 0.3])]
    rows += [(len(rows) + k, rows[3][1], rows[3][2]) for k in range(40)]  # copies
    odd = [None, [], [0.0] * 8, [1.0, None] + [0.0] * 6, [float("nan")] * 8, [float("inf")] + [0.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(2000, rows[0][1], None), (None, rows[0][1], 0), (5, rows[0][1], 0), (None, None, None)]
    vectors = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, unit string").repartition(3)
    want = links_by_hand(rows, 0.98)
    for leaf in (8, 2048):
        got = covertree.near_duplicates(vectors, leaf_points=leaf).collect()
        assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == want
    assert covertree.near_duplicates(vectors.limit(0)).count() == 0


def test_embeddings_closer_than_any_level(spark):
    rows = [(i, [1.0, 1e-7 * i], 0) for i in range(300)]
    got = covertree.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), leaf_points=20)
    assert {(r.n_links, r.component_id) for r in got.collect()} == {(299, 0)}


def test_traversal_finds_all_pairs():
    pick = np.random.default_rng(5)
    points = np.concatenate([c + pick.normal(size=(150, 6)) * 0.05 for c in pick.normal(size=(6, 6))])
    points /= np.linalg.norm(points, axis=1)[:, None]
    links = covertree.Links(np.ones(len(points), np.int64))
    tree = covertree.root_of(points)
    covertree.traverse(points, tree, tree, 0.98, links)
    near = points @ points.T >= 0.98
    assert (links.links == near.sum(axis=1) - 1).all()


def test_pipeline(spark, tmp_path, monkeypatch):
    words = [f"w{i}" for i in range(300)]
    pick = np.random.default_rng(6)
    rows = []
    for i in range(120):
        text = " ".join(pick.choice(words, 60)) + (" rude" * 3 + " nasty" if i % 6 == 0 else "")
        rows.append((i, text, "en", f"s{i % 4}", len(text)))
    rows += [(200 + i, rows[i][1], "en", "s1", rows[i][4]) for i in range(1, 20, 2)]  # copies
    rows += [(300, None, None, None, None), (301, "", "en", "s0", 0), (None, "an unnamed text", "en", "s0", 15)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, 0, int(i % 6 == 0)) for i in range(120)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        if name != "encoding":
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = collections.Counter(r.doc_id for r in docs.collect())
    clean = {i for i in range(120) if i % 6} | {200 + i for i in range(1, 20, 2)} - {200 + i for i in range(0, 120, 6)} | {300, 301, None}
    assert set(kept["toxicity"]) == clean
    single = {i for i in clean if i is None or i < 200 or i == 300}  # 301 is empty as 300 is
    assert set(kept["near_duplicates"]) == single and max(kept["near_duplicates"].values()) == 1
    assert set(kept["mixing"]) <= single and 0.6 * len(single) < sum(kept["mixing"].values()) < 1.5 * len(single)
    assert kept["encoding"] == kept["mixing"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == docs.count()


def test_held_out_rows_are_never_learned(spark):
    rows = spark.range(50).withColumn("doc_id", F.col("id")).select("doc_id", remainder(F.col("doc_id"), 5).alias("m")).collect()
    import zlib

    assert all(r.m == zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def test_queries_are_registered():
    names = set(queries.queries())
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 11)}
    assert set(queries.oracle_sql()) <= names
    assert toxicity.Settings().max_rows == 20_000
