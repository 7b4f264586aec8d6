"""Near-duplicates by shingles, against all pairs of sets."""

import numpy as np
import pytest

import corpus_pipeline
from inkdex.llm import shingles


def set_by_hand(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def first_by_hand(rows, least=0.8):
    """Smallest id of the group of each row."""
    sets, group = [set_by_hand(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if group[i] != group[j] and jaccard(sets[i], sets[j]) >= least:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return [min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group]


def planted():
    """Texts with copies whose similarity goes from below 0.8 up to 0.97; ids of copies are above 1000."""
    pick, rows = np.random.default_rng(8), []
    for i in range(40):
        words = [f"w{k}" for k in pick.integers(0, 5000, int(pick.integers(120, 400)))]
        rows.append((i, " ".join(words)))
        for copy in range(3):
            # New words at places of their own take five shingles each, or a stretch of one end as many as its words.
            changed = list(words)
            if copy:
                for at in pick.choice(len(words), max(1, round(len(words) * pick.choice([0.004, 0.01, 0.018, 0.03]))), replace=False):
                    changed[at] = f"x{at}"
            else:
                changed = words[: round(len(words) * pick.choice([0.75, 0.8, 0.82, 0.9, 0.97]))]
            rows.append((1000 + 10 * i + copy, " ".join(changed)))
    base = [f"z{k}" for k in range(9)]
    rows += [(3000, " ".join(base)), (3001, " ".join(base[:8])), (3002, " ".join(base[:7])), (3003, "z0 z1 z2"), (3004, "z0 z1")]
    return [*rows, (4000, None), (4001, ""), (None, rows[0][1]), (None, "alone"), (None, "ALONE"), (5, rows[20][1]), rows[0]]


@pytest.mark.parametrize("block", [4096, 8])
def test_shingle_classes_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(shingles, "BLOCK_ROWS", block)  # long lists are cut into blocks
    monkeypatch.setattr(shingles, "PAIRS", block)
    rows = planted()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, fp string").repartition(3)
    got = sorted(((r.doc_id, r.component_id) for r in shingles.shingle_classes(docs).collect()), key=str)
    assert got == sorted(zip([i for i, _ in rows], first_by_hand(rows)), key=str)
    assert shingles.shingle_classes(docs.limit(0)).count() == 0


def test_links_that_a_list_s_smallest_member_does_not_make(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words[start : start + 200]) for start in range(0, 200, 15)]  # a chain: only neighbours are alike
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {r.component_id for r in shingles.shingle_classes(docs).collect()} == {0}


def test_pipeline_drops_near_copies(spark):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    want = {i for i, first in zip([i for i, _ in rows], first_by_hand(rows)) if i == first}
    assert {r.doc_id for r in kept.collect()} == want and kept.count() == len(want)


def test_pairs_of_a_large_group_do_not_grow_with_its_square(spark):
    """600 copies of one text, each with changes of its own, a quarter of them too many: 180,000 pairs, of which few are proposed."""
    pick = np.random.default_rng(3)
    words = [f"w{k}" for k in range(150)]

    def copy(changes):
        places = set(pick.choice(len(words), changes, replace=False).tolist())
        return " ".join(f"x{pick.integers(1 << 30)}" if k in places else w for k, w in enumerate(words))

    rows = [(0, " ".join(words))] + [(n, copy(2 if n % 4 else 6)) for n in range(1, 601)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = shingles._set_hashes(docs, 5, 0.8).cache()
    lists = shingles._lists(sets)
    members = sets.selectExpr("fp", "n", "fp AS component", "signature")
    about_leaders = shingles._candidates(lists, members, 0.8, False).count()
    assert 400 <= about_leaders <= 600 * shingles.LEADERS
    found = {r.doc_id: r.component_id for r in shingles.shingle_classes(docs).collect()}
    assert found == dict(zip([i for i, _ in rows], first_by_hand(rows)))


def test_stages_keep_columns_of_any_name(spark):
    rows = [(n, t, "s", 1, 2, 3, 4, 5) for n, t in planted()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _id int, _tag int, _times int, _copy int, `a.b` int")
    for stage in (corpus_pipeline.drop_near_duplicates, corpus_pipeline.mix_sources):
        kept = stage(spark, docs, "")
        assert kept.columns == docs.columns and {tuple(r)[3:] for r in kept.collect()} == {(1, 2, 3, 4, 5)}


def test_of_equal_rows_the_same_one_stays(spark):
    rows = [(1, "one two three", f"src{n}") for n in range(9)]
    kept = [
        corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(own, "doc_id bigint, text string, source string"), "").collect()
        for own in (rows, rows[::-1])
    ]
    assert len(kept[0]) == 1 and kept[0] == kept[1]


def test_simhash_proposes_pairs(spark, monkeypatch):
    """Texts within three bits are proposed by operator 10's index, also where no band of minima lists them together."""
    words = [f"w{k}" for k in range(3000)]
    rows = [(0, " ".join(words)), (1, " ".join([*words[:-1], "x"])), (2, " ".join(words[:2000])), (3, None)]
    monkeypatch.setattr(shingles, "bands_of", lambda minima: [])
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in shingles.shingle_classes(docs).collect()} == {0: 0, 1: 0, 2: 2, 3: 3}


def test_only_links_leave_the_lists_of_several_components():
    """200 sets, each just below 0.8 with any other but for two: of 19,900 pairs that may be alike one comes out."""
    base = [f"b{k}" for k in range(204)]
    sets = [shingles.shingle_set(" ".join([*base, *(f"o{n}_{k}" for k in range(28))])) for n in range(199)]
    sets.append(shingles.shingle_set(" ".join([*base, *(f"o7_{k}" for k in range(28)), "end"])))
    signs = np.array([np.frombuffer(shingles.signature_of(shingles.minima_of(s)), np.uint8) for s in sets])
    sizes, groups = np.array([len(s) for s in sets]), np.arange(len(sets))
    found = [(one, others.tolist()) for band in range(shingles.BANDS) for one, others in shingles._between(band, signs, sizes, groups, sets, 0.8)]
    assert [(one, others) for one, others in found if others] == [(7, [199])]


def test_pairs_that_simhash_proposes_are_all_decided(spark, monkeypatch):
    """All fingerprints are equal, which one tree of links connects; the alike pair is not on it."""
    texts = [" ".join(f"w{n}_{k}" for k in range(60)) for n in range(30)]
    rows = [*enumerate(texts), (100, f"{texts[7]} end"), (101, f"{texts[11]} end")]
    monkeypatch.setattr(shingles, "bands_of", lambda minima: [])
    monkeypatch.setattr(shingles, "fingerprint", lambda text: 5)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r.component_id for r in shingles.shingle_classes(docs).collect()}
    assert found == {**{n: n for n in range(30)}, 100: 7, 101: 11}


def test_sets_decide_whatever_share_of_the_minima_is_equal():
    """A list of a band holds those whose signatures agree there, and no estimate stands between them and their sets."""
    minima = shingles.minima_of(shingles.shingle_set(" ".join(f"w{k}" for k in range(50))))
    assert shingles.bands_of(minima) == shingles.bands_of(minima ^ np.uint64(1))
    base = [f"b{k}" for k in range(300)]
    sets = [shingles.shingle_set(" ".join(words)) for words in (base, [*base, "x"], [*base[:250], *(f"y{k}" for k in range(50))], [f"z{k}" for k in range(300)])]
    signs = np.arange(4, dtype=np.uint8)[:, None].repeat(shingles.BANDS * shingles.ROWS, axis=1)
    signs[:, 10:15] = 9  # they share band 2 alone
    sizes = np.array([len(s) for s in sets])
    found = [[(one, others.tolist()) for one, others in shingles._between(band, signs, sizes, np.arange(4), sets, 0.8)] for band in (0, 2)]
    assert found == [[], [(1, [0])]] or found == [[], [(0, [1])]]
    tallies = shingles._tallies(sets, sizes)
    assert shingles._may_share(tallies, sizes, 0, np.array([1, 2, 3]), 0.8).tolist()[0] and not shingles._may_share(tallies, sizes, 0, np.array([3]), 0.8)[0]
