"""Operators on documents, against plain Python; every one on nulls, empty and long texts, and repeated rows."""

import collections
import hashlib
import math
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from inkdex.llm import bpe, digests, idcoder, mixing, ppm, simhash, toxicity

ODD = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta"),
    (2, None),
    (3, ""),
    (4, "  \t\n "),
    (5, "one"),
    (6, "two WORDS"),
    (7, "x" * 5000 + " " + "word " * 3000),
    (8, "éß \U0001f600 <|endoftext|> á   it's 123"),
    (8, "éß \U0001f600 <|endoftext|> á   it's 123"),
    (None, "no id here"),
    (9, "Alpha beta gamma delta epsilon zeta eta theta"),
    (10, "alpha BETA gamma delta epsilon zeta eta theta"),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "src", 1.5, "tag", 3) for i, t in ODD]
    # Columns of names that operators use themselves.
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string, fp double, tag string, score int").repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, source string")


def texts(rows=ODD):
    return collections.Counter((i, t or "") for i, t in rows)


def in_order(rows=ODD):
    """As documents follow each other: by id, null first (equal ids here have equal texts)."""
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))


def simhash_by_hand(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_by_hand(prints, bits=3):
    group = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    return group


def test_simhash_on_odd_rows(odd, none):
    prints = [simhash_by_hand(t) for _, t in ODD]
    group = groups_by_hand(prints)
    first = {g: min((i for (i, _), h in zip(ODD, group) if h == g and i is not None), default=None) for g in group}
    want = sorted(((i, p, first[g]) for (i, _), p, g in zip(ODD, prints, group)), key=str)
    got = simhash.simhash_classes(odd)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got.collect()), key=str) == want
    assert simhash.simhash_classes(none).count() == 0


def test_simhash_links_match_all_pairs(spark, monkeypatch):
    pick = np.random.default_rng(3)
    seeds = pick.integers(0, 2**63, 40, dtype=np.uint64)
    values = set()
    for seed in seeds.tolist():
        for _ in range(30):
            flipped = seed
            for bit in pick.integers(0, 64, pick.integers(0, 5)):
                flipped ^= 1 << int(bit)
            values.add(flipped)
    values = sorted(values)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)  # long lists are cut into blocks
    for bits in (0, 2, 3, 5):
        links = simhash.fingerprint_links(spark.createDataFrame([(int(np.uint64(v).view(np.int64)),) for v in values], "fp bigint"), bits)
        found = [(r.a % 2**64, r.b % 2**64) for r in links.collect()]
        assert all((a ^ b).bit_count() <= bits for a, b in found)
        group = {v: v for v in values}

        def top(v, group=group):
            while group[v] != v:
                v = group[v]
            return v

        for a, b in found:
            group[top(a)] = top(b)
        want = groups_by_hand(values, bits)
        assert len({(top(v), g) for v, g in zip(values, want)}) == len(set(want)) == len({top(v) for v in values})


def test_keep_first(odd):
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_first(odd).collect()), key=str)
    prints = [simhash_by_hand(t) for _, t in ODD]
    group = groups_by_hand(prints)
    want, seen = [], set()
    for g in group:
        ids = [(i, t) for (i, t), h in zip(ODD, group) if h == g]
        if g not in seen:
            seen.add(g)
            want.append(min(ids, key=lambda r: (r[0] is None, r[0] or 0)))
    assert kept == sorted(want, key=str)
    assert simhash.keep_first(odd).columns == odd.columns


def test_digests(odd, none):
    by_id = collections.defaultdict(list)
    for r in digests.compare_with_next(odd, buckets=64).collect():
        by_id[r.doc_id].append(r)
    rows = in_order()
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, theirs = (digests.digest(t, 64) for t in (text, edited, following))
        want = (len(text), hashlib.sha256(edited.encode()).digest(), own, changed, digests.likeness(own, changed), digests.likeness(own, theirs))
        got = by_id[i].pop() if i != 8 else next(r for r in by_id[8] if bytes(r.edited_sha256) == want[1])
        assert (got.n_chars, bytes(got.edited_sha256), bytes(got.digest), bytes(got.edited_digest), got.near_edited, got.near_next) == want
    assert digests.compare_with_next(none).count() == 0
    same = digests.digest("a b c")
    assert digests.likeness(same, same) == 1.0 and 0 <= digests.likeness(digests.digest(""), digests.digest("a" * 10**6)) < 1


def test_one_document_is_its_own_next(spark):
    got = digests.compare_with_next(spark.createDataFrame([(5, "abcdef")], "doc_id bigint, text string")).first()
    assert bytes(got.edited_sha256) == hashlib.sha256(b"abcabc").digest() and got.near_next == 1.0


def test_byte_bpe_is_the_librarys(odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), bpe.ByteBPE(open(path, encoding="utf-8").read())
    got = bpe.decode(bpe.encode(odd, path), path).collect()
    assert collections.Counter((r.doc_id, r.decoded) for r in got) == texts()
    for r in got:
        assert r.ids == library.encode(r.decoded, add_special_tokens=False).ids
    for text in ("a" * 3000, "ab" * 2000, "qz" * 70 + "the" * 50, "漢字" * 200, " \n\n  x y\x1c\x85"):
        assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    ids = [50256, 127, 200, 0, 17000]
    assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(none, path).count() == 0


@pytest.mark.parametrize("length", [0, 1, 255, 256, 700, 5000])
def test_coded_ids_come_back(length):
    pick = np.random.default_rng(length)
    for ids in (pick.integers(0, 49_408, length), pick.zipf(1.4, length).clip(0, 2**27), np.full(length, 9)):
        ids = ids.astype(np.uint32)
        assert (idcoder.decode_ids(idcoder.encode_ids(ids, 256)) == ids).all()


def test_damage_is_found():
    data = bytearray(idcoder.encode_ids(np.arange(3000, dtype=np.uint32) % 700, 1024))
    data[-5] ^= 1
    with pytest.raises(ValueError):
        idcoder.decode_ids(bytes(data))
    with pytest.raises(ValueError):
        idcoder.decode_ids(b"something else")


def test_repetition_is_coded_in_few_bytes():
    ids = np.tile(np.arange(100, 400, dtype=np.uint32), 40)
    assert len(idcoder.encode_ids(ids, 4096)) < len(ids) * 2 * 0.6


def test_id_files(spark, odd, none, tmp_path, monkeypatch):
    monkeypatch.setattr(idcoder, "SEGMENT_IDS", 50)
    path, out = public_tokenizers.path("word_bpe_49k.json"), str(tmp_path / "ids")
    idcoder.write_ids(odd, path, 1, out)
    read = idcoder.read_ids(spark, out).join(idcoder.segment_starts(spark, out), ["part", "segment"]).collect()
    library, start = Tokenizer.from_file(path), 0
    got = sorted((r.first + r.before, r.doc_id, r.n_tokens, r.ids_crc32, r.ids) for r in read)
    for (i, text), row in zip(in_order(), got, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 1]
        assert row == (start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids)
        start += len(ids)
    idcoder.write_ids(none, path, 1, str(tmp_path / "none"))
    assert idcoder.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_word_ids_are_the_librarys():
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    library, words = Tokenizer.from_str(source), idcoder.WordIds(source)
    for text in ("It's Á ΑΣ x", "a <|endoftext|>b 12 3\x0b4\x0c", " tab\x1cx 가", "don't..--'s"):
        assert np.frombuffer(words.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_new_words_are_given_to_the_library_together():
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    library, words, calls = Tokenizer.from_str(source), idcoder.WordIds(source), []

    class Counting:
        def __getattr__(self, name):
            calls.append(name)
            return getattr(library, name)

    words.tokenizer = Counting()
    pick = np.random.default_rng(3)
    plain = ["".join(pick.choice(list("abcdeXYZ"), 7)) for _ in range(3000)]
    texts = [" ".join(plain[:2000]), "", " \n", ",\t".join(plain[1000:]), "a\x01b \x01 x\xa0y \xa0 \u0301e e\u0301 H\u0331 <|endoftext|> </w> I\u0307", "end."]
    ids, counts = words.encode_all(pa.array(texts))
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
    assert len(calls) < 10
    before = len(calls)
    assert words.encode_all(pa.array(texts))[0].tolist() == ids.tolist() and len(calls) == before


def test_letters_and_a_stop_are_looked_up_apart():
    source = open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read()
    more = Tokenizer.from_str(source)
    more.add_tokens(["beta."])
    text = "alpha beta. Beta, beta beta.. 1. . ,; can't. é. gamma! beta.x"
    for own in (source, more.to_str()):
        words = idcoder.WordIds(own)
        assert np.frombuffer(words.encode(text), "<u4").tolist() == Tokenizer.from_str(own).encode(text, add_special_tokens=False).ids
        assert b"gamma" in words and b"gamma!" not in words and (b"." in words.apart) == (own is source)


def test_texts_are_taken_in_slices(monkeypatch):
    monkeypatch.setattr(idcoder, "TEXT_BYTES", 10)
    texts = ["a" * n for n in (0, 3, 6, 40, 0, 9, 1, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(8)), pa.array(texts)], names=["doc_id", "text"])
    got = list(idcoder._of_texts(iter([batch.slice(0, 0), batch])))
    assert pa.Table.from_batches(got).column("text").to_pylist() == texts
    assert len(got) > 3 and all(sum(map(len, b.column(1).to_pylist()[1:])) < 10 for b in got)


@pytest.mark.parametrize("length", [511, 512, 513, 20_001, 70_000])
def test_lanes_share_what_a_block_has_learned(length, monkeypatch):
    steps, step = [], idcoder._Model.step
    monkeypatch.setattr(idcoder._Model, "step", lambda self, *args: (steps.append(1), step(self, *args))[1])
    ids = (np.random.default_rng(length).zipf(1.3, length) % 500 * 90).astype(np.uint32)
    coded = idcoder.encode_ids(ids)
    assert len(steps) <= 512  # many ids a step
    assert (idcoder.decode_ids(coded) == ids).all()
    share = np.unique(ids, return_counts=True)[1] / length
    assert length < 20_000 or len(coded) * 8 < 1.1 * length * -(share * np.log2(share)).sum()
    with pytest.raises(ValueError):
        idcoder.decode_ids(coded[:-3] + bytes([coded[-3] ^ 8]) + coded[-2:])
    assert (idcoder.decode_ids(idcoder.encode_ids(ids, 1000)) == ids).all()


def ppm_by_hand(streams, learned, order):
    counts = [collections.defaultdict(collections.Counter) for _ in range(order + 1)]
    for s, known in zip(streams, learned):
        if known:
            s = b"\n" * order + s
            for i in range(order, len(s)):
                for k in range(order + 1):
                    counts[k][s[i - k : i]][s[i]] += 1

    def score(s):
        s, total = b"\n" * order + s, 0.0
        for i in range(order, len(s)):
            excluded = set()
            for k in range(order, -1, -1):
                seen = {b: n for b, n in counts[k].get(s[i - k : i], {}).items() if b not in excluded}
                if s[i] in seen:
                    total += math.log10((2 * seen[s[i]] - 1) / (2 * sum(seen.values())))
                    break
                if seen:
                    total += math.log10(len(seen) / (2 * sum(seen.values())))
                    excluded |= set(seen)
            else:
                total -= math.log10(256 - len(excluded))
        return total

    return [score(s) for s in streams]


@pytest.mark.parametrize("order,chunk", [(2, 10), (4, 1 << 20)])
def test_ppm_scores(spark, odd, order, chunk):
    got = ppm.score_texts(odd, odd["doc_id"] % 2 == 1, order, chunk).collect()
    streams = [b" ".join((t or "").encode().lower().split()) + b"\n" for _, t in ODD]
    learned = [i is not None and i % 2 == 1 for i, _ in ODD]
    tokens = [[*s[:-1].split(), b"\n"] for s in streams]
    c = collections.Counter(w for row, known in zip(tokens, learned) if known for w in row)
    n, v = sum(c.values()), len(c)
    base = [sum(math.log10((c[w] + 1) / (n + v + 1)) for w in row) for row in tokens]
    scores = ppm_by_hand(streams, learned, order)
    want = sorted(zip([i for i, _ in ODD], learned, map(len, tokens), [sum(c[w] > 0 for w in r) for r in tokens], base, scores), key=str)
    rows = sorted(((r.doc_id, r.learned, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=str)
    assert [r[:4] for r in rows] == [w[:4] for w in want] and {r.train_tokens for r in got} == {n}
    for r, w in zip(rows, want):
        assert r[4:] == pytest.approx(w[4:], rel=1e-5)


def test_ppm_with_nothing_to_learn(spark, odd, none):
    for r in ppm.score_texts(odd, odd["doc_id"] < 0).collect():
        assert r.n_known == 0 and r.base_score == 0 and r.score == pytest.approx(-math.log10(256) * round(-r.score / math.log10(256)))
    assert ppm.score_texts(none, none["doc_id"] > 0).count() == 0


def test_toxicity(spark, odd, none):
    clean = [(i, f"some plain words about thing {i % 37} and place {i % 11}", 0) for i in range(300)]
    bad = [(i, f"some rude{i % 3} words about thing {i % 37}", 1) for i in range(300, 400)]
    rows = clean + bad
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if i % 5], "doc_id bigint, label int")
    model = toxicity.fit(docs, labels.union(labels).union(spark.createDataFrame([(None, 1), (3, None)], labels.schema)))
    assert model.places.size < 500
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    assert all((scores[i] >= 0.5) == bool(y) for i, _, y in rows if i % 5 == 0)
    assert {r.doc_id for r in toxicity.keep_clean(docs, model).collect()} == set(range(300))
    scored = toxicity.score(odd, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert toxicity.keep_clean(odd, model).count() == len(ODD) and toxicity.keep_clean(odd, model).columns == odd.columns
    blank = toxicity.fit(none, labels)
    assert all(r.score == pytest.approx(0.25) for r in toxicity.score(odd, blank).collect())
    assert toxicity.score(none, model).count() == 0


def targets_by_hand(sizes, weights=(1, 2, 3)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight, capped, total = {s: weights[i % 3] for i, s in enumerate(names)}, {}, sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        if not free:
            return capped
        level = (total - sum(capped.values())) / sum(weight[s] for s in free)
        above = [s for s in free if level * weight[s] > 3 * sizes[s]]
        if not above:
            return capped | {s: level * weight[s] for s in free}
        capped |= {s: 3 * sizes[s] for s in above}


def test_mixing(spark):
    pick = np.random.default_rng(1)
    rows = []
    for source, n, words in (("a", 400, 40), ("b", 30, 60), ("é", 3, 5), ("C", 200, 30), (None, 50, 20), ("empty", 4, 0)):
        rows += [(len(rows) + i, source, " ".join(["w"] * int(pick.integers(0, 2 * words + 1)))) for i in range(n)]
    rows += [(None, "a", "x y z"), (7, "a", None), (8, "b", "same same"), (8, "b", "same same")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(5)
    got = mixing.mix(docs, block_words=64).documents.collect()
    assert len(got) == len(rows)
    sizes, taken = collections.Counter(), collections.Counter()
    for _, source, text in rows:
        sizes[source] += len((text or "").split())
    want = targets_by_hand(dict(sizes))
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(64, sizes[source] / 64 + 1)
    again = mixing.mix(docs.repartition(2), block_words=64).documents.collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    schedule = mixing.mix(docs, block_words=64).schedule.collect()
    assert len({r.slot for r in schedule}) == len(schedule)
    assert len({(r.source_no, r.turn) for r in schedule}) == len(schedule)


def test_mixing_odd_rows(odd, none):
    got = mixing.mix(odd).documents.collect()
    assert sorted(r.size for r in got) == sorted(len((t or "").encode().split()) for _, t in ODD)
    assert sum(r.taken for r in got) == pytest.approx(got[0].target, rel=0.02)
    assert mixing.mix(none).documents.count() == 0
    repeated = mixing.repeat_taken(odd)
    assert repeated.columns == odd.columns and repeated.count() == len(ODD)


def test_the_count_filter_drops_most_pairs_of_a_list():
    """Fingerprints of equal bytes at three positions, as an index list has them: few reach five."""
    pick = np.random.default_rng(1)
    values = pick.integers(0, 1 << 64, 400, dtype=np.uint64) << np.uint64(24) | np.uint64(0xABCDEF)
    values[:40] = values[40:80] ^ np.uint64(1 << 30)
    dropped = kept = 0
    for n, one in enumerate(values):
        others = values[n + 1 :]
        same = [sum(int(a) >> 8 * p & 255 == int(one) >> 8 * p & 255 for p in range(8)) for a in others]
        assert simhash.equal_bytes(others ^ one).tolist() == same
        near = [(int(a) ^ int(one)).bit_count() <= 3 for a in others]
        assert simhash._linked(one, others, 3).tolist() == near
        assert all(s >= 5 for s, k in zip(same, near) if k)
        dropped, kept = dropped + sum(s < 5 for s in same), kept + sum(s >= 5 for s in same)
    assert dropped > 100 * kept >= 4000
