"""The byte network against a plain loop over its formulas, its gradients against differences, and held-out languages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from inkdex.llm import langid

SYLLABLES = {"aa": ["ba", "ko", "ti", "la"], "bb": ["sch", "ung", "er", "ein"], "cc": ["ção", "nho", "que", "ão"]}


def some_text(pick, lang, words):
    return " ".join("".join(pick.choice(SYLLABLES[lang], pick.integers(1, 4))) for _ in range(words))


def small(units=3, window=7, labels=3):
    network = langid.Network(langid.Settings(units=units, window=window), labels)
    network.weights = {name: w.astype(np.float64) for name, w in network.weights.items()}
    return network


def by_hand(network, text):
    """Probabilities of each byte of one window, unit by unit."""

    def curve(x):
        return x / (1 + np.abs(x))

    sums = np.tile(network.weights["bias"], (len(text), 1))
    for direction in (0, 1):
        update_in, reset_in, new_in = network.weights["inputs"][direction]
        update_by, reset_by, new_by = network.weights["states"][direction]
        state = np.zeros(network.units)
        for t in range(len(text) - 1, -1, -1) if direction else range(len(text)):
            update = (1 + curve(update_in[text[t]] + state @ update_by)) / 2
            reset = (1 + curve(reset_in[text[t]] + state @ reset_by)) / 2
            new = curve(new_in[text[t]] + reset * (state @ new_by))
            state = update * state + (1 - update) * new
            sums[t] += state @ network.weights["outputs"][direction]
    chances = np.exp(sums)
    return chances / chances.sum(axis=1, keepdims=True)


def test_every_position_is_labelled():
    network = small()
    texts = [b"abcdefg", b"a", b"", b"xyzabca"]
    windows = np.zeros((4, 7), np.uint8)
    for row, text in enumerate(texts):
        windows[row, : len(text)] = np.frombuffer(text, np.uint8)
    found = network.probabilities(windows, np.array([7, 1, 0, 7]))
    for own, text in zip(found, texts):
        assert np.allclose(own, by_hand(network, text).sum(axis=0) if text else 0)


def test_gradients():
    network, pick = small(), np.random.default_rng(0)
    windows, lengths = pick.integers(0, 5, (4, 7)).astype(np.uint8), np.array([7, 3, 7, 1])
    labels = np.array([0, 1, 2, 1])
    _, grads = network.gradients(windows, lengths, labels)
    for name, weights in network.weights.items():
        for _ in range(12):
            place = tuple(pick.integers(0, min(n, 5)) for n in weights.shape)
            kept, losses = weights[place], []
            for step in (1e-6, -1e-6):
                weights[place] = kept + step
                losses.append(network.gradients(windows, lengths, labels)[0])
            weights[place] = kept
            assert (losses[0] - losses[1]) / 2e-6 == pytest.approx(grads[name][place], abs=1e-6)


def test_windows_hold_the_whole_text():
    for n in (0, 1, 127, 128, 129, 1000):
        windows, lengths = langid.windows_of("é" + "x" * n, 128)
        assert b"".join(w[:k].tobytes() for w, k in zip(windows, lengths)) == ("é" + "x" * n).encode()


def test_languages(spark):
    pick = np.random.default_rng(2)
    rows = [(i, some_text(pick, lang, int(pick.integers(2, 80))), lang, 0.5) for i, lang in enumerate(["aa", "bb", "cc"] * 100)]
    rows += [(1000, None, "aa", 0.5), (1001, "", "bb", 0.5), (1002, " 12 ½ ...\n", "cc", 0.5), (None, some_text(pick, "bb", 50), None, 0.5)]
    rows += [(1003, some_text(pick, "cc", 40_000), None, 0.5), (7, rows[7][1], "bb", 0.5)] + [(2000 + i, "same text", "aa", 0.5) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double").repartition(3)
    learned = docs.where("doc_id % 5 <> 0 OR doc_id IS NULL")
    settings = langid.Settings(steps=120, batch=32, max_rows=150)
    model = langid.fit(learned, F.col("lang"), settings)
    assert model.labels == ("aa", "bb", "cc")
    found = langid.identify(docs, model).collect()
    assert len(found) == len(rows)
    told = {r.doc_id: r for r in found}
    assert all(told[i].lang_pred == "und" and told[i].score == 0 for i in (1000, 1001, 1002))
    assert told[None].lang_pred == "bb" and told[1003].lang_pred == "cc"
    held_out = [told[r[0]].lang_pred == r[2] for r in rows[:300] if r[0] % 5 == 0]
    assert sum(held_out) >= 0.95 * len(held_out)
    assert all(0 <= r.score <= 1 and (r.chances is None or abs(sum(r.chances) - 1) < 1e-4) for r in found)
    again = langid.fit(learned.repartition(5), F.col("lang"), settings)
    assert all(np.array_equal(again.network.weights[n], w) for n, w in model.network.weights.items())


def test_nothing_to_learn_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some text", None), (2, None, "aa")], "doc_id bigint, text string, lang string")
    model = langid.fit(docs, F.col("lang"))
    assert model.labels == ()
    assert sorted((r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, model).collect()) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert langid.identify(docs.where("false"), model).collect() == []
