"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices

_WORD = re.compile(r"\w+")

# Words that a worker remembers before it starts anew.
REMEMBERED = 150_000


@dataclass(frozen=True)
class Settings:
    """Of features and training. ``max_rows`` bounds the labelled rows that a model is fitted on."""

    bits: int = 20
    skips: tuple[int, ...] = (1, 2, 3)
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    epochs: int = 4
    max_rows: int = 20_000


class _Hashes(dict):
    """Hash of each word, worked out when first asked for."""

    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh32_intdigest(word.encode())
        return value


class Features:
    """Places of a text's features among 2**bits: words, and pairs of words some steps apart.

    A word is a run of letters, digits and underscores in lower case. A pair one step apart is a
    bigram, those further apart are skip-grams.
    """

    def __init__(self, settings: Settings) -> None:
        self.shift, self.skips, self.hashes = np.uint32(32 - settings.bits), settings.skips, _Hashes()

    def places(self, text: str) -> np.ndarray:
        """With repeats; in whole-text order, kind by kind."""
        if len(self.hashes) > REMEMBERED:
            self.hashes.clear()
        words = _WORD.findall(text.lower())
        one = np.fromiter(map(self.hashes.__getitem__, words), np.uint32, len(words))
        kinds = [one * np.uint32(2654435761)]
        for step in self.skips:
            first, second = one[:-step], one[step:]
            mixed = (first ^ np.uint32(step * 40503)) * np.uint32(2246822519) + second * np.uint32(3266489917)
            kinds.append((mixed ^ mixed >> np.uint32(15)) * np.uint32(668265263))
        return np.concatenate(kinds) >> self.shift


class Ftrl:
    """Follow the regularized leader, with a learning rate per coordinate.

    The bias is the log-odds of the labels and stays so: a text of unknown features is as toxic as any.
    """

    def __init__(self, settings: Settings, positive: int, rows: int) -> None:
        self.s = settings
        self.z, self.n = np.zeros(1 << settings.bits), np.zeros(1 << settings.bits)
        self.bias = math.log((positive + 0.5) / (rows - positive + 1.5))

    def weights(self, places: np.ndarray) -> np.ndarray:
        """Zero where the evidence has not passed l1."""
        s, z = self.s, self.z[places]
        kept = np.maximum(np.abs(z) - s.l1, 0.0) * -np.sign(z)
        return kept / ((s.beta + np.sqrt(self.n[places])) / s.alpha + s.l2)

    def learn(self, places: np.ndarray, label: int) -> None:
        w = self.weights(places)
        gap = sigmoid(self.bias + w.sum()) - label
        n = self.n[places]
        self.z[places] += gap - (np.sqrt(n + gap * gap) - np.sqrt(n)) / self.s.alpha * w
        self.n[places] = n + gap * gap


def sigmoid(x: float) -> float:
    return 1.0 / (1.0 + math.exp(-x)) if x > -700 else 0.0


@dataclass(frozen=True)
class Model:
    """The weights that are not zero: ascending places, their weights, and the bias."""

    settings: Settings
    places: np.ndarray
    values: np.ndarray
    bias: float

    def scorer(self):
        dense = np.zeros(1 << self.settings.bits, np.float32)
        dense[self.places] = self.values
        features = Features(self.settings)

        def score(text: str | None) -> float:
            places = features.places(text or "")
            found = np.unique(places[dense[places] != 0])
            return sigmoid(self.bias + float(dense[found].sum(dtype=np.float64)))

        return score


_WEIGHTS = pa.schema([("place", pa.int64()), ("weight", pa.float64())])


def fit(docs: DataFrame, labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on the texts of ``docs`` whose doc_id is in ``labelled`` (doc_id, label 0 or 1).

    Null ids and labels are left out; an id labelled both ways counts as 1. At most
    ``settings.max_rows`` ids are used, those of the smallest hashes, so that one task, which takes
    the rows in the order of the hashes, fits the model; neither its memory nor its time grows with the corpus.
    Without rows the model gives every text 1/4.
    """
    spark = docs.sparkSession
    order = F.xxhash64("doc_id").alias("place")
    known = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label"))
    known = known.where("doc_id IS NOT NULL AND label IS NOT NULL").groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = known.orderBy(order, "doc_id").limit(settings.max_rows)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").select(order, "label", "text")

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, seen = Features(settings), []
        for batch in slices(batches):
            for place, label, text in zip(*batch.columns, strict=True):
                found = np.unique(features.places(text.as_py())).astype(np.int32)
                seen.append((place.as_py(), label.as_py(), found))
        seen.sort(key=lambda row: (row[0], row[2].tobytes()))
        model = Ftrl(settings, sum(row[1] for row in seen), len(seen))
        for _ in range(settings.epochs):
            for _, label, found in seen:
                model.learn(found, label)
        weights = model.weights(np.arange(len(model.z)))
        kept = np.flatnonzero(weights)
        yield batch_of(_WEIGHTS, [[-1, *kept], [model.bias, *weights[kept]]])  # place -1: the bias

    trained = rows.repartition(1).mapInArrow(train, "place bigint, weight double").toPandas()
    trained = trained.sort_values("place")
    places, values = trained["place"].to_numpy(), trained["weight"].to_numpy()
    bias = float(values[0]) if len(values) else math.log(0.5 / 1.5)
    return Model(settings, places[1:], values[1:].astype(np.float32), bias)


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) per row of ``docs``: how likely the whole text is to be labelled 1.

    Null texts are empty and get the score of the bias alone; repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in slices(batches):
            yield batch_of(_SCORES, [batch.column("doc_id"), [scorer(t.as_py()) for t in batch.column("text")]])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, score double")


def keep_clean(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores below ``least``.

    The text goes to the model and comes back with the other columns, whatever they are, in one pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in slices(batches):
            yield batch.filter(pa.array([scorer(t.as_py()) < least for t in batch.column("text")], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
