"""Language identification: a bidirectional gated recurrent network over bytes labels every position.

A text is read in windows of equal length from both sides. Each position gets a probability per language from the
two states that meet there; those of a document are the means over all its positions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkdex.llm.common import batch_of, slices

_LETTER = regex.compile(r"\p{L}")
UNDETERMINED = "und"


@dataclass(frozen=True)
class Settings:
    """Of the network and its training.

    ``max_rows`` bounds the different labelled texts that a model is fitted on, shared evenly among the labels, and
    ``text_windows`` the windows taken from each of them, at equal distances.
    """

    units: int = 8
    window: int = 128
    max_rows: int = 2000
    text_windows: int = 4
    steps: int = 300
    batch: int = 96
    rate: float = 0.02
    seed: int = 7


# Windows that are scored side by side.
SIDE_BY_SIDE = 1024


def windows_of(text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text in rows of ``width``, the last one filled up with zeros, and how many bytes of each row count."""
    data = np.frombuffer(text.encode(), np.uint8)
    rows = -(-len(data) // width)
    cut = np.zeros((rows, width), np.uint8)
    cut.ravel()[: len(data)] = data
    lengths = np.full(rows, width)
    if rows:
        lengths[-1] = len(data) - (rows - 1) * width
    return cut, lengths


def softsign(x: np.ndarray, out: np.ndarray, room: np.ndarray) -> None:
    """x / (1 + |x|): an S-shaped curve like tanh that costs a fraction of it."""
    np.abs(x, out=room)
    room += 1
    np.divide(x, room, out=out)


class Network:
    """Gated recurrent units of both directions.

    ``inputs`` (by byte) and ``states`` lead to update gate, reset gate and candidate, ``outputs`` to labels. Candidates are
    softsigns, gates are softsigns moved to 0..1.
    """

    def __init__(self, settings: Settings, labels: int) -> None:
        pick = np.random.default_rng(settings.seed)
        units = settings.units
        self.units = units
        self.weights = {
            "inputs": pick.normal(0, 0.5, (2, 3, 256, units)),
            "states": pick.normal(0, 0.7 / np.sqrt(units), (2, 3, units, units)),
            "outputs": pick.normal(0, 0.7 / np.sqrt(units), (2, units, labels)),
            "bias": np.zeros(labels),
        }
        self.weights = {name: w.astype(np.float32) for name, w in self.weights.items()}

    def _steps(self, width: int, direction: int):
        return range(width - 1, -1, -1) if direction else range(width)

    @staticmethod
    def _out_of_text(lengths: np.ndarray, width: int) -> list[np.ndarray]:
        """Rows that have ended before each position; the state there is zero, so that reading back begins with the text."""
        short = np.flatnonzero(lengths < width)
        return [short[lengths[short] <= t] for t in range(width)]

    def _read(self, letters: np.ndarray, ended: list[np.ndarray], direction: int, kept: list | None = None) -> np.ndarray:
        """States (position, window, unit) after each position; ``kept`` takes what backpropagation needs of each step."""
        inputs, states = self.weights["inputs"][direction], self.weights["states"][direction]
        width, n = letters.shape
        after = np.empty((width, n, self.units), inputs.dtype)
        state = np.zeros((n, self.units), inputs.dtype)
        given, told = np.empty((3, n, self.units), inputs.dtype), np.empty((3, n, self.units), inputs.dtype)
        gates, room, new, part = (np.empty_like(x) for x in (given[:2], given[:2], state, state))
        for t in self._steps(width, direction):
            np.take(inputs, letters[t], axis=1, out=given, mode="clip")
            np.matmul(state, states, out=told)
            np.add(given[:2], told[:2], out=gates)
            softsign(gates, gates, room)
            gates += 1
            gates *= 0.5
            update, reset = gates
            np.multiply(reset, told[2], out=part)
            part += given[2]
            softsign(part, new, room[0])
            np.subtract(state, new, out=part)
            part *= update
            np.add(part, new, out=after[t])
            if len(ended[t]):
                after[t][ended[t]] = 0
            if kept is not None:
                kept.append((t, state, update.copy(), reset.copy(), told[2].copy(), new.copy()))
            state = after[t]
        return after

    def _chances(self, after: list[np.ndarray]) -> np.ndarray:
        """Probabilities (label, position, window) from the states of both directions."""
        width, n, units = after[0].shape
        scores = sum(o.T @ a.reshape(-1, units).T for o, a in zip(self.weights["outputs"], after, strict=True))
        scores += self.weights["bias"][:, None]
        scores -= scores.max(axis=0)
        np.exp(scores, out=scores)
        scores /= scores.sum(axis=0)
        return scores.reshape(-1, width, n)

    def probabilities(self, windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Sums over the positions of each window of the probabilities of the labels."""
        letters = np.ascontiguousarray(windows.T).astype(np.intp)
        ended = self._out_of_text(lengths, windows.shape[1])
        chances = self._chances([self._read(letters, ended, direction) for direction in (0, 1)])
        for row in np.flatnonzero(lengths < windows.shape[1]):
            chances[:, lengths[row] :, row] = 0
        return chances.sum(axis=1).T

    def gradients(self, windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions, and its derivatives, by backpropagation through time."""
        width, n, units = windows.shape[1], len(windows), self.units
        letters, ended = np.ascontiguousarray(windows.T).astype(np.intp), self._out_of_text(lengths, windows.shape[1])
        kept: tuple[list, list] = ([], [])
        after = [self._read(letters, ended, direction, kept[direction]) for direction in (0, 1)]
        changes = self._chances(after)
        inside = np.arange(width)[:, None] < lengths[None, :]
        positions, rows = inside.sum(), np.arange(n)
        loss = float(-np.log(np.maximum(changes[labels, :, rows], 1e-30))[inside.T].sum() / positions)
        changes[labels, :, rows] -= 1
        changes *= inside / changes.dtype.type(positions)
        grads = {name: np.zeros_like(w) for name, w in self.weights.items()}
        grads["bias"] += changes.sum(axis=(1, 2))
        order = np.argsort(letters, axis=None, kind="stable")
        values, starts = np.unique(letters.ravel()[order], return_index=True)
        for direction in (0, 1):
            states, outputs = self.weights["states"][direction], self.weights["outputs"][direction]
            flat = changes.reshape(len(changes), -1)
            grads["outputs"][direction] += (flat @ after[direction].reshape(-1, units)).T
            asked = (flat.T @ outputs.T).reshape(width, n, units)
            later, sums = np.zeros((n, units), states.dtype), np.empty((3, width, n, units), states.dtype)
            for t, state, update, reset, told, new in reversed(kept[direction]):
                change = later + asked[t]
                if len(ended[t]):
                    change[ended[t]] = 0
                to_new = change * (1 - update) * (1 - np.abs(new)) ** 2
                to_update = change * (state - new) * 0.5 * (1 - np.abs(2 * update - 1)) ** 2
                to_reset = to_new * told * 0.5 * (1 - np.abs(2 * reset - 1)) ** 2
                sums[:, t] = to_update, to_reset, to_new
                through = np.stack((to_update, to_reset, to_new * reset))
                grads["states"][direction] += state.T @ through
                later = change * update + (through @ states.transpose(0, 2, 1)).sum(axis=0)
            for gate in range(3):
                grads["inputs"][direction, gate, values] = np.add.reduceat(sums[gate].reshape(-1, units)[order], starts)
        return loss, grads


def train(windows: np.ndarray, lengths: np.ndarray, labels: np.ndarray, n_labels: int, settings: Settings) -> Network:
    """Adam over random batches, with a rate that falls to nothing and a bound on the length of a step's gradient."""
    network, pick = Network(settings, n_labels), np.random.default_rng(settings.seed)
    first = {name: np.zeros_like(w) for name, w in network.weights.items()}
    second = {name: np.zeros_like(w) for name, w in network.weights.items()}
    for step in range(1, settings.steps + 1):
        chosen = pick.integers(0, len(windows), min(settings.batch, len(windows)))
        _, grads = network.gradients(windows[chosen], lengths[chosen], labels[chosen])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        rate = settings.rate * (1 - (step - 1) / settings.steps)
        for name, grad in grads.items():
            grad = grad / max(norm, 1.0)
            first[name] += 0.1 * (grad - first[name])
            second[name] += 0.01 * (grad * grad - second[name])
            step_size = rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8)
            network.weights[name] -= step_size.astype(np.float32)
    return network


@dataclass(frozen=True)
class Model:
    """The learned labels in order, and the network; none if there was nothing to learn."""

    settings: Settings
    labels: tuple[str, ...]
    network: Network | None


_SAMPLE = pa.schema([("label", pa.string()), ("hash", pa.int64()), ("windows", pa.binary()), ("lengths", pa.list_(pa.int32()))])
_WEIGHTS = pa.schema([("name", pa.string()), ("values", pa.binary()), ("labels", pa.list_(pa.string()))])


def fit(docs: DataFrame, label: Column, settings: Settings = Settings()) -> Model:
    """Fit on the texts of ``docs`` whose ``label`` is not null and that have a letter.

    The sample is the different (label, text) of the smallest hashes, label by label in turn, ``settings.max_rows`` at
    most. Only some windows of each chosen text go to the one task that fits, so neither its memory nor its time
    grows with the corpus or with its texts.
    """
    spark = docs.sparkSession
    rows = docs.select(label.cast("string").alias("label"), F.col("text").cast("string").alias("text"))
    rows = rows.where("label IS NOT NULL AND text IS NOT NULL").withColumn("hash", F.xxhash64("text"))
    lettered = rows.where(F.col("text").rlike(r"\p{L}")).select("label", "hash").distinct()
    turn = F.row_number().over(Window.partitionBy("label").orderBy("hash"))
    chosen = lettered.withColumn("turn", turn).where(F.col("turn") <= settings.max_rows)
    chosen = chosen.orderBy("turn", "label").limit(settings.max_rows).select("label", "hash")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            windows, lengths = [], []
            for text in batch.column("text"):
                all_, counts = windows_of(text.as_py(), settings.window)
                some = np.unique(np.linspace(0, len(all_) - 1, settings.text_windows).astype(int))
                windows.append(all_[some].tobytes())
                lengths.append(counts[some].tolist())
            yield batch_of(_SAMPLE, [batch.column("label"), batch.column("hash"), windows, lengths])

    texts = rows.join(F.broadcast(chosen), ["label", "hash"]).select("label", "hash", "text")
    sample = texts.mapInArrow(cut, "label string, hash bigint, windows binary, lengths array<int>")
    sample = sample.groupBy("label", "hash").agg(F.first("windows").alias("windows"), F.first("lengths").alias("lengths"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sorted((row for batch in batches for row in batch.to_pylist()), key=lambda r: (r["label"], r["hash"]))
        if held:
            names = sorted({row["label"] for row in held})
            windows = np.frombuffer(b"".join(row["windows"] for row in held), np.uint8).reshape(-1, settings.window)
            lengths = np.concatenate([row["lengths"] for row in held])
            labels = np.concatenate([np.full(len(row["lengths"]), names.index(row["label"])) for row in held])
            network = train(windows, lengths, labels, len(names), settings)
            for name, values in network.weights.items():
                yield batch_of(_WEIGHTS, [[name], [values.tobytes()], [names]])

    fitted = sample.repartition(1).mapInArrow(learn, "name string, values binary, labels array<string>").collect()
    if not fitted:
        return Model(settings, (), None)
    network = Network(settings, len(fitted[0].labels))
    for row in fitted:
        shape = network.weights[row.name].shape
        network.weights[row.name] = np.frombuffer(row["values"], np.float32).reshape(shape).copy()
    return Model(settings, tuple(fitted[0].labels), network)


class _Scorer:
    """Windows of many documents side by side, a fixed number at a time; sums by document."""

    def __init__(self, model: Model) -> None:
        self.model = model

    def chances(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Mean probabilities of each text that has bytes."""
        width, network = self.model.settings.window, self.model.network
        sums, sizes = np.zeros((len(texts), len(self.model.labels))), []
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        held = 0

        def score(windows: np.ndarray, lengths: np.ndarray, owners: np.ndarray) -> None:
            for start in range(0, len(windows), SIDE_BY_SIDE):
                part = slice(start, start + SIDE_BY_SIDE)
                np.add.at(sums, owners[part], network.probabilities(windows[part], lengths[part]))

        for number, text in enumerate(texts):
            windows, lengths = windows_of(text, width)
            sizes.append(int(lengths.sum()))
            waiting.append((windows, lengths, np.full(len(windows), number)))
            held += len(windows)
            if held >= 4 * SIDE_BY_SIDE:
                score(*map(np.concatenate, zip(*waiting, strict=True)))
                waiting, held = [], 0
        if held:
            score(*map(np.concatenate, zip(*waiting, strict=True)))
        return sums / np.maximum(np.array(sizes), 1)[:, None]


_FOUND = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("chances", pa.list_(pa.float64()))])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, chances) per row of ``docs`` by its whole text.

    ``chances`` are the probabilities of the model's labels in their order, means over all positions; ``lang_pred`` is the
    likeliest, the first of equal ones, and ``score`` its probability, both after rounding to six decimals. A text that
    is null or has no letter is ``und`` with score 0 and null ``chances``, and so is every text if nothing was learned.
    Repeated rows stay; other columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scorer = shared.value, _Scorer(shared.value)
        for batch in slices(batches):
            texts = [t.as_py() or "" for t in batch.column("text")]
            asked = [n for n, text in enumerate(texts) if known.labels and _LETTER.search(text)]
            names, scores, chances = [UNDETERMINED] * len(texts), [0.0] * len(texts), [None] * len(texts)
            for n, own in zip(asked, np.round(scorer.chances([texts[n] for n in asked]), 6) if asked else (), strict=True):
                best = int(own.argmax())
                names[n], scores[n], chances[n] = known.labels[best], float(own[best]), own.tolist()
            yield batch_of(_FOUND, [batch.column("doc_id"), names, scores, chances])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, chances array<double>")
