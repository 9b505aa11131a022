"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature is cut into bins at quantiles. Boosting goes round the features: a tree of few leaves over one feature's
bins is fitted to the gradient and added, shrunk, to that feature's lookup table. Then the pairs of features that
explain most of what is left get tables of two dimensions in the same way. A score is the logistic function of the
intercept and one table entry per feature and pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, keep
from .language import fold
from .measures import Measures

SLICE = 2 << 20
#: The classifier is fitted on at most this many labelled rows, the first by a hash of the id.
TRAINING_ROWS = 20_000
BINS, PAIR_BINS, PAIRS, ROUNDS, PAIR_ROUNDS, RATE, LEAVES, LEAF_ROWS, RIDGE = 64, 8, 6, 200, 60, 0.1, 3, 10, 1.0


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


FEATURES = {
    "words": lambda m: np.log1p(m.n_words()),
    "word length": lambda m: _share(m.word_chars(), m.n_words()),
    "symbols per word": lambda m: _share(m.count("symbol"), m.n_words()),
    "capitals": lambda m: _share(m.count("upper"), m.word_chars()),
    "lower case": lambda m: _share(m.count("lower"), m.word_chars()),
    "digits": lambda m: _share(m.count("digit"), m.word_chars()),
    "beyond ASCII": lambda m: _share(m.count("lead"), m.word_chars()),
    "stops per word": lambda m: _share(m.count("stop"), m.n_words()),
    "commas per word": lambda m: _share(m.count("comma"), m.n_words()),
    "bars per word": lambda m: _share(m.count("bar"), m.n_words()),
    "lines per word": lambda m: _share(m.n_lines(), m.n_words()),
    "repeated lines": lambda m: _share(m.n_dup_lines(), m.n_lines()),
    "repeated words": lambda m: _share(m.n_repeat_words(), m.n_words()),
    "different words": lambda m: _share(m.n_distinct_words(), m.n_words()),
}


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in byte_slices(batches, "text", SLICE):
        m = Measures(part.column("text"))
        columns = np.stack([f(m).astype(np.float64) for f in FEATURES.values()], axis=1)
        flat = pa.array(columns.ravel())
        lists = pa.ListArray.from_arrays(np.arange(0, columns.size + 1, len(FEATURES), dtype=np.int32), flat)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "features"])


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_features, "doc_id long, features array<double>")


def _grow(grad: np.ndarray, weight: np.ndarray, rows: np.ndarray, leaves: int) -> np.ndarray:
    """Step of each bin: a tree over ordered bins, split greedily, with a Newton step in each leaf."""
    cuts = [0, len(grad)]
    g, w, n = (np.concatenate([[0], np.cumsum(x)]) for x in (grad, weight, rows))
    worth = lambda a, b: (g[b] - g[a]) ** 2 / (w[b] - w[a] + RIDGE)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:]):
            c = np.arange(a + 1, b)
            c = c[(n[c] - n[a] >= LEAF_ROWS) & (n[b] - n[c] >= LEAF_ROWS)]
            if len(c):
                gain = worth(a, c) + worth(c, b) - worth(a, b)
                best = max(best, (gain.max(), int(c[gain.argmax()])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    step = np.zeros(len(grad))
    for a, b in zip(cuts, cuts[1:]):
        step[a:b] = (g[b] - g[a]) / (w[b] - w[a] + RIDGE)
    return step


def _grow_pair(grad: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, float]:
    """Step of each cell of a two-feature grid: one cut of the first feature, then one of the second on either side."""
    step, before = np.zeros_like(grad), grad.sum() ** 2 / (weight.sum() + RIDGE)
    best = (0.0, step)
    for c in range(1, grad.shape[0]):
        new, gain = np.zeros_like(grad), 0.0
        for side in (slice(0, c), slice(c, None)):
            line = _grow(grad[side].sum(0), weight[side].sum(0), rows[side].sum(0), 2)
            new[side] = line
            for value in np.unique(line):
                at = line == value
                gain += grad[side][:, at].sum() ** 2 / (weight[side][:, at].sum() + RIDGE)
        if gain - before > best[0]:
            best = (gain - before, new)
    return best[1], best[0]


@dataclass
class Model:
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    intercept: float = 0.0
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def bins(self, x: np.ndarray, pair: bool = False) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(self.pair_edges if pair else self.edges)], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        at, total = self.bins(x), np.full(len(x), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[at[:, k]]
        if self.pairs:
            at = self.bins(x, pair=True)
            for (a, b), table in self.pairs.items():
                total += table[at[:, a], at[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins, method="nearest"))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting on a matrix of features and labels 0 and 1. Without rows every score is 0.5."""
    kinds = range(x.shape[1])
    if not len(y):
        return Model([np.zeros(0)] * len(kinds), [np.zeros(1)] * len(kinds))
    model = Model([_edges(x[:, k], BINS) for k in kinds], [])
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    model.pair_edges = [_edges(x[:, k], PAIR_BINS) for k in kinds]
    rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model.intercept = float(np.log(rate / (1 - rate)))
    at, total = model.bins(x), np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for k in kinds:
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[k])
            sums = [np.bincount(at[:, k], v, minlength=size) for v in (y - p, p * (1 - p), np.ones(len(y)))]
            step = RATE * _grow(*sums, LEAVES)
            model.tables[k] += step
            total += step[at[:, k]]
    at = model.bins(x, pair=True)

    def grid(a: int, b: int) -> list[np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        shape = (len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1)
        cell = at[:, a] * shape[1] + at[:, b]
        return [np.bincount(cell, v, minlength=shape[0] * shape[1]).reshape(shape) for v in (y - p, p * (1 - p), np.ones(len(y)))]

    gains = {(a, b): _grow_pair(*grid(a, b))[1] for a, b in combinations(kinds, 2)}
    for a, b in sorted(gains, key=lambda k: (-gains[k], k))[:PAIRS]:
        model.pairs[a, b] = np.zeros((len(model.pair_edges[a]) + 1, len(model.pair_edges[b]) + 1))
    for _ in range(PAIR_ROUNDS):
        for (a, b), table in model.pairs.items():
            step = RATE * _grow_pair(*grid(a, b))[0]
            table += step
            total += step[at[:, a], at[:, b]]
    return model


def _score(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], names=["doc_id", "score"])


def classify(docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted; one row per row of `docs`.

    Learns from labelled rows outside the held-out fold (0 of 5), at most TRAINING_ROWS. Null labels and ids are not
    learned from. A null text counts as empty and is scored. Repeated rows get equal scores; where no row can be
    learned from, or all labels agree, every score is the same. Extra columns are not read.
    """
    table = keep(features(docs))
    train = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("label"))
    train = train.where("doc_id is not null and label is not null").where(fold("doc_id", 5) != 0)
    # Where there are far more labels than rows to learn from, only about twice as many reach the join and the driver.
    share = max(1, train.count() // (2 * TRAINING_ROWS))
    train = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) == 0)
    order = F.crc32(F.concat(F.lit("training"), F.col("doc_id").cast("string")).cast("binary"))
    rows = table.join(train, "doc_id").orderBy(order, "doc_id", "label").limit(TRAINING_ROWS).select("features", "label").toPandas()
    x = np.array(rows["features"].tolist(), float).reshape(len(rows), len(FEATURES))
    model = fit(x, (rows["label"].to_numpy() > 0.5).astype(float))
    scored = table.mapInArrow(lambda it: _score(model, it), "doc_id long, score double")
    return scored.select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
