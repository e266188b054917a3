"""Quality classifier as a sparse rule ensemble that is one Spark column expression.

Statistics of whole texts are made once and written. On a bounded sample of labelled rows small trees
are boosted; every path from a root to a node becomes a conjunctive rule over the statistics; logistic
regression with an L1 penalty keeps few of them. The result is compiled into a sum of ``CASE`` terms, so
scoring runs inside the JVM.

Defined results: a null or empty text has all counts zero and is scored like any other. Labels that are
null, or of unknown documents, are not learned from; a repeated label counts once, as its least value.
Without labels the score is 0.5; with one class it is near that class. An empty table gives an empty
result. Only ``doc_id`` and ``text`` are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import text_statistics as S
from . import words as W
from .components import scratch, written
from .labelled import fold, sample_ids

#: Labelled rows that the model is fitted on, at most.
TRAINING_ROWS = 20_000
TREES, DEPTH, CUTS, STEP = 24, 3, 32, 0.3
#: Weight of the L1 penalty, and steps of the proximal gradient method.
PENALTY, LASSO_STEPS = 0.002, 600

#: numerator and denominator of each statistic; a denominator of zero counts as one.
STATISTICS = {
    "length": (S.n_words, None),
    "word_length": (S.word_chars, S.n_words),
    "symbols": (S.n_symbols, S.n_words),
    "exclamations": (S.count_of(b"!?"), S.n_words),
    "capitals": (S.n_upper, lambda t: t.count(S.n_upper) + t.count(S.n_lower)),
    "repeated_lines": (S.n_dup_lines, S.n_lines),
    "repeated_words": (S.n_repeat_words, S.n_words),
    "distinct_words": (S.n_distinct_words, S.n_words),
    "letter_words": (S.n_letter_words, S.n_words),
    "line_length": (S.n_words, S.n_lines),
}


class Condition(NamedTuple):
    statistic: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value > self.cut if self.above else value <= self.cut


Rule = tuple[Condition, ...]


class Model(NamedTuple):
    bias: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        terms = [F.when(reduce(Column.__and__, [c.column() for c in rule]), weight).otherwise(0.0) for rule, weight in self.rules]
        return 1 / (1 + F.exp(-reduce(Column.__add__, terms, F.lit(self.bias))))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, starts, data in W.chunks(batch.column("text")):
                t = S.Texts(starts, data)
                values = [
                    t.count(top) / (1.0 if below is None else np.maximum(t.count(below), 1)) for top, below in STATISTICS.values()
                ]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], *map(pa.array, values)], ["doc_id", *STATISTICS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


def _grown(x: np.ndarray, cuts: list[np.ndarray], slope: np.ndarray, curve: np.ndarray, names: list[str]) -> tuple[list[Rule], np.ndarray]:
    """One regression tree on gradients: its paths, and its prediction for each row."""
    paths, prediction = [], np.zeros(len(x))
    todo = [((), np.arange(len(x)))]
    while todo:
        path, rows = todo.pop()
        g, h = slope[rows], curve[rows]
        prediction[rows] = -g.sum() / (h.sum() + 1.0)
        if path:
            paths.append(path)
        if len(path) == DEPTH:
            continue
        best = (1e-3, None)
        for f, edges in enumerate(cuts):
            at = np.searchsorted(edges, x[rows, f], side="left")  # value <= edges[at]
            left_g, left_h = (np.cumsum(np.bincount(at, v, len(edges) + 1))[:-1] for v in (g, h))
            gain = left_g**2 / (left_h + 1) + (g.sum() - left_g) ** 2 / (h.sum() - left_h + 1) - g.sum() ** 2 / (h.sum() + 1)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), (f, edges[int(gain.argmax())]))
        if best[1]:
            f, cut = best[1]
            above = x[rows, f] > cut
            if 0 < above.sum() < len(rows):
                todo += [(path + (Condition(names[f], side, float(cut)),), rows[above == side]) for side in (False, True)]
    return paths, prediction


def _holds(rule: Rule, x: np.ndarray, names: list[str]) -> np.ndarray:
    return np.all([(x[:, names.index(c.statistic)] > c.cut) == c.above for c in rule], axis=0)


def fit(x: np.ndarray, y: np.ndarray, names: list[str], weight: np.ndarray | None = None) -> Model:
    """Rules of boosted trees, weighted by L1-penalised logistic regression; rows may have weights of mean 1."""
    if not len(y):
        return Model(0.0, ())
    weight = np.ones(len(y)) if weight is None else weight / weight.mean()
    share = np.clip(np.average(y, weights=weight), 0.01, 0.99)
    bias = float(np.log(share / (1 - share)))
    if y.min() == y.max():
        return Model(bias, ())
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, CUTS + 1)[1:-1])) for f in range(x.shape[1])]
    rules, total = {}, np.full(len(y), bias)
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        paths, prediction = _grown(x, cuts, weight * (p - y), weight * p * (1 - p), names)
        rules |= dict.fromkeys(paths)
        total += STEP * prediction
    rules = list(rules)
    held = np.stack([_holds(r, x, names) for r in rules], axis=1).astype(float)
    weights, momentum, inertia = np.zeros(len(rules)), np.zeros(len(rules)), 1.0
    size = 4 / (np.linalg.norm(held * np.sqrt(weight)[:, None], 2) ** 2 / len(y) + 1)
    for _ in range(LASSO_STEPS):
        error = weight * (1 / (1 + np.exp(-(held @ momentum + bias))) - y)
        bias -= size * float(error.mean())
        moved = momentum - size * (held.T @ error) / len(y)
        shrunk = np.sign(moved) * np.maximum(np.abs(moved) - size * PENALTY, 0)
        faster = (1 + np.sqrt(1 + 4 * inertia**2)) / 2
        momentum, weights, inertia = shrunk + (inertia - 1) / faster * (shrunk - weights), shrunk, faster
    return Model(bias, tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def scored(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the statistics of every row.

    Rows whose fold is ``held_out`` are not learned from.
    """
    found = written(statistics(docs), f"{scratch(docs.sparkSession)}/statistics")
    usable = labels.where(F.col(label).isNotNull() & (fold("doc_id", folds) != held_out))
    chosen = sample_ids(usable.select("doc_id", F.col(label).alias("label")), TRAINING_ROWS, "label")
    names = list(STATISTICS)
    # At most TRAINING_ROWS rows are sent; of several texts with one id the one with the least statistics is learned from.
    one = F.min(F.struct(*names, "label", "weight")).alias("row")
    rows = found.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(one).orderBy("doc_id").select("row.*").collect()
    model = fit(
        np.array([[r[n] for n in names] for r in rows]).reshape(-1, len(names)), np.array([float(r["label"]) for r in rows]), names, np.array([r["weight"] for r in rows])
    )
    return found.select(
        "doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), model.score().alias("score"), *names
    ).select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), *names)
