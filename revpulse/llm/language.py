"""Language of a text by a string kernel with landmarks.

A text is the set of its character n-grams of several orders (a blended spectrum, presence only), hashed
into ``BUCKETS``. The kernel of two texts is the cosine of their sets. A few sample texts of each language
are landmarks: kernels with them, whitened, are the features of the Nystrom method, on which one ridge
regression per language is fitted against the rest. Scoring a block of texts is two matrix products.

Letters are lower-cased (A-Z); runs of bytes that are no letters count as one gap. n-grams are of bytes of
UTF-8, over the whole text.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Rows with a null language
are not learned from; a repeated id counts once. If no row can be learned from, every text is ``und``.
The score is the ridge value of the winner, moved from [-1, 1] to [0, 1]; equal values go to the language
that sorts first. An empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .labelled import fold, sample_ids

#: Texts that the model is fitted on, and landmarks of each language, at most.
TRAINING_TEXTS, LANDMARKS = 3000, 32
ORDERS, BUCKETS = (1, 2, 3), 1 << 13
RIDGE = 1e-2
#: Texts scored by one matrix product.
BLOCK = 256
UNKNOWN = "und"

_LETTERS = W.byte_set(bytes(range(65, 91))) | W.byte_set(bytes(range(97, 123))) | W.byte_set(bytes(range(128, 256)))
_CODES = np.where(_LETTERS, W.byte_codes(fold_case=True), np.uint64(1))


class Model(NamedTuple):
    languages: list[str]
    landmarks: np.ndarray  # bucket by landmark, each landmark of length one
    weights: np.ndarray  # landmark by language

    def values(self, present: np.ndarray) -> np.ndarray:
        length = np.sqrt(np.maximum(present.sum(1), 1, dtype=np.float32))[:, None]
        return (present @ self.landmarks / length) @ self.weights


def spectra(starts: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Presence of each n-gram bucket in each text, as a matrix of bytes."""
    gap = ~_LETTERS[data]
    kept = np.ones(len(data), bool)
    kept[1:] = ~(gap[1:] & gap[:-1])
    kept[starts[:-1][starts[:-1] < len(data)]] = True
    codes = _CODES[data[kept]]
    first = np.append(0, np.cumsum(kept))[starts]
    texts = len(starts) - 1
    owner = np.repeat(np.arange(texts), np.diff(first)) * BUCKETS
    present = np.zeros(texts * BUCKETS, np.uint8)
    for order in ORDERS:
        grams = W.hash_windows(codes, order) >> np.uint64(51)
        whole = owner[: len(grams)] == owner[order - 1 :]
        present[owner[: len(grams)][whole] + grams[whole].astype(np.int64)] = 1
    return present.reshape(texts, BUCKETS)


def blocks(column: pa.Array) -> Iterator[tuple[slice, np.ndarray]]:
    for rows, starts, data in W.chunks(column):
        for at in range(0, len(starts) - 1, BLOCK):
            part = starts[at : at + BLOCK + 1]
            yield slice(rows.start + at, rows.start + at + len(part) - 1), spectra(part - part[0], data[part[0] : part[-1]])


def _spectrum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, present in blocks(batch.column("text")):
            packed = pa.array([row.tobytes() for row in np.packbits(present, axis=1)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], batch.column("lang")[rows], packed], ["doc_id", "lang", "spectrum"])


def fit(present: np.ndarray, languages: list[str]) -> Model:
    """Landmarks are the first texts of each language; the rest of the fit is two small eigenproblems."""
    names, y = np.unique(np.array(languages, dtype=object), return_inverse=True)
    of = [np.flatnonzero(y == k)[:LANDMARKS] for k in range(len(names))]
    unit = present.astype(np.float32) / np.sqrt(np.maximum(present.sum(1, keepdims=True), 1))
    landmarks = unit[np.concatenate(of)]
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(float))
    good = values > 1e-8 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = (unit @ landmarks.T).astype(float) @ whiten
    goal = np.where(y[:, None] == np.arange(len(names)), 1.0, -1.0)
    # Every language weighs the same, however many of its texts were sampled.
    share = (1 / np.bincount(y))[y][:, None]
    ridge = np.linalg.solve(features.T @ (share * features) + RIDGE * np.eye(features.shape[1]), features.T @ (share * goal))
    return Model(names.tolist(), np.ascontiguousarray(landmarks.T), (whiten @ ridge).astype(np.float32))


def trained(docs: DataFrame, folds: int = 4, held_out: int = 2) -> Model | None:
    """The model of a bounded sample of rows with a language; the fold ``held_out`` is not learned from."""
    usable = docs.where(F.col("lang").isNotNull() & (fold("doc_id", folds) != held_out))
    chosen = F.broadcast(sample_ids(usable.select("doc_id", "lang"), TRAINING_TEXTS, "lang"))  # at most that many rows
    found = docs.select("doc_id", "text").join(chosen, "doc_id").mapInArrow(
        _spectrum_rows, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, spectrum binary"
    )
    # Ordered by text and not by id: the first texts of a language become landmarks.
    rows = sorted({r["doc_id"]: (r["spectrum"], r["lang"]) for r in found.collect()}.values())
    if not rows:
        return None
    present = np.unpackbits(np.stack([np.frombuffer(s, np.uint8) for s, _ in rows]), axis=1)
    order = np.random.default_rng(11).permutation(len(rows))
    return fit(present[order], [rows[k][1] for k in order])


def _has_letter(texts: pa.Array) -> np.ndarray:
    return np.array([t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)


def predicted(docs: DataFrame, model: Model | None, folds: int = 4, held_out: int = 2) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, present in blocks(batch.column("text")):
                if model:
                    values = model.values(present.astype(np.float32))
                    best = values.argmax(1)
                    score = np.clip((values.max(1).astype(float) + 1) / 2, 0, 1)
                    names = np.array(model.languages, dtype=object)[best]
                else:
                    score, names = np.zeros(len(present)), np.full(len(present), UNKNOWN, dtype=object)
                lettered = _has_letter(batch.column("text")[rows])
                names[~lettered], score[~lettered] = UNKNOWN, 0.0
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows], pa.array(names, pa.string()), pa.array(score)], ["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "lang_pred", "score")
