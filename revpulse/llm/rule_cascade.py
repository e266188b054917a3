"""Quality rules as a short-circuit cascade: the rule with the most rejections per second goes first.

Every rule is tried alone on a sample of the texts, where its running time and its rejections are
measured. Ordered by rejections per second, each rule then sees only the texts that the earlier ones
let through. The order changes the cost and the name of the rule that rejects, never the verdict.

The base counts of a text are made for all texts; a text that fails the base is not shown to the rules.
Defined results: a null or empty text has no words and fails the base. Repeated rows are judged alike.
An empty table gives an empty result. Columns other than ``doc_id`` and ``text`` are passed through by
``keep`` whatever their names, and not looked at by ``judged``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text_statistics as S
from . import words as W

#: Rows on which costs and selectivities are estimated. The estimate changes no verdict.
SAMPLE_ROWS = 2000
#: Texts are gathered anew for the next rule once fewer than this share of them is left.
GATHER_BELOW = 0.8


class Rule(NamedTuple):
    name: str
    rejects: Callable[[S.Texts], np.ndarray]


def _words(t: S.Texts) -> np.ndarray:
    return t.count(S.n_words)


RULES = (
    Rule("symbols", lambda t: 10 * t.count(S.n_symbols) > _words(t)),
    Rule("capitals", lambda t: t.count(S.n_upper) > t.count(S.n_lower) + t.count(S.n_beyond_ascii)),
    Rule("repeated_lines", lambda t: 10 * t.count(S.n_dup_lines) > 4 * t.count(S.n_lines)),
    Rule("few_letter_words", lambda t: 10 * t.count(S.n_letter_words) < 7 * _words(t)),
    Rule("few_distinct_words", lambda t: 10 * t.count(S.n_distinct_in_stretches) < _words(t)),
    Rule("short_words", lambda t: t.count(S.word_chars) < 2 * _words(t)),
    # Not in scripts without spaces.
    Rule("long_words", lambda t: (t.count(S.word_chars) > 15 * _words(t)) & (2 * t.count(S.n_beyond_ascii) < t.count(S.word_chars))),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def base_failed(t: S.Texts) -> np.ndarray:
    return (_words(t) < 50) | (100 * t.count(S.n_repeat_words) > 50 * _words(t))


def _tried(rules: tuple[Rule, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = np.zeros(len(rules)), np.zeros(len(rules))
        for batch in batches:
            for _, starts, data in W.chunks(batch.column("text")):
                texts = S.Texts(starts, data)
                texts = texts.only(~base_failed(texts))
                for k, rule in enumerate(rules):
                    alone = S.Texts(texts.words.text_starts, texts.words.data)
                    began = time.perf_counter()
                    rejected[k] += rule.rejects(alone).sum()
                    seconds[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(range(len(rules))), pa.array(seconds), pa.array(rejected)], ["rule", "seconds", "rejected"])

    return run


def ordered(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> tuple[Rule, ...]:
    """The rules by falling rejections per second, as measured on about ``sample_rows`` of the texts."""
    rows = docs.count()
    if not rows:
        return rules
    sample = docs.select("text").sample(min(1.0, sample_rows / rows), seed=17)
    measured = sample.mapInArrow(_tried(rules), "rule long, seconds double, rejected double")
    worth = {
        r["rule"]: (-r["rejected"] / max(r["seconds"], 1e-9), r["seconds"])
        for r in measured.groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected")).collect()
    }
    return tuple(rules[k] for k in sorted(range(len(rules)), key=lambda k: worth.get(k, (0, 0))))


def _first_rejection(texts: S.Texts, rules: tuple[Rule, ...]) -> np.ndarray:
    """Index of the rule that rejects each text: -1 for none, -2 for the base."""
    found = np.where(base_failed(texts), -2, -1)
    at = np.arange(texts.size)  # texts that are still looked at
    alive = found == -1
    for k, rule in enumerate(rules):
        if alive.sum() < GATHER_BELOW * len(alive):
            texts, at, alive = texts.only(alive), at[alive], np.ones(int(alive.sum()), bool)
        if not len(at):
            break
        rejected = rule.rejects(texts) & alive
        found[at[rejected]] = k
        alive &= ~rejected
    return found


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """For every row ``doc_id``, the base counts, ``base_failed``, ``kept`` and the rule that rejected it."""
    docs = docs.select("doc_id", "text")
    rules = ordered(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([r.name for r in rules] + ["base", None], dtype=object)  # -2 and -1 count from the end
        for batch in batches:
            for rows, starts, data in W.chunks(batch.column("text")):
                texts = S.Texts(starts, data)
                rejected = _first_rejection(texts, rules)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id")[rows],
                        *(pa.array(texts.count(getattr(S, c)).astype(np.int64)) for c in BASE),
                        pa.array(rejected == -2),
                        pa.array(rejected == -1),
                        pa.array(names[rejected], pa.string()),
                    ],
                    ["doc_id", *BASE, "base_failed", "kept", "rejected_by"],
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"{c} long" for c in BASE)
    return docs.mapInArrow(run, f"doc_id {key}, {counts}, base_failed boolean, kept boolean, rejected_by string")


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that neither the base nor a rule rejects, with all their columns."""
    rules = ordered(docs, rules, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, starts, data in W.chunks(batch.column("text")):
                passed = _first_rejection(S.Texts(starts, data), rules) == -1
                yield batch[rows].filter(pa.array(passed))

    return docs.mapInArrow(run, docs.schema)
