from collections import defaultdict
from fractions import Fraction

import numpy as np

from revpulse.llm import mixing as M

WEIGHTS = M.Weights({"a": "web", "b": "web", "c": "books"}, {"web": 3, "books": 1}, {"en": 2, "de": 1}, {"a": 5, "zero": 0})


def split(given, children):
    """Water-filling by rounds: who is full gives back, until no one is. children: {name: (weight, capacity)}"""
    budget, open_ = {}, dict(children)
    left = given
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [k for k, (w, c) in open_.items() if Fraction(left * w, total) >= c]
        if not full:
            return budget | {k: left * w // total for k, (w, _) in open_.items()}
        for k in full:
            budget[k] = open_.pop(k)[1]
        left = given - sum(budget.values())
    return budget


def leaf_budgets(supply, weights, total, epochs):
    w = lambda level, k: getattr(weights, level).get(k, weights.other_weight)
    supply = {k: s for k, s in supply.items() if w("domain", k[0]) * w("lang", k[1]) * w("source", k[2])}

    def down(prefix, given):
        depth = len(prefix)
        if depth == 3:
            return {prefix: given}
        children = defaultdict(int)
        for k, s in supply.items():
            if k[:depth] == prefix:
                children[k[depth]] += s * epochs
        out = {}
        for name, part in split(given, {c: (w(M.LEVELS[depth], c), cap) for c, cap in children.items()}).items():
            out |= down((*prefix, name), part)
        return out

    return down((), min(total, epochs * sum(supply.values())))


def documents(spark, seed=0, n=150):
    rng = np.random.default_rng(seed)
    rows = [
        (k, " ".join(["w"] * int(rng.integers(0, 40))), str(rng.choice(["en", "de", "fr"])), str(rng.choice(["a", "a", "a", "b", "c", "d", "zero"])), "x", 1)
        for k in range(n)
    ]
    rows += [(1000, None, "en", "a", "x", 1), (1001, "w w", None, None, "x", 1), (None, "w", "en", "a", "x", 1), (1002, "v v v", "en", "c", "x", 1), (1002, "v v v", "en", "c", "x", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string, epoch int")


def supply(docs):
    out = defaultdict(int)
    for r in docs.collect():
        n = len((r["text"] or "").split())
        if n and r["doc_id"] is not None:
            source = r["source"] or "unknown"
            out[(WEIGHTS.domains.get(source, "other"), r["lang"] or "und", source)] += n
    return out


def test_budgets_equal_water_filling(spark):
    docs = documents(spark)
    held = supply(docs)
    for total, epochs in ((500, 1), (sum(held.values()), 3), (10**9, 2), (7, 2)):
        got = {
            (r["domain"], r["lang"], r["source"]): r["budget"]
            for r in M.leaf_budgets(M.token_counts(docs, WEIGHTS), WEIGHTS, total, epochs).collect()
        }
        assert got == leaf_budgets(held, WEIGHTS, total, epochs), total


def test_selection_fills_every_leaf_and_repeats_by_epochs(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ROWS", 3)
    docs = documents(spark)
    held = supply(docs)
    expect = leaf_budgets(held, WEIGHTS, sum(n for k, n in held.items() if k[2] != "zero"), 4)
    rows = M.selection(docs, WEIGHTS).collect()
    taken = defaultdict(int)
    for r in rows:
        taken[(r["domain"], r["lang"], r["source"])] += r["taken"]
        assert 0 < r["taken"] <= r["n_tokens"]
    assert taken == {k: v for k, v in expect.items() if v}
    part = defaultdict(int)
    for r in rows:
        part[(r["domain"], r["lang"], r["source"])] += r["taken"] < r["n_tokens"]
    assert max(part.values()) <= 1
    epochs = defaultdict(set)
    for r in rows:
        epochs[r["doc_id"]].add(r["epoch"])
    assert all(e == set(range(len(e))) for e in epochs.values())  # no epoch is skipped
    again = M.selection(docs.repartition(5), WEIGHTS).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert sorted(map(tuple, rows)) != sorted(map(tuple, M.selection(docs, WEIGHTS, seed=2).collect()))


def test_ranges_change_nothing(spark, monkeypatch):
    docs = documents(spark, 3)
    one = sorted(map(tuple, M.selection(docs, WEIGHTS).collect()))
    monkeypatch.setattr(M, "RANGE_ROWS", 2)
    assert one == sorted(map(tuple, M.selection(docs, WEIGHTS).collect()))


def test_mixed_returns_rows_once_for_each_epoch(spark):
    docs = documents(spark)
    times = defaultdict(int)
    for r in M.selection(docs, WEIGHTS).collect():
        times[r["doc_id"], r["lang"], r["source"]] += 1
    mixed = M.mixed(docs, WEIGHTS)
    assert mixed.columns == docs.columns
    got = defaultdict(int)
    for r in mixed.collect():
        got[r["doc_id"], r["lang"] or "und", r["source"] or "unknown"] += 1
    assert got == times


def test_an_id_of_two_sources_is_two_rows(spark):
    """A source of weight 0 gives nothing, also if another source has a row of the same id."""
    weights = M.Weights({}, {}, {}, {"b": 0})
    rows = [(1, "a a a", "en", "a"), (1, "b b b", "en", "b"), (2, "c", "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert [tuple(r) for r in M.mixed(docs, weights, epochs=1).collect()] == rows[:1]


def test_a_repeated_id_is_counted_in_parts(spark, monkeypatch):
    """A third of the rows with one id and length: the budget ends among them, and the parts change nothing."""
    rows = [(7, "w " * 5, "en", "a")] * 90 + [(k, "w " * (k % 4 + 1), "en", "a") for k in range(100, 280)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    shown = lambda table: sorted((r["doc_id"], r["n_tokens"], r["epoch"], r["taken"]) for r in table.collect())
    weights = M.Weights({}, {}, {}, {})
    for total in (333, 471):
        with monkeypatch.context() as patched:
            one = M.selection(docs, weights, total=total)
            whole = shown(one)
            patched.setattr(M, "RANGE_ROWS", 8)
            assert shown(M.selection(docs, weights, total=total)) == whole
        assert sum(t for *_, t in whole) == total and sum(t < n for _, n, _, t in whole) <= 1
        assert len(M.mixed(docs, weights, total=total).collect()) == len(whole)


def test_columns_of_any_name(spark):
    names = ["key", "row", "times", "epoch", "__times", "__id", "a.b", "h"]
    docs = spark.createDataFrame([(1, "x y", "en", "s", *range(8), {"k": 1})], ["doc_id", "text", "lang", "source", *names, "m"])
    got = M.mixed(docs, M.Weights({}, {}, {}, {}), epochs=2)
    assert got.columns == docs.columns and [tuple(r) for r in got.collect()] == [tuple(r) for r in docs.collect()]


def test_empty_table(spark):
    docs = documents(spark).limit(0)
    assert M.selection(docs, WEIGHTS).count() == 0 and M.mixed(docs, WEIGHTS).count() == 0
