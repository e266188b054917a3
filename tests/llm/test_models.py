"""Classifiers: held-out rows of the test tables, and small cases."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from revpulse.llm import labelled as L
from revpulse.llm import language as G
from revpulse.llm import quality_rules as Q
from revpulse.llm import toxicity as T

LARGER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{LARGER}/{t}.parquet") for t in ("documents", "labels")}


def crc(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_toxicity_on_held_out_rows(tables):
    labels = {r["doc_id"]: r["toxic"] for r in tables["labels"].collect()}
    rows = T.scored(tables["documents"], T.trained(tables["documents"], tables["labels"])).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (crc(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    toxic = [r["predicted"] for r in held if labels[r["doc_id"]] == 1]
    clean = [r["predicted"] for r in held if labels[r["doc_id"]] == 0]
    assert np.mean(toxic) > 0.7 and np.mean(clean) < 0.02


def _fit(spark, texts, y):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(v)) for k, v in enumerate(y)], "doc_id long, toxic int")
    return T.trained(docs, labels, folds=1)


def _score(model, texts):
    return np.concatenate([s for _, s in T.scores(model, pa.array(texts, pa.string()))])


def test_pairs_are_learned_that_single_terms_cannot_show(spark, monkeypatch):
    """An insult or a group alone is clean, both in one window are toxic."""
    monkeypatch.setattr(T, "STANDS_OUT", 1.0)
    rng = np.random.default_rng(0)
    fill = lambda n: [f"{a}{b}" for a, b in rng.choice(list("bcdfg"), (n, 2))]
    texts, y = [], []
    for k in range(600):
        words = fill(14) + ["vermin"] * (k % 2) + ["people"] * (k // 2 % 2)
        texts.append(" ".join(rng.permutation(words)))
        y.append(k % 4 == 3)
    model = _fit(spark, texts, y)
    score = _score(model, ["zz vermin zz", "zz people zz", "vermin zz people", "vermin " + "zz " * 100 + "people", "", None])
    assert score[2] > 0.7 and max(score[[0, 1, 3, 4, 5]]) < 0.5


def test_pairs_of_terms_that_do_not_stand_out_alone(spark):
    """Each word's toxic texts are within 2 deviations of the mean, with the screen for single terms as it is."""
    rng = np.random.default_rng(5)
    vocabulary = ["".join(w) for w in rng.choice(list("bcdfghklm"), (1500, 5))]
    texts, y = [], []
    for k in range(3000):
        words, kind = list(rng.choice(vocabulary, 60)), k % 75
        if kind in (0, *range(1, 8)):
            words[10] = "vermin"
        if kind in (0, *range(8, 15)):
            words[14] = "people"
        if kind in range(15, 23):
            words[30] = "badword"
        texts.append(" ".join(words))
        y.append(kind == 0 or kind in range(15, 23))
    share = np.mean(y)
    for word in ("vermin", "people"):
        mine = np.array([word in t.split() for t in texts])
        z = (np.sum(np.array(y)[mine]) - mine.sum() * share) / np.sqrt(mine.sum() * share * (1 - share))
        assert abs(z) < 2
    score = _score(_fit(spark, texts, y), ["zz vermin zz people", "zz vermin zz", "zz people zz", "vermin " + "zz " * 100 + "people", "a badword", "", None])
    assert min(score[[0, 4]]) > 0.7 and max(score[[1, 2, 3, 5, 6]]) < 0.3


def test_counted_pairs_are_those_of_a_plain_count(spark, tmp_path, monkeypatch):
    """Also with a small filter and small parts; one word stands out alone, and is harmless beside another."""
    rng = np.random.default_rng(6)
    words = [f"{a}{b}" for a in "bcdfg" for b in "klmnp"]
    texts = [list(rng.choice(words, 40)) for _ in range(400)]
    for k in range(0, 400, 3):
        texts[k][5] = "vile"
        texts[k][7:9] = ["not", "not"] if k % 2 else texts[k][7:9]

    def windows(t):
        cuts = [t[max(0, s) : s + T.WINDOW] for c in (0, T.WINDOW // 2) for s in range(-c, len(t), T.WINDOW)]
        return [set(w) for w in cuts]

    y = np.array([any({"bk", "gp"} <= w or ("vile" in w and "not" not in w) for w in windows(t)) for t in texts], int)
    rows = [(k, int(v), 1.0, " ".join(t)) for k, (t, v) in enumerate(zip(texts, y))]
    sample = spark.createDataFrame(rows, "doc_id long, label int, weight double, text string").repartition(3)
    units = {k: T.ONE for k in range(400)}
    counted = sample.mapInArrow(T._term_counts(units), "bucket long, every long, toxic long, mark long").groupBy("bucket")
    counted = counted.agg({"every": "sum", "toxic": "sum", "mark": "bit_xor"}).toPandas().sort_values("bucket")
    bucket, mark = counted["bucket"].to_numpy(), counted["bit_xor(mark)"].to_numpy()
    every, toxic = counted["sum(every)"].to_numpy() / T.ONE, counted["sum(toxic)"].to_numpy() / T.ONE
    term = {w: int(T.terms(np.array([0, len(w)]), np.frombuffer(w.encode(), np.uint8))[1][0, 0]) for w in {*words, "vile", "not"}}
    for w, at in term.items():
        has = np.array([w in t for t in texts])
        where = int(np.flatnonzero(bucket == at)[0])
        assert (every[where], toxic[where]) == (has.sum(), y[has].sum())
    screen = T.screen_of(bucket, every, toxic, mark, bucket == term["vile"], y.mean())
    assert screen.strong.sum() == 1 and len(screen.own) == len(term)

    number, pairs = {w: int(screen.place[at]) for w, at in term.items()}, {}
    for t, bad in zip(texts, y):
        for pair in {(a, b) for w in windows(t) for a in w for b in w if number[a] < number[b]}:
            pairs.setdefault(pair, [0, 0])[bad] += 1
    code = np.array([number[a] * len(screen.own) + number[b] for a, b in pairs])
    clean, bad = np.array(list(pairs.values()), float).T
    out = code[screen.outstanding(code, clean, bad)]
    expect = sorted({int(x) for x in np.concatenate(np.divmod(out, len(screen.own)))})
    assert {number["bk"], number["gp"], number["vile"], number["not"]} <= set(expect)
    for at_once, bits in ((1 << 20, 22), (50, 4)):
        monkeypatch.setattr(T, "PAIRS_AT_ONCE", at_once)
        monkeypatch.setattr(T, "PAIRS_HELD", 4 * at_once)
        monkeypatch.setattr(T, "FILTER_BITS", bits)
        assert sorted(T.pair_terms(sample, screen, units, f"{tmp_path}/{bits}").tolist()) == expect


def test_pairs_of_a_long_text_are_made_in_parts(monkeypatch):
    rng = np.random.default_rng(3)
    term = rng.integers(0, 40, 900)
    windows = T.cut_windows(np.array([900]), np.zeros(900, np.int64), np.arange(900), term)
    of = {}
    for w, t in zip(windows.window.tolist(), windows.term.tolist()):
        of.setdefault(w, set()).add(t)
    every, none, some, few = np.ones(40, bool), np.zeros(40, bool), np.arange(40) % 3 > 0, np.arange(40) % 7 == 0
    for both, either in ((every, none), (some, none), (none, few), (some, few)):
        expect = {a * 40 + b for w in of.values() for a in w for b in w if a < b and ((both[a] and both[b]) or either[a] or either[b])}
        with monkeypatch.context() as patched:
            patched.setattr(T, "PAIRS_AT_ONCE", 500)
            parts = list(T.text_pairs(windows, 40, both, either))
        assert len(parts) > 3 and sorted(np.concatenate(parts).tolist()) == sorted(expect)
        assert [p.tolist() for p in T.text_pairs(windows, 40, both, either)] == [sorted(expect)]


def test_samples_are_split_between_classes(spark):
    rows = [(k, int(k % 500 == 0)) for k in range(20_000)] + [(k, None) for k in range(50)] + [(None, 1), (40, 0), (40, 1)]
    table = spark.createDataFrame(rows, "doc_id long, label int")
    got = L.sample_ids(table, 1000, "label").collect()
    assert len(got) == len({r["doc_id"] for r in got}) == 1000 and sum(r["label"] for r in got) == 40
    assert abs(sum(r["weight"] for r in got) - 1000) < 1e-6
    assert abs(sum(r["weight"] for r in got if r["label"]) / 1000 - 40 / 20_000) < 1e-9
    assert sorted(map(tuple, got)) == sorted(map(tuple, L.sample_ids(table.repartition(7), 1000, "label").collect()))
    names = spark.createDataFrame([(k, f"x{k % 30}") for k in range(900)] + [(k, "big") for k in range(900, 9000)], "doc_id long, lang string")
    chosen = L.sample_ids(names, 310, "lang").collect()
    assert {r["lang"] for r in chosen} == {"big", *(f"x{k}" for k in range(30))} and len(chosen) == 310
    assert L.quotas({"a": 5, "b": 100, "c": 2}, 30) == {"c": 2, "a": 5, "b": 23} and L.quotas({}, 9) == {}
    assert L.sample_ids(table.limit(0), 10, "label").count() == 0


def test_a_toxic_window_of_a_long_text_and_stems(spark):
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 30)) + (f" badword{rng.integers(99)}s" if k % 3 == 0 else "") for k in range(300)]
    model = _fit(spark, texts, [k % 3 == 0 for k in range(300)])
    score = _score(model, ["alpha " * 9000 + "BADWORDish! " + "beta " * 9000, "alpha " * 9000, "a bad word"])
    assert score[0] > 0.7 and max(score[1:]) < 0.3


def test_toxicity_without_labels_or_classes(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 1), (1, 1), (2, None), (9, 1)], "doc_id long, toxic int")
    assert {r["score"] for r in T.scored(docs, T.trained(docs, none)).collect()} == {0.5}
    assert len(T.scored(docs, T.trained(docs, one)).collect()) == 3
    assert T.keep(docs, T.trained(docs, none)).count() == 3
    assert T.scored(docs.limit(0), T.trained(docs.limit(0), one)).count() == 0


def test_language_on_held_out_rows(tables):
    truth = {r["doc_id"]: r["lang"] for r in tables["documents"].collect()}
    rows = G.predicted(tables["documents"], G.trained(tables["documents"])).collect()
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 for r in rows)
    held = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert np.mean(held) > 0.98


def test_language_of_odd_texts(spark, tables):
    model = G.trained(tables["documents"])
    odd = spark.createDataFrame([(1, None, "en"), (2, "", None), (3, "12 + 3 %", "en"), (4, "١٢", "x"), (5, "der die das und nicht sie", None), (5, "the " * 60000, "en")], "doc_id long, text string, lang string")
    got = G.predicted(odd, model).collect()
    assert [r["lang_pred"] for r in got] == ["und"] * 4 + ["de", "en"]
    assert [r["score"] for r in got][:4] == [0.0] * 4
    assert {r["lang_pred"] for r in G.predicted(odd, G.trained(odd.where("lang is null"))).collect()} == {"und"}
    assert G.predicted(odd.limit(0), model).count() == 0


def test_kernel_is_the_cosine_of_presence_sets():
    texts = ["abc abd", "abc, ABD!!", "xyz"]
    (_, present), = G.blocks(pa.array(texts))
    assert (present[0] <= present[1]).all()  # the second has one more gap, at its end
    grams = lambda t: {t[k : k + n] for n in G.ORDERS for k in range(len(t) - n + 1)}
    assert present[0].sum() == len(grams("abc abd"))
    assert (present[0] & present[2]).sum() == len(grams("abc abd") & grams("xyz"))


def test_quality_on_held_out_rows(tables):
    labels = {r["doc_id"]: r["quality"] for r in tables["labels"].collect()}
    rows = Q.scored(tables["documents"], tables["labels"]).collect()
    assert len(rows) == 1000
    assert all(r["held_out"] == (crc(r["doc_id"], 4) == 2) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert np.mean([p == y for p, y in held]) > 0.93


def test_rules_are_conjunctions_and_few(spark):
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(Q.STATISTICS)))
    names = list(Q.STATISTICS)
    y = ((x[:, 1] > 0.4) & (x[:, 2] <= 0.7)).astype(float)
    model = Q.fit(x, y, names)
    assert 0 < len(model.rules) < 40 and max(len(r) for r, _ in model.rules) <= Q.DEPTH
    table = spark.createDataFrame([tuple(map(float, r)) for r in x[:500]], ", ".join(f"{n} double" for n in names))
    score = np.array([r[0] for r in table.select(model.score()).collect()])
    assert np.mean((score > 0.5) == y[:500]) > 0.97
    # The compiled column is the sum of the rules that hold.
    logit = model.bias + sum(w * Q._holds(rule, x[:500], names) for rule, w in model.rules)
    assert np.allclose(score, 1 / (1 + np.exp(-logit)))


def test_quality_without_labels_and_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, "a b", 9), (2, None, 9), (3, "", 9), (3, "", 9)], "doc_id long, text string, length int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(1, 1), (1, 1), (2, None), (9, 1)], "doc_id long, quality int")
    assert [r["score"] for r in Q.scored(docs, none).collect()] == [0.5] * 4
    assert len(Q.scored(docs, one).collect()) == 4
    assert Q.scored(docs.limit(0), one).count() == 0
