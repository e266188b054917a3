from collections import defaultdict

import numpy as np

from revpulse.llm import host_reputation as H
from revpulse.llm import vector_graph as V
from test_ngram_join import least_reached

SCHEMA = "vec_id long, embedding array<float>, label int, rep long, links long"


def vectors(seed=0):
    """A large group of near copies, exact copies, pairs near the threshold, and rows that link with nothing."""
    rng = np.random.default_rng(seed)
    rows = []
    center = rng.normal(size=16)
    rows += [(center + rng.normal(size=16) * 0.1, 1) for _ in range(150)]
    rows += [(center, 1)] * 20 + [(center, 2)] * 3
    for _ in range(250):
        v = rng.normal(size=16)
        rows.append((v, int(rng.integers(1, 4))))
        if rng.random() < 0.4:
            rows.append((v * 3 + rng.normal(size=16) * rng.choice([0.3, 1.0, 1.2]), rows[-1][1]))
    rows = [([float(np.float32(x)) for x in v], label) for v, label in rows]
    rows += [(None, 1), ([], 1), ([0.0] * 16, 1), ([float("nan")] + [1.0] * 15, 1), ([None] + [1.0] * 15, 1), ([float("inf")] + [1.0] * 15, 1)]
    rows += [(rows[0][0], None), (rows[0][0][:8], 1)]
    order = rng.permutation(len(rows))
    return [(int(i), *rows[k], 7, 7) for i, k in enumerate(order)]


def brute_force(rows):
    good = {
        i: (label, len(v), np.array(v, float))
        for i, v, label, *_ in rows
        if label is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and np.any(v)
    }
    near = defaultdict(set)
    ids = sorted(good)
    for a in ids:
        for b in ids:
            if a < b and good[a][:2] == good[b][:2]:
                x, y = good[a][2], good[b][2]
                if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= 0.93:
                    near[a].add(b)
                    near[b].add(a)
    root = least_reached([r[0] for r in rows], lambda a, b: b in near[a])
    return {i: (len(near[i]), root[i], root[i] == i) for i, *_ in rows}


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in V.near_duplicates(table, **options).collect()}


def test_links_and_components(spark):
    rows = vectors()
    expect = brute_force(rows)
    for shard in (8192, 60):
        got = found(spark, rows, shard=shard)
        assert got.keys() == expect.keys()
        links = sum(n for n, *_ in expect.values())
        assert sum(got[i][0] for i in got) >= 0.97 * links and all(got[i][0] <= expect[i][0] for i in got)
        assert np.mean([got[i][1:] == expect[i][1:] for i in got]) > 0.99


def pairs_of(raw, least, shard=None, queries=None):
    """Links of each query by the operator's search, and by all pairs."""
    keys = np.arange(len(raw))
    shard = shard or V.Shard(keys, np.ones(len(raw), int), raw, V.dense_groups(V._unit(raw), least))
    q = raw if queries is None else queries
    fold = V.links_between(shard, keys[: len(q)] if queries is None else len(raw) + np.arange(len(q)), q, least)
    cosine = (q @ raw.T) / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(raw, axis=1)
    if queries is None:
        np.fill_diagonal(cosine, 0)
    return fold, cosine >= least


def test_graph_finds_neighbours():
    raw = np.random.default_rng(2).normal(size=(3000, 12))
    assert len(V.Graph(V._unit(raw)).layers) > 1
    fold, true = pairs_of(raw, 0.8)
    assert (fold.links <= true.sum(1)).all() and fold.links.sum() >= 0.99 * true.sum()


def test_isolated_pairs_of_a_whole_shard_and_between_two():
    """64 components and 8,192 vectors a shard, each pair by itself in the space."""
    rng = np.random.default_rng(4)
    one, two = rng.normal(size=(2, 8192, 64))
    some = rng.choice(8192, 1200, replace=False)
    near = lambda v: v + rng.normal(size=v.shape) * 0.3
    one[some[:400]] = near(one[some[400:800]])
    two[some[800:]] = near(one[some[800:]])
    shard = V.Shard(np.arange(8192), np.ones(8192, int), one, V.dense_groups(V._unit(one), 0.93))
    fold, true = pairs_of(one, 0.93, shard)
    assert true.sum() > 600 and fold.links.sum() >= 0.99 * true.sum() and (fold.links <= true.sum(1)).all()
    fold, true = pairs_of(one, 0.93, shard, two)
    assert true.sum() > 300 and fold.links.sum() >= 0.99 * true.sum() and (fold.links <= true.sum(1)).all()


def test_audit_widens_beams_where_links_are_rare():
    """Without any link the audit looks at the nearest vectors, so a bad graph is noticed."""
    raw = np.random.default_rng(6).normal(size=(1500, 32))
    shard = V.Shard(np.arange(1500), np.ones(1500, int), raw, [])
    assert V._beam(shard, V._unit(raw), 0.93) < 1500
    shard.graph.layers = [np.full_like(layer, -1) for layer in shard.graph.layers]
    assert V._beam(shard, V._unit(raw), 0.93) == 1500


def test_dense_groups_are_folded_and_counted_exactly():
    rng = np.random.default_rng(3)
    center, other = rng.normal(size=(2, 64))
    tight, wide = center + rng.normal(size=(900, 64)) * 0.05, other + rng.normal(size=(300, 64)) * rng.uniform(0.1, 0.6, (300, 1))
    raw = rng.permutation(np.concatenate([tight, wide, rng.normal(size=(1500, 64))]))
    groups = V.dense_groups(V._unit(raw), 0.93)
    assert max(map(len, groups)) >= 900
    fold, true = pairs_of(raw, 0.93)
    assert fold.links.sum() >= 0.995 * true.sum() and (fold.links <= true.sum(1)).all()
    expect = V.Fold(np.arange(len(raw)), np.arange(len(raw)), np.ones(len(raw), int))
    expect.add(*np.nonzero(true))
    assert np.mean(fold.root == expect.root) > 0.99


def test_a_full_beam_is_finished_by_products():
    """A group that no tried center is in still fills beams."""
    rng = np.random.default_rng(3)
    raw = np.concatenate([np.ones((500, 8)) + rng.normal(size=(500, 8)) * 0.05, rng.normal(size=(1500, 8))])
    fold, true = pairs_of(raw, 0.95, V.Shard(np.arange(2000), np.ones(2000, int), raw, []))
    assert (fold.links[:500] == true.sum(1)[:500]).all()


def test_a_group_costs_little_more_than_none():
    import time

    rng = np.random.default_rng(8)
    spread = rng.normal(size=(3000, 64))
    dense = spread.copy()
    dense[:1000] = dense[0] + rng.normal(size=(1000, 64)) * 0.1
    took = []
    for raw in (spread, dense):
        begun = time.process_time()
        pairs_of(rng.permutation(raw), 0.93)
        took.append(time.process_time() - begun)
    assert took[1] < 3 * took[0]


def test_repeated_ids_are_separate_vectors(spark):
    """One id for two vectors, of one label and of two: no link is lost and no component spans labels."""
    rows = [(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.1], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in V.near_duplicates(table).collect())
    assert got == [(1, 0, 1), (1, 1, 1), (2, 1, 1)]
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 2), (2, [1.0, 0.1], 1), (3, [1.0, 0.1], 2), (4, [1.0, 0.1], 2), (1, [1.0, 0.0], 2)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r["vec_id"], r["n_links"], r["component_id"]) for r in V.near_duplicates(table).collect())
    assert got == [(1, 1, 1), (1, 3, 1), (1, 3, 1), (2, 1, 1), (3, 3, 1), (4, 3, 1)]


def test_vector_tables_without_rows_or_links(spark):
    assert found(spark, []) == {}
    assert found(spark, [(1, None, 1, 0, 0), (2, [1.0], None, 0, 0)]) == {1: (0, 1, True), 2: (0, 2, True)}
    assert found(spark, [(5, [1.0, 0.0], 1, 0, 0), (4, [0.0, 1.0], 1, 0, 0)]) == {4: (0, 4, True), 5: (0, 5, True)}


RULES = (H.Rule("com", "/", "allow"), H.Rule("example.com", "/en/", "block"), H.Rule("www.example.com", "/en/", "allow"), H.Rule("net", "/es/", "block"))


def test_hosts_paths_and_rules(spark):
    urls = {
        1: (None, "", "", None),
        2: ("no scheme/en/", "", "", None),
        3: ("http://WWW.Example.com/en/1?q", "www.example.com", "/en/1", "www.example.com/en/"),
        4: ("http://a.example.com/en/1#x", "a.example.com", "/en/1", "example.com/en/"),
        5: ("http://badexample.com/en/", "badexample.com", "/en/", "com/"),
        6: ("https://x.net/es/", "x.net", "/es/", "net/es/"),
        7: ("https://x.net?u=http://a.com/en/", "x.net", "", None),
        8: ("https://x.net/ES/", "x.net", "/ES/", None),
        9: ("://com/", "com", "/", "com/"),
        10: ("http://É.org/Ä?", "É.org", "/Ä", None),
        11: ("", "", "", None),
    }
    pages = spark.createDataFrame([(k, u[0], "x") for k, u in urls.items()], "page_id long, url string, rule string")
    outcomes = spark.createDataFrame([(8, 0), (8, 0), (99, 1), (None, 1), (7, None)], "page_id long, good int")
    rows = {r["page_id"]: r for r in H.judged(pages, outcomes, RULES).collect()}
    assert {k: (rows[k]["host"], rows[k]["path"], rows[k]["rule"]) for k in rows} == {k: u[1:] for k, u in urls.items()}
    by_name = {r.name: r.verdict for r in RULES}
    assert all(rows[k]["verdict"] == by_name[u[3]] for k, u in urls.items() if u[3])
    assert H.judged(pages.limit(0), outcomes, RULES).count() == 0
    assert H.judged(pages, outcomes.limit(0), RULES).count() == len(urls)


def reputation(hosts):
    """Posterior mean and strength of each host, level by level, from {host: (n, good)}."""

    def strength(groups):
        groups = [g for g in groups if g[0]]
        seen = sum(n * (good / n - p) ** 2 for n, good, p in groups)
        alone = sum(p * (1 - p) for _, _, p in groups)
        extra = sum(p * (1 - p) * (n - 1) for n, _, p in groups)
        k = extra / (seen - alone) - 1 if seen > alone else H.STRONGEST
        return max(H.WEAKEST, min(H.STRONGEST, k))

    def level(names, of, prior):
        sums = defaultdict(lambda: [0, 0])
        for h, (n, good) in hosts.items():
            sums[names(h)][0] += n
            sums[names(h)][1] += good
        k = strength([(n, g, prior[of(name)]) for name, (n, g) in sums.items()])
        return {name: ((g + prior[of(name)] * k) / (n + k), n + k) for name, (n, g) in sums.items()}

    suffix, domain = lambda h: h.split(".")[-1], lambda h: ".".join(h.split(".")[-2:])
    overall = sum(g for _, g in hosts.values()) / sum(n for n, _ in hosts.values())
    first = level(suffix, lambda _: "", {"": overall})
    second = level(domain, suffix, {k: m for k, (m, _) in first.items()})
    return level(lambda h: h, domain, {k: m for k, (m, _) in second.items()})


def test_suffixes_of_two_labels(spark):
    """Hosts below such a suffix have the domain of their last three labels."""
    hosts = {"a.x.co.uk": (20, 19), "b.x.co.uk": (0, 0), "a.y.co.uk": (20, 1), "b.y.co.uk": (0, 0), "w.uk": (4, 2)}
    table = spark.createDataFrame([(h, n, float(g)) for h, (n, g) in hosts.items()], "host string, n long, good double")
    plain = {r["host"]: r["mean"] for r in H.reputations(table).collect()}
    split = {r["host"]: r["mean"] for r in H.reputations(table, ["co.uk"]).collect()}
    assert abs(plain["b.x.co.uk"] - plain["b.y.co.uk"]) < 1e-12 and split["b.x.co.uk"] > split["b.y.co.uk"] + 0.1


def test_reputation_is_shrunk_through_three_levels(spark):
    rng = np.random.default_rng(1)
    hosts = {}
    for suffix, share in (("net", 0.9), ("org", 0.3), ("com", 0.6)):
        for d in range(4):
            for h in range(5):
                n = int(rng.integers(0, 30))
                hosts[f"h{h}.d{d}.{suffix}"] = (n, int(rng.binomial(n, np.clip(share + rng.normal() * 0.1, 0, 1))))
    table = spark.createDataFrame([(h, n, float(g)) for h, (n, g) in hosts.items()], "host string, n long, good double")
    got = {r["host"]: (r["mean"], r["after"]) for r in H.reputations(table).collect()}
    expect = reputation(hosts)
    assert got.keys() == expect.keys() and all(np.allclose(got[h], expect[h]) for h in got)
    unseen = [h for h, (n, _) in hosts.items() if not n]
    assert all(0 < got[h][0] < 1 for h in unseen)
