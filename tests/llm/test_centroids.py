import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revpulse.llm import centroids as C

SCHEMA = "vec_id long, embedding array<double>, label int, cluster int, hash string"


def brute_force(rows, clusters, rounds, dims, scale=1024, seed=3):
    """All pairs in plain Python: (vec_id, cluster, squared distance, centroid) of every kept row, sorted."""
    from fractions import Fraction
    from math import floor

    kept = [(i, [floor(Fraction(x) * scale) for x in v]) for i, v in rows if v is not None and len(v) == dims and None not in v and np.isfinite(v).all()]
    hashed = sorted((i is None, i if i is None else hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept)
    at = [v for _, _, v in hashed[:clusters]]

    def owners():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(at)) for _, v in kept]

    for _ in range(rounds):
        owner = owners()
        for k in range(len(at)):
            own = [v for (_, v), (_, o) in zip(kept, owner) if o == k]
            if own:
                at[k] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i, k, d, ",".join(map(str, at[k]))) for (i, _), (d, k) in zip(kept, owners())), key=repr)


def rows_of(spark, rows, **options):
    table = spark.createDataFrame([(i, v, 1, 7, "x") for i, v in rows], SCHEMA).repartition(3)
    return C.clustered(table, **options).collect()


@given(st.data())
@settings(max_examples=60, deadline=None)
def test_search_in_the_tree_equals_all_pairs(data):
    number = st.integers(-3, 3) if data.draw(st.booleans()) else st.integers(-(1 << 26), 1 << 26)
    if data.draw(st.booleans()):
        number = number.map(lambda x: x << 400)
    dims = data.draw(st.integers(1, 4))
    vector = st.lists(number, min_size=dims, max_size=dims)
    at = data.draw(st.lists(vector, min_size=1, max_size=40))
    vectors = data.draw(st.lists(vector, min_size=1, max_size=20))
    who, away = C.nearest(C.tree_of(at), C._fitting(vectors))
    expect = [min((sum((x - y) ** 2 for x, y in zip(v, c)), k) for k, c in enumerate(at)) for v in vectors]
    assert list(zip(away.tolist(), who.tolist())) == expect


def test_the_tree_leaves_out_most_of_many_centroids():
    rng = np.random.default_rng(1)
    tree = C.tree_of(rng.integers(-1000, 1000, (2000, 2)).astype(object))
    opened = []
    real = C._squared
    try:
        C._squared = lambda a, b: opened.append(len(a)) or real(a, b)
        C.nearest(tree, rng.integers(-1000, 1000, (50, 2)))
    finally:
        C._squared = real
    assert sum(opened) < 0.2 * 50 * 2000


@given(st.lists(st.integers(-(1 << 200), 1 << 200), max_size=5))
def test_limbs_add_up(values):
    for value in values:
        limbs = C._limbs(value)
        assert sum(x << C.LIMB * k for k, x in enumerate(limbs)) == value and all(-(1 << 40) <= x < 1 << 40 for x in limbs)


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(size=5) + 3 * (i % 7)]) for i in range(300)]
    rows += [(5, rows[9][1]), (5, rows[9][1]), (None, rows[3][1]), (900, [0.1] * 5), (901, [0.1] * 5)]
    rows += [(950, None), (951, []), (952, [1.0] * 4), (953, [None] + [1.0] * 4), (954, [float("nan")] + [1.0] * 4), (955, [float("inf")] + [1.0] * 4)]
    for clusters, rounds in ((8, 10), (1, 2), (60, 3)):
        got = rows_of(spark, rows, clusters=clusters, rounds=rounds, dims=5)
        expect = brute_force(rows, clusters, rounds, 5)
        assert sorted(((r["vec_id"], r["cluster"], r["distance"], r["centroid"]) for r in got), key=repr) == expect
        total = {}
        for _, k, d, _ in expect:
            total[k] = total.get(k, 0) + d
        assert all(r["cluster_inertia"] == total[r["cluster"]] and r["inertia"] == sum(total.values()) for r in got)


def test_components_beyond_64_bits(spark):
    rows = [(1, [1e30, 0.0]), (2, [1.5, 2.5]), (3, [-1e300, 1e-300]), (4, [1.5, 2.25]), (5, [1e30, 1.0])]
    got = rows_of(spark, rows, clusters=3, rounds=4, dims=2)
    expect = brute_force(rows, 3, 4, 2)
    fits = [(i, k, d if d < 1 << 63 else None, c) for i, k, d, c in expect]
    assert sorted(((r["vec_id"], r["cluster"], r["distance"], r["centroid"]) for r in got), key=repr) == sorted(fits, key=repr)


def test_few_equal_and_no_vectors(spark):
    assert rows_of(spark, [], dims=2) == [] == rows_of(spark, [(1, None)], dims=2)
    same = rows_of(spark, [(k, [0.5, -0.25]) for k in range(12)], clusters=4, dims=2)
    assert {(r["cluster"], r["distance"], r["inertia"], r["centroid"]) for r in same} == {(0, 0, 0, "512,-256")} and len(same) == 12
    two = rows_of(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0])], dims=2)
    assert sorted(r["cluster"] for r in two) == [0, 1]


def test_too_many_centroids_are_refused(spark):
    with pytest.raises(ValueError):
        rows_of(spark, [(1, [0.0])], clusters=1 << 22, dims=64)
