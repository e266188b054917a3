"""Centroid clustering of vectors with exact integer distances and a vantage-point tree over the centroids.

A component x becomes the integer floor(``SCALE`` * x), so distances, ties and means are exact and no result
depends on the order of sums. In each round the driver builds a vantage-point tree over the centroids and
broadcasts it; its size is fixed by parameters and checked against ``MOST_NUMBERS``. Every vector looks for its nearest
centroid best-first: of the nodes seen so far it opens the one with the least bound, and stops when that
bound is above the best distance. Bounds are whole numbers with room for rounding, and a node whose bound
equals the best distance is still opened, so of equally near centroids the smallest number always wins. The vectors of
a block take their steps together, as arrays; each has its own list of open nodes.

A task returns sums and counts of its clusters, cut into limbs of ``LIMB`` bits. Spark adds the limbs up, so
sums are exact for any number of rows, and the driver gets a fixed number of rows a round.

Defined results: vectors that are null, have another number of components, or null or non-finite ones are
not in the result. Repeated rows are separate vectors. A null id is kept as it is and starts no cluster
unless too few vectors have an id. With fewer vectors than clusters every vector starts one. A squared
distance or a sum of them that does not fit 64 bits is null; the clusters are right all the same. An empty
table gives an empty result. Columns other than ``vec_id`` and ``embedding`` are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import scratch, written

#: Numbers in all centroids together, at most: what is broadcast has this bound.
MOST_NUMBERS = 1 << 24
#: Centroids in a leaf of the tree, and numbers held for the vectors that search together.
LEAF, TOGETHER = 4, 1 << 20
#: Components below this are handled in 64 bits, larger ones as Python integers.
SMALL = 1 << 27
LIMB = 40
#: Rooted distances are rounded down; a bound is lowered by so much that it stays one.
ROUNDING = 2


class Tree(NamedTuple):
    """Nodes by number, the root first. A node without children is a leaf."""

    centroids: np.ndarray
    points: np.ndarray  # node, place: a centroid, or -1; the first of an inner node is its vantage point
    child: np.ndarray  # node, side: the nodes of what is nearer to the vantage point and of the rest, or -1
    nearest: np.ndarray  # node, side: least and greatest distance from the vantage point
    farthest: np.ndarray


def _root(squares: np.ndarray) -> np.ndarray:
    """Square roots, rounded down (by one too many at most)."""
    if squares.dtype == object:
        return np.array([math.isqrt(x) for x in squares], object)
    return np.floor(np.sqrt(squares.astype(np.float64))).astype(np.int64)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return (difference * difference).sum(1)


def _fitting(values: list[list[int]] | np.ndarray) -> np.ndarray:
    """As 64-bit integers if all are small, or else as Python integers."""
    found = np.array(values, object)
    return found if found.size and max(abs(found.min()), abs(found.max())) >= SMALL else found.astype(np.int64)


def tree_of(centroids: list[list[int]] | np.ndarray) -> Tree:
    """A vantage-point tree; the point farthest from the first of a node splits it at the median distance."""
    at = _fitting(centroids)
    points, child, nearest, farthest = [], [], [], []

    def grow(members: np.ndarray) -> int:
        node = len(points)
        for table in (points, child, nearest, farthest):
            table.append(None)
        points[node], child[node] = np.full(LEAF, -1), [-1, -1]
        nearest[node], farthest[node] = [0, 0], [0, 0]
        if len(members) <= LEAF:
            points[node][: len(members)] = members
            return node
        vantage = members[int(np.argmax(_squared(at[members], at[members[0]])))]
        rest = members[members != vantage]
        points[node][0] = vantage
        away = _root(_squared(at[rest], at[vantage]))
        order = np.argsort(away, kind="stable")
        for side, part in enumerate((order[: len(order) // 2], order[len(order) // 2 :])):
            nearest[node][side], farthest[node][side] = away[part[0]], away[part[-1]]
            child[node][side] = grow(rest[part])
        return node

    grow(np.arange(len(at)))
    return Tree(at, np.stack(points), np.array(child), np.array(nearest, at.dtype), np.array(farthest, at.dtype))


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each vector's nearest centroid, the smallest of equal ones, and the squared distance."""
    kind = np.dtype(object) if object in (tree.centroids.dtype, vectors.dtype) else np.dtype(np.int64)
    centroids, vectors = tree.centroids.astype(kind), vectors.astype(kind)
    best, who = _squared(vectors, centroids[0]), np.zeros(len(vectors), np.int64)
    never = np.iinfo(np.int64).max if kind != object else math.inf
    bound, node = np.full((len(vectors), 4), never, kind), np.zeros((len(vectors), 4), np.int64)
    bound[:, 0], used = 0, 1
    rows = np.arange(len(vectors))
    while len(rows):
        place = bound[rows, :used].argmin(1)
        low = bound[rows, place]
        # Inclusive: an equally near centroid of a smaller number may be in there.
        go = np.asarray(low <= _root(best[rows]) + 1, bool)
        rows, place, low = rows[go], place[go], low[go]
        here = node[rows, place]
        bound[rows, place] = never
        for c in range(LEAF):
            some = np.flatnonzero(tree.points[here, c] >= 0)
            point, at = tree.points[here[some], c], rows[some]
            away = _squared(vectors[at], centroids[point])
            better = np.asarray((away < best[at]) | ((away == best[at]) & (point < who[at])), bool)
            best[at[better]], who[at[better]] = away[better], point[better]
            if not c:
                first = _root(away)  # every node has a first point
        if used == bound.shape[1]:
            bound = np.concatenate([bound, np.full_like(bound, never)], axis=1)
            node = np.concatenate([node, np.zeros_like(node)], axis=1)
        for side, into in ((0, place), (1, np.full(len(rows), used))):
            has = tree.child[here, side] >= 0
            apart = np.maximum(first - tree.farthest[here, side], tree.nearest[here, side] - first) - ROUNDING
            bound[rows[has], into[has]] = np.maximum(low, apart)[has]
            node[rows[has], into[has]] = tree.child[here, side][has]
        used += 1
    return who, best


def _kept(column: pa.Array, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with ``dims`` finite components, and these as doubles."""
    column = column.cast(pa.large_list(pa.float64()))
    rows = np.flatnonzero(pc.equal(pc.list_value_length(column), dims).fill_null(False).to_numpy(zero_copy_only=False))
    flat = pc.list_flatten(column.take(pa.array(rows))).to_numpy(zero_copy_only=False).reshape(-1, dims)
    finite = np.isfinite(flat).all(1)
    return rows[finite], flat[finite]


def _integers(values: np.ndarray, scale: int) -> np.ndarray:
    if not values.size or np.abs(values).max() * scale < SMALL:
        return np.floor(values * scale).astype(np.int64)
    exact = [math.floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return np.array([*exact, None], object)[:-1].reshape(values.shape)


def _blocks(values: np.ndarray, scale: int) -> Iterator[tuple[slice, np.ndarray]]:
    """Rows that search together, and their integers."""
    room = max(1, TOGETHER // max(1, values.shape[1]))
    for at in range(0, len(values), room):
        yield slice(at, at + room), _integers(values[at : at + room], scale)


def _limbs(total: int) -> list[int]:
    found = []
    while not -(1 << LIMB) <= total < 1 << LIMB:
        found.append(total & ((1 << LIMB) - 1))
        total >>= LIMB
    return [*found, total]


def _sums(shared, dims: int, scale: int):
    """Per task: the limbs of each cluster's sums; the place ``dims`` has its number of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            _, values = _kept(batch.column("embedding"), dims)
            for _, vectors in _blocks(values, scale):
                who, _ = nearest(tree, vectors)
                order = np.argsort(who, kind="stable")
                clusters, first = np.unique(who[order], return_index=True)
                parts = np.add.reduceat(vectors[order], first, axis=0)
                for cluster, part, many in zip(clusters.tolist(), parts, np.diff(np.append(first, len(who)))):
                    part = np.append(part.astype(object), int(many))
                    total[cluster] = total[cluster] + part if cluster in total else part
        for cluster, sums in total.items():
            limbs = [(place, k, x) for place, value in enumerate(sums) for k, x in enumerate(_limbs(int(value)))]
            place, limb, value = zip(*limbs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([cluster] * len(limbs), pa.int32()), pa.array(place, pa.int32()), pa.array(limb, pa.int32()), pa.array(value, pa.int64())],
                ["cluster", "place", "limb", "value"],
            )

    return run


def _assigned(shared, dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            rows, values = _kept(batch.column("embedding"), dims)
            for part, vectors in _blocks(values, scale):
                who, away = nearest(tree, vectors)
                fits = [int(x) if x < 1 << 63 else None for x in away.tolist()]
                columns = [batch.column("vec_id").take(pa.array(rows[part])), pa.array(who, pa.int32()), pa.array(fits, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    return run


def _first_centroids(vectors: DataFrame, clusters: int, dims: int, scale: int, seed: int) -> list[list[int]]:
    """The vectors with the least hashes of their id; equal hashes are ordered by the vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, values = _kept(batch.column("embedding"), dims)
            parts = pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, dims, dtype=np.int32)), pa.array(values.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("hash").take(pa.array(rows)), parts], ["hash", "parts"])

    hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("hash"), "embedding")
    first = hashed.mapInArrow(run, "hash string, parts array<double>").orderBy(F.col("hash").asc_nulls_last(), "parts").limit(clusters)
    return [_integers(np.array([row["parts"]]), scale)[0].tolist() for row in first.collect()]


def _moved(centroids: list[list[int]], limbs: DataFrame, dims: int) -> list[list[int]]:
    """Exact means, rounded down; a cluster without vectors stays."""
    sums = limbs.groupBy("cluster", "place", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    total: dict[int, list[int]] = {}
    for row in sums.collect():  # some rows for each component of each centroid
        total.setdefault(row["cluster"], [0] * (dims + 1))[row["place"]] += int(row["value"]) << LIMB * row["limb"]
    return [[s // total[k][dims] for s in total[k][:dims]] if k in total else c for k, c in enumerate(centroids)]


def clustered(vectors: DataFrame, clusters: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid`` of every vector that is kept.

    ``distance`` is squared, ``centroid`` has the final centroid's components, separated by commas.
    """
    if clusters * dims > MOST_NUMBERS:
        raise ValueError(f"{clusters} centroids of {dims} components are too many to broadcast")
    spark, folder = vectors.sparkSession, scratch(vectors.sparkSession)
    vectors = vectors.select("vec_id", "embedding")
    kind = vectors.schema["vec_id"].dataType.simpleString()
    centroids = _first_centroids(vectors, clusters, dims, scale, seed)
    names = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    if not centroids:
        return spark.createDataFrame([], f"vec_id {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid string")
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(tree_of(centroids))
        limbs = vectors.mapInArrow(_sums(shared, dims, scale), "cluster int, place int, limb int, value long")
        before, centroids = centroids, _moved(centroids, limbs, dims)
        shared.unpersist()
        if centroids == before:  # and so in all later rounds
            break
    shared = spark.sparkContext.broadcast(tree_of(centroids))
    assigned = written(vectors.mapInArrow(_assigned(shared, dims, scale), f"vec_id {kind}, cluster int, distance long"), f"{folder}/assigned")
    shared.unpersist()
    whole = F.when(F.count("*") == F.count("distance"), F.sum(F.col("distance").cast("decimal(38,0)")))
    inertia = {row["cluster"]: None if row["total"] is None else int(row["total"]) for row in assigned.groupBy("cluster").agg(whole.alias("total")).collect()}
    everything = None if None in inertia.values() else sum(inertia.values())
    fitting = lambda x: x if x is not None and x < 1 << 63 else None
    found = [(k, fitting(x), fitting(everything), ",".join(map(str, centroids[k]))) for k, x in inertia.items()]
    known = spark.createDataFrame(found, "cluster int, cluster_inertia long, inertia long, centroid string")
    return assigned.join(F.broadcast(known), "cluster").select(names)  # a row for each centroid
