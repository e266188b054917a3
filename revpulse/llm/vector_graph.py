"""Near-duplicate vectors by hierarchical navigable small-world graphs, one for each shard.

Only vectors of the same label and dimension are compared. Equal vectors form one class first, with a key of
its own, so a thousand copies cost as much as one. The classes of a label are dealt to shards of about ``SHARD``
vectors by a hash; a task builds the graph of a shard, and each shard's vectors are then queried against
the graph of every shard of their label. Queries advance through a graph together, as arrays.

Dense groups do not go into the graph, where they would fill every beam: ``PIVOTS`` vectors of the shard are tried as
centers, and what lies within half the threshold's angle of one, if it is as much as a beam, is folded. Folded groups
are searched by block products, and left out for queries whose angle to the center cannot reach them.

A query of a graph keeps a beam of the best vectors seen. If the whole beam reaches the threshold there may be more,
and the query is finished by block products over the shard. The width of the beam is found for each pair of shards on
audited queries, before the others are searched: it is widened, in the end to the whole shard, until
the audited queries find ``RECALL`` of their true links and ``RANK_RECALL`` of their ``NEAREST`` nearest vectors,
whether these are links or not; so there is something to miss also where links are rare. Links are
verified by their cosine in double precision.

No list of pairs outlives a block: pairs are folded as they are made into the number of links of each
vector and the least vector of its component within the task. Components are united over tasks from
those rows. A task compares up to ``GROUP`` shards with as many, so a shard's bytes move once for that many shards.

Defined results: a vector that is null, zero or has null or non-finite parts, or whose label is null, has
no links and is a component of its own. Rows with a null id are left out. Repeated rows are separate
vectors, also if their id stands for several vectors or labels. ``component_id`` is the least id. An empty table gives an empty result. Columns
other than those named are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, scratch, written

#: Vectors of a shard, about.
SHARD = 8192
#: Neighbours of a vector in the upper layers (twice as many in the lowest), and candidates they are chosen from.
DEGREE, BUILD_BEAM = 16, 64
#: Width of the first beam, vectors expanded at once, queries that advance together.
BEAM, EXPANDED, TOGETHER = 64, 4, 256
#: Queries audited for each pair of shards, shares that they must find of their true links and of their nearest.
AUDITED, RECALL, RANK_RECALL, NEAREST = 64, 0.99, 0.9, 4
#: Vectors of a shard tried as centers of dense groups, numbers of a block product, shards of a task on either side.
PIVOTS, PRODUCT, GROUP = 64, 1 << 20, 4
MOST_PARTITIONS = 20_000


class Graph:
    """Layers of neighbour lists over unit vectors; vectors are inserted in batches."""

    def __init__(self, unit: np.ndarray, layers: list[np.ndarray] | None = None, top: int = 0):
        self.unit, self.top = unit, top
        if layers is not None:
            self.layers = layers
            return
        n = len(unit)
        # A vector reaches layer k with probability DEGREE ** -k, by a fixed sequence.
        heights = (-np.log(1 - np.random.default_rng(5).random(n)) / np.log(DEGREE)).astype(int)
        self.layers = [np.full((n, 2 * DEGREE if k == 0 else DEGREE), -1, np.int32) for k in range(heights.max(initial=0) + 1)]
        highest = 0  # height of the entry point
        at = 0
        while at < n:
            batch = np.arange(at, min(n, at + max(1, min(TOGETHER, at))))
            entry = np.full((len(batch), 1), self.top)
            for k in range(len(self.layers) - 1, -1, -1):
                here = np.flatnonzero(heights[batch] >= k)
                if k > highest or not at:  # no vector is here yet
                    old = np.full((len(here), 0), -1)
                else:
                    found, sims = self.search(unit[batch], entry, k, BUILD_BEAM)
                    entry = found
                    old = np.where(np.isfinite(sims), found, -1)[here]
                self._link(k, batch[here], old)
            if heights[batch].max() > highest or not at:
                self.top, highest = int(batch[heights[batch].argmax()]), int(heights[batch].max())
            at += len(batch)

    def _link(self, k: int, new: np.ndarray, old: np.ndarray) -> None:
        """Give new vectors neighbours among ``old`` and each other, and link back."""
        if not len(new):
            return
        others = np.where(np.eye(len(new), dtype=bool), -1, new[None, :])
        chosen = self._choose(new, np.concatenate([old, others], axis=1), self.layers[k].shape[1])
        self.layers[k][new] = chosen
        source, place = np.nonzero(chosen >= 0)
        target, source = chosen[source, place], new[source]
        fresh = ~(self.layers[k][target] == source[:, None]).any(1)
        target, source = target[fresh], source[fresh]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        targets, first, many = np.unique(target, return_index=True, return_counts=True)
        if not len(targets):
            return
        more = np.full((len(targets), many.max()), -1)
        row = np.repeat(np.arange(len(targets)), many)
        more[row, np.arange(len(target)) - np.repeat(first, many)] = source
        most = self.layers[k].shape[1]
        fits = (self.layers[k][targets] >= 0).sum(1) + many <= most
        both = np.concatenate([self.layers[k][targets[fits]], more[fits]], axis=1)
        self.layers[k][targets[fits]] = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable")[:, :most], 1)
        targets, more = targets[~fits], more[~fits]
        for a in range(0, len(targets), TOGETHER):
            part = targets[a : a + TOGETHER]
            both = np.concatenate([self.layers[k][part], more[a : a + TOGETHER]], axis=1)
            self.layers[k][part] = self._choose(part, both, most)

    def _choose(self, nodes: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` neighbours of each node: the nearest, leaving out what is nearer to a chosen one.

        Places that remain are filled with the nearest of those left out.
        """
        sims = np.matmul(self.unit[candidates], self.unit[nodes][:, :, None])[:, :, 0]
        sims[candidates < 0] = -np.inf
        width = min(candidates.shape[1], 2 * most)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
        candidates, sims = np.take_along_axis(candidates, order, 1), np.take_along_axis(sims, order, 1)
        near = self.unit[candidates]
        among = np.matmul(near, near.transpose(0, 2, 1))
        rows, left = np.arange(len(nodes)), np.isfinite(sims)
        value = sims.copy()
        for k in range(width):
            kept = left[:, k]
            # A kept candidate shadows the later ones that are nearer to it than to the node.
            shadow = kept[:, None] & (among[:, k, :] > sims)
            shadow[:, : k + 1] = False
            left &= ~shadow
            value[shadow] -= 4.0
        value[~np.isfinite(sims)] = -np.inf
        best = np.argsort(-value, axis=1, kind="stable")[:, :most]
        found = np.where(np.isfinite(np.take_along_axis(value, best, 1)), candidates[rows[:, None], best], -1)
        return np.pad(found, ((0, 0), (0, most - found.shape[1])), constant_values=-1).astype(np.int32)

    def search(self, queries: np.ndarray, entry: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beams of all queries in layer ``k``: vectors and cosines, best first; -inf where there is none."""
        q, n = len(queries), len(self.unit)
        seen = np.zeros((q, n), bool)
        rows = np.arange(q)
        ids = np.full((q, beam), 0)
        sims = np.full((q, beam), -np.inf, np.float32)
        known = np.zeros((q, beam), bool)  # expanded
        start = entry[:, :beam]
        ids[:, : start.shape[1]] = start
        sims[:, : start.shape[1]] = np.einsum("qd,qcd->qc", queries, self.unit[start])
        same = np.zeros(start.shape, bool)
        for c in range(1, start.shape[1]):
            same[:, c] = (start[:, :c] == start[:, c : c + 1]).any(1)
        sims[:, : start.shape[1]][same] = -np.inf
        seen[rows[:, None], start] = True
        active = rows
        while len(active):
            value = np.where(known[active] | ~np.isfinite(sims[active]), -np.inf, sims[active])
            width = min(EXPANDED, beam)
            place = np.argpartition(-value, width - 1, axis=1)[:, :width]
            usable = np.isfinite(np.take_along_axis(value, place, 1))
            going = usable.any(1)
            active, place, usable = active[going], place[going], usable[going]
            if not len(active):
                break
            known[active[:, None], place] |= usable
            near = np.where(usable[:, :, None], self.layers[k][ids[active[:, None], place]], -1).reshape(len(active), -1)
            row, column = np.nonzero((near >= 0) & ~seen[active[:, None], near])
            node = near[row, column]
            _, once = np.unique(row * n + node, return_index=True)
            row, node = row[once], node[once]
            seen[active[row], node] = True
            if not len(row):
                continue
            found = np.einsum("rd,rd->r", self.unit[node], queries[active[row]])
            many = np.bincount(row, minlength=len(active))
            slot = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            more_ids, more_sims = np.zeros((len(active), many.max()), int), np.full((len(active), many.max()), -np.inf, np.float32)
            more_ids[row, slot], more_sims[row, slot] = node, found
            all_ids = np.concatenate([ids[active], more_ids], axis=1)
            all_sims = np.concatenate([sims[active], more_sims], axis=1)
            all_known = np.concatenate([known[active], np.zeros(more_ids.shape, bool)], axis=1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            ids[active], sims[active], known[active] = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_sims, all_known))
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def beams(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The best vectors seen by each query, and their cosines."""
        entry = np.full((len(queries), 1), self.top)
        for k in range(len(self.layers) - 1, 0, -1):
            entry = self.search(queries, entry, k, 4)[0]
        return self.search(queries, entry, 0, min(width, len(self.unit)))


def _unit(raw: np.ndarray) -> np.ndarray:
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float32)


def dense_groups(unit: np.ndarray, least: float) -> list[np.ndarray]:
    """Groups of at least ``BEAM`` vectors around a center, the first of each, that are all within half the angle of ``least``."""
    free, found = np.ones(len(unit), bool), []
    if len(unit) < BEAM:
        return found
    centers = np.unique(np.linspace(0, len(unit) - 1, PIVOTS).astype(int))
    near = unit[centers] @ unit.T >= np.cos(np.arccos(least) / 2)
    for row, center in zip(near, centers.tolist()):
        members = np.flatnonzero(row & free)
        if free[center] and len(members) >= BEAM:
            free[members] = False
            found.append(np.concatenate([[center], members[members != center]]))
    return found


class Shard:
    """The vectors of a shard, its dense groups, and the graph of the others."""

    def __init__(self, keys: np.ndarray, copies: np.ndarray, raw: np.ndarray, groups: list[np.ndarray], layers: list[np.ndarray] | None = None, top: int = 0):
        self.keys, self.copies, self.raw, self.groups = keys, copies, raw, groups
        self.norms = np.linalg.norm(raw, axis=1)
        loose = np.ones(len(keys), bool)
        for members in groups:
            loose[members] = False
        self.loose = np.flatnonzero(loose)
        self.graph = Graph(_unit(raw[self.loose]), layers, top) if len(self.loose) else None


class Fold:
    """Links of queries and least nodes reached, from pairs that come in blocks."""

    def __init__(self, queries: np.ndarray, keys: np.ndarray, copies: np.ndarray):
        self.nodes = np.unique(np.concatenate([queries, keys]))
        self.query, self.node = np.searchsorted(self.nodes, queries), np.searchsorted(self.nodes, keys)
        self.copies, self.links = copies, np.zeros(len(queries), np.int64)
        self.root = np.arange(len(self.nodes))

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """Pairs of a query and a vector; each pair comes once. Pairs of a vector with itself are none."""
        other = self.query[a] != self.node[b]
        a, b = a[other], b[other]
        self.links += np.bincount(a, self.copies[b], len(self.links)).astype(np.int64)
        a, b = self.query[a], self.node[b]
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _scan(fold: Fold, shard: Shard, members: np.ndarray, raw: np.ndarray, norms: np.ndarray, chosen: np.ndarray, least: float) -> None:
    """All links of the chosen queries with some vectors of a shard, by block products."""
    step = max(1, PRODUCT // max(1, len(members)))
    for at in range(0, len(chosen), step):
        part = chosen[at : at + step]
        a, b = np.nonzero(raw[part] @ shard.raw[members].T >= least * norms[part][:, None] * shard.norms[members])
        fold.add(part[a], members[b])


def _beam(shard: Shard, unit: np.ndarray, least: float) -> int:
    """The least width of the beam with which audited queries find enough."""
    audited = unit[np.unique(np.linspace(0, len(unit) - 1, min(AUDITED, len(unit))).astype(int))]
    n = len(shard.loose)
    sims = audited @ shard.graph.unit.T
    links = sims >= least
    order = np.argsort(-sims, axis=1, kind="stable")[:, : min(NEAREST, n)]
    nearest = np.zeros(sims.shape, bool)
    nearest[np.arange(len(audited))[:, None], order] = True
    width = min(BEAM, n)
    while width < n:
        ids, found = shard.graph.beams(audited, width)
        seen = np.zeros(sims.shape, bool)
        row, place = np.nonzero(np.isfinite(found))
        seen[row, ids[row, place]] = True
        seen_links = seen | (found[:, -1:] >= least)  # a full beam is finished by products
        if (links & seen_links).sum() >= RECALL * links.sum() and (nearest & seen).sum() >= RANK_RECALL * nearest.sum():
            break
        width = min(2 * width, n)
    return width


def links_between(shard: Shard, q_keys: np.ndarray, q_raw: np.ndarray, least: float) -> Fold:
    """Links of the queries with the vectors of a shard."""
    fold = Fold(q_keys, shard.keys, shard.copies)
    norms, unit = np.linalg.norm(q_raw, axis=1), _unit(q_raw)
    every = np.arange(len(q_keys))
    for members in shard.groups:
        # Members are within half the angle of the center, so a linked query is within one and a half.
        widest = 1.5 * np.arccos(least) + 1e-3
        reach = np.arccos(np.clip(unit @ _unit(shard.raw[members[:1]])[0], -1, 1)) <= widest
        _scan(fold, shard, members, q_raw, norms, every[reach], least)
    if shard.graph is None:
        return fold
    width = _beam(shard, unit, least - 1e-4)
    if width >= len(shard.loose):
        _scan(fold, shard, shard.loose, q_raw, norms, every, least)
        return fold
    for at in range(0, len(every), TOGETHER):
        part = every[at : at + TOGETHER]
        ids, sims = shard.graph.beams(unit[part], width)
        full = sims[:, -1] >= least - 1e-4
        a, place = np.nonzero((sims >= least - 1e-4) & ~full[:, None])
        a, b = part[a], shard.loose[ids[a, place]]
        exact = np.einsum("pd,pd->p", q_raw[a], shard.raw[b]) >= least * norms[a] * shard.norms[b]
        fold.add(a[exact], b[exact])
        _scan(fold, shard, shard.loose, q_raw, norms, part[full], least)
    return fold


_GRAPH = "label int, dim int, shard int, keys binary, copies binary, vectors binary, dense array<binary>, layers array<binary>, top int"
_GRAPH_ARROW = pa.schema(
    [("label", pa.int32()), ("dim", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary()),
     ("dense", pa.list_(pa.binary())), ("layers", pa.list_(pa.binary())), ("top", pa.int32())]
)


def _built(least: float):
    def run(table: pa.Table) -> pa.Table:
        """The graph of a shard as one row; ``table`` has its classes."""
        table = table.sort_by("key")
        raw = np.stack(table.column("embedding").to_pylist()).astype(np.float64)
        keys, copies = (table.column(c).to_numpy().astype(np.int64) for c in ("key", "copies"))
        shard = Shard(keys, copies, raw, dense_groups(_unit(raw), least))
        graph = shard.graph
        values = {
            "label": table.column("label")[0].as_py(),
            "dim": raw.shape[1],
            "shard": table.column("shard")[0].as_py(),
            "keys": keys.tobytes(),
            "copies": copies.tobytes(),
            "vectors": raw.tobytes(),
            "dense": [members.astype(np.int64).tobytes() for members in shard.groups],
            "layers": [layer.tobytes() for layer in graph.layers] if graph else [],
            "top": graph.top if graph else 0,
        }
        return pa.table({k: [v] for k, v in values.items()}, schema=_GRAPH_ARROW)

    return run


def _opened(row: dict) -> Shard:
    keys, copies = (np.frombuffer(row[c], np.int64) for c in ("keys", "copies"))
    groups = [np.frombuffer(x, np.int64) for x in row["dense"]]
    loose = len(keys) - sum(map(len, groups))
    layers = [np.frombuffer(x, np.int32).reshape(loose, -1) for x in row["layers"]]
    return Shard(keys, copies, np.frombuffer(row["vectors"], np.float64).reshape(len(keys), -1), groups, layers, row["top"])


_FOUND_ARROW = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def _compared(least: float):
    def run(graphs: pa.Table, queries: pa.Table) -> pa.Table:
        """Links of the vectors of some shards with those of others, counted, and their components."""
        parts = []
        for g in range(graphs.num_rows):
            shard = _opened(graphs.slice(g, 1).to_pylist()[0])
            for q in range(queries.num_rows):
                row = queries.slice(q, 1).to_pylist()[0]
                keys = np.frombuffer(row["keys"], np.int64)
                fold = links_between(shard, keys, np.frombuffer(row["vectors"], np.float64).reshape(len(keys), -1), least)
                counted = np.zeros(len(fold.nodes), np.int64)
                counted[fold.query] = fold.links
                root = fold.nodes[fold.root]
                some = (root != fold.nodes) | (counted > 0)
                parts.append(pa.table([x[some] for x in (fold.nodes, root, counted)], schema=_FOUND_ARROW))
        return pa.concat_tables(parts) if parts else _FOUND_ARROW.empty_table()

    return run


def near_duplicates(vectors: DataFrame, least: float = 0.93, shard: int = SHARD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every vector; see the module's text."""
    folder = scratch(vectors.sparkSession)
    vectors = vectors.where("vec_id is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("int").alias("label"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    length = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x)
    usable = F.coalesce(F.col("label").isNotNull() & ~odd & (length > 0), F.lit(False))
    same = ["label", "embedding"]
    classes = vectors.where(usable).groupBy(*same).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    # In the order of the least ids, so the least key of a component has its least id.
    classes = written(classes.orderBy("rep", *same).withColumn("dim", F.size("embedding")).withColumn("key", F.monotonically_increasing_id()), f"{folder}/classes")
    shards = classes.groupBy("label", "dim").agg(F.ceil(F.count("*") / F.lit(shard)).alias("shards")).withColumn("groups", F.ceil(F.col("shards") / F.lit(GROUP)))
    many, cells = shards.agg(F.coalesce(F.sum("shards"), F.lit(0)), F.coalesce(F.sum(F.col("groups") * F.col("groups")), F.lit(0))).first()
    dealt = classes.join(shards, ["label", "dim"]).withColumn("shard", F.pmod(F.xxhash64("key"), "shards").cast("int"))
    # Several times as many partitions as there is work, so that few get two pieces of it.
    place = ["label", "dim", "shard"]
    dealt = dealt.select(*place, "key", "copies", "embedding").repartition(min(4 * many + 1, MOST_PARTITIONS), *place)
    graphs = written(dealt.groupBy(*place).applyInArrow(_built(least), _GRAPH), f"{folder}/graphs")
    cell = ["label", "dim", "row", "column"]
    grid = graphs.join(shards.select("label", "dim", "groups"), ["label", "dim"]).withColumn("group", F.floor(F.col("shard") / GROUP))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))
    parts = min(4 * cells + 1, MOST_PARTITIONS)
    rows = grid.select("*", F.col("group").alias("row"), others.alias("column")).drop("group", "groups").repartition(parts, *cell)
    columns = grid.select("label", "dim", "keys", "vectors", "group", others.alias("row"))
    columns = columns.toDF("label", "dim", "keys", "vectors", "column", "row").repartition(parts, *cell)
    found = written(
        rows.groupBy(*cell).cogroup(columns.groupBy(*cell)).applyInArrow(_compared(least), "a long, b long, links long"), f"{folder}/found"
    )
    roots = components(found.select("a", "b"), f"{folder}/components").toDF("key", "root")
    counted = found.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "key")
    ids = classes.select(F.col("key").alias("root"), F.col("rep").alias("component_id"))
    known = classes.join(roots.join(ids, "root").drop("root"), "key", "left").join(counted, "key", "left").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "rep").alias("component_id")
    )
    linked = vectors.where(usable).join(known, same).select("vec_id", "n_links", "component_id")
    alone = vectors.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))
