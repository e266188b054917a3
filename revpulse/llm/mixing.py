"""Mixing sources to target weights by hierarchical budgets.

The sources are leaves of a tree domain - language - source, and every node has a weight among its
siblings. A token budget flows from the root to the leaves. A node can take what its leaves hold, times the
number of epochs that a text may be repeated. Among siblings the budget is split by weight; what a full
one cannot take goes to its siblings in proportion to their weights, and only when all of them are full does
it remain with the parent's siblings, because the parent's own capacity is the sum of its children's.

A leaf's tokens are the sequence of its documents in the order of a seeded hash, one epoch after the
other, each epoch in an order of its own. The leaf gives the prefix that fills its budget: whole epochs,
then documents up to the budget, the last one in part.

All of it is DataFrame operations. A leaf that holds a third of the rows is not gathered anywhere: its last
epoch is cut into hash ranges of about ``RANGE_ROWS`` ids, running totals are kept over ranges, and only
the range in which the budget ends is looked at closer. There, rows of one id and length are one group, and totals are
kept over groups; the group in which the budget ends, which an often repeated id makes large, is cut into parts once
more, and counted part by part. Budgets are integers throughout.

Defined results: null or empty texts have no tokens and are never selected; a null language or source
is ``und`` or ``unknown``. Weights that are not listed are ``other_weight``, and a node of weight 0 gets
nothing. Repeated rows are separate rows, which are chosen each for itself. Rows with a null id are left out. If the corpus cannot hold the
budget, every leaf gives all it may. An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import keyed, scratch, written

#: Rows of a leaf that one hash range, or part of a group, holds, about.
RANGE_ROWS = 2_000
LEVELS = ("domain", "lang", "source")


class Weights(NamedTuple):
    """Weights of siblings at each level; ``domains`` says which domain a source belongs to."""

    domains: dict[str, str]
    domain: dict[str, int]
    lang: dict[str, int]
    source: dict[str, int]
    other_domain: str = "other"
    other_weight: int = 1


def _lookup(column: Column, table: dict, default) -> Column:
    if not table:
        return F.lit(default)
    by_value: dict = {}
    for key, value in table.items():
        by_value.setdefault(value, []).append(key)
    found = F.lit(default)
    for value, keys in by_value.items():
        found = F.when(column.isin(keys), F.lit(value)).otherwise(found)
    return found


def token_counts(docs: DataFrame, weights: Weights, *keep: str) -> DataFrame:
    """``doc_id``, the leaf and the number of words ``[^\\x20\\x09-\\x0D]+`` of each text, and the columns ``keep``."""
    source = F.coalesce("source", F.lit("unknown"))
    return docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        _lookup(source, weights.domains, weights.other_domain).alias("domain"),
        F.coalesce("lang", F.lit("und")).alias("lang"),
        source.alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("n_tokens"),
        *keep,
    )


def _split(nodes: DataFrame, parent: tuple[str, ...]) -> DataFrame:
    """The budget of each node: its parent's ``given``, by ``weight``, up to ``capacity``.

    In the order of capacity for each unit of weight, a node is full if the level that the rest of the
    budget reaches with it, and all after it, is no less than its own. Nodes are few; one row each.
    """
    siblings = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("weight"), *LEVELS[: len(parent) + 1])
    before = siblings.rowsBetween(Window.unboundedPreceding, -1)
    after = siblings.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    big = "decimal(38,0)"
    left = F.col("given") - F.coalesce(F.sum("capacity").over(before), F.lit(0))
    ranked = nodes.withColumn("left", left).withColumn("rest", F.sum("weight").over(after))
    full = F.col("left").cast(big) * F.col("weight") >= F.col("capacity").cast(big) * F.col("rest")
    # Nodes are full up to the first that is not; it fixes the level of all that follow.
    ranked = ranked.withColumn("full", full).withColumn("reached", F.min(F.when(~F.col("full"), F.struct(-F.col("rest"), "left"))).over(whole))
    share = F.floor(F.col("reached.left").cast(big) * F.col("weight") / -F.col("reached.col1"))
    return ranked.withColumn("budget", F.when(F.col("full"), F.col("capacity")).otherwise(share).cast("long")).drop("left", "rest", "full", "reached", "given")


def leaf_budgets(counts: DataFrame, weights: Weights, total: int | None, epochs: int) -> DataFrame:
    """``domain, lang, source, rows, supply, budget`` of every leaf that holds tokens.

    ``total`` is the token budget; None stands for as many tokens as the leaves with a weight hold.
    """
    leaves = counts.where("n_tokens > 0").groupBy(*LEVELS).agg(F.count("*").alias("rows"), F.sum("n_tokens").alias("supply"))
    leaves = written(leaves, f"{scratch(counts.sparkSession)}/leaves")
    weight = {c: _lookup(F.col(c), getattr(weights, c), weights.other_weight).cast("long") for c in LEVELS}
    usable = leaves.where(weight["domain"] * weight["lang"] * weight["source"] > 0).withColumn("capacity", F.col("supply") * epochs)
    wanted = F.sum("supply") if total is None else F.lit(total).cast("long")
    given = usable.agg(F.least(wanted, F.sum("capacity")).alias("given"))
    for depth, level in enumerate(LEVELS):
        path = LEVELS[: depth + 1]
        nodes = usable.groupBy(*path).agg(F.sum("capacity").alias("capacity")).withColumn("weight", weight[level])
        parent = path[:-1]
        nodes = nodes.join(given, list(parent)) if parent else nodes.crossJoin(F.broadcast(given))  # one row
        given = _split(nodes, parent).select(*path, F.col("budget").alias("given"))
    return leaves.join(given, list(LEVELS)).select(*LEVELS, "rows", "supply", F.col("given").alias("budget"))


def _hash(seed: int, epoch: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), epoch.cast("string"), F.lit(":"), F.col("doc_id").cast("string")).cast("binary"))


def _last_group(rows: DataFrame) -> DataFrame:
    """The first ``whole`` rows of each leaf's last group, and ``rest`` tokens of the next; the rows are alike.

    Rows are counted in parts by a hash of their key, and numbered only within a part.
    """
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.ceil(F.col("many") / RANGE_ROWS).cast("long")))
    parts = rows.groupBy(*LEVELS, "part").agg(F.count("*").alias("in_part"))
    earlier = Window.partitionBy(*LEVELS).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("in_part").over(earlier), F.lit(0))).drop("in_part")
    number = F.col("before") + F.row_number().over(Window.partitionBy(*LEVELS, "part").orderBy("key"))
    numbered = rows.join(parts, [*LEVELS, "part"]).withColumn("number", number)
    taken = F.when(F.col("number") <= F.col("whole_rows"), F.col("n_tokens")).when(F.col("number") == F.col("whole_rows") + 1, F.col("rest"))
    return numbered.withColumn("taken", taken).where("taken > 0")


def _selected(counts: DataFrame, folder: str, weights: Weights, total: int | None, epochs: int, seed: int) -> DataFrame:
    """``key, doc_id, domain, lang, source, epoch, n_tokens, taken`` of every row and epoch that is used."""
    budgets = written(leaf_budgets(counts, weights, total, epochs).where("budget > 0"), f"{folder}/budgets")
    budgets = budgets.select(
        *LEVELS,
        F.floor(F.col("budget") / F.col("supply")).cast("long").alias("whole"),
        (F.col("budget") % F.col("supply")).alias("over"),
        F.ceil(F.col("rows") / RANGE_ROWS).cast("long").alias("ranges"),
    )
    rows = counts.where("n_tokens > 0").join(budgets, list(LEVELS))
    columns = ["key", "doc_id", *LEVELS, "epoch", "n_tokens", "taken"]
    complete = rows.where("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1))).withColumn("taken", F.col("n_tokens"))

    hashed = rows.where("over > 0").withColumn("epoch", F.col("whole")).withColumn("h", _hash(seed, F.col("epoch")))
    place = F.floor(F.conv(F.substring("h", 1, 8), 16, 10).cast("long") * F.col("ranges") / F.lit(1 << 32)).cast("long")
    hashed = hashed.withColumn("range", place)
    by_range = hashed.groupBy(*LEVELS, "range").agg(F.sum("n_tokens").alias("tokens"))
    earlier = Window.partitionBy(*LEVELS).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    by_range = by_range.withColumn("start", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    placed = hashed.join(by_range, [*LEVELS, "range"]).where("start < over")
    inside = placed.where("start + tokens <= over").withColumn("taken", F.col("n_tokens"))

    # One range of each leaf: what is left of its budget, group by group.
    ending = placed.where("start + tokens > over")
    group = [*LEVELS, "h", "n_tokens"]
    groups = ending.groupBy(*group).agg(F.count("*").alias("many"), F.first("over").alias("limit"), F.first("start").alias("from"))
    within = Window.partitionBy(*LEVELS).orderBy("h", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    left = F.col("limit") - F.col("from") - F.coalesce(F.sum(F.col("many") * F.col("n_tokens")).over(within), F.lit(0))
    groups = groups.withColumn("left", left).where("left > 0")
    groups = groups.withColumn("whole_rows", F.least("many", F.floor(F.col("left") / F.col("n_tokens")).cast("long")))
    groups = groups.withColumn("rest", F.col("left") - F.col("whole_rows") * F.col("n_tokens")).select(*group, "many", "whole_rows", "rest")
    reached = ending.join(groups, group)
    full = reached.where("whole_rows = many").withColumn("taken", F.col("n_tokens"))
    last = _last_group(reached.where("whole_rows < many"))
    return complete.select(columns).union(inside.select(columns)).union(full.select(columns)).union(last.select(columns))


def selection(docs: DataFrame, weights: Weights, total: int | None = None, epochs: int = 4, seed: int = 1) -> DataFrame:
    """``doc_id, domain, lang, source, epoch, n_tokens, taken`` of every document and epoch that is used."""
    folder = scratch(docs.sparkSession)
    counts = token_counts(docs, weights).withColumn("key", F.monotonically_increasing_id())
    return _selected(written(counts, f"{folder}/counts"), folder, weights, total, epochs, seed).drop("key")


def mixed(docs: DataFrame, weights: Weights, total: int | None = None, epochs: int = 4, seed: int = 1) -> DataFrame:
    """The documents of the selection with all their columns, once for each epoch; the last one is whole.

    Every row is chosen by itself, by a number that it gets here: rows that repeat an id under another source,
    language or text are not returned for each other.
    """
    folder = scratch(docs.sparkSession)
    rows = keyed(docs, f"{folder}/rows")
    counts = token_counts(rows.select("row.doc_id", "row.lang", "row.source", "row.text", "key"), weights, "key")
    used = _selected(written(counts, f"{folder}/counts"), folder, weights, total, epochs, seed)
    times = used.groupBy("key").agg((F.max("epoch") + 1).alias("times"))
    return rows.join(times, "key").select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
