"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revpulse.session import fresh_folder

#: Rounds after which a link table counts as broken; each round shrinks long paths by a constant factor.
MOST_ROUNDS = 60


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared one that the cluster names in ``spark.checkpoint.dir``."""
    return fresh_folder(spark, "llm")


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and read it back: the lineage ends there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(rows: DataFrame, path: str) -> DataFrame:
    """Every row with a number of its own as ``key`` and its columns as ``row``, written.

    Whatever the columns are called, they cannot clash with those that an operator adds.
    """
    return written(rows.select(F.monotonically_increasing_id().alias("key"), F.struct("*").alias("row")), path)


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """Point neighbours at the least node around them.

    ``larger``: each node hands its least neighbour to its larger neighbours. Otherwise each node does so
    to itself and its smaller neighbours. The minimum is a partial aggregate and the join carries one
    value per key, so a node with a third of all links does not gather them anywhere.
    """
    if larger:
        around = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        out = around.where("b > a").join(least, "a").select(F.col("b").alias("x"), "root")
    else:
        # Every link is (larger node, smaller node).
        least = links.groupBy("a").agg(F.min("b").alias("root"))
        out = links.join(least, "a").select(F.col("b").alias("x"), "root").union(least.select("a", "root"))
    return out.where("x <> root").select(F.col("x").alias("a"), F.col("root").alias("b")).distinct()


def components(links: DataFrame, folder: str) -> DataFrame:
    """``node, root`` for every node of ``links(a, b)``: the least node that links reach.

    Links may be repeated, in either direction, or from a node to itself; nulls are no links. An empty
    table gives an empty result. Each round is written to ``folder``.
    """
    state = written(
        links.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        f"{folder}/links-0",
    )
    before = None
    for k in range(1, MOST_ROUNDS + 1):
        large = _star(state, larger=True).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        state = written(_star(large, larger=False), f"{folder}/links-{k}")
        now = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:  # links of a star: every node to its root
            return state.select(F.col("a").alias("node"), F.col("b").alias("root")).union(state.select("b", "b").distinct())
        before = now
    raise RuntimeError("the components did not settle")
