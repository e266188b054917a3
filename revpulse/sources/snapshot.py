"""All-or-nothing publishing of a full source snapshot.

A load writes every entity to a new folder and only then commits their paths in one manifest. Readers
resolve folders through the manifest, so they see either the whole old load or the whole new one. The
audit rows of a load are appended to one table once it is committed.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from revpulse.operators.keys import union_all
from revpulse.operators.raw_checks import Facts, load_metrics
from revpulse.schemas import ENTITIES
from revpulse.sources import Sources
from revpulse.sources.history import History
from revpulse.sources.manifest import Manifest

AUDIT_SCHEMA = "table_schema string, table_name string, row_count bigint, loaded_at timestamp_ntz"
# These entities are written in folders by month, and in time order within a file.
TIMED_BY = {"product_events": "occurred_at", "support_tickets": "created_at", "billing_payments": "payment_date"}
MONTH = "_month"


def load_audit(spark: SparkSession, counts: Mapping[str, int], loaded_at: dt.datetime) -> DataFrame:
    rows = [("raw", name, n, loaded_at) for name, n in counts.items()]
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def count_entities(frames: Mapping[str, DataFrame], loaded_at: dt.datetime) -> DataFrame:
    """The audit rows a load of these frames would write, counted in Spark."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("raw").alias("table_schema"),
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(loaded_at).cast("timestamp_ntz").alias("loaded_at"),
        )
        for name, df in frames.items()
    )


class Snapshot(Sources):
    """Published entities, and what their load has counted; a range of days opens only its months."""

    def __init__(self, spark: SparkSession, paths: Mapping[str, str], facts: Facts | None = None):
        self.paths, self.facts = dict(paths), dict(facts or {})
        self._stored = {}
        for name, path in self.paths.items():
            schema = ENTITIES[name].schema
            if name in TIMED_BY:
                schema = schema.add(MONTH, "date")
            self._stored[name] = spark.read.schema(schema).parquet(path)
        super().__init__({name: df.drop(MONTH) for name, df in self._stored.items()})

    def between(self, name: str, first: dt.date | None, last: dt.date) -> DataFrame:
        """Rows of the months of these days; other entities, and rows without a time, are left as they are."""
        df = self._stored[name]
        if name not in TIMED_BY:
            return df
        months = F.col(MONTH) <= F.lit(last.replace(day=1))
        if first is not None:
            months &= F.col(MONTH) >= F.lit(first.replace(day=1))
        return df.where(months).drop(MONTH)


def write_entities(
    spark: SparkSession, frames: Mapping[str, DataFrame], root: str, writers: int = 4, dealt: Mapping[str, str] | None = None
) -> tuple[dict[str, str], dict[tuple[str, str, str], int]]:
    """Write entities to new folders that no manifest names yet; their paths, and what the writes have counted.

    Rows, null keys, blank dates and negative amounts are counted by the tasks that write the files, after
    the last shuffle, so a task that is run again does not count twice and nothing is read again.
    ``dealt`` names entities whose rows already lie in tasks of a fair size, in the order of a column: those tasks write
    them as they are, without a shuffle and sorted by nothing but the month, into a file for each month they have.
    """
    unknown = sorted(set(frames) - set(ENTITIES))
    if unknown:
        raise ValueError(f"unknown source entities: {', '.join(unknown)}")
    root, version = root.rstrip("/"), uuid.uuid4().hex

    def write(name: str) -> tuple[str, str, dict]:
        path = f"{root}/{name}/v={version}"
        df = frames[name].select(*ENTITIES[name].columns)
        metrics = load_metrics(ENTITIES[name], df)
        if name in TIMED_BY:
            df = df.withColumn(MONTH, F.trunc(TIMED_BY[name], "month"))
            if name in (dealt or {}):
                df = df.sortWithinPartitions(MONTH)
            else:
                # Spark splits a large month over several files and joins no two months in one.
                df = df.hint("rebalance", F.col(MONTH)).sortWithinPartitions(MONTH, TIMED_BY[name])
        seen = Observation()
        out = df.observe(seen, *(c.alias(f"{kind} {column}") for (kind, column), c in metrics.items())).write.option("compression", "zstd")
        (out.partitionBy(MONTH) if name in TIMED_BY else out).parquet(path)
        return name, path, {(name, *key): seen.get[" ".join(key)] for key in metrics}

    with ThreadPoolExecutor(writers) as pool:
        written = list(pool.map(write, frames))
    return {name: path for name, path, _ in written}, {key: n for *_, found in written for key, n in found.items()}


def row_counts(facts: Facts) -> dict[str, int]:
    return {table: n for (table, kind, _), n in facts.items() if kind == "rows"}


def append_audit(spark: SparkSession, root: str, counts: Mapping[str, int], loaded_at: dt.datetime) -> None:
    _audit(spark, root).append(load_audit(spark, counts, loaded_at))


def _audit(spark: SparkSession, root: str) -> History:
    return History(spark, f"{root.rstrip('/')}/load_audit", AUDIT_SCHEMA)


def publish_snapshot(
    spark: SparkSession,
    frames: Mapping[str, DataFrame],
    root: str,
    loaded_at: dt.datetime,
    writers: int = 4,
    dealt: Mapping[str, str] | None = None,
) -> Snapshot:
    """Replace the given entities together; any failure leaves the previous load in place."""
    paths, facts = write_entities(spark, frames, root, writers, dealt)
    Manifest(spark, root).commit(lambda was: committed(was, paths, facts))
    append_audit(spark, root, row_counts(facts), loaded_at)
    return open_snapshot(spark, root)


def committed(was: dict, paths: Mapping[str, str], facts: Facts) -> dict:
    """A state with some entities replaced, and what is known of them; what it said of replaced ones is gone."""
    kept = [row for row in was.get("facts", []) if row[0] not in paths]
    known = [[*key, n] for key, n in facts.items()]
    return {**was, "entities": {**was.get("entities", {}), **paths}, "facts": kept + known}


def facts_of(state: dict) -> dict[tuple[str, str, str], int]:
    return {(table, kind, column): n for table, kind, column, n in state.get("facts", [])}


def open_snapshot(spark: SparkSession, root: str) -> Snapshot:
    """The entities of the load the manifest currently names."""
    state = Manifest(spark, root).read()
    return Snapshot(spark, state.get("entities", {}), facts_of(state))


def read_load_audit(spark: SparkSession, root: str) -> DataFrame:
    """Audit rows of all committed loads."""
    return _audit(spark, root).read()


def table_fingerprint(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and content digest of every table, independent of row order.

    A row's digest is the md5 of its length-prefixed fields. Two 60-bit parts of it
    are added up exactly, so repeated rows count and no task sees a whole table. Each part is added up
    in limbs of 20 bits, whose sums are plain numbers for up to 2^43 rows; decimals of 38 digits are made of the sums alone.
    """
    limbs, bits = 3, 20

    def one(name: str, df: DataFrame) -> DataFrame:
        # A text is made once for its length and itself.
        texts = df.select(*(F.col(column).cast("string").alias(column) for column in df.columns))
        fields = []
        for column in df.columns:
            text = F.col(column)
            mark = F.when(text.isNull(), "-").otherwise(":")
            fields += [F.coalesce(F.length(text).cast("string"), F.lit("")), mark, F.coalesce(text, F.lit(""))]
        parts = texts.select(F.md5(F.concat(*fields)).alias("digest")).select(
            *(F.conv(F.substring("digest", start, 15), 16, 10).cast("bigint").alias(part) for part, start in (("high", 1), ("low", 17)))
        )

        def limb(part, k):
            return F.sum(F.shiftright(part, bits * k).bitwiseAND(F.lit((1 << bits) - 1))).alias(f"{part}_{k}")

        def total(part):
            shares = [F.col(f"{part}_{k}").cast("decimal(20,0)") * F.lit(1 << bits * k).cast("decimal(13,0)") for k in range(limbs)]
            return F.coalesce(sum(shares[1:], shares[0]), F.lit(0)).cast("decimal(38,0)").cast("string").alias(f"digest_{part}")

        sums = parts.agg(F.count(F.lit(1)).alias("row_count"), *(limb(part, k) for part in ("high", "low") for k in range(limbs)))
        return sums.select(F.lit(name).alias("table_name"), "row_count", total("high"), total("low"))

    return union_all(one(name, df) for name, df in frames.items())


def reload_is_idempotent(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per table, whether two fingerprints agree; a table missing on either side does not."""
    facts = ("row_count", "digest_high", "digest_low")

    def side(df, prefix):
        return df.select("table_name", *(F.col(f).alias(f"{prefix}_{f}") for f in facts))

    same = F.lit(True)
    for f in facts:
        same = same & F.col(f"before_{f}").isNotNull() & F.col(f"before_{f}").eqNullSafe(F.col(f"after_{f}"))
    return (
        side(before, "before")
        .join(side(after, "after"), "table_name", "full")
        .select(
            "table_name",
            F.col("before_row_count").alias("rows_before"),
            F.col("after_row_count").alias("rows_after"),
            same.alias("unchanged"),
        )
    )
