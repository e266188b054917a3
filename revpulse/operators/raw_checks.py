"""Checks on the loaded source tables, one result row per check."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from revpulse.functions.numeric import count_where
from revpulse.operators.contracts import failing
from revpulse.operators.keys import Reference, Unique, key_pass, union_all
from revpulse.schemas import ENTITIES, Entity

RESULT = "check_name string, table_schema string, table_name string, check_type string, failed_records bigint, details string"


def _row(name: str, table: str, kind: str, failed: Column, details: Column | str) -> Column:
    text = F.lit(details) if isinstance(details, str) else details
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit("raw").alias("table_schema"),
        F.lit(table).alias("table_name"),
        F.lit(kind).alias("check_type"),
        failed.cast("bigint").alias("failed_records"),
        text.alias("details"),
    )


def _report(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def _blank(df: DataFrame, column: str) -> Column:
    """No value or an empty text. A date or a time that is there has a text, which need not be made to know that."""
    missing = F.col(column).isNull()
    if isinstance(df.schema[column].dataType, (DateType, TimestampNTZType, TimestampType)):
        return missing
    return missing | (F.col(column).cast("string") == "")


def check_tables_exist(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per expected table. The list is the registry, so it stays a driver-side literal."""
    rows = [
        (f"{e}_exists", "raw", e, "table_exists", int(e not in tables), "Table exists" if e in tables else "Missing table")
        for e in ENTITIES
    ]
    return spark.createDataFrame(rows, RESULT)


def _not_empty(e: Entity) -> list[Column]:
    n = F.count(F.lit(1))
    return [
        _row(f"{e.name}_not_empty", e.name, "not_empty", (n == 0).cast("int"), F.concat(F.lit("row_count="), n.cast("string")))
    ]


def _key_present(e: Entity) -> list[Column]:
    missing = count_where(F.col(e.key).isNull())
    return [_row(f"{e.name}_{e.key}_not_null", e.name, "primary_key_not_null", missing, f"primary_key={e.key}")]


def _dates_present(e: Entity, df: DataFrame) -> list[Column]:
    return [
        _row(f"{e.name}_{d}_valid", e.name, "date_not_null", count_where(_blank(df, d)), f"date_column={d}")
        for d in e.required_dates
    ]


def _non_negative(e: Entity) -> list[Column]:
    return [
        _row(
            f"{e.name}_{a}_non_negative",
            e.name,
            "non_negative_amount",
            count_where(failing(F.col(a) < 0)),
            f"amount_column={a}",
        )
        for a in e.amounts
    ]


def _present(tables) -> list[Entity]:
    return [e for e in ENTITIES.values() if e.name in tables]


def check_not_empty(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(_report(tables[e.name], _not_empty(e)) for e in _present(tables))


def check_pk_not_null(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(_report(tables[e.name], _key_present(e)) for e in _present(tables))


def check_dates_present(tables: Mapping[str, DataFrame]) -> DataFrame:
    dated = [e for e in _present(tables) if e.required_dates]
    return union_all(_report(tables[e.name], _dates_present(e, tables[e.name])) for e in dated)


def check_non_negative(tables: Mapping[str, DataFrame]) -> DataFrame:
    priced = [e for e in _present(tables) if e.amounts]
    return union_all(_report(tables[e.name], _non_negative(e)) for e in priced)


def uniques_of(tables) -> list[Unique]:
    return [Unique(e.name, e.key) for e in _present(tables)]


def references_of(tables) -> list[Reference]:
    return [
        Reference(e.name, key, parent, parent_key)
        for e in _present(tables)
        for key, (parent, parent_key) in e.references.items()
        if parent in tables
    ]


def _named(checks: list[Unique | Reference]) -> Column:
    """Name, table, kind and details of the check that a number stands for."""

    def one(check) -> tuple:
        if isinstance(check, Unique):
            return f"{check.relation}_{check.column}_unique", check.relation, "primary_key_unique", f"primary_key={check.column}"
        details = f"{check.relation}.{check.column} -> {check.parent}.{check.parent_column}"
        return f"{check.relation}_{check.column}_exists_in_{check.parent}", check.relation, "relationship", details

    names = ("check_name", "table_name", "check_type", "details")
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, one(c)))) for c in checks]
    return F.element_at(F.array(*rows), F.col("check") + 1)


def _key_report(tables: Mapping[str, DataFrame], uniques: list[Unique], references: list[Reference], keys: int | None = None) -> DataFrame:
    """Keys and references of all tables in one pass; several null keys count as one repeated key."""
    counted = key_pass(tables, uniques, references, keys=keys)
    if uniques:
        missing = [
            tables[u.relation].agg((count_where(F.col(u.column).isNull()) > 1).cast("bigint").alias("failed_rows")).select(F.lit(k).alias("check"), "failed_rows")
            for k, u in enumerate(uniques)
        ]
        counted = union_all([counted, *missing]).groupBy("check").agg(F.sum("failed_rows").alias("failed_rows"))
    named = counted.withColumn("of", _named([*uniques, *references]))
    return named.select(
        "of.check_name", F.lit("raw").alias("table_schema"), "of.table_name", "of.check_type", F.col("failed_rows").alias("failed_records"), "of.details"
    )


def check_pk_unique(tables: Mapping[str, DataFrame], keys: int | None = None) -> DataFrame:
    """Repeated primary keys per table; several null keys count as one repeated key. ``keys`` as in ``key_pass``."""
    return _key_report(tables, uniques_of(tables), [], keys)


def check_relationships(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _key_report(tables, [], references_of(tables))


def with_status(results: DataFrame) -> DataFrame:
    verdict = F.when(F.col("failed_records") == 0, "pass").otherwise("fail")
    return results.select(
        "check_name", "table_schema", "table_name", "check_type", verdict.alias("status"), "failed_records", "details"
    )


def raw_validation_report(spark: SparkSession, tables: Mapping[str, DataFrame], keys: int | None = None) -> DataFrame:
    """All source checks. Column checks of a table share one pass, and so do all keys and all references. ``keys`` as in ``key_pass``."""
    per_table = [
        _report(
            tables[e.name],
            _not_empty(e) + _key_present(e) + _dates_present(e, tables[e.name]) + _non_negative(e),
        )
        for e in _present(tables)
    ]
    parts = [check_tables_exist(spark, tables), *per_table]
    if _present(tables):
        parts.append(_key_report(tables, uniques_of(tables), references_of(tables), keys))
    return with_status(union_all(parts))


#: What a load finds out while it writes: (table, kind, column) and a number of rows.
Facts = Mapping[tuple[str, str, str], int]


def load_metrics(e: Entity, df: DataFrame) -> dict[tuple[str, str], Column]:
    """Counts of one entity that a write can make on its way: rows, null keys, blank dates, negative amounts."""
    return {
        ("rows", ""): F.count(F.lit(1)),
        ("null", e.key): count_where(F.col(e.key).isNull()),
        **{("blank", d): count_where(_blank(df, d)) for d in e.required_dates},
        **{("negative", a): count_where(failing(F.col(a) < 0)) for a in e.amounts},
    }


def key_facts(
    tables: Mapping[str, DataFrame], references: list[Reference], parents: int | None = None, keys: int | None = None
) -> dict[tuple[str, str, str], int]:
    """Repeated keys (null is none) and rows without a parent, counted together; a number for each check."""
    uniques = uniques_of(tables)
    checks = [*uniques, *references]
    found = {r["check"]: r["failed_rows"] for r in key_pass(tables, uniques, references, parents, keys).collect()}
    return {(c.relation, "repeated" if isinstance(c, Unique) else f"orphan of {c.parent}", c.column): found[k] for k, c in enumerate(checks)}


def report_of_facts(spark: SparkSession, facts: Facts) -> DataFrame:
    """The report of a load from what is known of it, without reading it."""
    tables = {table for table, *_ in facts}
    rows = []
    for e in _present(tables):
        n, missing = facts[e.name, "rows", ""], facts[e.name, "null", e.key]
        rows.append((f"{e.name}_not_empty", e.name, "not_empty", int(n == 0), f"row_count={n}"))
        rows.append((f"{e.name}_{e.key}_not_null", e.name, "primary_key_not_null", missing, f"primary_key={e.key}"))
        repeated = facts[e.name, "repeated", e.key] + (missing > 1)
        rows.append((f"{e.name}_{e.key}_unique", e.name, "primary_key_unique", repeated, f"primary_key={e.key}"))
        rows += [(f"{e.name}_{d}_valid", e.name, "date_not_null", facts[e.name, "blank", d], f"date_column={d}") for d in e.required_dates]
        rows += [(f"{e.name}_{a}_non_negative", e.name, "non_negative_amount", facts[e.name, "negative", a], f"amount_column={a}") for a in e.amounts]
        for key, (parent, parent_key) in e.references.items():
            if parent in tables:
                name = f"{e.name}_{key}_exists_in_{parent}"
                rows.append((name, e.name, "relationship", facts[e.name, f"orphan of {parent}", key], f"{e.name}.{key} -> {parent}.{parent_key}"))
    found = spark.createDataFrame([(name, "raw", *rest) for name, *rest in rows], RESULT)
    return with_status(check_tables_exist(spark, dict.fromkeys(tables)).union(found))
