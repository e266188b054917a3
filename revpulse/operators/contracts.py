"""Generic data checks. Each returns failures as rows, so "pass" is an empty or zero result."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions.numeric import or_zero
from revpulse.operators.keys import lost_references, null_keys, repeated_keys, union_all


def failing(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _text(value) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_failures(
    df: DataFrame,
    not_null: Iterable[str] = (),
    accepted: Mapping[str, Iterable[str]] | None = None,
) -> DataFrame:
    """Failing row count of every per-column check of a relation, in a single pass over it.

    Null passes an accepted-values check; ``not_null`` is what catches it.
    """
    checks = [("not_null", name, f"`{name}` IS NULL") for name in not_null]
    for name, values in (accepted or {}).items():
        checks.append(("accepted_values", name, f"`{name}` NOT IN ({', '.join(map(_text, values))})"))
    rows = ", ".join(
        f"struct('{kind}' AS contract, '{name}' AS column_name, count_if({bad}) AS failed_rows)"
        for kind, name, bad in checks
    )
    return df.agg(F.expr(f"array({rows})").alias("checks")).select(F.inline("checks"))


def expect_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return column_failures(df, not_null=columns)


def expect_accepted_values(df: DataFrame, accepted: Mapping[str, Iterable]) -> DataFrame:
    return column_failures(df, accepted=accepted)


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Key values on more than one row; null counts as a value."""
    return repeated_keys(df, key).unionByName(null_keys(df, key))


def expect_unique(df: DataFrame, key: str) -> DataFrame:
    """Number of repeated values of a column, ignoring null."""
    repeated = repeated_keys(df, key)
    return repeated.agg(F.count(F.lit(1)).alias("failed_rows")).select(
        F.lit("unique").alias("contract"), F.lit(key).alias("column_name"), "failed_rows"
    )


def orphan_rows(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, parents: int | None = None) -> DataFrame:
    """Child keys without a parent, with the rows that carry them; null keys pass."""
    return lost_references(child, child_key, parent, parent_key, parents)


def expect_relationship(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, parents: int | None = None
) -> DataFrame:
    lost = orphan_rows(child, child_key, parent, parent_key, parents)
    return lost.agg(or_zero(F.sum("child_rows")).alias("failed_rows")).select(
        F.lit("relationship").alias("contract"), F.lit(child_key).alias("column_name"), "failed_rows"
    )
