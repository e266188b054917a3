"""Small builders for "first rule that applies" expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _lit(v):
    return v if isinstance(v, Column) else F.lit(v)


def first_match(rules, otherwise) -> Column:
    """Result of the first (condition, result) pair whose condition is true; null counts as false."""
    out = None
    for condition, result in rules:
        out = F.when(condition, _lit(result)) if out is None else out.when(condition, _lit(result))
    return _lit(otherwise) if out is None else out.otherwise(_lit(otherwise))


def banded(value: Column, bands, otherwise) -> Column:
    """Result of the highest lower bound that ``value`` reaches."""
    ordered = sorted(bands, key=lambda b: b[0], reverse=True)
    return first_match([(value >= F.lit(bound), result) for bound, result in ordered], otherwise)


def flag(condition: Column) -> Column:
    """Boolean that is false where the condition is null."""
    return F.coalesce(condition, F.lit(False))
