"""Exact decimal arithmetic: money casts, rounded means and guarded rates.

Spark's ``avg`` and ``/`` on decimals keep only a few extra digits, so a later
``round`` can round twice. The helpers here round the true quotient once, half
away from zero, by integer division.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(c: Column) -> Column:
    return c.cast("decimal(18,2)")


def money_or_zero(c: Column) -> Column:
    return money(F.coalesce(c, F.lit(0)))


def rounded_quotient(num: Column, den: Column, places: int, scale: int = 0) -> Column:
    """``num / den`` rounded half away from zero; null when either is null or ``den`` is 0.

    ``scale`` is the number of decimal places the operands carry.
    """

    def units(c):
        c = c.cast(f"decimal({28 + scale},{scale})")
        return (c * F.lit(Decimal(10**scale))).cast("decimal(28,0)") if scale else c

    n, d = units(num), F.nullif(units(den), F.lit(Decimal(0)))
    twice = F.lit(Decimal(2))
    whole = F.call_function(
        "div", F.abs(n) * F.lit(Decimal(2 * 10**places)) + F.abs(d), F.abs(d) * twice
    )
    negative = (n < 0) != (d < 0)
    signed = F.when(negative, -whole).otherwise(whole)
    step = F.lit(Decimal(1).scaleb(-places))
    return (signed.cast("decimal(19,0)") * step).cast(f"decimal(18,{places})")


def mean(total: Column, count: Column, places: int, scale: int = 0) -> Column:
    """Mean from an already computed sum and count; null on an empty group."""
    return rounded_quotient(total, count, places, scale)


def rate(num: Column, den: Column, scale: int = 0) -> Column:
    """Share rounded to four places, 0 when nothing is in the denominator."""
    zero = F.lit(Decimal(0)).cast("decimal(18,4)")
    return F.coalesce(rounded_quotient(F.coalesce(num, F.lit(0)), den, 4, scale), zero)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0).cast("bigint"))


def count_where(condition: Column) -> Column:
    return F.count_if(condition).cast("bigint")
