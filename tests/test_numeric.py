from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from revpulse.functions.ladders import banded, first_match, flag
from revpulse.functions.numeric import mean, rate, rounded_quotient

CENTS = st.integers(-(10**12), 10**12)


def exact(n, d, places):
    """True quotient rounded half away from zero, by integers."""
    if d == 0:
        return None
    sign = -1 if (n < 0) != (d < 0) else 1
    whole = (2 * abs(n) * 10**places + abs(d)) // (2 * abs(d))
    return Decimal(sign * whole).scaleb(-places)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(CENTS, CENTS), min_size=1, max_size=40))
def test_quotient_matches_exact_arithmetic(spark, pairs):
    rows = [(Decimal(n).scaleb(-2), Decimal(d).scaleb(-2)) for n, d in pairs]
    df = spark.createDataFrame(rows, "n decimal(18,2), d decimal(18,2)")
    out = df.select("n", "d", rounded_quotient(F.col("n"), F.col("d"), 4, scale=2).alias("q")).collect()
    for r in out:
        assert r.q == exact(int(r.n * 100), int(r.d * 100), 4)


@pytest.mark.parametrize(
    "n, d, places, expected",
    [(1, 8, 2, "0.13"), (-1, 8, 2, "-0.13"), (1, 3, 4, "0.3333"), (2, 3, 4, "0.6667"), (5, 1, 2, "5.00"), (0, 7, 2, "0.00")],
)
def test_ties_go_away_from_zero(spark, n, d, places, expected):
    got = spark.range(1).select(rounded_quotient(F.lit(n), F.lit(d), places).alias("q")).first().q
    assert got == Decimal(expected)


def test_quotient_of_nothing_is_null_and_rate_is_zero(spark):
    row = spark.range(1).select(
        rounded_quotient(F.lit(5), F.lit(0), 2).alias("q"),
        rate(F.lit(5), F.lit(0)).alias("r"),
        rate(F.lit(None).cast("bigint"), F.lit(4)).alias("none"),
    ).first()
    assert row.q is None and row.r == 0 and row.none == 0


def test_mean_does_not_round_twice(spark):
    """The mean of these is just below the tie; one more rounding on the way would lift it."""
    n = 20_000_000
    total = Decimal("0.0001") * (n // 2 - 1)
    df = spark.createDataFrame([(total, n)], "total decimal(28,4), n bigint")
    assert df.select(mean(F.col("total"), F.col("n"), 4, scale=4).alias("m")).first().m == Decimal("0.0000")
    tie = spark.createDataFrame([(Decimal("0.0001"), 2)], "total decimal(28,4), n bigint")
    assert tie.select(mean(F.col("total"), F.col("n"), 4, scale=4).alias("m")).first().m == Decimal("0.0001")


def test_mean_agrees_with_decimal_quantize(spark):
    values = [Decimal("2.675"), Decimal("-2.675")]
    df = spark.createDataFrame([(v,) for v in values], "v decimal(18,3)")
    out = df.select(rounded_quotient(F.col("v"), F.lit(1), 2, scale=3).alias("q")).collect()
    assert [r.q for r in out] == [v.quantize(Decimal("0.01"), ROUND_HALF_UP) for v in values]


def test_ladders_treat_null_as_false(spark):
    df = spark.createDataFrame([(None,), (5,), (10,)], "v int")
    out = df.select(
        first_match([(F.col("v") > 7, "big")], "rest").alias("first"),
        banded(F.col("v"), [(5, "five"), (10, "ten")], "none").alias("band"),
        flag(F.col("v") > 7).alias("flag"),
    ).collect()
    assert [tuple(r) for r in out] == [("rest", "none", False), ("rest", "five", False), ("big", "ten", True)]
