"""Business rules over the marts. Each returns the rows that break one rule."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions.numeric import money
from revpulse.operators.keys import moved
from revpulse.operators.marts import current_customers
from revpulse.operators.support import tickets_as_of
from revpulse.params import Params

MRR_COLUMNS = ("current_mrr_usd", "healthy_mrr_usd", "non_healthy_mrr_usd")


def _any(conditions) -> Column:
    out = F.lit(False)
    for condition in conditions:
        out = out | condition
    return out


def _outside(low, high, *columns: str) -> Column:
    return _any((F.col(n) < low) | (F.col(n) > high) for n in columns)


def assert_financials_non_negative(account_360: DataFrame) -> DataFrame:
    amounts = (*MRR_COLUMNS, "mrr_at_risk_usd")
    return account_360.where(_any(F.col(a) < 0 for a in amounts)).select("account_id", "account_name", *amounts)


def assert_mrr_components_reconcile(account_360: DataFrame) -> DataFrame:
    gap = F.col("current_mrr_usd") - (F.col("healthy_mrr_usd") + F.col("non_healthy_mrr_usd"))
    return account_360.where(F.abs(gap) > Decimal("0.01")).select(
        "account_id", "account_name", *MRR_COLUMNS, money(gap).alias("reconciliation_difference")
    )


def assert_risk_mart_only_risk(churn_risk: DataFrame, account_360: DataFrame) -> DataFrame:
    """Risk rows whose account is absent from the 360 table or not flagged there."""
    known = account_360.select("account_id", "is_churn_risk", F.lit(True).alias("known"))
    return (
        churn_risk.select("account_id", "account_name")
        .join(moved(known), "account_id", "left")
        .where(F.col("known").isNull() | ~F.col("is_churn_risk"))
        .drop("known")
    )


def assert_rank_in_band(churn_risk: DataFrame) -> DataFrame:
    # Ranks allowed inside each priority.
    bands = {"P1": (1,), "P2": (1, 2), "P3": (3, 4), "P4": (5,), "P5": (6,)}
    rank = F.col("risk_priority_rank")
    outside = _any((F.col("risk_priority") == p) & ~rank.isin(*ranks) for p, ranks in bands.items())
    return churn_risk.where(outside | rank.isNull()).select(
        "account_id",
        "account_name",
        "risk_priority",
        "risk_priority_rank",
        "current_mrr_usd",
        "mrr_at_risk_usd",
        "primary_risk_reason",
    )


def assert_critical_flag_open_only(
    ticket_summary: DataFrame, tickets: DataFrame, params: Params = Params()
) -> DataFrame:
    """Accounts whose critical flag disagrees with their open critical tickets."""
    critical = tickets_as_of(tickets, params).where((F.col("severity") == "critical") & F.col("is_open"))
    evidence = critical.select("account_id").distinct().withColumn("seen", F.lit(True))
    seen = F.coalesce("seen", F.lit(False))
    return (
        ticket_summary.select("account_id", "has_critical_ticket")
        .join(evidence, "account_id", "left")
        .where(~F.col("has_critical_ticket").eqNullSafe(seen))
        .select("account_id")
    )


def assert_scores_0_100(customer_health: DataFrame) -> DataFrame:
    return customer_health.where(_outside(0, 100, "customer_health_score", "raw_customer_health_score"))


def assert_healthy_not_risk(account_360: DataFrame) -> DataFrame:
    return account_360.where((F.col("customer_health_segment") == "healthy") & F.col("is_churn_risk")).select(
        "account_id", "account_name", "customer_health_segment", "is_churn_risk", "customer_health_score"
    )


def assert_non_customers_zero_mrr(account_360: DataFrame) -> DataFrame:
    return account_360.where(~F.col("is_current_customer") & (F.col("current_mrr_usd") != 0)).select(
        "account_id", "account_name", "account_status_group", "is_current_customer", "current_mrr_usd"
    )


def assert_non_risk_zero_at_risk(account_360: DataFrame) -> DataFrame:
    return account_360.where(~F.col("is_churn_risk") & (F.col("mrr_at_risk_usd") != 0)).select(
        "account_id", "account_name", "customer_health_segment", "is_churn_risk", "mrr_at_risk_usd"
    )


def _rates_inside(mart: DataFrame, third_key: str, *rates: str) -> DataFrame:
    return mart.where(_outside(0, 1, *rates)).select("customer_health_segment", "revenue_tier", third_key, *rates)


def assert_adoption_rates_0_1(adoption: DataFrame) -> DataFrame:
    return _rates_inside(
        adoption,
        "usage_intensity",
        "integration_adoption_rate",
        "low_usage_paid_account_rate",
        "report_creation_rate",
    )


def assert_retention_rates_0_1(retention: DataFrame) -> DataFrame:
    return _rates_inside(retention, "account_priority_action", "customer_risk_rate", "mrr_at_risk_rate")


def assert_support_rates_0_1(operations: DataFrame) -> DataFrame:
    return _rates_inside(
        operations,
        "support_burden_level",
        "open_ticket_account_rate",
        "critical_ticket_account_rate",
        "support_risk_account_rate",
    )


def global_totals(df: DataFrame, accounts: Column) -> DataFrame:
    return df.agg(
        money(F.sum("current_mrr_usd")).alias("current_mrr_usd"),
        money(F.sum("mrr_at_risk_usd")).alias("mrr_at_risk_usd"),
        accounts.alias("customer_count"),
    )


def reconcile_totals(account_360: DataFrame, retention: DataFrame) -> DataFrame:
    """Totals of both tables side by side; two single rows, so the join is one by one."""

    def prefixed(df, prefix):
        return df.select(*(F.col(n).alias(f"{prefix}_{n}") for n in df.columns))

    left = prefixed(global_totals(current_customers(account_360), F.count(F.lit(1))), "account_360")
    right = prefixed(global_totals(retention, F.sum("customer_count")), "revenue_retention")
    pairs = [
        f"{side}_{n}"
        for n in ("current_mrr_usd", "mrr_at_risk_usd", "customer_count")
        for side in ("account_360", "revenue_retention")
    ]
    return left.crossJoin(right).select(*pairs)


def assert_retention_matches_360(account_360: DataFrame, retention: DataFrame) -> DataFrame:
    differs = _any(
        F.col(f"account_360_{n}") != F.col(f"revenue_retention_{n}")
        for n in ("current_mrr_usd", "mrr_at_risk_usd", "customer_count")
    )
    return reconcile_totals(account_360, retention).where(differs)
