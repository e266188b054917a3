"""Copies of good relations with known faults, to show that the checks fire.

Faults follow an attribute of the row, such as its country or plan, over the whole table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions.numeric import money


def _country(n: int) -> Column:
    return F.col("country") == f"NATION_{n}"


def _where(condition: Column, changed, name: str) -> Column:
    return F.when(condition, changed).otherwise(F.col(name)).alias(name)


def accounts(df: DataFrame) -> DataFrame:
    """Nameless in one country, an unknown segment in another, machinery accounts twice."""
    broken = df.withColumns(
        {
            "account_name": _where(_country(3), None, "account_name"),
            "segment": F.when(_country(4), "Micro").when(_country(5), None).otherwise(F.col("segment")),
        }
    )
    return broken.unionByName(broken.where(F.col("industry") == "MACHINERY"))


def deals(df: DataFrame) -> DataFrame:
    """Missing keys, missing dates, negative amounts and unknown accounts."""
    stage, plan = F.col("deal_stage"), F.col("plan")
    return df.withColumns(
        {
            "deal_id": _where(stage == "negotiation", None, "deal_id"),
            "created_at": _where(plan == "Growth", None, "created_at"),
            "deal_amount_usd": _where(plan == "Scale", -F.col("deal_amount_usd"), "deal_amount_usd"),
            "account_id": F.when(stage == "proposal", F.concat(F.lit("lost_"), "account_id"))
            .when(stage == "qualified", None)
            .otherwise(F.col("account_id")),
        }
    )


def contacts(df: DataFrame) -> DataFrame:
    """Finance contacts without a key, operations contacts of unknown accounts, administrators without a date, analysts twice."""
    role = F.col("role")
    broken = df.withColumns(
        {
            "contact_id": _where(role == "Finance", None, "contact_id"),
            "account_id": _where(role == "Operations", F.concat(F.lit("lost_"), "account_id"), "account_id"),
            "created_at": _where(role == "Admin", None, "created_at"),
        }
    )
    return broken.unionByName(broken.where(role == "Analyst"))


def no_rows(df: DataFrame) -> DataFrame:
    return df.where(F.lit(False))


def subscriptions(df: DataFrame) -> DataFrame:
    """Negative revenue of one plan, canceled ones without a start."""
    return df.withColumns(
        {
            "mrr_usd": _where(F.col("plan") == "Starter", -F.col("mrr_usd"), "mrr_usd"),
            "start_date": _where(F.col("status") == "canceled", None, "start_date"),
        }
    )


def invoices(df: DataFrame) -> DataFrame:
    """Open ones without a date, of unknown subscriptions, and with negative amounts."""
    is_open = F.col("status") == "open"
    return df.withColumns(
        {
            "invoice_date": _where(is_open, None, "invoice_date"),
            "subscription_id": _where(is_open, F.concat(F.lit("lost_"), "subscription_id"), "subscription_id"),
            "amount_due_usd": _where(is_open, -F.col("amount_due_usd"), "amount_due_usd"),
        }
    )


def payments(df: DataFrame) -> DataFrame:
    """Cards without a key, wires with negative amounts, transfers without a date and of unknown invoices."""
    method = F.col("payment_method")
    return df.withColumns(
        {
            "payment_id": _where(method == "card", None, "payment_id"),
            "amount_paid_usd": _where(method == "wire", -F.col("amount_paid_usd"), "amount_paid_usd"),
            "payment_date": _where(method == "bank_transfer", None, "payment_date"),
            "invoice_id": _where(method == "bank_transfer", F.concat(F.lit("lost_"), "invoice_id"), "invoice_id"),
        }
    )


def events(df: DataFrame) -> DataFrame:
    """Logins without a time, invitations of unknown subscriptions, reports twice."""
    kind = F.col("event_type")
    broken = df.withColumns(
        {
            "occurred_at": _where(kind == "login", None, "occurred_at"),
            "subscription_id": _where(kind == "user_invited", F.concat(F.lit("lost_"), "subscription_id"), "subscription_id"),
        }
    )
    return broken.unionByName(broken.where(kind == "report_created"))


def tickets(df: DataFrame) -> DataFrame:
    """Critical ones without a time, billing ones without a subscription, which is allowed, pending ones twice."""
    broken = df.withColumns(
        {
            "created_at": _where(F.col("severity") == "critical", None, "created_at"),
            "subscription_id": _where(F.col("category") == "billing", None, "subscription_id"),
        }
    )
    return broken.unionByName(broken.where(F.col("status") == "pending"))


def account_360(df: DataFrame) -> DataFrame:
    mrr, healthy = F.col("current_mrr_usd"), F.col("healthy_mrr_usd")
    off = F.when(_country(2), F.lit(Decimal("0.02"))).when(_country(3), F.lit(Decimal("0.01"))).otherwise(Decimal("0.00"))
    return df.withColumns(
        {
            "current_mrr_usd": money(F.when(_country(1), -mrr).otherwise(mrr)),
            "healthy_mrr_usd": money(healthy + off),
            "is_churn_risk": F.col("is_churn_risk") != _country(4),
            "is_current_customer": F.col("is_current_customer") != _country(5),
        }
    )


def account_360_with_gaps(df: DataFrame) -> DataFrame:
    return account_360(df).where(~_country(6))


def churn_risk(df: DataFrame) -> DataFrame:
    rank = F.col("risk_priority_rank")
    return df.withColumn("risk_priority_rank", F.when(_country(8), rank + 1).when(~_country(7), rank))


def customer_health(df: DataFrame) -> DataFrame:
    score, raw = F.col("customer_health_score"), F.col("raw_customer_health_score")
    return df.withColumns(
        {
            "customer_health_score": F.when(_country(9), score + 100).otherwise(score),
            "raw_customer_health_score": F.when(_country(10), raw - 100).otherwise(raw),
        }
    )


def ticket_summary(df: DataFrame) -> DataFrame:
    flipped = F.col("has_critical_ticket") != (F.col("support_burden_level") == "high_burden")
    return df.withColumn("has_critical_ticket", flipped)


def shifted(df: DataFrame, rate: str, by: int, tier: str) -> DataFrame:
    """A rate mart with one rate moved out of range for one revenue tier."""
    moved = (F.col(rate) + by).cast("decimal(18,4)")
    return df.withColumn(rate, F.when(F.col("revenue_tier") == tier, moved).otherwise(F.col(rate)))
