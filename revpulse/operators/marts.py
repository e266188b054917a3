"""The six tables people query."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions import policy as P
from revpulse.functions.numeric import count_where, mean, money, rate
from revpulse.params import Policy

# Output columns shared by the account-level tables.
PROFILE = (
    "account_id",
    "account_name",
    "industry",
    "segment",
    "employee_band",
    "country",
    "account_owner",
    "account_lifecycle_stage",
)
REVENUE = (
    "current_mrr_usd",
    "total_invoiced_usd",
    "total_paid_usd",
    "total_outstanding_usd",
    "avg_collection_rate",
    "avg_days_to_payment",
    "has_overdue_invoice",
    "payment_risk_flag",
)
USAGE = (
    "total_events",
    "active_users",
    "active_days",
    "adopted_feature_count",
    "usage_intensity",
    "has_connected_integration",
    "has_created_report",
    "low_usage_paid_account",
)
SUPPORT = (
    "total_tickets",
    "open_tickets",
    "high_priority_tickets",
    "critical_tickets",
    "support_burden_level",
    "has_open_tickets",
    "has_critical_ticket",
    "support_risk_flag",
)
CONTACTS = (
    "contact_count",
    "executive_sponsor_count",
    "admin_contact_count",
)


def mart_customer_health(health: DataFrame) -> DataFrame:
    return health.select(
        *PROFILE,
        "is_current_customer",
        "customer_health_segment",
        "is_churn_risk",
        "raw_customer_health_score",
        "customer_health_score",
        *P.SCORE_PARTS,
        *REVENUE,
        *USAGE,
        *SUPPORT,
        *CONTACTS,
        P.recommended_action().alias("recommended_action"),
        P.health_priority_rank().alias("health_priority_rank"),
    )


def mart_account_360(customer_health: DataFrame, policy: Policy = Policy()) -> DataFrame:
    return customer_health.select(
        *PROFILE,
        P.account_status_group().alias("account_status_group"),
        "is_current_customer",
        "customer_health_segment",
        "recommended_action",
        "health_priority_rank",
        "is_churn_risk",
        "customer_health_score",
        "raw_customer_health_score",
        *REVENUE,
        *USAGE,
        *SUPPORT,
        *CONTACTS,
        P.mrr_at_risk().alias("mrr_at_risk_usd"),
        P.healthy_mrr().alias("healthy_mrr_usd"),
        P.non_healthy_mrr().alias("non_healthy_mrr_usd"),
        P.revenue_tier(policy).alias("revenue_tier"),
        P.account_priority_action(policy).alias("account_priority_action"),
    )


def current_customers(account_360: DataFrame) -> DataFrame:
    return account_360.where("is_current_customer")


def risk_accounts(account_360: DataFrame) -> DataFrame:
    return account_360.where("is_churn_risk")


def mart_churn_risk(account_360: DataFrame, policy: Policy = Policy()) -> DataFrame:
    return risk_accounts(account_360).select(
        *PROFILE,
        "account_status_group",
        "customer_health_segment",
        "account_priority_action",
        "revenue_tier",
        "customer_health_score",
        "raw_customer_health_score",
        "current_mrr_usd",
        "mrr_at_risk_usd",
        "usage_intensity",
        "total_events",
        "active_users",
        "active_days",
        "adopted_feature_count",
        "low_usage_paid_account",
        "support_burden_level",
        "total_tickets",
        "open_tickets",
        "high_priority_tickets",
        "critical_tickets",
        "has_open_tickets",
        "has_critical_ticket",
        "support_risk_flag",
        "has_overdue_invoice",
        "total_outstanding_usd",
        "avg_collection_rate",
        "avg_days_to_payment",
        "payment_risk_flag",
        P.primary_risk_reason().alias("primary_risk_reason"),
        P.risk_playbook().alias("recommended_risk_playbook"),
        P.risk_priority(policy).alias("risk_priority"),
        P.risk_priority_rank(policy).alias("risk_priority_rank"),
    )


def _accounts() -> Column:
    return F.count(F.lit(1))


def _account_mean(column: str, name: str) -> Column:
    return mean(F.sum(column), F.count(column), 2).alias(name)


def _account_share(condition: str, name: str) -> Column:
    return rate(count_where(F.col(condition)), _accounts()).alias(name)


def _exposure(*extra_mrr: str) -> list[Column]:
    return [
        _accounts().alias("customer_count"),
        count_where(F.col("is_churn_risk")).alias("churn_risk_customer_count"),
        *(money(F.sum(m)).alias(m) for m in ("current_mrr_usd", "mrr_at_risk_usd", *extra_mrr)),
    ]


def mart_revenue_retention(account_360: DataFrame) -> DataFrame:
    """Current revenue exposure by segment, tier and action; not a historical retention rate."""
    at_risk = rate(F.sum("mrr_at_risk_usd"), F.sum("current_mrr_usd"), scale=2)
    return (
        current_customers(account_360)
        .groupBy("customer_health_segment", "revenue_tier", "account_priority_action")
        .agg(
            *_exposure("healthy_mrr_usd", "non_healthy_mrr_usd"),
            _account_mean("customer_health_score", "avg_customer_health_score"),
            _account_mean("raw_customer_health_score", "avg_raw_customer_health_score"),
            at_risk.alias("mrr_at_risk_rate"),
            _account_share("is_churn_risk", "customer_risk_rate"),
        )
    )


def mart_product_adoption(account_360: DataFrame) -> DataFrame:
    """Usage by segment, tier and intensity; ``active_users`` adds up per-account user counts."""
    return (
        current_customers(account_360)
        .groupBy("customer_health_segment", "revenue_tier", "usage_intensity")
        .agg(
            *_exposure(),
            *(F.sum(n).alias(n) for n in ("total_events", "active_users", "active_days")),
            _account_mean("total_events", "avg_events_per_account"),
            _account_mean("active_users", "avg_active_users"),
            _account_mean("active_days", "avg_active_days"),
            _account_mean("adopted_feature_count", "avg_adopted_feature_count"),
            _account_mean("customer_health_score", "avg_customer_health_score"),
            count_where(F.col("has_connected_integration")).alias("accounts_with_integration"),
            count_where(F.col("has_created_report")).alias("accounts_with_created_report"),
            count_where(F.col("low_usage_paid_account")).alias("low_usage_paid_accounts"),
            _account_share("has_connected_integration", "integration_adoption_rate"),
            _account_share("has_created_report", "report_creation_rate"),
            _account_share("low_usage_paid_account", "low_usage_paid_account_rate"),
        )
    )


def mart_support_operations(account_360: DataFrame) -> DataFrame:
    """Support load by segment, tier and burden."""
    loads = ("total_tickets", "open_tickets", "high_priority_tickets", "critical_tickets")
    return (
        current_customers(account_360)
        .groupBy("customer_health_segment", "revenue_tier", "support_burden_level")
        .agg(
            *_exposure(),
            *(F.sum(n).alias(n) for n in loads),
            count_where(F.col("has_open_tickets")).alias("accounts_with_open_tickets"),
            count_where(F.col("has_critical_ticket")).alias("accounts_with_critical_ticket"),
            count_where(F.col("support_risk_flag")).alias("support_risk_accounts"),
            _account_mean("total_tickets", "avg_tickets_per_account"),
            *(_account_mean(n, f"avg_{n}_per_account") for n in loads[1:]),
            _account_mean("customer_health_score", "avg_customer_health_score"),
            _account_share("has_open_tickets", "open_ticket_account_rate"),
            _account_share("has_critical_ticket", "critical_ticket_account_rate"),
            _account_share("support_risk_flag", "support_risk_account_rate"),
        )
    )
