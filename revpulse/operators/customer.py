"""The account spine and its health signals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revpulse.functions import policy as P
from revpulse.functions.numeric import count_where, money, money_or_zero, or_zero
from revpulse.operators.keys import moved
from revpulse.params import Policy


def contacts_by_account(contacts: DataFrame) -> DataFrame:
    role = F.col("contact_role")
    return contacts.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("contact_count"),
        count_where(role == "Executive Sponsor").alias("executive_sponsor_count"),
        count_where(role == "Admin").alias("admin_contact_count"),
    )


def deals_by_account(deals: DataFrame) -> DataFrame:
    won = F.col("deal_stage") == "closed_won"
    return deals.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("total_deals"),
        count_where(won).alias("won_deals"),
        count_where(F.col("deal_stage") == "closed_lost").alias("lost_deals"),
        money(F.sum(F.when(won, F.col("deal_amount_usd")))).alias("won_deal_amount_usd"),
        money(F.sum(F.when(won, F.col("expected_mrr_usd")))).alias("won_expected_mrr_usd"),
        F.min("created_at").alias("first_deal_created_at"),
        F.max(F.when(won, F.col("close_date"))).alias("latest_won_close_date"),
    )


def subscriptions_by_account(subscriptions: DataFrame) -> DataFrame:
    """Subscription counts and the revenue that is not canceled."""
    running = ~F.col("is_canceled")
    return subscriptions.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("subscription_count"),
        count_where(F.col("is_active")).alias("active_subscription_count"),
        count_where(F.col("is_past_due")).alias("past_due_subscription_count"),
        count_where(F.col("is_canceled")).alias("canceled_subscription_count"),
        money(F.sum(F.when(running, F.col("mrr_usd")))).alias("current_mrr_usd"),
        money(F.sum(F.when(running, F.col("arr_usd")))).alias("current_arr_usd"),
        F.min("start_date").alias("first_subscription_start_date"),
        F.max("canceled_at").alias("latest_canceled_at"),
    )


def with_billing_customers(accounts: DataFrame, billing_customers: DataFrame) -> DataFrame:
    """Left join to billing customers that stays even when one account has most of them.

    Billing customers are counted per account like any other child, and an account with one takes its id
    from there, in place. Only accounts with several are joined to the rows themselves; that is an inner join,
    of which Spark can split a large key on either side.
    """
    pairs = billing_customers.select("account_id", "billing_customer_id")
    counted = pairs.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("billing_customers"), F.min("billing_customer_id").alias("billing_customer_id")
    )
    wide = accounts.join(counted, "account_id", "left")
    several = F.coalesce(F.col("billing_customers") > 1, F.lit(False))
    one = wide.where(~several).drop("billing_customers")
    many = wide.where(several).drop("billing_customers", "billing_customer_id").join(moved(pairs), "account_id")
    return one.unionByName(many)


def account_base(
    accounts: DataFrame,
    contacts: DataFrame,
    deals: DataFrame,
    billing_customers: DataFrame,
    subscriptions: DataFrame,
) -> DataFrame:
    """One row per account, plus one more for every further billing customer it has.

    Every other child is folded to its account first, and those joins share one
    partitioning on ``account_id``.
    """
    joined = (
        accounts.withColumnRenamed("created_at", "account_created_at")
        .join(contacts_by_account(contacts), "account_id", "left")
        .join(deals_by_account(deals), "account_id", "left")
        .join(subscriptions_by_account(subscriptions), "account_id", "left")
    )
    joined = with_billing_customers(joined, billing_customers)

    def counts(*names):
        return [or_zero(F.col(n)).alias(n) for n in names]

    def sums(*names):
        return [money_or_zero(F.col(n)).alias(n) for n in names]

    return joined.select(
        "account_id",
        "account_name",
        "industry",
        "segment",
        "employee_band",
        "country",
        "account_created_at",
        "account_owner",
        *counts("contact_count", "executive_sponsor_count", "admin_contact_count"),
        *counts("total_deals", "won_deals", "lost_deals"),
        *sums("won_deal_amount_usd", "won_expected_mrr_usd"),
        "first_deal_created_at",
        "latest_won_close_date",
        "billing_customer_id",
        *counts(
            "subscription_count",
            "active_subscription_count",
            "past_due_subscription_count",
            "canceled_subscription_count",
        ),
        *sums("current_mrr_usd", "current_arr_usd"),
        "first_subscription_start_date",
        "latest_canceled_at",
        P.lifecycle_stage(
            F.col("active_subscription_count"),
            F.col("past_due_subscription_count"),
            F.col("canceled_subscription_count"),
            F.col("won_deals"),
        ).alias("account_lifecycle_stage"),
    )


def account_signals(
    base: DataFrame, revenue: DataFrame, usage: DataFrame, tickets: DataFrame, policy: Policy = Policy()
) -> DataFrame:
    """Account spine with revenue, usage and support facts; absent facts become zero."""
    spine = base.select(
        "account_id",
        "account_name",
        "industry",
        "segment",
        "employee_band",
        "country",
        "account_owner",
        "account_lifecycle_stage",
        "contact_count",
        "executive_sponsor_count",
        "admin_contact_count",
    )
    use = usage.select(
        "account_id",
        "total_events",
        "active_users",
        "active_days",
        "first_event_date",
        "latest_event_date",
        "adopted_feature_count",
        "usage_intensity",
        "has_connected_integration",
        "has_created_report",
    )
    load = tickets.select(
        "account_id",
        "total_tickets",
        "open_tickets",
        "resolved_tickets",
        "high_priority_tickets",
        "critical_tickets",
        "latest_ticket_date",
        "avg_resolution_days",
        "support_burden_level",
        "has_open_tickets",
        "has_critical_ticket",
    )
    joined = (
        spine.join(revenue, "account_id", "left")
        .join(moved(use), "account_id", "left")
        .join(moved(load), "account_id", "left")
    )
    zero_counts = (
        "subscription_count",
        "active_subscription_count",
        "past_due_subscription_count",
        "canceled_subscription_count",
        "total_events",
        "active_users",
        "active_days",
        "adopted_feature_count",
        "total_tickets",
        "open_tickets",
        "resolved_tickets",
        "high_priority_tickets",
        "critical_tickets",
    )
    zero_money = (
        "current_mrr_usd",
        "total_invoiced_usd",
        "total_paid_usd",
        "total_outstanding_usd",
    )
    false_flags = (
        "has_overdue_invoice",
        "has_connected_integration",
        "has_created_report",
        "has_open_tickets",
        "has_critical_ticket",
    )
    filled = joined.withColumns(
        {
            **{n: or_zero(F.col(n)) for n in zero_counts},
            **{n: money_or_zero(F.col(n)) for n in zero_money},
            **{n: F.coalesce(F.col(n), F.lit(False)) for n in false_flags},
            "avg_collection_rate": F.coalesce(
                F.col("avg_collection_rate"), F.lit(0).cast("decimal(18,4)")
            ),
            "usage_intensity": F.coalesce("usage_intensity", F.lit(policy.no_usage)),
            "support_burden_level": F.coalesce("support_burden_level", F.lit(policy.no_burden)),
        }
    )
    return filled.withColumn(
        "is_current_customer",
        P.is_current_customer(
            F.col("current_mrr_usd"),
            F.col("active_subscription_count"),
            F.col("past_due_subscription_count"),
        ),
    )


def score_health(signals: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Risk flags, component scores, capped score, segment and churn risk."""
    return (
        signals.withColumns(P.risk_flags(policy))
        .withColumns(P.component_scores(policy))
        .withColumn("raw_customer_health_score", P.raw_health_score())
        .withColumn("customer_health_score", P.health_score(policy))
        .withColumns(
            {"customer_health_segment": P.health_segment(policy), "is_churn_risk": P.is_churn_risk()}
        )
    )


def health_signals(
    base: DataFrame, revenue: DataFrame, usage: DataFrame, tickets: DataFrame, policy: Policy = Policy()
) -> DataFrame:
    return score_health(account_signals(base, revenue, usage, tickets, policy), policy)
