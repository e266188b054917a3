"""Invoice settlement and the revenue position of each subscription and account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions import policy as P
from revpulse.functions.numeric import count_where, mean, money, money_or_zero, or_zero
from revpulse.operators.keys import moved
from revpulse.params import Params


def payments_as_of(payments: DataFrame, params: Params = Params()) -> DataFrame:
    return payments.where(F.col("payment_date") <= F.lit(params.as_of_date))


def payments_by_invoice(payments: DataFrame, params: Params = Params()) -> DataFrame:
    return (
        payments_as_of(payments, params)
        .groupBy("invoice_id")
        .agg(
            F.count(F.lit(1)).alias("payment_count"),
            money(F.sum("amount_paid_usd")).alias("total_paid_usd"),
            F.min("payment_date").alias("first_payment_date"),
            F.max("payment_date").alias("latest_payment_date"),
        )
    )


def invoice_state(paid: Column, params: Params) -> dict[str, Column]:
    """What an invoice's payments say about it; replaces the status the source reported."""
    due = F.col("amount_due_usd")
    settled = paid >= due
    return {
        "is_paid": settled,
        "is_open": ~settled,
        "outstanding_amount_usd": money(due - paid),
        "is_fully_paid": F.coalesce(settled, F.lit(False)),
        "days_to_payment": F.datediff("first_payment_date", "invoice_date"),
        "is_overdue": F.coalesce(~settled & (F.col("due_date") < F.lit(params.as_of_date)), F.lit(False)),
    }


def invoice_payment_summary(invoices: DataFrame, payments: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per invoice. Payments stop at the observation date, invoices do not."""
    joined = invoices.drop("is_paid", "is_open").join(
        payments_by_invoice(payments, params), "invoice_id", "left"
    )
    paid = money_or_zero(F.col("total_paid_usd"))
    state = invoice_state(paid, params)
    return joined.select(
        "invoice_id",
        "subscription_id",
        "billing_customer_id",
        "account_id",
        "invoice_date",
        "due_date",
        "amount_due_usd",
        "invoice_status",
        state["is_paid"].alias("is_paid"),
        state["is_open"].alias("is_open"),
        or_zero(F.col("payment_count")).alias("payment_count"),
        paid.alias("total_paid_usd"),
        "first_payment_date",
        "latest_payment_date",
        *(
            state[n].alias(n)
            for n in ("outstanding_amount_usd", "is_fully_paid", "days_to_payment", "is_overdue")
        ),
    )


def invoices_by_subscription(invoice_summary: DataFrame) -> DataFrame:
    days = F.col("days_to_payment")
    return invoice_summary.groupBy("subscription_id").agg(
        F.count(F.lit(1)).alias("invoice_count"),
        count_where(F.col("is_fully_paid")).alias("paid_invoice_count"),
        count_where(F.col("is_open")).alias("open_invoice_count"),
        count_where(F.col("is_overdue")).alias("overdue_invoice_count"),
        money(F.sum("amount_due_usd")).alias("total_invoiced_usd"),
        money(F.sum("total_paid_usd")).alias("total_paid_usd"),
        money(F.sum("outstanding_amount_usd")).alias("total_outstanding_usd"),
        F.min("invoice_date").alias("first_invoice_date"),
        F.max("invoice_date").alias("latest_invoice_date"),
        F.max("latest_payment_date").alias("latest_payment_date"),
        mean(F.sum(days), F.count(days), 2).alias("avg_days_to_payment"),
    )


def subscription_settlement(
    subscriptions: DataFrame, invoice_summary: DataFrame, params: Params = Params()
) -> DataFrame:
    """One row per subscription with its invoice totals, rates and age."""
    joined = subscriptions.join(invoices_by_subscription(invoice_summary), "subscription_id", "left")
    counts = ("invoice_count", "paid_invoice_count", "open_invoice_count", "overdue_invoice_count")
    sums = ("total_invoiced_usd", "total_paid_usd", "total_outstanding_usd")
    return joined.withColumns(
        {
            **{n: or_zero(F.col(n)) for n in counts},
            **{n: money_or_zero(F.col(n)) for n in sums},
            "collection_rate": P.collection_rate(F.col("total_paid_usd"), F.col("total_invoiced_usd")),
            "current_mrr_usd": P.subscription_current_mrr(),
            "subscription_age_days": P.subscription_age_days(params.as_of_date),
            "has_overdue_invoice": or_zero(F.col("overdue_invoice_count")) > 0,
        }
    )


def subscriptions_enriched(settlement: DataFrame, accounts: DataFrame) -> DataFrame:
    """Subscription settlement with the account's descriptive columns."""
    about = accounts.select("account_id", "account_name", "industry", "segment", "country")
    return settlement.join(moved(about), "account_id", "left").select(
        "subscription_id",
        "billing_customer_id",
        "account_id",
        "account_name",
        "industry",
        "segment",
        "country",
        "plan",
        "subscription_status",
        "billing_cycle",
        "mrr_usd",
        "arr_usd",
        "start_date",
        "canceled_at",
        "is_active",
        "is_canceled",
        "is_past_due",
        "invoice_count",
        "paid_invoice_count",
        "open_invoice_count",
        "overdue_invoice_count",
        "total_invoiced_usd",
        "total_paid_usd",
        "total_outstanding_usd",
        "first_invoice_date",
        "latest_invoice_date",
        "latest_payment_date",
        "avg_days_to_payment",
        "collection_rate",
        "current_mrr_usd",
        "subscription_age_days",
        "has_overdue_invoice",
    )


def revenue_by_account(subscriptions: DataFrame) -> DataFrame:
    """One row per subscribed account.

    Rates and payment days are averaged over subscriptions that were themselves
    rounded, each subscription counting once whatever its size.
    """
    rate, days = F.col("collection_rate"), F.col("avg_days_to_payment")
    return subscriptions.groupBy("account_id").agg(
        F.count(F.lit(1)).alias("subscription_count"),
        count_where(F.col("is_active")).alias("active_subscription_count"),
        count_where(F.col("is_past_due")).alias("past_due_subscription_count"),
        count_where(F.col("is_canceled")).alias("canceled_subscription_count"),
        money(F.sum("current_mrr_usd")).alias("current_mrr_usd"),
        money(F.sum("total_invoiced_usd")).alias("total_invoiced_usd"),
        money(F.sum("total_paid_usd")).alias("total_paid_usd"),
        money(F.sum("total_outstanding_usd")).alias("total_outstanding_usd"),
        F.max("latest_invoice_date").alias("latest_invoice_date"),
        F.max("latest_payment_date").alias("latest_payment_date"),
        F.bool_or("has_overdue_invoice").alias("has_overdue_invoice"),
        mean(F.sum(rate), F.count(rate), 4, scale=4).alias("avg_collection_rate"),
        mean(F.sum(days), F.count(days), 2, scale=2).alias("avg_days_to_payment"),
    )


def expected_invoice_schedule(subscriptions: DataFrame, params: Params = Params()) -> DataFrame:
    """Invoices the billing rules call for, month by month, up to the observation month.

    Monthly contracts bill MRR every month; annual ones bill twelve times MRR in
    the month they started. Billing stops once a month begins after cancellation.
    """
    as_of = F.lit(params.as_of_date)
    first, last = F.trunc("start_date", "MM"), F.trunc(as_of, "MM")
    cutoff = F.least(last, F.trunc("canceled_at", "MM"))
    months = F.when(
        (F.col("start_date") <= as_of) & (first <= cutoff),
        F.sequence(first, cutoff, F.expr("interval 1 month")),
    )
    monthly = F.col("billing_cycle") == "monthly"
    anniversary = F.month("invoice_date") == F.month("start_date")
    return (
        subscriptions.withColumn("invoice_date", F.explode(months))
        .where(monthly | anniversary)
        .select(
            "subscription_id",
            "billing_customer_id",
            "account_id",
            "invoice_date",
            F.date_add("invoice_date", 15).alias("due_date"),
            money(F.when(monthly, F.col("mrr_usd")).otherwise(F.col("mrr_usd") * 12)).alias("amount_due_usd"),
        )
    )
