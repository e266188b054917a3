"""Support load per account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions import policy as P
from revpulse.functions.numeric import count_where, mean
from revpulse.params import Params, Policy


def tickets_as_of(tickets: DataFrame, params: Params = Params()) -> DataFrame:
    return tickets.where(F.col("created_date") <= F.lit(params.as_of_date))


def tickets_by_account(tickets: DataFrame, params: Params = Params()) -> DataFrame:
    open_, severity, days = F.col("is_open"), F.col("severity"), F.col("resolution_days")
    return (
        tickets_as_of(tickets, params)
        .groupBy("account_id")
        .agg(
            F.count(F.lit(1)).alias("total_tickets"),
            count_where(open_).alias("open_tickets"),
            count_where(F.col("is_resolved")).alias("resolved_tickets"),
            count_where(F.col("is_high_priority") & open_).alias("high_priority_tickets"),
            count_where((severity == "critical") & open_).alias("critical_tickets"),
            *(count_where(severity == s).alias(f"{s}_tickets") for s in ("high", "medium", "low")),
            F.min("created_date").alias("first_ticket_date"),
            F.max("created_date").alias("latest_ticket_date"),
            mean(F.sum(days), F.count(days), 2).alias("avg_resolution_days"),
        )
    )


def ticket_flags() -> dict[str, Column]:
    return {
        "has_open_tickets": F.col("open_tickets") > 0,
        "has_critical_ticket": F.col("critical_tickets") > 0,
    }


def account_ticket_summary(
    tickets: DataFrame, params: Params = Params(), policy: Policy = Policy()
) -> DataFrame:
    """One row per account with a ticket created by the observation date."""
    burden = P.support_burden(F.col("total_tickets"), F.col("high_priority_tickets"), policy)
    return tickets_by_account(tickets, params).withColumns({"support_burden_level": burden, **ticket_flags()})
