"""Product usage inside the observation window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revpulse.functions import policy as P
from revpulse.functions.numeric import count_where
from revpulse.params import Params, Policy
from revpulse.schemas import EVENT_TYPES

# Output column counting each event type.
TYPE_COUNTS = {
    "login": "login_events",
    "dashboard_viewed": "dashboard_view_events",
    "report_created": "report_created_events",
    "integration_connected": "integration_connected_events",
    "user_invited": "user_invited_events",
    "export_downloaded": "export_downloaded_events",
}
DAYS_PER_WORD = 62


def events_in_window(events: DataFrame, params: Params = Params()) -> DataFrame:
    return events.where(F.col("event_date").between(F.lit(params.window_start), F.lit(params.as_of_date)))


def _day_words(params: Params) -> dict[str, Column]:
    """One bit per window day, spread over as many longs as the window needs."""
    day = F.datediff("event_date", F.lit(params.window_start))
    words = {}
    for w in range(-(-params.usage_window_days // DAYS_PER_WORD)):
        offset = day - w * DAYS_PER_WORD
        inside = offset.between(0, DAYS_PER_WORD - 1)
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.when(inside, offset).otherwise(0))
        words[f"days_{w}"] = F.when(inside, bit).otherwise(F.lit(0).cast("bigint"))
    return words


def usage_facts(events: DataFrame, params: Params = Params()) -> DataFrame:
    """Window events folded to one row per account, and one more for each of its members.

    The account's own row (slot 0) has all measures: days are a bitmap and listed types are counters, so they
    fold on the map side to one row. A member is a user (slot 1) or, for an event of a type that has no counter
    of its own, that type (slot 2); counting members gives both distinct counts exactly. Their rows have
    no measures, so the many that shuffle are short, and a busy account is spread over its users.
    """
    words = _day_words(params)
    kind = F.col("event_type")
    listed = F.coalesce(kind.isin(*EVENT_TYPES), F.lit(True))
    members = (F.struct(F.lit(0).alias("slot"), F.lit(None).cast("string").alias("member")), F.struct(F.lit(1).alias("slot"), F.col("user_id").alias("member")))
    rows = F.when(listed, F.array(*members)).otherwise(F.array(*members, F.struct(F.lit(2).alias("slot"), kind.alias("member"))))
    own = F.col("slot") == 0
    return (
        events_in_window(events, params)
        .select(
            "account_id",
            "event_type",
            "event_date",
            *(v.alias(k) for k, v in words.items()),
            F.inline(rows),
        )
        .where(own | F.col("member").isNotNull())
        .groupBy("account_id", "slot", "member")
        .agg(
            count_where(own).alias("total_events"),
            F.min(F.when(own, F.col("event_date"))).alias("first_event_date"),
            F.max(F.when(own, F.col("event_date"))).alias("latest_event_date"),
            *(F.bit_or(F.when(own, F.col(w))).alias(w) for w in words),
            *(count_where(own & (kind == k)).alias(name) for k, name in TYPE_COUNTS.items()),
        )
    )


def usage_by_account(events: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per account with events in the window.

    Rows of members move to their account unfolded: a task that has any members has some of nearly every
    account, and to fold them there would take memory for all accounts and save little.
    """
    days = [F.bit_count(F.bit_or(w)).cast("bigint") for w in _day_words(params)]
    counters = ("total_events", *TYPE_COUNTS.values())
    used = [F.when(F.col(name) > 0, 1).otherwise(0) for name in TYPE_COUNTS.values()]
    return (
        usage_facts(events, params)
        .repartition("account_id")
        .groupBy("account_id")
        .agg(
            *(F.sum(n).alias(n) for n in counters),
            count_where(F.col("slot") == 1).alias("active_users"),
            sum(days[1:], days[0]).alias("active_days"),
            F.min("first_event_date").alias("first_event_date"),
            F.max("latest_event_date").alias("latest_event_date"),
            count_where(F.col("slot") == 2).alias("other_features"),
        )
        .select(
            "account_id",
            "total_events",
            "active_users",
            "active_days",
            "first_event_date",
            "latest_event_date",
            *TYPE_COUNTS.values(),
            (sum(used[1:], used[0]) + F.col("other_features")).alias("adopted_feature_count"),
        )
    )


def adoption_flags() -> dict[str, Column]:
    return {
        "has_connected_integration": F.col("integration_connected_events") > 0,
        "has_created_report": F.col("report_created_events") > 0,
    }


def account_usage(events: DataFrame, params: Params = Params(), policy: Policy = Policy()) -> DataFrame:
    """One row per account with events in the window."""
    return usage_by_account(events, params).withColumns(
        {"usage_intensity": P.usage_intensity(F.col("total_events"), policy), **adoption_flags()}
    )
