import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revpulse.operators import staging
from revpulse.params import Params

from conftest import by


def ticket(entity, **values):
    base = {"ticket_id": "t", "account_id": "a", "severity": "low", "created_at": "2025-06-01T00:00:00"}
    return staging.stg_tickets(entity("support_tickets", {**base, **values})).first()


@pytest.mark.parametrize(
    "status, resolved, expected",
    [
        ("open", None, (False, True)),
        ("pending", None, (False, True)),
        ("resolved", "2025-06-05T00:00:00", (True, False)),
        ("closed", "2025-12-31T23:00:00", (True, False)),
        ("resolved", "2026-01-01T00:00:00", (False, True)),
        ("resolved", None, (False, False)),
        (None, None, (False, False)),
    ],
)
def test_ticket_state_at_the_observation_date(entity, status, resolved, expected):
    row = ticket(entity, status=status, resolved_at=resolved)
    assert (row.is_resolved, row.is_open) == expected


def test_ticket_created_later_is_not_open(entity):
    row = ticket(entity, status="open", created_at="2026-01-01T00:00:00")
    assert not row.is_open


@pytest.mark.parametrize("hours, days", [(47, 1), (48, 2), (23, 0), (-47, -1), (-48, -2), (0, 0)])
def test_resolution_days_truncate_toward_zero(entity, hours, days):
    start = dt.datetime(2025, 6, 10)
    end = (start + dt.timedelta(hours=hours)).isoformat()
    row = ticket(entity, status="resolved", created_at=start.isoformat(), resolved_at=end)
    assert row.resolution_days == days


def test_high_priority_covers_two_severities(entity):
    levels = {s: ticket(entity, severity=s).is_high_priority for s in ("low", "medium", "high", "critical")}
    assert levels == {"low": False, "medium": False, "high": True, "critical": True}


def test_subscription_flags_and_renames(entity):
    df = staging.stg_subscriptions(
        entity(
            "billing_subscriptions",
            {"subscription_id": "1", "status": "active", "mrr_usd": "10.50", "start_date": "2025-01-01"},
            {"subscription_id": "2", "status": "canceled", "canceled_at": "2025-02-01"},
            {"subscription_id": "3", "status": "past_due"},
            {"subscription_id": "4", "status": "paused"},
        )
    )
    rows = by(df, "subscription_id")
    flags = {k: (r["is_active"], r["is_canceled"], r["is_past_due"]) for k, r in rows.items()}
    assert flags == {
        "1": (True, False, False),
        "2": (False, True, False),
        "3": (False, False, True),
        "4": (False, False, False),
    }
    assert rows["1"]["subscription_status"] == "active" and "status" not in rows["1"]
    assert rows["1"]["mrr_usd"] == Decimal("10.50")


def test_text_sources_are_cast_and_empty_dates_are_missing(spark):
    raw = spark.createDataFrame(
        [("d1", "a", "n", "p", "closed_won", "1200.5", "100.045", "Growth", "2025-01-02", ""),
         ("d2", "a", "n", "p", "closed_won", "1", "2", "Growth", "2025-01-02", "2025-03-04")],
        "deal_id string, account_id string, deal_name string, pipeline string, deal_stage string, "
        "deal_amount_usd string, expected_mrr_usd string, plan string, created_at string, close_date string",
    )
    rows = by(staging.stg_deals(raw), "deal_id")
    assert rows["d1"]["close_date"] is None
    assert rows["d2"]["close_date"] == dt.date(2025, 3, 4)
    assert rows["d1"]["deal_amount_usd"] == Decimal("1200.50")
    assert rows["d1"]["expected_mrr_usd"] == Decimal("100.05")


def test_event_date_follows_the_timestamp(entity):
    row = staging.stg_events(
        entity("product_events", {"event_id": "e", "occurred_at": "2025-03-04T23:59:59"})
    ).first()
    assert row.event_date == dt.date(2025, 3, 4)


def test_window_filter_reaches_the_scan(spark, entity, tmp_path):
    from revpulse.operators.product import events_in_window

    path = str(tmp_path / "events")
    entity("product_events", {"event_id": "e", "occurred_at": "2025-03-04T00:00:00"}).write.parquet(path)
    df = events_in_window(staging.stg_events(spark.read.parquet(path)), Params())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(occurred_at,2025-10-03" in plan


def test_other_entities_keep_their_columns(entity):
    assert staging.stg_contacts(entity("crm_contacts", {"contact_id": "c"})).columns[4] == "contact_role"
    assert "account_owner" in staging.stg_accounts(entity("crm_accounts", {"account_id": "a"})).columns
    assert staging.stg_payments(entity("billing_payments", {"payment_id": "p"})).count() == 1
    paid = staging.stg_invoices(entity("billing_invoices", {"invoice_id": "i", "status": "paid"})).first()
    assert (paid.is_paid, paid.is_open, paid.invoice_status) == (True, False, "paid")
    assert staging.stg_billing_customers(entity("billing_customers", {"billing_customer_id": "b"})).where(
        F.col("billing_customer_id") == "b"
    ).count() == 1
