import datetime as dt
from decimal import Decimal

import pytest

from revpulse.operators import revenue, staging
from revpulse.params import Params

from conftest import by

D = Decimal


@pytest.fixture
def settled(entity):
    """Invoice summary of hand-written invoices and payments."""

    def build(invoices, payments=()):
        inv = staging.stg_invoices(entity("billing_invoices", *invoices))
        pay = staging.stg_payments(entity("billing_payments", *payments))
        return revenue.invoice_payment_summary(inv, pay)

    return build


def invoice(key, **values):
    base = {"invoice_id": key, "subscription_id": "s", "account_id": "a", "invoice_date": "2025-11-01",
            "due_date": "2025-11-16", "amount_due_usd": "100.00", "status": "open"}
    return {**base, **values}


def payment(key, of, amount, day):
    return {"payment_id": key, "invoice_id": of, "amount_paid_usd": amount, "payment_date": day}


def test_overdue_needs_a_due_date_before_the_observation_date(settled):
    rows = by(
        settled([
            invoice("before", due_date="2025-12-30"),
            invoice("on", due_date="2025-12-31"),
            invoice("after", due_date="2026-01-01"),
            invoice("unknown", due_date=None),
        ]),
        "invoice_id",
    )
    assert {k: r["is_overdue"] for k, r in rows.items()} == {
        "before": True, "on": False, "after": False, "unknown": False
    }


def test_payments_decide_the_state_whatever_the_source_said(settled):
    rows = by(
        settled(
            [
                invoice("free", amount_due_usd="0.00"),
                invoice("split"),
                invoice("late"),
                invoice("over", status="open"),
                invoice("claimed", status="paid"),
                invoice("short"),
            ],
            [
                payment("1", "split", "60.00", "2025-11-20"),
                payment("2", "split", "40.00", "2025-11-10"),
                payment("3", "late", "100.00", "2026-01-01"),
                payment("4", "over", "150.00", "2025-11-05"),
                payment("5", "short", "99.99", "2025-10-30"),
            ],
        ),
        "invoice_id",
    )
    assert {k: (r["is_paid"], r["is_open"], r["is_fully_paid"]) for k, r in rows.items()} == {
        "free": (True, False, True),
        "split": (True, False, True),
        "late": (False, True, False),
        "over": (True, False, True),
        "claimed": (False, True, False),
        "short": (False, True, False),
    }
    assert rows["split"]["payment_count"] == 2
    assert rows["split"]["days_to_payment"] == 9
    assert rows["split"]["latest_payment_date"] == dt.date(2025, 11, 20)
    assert rows["over"]["outstanding_amount_usd"] == D("-50.00")
    assert rows["late"]["total_paid_usd"] == 0 and rows["late"]["days_to_payment"] is None
    assert rows["short"]["outstanding_amount_usd"] == D("0.01") and rows["short"]["days_to_payment"] == -2


def subscriptions(entity, *rows):
    base = {"account_id": "a", "mrr_usd": "100.00", "arr_usd": "1200.00", "start_date": "2025-01-01"}
    return staging.stg_subscriptions(entity("billing_subscriptions", *({**base, **r} for r in rows)))


def test_subscription_position(entity, settled):
    subs = subscriptions(
        entity,
        {"subscription_id": "s", "status": "active"},
        {"subscription_id": "quiet", "status": "past_due"},
        {"subscription_id": "gone", "status": "canceled", "canceled_at": "2025-01-31"},
    )
    summary = settled(
        [invoice("1"), invoice("2", amount_due_usd="200.00"), invoice("3", invoice_date="2026-02-01", due_date="2026-02-16")],
        [payment("p", "1", "100.00", "2025-11-02"), payment("q", "2", "33.33", "2025-11-04")],
    )
    rows = by(revenue.subscription_settlement(subs, summary), "subscription_id")
    s = rows["s"]
    assert (s["invoice_count"], s["paid_invoice_count"], s["open_invoice_count"], s["overdue_invoice_count"]) == (3, 1, 2, 1)
    assert s["total_invoiced_usd"] == D("400.00") and s["total_outstanding_usd"] == D("266.67")
    assert s["collection_rate"] == D("0.3333") and s["avg_days_to_payment"] == D("2.00")
    assert s["has_overdue_invoice"] and s["current_mrr_usd"] == D("100.00")
    assert s["subscription_age_days"] == 364
    assert rows["quiet"]["collection_rate"] == 0 and rows["quiet"]["invoice_count"] == 0
    assert rows["quiet"]["avg_days_to_payment"] is None and rows["quiet"]["current_mrr_usd"] == D("100.00")
    assert rows["gone"]["current_mrr_usd"] == 0 and rows["gone"]["subscription_age_days"] == 30


def test_account_means_are_unweighted_and_rounded_at_both_steps(entity, settled):
    subs = subscriptions(
        entity, {"subscription_id": "s", "status": "active"}, {"subscription_id": "quiet", "status": "active"}
    )
    summary = settled(
        [invoice("1", amount_due_usd="300.00"), invoice("2", amount_due_usd="300.00"), invoice("3", amount_due_usd="300.00")],
        [payment("a", "1", "300.00", "2025-11-02"), payment("b", "2", "300.00", "2025-11-02"), payment("c", "3", "0.01", "2025-11-03")],
    )
    enriched = revenue.subscription_settlement(subs, summary)
    row = revenue.revenue_by_account(enriched).first()
    assert by(enriched, "subscription_id")["s"]["avg_days_to_payment"] == D("1.33")
    assert row.avg_days_to_payment == D("1.33")
    assert row.avg_collection_rate == D("0.3334")
    assert row.has_overdue_invoice and row.subscription_count == 2


def test_enriched_keeps_subscriptions_of_unknown_accounts(entity, settled):
    subs = subscriptions(entity, {"subscription_id": "s", "status": "active"})
    accounts = staging.stg_accounts(entity("crm_accounts", {"account_id": "other", "account_name": "x"}))
    row = revenue.subscriptions_enriched(revenue.subscription_settlement(subs, settled([])), accounts).first()
    assert row.subscription_id == "s" and row.account_name is None


def test_expected_invoices_follow_the_cycle(entity):
    subs = subscriptions(
        entity,
        {"subscription_id": "monthly", "billing_cycle": "monthly", "start_date": "2025-10-20"},
        {"subscription_id": "annual", "billing_cycle": "annual", "start_date": "2023-11-30"},
        {"subscription_id": "ended", "billing_cycle": "monthly", "start_date": "2025-01-31", "canceled_at": "2025-03-01"},
        {"subscription_id": "future", "billing_cycle": "monthly", "start_date": "2026-01-01"},
        {"subscription_id": "reversed", "billing_cycle": "monthly", "start_date": "2025-05-10", "canceled_at": "2025-03-01"},
    )
    got = {}
    for r in revenue.expected_invoice_schedule(subs, Params()).collect():
        got.setdefault(r.subscription_id, []).append((r.invoice_date.isoformat(), r.due_date.isoformat(), r.amount_due_usd))
    assert sorted(got) == ["annual", "ended", "monthly"]
    assert sorted(got["monthly"]) == [
        ("2025-10-01", "2025-10-16", D("100.00")),
        ("2025-11-01", "2025-11-16", D("100.00")),
        ("2025-12-01", "2025-12-16", D("100.00")),
    ]
    assert [d for d, _, _ in sorted(got["annual"])] == ["2023-11-01", "2024-11-01", "2025-11-01"]
    assert {a for _, _, a in got["annual"]} == {D("1200.00")}
    assert [d for d, _, _ in sorted(got["ended"])] == ["2025-01-01", "2025-02-01", "2025-03-01"]
