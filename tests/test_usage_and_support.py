import datetime as dt
import random
from decimal import Decimal

import pytest

from revpulse.operators import product, staging, support
from revpulse.params import Params

from conftest import by

AS_OF = dt.date(2025, 12, 31)


def events(entity, *rows):
    named = ({"event_id": str(i), "account_id": a, "user_id": u, "event_type": t, "occurred_at": f"{d}T12:00:00"} for i, (a, u, t, d) in enumerate(rows))
    return staging.stg_events(entity("product_events", *named))


def test_window_is_inclusive_on_both_ends(entity):
    days = {"first": 89, "early": 90, "last": 0, "late": -1}
    df = events(entity, *((k, "u", "login", (AS_OF - dt.timedelta(days=n)).isoformat()) for k, n in days.items()))
    assert set(by(product.account_usage(df), "account_id")) == {"first", "last"}


@pytest.mark.parametrize("window", [1, 30, 62, 63, 90, 124, 200])
def test_counts_match_brute_force(entity, window):
    rng = random.Random(window)
    kinds = [*product.EVENT_TYPES, "beta_feature", "gamma_feature", None]
    rows = [
        (
            rng.choice("abc"),
            rng.choice(["u1", "u2", "u3", None]),
            rng.choice(kinds),
            (AS_OF - dt.timedelta(days=rng.randrange(-3, window + 5))).isoformat(),
        )
        for _ in range(400)
    ]
    params = Params(usage_window_days=window)
    got = by(product.usage_by_account(events(entity, *rows), params), "account_id")
    for account in "abc":
        inside = [r for r in rows if r[0] == account and params.window_start <= dt.date.fromisoformat(r[3]) <= AS_OF]
        if not inside:
            assert account not in got
            continue
        row = got[account]
        assert row["total_events"] == len(inside)
        assert row["active_users"] == len({r[1] for r in inside} - {None})
        assert row["active_days"] == len({r[3] for r in inside})
        assert row["adopted_feature_count"] == len({r[2] for r in inside} - {None})
        assert row["first_event_date"].isoformat() == min(r[3] for r in inside)
        assert row["latest_event_date"].isoformat() == max(r[3] for r in inside)
        assert row["dashboard_view_events"] == sum(r[2] == "dashboard_viewed" for r in inside)


@pytest.mark.parametrize("n, label", [(1, "low_usage"), (149, "low_usage"), (150, "medium_usage"), (499, "medium_usage"), (500, "high_usage")])
def test_intensity_bounds(entity, n, label):
    df = events(entity, *(("a", "u", "login", "2025-12-01") for _ in range(n)))
    assert product.account_usage(df).first().usage_intensity == label


def test_adoption_flags(entity):
    df = events(entity, ("a", "u", "integration_connected", "2025-12-01"), ("b", "u", "report_created", "2025-12-01"))
    rows = by(product.account_usage(df), "account_id")
    assert [rows[k]["has_connected_integration"] for k in "ab"] == [True, False]
    assert [rows[k]["has_created_report"] for k in "ab"] == [False, True]


def test_an_account_with_most_rows_is_spread_over_tasks(spark, entity):
    """Rows of a busy account shuffle by account and user, not by account alone."""
    df = product.usage_by_account(events(entity, ("a", "u", "login", "2025-12-01")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Scan") == 1
    assert "Exchange hashpartitioning(account_id" in plan and ", slot" in plan


def tickets(entity, *rows):
    base = {"account_id": "a", "status": "open", "severity": "low", "created_at": "2025-06-01T00:00:00"}
    return staging.stg_tickets(entity("support_tickets", *({**base, "ticket_id": str(i), **r} for i, r in enumerate(rows))))


@pytest.mark.parametrize(
    "total, priority, level",
    [(1, 0, "low_burden"), (3, 0, "low_burden"), (4, 0, "medium_burden"), (7, 0, "medium_burden"), (8, 0, "high_burden"),
     (1, 1, "medium_burden"), (2, 2, "medium_burden"), (3, 3, "high_burden")],
)
def test_burden_bounds(entity, total, priority, level):
    rows = [{"severity": "high" if i < priority else "low"} for i in range(total)]
    assert support.account_ticket_summary(tickets(entity, *rows)).first().support_burden_level == level


def test_ticket_counts(entity):
    done = {"status": "resolved", "resolved_at": "2025-06-03T12:00:00"}
    df = tickets(
        entity,
        {"severity": "critical"},
        {"severity": "critical", **done},
        {"severity": "high", "status": "pending"},
        {"severity": "high", "status": "resolved", "resolved_at": "2026-02-01T00:00:00"},
        {"severity": "medium", "status": "closed"},
        {"created_at": "2026-01-01T00:00:00"},
    )
    row = support.account_ticket_summary(df).first()
    assert (row.total_tickets, row.open_tickets, row.resolved_tickets) == (5, 3, 1)
    assert (row.high_priority_tickets, row.critical_tickets, row.high_tickets, row.medium_tickets, row.low_tickets) == (3, 1, 2, 1, 0)
    assert row.has_open_tickets and row.has_critical_ticket
    # The later resolution counts although it lies past the observation date: (2 + 245) / 2.
    assert row.avg_resolution_days == Decimal("123.50")
    assert (row.first_ticket_date, row.latest_ticket_date) == (dt.date(2025, 6, 1), dt.date(2025, 6, 1))


def test_accounts_without_tickets_by_the_date_are_absent(entity):
    assert support.account_ticket_summary(tickets(entity, {"created_at": "2026-01-01T00:00:00"})).count() == 0
