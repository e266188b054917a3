import datetime as dt
from decimal import Decimal

from revpulse.operators import customer, marts, staging
from revpulse.plans.relations import Warehouse
from revpulse.schemas import ENTITIES

from conftest import by


def warehouse(entity, **rows):
    return Warehouse({e: entity(e, *rows.get(e, ())) for e in ENTITIES})


def sub(key, account, status="active", mrr="100.00", **more):
    return {"subscription_id": key, "account_id": account, "status": status, "mrr_usd": mrr, "arr_usd": mrr,
            "start_date": "2025-01-01", "plan": "Growth", "billing_cycle": "monthly", **more}


def test_account_base_folds_children_before_joining(entity):
    w = warehouse(
        entity,
        crm_accounts=[{"account_id": k, "account_name": k} for k in ("full", "bare", "won", "split")],
        crm_contacts=[
            {"contact_id": "1", "account_id": "full", "role": "Executive Sponsor"},
            {"contact_id": "2", "account_id": "full", "role": "Admin"},
            {"contact_id": "3", "account_id": "full", "role": "Analyst"},
        ],
        crm_deals=[
            {"deal_id": "1", "account_id": "full", "deal_stage": "closed_won", "deal_amount_usd": "10.00",
             "expected_mrr_usd": "1.00", "created_at": "2025-02-01", "close_date": "2025-03-01"},
            {"deal_id": "2", "account_id": "full", "deal_stage": "closed_lost", "deal_amount_usd": "99.00",
             "expected_mrr_usd": "9.00", "created_at": "2025-01-01", "close_date": "2025-04-01"},
            {"deal_id": "3", "account_id": "won", "deal_stage": "closed_won"},
        ],
        billing_customers=[
            {"billing_customer_id": "b1", "account_id": "full"},
            {"billing_customer_id": "b2", "account_id": "split"},
            {"billing_customer_id": "b3", "account_id": "split"},
        ],
        billing_subscriptions=[
            sub("s1", "full", "past_due", "5.00"),
            sub("s2", "full", "canceled", "7.00", canceled_at="2025-06-01"),
        ],
    )
    base = w["int_customer__account_base"]
    rows = by(base, "account_id")
    full = rows["full"]
    assert (full["contact_count"], full["executive_sponsor_count"], full["admin_contact_count"]) == (3, 1, 1)
    assert (full["total_deals"], full["won_deals"], full["lost_deals"]) == (2, 1, 1)
    assert full["won_deal_amount_usd"] == Decimal("10.00") and full["won_expected_mrr_usd"] == Decimal("1.00")
    assert full["first_deal_created_at"] == dt.date(2025, 1, 1) and full["latest_won_close_date"] == dt.date(2025, 3, 1)
    assert full["current_mrr_usd"] == Decimal("5.00") and full["subscription_count"] == 2
    assert full["latest_canceled_at"] == dt.date(2025, 6, 1)
    assert {k: r["account_lifecycle_stage"] for k, r in rows.items()} == {
        "full": "past_due_customer", "bare": "prospect", "won": "won_not_subscribed", "split": "prospect"
    }
    assert rows["bare"]["contact_count"] == 0 and rows["bare"]["won_deal_amount_usd"] == 0
    # Two billing customers of one account stay two rows; the uniqueness contract reports them.
    assert base.count() == 5


def test_billing_customers_join_like_a_left_join(frame):
    rows = [("hot", f"b{i}") for i in range(200)] + [("one", "b"), ("lost", "x"), (None, "y"), ("blank", None)]
    billing = frame("account_id string, billing_customer_id string", *rows)
    accounts = frame("account_id string, name string", ("hot", "h"), ("one", "o"), ("none", "n"), ("blank", "b"))
    got = customer.with_billing_customers(accounts, billing)
    plain = accounts.join(billing, "account_id", "left")
    assert sorted(map(str, got.select(plain.columns).collect())) == sorted(map(str, plain.collect()))
    assert got.count() == 203


def test_unknown_status_counts_as_revenue_in_the_base_only(entity):
    w = warehouse(entity, crm_accounts=[{"account_id": "a"}], billing_subscriptions=[sub("s", "a", "paused", "5.00")])
    assert w["int_customer__account_base"].first().current_mrr_usd == Decimal("5.00")
    health = w["int_customer__health_signals"].first()
    assert health.current_mrr_usd == 0 and not health.is_current_customer


def test_absent_facts_become_zero_labels(entity):
    w = warehouse(entity, crm_accounts=[{"account_id": "a"}])
    row = w["int_customer__health_signals"].first()
    assert (row.usage_intensity, row.support_burden_level) == ("no_usage", "no_burden")
    assert row.avg_collection_rate == 0 and row.avg_days_to_payment is None
    assert row.total_events == 0 and row.total_tickets == 0 and not row.has_overdue_invoice
    assert row.customer_health_segment == "not_customer"


def test_stored_relation_feeds_what_comes_later(entity):
    w = warehouse(entity, crm_accounts=[{"account_id": "a"}], billing_subscriptions=[sub("s", "a")])
    direct = w["int_customer__health_signals"].collect()
    w.store("int_revenue__subscriptions_enriched", w["int_revenue__subscriptions_enriched"].cache())
    assert w["int_customer__health_signals"].collect() == direct


M360 = (
    "is_current_customer boolean, customer_health_segment string, revenue_tier string, account_priority_action string, "
    "usage_intensity string, support_burden_level string, is_churn_risk boolean, current_mrr_usd decimal(18,2), "
    "mrr_at_risk_usd decimal(18,2), healthy_mrr_usd decimal(18,2), non_healthy_mrr_usd decimal(18,2), "
    "customer_health_score int, raw_customer_health_score int, total_events bigint, active_users bigint, "
    "active_days bigint, adopted_feature_count bigint, has_connected_integration boolean, has_created_report boolean, "
    "low_usage_paid_account boolean, total_tickets bigint, open_tickets bigint, high_priority_tickets bigint, "
    "critical_tickets bigint, has_open_tickets boolean, has_critical_ticket boolean, support_risk_flag boolean"
)


def account(current=True, risk=False, mrr="100.00", score=50, events=10, opened=0):
    at_risk = mrr if risk else "0.00"
    return (current, "watch", "low_value", "P4 - Adoption playbook", "low_usage", "low_burden", risk, mrr, at_risk, "0.00",
            mrr, score, score, events, 2, 3, 1, risk, False, risk, 3, opened, 0, 0, opened > 0, False, risk)


def test_rollups(frame):
    df = frame(M360, account(), account(risk=True, mrr="50.00", score=51, events=11, opened=2), account(risk=True, mrr="150.01", events=12),
               account(current=False, mrr="9999.00"))
    kept = marts.mart_revenue_retention(df).first()
    assert (kept.customer_count, kept.churn_risk_customer_count) == (3, 2)
    assert kept.current_mrr_usd == Decimal("300.01") and kept.mrr_at_risk_usd == Decimal("200.01")
    assert kept.mrr_at_risk_rate == Decimal("0.6667") and kept.customer_risk_rate == Decimal("0.6667")
    assert kept.avg_customer_health_score == Decimal("50.33")
    use = marts.mart_product_adoption(df).first()
    assert (use.total_events, use.active_users, use.active_days) == (33, 6, 9)
    assert use.avg_events_per_account == Decimal("11.00") and use.integration_adoption_rate == Decimal("0.6667")
    assert use.report_creation_rate == 0 and use.low_usage_paid_accounts == 2
    load = marts.mart_support_operations(df).first()
    assert (load.total_tickets, load.open_tickets, load.accounts_with_open_tickets) == (9, 2, 1)
    assert load.avg_open_tickets_per_account == Decimal("0.67") and load.open_ticket_account_rate == Decimal("0.3333")


def test_rate_of_a_group_without_revenue_is_zero(frame):
    assert marts.mart_revenue_retention(frame(M360, account(mrr="0.00"))).first().mrr_at_risk_rate == 0
