"""Truth tables of every rule, one row per branch and boundary."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revpulse.functions import policy as P
from revpulse.operators.customer import score_health
from revpulse.operators.marts import mart_account_360, mart_churn_risk, mart_customer_health
from revpulse.params import Policy

SIGNALS = (
    "account_lifecycle_stage string, is_current_customer boolean, contact_count bigint, "
    "executive_sponsor_count bigint, admin_contact_count bigint, past_due_subscription_count bigint, "
    "current_mrr_usd decimal(18,2), total_invoiced_usd decimal(18,2), avg_collection_rate decimal(18,4), "
    "has_overdue_invoice boolean, adopted_feature_count bigint, usage_intensity string, "
    "high_priority_tickets bigint, open_tickets bigint, support_burden_level string, has_critical_ticket boolean"
)
GOOD = {
    "account_lifecycle_stage": "active_customer",
    "is_current_customer": True,
    "contact_count": 2,
    "executive_sponsor_count": 1,
    "admin_contact_count": 1,
    "past_due_subscription_count": 0,
    "current_mrr_usd": "1000.00",
    "total_invoiced_usd": "500.00",
    "avg_collection_rate": "1.0000",
    "has_overdue_invoice": False,
    "adopted_feature_count": 6,
    "usage_intensity": "high_usage",
    "high_priority_tickets": 0,
    "open_tickets": 0,
    "support_burden_level": "low_burden",
    "has_critical_ticket": False,
}
REST = (
    "account_id account_name industry segment employee_band country account_owner total_paid_usd "
    "total_outstanding_usd avg_days_to_payment total_events active_users active_days "
    "has_connected_integration has_created_report total_tickets critical_tickets has_open_tickets"
)


@pytest.fixture
def scored(frame):
    """Score accounts that differ from a flawless one in the given columns."""

    def build(*changes):
        names = [c.split()[0] for c in SIGNALS.split(", ")]
        rows = [tuple({**GOOD, **c}[n] for n in names) for c in changes]
        return score_health(frame(SIGNALS, *rows))

    return build


def mart(scored, *changes):
    df = scored(*changes)
    filler = {n: F.lit(None).cast("string").alias(n) for n in REST.split()}
    return mart_account_360(mart_customer_health(df.select("*", *filler.values())))


def one(scored, column, **change):
    return scored(change).first()[column]


def test_flawless_account(scored):
    row = scored({}).first()
    assert (row.raw_customer_health_score, row.customer_health_score) == (100, 100)
    assert row.customer_health_segment == "healthy" and not row.is_churn_risk


@pytest.mark.parametrize(
    "counts, stage",
    [((1, 1, 1, 1), "active_customer"), ((0, 1, 1, 1), "past_due_customer"), ((0, 0, 1, 1), "churned_customer"),
     ((0, 0, 0, 1), "won_not_subscribed"), ((0, 0, 0, 0), "prospect")],
)
def test_lifecycle(spark, counts, stage):
    assert spark.range(1).select(P.lifecycle_stage(*map(F.lit, counts)).alias("s")).first().s == stage


@pytest.mark.parametrize(
    "mrr, active, past_due, expected",
    [(1, 0, 0, True), (0, 1, 0, True), (0, 0, 1, True), (0, 0, 0, False), (None, None, None, False)],
)
def test_current_customer(spark, mrr, active, past_due, expected):
    cols = [F.lit(v).cast("int") for v in (mrr, active, past_due)]
    assert spark.range(1).select(P.is_current_customer(*cols).alias("c")).first().c is expected


@pytest.mark.parametrize(
    "change, flags",
    [
        ({}, (False, False, False)),
        ({"usage_intensity": "low_usage"}, (True, False, False)),
        ({"usage_intensity": "no_usage"}, (True, False, False)),
        ({"usage_intensity": "no_usage", "is_current_customer": False}, (False, False, False)),
        ({"has_overdue_invoice": True}, (False, True, False)),
        ({"past_due_subscription_count": 1}, (False, True, False)),
        ({"avg_collection_rate": "0.8999"}, (False, True, False)),
        ({"avg_collection_rate": "0.9000"}, (False, False, False)),
        ({"avg_collection_rate": "0.0000", "total_invoiced_usd": "0.00"}, (False, False, False)),
        ({"has_critical_ticket": True}, (False, False, True)),
        ({"high_priority_tickets": 3}, (False, False, True)),
        ({"high_priority_tickets": 2, "open_tickets": 2}, (False, False, False)),
        ({"open_tickets": 3}, (False, False, True)),
    ],
)
def test_risk_flags(scored, change, flags):
    row = scored(change).first()
    assert (row.low_usage_paid_account, row.payment_risk_flag, row.support_risk_flag) == flags
    assert row.is_churn_risk == any(flags)


@pytest.mark.parametrize("label, points", [("high_usage", 35), ("medium_usage", 25), ("low_usage", 8), ("no_usage", 0)])
def test_usage_points(scored, label, points):
    assert one(scored, "usage_score", usage_intensity=label) == points


@pytest.mark.parametrize("n, points", [(0, 0), (1, 5), (2, 5), (3, 12), (4, 12), (5, 20), (6, 20)])
def test_adoption_points(scored, n, points):
    assert one(scored, "adoption_score", adopted_feature_count=n) == points


@pytest.mark.parametrize(
    "change, points",
    [
        ({"is_current_customer": False}, 0),
        ({"has_overdue_invoice": True, "past_due_subscription_count": 1}, 0),
        ({"past_due_subscription_count": 1}, 5),
        ({"total_invoiced_usd": "0.00", "avg_collection_rate": "0.0000"}, 18),
        ({"avg_collection_rate": "0.9800"}, 25),
        ({"avg_collection_rate": "0.9799"}, 18),
        ({"avg_collection_rate": "0.9000"}, 18),
        ({"avg_collection_rate": "0.8999"}, 10),
        ({"avg_collection_rate": "0.7500"}, 10),
        ({"avg_collection_rate": "0.7499"}, 5),
        ({"avg_collection_rate": "0.0001"}, 5),
        ({"avg_collection_rate": "0.0000"}, 0),
    ],
)
def test_payment_points(scored, change, points):
    assert one(scored, "payment_score", **change) == points


@pytest.mark.parametrize(
    "change, points",
    [
        ({"has_critical_ticket": True, "high_priority_tickets": 9}, 0),
        ({"high_priority_tickets": 3, "open_tickets": 9}, 3),
        ({"open_tickets": 3, "support_burden_level": "high_burden"}, 6),
        ({"support_burden_level": "high_burden"}, 8),
        ({"support_burden_level": "medium_burden"}, 11),
        ({"support_burden_level": "low_burden"}, 15),
        ({"support_burden_level": "no_burden"}, 15),
    ],
)
def test_support_points(scored, change, points):
    assert one(scored, "support_score", **change) == points


@pytest.mark.parametrize("contacts, points", [((3, 1, 1), 5), ((3, 1, 0), 3), ((3, 0, 1), 3), ((3, 0, 0), 1), ((0, 0, 0), 0)])
def test_relationship_points(scored, contacts, points):
    total, sponsors, admins = contacts
    change = {"contact_count": total, "executive_sponsor_count": sponsors, "admin_contact_count": admins}
    assert one(scored, "relationship_score", **change) == points


@pytest.mark.parametrize(
    "change, raw, score",
    [
        ({"is_current_customer": False, "account_lifecycle_stage": "prospect", "has_critical_ticket": True}, 60, 60),
        ({"is_current_customer": False, "account_lifecycle_stage": "won_not_subscribed"}, 75, 75),
        ({"is_current_customer": False, "account_lifecycle_stage": "churned_customer"}, 75, 20),
        ({"account_lifecycle_stage": "churned_customer", "usage_intensity": "no_usage", "adopted_feature_count": 0,
          "has_overdue_invoice": True, "has_critical_ticket": True}, 5, 5),
        ({"has_critical_ticket": True}, 85, 49),
        ({"has_overdue_invoice": True}, 75, 49),
        ({"past_due_subscription_count": 1}, 80, 64),
        ({"open_tickets": 3}, 91, 64),
        ({"usage_intensity": "low_usage"}, 73, 64),
        ({"usage_intensity": "no_usage", "adopted_feature_count": 0}, 45, 45),
    ],
)
def test_caps(scored, change, raw, score):
    row = scored(change).first()
    assert (row.raw_customer_health_score, row.customer_health_score) == (raw, score)


@pytest.mark.parametrize(
    "score, segment",
    [(100, "healthy"), (80, "healthy"), (79, "watch"), (60, "watch"), (59, "at_risk"), (35, "at_risk"), (34, "critical"), (0, "critical")],
)
def test_segment_bounds(frame, score, segment):
    df = frame("customer_health_score int, is_current_customer boolean, account_lifecycle_stage string", (score, True, "active_customer"))
    assert df.select(P.health_segment().alias("s")).first().s == segment


@pytest.mark.parametrize(
    "current, stage, segment, risk",
    [(False, "prospect", "not_customer", False), (False, "won_not_subscribed", "not_customer", False),
     (False, "churned_customer", "critical", True), (True, "churned_customer", "critical", True)],
)
def test_segment_outside_the_score(scored, current, stage, segment, risk):
    row = scored({"is_current_customer": current, "account_lifecycle_stage": stage}).first()
    assert (row.customer_health_segment, row.is_churn_risk) == (segment, risk)


def test_low_score_without_a_flag_is_not_churn_risk(scored):
    row = scored(
        {"usage_intensity": "medium_usage", "adopted_feature_count": 0, "avg_collection_rate": "0.0000",
         "total_invoiced_usd": "0.00", "contact_count": 0, "executive_sponsor_count": 0, "admin_contact_count": 0}
    ).first()
    assert row.customer_health_score == 58 and row.customer_health_segment == "at_risk" and not row.is_churn_risk


VIEW = (
    "customer_health_segment string, is_current_customer boolean, account_lifecycle_stage string, "
    "current_mrr_usd decimal(18,2), is_churn_risk boolean"
)


def seen(frame, column, segment, mrr="0.00", current=True, stage="active_customer", risk=True):
    return frame(VIEW, (segment, current, stage, mrr, risk)).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "segment, advice, rank",
    [("healthy", "Maintain and expand", 4), ("watch", "Monitor and drive adoption", 3), ("at_risk", "Prioritize intervention", 2),
     ("critical", "Escalate immediately", 1), ("not_customer", "Exclude from customer health motion", 5), (None, "Review", 5)],
)
def test_advice(frame, segment, advice, rank):
    assert seen(frame, P.recommended_action(), segment) == advice
    assert seen(frame, P.health_priority_rank(), segment) == rank


@pytest.mark.parametrize(
    "current, stage, group",
    [(True, "churned_customer", "Customer"), (False, "won_not_subscribed", "Won - Not Subscribed"), (False, "prospect", "Prospect"),
     (False, "churned_customer", "Churned Customer"), (False, "active_customer", "Other")],
)
def test_status_group(frame, current, stage, group):
    assert seen(frame, P.account_status_group(), "watch", current=current, stage=stage) == group


@pytest.mark.parametrize(
    "mrr, current, tier",
    [("10000.00", True, "high_value"), ("9999.99", True, "mid_value"), ("5000.00", True, "mid_value"), ("4999.99", True, "low_value"),
     ("0.01", True, "low_value"), ("0.00", True, "unknown"), ("20000.00", False, "non_customer")],
)
def test_tiers(frame, mrr, current, tier):
    assert seen(frame, P.revenue_tier(), "watch", mrr=mrr, current=current) == tier


@pytest.mark.parametrize(
    "segment, mrr, current, stage, action",
    [
        ("critical", "9000.00", False, "churned_customer", "Churned - winback review"),
        ("not_customer", "9000.00", False, "prospect", "No customer action"),
        ("critical", "5000.00", True, "active_customer", "P1 - Executive escalation"),
        ("critical", "4999.99", True, "active_customer", "P2 - Immediate CS escalation"),
        ("at_risk", "5000.00", True, "active_customer", "P2 - High-value rescue plan"),
        ("at_risk", "4999.99", True, "active_customer", "P3 - CS intervention"),
        ("watch", "90000.00", True, "active_customer", "P4 - Adoption playbook"),
        ("healthy", "5000.00", True, "active_customer", "Expansion candidate"),
        ("healthy", "4999.99", True, "active_customer", "Maintain"),
        ("not_customer", "1.00", True, "active_customer", "Review"),
    ],
)
def test_priority_action(frame, segment, mrr, current, stage, action):
    assert seen(frame, P.account_priority_action(), segment, mrr, current, stage) == action


@pytest.mark.parametrize(
    "segment, mrr, current, stage, priority, rank",
    [
        ("critical", "5000.00", True, "active_customer", "P1", 1),
        ("critical", "4999.99", True, "active_customer", "P2", 1),
        ("at_risk", "5000.00", True, "active_customer", "P2", 2),
        ("at_risk", "4999.99", True, "active_customer", "P3", 3),
        ("watch", "10000.00", True, "active_customer", "P3", 4),
        ("watch", "9999.99", True, "active_customer", "P4", 5),
        ("critical", "0.00", False, "churned_customer", "P5", 6),
        ("healthy", "0.00", True, "active_customer", "P5", 7),
    ],
)
def test_risk_priority(frame, segment, mrr, current, stage, priority, rank):
    assert seen(frame, P.risk_priority(), segment, mrr, current, stage) == priority
    assert seen(frame, P.risk_priority_rank(), segment, mrr, current, stage) == rank


EVIDENCE = (
    "account_lifecycle_stage string, has_overdue_invoice boolean, has_critical_ticket boolean, "
    "payment_risk_flag boolean, support_risk_flag boolean, low_usage_paid_account boolean"
)


@pytest.mark.parametrize(
    "first, reason, playbook",
    [(0, "churned_customer", "closed_loss_or_churn_review"), (1, "overdue_invoice", "finance_collection_and_cs_outreach"),
     (2, "critical_support_ticket", "support_escalation"), (3, "payment_risk", "payment_follow_up"),
     (4, "support_risk", "support_follow_up"), (5, "low_product_usage", "adoption_intervention"), (6, "general_risk", "manual_review")],
)
def test_reason_is_the_weightiest_evidence(frame, first, reason, playbook):
    stage = "churned_customer" if first == 0 else "active_customer"
    df = frame(EVIDENCE, (stage, *(i >= first for i in range(1, 6))))
    row = df.select(P.primary_risk_reason().alias("r"), P.risk_playbook().alias("p")).first()
    assert (row.r, row.p) == (reason, playbook)


def test_mrr_split(scored):
    rows = mart(
        scored,
        {},
        {"past_due_subscription_count": 1},
        {"is_current_customer": False, "account_lifecycle_stage": "churned_customer"},
    ).select("customer_health_segment", "mrr_at_risk_usd", "healthy_mrr_usd", "non_healthy_mrr_usd").collect()
    k, z = Decimal("1000.00"), Decimal("0.00")
    assert [tuple(r) for r in rows] == [("healthy", z, k, z), ("watch", k, z, k), ("critical", z, z, z)]


def test_risk_mart_holds_flagged_accounts_only(scored):
    df = mart_churn_risk(mart(scored, {}, {"open_tickets": 3}))
    assert [r.primary_risk_reason for r in df.collect()] == ["support_risk"]


def test_thresholds_can_be_changed(frame):
    strict = Policy(segment_bands=((95, "healthy"), (60, "watch"), (35, "at_risk")), mid_value_mrr=100)
    assert seen(frame, P.revenue_tier(strict), "watch", mrr="150.00") == "mid_value"
    df = frame("customer_health_score int, is_current_customer boolean, account_lifecycle_stage string", (90, True, "active_customer"))
    assert df.select(P.health_segment(strict).alias("s")).first().s == "watch"
