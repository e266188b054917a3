"""The lifecycle, scoring, risk and playbook policy as pure column expressions.

Every function reads columns by name and takes its thresholds from ``Policy``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from revpulse.functions.ladders import banded, first_match, flag
from revpulse.functions.numeric import money, rate
from revpulse.params import Policy

c = F.col
DEFAULT = Policy()


def _customer_in(*segments) -> Column:
    return c("is_current_customer") & c("customer_health_segment").isin(*segments)


def _departed() -> Column:
    return ~c("is_current_customer") & (c("account_lifecycle_stage") == "churned_customer")


def _never_customer() -> Column:
    return ~c("is_current_customer") & c("account_lifecycle_stage").isin("prospect", "won_not_subscribed")


def lifecycle_stage(active: Column, past_due: Column, canceled: Column, won: Column) -> Column:
    # Strongest evidence first.
    return first_match(
        [
            (active > 0, "active_customer"),
            (past_due > 0, "past_due_customer"),
            (canceled > 0, "churned_customer"),
            (won > 0, "won_not_subscribed"),
        ],
        "prospect",
    )


def usage_intensity(total_events: Column, policy: Policy = DEFAULT) -> Column:
    return banded(total_events, policy.usage_bands, policy.no_usage)


def support_burden(total: Column, open_priority: Column, policy: Policy = DEFAULT) -> Column:
    by_priority = dict((label, bound) for bound, label in policy.burden_priority)
    rules = []
    for bound, label in policy.burden_tickets:
        reached = total >= bound
        if label in by_priority:
            reached = reached | (open_priority >= by_priority[label])
        rules.append((reached, label))
    return first_match(rules, policy.no_burden)


def is_current_customer(mrr: Column, active: Column, past_due: Column) -> Column:
    return flag((mrr > 0) | (active > 0) | (past_due > 0))


def risk_flags(policy: Policy = DEFAULT) -> dict[str, Column]:
    low_labels = [policy.no_usage, policy.low_usage]
    under_collected = (c("total_invoiced_usd") > 0) & (
        c("avg_collection_rate") < F.lit(policy.collection_risk_below)
    )
    return {
        "low_usage_paid_account": flag(c("is_current_customer") & c("usage_intensity").isin(low_labels)),
        "payment_risk_flag": flag(
            c("has_overdue_invoice") | (c("past_due_subscription_count") > 0) | under_collected
        ),
        "support_risk_flag": flag(
            c("has_critical_ticket")
            | (c("high_priority_tickets") >= policy.priority_ticket_risk)
            | (c("open_tickets") >= policy.open_ticket_risk)
        ),
    }


def component_scores(policy: Policy = DEFAULT) -> dict[str, Column]:
    support = dict(policy.support_points)
    contact = dict(policy.relationship_points)
    sponsor, admin = c("executive_sponsor_count") > 0, c("admin_contact_count") > 0
    paid_share = c("avg_collection_rate")
    return {
        "usage_score": first_match(
            [(c("usage_intensity") == label, points) for label, points in policy.usage_points], 0
        ),
        "adoption_score": banded(c("adopted_feature_count"), policy.adoption_points, 0),
        "payment_score": first_match(
            [
                (~c("is_current_customer") | c("has_overdue_invoice"), 0),
                (c("past_due_subscription_count") > 0, policy.past_due_points),
                (c("total_invoiced_usd") == 0, policy.uninvoiced_points),
            ],
            banded(
                paid_share,
                policy.collection_points,
                F.when(paid_share > 0, policy.partial_collection_points).otherwise(0),
            ),
        ),
        "support_score": first_match(
            [
                (c("has_critical_ticket"), 0),
                (c("high_priority_tickets") >= policy.priority_ticket_risk, support["priority"]),
                (c("open_tickets") >= policy.open_ticket_risk, support["open"]),
                *(
                    (c("support_burden_level") == level, support[level])
                    for level in ("high_burden", "medium_burden")
                ),
            ],
            policy.support_clear_points,
        ),
        "relationship_score": first_match(
            [
                (sponsor & admin, contact["both"]),
                (sponsor | admin, contact["either"]),
                (c("contact_count") > 0, contact["any"]),
            ],
            0,
        ),
    }


SCORE_PARTS = ("usage_score", "adoption_score", "payment_score", "support_score", "relationship_score")


def raw_health_score() -> Column:
    total = c(SCORE_PARTS[0])
    for part in SCORE_PARTS[1:]:
        total = total + c(part)
    return total


def health_score(policy: Policy = DEFAULT) -> Column:
    """The raw score lowered to the cap of the first condition that holds."""
    raw = c("raw_customer_health_score")
    any_flag = c("payment_risk_flag") | c("support_risk_flag") | c("low_usage_paid_account")
    no_cap = F.lit(None).cast("int")
    cap = first_match(
        [
            (_never_customer(), no_cap),
            (c("account_lifecycle_stage") == "churned_customer", policy.churned_cap),
            (c("has_critical_ticket") | c("has_overdue_invoice"), policy.severe_cap),
            (any_flag, policy.flagged_cap),
        ],
        no_cap,
    )
    return F.least(raw, cap)


def health_segment(policy: Policy = DEFAULT) -> Column:
    return first_match(
        [
            (_never_customer(), "not_customer"),
            (c("account_lifecycle_stage") == "churned_customer", "critical"),
        ],
        banded(c("customer_health_score"), policy.segment_bands, "critical"),
    )


def is_churn_risk() -> Column:
    any_flag = c("payment_risk_flag") | c("support_risk_flag") | c("low_usage_paid_account")
    return flag(~_never_customer() & ((c("account_lifecycle_stage") == "churned_customer") | any_flag))


# Segment, advice shown to the account team, and queue rank.
SEGMENT_ADVICE = {
    "critical": ("Escalate immediately", 1),
    "at_risk": ("Prioritize intervention", 2),
    "watch": ("Monitor and drive adoption", 3),
    "healthy": ("Maintain and expand", 4),
    "not_customer": ("Exclude from customer health motion", 5),
}


def recommended_action() -> Column:
    seg = c("customer_health_segment")
    return first_match([(seg == s, advice) for s, (advice, _) in SEGMENT_ADVICE.items()], "Review")


def health_priority_rank() -> Column:
    seg = c("customer_health_segment")
    return first_match([(seg == s, rank) for s, (_, rank) in SEGMENT_ADVICE.items()], 5)


def account_status_group() -> Column:
    # Label shown for accounts that are not current customers.
    labels = {
        "won_not_subscribed": "Won - Not Subscribed",
        "prospect": "Prospect",
        "churned_customer": "Churned Customer",
    }
    stage = c("account_lifecycle_stage")
    return first_match(
        [(c("is_current_customer"), "Customer"), *((stage == s, text) for s, text in labels.items())],
        "Other",
    )


def mrr_where(condition: Column) -> Column:
    return money(F.when(condition, c("current_mrr_usd")).otherwise(F.lit(0)))


def mrr_at_risk() -> Column:
    return mrr_where(c("is_current_customer") & c("is_churn_risk"))


def healthy_mrr() -> Column:
    return mrr_where(_customer_in("healthy"))


def non_healthy_mrr() -> Column:
    return mrr_where(_customer_in("watch", "at_risk", "critical"))


def revenue_tier(policy: Policy = DEFAULT) -> Column:
    mrr = c("current_mrr_usd")
    return F.when(~c("is_current_customer"), "non_customer").otherwise(
        first_match(
            [
                (mrr >= policy.high_value_mrr, "high_value"),
                (mrr >= policy.mid_value_mrr, "mid_value"),
                (mrr > 0, "low_value"),
            ],
            "unknown",
        )
    )


def account_priority_action(policy: Policy = DEFAULT) -> Column:
    # Action for a segment, first with MRR at or above the mid tier, then below it.
    actions = {
        "critical": ("P1 - Executive escalation", "P2 - Immediate CS escalation"),
        "at_risk": ("P2 - High-value rescue plan", "P3 - CS intervention"),
        "watch": ("P4 - Adoption playbook", "P4 - Adoption playbook"),
        "healthy": ("Expansion candidate", "Maintain"),
    }
    sizeable = c("current_mrr_usd") >= policy.mid_value_mrr
    rules = [(_departed(), "Churned - winback review"), (~c("is_current_customer"), "No customer action")]
    for segment, (large, small) in actions.items():
        rules.append((c("customer_health_segment") == segment, F.when(sizeable, large).otherwise(small)))
    return first_match(rules, "Review")


def _risk_evidence():
    # Evidence in order of weight, with the reason and the playbook it leads to.
    return [
        (c("account_lifecycle_stage") == "churned_customer", "churned_customer", "closed_loss_or_churn_review"),
        (c("has_overdue_invoice"), "overdue_invoice", "finance_collection_and_cs_outreach"),
        (c("has_critical_ticket"), "critical_support_ticket", "support_escalation"),
        (c("payment_risk_flag"), "payment_risk", "payment_follow_up"),
        (c("support_risk_flag"), "support_risk", "support_follow_up"),
        (c("low_usage_paid_account"), "low_product_usage", "adoption_intervention"),
    ]


def primary_risk_reason() -> Column:
    return first_match([(when, reason) for when, reason, _ in _risk_evidence()], "general_risk")


def risk_playbook() -> Column:
    return first_match([(when, play) for when, _, play in _risk_evidence()], "manual_review")


def _by_segment_and_size(critical, at_risk, watch, policy):
    """One result per segment; a pair is (at or above the segment's MRR bound, below it)."""
    mrr, seg = c("current_mrr_usd"), c("customer_health_segment")
    bounds = {
        "critical": (critical, policy.mid_value_mrr),
        "at_risk": (at_risk, policy.mid_value_mrr),
        "watch": (watch, policy.high_value_mrr),
    }
    return [
        (seg == name, F.when(mrr >= bound, pair[0]).otherwise(pair[1]))
        for name, (pair, bound) in bounds.items()
    ]


def risk_priority(policy: Policy = DEFAULT) -> Column:
    bands = _by_segment_and_size(("P1", "P2"), ("P2", "P3"), ("P3", "P4"), policy)
    return first_match([(_departed(), "P5"), *bands], "P5")


def risk_priority_rank(policy: Policy = DEFAULT) -> Column:
    critical, *others = _by_segment_and_size((1, 1), (2, 3), (4, 5), policy)
    live_critical = (critical[0] & c("is_current_customer"), critical[1])
    return first_match([live_critical, *others, (_departed(), 6)], 7)


def subscription_age_days(as_of: dt.date) -> Column:
    return F.datediff(F.coalesce(c("canceled_at"), F.lit(as_of)), c("start_date"))


def collection_rate(paid: Column, invoiced: Column) -> Column:
    return rate(paid, invoiced, scale=2)


def subscription_current_mrr() -> Column:
    return money(F.when(c("is_active") | c("is_past_due"), c("mrr_usd")).otherwise(F.lit(0)))
