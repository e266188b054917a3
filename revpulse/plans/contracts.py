"""What every relation promises, and one report over all promises."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revpulse.operators import invariants as I
from revpulse.operators.contracts import column_failures
from revpulse.operators.keys import Reference, Unique, key_pass, union_all
from revpulse.operators.raw_checks import Facts
from revpulse.plans.relations import ENTITY_OF, Warehouse
from revpulse.schemas import ENTITIES, EVENT_TYPES, PAYMENT_METHODS, PLANS, TICKET_CATEGORIES

# Labels a column may hold.
DOMAINS = {
    "segment": ("SMB", "Mid-Market", "Enterprise"),
    "deal_stage": ("prospecting", "qualified", "proposal", "negotiation", "closed_won", "closed_lost"),
    "plan": PLANS,
    "subscription_status": ("active", "past_due", "canceled"),
    "billing_cycle": ("monthly", "annual"),
    "invoice_status": ("paid", "open"),
    "payment_method": PAYMENT_METHODS,
    "event_type": EVENT_TYPES,
    "ticket_status": ("open", "pending", "resolved", "closed"),
    "severity": ("low", "medium", "high", "critical"),
    "category": TICKET_CATEGORIES,
    "account_lifecycle_stage": (
        "active_customer",
        "past_due_customer",
        "churned_customer",
        "won_not_subscribed",
        "prospect",
    ),
    "customer_health_segment": ("healthy", "watch", "at_risk", "critical", "not_customer"),
    "usage_intensity": ("high_usage", "medium_usage", "low_usage", "no_usage"),
    "support_burden_level": ("high_burden", "medium_burden", "low_burden", "no_burden"),
    "account_status_group": ("Customer", "Won - Not Subscribed", "Prospect", "Churned Customer", "Other"),
    "revenue_tier": ("high_value", "mid_value", "low_value", "non_customer", "unknown"),
    "primary_risk_reason": (
        "churned_customer",
        "overdue_invoice",
        "critical_support_ticket",
        "payment_risk",
        "support_risk",
        "low_product_usage",
        "general_risk",
    ),
    "risk_priority": ("P1", "P2", "P3", "P4", "P5"),
}
# Narrower domains of relations that hold current customers or risk accounts only.
CUSTOMER_SEGMENTS = ("healthy", "watch", "at_risk", "critical")
CUSTOMER_TIERS = ("high_value", "mid_value", "low_value")
RISK_SEGMENTS = ("watch", "at_risk", "critical")


@dataclass(frozen=True)
class Contract:
    """Promises of one relation; ``labels`` names the columns held to a domain."""

    not_null: tuple
    key: str | None = None
    labels: tuple = ()
    narrowed: dict = field(default_factory=dict)
    references: dict = field(default_factory=dict)

    @property
    def accepted(self) -> dict:
        return {name: self.narrowed.get(name, DOMAINS.get(name)) for name in self.labels}


_ACCOUNT = ("stg_crm__accounts", "account_id")
_BILLED = ("stg_billing__customers", "billing_customer_id")
_SUBSCRIBED = ("stg_billing__subscriptions", "subscription_id")

# Columns that must be present, unique, in a domain or matched in a parent.
CONTRACTS: dict[str, Contract] = {
    "stg_crm__accounts": Contract(
        not_null=("account_id", "account_name", "industry", "segment", "created_at"),
        key="account_id",
        labels=("segment",),
    ),
    "stg_crm__contacts": Contract(
        not_null=("contact_id", "account_id", "email", "contact_role"),
        key="contact_id",
        references={"account_id": _ACCOUNT},
    ),
    "stg_crm__deals": Contract(
        not_null=("deal_id", "account_id", "deal_stage", "deal_amount_usd", "expected_mrr_usd", "created_at"),
        key="deal_id",
        labels=("deal_stage",),
        references={"account_id": _ACCOUNT},
    ),
    "stg_billing__customers": Contract(
        not_null=("billing_customer_id", "account_id", "customer_name", "created_at"),
        key="billing_customer_id",
        references={"account_id": _ACCOUNT},
    ),
    "stg_billing__subscriptions": Contract(
        not_null=(
            "subscription_id",
            "billing_customer_id",
            "account_id",
            "plan",
            "subscription_status",
            "billing_cycle",
            "mrr_usd",
            "arr_usd",
            "start_date",
        ),
        key="subscription_id",
        labels=("plan", "subscription_status", "billing_cycle"),
        references={"billing_customer_id": _BILLED, "account_id": _ACCOUNT},
    ),
    "stg_billing__invoices": Contract(
        not_null=(
            "invoice_id",
            "subscription_id",
            "billing_customer_id",
            "account_id",
            "invoice_date",
            "due_date",
            "amount_due_usd",
            "invoice_status",
        ),
        key="invoice_id",
        labels=("invoice_status",),
        references={"subscription_id": _SUBSCRIBED, "billing_customer_id": _BILLED, "account_id": _ACCOUNT},
    ),
    "stg_billing__payments": Contract(
        not_null=(
            "payment_id",
            "invoice_id",
            "billing_customer_id",
            "account_id",
            "payment_date",
            "amount_paid_usd",
            "payment_method",
        ),
        key="payment_id",
        labels=("payment_method",),
        references={"invoice_id": ("stg_billing__invoices", "invoice_id"), "billing_customer_id": _BILLED, "account_id": _ACCOUNT},
    ),
    "stg_product__events": Contract(
        not_null=(
            "event_id",
            "account_id",
            "subscription_id",
            "user_id",
            "event_type",
            "occurred_at",
            "event_date",
        ),
        key="event_id",
        labels=("event_type",),
        references={"account_id": _ACCOUNT, "subscription_id": _SUBSCRIBED},
    ),
    "stg_support__tickets": Contract(
        not_null=(
            "ticket_id",
            "account_id",
            "subscription_id",
            "created_at",
            "created_date",
            "ticket_status",
            "severity",
            "category",
            "is_resolved",
            "is_open",
            "is_high_priority",
        ),
        key="ticket_id",
        labels=("ticket_status", "severity", "category"),
        references={"account_id": _ACCOUNT, "subscription_id": _SUBSCRIBED},
    ),
    "int_revenue__invoice_payment_summary": Contract(
        not_null=(
            "invoice_id",
            "subscription_id",
            "account_id",
            "amount_due_usd",
            "total_paid_usd",
            "outstanding_amount_usd",
            "is_fully_paid",
            "is_overdue",
        ),
        key="invoice_id",
        references={"subscription_id": _SUBSCRIBED, "account_id": _ACCOUNT},
    ),
    "int_revenue__subscriptions_enriched": Contract(
        not_null=(
            "subscription_id",
            "billing_customer_id",
            "account_id",
            "subscription_status",
            "mrr_usd",
            "arr_usd",
            "current_mrr_usd",
            "collection_rate",
            "has_overdue_invoice",
        ),
        key="subscription_id",
        labels=("subscription_status",),
        references={"billing_customer_id": _BILLED, "account_id": _ACCOUNT},
    ),
    "int_customer__account_base": Contract(
        not_null=(
            "account_id",
            "account_name",
            "segment",
            "account_lifecycle_stage",
            "current_mrr_usd",
            "current_arr_usd",
        ),
        key="account_id",
        labels=("segment", "account_lifecycle_stage"),
    ),
    "int_product__account_usage": Contract(
        not_null=(
            "account_id",
            "total_events",
            "active_users",
            "active_days",
            "adopted_feature_count",
            "usage_intensity",
            "has_connected_integration",
            "has_created_report",
        ),
        key="account_id",
        labels=("usage_intensity",),
        references={"account_id": _ACCOUNT},
    ),
    "int_support__account_ticket_summary": Contract(
        not_null=(
            "account_id",
            "total_tickets",
            "open_tickets",
            "resolved_tickets",
            "high_priority_tickets",
            "support_burden_level",
            "has_open_tickets",
            "has_critical_ticket",
        ),
        key="account_id",
        labels=("support_burden_level",),
        references={"account_id": _ACCOUNT},
    ),
    "int_customer__health_signals": Contract(
        not_null=(
            "account_id",
            "account_lifecycle_stage",
            "current_mrr_usd",
            "usage_score",
            "adoption_score",
            "payment_score",
            "support_score",
            "relationship_score",
            "customer_health_score",
            "customer_health_segment",
            "is_churn_risk",
            "is_current_customer",
            "low_usage_paid_account",
            "payment_risk_flag",
            "support_risk_flag",
            "raw_customer_health_score",
        ),
        key="account_id",
        labels=("customer_health_segment",),
        references={"account_id": ("int_customer__account_base", "account_id")},
    ),
    "mart_customer_health": Contract(
        not_null=(
            "account_id",
            "account_name",
            "customer_health_segment",
            "is_current_customer",
            "is_churn_risk",
            "customer_health_score",
            "raw_customer_health_score",
            "current_mrr_usd",
            "recommended_action",
            "health_priority_rank",
        ),
        key="account_id",
        labels=("customer_health_segment",),
        references={"account_id": ("int_customer__health_signals", "account_id")},
    ),
    "mart_account_360": Contract(
        not_null=(
            "account_id",
            "account_name",
            "account_status_group",
            "customer_health_segment",
            "revenue_tier",
            "account_priority_action",
            "current_mrr_usd",
            "mrr_at_risk_usd",
            "healthy_mrr_usd",
            "non_healthy_mrr_usd",
            "is_current_customer",
            "is_churn_risk",
        ),
        key="account_id",
        labels=("account_status_group", "customer_health_segment", "revenue_tier"),
        references={"account_id": ("mart_customer_health", "account_id")},
    ),
    "mart_churn_risk": Contract(
        not_null=(
            "account_id",
            "account_name",
            "customer_health_segment",
            "current_mrr_usd",
            "mrr_at_risk_usd",
            "primary_risk_reason",
            "recommended_risk_playbook",
            "risk_priority",
            "risk_priority_rank",
        ),
        key="account_id",
        labels=("customer_health_segment", "primary_risk_reason", "risk_priority"),
        narrowed={"customer_health_segment": RISK_SEGMENTS},
        references={"account_id": ("mart_account_360", "account_id")},
    ),
    "mart_revenue_retention": Contract(
        not_null=(
            "customer_health_segment",
            "revenue_tier",
            "account_priority_action",
            "customer_count",
            "churn_risk_customer_count",
            "current_mrr_usd",
            "mrr_at_risk_usd",
            "healthy_mrr_usd",
            "non_healthy_mrr_usd",
            "mrr_at_risk_rate",
            "customer_risk_rate",
        ),
        labels=("customer_health_segment", "revenue_tier"),
        narrowed={"customer_health_segment": CUSTOMER_SEGMENTS, "revenue_tier": CUSTOMER_TIERS},
    ),
    "mart_product_adoption": Contract(
        not_null=(
            "customer_health_segment",
            "revenue_tier",
            "usage_intensity",
            "customer_count",
            "churn_risk_customer_count",
            "current_mrr_usd",
            "mrr_at_risk_usd",
            "avg_events_per_account",
            "avg_adopted_feature_count",
            "integration_adoption_rate",
            "report_creation_rate",
            "low_usage_paid_account_rate",
        ),
        labels=("customer_health_segment", "revenue_tier", "usage_intensity"),
        narrowed={"customer_health_segment": CUSTOMER_SEGMENTS, "revenue_tier": CUSTOMER_TIERS},
    ),
    "mart_support_operations": Contract(
        not_null=(
            "customer_health_segment",
            "revenue_tier",
            "support_burden_level",
            "customer_count",
            "churn_risk_customer_count",
            "current_mrr_usd",
            "mrr_at_risk_usd",
            "total_tickets",
            "open_tickets",
            "high_priority_tickets",
            "critical_tickets",
            "support_risk_accounts",
            "open_ticket_account_rate",
            "critical_ticket_account_rate",
            "support_risk_account_rate",
        ),
        labels=("customer_health_segment", "revenue_tier", "support_burden_level"),
        narrowed={"customer_health_segment": CUSTOMER_SEGMENTS, "revenue_tier": CUSTOMER_TIERS},
    ),
}


@dataclass(frozen=True)
class Rule:
    name: str
    relation: str
    violations: Callable[[Warehouse], DataFrame]
    tags: tuple


def _rule(name, relation, violations, *tags):
    return Rule(name, relation, violations, tags)


_BUSINESS, _DATA = "business_logic", "data_contract"
RULES: tuple[Rule, ...] = (
    _rule(
        "financials_non_negative",
        "mart_account_360",
        lambda w: I.assert_financials_non_negative(w["mart_account_360"]),
        _BUSINESS,
        _DATA,
    ),
    _rule(
        "mrr_components_reconcile",
        "mart_account_360",
        lambda w: I.assert_mrr_components_reconcile(w["mart_account_360"]),
        _BUSINESS,
        _DATA,
    ),
    _rule(
        "risk_mart_only_risk",
        "mart_churn_risk",
        lambda w: I.assert_risk_mart_only_risk(w["mart_churn_risk"], w["mart_account_360"]),
        _BUSINESS,
    ),
    _rule("rank_in_band", "mart_churn_risk", lambda w: I.assert_rank_in_band(w["mart_churn_risk"]), _BUSINESS, _DATA),
    _rule(
        "critical_flag_open_only",
        "int_support__account_ticket_summary",
        lambda w: I.assert_critical_flag_open_only(
            w["int_support__account_ticket_summary"], w["stg_support__tickets"], w.params
        ),
    ),
    _rule(
        "scores_0_100",
        "mart_customer_health",
        lambda w: I.assert_scores_0_100(w["mart_customer_health"]),
        _BUSINESS,
        _DATA,
    ),
    _rule("healthy_not_risk", "mart_account_360", lambda w: I.assert_healthy_not_risk(w["mart_account_360"]), _BUSINESS),
    _rule(
        "non_customers_zero_mrr",
        "mart_account_360",
        lambda w: I.assert_non_customers_zero_mrr(w["mart_account_360"]),
        _BUSINESS,
    ),
    _rule(
        "non_risk_zero_at_risk",
        "mart_account_360",
        lambda w: I.assert_non_risk_zero_at_risk(w["mart_account_360"]),
        _BUSINESS,
    ),
    _rule(
        "adoption_rates_0_1",
        "mart_product_adoption",
        lambda w: I.assert_adoption_rates_0_1(w["mart_product_adoption"]),
        _BUSINESS,
        _DATA,
    ),
    _rule(
        "retention_matches_360",
        "mart_revenue_retention",
        lambda w: I.assert_retention_matches_360(w["mart_account_360"], w["mart_revenue_retention"]),
        _BUSINESS,
    ),
    _rule(
        "retention_rates_0_1",
        "mart_revenue_retention",
        lambda w: I.assert_retention_rates_0_1(w["mart_revenue_retention"]),
        _BUSINESS,
        _DATA,
    ),
    _rule(
        "support_rates_0_1",
        "mart_support_operations",
        lambda w: I.assert_support_rates_0_1(w["mart_support_operations"]),
        _BUSINESS,
        _DATA,
    ),
)


def _column_checks(w: Warehouse, name: str) -> DataFrame:
    contract = CONTRACTS[name]
    return column_failures(w[name], contract.not_null, contract.accepted).select(
        F.lit(name).alias("relation"), "contract", "column_name", "failed_rows"
    )


def _key_checks() -> tuple[list[Unique], list[Reference]]:
    uniques = [Unique(name, c.key) for name, c in CONTRACTS.items() if c.key]
    return uniques, [Reference(name, key, *parent) for name, c in CONTRACTS.items() for key, parent in c.references.items()]


def staged_references() -> list[Reference]:
    """References that staging promises, between the entities it takes its keys from."""
    return [
        Reference(ENTITY_OF[r.relation], r.column, ENTITY_OF[r.parent], r.parent_column)
        for r in _key_checks()[1]
        if r.relation in ENTITY_OF
    ]


def _known(w: Warehouse, check: Unique | Reference, facts: Facts) -> int | None:
    """What the load already knows of a staging promise. Staged keys are those of the entity if they were typed."""

    def same(relation: str, column: str) -> str | None:
        entity = ENTITY_OF.get(relation)
        if entity is None or w.sources[entity].schema[column].dataType != ENTITIES[entity].columns[column]:
            return None
        return entity

    entity = same(check.relation, check.column)
    if isinstance(check, Unique):
        return facts.get((entity, "repeated", check.column))
    parent = same(check.parent, check.parent_column)
    return facts.get((entity, f"orphan of {parent}", check.column))


def _key_report(w: Warehouse, facts: Facts) -> DataFrame:
    """Keys and references of all relations together, without those that the load has counted."""
    uniques, references = _key_checks()
    known = {c: n for c in (*uniques, *references) if (n := _known(w, c, facts)) is not None}
    uniques, references = ([c for c in checks if c not in known] for checks in (uniques, references))
    rows = sum(n for (_, kind, _), n in getattr(w.sources, "facts", {}).items() if kind == "rows")
    counted = key_pass(w, uniques, references, keys=rows or None)
    label = lambda c: (c.relation, "unique" if isinstance(c, Unique) else "relationship", c.column)
    names = ("relation", "contract", "column_name")
    rows = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, label(c)))) for c in (*uniques, *references)]
    found = counted.select(F.element_at(F.array(*rows), F.col("check") + 1).alias("of"), "failed_rows").select("of.*", "failed_rows")
    if not known:
        return found
    said = w[next(iter(CONTRACTS))].sparkSession.createDataFrame([(*label(c), n) for c, n in known.items()], found.schema)
    return found.unionByName(said)


def rule_report(w: Warehouse, rule: Rule) -> DataFrame:
    return rule.violations(w).agg(F.count(F.lit(1)).alias("failed_rows")).select(
        F.lit(rule.relation).alias("relation"),
        F.lit(rule.name).alias("contract"),
        F.lit(None).cast("string").alias("column_name"),
        "failed_rows",
    )


def run_contracts(w: Warehouse, tag: str | None = None, facts: Facts | None = None) -> DataFrame:
    """Every contract with its failing rows, or only the business rules carrying a tag.

    ``facts`` is what the load of the sources has counted; keys of staging are not counted again then.
    """
    rules = [r for r in RULES if tag is None or tag in r.tags]
    parts = [rule_report(w, r) for r in rules]
    if tag is None:
        parts = [*(_column_checks(w, name) for name in CONTRACTS), _key_report(w, facts or {}), *parts]
    if not parts:
        raise ValueError(f"no contract carries the tag {tag!r}")
    verdict = F.when(F.col("failed_rows") == 0, "pass").otherwise("fail")
    return union_all(parts).withColumn("status", verdict)
