from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from revpulse.operators import contracts, invariants, raw_checks
from revpulse.plans.contracts import CONTRACTS, RULES, run_contracts
from revpulse.plans.relations import Warehouse
from revpulse.schemas import ENTITIES
from revpulse.sources.bound import bind

from conftest import by


def test_registry_is_complete():
    per = CONTRACTS.values()
    assert sum(len(c.not_null) for c in per) == 185
    assert sum(c.key is not None for c in per) == 18
    assert sum(len(c.labels) for c in per) == 32 and all(v for c in per for v in c.accepted.values())
    assert sum(len(c.references) for c in per) == 25
    assert len(RULES) == 13
    assert sum("business_logic" in r.tags for r in RULES) == 12 and sum("data_contract" in r.tags for r in RULES) == 7


def test_raw_report_counts_every_kind(spark, entity):
    tables = {e: entity(e) for e in ENTITIES}
    tables["crm_accounts"] = entity("crm_accounts", {"account_id": "a", "created_at": "2025-01-01"}, {"account_id": "a"})
    tables["crm_deals"] = entity(
        "crm_deals",
        {"deal_id": None, "account_id": "a", "deal_amount_usd": "-1.00", "created_at": "2025-01-01"},
        {"deal_id": None, "account_id": "lost", "created_at": "2025-01-01"},
        {"deal_id": "3", "account_id": "lost", "expected_mrr_usd": "0.00"},
        {"deal_id": "4", "account_id": None, "created_at": "2025-01-01"},
    )
    report = by(raw_checks.raw_validation_report(spark, tables), "check_name")
    assert len(report) == 57
    failed = {k: r["failed_records"] for k, r in report.items() if r["status"] == "fail"}
    assert failed == {
        "crm_accounts_account_id_unique": 1,
        "crm_accounts_created_at_valid": 1,
        "crm_deals_deal_id_not_null": 2,
        "crm_deals_deal_id_unique": 1,
        "crm_deals_account_id_exists_in_crm_accounts": 2,
        "crm_deals_created_at_valid": 1,
        "crm_deals_deal_amount_usd_non_negative": 1,
        **{f"{e}_not_empty": 1 for e in ENTITIES if e not in ("crm_accounts", "crm_deals")},
    }
    assert report["crm_deals_not_empty"]["details"] == "row_count=4"
    assert report["crm_deals_account_id_exists_in_crm_accounts"]["details"] == "crm_deals.account_id -> crm_accounts.account_id"


def test_missing_table_is_reported(spark, entity):
    report = by(raw_checks.raw_validation_report(spark, {"crm_accounts": entity("crm_accounts", {"account_id": "a"})}), "check_name")
    assert report["crm_deals_exists"]["status"] == "fail" and report["crm_deals_exists"]["details"] == "Missing table"
    assert report["crm_accounts_exists"]["status"] == "pass"


def test_empty_text_date_is_missing(spark):
    df = spark.createDataFrame([("a", ""), ("b", "2025-01-01"), ("c", None)], "account_id string, created_at string")
    report = by(raw_checks.check_dates_present({"crm_accounts": df}), "check_name")
    assert report["crm_accounts_created_at_valid"]["failed_records"] == 2


def test_column_checks(frame):
    df = frame("k string, label string", ("a", "x"), (None, "y"), ("a", None), ("b", "z"))
    rows = by(contracts.column_failures(df, ["k", "label"], {"label": ["x", "y"]}).select(F.concat_ws("/", "contract", "column_name").alias("c"), "failed_rows"), "c")
    assert {c: r["failed_rows"] for c, r in rows.items()} == {"not_null/k": 1, "not_null/label": 1, "accepted_values/label": 1}


def test_accepted_values_may_hold_quotes(frame):
    df = frame("label string", ("it's",), ("a\\b",), ("other",))
    assert contracts.expect_accepted_values(df, {"label": ["it's", "a\\b"]}).first().failed_rows == 1


def test_unique_ignores_null_but_duplicate_keys_does_not(frame):
    df = frame("k string", ("a",), ("a",), (None,), (None,), ("b",))
    assert contracts.expect_unique(df, "k").first().failed_rows == 1
    assert {r.k: r.key_rows for r in contracts.duplicate_keys(df, "k").collect()} == {"a": 2, None: 2}


def test_orphans(frame):
    child = frame("fk string", ("a",), ("x",), ("x",), (None,), ("y",))
    parent = frame("pk string", ("a",), ("b",), (None,))
    assert {r.orphan_key: r.child_rows for r in contracts.orphan_rows(child, "fk", parent, "pk").collect()} == {"x": 2, "y": 1}
    assert contracts.expect_relationship(child, "fk", parent, "pk").first().failed_rows == 3
    assert contracts.expect_relationship(child.where("fk = 'a'"), "fk", parent, "pk").first().failed_rows == 0


def test_rank_bands(frame):
    schema = "account_id string, account_name string, risk_priority string, risk_priority_rank int, current_mrr_usd int, mrr_at_risk_usd int, primary_risk_reason string"
    allowed = {("P1", 1), ("P2", 1), ("P2", 2), ("P3", 3), ("P3", 4), ("P4", 5), ("P5", 6)}
    every = [(p, r) for p in ("P1", "P2", "P3", "P4", "P5") for r in (1, 2, 3, 4, 5, 6, 7, None)]
    df = frame(schema, *((f"{p}{r}", "n", p, r, 0, 0, "x") for p, r in every))
    broken = {(r.risk_priority, r.risk_priority_rank) for r in invariants.assert_rank_in_band(df).collect()}
    assert broken == set(every) - allowed


def test_score_and_rate_ranges(frame):
    scores = frame("account_id string, customer_health_score int, raw_customer_health_score int", ("ok", 0, 100), ("hi", 101, 1), ("lo", 1, -1))
    assert {r.account_id for r in invariants.assert_scores_0_100(scores).collect()} == {"hi", "lo"}
    schema = "customer_health_segment string, revenue_tier string, account_priority_action string, customer_risk_rate decimal(18,4), mrr_at_risk_rate decimal(18,4)"
    rates = frame(schema, ("ok", "t", "a", "0.0000", "1.0000"), ("hi", "t", "a", "1.5000", "0.0000"), ("lo", "t", "a", "0.0000", "-0.0001"))
    assert {r.customer_health_segment for r in invariants.assert_retention_rates_0_1(rates).collect()} == {"hi", "lo"}


def test_mrr_tolerance(frame):
    schema = "account_id string, account_name string, current_mrr_usd decimal(18,2), healthy_mrr_usd decimal(18,2), non_healthy_mrr_usd decimal(18,2)"
    df = frame(schema, ("near", "n", "100.00", "99.99", "0.00"), ("off", "n", "100.00", "0.00", "99.98"), ("over", "n", "1.00", "1.00", "0.02"))
    rows = by(invariants.assert_mrr_components_reconcile(df), "account_id")
    assert {k: r["reconciliation_difference"] for k, r in rows.items()} == {"off": Decimal("0.02"), "over": Decimal("-0.02")}


def test_risk_rows_must_exist_and_be_flagged(frame):
    risk = frame("account_id string, account_name string", ("ok", "n"), ("absent", "n"), ("calm", "n"))
    m360 = frame("account_id string, is_churn_risk boolean", ("ok", True), ("calm", False))
    assert {r.account_id for r in invariants.assert_risk_mart_only_risk(risk, m360).collect()} == {"absent", "calm"}


def test_critical_flag_against_tickets(frame):
    summary = frame("account_id string, has_critical_ticket boolean", ("right", True), ("claimed", True), ("missed", False), ("calm", False))
    tickets = frame(
        "account_id string, severity string, is_open boolean, created_date date",
        ("right", "critical", True, "2025-01-01"), ("right", "critical", True, "2025-02-01"), ("claimed", "critical", False, "2025-01-01"),
        ("missed", "critical", True, "2025-01-01"), ("calm", "critical", True, "2026-01-01"), ("calm", "high", True, "2025-01-01"),
    )
    assert {r.account_id for r in invariants.assert_critical_flag_open_only(summary, tickets).collect()} == {"claimed", "missed"}


def test_totals_must_agree(frame):
    m360 = frame("is_current_customer boolean, current_mrr_usd decimal(18,2), mrr_at_risk_usd decimal(18,2)", (True, "10.00", "5.00"), (False, "9.00", "9.00"))
    good = frame("current_mrr_usd decimal(18,2), mrr_at_risk_usd decimal(18,2), customer_count bigint", ("10.00", "5.00", 1))
    assert invariants.assert_retention_matches_360(m360, good).count() == 0
    assert invariants.assert_retention_matches_360(m360, good.withColumn("customer_count", F.lit(2))).count() == 1


def test_tagged_report_and_unknown_tag(spark, data):
    w = Warehouse(bind(spark, data))
    with pytest.raises(ValueError):
        run_contracts(w, "no_such_tag")
    assert len(run_contracts(w, "data_contract").columns) == 5
