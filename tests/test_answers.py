"""Registered queries against their DuckDB answers on the smallest data set."""

from collections import Counter

import pytest

import __spark_entry__ as entry
from revpulse import oracle, registry

duckdb = pytest.importorskip("duckdb")

CHECKED = (
    "stg_tickets subscriptions_enriched account_usage health_signals mart_churn_risk mart_revenue_retention "
    "mart_support_operations expected_invoice_schedule table_fingerprint raw_validation_of_faults run_contracts "
    "assert_rank_in_band assert_retention_matches_360 stage_audit latest_running_stage table_row_counts"
).split()


@pytest.fixture(scope="session")
def answers(data):
    con = duckdb.connect()
    for t in ("nation", "customer", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def test_every_query_has_an_answer():
    assert set(registry.queries()) == set(oracle.statements())
    assert set(registry.queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_answer(spark, data, answers, name):
    got = answers.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in got.description]
    df = entry.queries()[name](spark, data)
    assert sorted(df.columns) == sorted(columns)
    ours = Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert ours == Counter(got.fetchall())


def test_entry_has_rows(spark, data):
    assert entry.entry(spark).count() > 0
