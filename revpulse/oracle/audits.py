"""Loads, fingerprints, run history and row counts."""

from __future__ import annotations

from revpulse.oracle.entities import _ENTITY_SELECTS
from revpulse.schemas import ENTITIES, catalog_rows

_LOADED = "TIMESTAMP '2026-01-01 06:00:00'"
_OBSERVED = "TIMESTAMP '2026-01-01 07:00:00'"

_LAYERS = {
    "raw": {name: f"({sql})" for name, sql in _ENTITY_SELECTS.items()},
    "staging": {
        "stg_crm__accounts": "s_accounts",
        "stg_crm__contacts": "s_contacts",
        "stg_crm__deals": "s_deals",
        "stg_billing__customers": "s_customers",
        "stg_billing__subscriptions": "s_subscriptions",
        "stg_billing__invoices": "s_invoices",
        "stg_billing__payments": "s_payments",
        "stg_product__events": "s_events",
        "stg_support__tickets": "s_tickets",
    },
    "intermediate": {
        "int_revenue__invoice_payment_summary": "m_invoices",
        "int_revenue__subscriptions_enriched": "m_subscriptions",
        "int_customer__account_base": "m_base",
        "int_product__account_usage": "m_usage",
        "int_support__account_ticket_summary": "m_tickets",
        "int_customer__health_signals": "m_health",
    },
    "marts": {
        "mart_customer_health": "m_customer_health",
        "mart_account_360": "m_360",
        "mart_churn_risk": "m_churn",
        "mart_revenue_retention": "m_retention",
        "mart_product_adoption": "m_adoption",
        "mart_support_operations": "m_operations",
    },
}


def _count(layer, name, source):
    kind = "BASE TABLE" if layer in ("raw", "marts") else "VIEW"
    return (
        f"SELECT 'run_of_record' AS run_id, 'account_warehouse' AS pipeline_name, '{layer}' AS schema_name, "
        f"'{name}' AS relation_name, '{kind}' AS relation_type, COUNT(*) AS row_count, {_OBSERVED} AS observed_at FROM {source}"
    )


def _entity_count(name, sql):
    return (
        f"SELECT 'raw' AS table_schema, '{name}' AS table_name, COUNT(*) AS row_count, {_LOADED} AS loaded_at FROM ({sql})"
    )


def _digest(name, sql):
    fields = [f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ENTITIES[name].columns]
    part = "CAST(coalesce(SUM(CAST('0x' || substr(digest, {0}, 15) AS BIGINT)), 0) AS VARCHAR)"
    return (
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, {part.format(1)} AS digest_high, "
        f"{part.format(17)} AS digest_low FROM (SELECT md5({' || '.join(fields)}) AS digest FROM ({sql}))"
    )


def _stack(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def _sources(missing):
    for name, sql in _ENTITY_SELECTS.items():
        count = "CAST(NULL AS BIGINT)" if name in missing else f"(SELECT COUNT(*) FROM ({sql}))"
        yield f"SELECT '{name}' AS source_name, {str(name not in missing).lower()} AS is_present, {count} AS row_count"


def _text(value) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


def _catalogued():
    """One select an entity: its columns as a list of structs with their filled rows."""
    names = ("source_name", "description", "position", "column_name", "data_type", "is_key", "references_source", "references_column")
    for name, sql in _ENTITY_SELECTS.items():
        structs = []
        for row in catalog_rows():
            if row[0] == name:
                values = [str(v).lower() if isinstance(v, (bool, int)) else _text(v) for v in row]
                fields = ", ".join(f"'{n}': {v}" for n, v in zip(names, values))
                structs.append(f"{{{fields}, 'row_count': COUNT(*), 'filled_rows': COUNT({row[3]})}}")
        yield f"SELECT unnest([{', '.join(structs)}], recursive := true) FROM ({sql})"


CTES = {
    "a_loads": _stack(_entity_count(n, q) for n, q in _ENTITY_SELECTS.items()),
    "a_two_loads": """
SELECT * FROM a_loads
UNION ALL
SELECT * REPLACE (TIMESTAMP '2025-12-31 06:00:00' AS loaded_at) FROM a_loads WHERE table_name = 'crm_accounts'""",
    "a_counts": _stack(_count(layer, n, q) for layer, rels in _LAYERS.items() for n, q in rels.items()),
    "a_events": """
SELECT 'run_' || (event_id // 5) AS run_id, 'account_warehouse' AS pipeline_name, event_type AS stage_name,
       ts AS started_at, CAST(round(value * 100) AS BIGINT) AS hundredths,
       event_type = 'view' AND value < 5 AS never_ends, event_type = 'error' AS broke
FROM events""",
    "a_stages": """
SELECT run_id, pipeline_name, stage_name, started_at,
       CASE WHEN NOT never_ends THEN started_at + to_microseconds(hundredths * 10000) END AS finished_at,
       CASE WHEN NOT never_ends THEN CAST(CAST(hundredths AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2)) END AS duration_seconds,
       CASE WHEN never_ends THEN 'running' WHEN broke THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN broke THEN 'exit code of error' END AS error_message
FROM a_events""",
    "a_runs": """
SELECT run_id, pipeline_name, started_at, finished_at,
       CAST(CAST((2 * (epoch_us(finished_at) - epoch_us(started_at)) + 10000) // 20000 AS DECIMAL(18,0)) * 0.01
            AS DECIMAL(18,2)) AS total_duration_seconds,
       CASE WHEN unfinished THEN 'running' WHEN broke THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN broke AND NOT unfinished THEN 'Stage failed: error' END AS error_message
FROM (SELECT run_id, pipeline_name, min(started_at) AS started_at, bool_or(never_ends) AS unfinished,
             bool_or(broke) AS broke,
             CASE WHEN NOT bool_or(never_ends) THEN max(started_at + to_microseconds(hundredths * 10000)) END AS finished_at
      FROM a_events GROUP BY run_id, pipeline_name)""",
}

ANSWERS = {
    "read_raw_accounts": _ENTITY_SELECTS["crm_accounts"],
    "read_raw_contacts": _ENTITY_SELECTS["crm_contacts"],
    "read_raw_deals": _ENTITY_SELECTS["crm_deals"],
    "read_raw_billing_customers": _ENTITY_SELECTS["billing_customers"],
    "read_raw_subscriptions": _ENTITY_SELECTS["billing_subscriptions"],
    "read_raw_invoices": _ENTITY_SELECTS["billing_invoices"],
    "read_raw_payments": _ENTITY_SELECTS["billing_payments"],
    "read_raw_events": _ENTITY_SELECTS["product_events"],
    "read_raw_tickets": _ENTITY_SELECTS["support_tickets"],
    "publish_snapshot": _stack(_digest(n, q) for n, q in _ENTITY_SELECTS.items()),
    "table_fingerprint": _stack(_digest(n, q) for n, q in _ENTITY_SELECTS.items()),
    "load_audit": "SELECT * FROM a_two_loads",
    "check_sources": _stack(_sources({"crm_contacts", "billing_payments"})),
    "source_catalog": _stack(_catalogued()),
    "layered_views": "SELECT schema_name, relation_name, row_count FROM a_counts",
    "count_entities": "SELECT * FROM a_loads",
    "reload_is_idempotent": """SELECT table_name, row_count AS rows_before, row_count AS rows_after, true AS unchanged
FROM a_loads
UNION ALL
SELECT 'view of crm_accounts', row_count, row_count, true FROM a_loads WHERE table_name = 'crm_accounts'""",
    "register_view": """SELECT plan, COUNT(*) AS subscriptions, CAST(SUM(mrr_usd) AS DECIMAL(18,2)) AS mrr_usd
FROM x_subscriptions WHERE status = 'active' GROUP BY plan""",
    "materialize_mart": "SELECT * FROM m_retention",
    "table_row_counts": "SELECT * FROM a_counts",
    "run_audit": "SELECT * FROM a_runs",
    "stage_audit": "SELECT * FROM a_stages",
    "latest_runs": "SELECT * FROM a_runs ORDER BY started_at DESC, run_id LIMIT 10",
    "latest_stage_audit": "SELECT * FROM a_stages ORDER BY started_at DESC, run_id, stage_name LIMIT 20",
    "latest_running_stage": """SELECT run_id, stage_name, max(started_at) AS started_at FROM a_stages
WHERE finished_at IS NULL GROUP BY run_id, stage_name""",
    "stage_durations_latest_run": """SELECT stage_name, status, duration_seconds, error_message FROM a_stages
WHERE run_id = (SELECT arg_max(run_id, started_at) FROM a_runs)""",
    "latest_raw_loads": "SELECT * FROM a_two_loads ORDER BY loaded_at DESC, table_name LIMIT 20",
    "latest_row_counts": "SELECT * EXCLUDE (pipeline_name) FROM a_counts",
    "row_counts_latest": """SELECT schema_name, COUNT(*) AS relations_observed,
       CAST(SUM(row_count) AS BIGINT) AS total_rows_observed FROM a_counts GROUP BY schema_name""",
}
