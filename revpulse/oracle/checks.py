"""Source checks, contracts and business rules, on good data and on seeded faults."""

from __future__ import annotations

from revpulse.oracle.audits import _LAYERS
from revpulse.oracle.entities import _ENTITY_SELECTS
from revpulse.plans.contracts import CONTRACTS, RULES
from revpulse.schemas import ENTITIES

_RELATIONS = {name: sql for layer in _LAYERS.values() for name, sql in layer.items()}


def _stack(selects) -> str:
    return "\nUNION ALL\n".join(selects)


def _result(name, table, kind, failed, details, source) -> str:
    return (
        f"SELECT '{name}' AS check_name, 'raw' AS table_schema, '{table}' AS table_name, '{kind}' AS check_type, "
        f"CASE WHEN {failed} = 0 THEN 'pass' ELSE 'fail' END AS status, CAST({failed} AS BIGINT) AS failed_records, "
        f"{details} AS details FROM {source}"
    )


def _exists(found):
    return [
        f"SELECT '{n}_exists' AS check_name, 'raw' AS table_schema, '{n}' AS table_name, 'table_exists' AS check_type, "
        f"'{'pass' if n in found else 'fail'}' AS status, CAST({int(n not in found)} AS BIGINT) AS failed_records, "
        f"'{'Table exists' if n in found else 'Missing table'}' AS details"
        for n in ENTITIES
    ]


def _not_empty(src):
    return [
        _result(f"{n}_not_empty", n, "not_empty", "CAST(COUNT(*) = 0 AS INTEGER)", "'row_count=' || COUNT(*)", s)
        for n, s in src.items()
    ]


def _pk_present(src):
    for n, s in src.items():
        k = ENTITIES[n].key
        yield _result(f"{n}_{k}_not_null", n, "primary_key_not_null", f"COUNT(*) - COUNT({k})", f"'primary_key={k}'", s)


def _pk_unique(src):
    for n, s in src.items():
        k = ENTITIES[n].key
        again = f"(SELECT {k} FROM {s} GROUP BY {k} HAVING COUNT(*) > 1)"
        yield _result(f"{n}_{k}_unique", n, "primary_key_unique", "COUNT(*)", f"'primary_key={k}'", again)


def _related(src):
    for n, s in src.items():
        for k, (parent, pk) in ENTITIES[n].references.items():
            if parent in src:
                lost = f"(SELECT * FROM {s} WHERE {k} NOT IN (SELECT {pk} FROM {src[parent]} WHERE {pk} IS NOT NULL))"
                yield _result(
                    f"{n}_{k}_exists_in_{parent}", n, "relationship", "COUNT(*)", f"'{n}.{k} -> {parent}.{pk}'", lost
                )


def _dated(src):
    for n, s in src.items():
        for d in ENTITIES[n].required_dates:
            yield _result(f"{n}_{d}_valid", n, "date_not_null", f"COUNT(*) - COUNT({d})", f"'date_column={d}'", s)


def _priced(src):
    for n, s in src.items():
        for a in ENTITIES[n].amounts:
            yield _result(
                f"{n}_{a}_non_negative", n, "non_negative_amount", f"COUNT(*) FILTER ({a} < 0)", f"'amount_column={a}'", s
            )


def _all_raw(src) -> str:
    parts = [*_exists(src), *_not_empty(src), *_pk_present(src), *_pk_unique(src)]
    return _stack([*parts, *_related(src), *_dated(src), *_priced(src)])


_GOOD = {n: f"({q})" for n, q in _ENTITY_SELECTS.items()}
_FAULTY = {
    "crm_accounts": "f_accounts",
    "crm_contacts": "f_contacts",
    "crm_deals": "f_deals",
    "billing_subscriptions": "f_subscriptions",
    "billing_invoices": "f_invoices",
    "billing_payments": "f_payments",
    "product_events": "f_events",
    "support_tickets": "f_tickets",
}


def _literals(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _contract_rows():
    for name, contract in CONTRACTS.items():
        source = _RELATIONS[name]

        def row(kind, column, failed, frm=source, name=name):
            return (
                f"SELECT '{name}' AS relation, '{kind}' AS contract, '{column}' AS column_name, "
                f"CAST({failed} AS BIGINT) AS failed_rows FROM {frm}"
            )

        for column in contract.not_null:
            yield row("not_null", column, f"COUNT(*) - COUNT({column})")
        for column, values in contract.accepted.items():
            yield row("accepted_values", column, f"COUNT(*) FILTER ({column} NOT IN ({_literals(values)}))")
        if contract.key:
            yield row("unique", contract.key, f"COUNT({contract.key}) - COUNT(DISTINCT {contract.key})")
        for column, (parent, key) in contract.references.items():
            lost = f"(SELECT * FROM {source} WHERE {column} NOT IN (SELECT {key} FROM {_RELATIONS[parent]}))"
            yield row("relationship", column, "COUNT(*)", lost)


_RULE_SQL = {
    "financials_non_negative": "SELECT 1 FROM m_360 WHERE least(current_mrr_usd, healthy_mrr_usd, non_healthy_mrr_usd, mrr_at_risk_usd) < 0",
    "mrr_components_reconcile": "SELECT 1 FROM m_360 WHERE abs(current_mrr_usd - healthy_mrr_usd - non_healthy_mrr_usd) > 0.01",
    "risk_mart_only_risk": "SELECT 1 FROM m_churn WHERE account_id NOT IN (SELECT account_id FROM m_360 WHERE is_churn_risk)",
    "rank_in_band": "SELECT 1 FROM m_churn WHERE NOT list_contains(map {'P1': [1], 'P2': [1, 2], 'P3': [3, 4], 'P4': [5], 'P5': [6]}[risk_priority], risk_priority_rank)",
    "critical_flag_open_only": """SELECT 1 FROM m_tickets WHERE has_critical_ticket <> (account_id IN
  (SELECT account_id FROM s_tickets WHERE is_open AND severity = 'critical'))""",
    "scores_0_100": "SELECT 1 FROM m_customer_health WHERE customer_health_score NOT BETWEEN 0 AND 100 OR raw_customer_health_score NOT BETWEEN 0 AND 100",
    "healthy_not_risk": "SELECT 1 FROM m_360 WHERE is_churn_risk AND customer_health_segment = 'healthy'",
    "non_customers_zero_mrr": "SELECT 1 FROM m_360 WHERE current_mrr_usd <> 0 AND is_current_customer = false",
    "non_risk_zero_at_risk": "SELECT 1 FROM m_360 WHERE mrr_at_risk_usd <> 0 AND is_churn_risk = false",
    "adoption_rates_0_1": "SELECT 1 FROM m_adoption WHERE greatest(integration_adoption_rate, report_creation_rate, low_usage_paid_account_rate) > 1",
    "retention_matches_360": """SELECT 1 WHERE (SELECT SUM(current_mrr_usd) FROM m_360 WHERE is_current_customer)
  <> (SELECT SUM(current_mrr_usd) FROM m_retention)""",
    "retention_rates_0_1": "SELECT 1 FROM m_retention WHERE greatest(customer_risk_rate, mrr_at_risk_rate) > 1",
    "support_rates_0_1": "SELECT 1 FROM m_operations WHERE greatest(open_ticket_account_rate, critical_ticket_account_rate, support_risk_account_rate) > 1",
}


def _rule_rows(tag=None):
    for rule in RULES:
        if tag is None or tag in rule.tags:
            yield (
                f"SELECT '{rule.relation}' AS relation, '{rule.name}' AS contract, CAST(NULL AS VARCHAR) AS column_name, "
                f"CAST(COUNT(*) AS BIGINT) AS failed_rows FROM ({_RULE_SQL[rule.name]})"
            )


def _judged(rows) -> str:
    return f"SELECT *, CASE WHEN failed_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({_stack(rows)})"


def _columns_of(name, contract, column, failed, source):
    return f"SELECT '{contract}' AS contract, '{column}' AS column_name, CAST({failed} AS BIGINT) AS failed_rows FROM {source}"


CTES = {
    "f_accounts": """
SELECT a.* EXCLUDE (account_name, segment), copy.account_name, copy.segment
FROM (SELECT * EXCLUDE (ck) FROM x_accounts) AS a
JOIN (SELECT account_id, CASE WHEN country <> 'NATION_3' THEN account_name END AS account_name,
             CASE country WHEN 'NATION_4' THEN 'Micro' WHEN 'NATION_5' THEN NULL ELSE segment END AS segment,
             unnest(range(CASE industry WHEN 'MACHINERY' THEN 2 ELSE 1 END)) AS n FROM x_accounts) AS copy USING (account_id)""",
    "f_deals": """
SELECT * EXCLUDE (ok, ck, os) REPLACE (
  CASE deal_stage WHEN 'negotiation' THEN NULL ELSE deal_id END AS deal_id,
  CASE plan WHEN 'Growth' THEN NULL ELSE created_at END AS created_at,
  CASE plan WHEN 'Scale' THEN 0 - deal_amount_usd ELSE deal_amount_usd END AS deal_amount_usd,
  CASE deal_stage WHEN 'proposal' THEN 'lost_' || account_id WHEN 'qualified' THEN NULL ELSE account_id END AS account_id)
FROM x_deals""",
    "f_contacts": """
SELECT * EXCLUDE (n) FROM (
  SELECT * REPLACE (CASE WHEN role <> 'Finance' THEN contact_id END AS contact_id,
                    if(role = 'Operations', 'lost_', '') || account_id AS account_id,
                    CASE WHEN role <> 'Admin' THEN created_at END AS created_at),
         unnest(range(if(role = 'Analyst', 2, 1))) AS n FROM x_contacts)""",
    "f_subscriptions": """
SELECT * REPLACE (CASE plan WHEN 'Starter' THEN 0 - mrr_usd ELSE mrr_usd END AS mrr_usd,
                  CASE WHEN status <> 'canceled' THEN start_date END AS start_date) FROM x_subscriptions""",
    "f_invoices": """
SELECT * REPLACE (CASE WHEN status <> 'open' THEN invoice_date END AS invoice_date,
                  if(status = 'open', 'lost_', '') || subscription_id AS subscription_id,
                  if(status = 'open', 0 - amount_due_usd, amount_due_usd) AS amount_due_usd) FROM x_invoices""",
    "f_payments": """
SELECT * REPLACE (CASE WHEN payment_method <> 'card' THEN payment_id END AS payment_id,
                  if(payment_method = 'wire', 0 - amount_paid_usd, amount_paid_usd) AS amount_paid_usd,
                  CASE WHEN payment_method <> 'bank_transfer' THEN payment_date END AS payment_date,
                  if(payment_method = 'bank_transfer', 'lost_', '') || invoice_id AS invoice_id) FROM x_payments""",
    "f_events": """
SELECT * EXCLUDE (n) FROM (
  SELECT * REPLACE (CASE WHEN event_type <> 'login' THEN occurred_at END AS occurred_at,
                    if(event_type = 'user_invited', 'lost_', '') || subscription_id AS subscription_id),
         unnest(range(if(event_type = 'report_created', 2, 1))) AS n FROM x_events)""",
    "f_tickets": """
SELECT * EXCLUDE (n) FROM (
  SELECT * REPLACE (CASE WHEN severity <> 'critical' THEN created_at END AS created_at,
                    CASE WHEN category <> 'billing' THEN subscription_id END AS subscription_id),
         unnest(range(if(status = 'pending', 2, 1))) AS n FROM x_tickets)""",
    "f_360": """
SELECT * REPLACE (
  CAST(CASE country WHEN 'NATION_1' THEN 0 - current_mrr_usd ELSE current_mrr_usd END AS DECIMAL(18,2)) AS current_mrr_usd,
  CAST(healthy_mrr_usd + CASE country WHEN 'NATION_2' THEN 0.02 WHEN 'NATION_3' THEN 0.01 ELSE 0.00 END
       AS DECIMAL(18,2)) AS healthy_mrr_usd,
  is_churn_risk <> (country = 'NATION_4') AS is_churn_risk,
  is_current_customer <> (country = 'NATION_5') AS is_current_customer)
FROM m_360""",
    "f_totals": """
SELECT CAST(SUM(current_mrr_usd) AS DECIMAL(18,2)) AS current_mrr_usd, CAST(SUM(mrr_at_risk_usd) AS DECIMAL(18,2)) AS mrr_at_risk_usd,
       COUNT(*) AS customer_count FROM m_360 WHERE is_current_customer""",
    "f_churn": """
SELECT * REPLACE (CASE country WHEN 'NATION_7' THEN NULL WHEN 'NATION_8' THEN risk_priority_rank + 1
                  ELSE risk_priority_rank END AS risk_priority_rank) FROM m_churn""",
}

_DEAL_NULLS = [
    _columns_of("deals", "not_null", c, f"COUNT(*) - COUNT({c})", "f_deals") for c in CONTRACTS["stg_crm__deals"].not_null
]

ANSWERS = {
    "raw_validation_report": _all_raw(_GOOD),
    "raw_validation_of_faults": _all_raw(_FAULTY),
    "raw_validation_of_load": _all_raw(_GOOD),
    "check_tables_exist": _stack(_exists({"crm_accounts", "crm_contacts"})),
    "check_not_empty": _stack(_not_empty({**_FAULTY, "crm_contacts": "(SELECT * FROM x_contacts WHERE false)"})),
    "check_pk_not_null": _stack(_pk_present(_FAULTY)),
    "check_pk_unique": _stack(_pk_unique(_FAULTY)),
    "check_relationships": _stack(_related(_FAULTY)),
    "check_dates_present": _stack(_dated(_FAULTY)),
    "check_non_negative": _stack(_priced(_FAULTY)),
    "duplicate_keys": """SELECT account_id, COUNT(*) AS key_rows FROM f_accounts GROUP BY account_id HAVING COUNT(*) <> 1""",
    "orphan_rows": """SELECT account_id AS orphan_key, COUNT(*) AS child_rows FROM f_deals
WHERE starts_with(account_id, 'lost_') GROUP BY account_id""",
    "expect_not_null": _stack(_DEAL_NULLS),
    "expect_unique": """SELECT 'unique' AS contract, 'account_id' AS column_name, COUNT(*) AS failed_rows
FROM x_accounts WHERE industry = 'MACHINERY'""",
    "expect_accepted_values": """SELECT 'accepted_values' AS contract, 'segment' AS column_name, COUNT(*) AS failed_rows
FROM f_accounts WHERE segment = 'Micro'""",
    "expect_relationship": """SELECT 'relationship' AS contract, 'account_id' AS column_name, COUNT(*) AS failed_rows
FROM f_deals WHERE deal_stage = 'proposal'""",
    "run_contracts": _judged([*_contract_rows(), *_rule_rows()]),
    "run_tagged_contracts": _judged(_rule_rows("data_contract")),
    "assert_financials_non_negative": """SELECT account_id, account_name, current_mrr_usd, healthy_mrr_usd,
       non_healthy_mrr_usd, mrr_at_risk_usd FROM f_360
WHERE least(current_mrr_usd, healthy_mrr_usd, non_healthy_mrr_usd, mrr_at_risk_usd) < 0""",
    "assert_mrr_components_reconcile": """SELECT * FROM (
  SELECT account_id, account_name, current_mrr_usd, healthy_mrr_usd, non_healthy_mrr_usd,
         CAST(current_mrr_usd - healthy_mrr_usd - non_healthy_mrr_usd AS DECIMAL(18,2)) AS reconciliation_difference FROM f_360)
WHERE reconciliation_difference NOT BETWEEN -0.01 AND 0.01""",
    "assert_risk_mart_only_risk": """SELECT account_id, account_name,
       CASE WHEN country <> 'NATION_6' THEN false END AS is_churn_risk
FROM m_churn WHERE country IN ('NATION_4', 'NATION_6')""",
    "assert_rank_in_band": """SELECT account_id, account_name, risk_priority, risk_priority_rank, current_mrr_usd,
       mrr_at_risk_usd, primary_risk_reason FROM f_churn
WHERE NOT coalesce(list_contains(
  map {'P1': [1], 'P2': [1, 2], 'P3': [3, 4], 'P4': [5], 'P5': [6]}[risk_priority], risk_priority_rank), false)""",
    "assert_critical_flag_open_only": "SELECT account_id FROM m_tickets WHERE support_burden_level = 'high_burden'",
    "assert_scores_0_100": """SELECT * FROM (
  SELECT * REPLACE (CASE country WHEN 'NATION_9' THEN customer_health_score + 100 ELSE customer_health_score END AS customer_health_score,
                    CASE country WHEN 'NATION_10' THEN raw_customer_health_score - 100 ELSE raw_customer_health_score END
                      AS raw_customer_health_score) FROM m_customer_health)
WHERE greatest(customer_health_score, raw_customer_health_score) > 100
   OR least(customer_health_score, raw_customer_health_score) < 0""",
    "assert_healthy_not_risk": """SELECT account_id, account_name, customer_health_segment, is_churn_risk,
       customer_health_score FROM f_360 WHERE is_churn_risk AND customer_health_segment = 'healthy'""",
    "assert_non_customers_zero_mrr": """SELECT account_id, account_name, account_status_group, is_current_customer,
       current_mrr_usd FROM f_360 WHERE is_current_customer = false AND abs(current_mrr_usd) > 0""",
    "assert_non_risk_zero_at_risk": """SELECT account_id, account_name, customer_health_segment, is_churn_risk,
       mrr_at_risk_usd FROM f_360 WHERE is_churn_risk = false AND abs(mrr_at_risk_usd) > 0""",
    "assert_adoption_rates_0_1": """SELECT customer_health_segment, revenue_tier, usage_intensity, integration_adoption_rate,
       low_usage_paid_account_rate, CAST(report_creation_rate + 1 AS DECIMAL(18,4)) AS report_creation_rate
FROM m_adoption WHERE revenue_tier = 'high_value' AND report_creation_rate > 0""",
    "assert_retention_rates_0_1": """SELECT customer_health_segment, revenue_tier, account_priority_action, customer_risk_rate,
       CAST(mrr_at_risk_rate - 1 AS DECIMAL(18,4)) AS mrr_at_risk_rate
FROM m_retention WHERE revenue_tier = 'low_value' AND mrr_at_risk_rate <> 1""",
    "assert_support_rates_0_1": """SELECT customer_health_segment, revenue_tier, support_burden_level,
       CAST(open_ticket_account_rate + 1 AS DECIMAL(18,4)) AS open_ticket_account_rate, critical_ticket_account_rate,
       support_risk_account_rate FROM m_operations WHERE revenue_tier = 'mid_value' AND open_ticket_account_rate > 0""",
    "global_totals": "SELECT * FROM f_totals",
    "reconcile_totals": """SELECT current_mrr_usd AS account_360_current_mrr_usd, current_mrr_usd AS revenue_retention_current_mrr_usd,
       mrr_at_risk_usd AS account_360_mrr_at_risk_usd, mrr_at_risk_usd AS revenue_retention_mrr_at_risk_usd,
       customer_count AS account_360_customer_count, customer_count AS revenue_retention_customer_count FROM f_totals""",
    "assert_retention_matches_360": """SELECT t.current_mrr_usd AS revenue_retention_current_mrr_usd,
       t.mrr_at_risk_usd AS revenue_retention_mrr_at_risk_usd, t.customer_count AS revenue_retention_customer_count,
       CAST(f.m AS DECIMAL(18,2)) AS account_360_current_mrr_usd, CAST(f.r AS DECIMAL(18,2)) AS account_360_mrr_at_risk_usd,
       f.n AS account_360_customer_count
FROM f_totals AS t, (SELECT SUM(current_mrr_usd) AS m, SUM(mrr_at_risk_usd) AS r, COUNT(*) AS n
                     FROM f_360 WHERE is_current_customer) AS f""",
}
