"""The nine source entities from the base tables, and their staged form."""

from __future__ import annotations


def _list(*labels):
    return "[" + ", ".join(f"'{x}'" for x in labels) + "]"


def usd(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


_ROLES = _list("Admin", "Executive Sponsor", "Finance", "Operations", "Analyst", "Technical Owner")
_OPEN = _list("prospecting", "qualified", "proposal", "negotiation", "closed_lost")
_PLANS = _list("Starter", "Growth", "Scale", "Enterprise")
_METHODS = _list("card", "bank_transfer", "wire")
_KINDS = _list(
    "login", "dashboard_viewed", "report_created", "user_invited", "integration_connected", "export_downloaded"
)
_CATEGORIES = _list("billing", "bug", "how_to", "integration", "performance", "feature_request")
_LINE_ID = "l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey"

CTES = {
    "x_accounts": """
SELECT c_custkey AS ck, 'acc_' || c_custkey AS account_id, c_name AS account_name,
       c_mktsegment AS industry,
       CASE WHEN c_acctbal < 5000 THEN 'SMB' WHEN c_acctbal < 8500 THEN 'Mid-Market' ELSE 'Enterprise' END AS segment,
       CASE WHEN c_acctbal < 2500 THEN '11-50' WHEN c_acctbal < 5000 THEN '51-100'
            WHEN c_acctbal < 8500 THEN '101-250' ELSE '1001-5000' END AS employee_band,
       n_name AS country, DATE '2019-01-01' + CAST(c_custkey * 37 % 600 AS INTEGER) AS created_at,
       'owner_' || (c_custkey % 23) AS account_owner
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "x_contacts": f"""
SELECT 'con_' || ck || '_' || i AS contact_id, account_id, 'contact' || i || '@' || ck || '.example' AS email,
       account_name || ' contact ' || i AS full_name, {_ROLES}[1 + (ck + 5 * i) % 6] AS role, created_at
FROM (SELECT *, unnest(range(1, 1 + ck % 4)) AS i FROM x_accounts)""",
    "x_deals": f"""
SELECT o_orderkey AS ok, o_custkey AS ck, o_orderstatus AS os, 'deal_' || o_orderkey AS deal_id,
       'acc_' || o_custkey AS account_id, 'Order ' || o_orderkey AS deal_name, 'new_business' AS pipeline,
       deal_stage, {usd("amount")} AS deal_amount_usd, {usd("amount // 12")} AS expected_mrr_usd,
       {_PLANS}[1 + o_orderkey % 4] AS plan, opened AS created_at,
       CASE WHEN deal_stage IN ('closed_won', 'closed_lost')
            THEN opened + CAST(15 + o_orderkey % 106 AS INTEGER) END AS close_date
FROM (SELECT *, CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT) // 8 AS amount,
             CAST(o_orderdate AS DATE) + 8918 AS opened,
             CASE WHEN o_custkey % 10 = 2 AND o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'closed_won'
                  WHEN o_custkey % 10 < 3 THEN {_OPEN}[1 + o_orderkey % 5]
                  WHEN o_orderkey % 20 < 9 THEN 'closed_won' WHEN o_orderkey % 20 < 11 THEN 'closed_lost'
                  WHEN o_orderkey % 20 < 13 THEN 'prospecting' WHEN o_orderkey % 20 < 16 THEN 'qualified'
                  WHEN o_orderkey % 20 < 18 THEN 'proposal' ELSE 'negotiation' END AS deal_stage
      FROM orders)""",
    "x_subscriptions": """
SELECT *, CASE WHEN canceled_at IS NOT NULL THEN 'canceled' WHEN leaning = 'past_due' THEN 'past_due'
               ELSE 'active' END AS status
FROM (SELECT ok, ck, 'sub_' || ok AS subscription_id, 'cus_' || ck AS billing_customer_id, account_id, plan,
             leaning, CASE WHEN (ok // 7) % 10 < 7 THEN 'monthly' ELSE 'annual' END AS billing_cycle,
             expected_mrr_usd AS mrr_usd, CAST(expected_mrr_usd * 12 AS DECIMAL(18,2)) AS arr_usd, start_date,
             CASE WHEN leaning = 'canceled' AND start_date + CAST(90 + ok % 361 AS INTEGER) < DATE '2025-12-31'
                  THEN start_date + CAST(90 + ok % 361 AS INTEGER) END AS canceled_at
      FROM (SELECT *, close_date + CAST(ok % 11 AS INTEGER) AS start_date,
                   CASE WHEN ck % 10 = 3 OR (ck % 10 = 4 AND ok % 3 = 0) THEN 'canceled'
                        WHEN ck % 10 = 4 THEN 'past_due'
                        WHEN (ok // 20) % 20 > 16 THEN 'canceled' WHEN (ok // 20) % 20 = 16 THEN 'past_due'
                        ELSE 'active' END AS leaning
            FROM x_deals WHERE deal_stage = 'closed_won' AND os <> 'P')
      WHERE start_date <= DATE '2025-12-31')""",
    "x_customers": """
SELECT 'cus_' || ck AS billing_customer_id, account_id, account_name AS customer_name, first_start AS created_at, country
FROM x_accounts JOIN (SELECT ck, min(start_date) AS first_start FROM x_subscriptions GROUP BY ck) USING (ck)""",
    "x_lines": """
SELECT s.*, l.* FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         SUM(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT)) AS cents, min(l_returnflag) AS rf,
         min(l_linestatus) AS ls, min(CAST(round(l_discount * 100) AS INTEGER)) AS disc
  FROM lineitem GROUP BY ALL) AS l
JOIN x_subscriptions AS s ON s.ok = l.l_orderkey""",
    "x_flagged": """
SELECT *, rf = 'R' AND (status = 'past_due' OR (ls = 'O' AND disc = 9)) AS unpaid,
       start_date + CAST(30 * l_linenumber AS INTEGER) AS invoice_day FROM x_lines""",
    "x_invoices": f"""
SELECT 'inv_' || l_orderkey || '_' || l_linenumber AS invoice_id, subscription_id, billing_customer_id, account_id,
       invoice_day AS invoice_date, invoice_day + 15 AS due_date, {usd("SUM(cents)")} AS amount_due_usd,
       CASE WHEN bool_or(unpaid) THEN 'open' ELSE 'paid' END AS status
FROM x_flagged GROUP BY l_orderkey, l_linenumber, subscription_id, billing_customer_id, account_id, invoice_day""",
    "x_payments": f"""
SELECT 'pay_' || {_LINE_ID} AS payment_id, 'inv_' || l_orderkey || '_' || l_linenumber AS invoice_id,
       billing_customer_id, account_id, invoice_day + CAST(10 + l_partkey % 16 AS INTEGER) AS payment_date,
       {usd("CASE WHEN rf = 'A' AND ls = 'O' AND disc = 8 THEN cents // 2 ELSE cents END")} AS amount_paid_usd,
       {_METHODS}[1 + l_suppkey % 3] AS payment_method
FROM x_flagged WHERE NOT unpaid""",
    "x_events": f"""
SELECT 'evt_' || {_LINE_ID} || '_' || i AS event_id, account_id, subscription_id,
       'user_' || ((31 * l_suppkey + 7 * i + l_partkey) % 97) AS user_id,
       {_KINDS}[1 + (l_partkey + i * (1 + ck % 3)) % (1 + ck % 6)] AS event_type,
       CAST(DATE '2026-01-03' - CAST((7 * l_partkey + 13 * i + l_linenumber) % 120 AS INTEGER) AS TIMESTAMP)
         + to_hours((l_partkey + i) % 24) AS occurred_at
FROM (SELECT *, unnest(range(1, 1 + CASE WHEN (ck // 10) % 10 < 4 THEN 60 WHEN (ck // 10) % 10 < 7 THEN 18
                                         WHEN (ck // 10) % 10 < 9 THEN 3 ELSE 0 END)) AS i FROM x_lines)""",
    "x_tickets": f"""
SELECT *, CASE WHEN turn >= 4 AND l_partkey % 50 <> 7
               THEN created_at + to_days(CAST(1 + l_partkey % 20 AS INTEGER)) + to_hours(l_partkey % 24) END AS resolved_at
FROM (SELECT 'tck_' || {_LINE_ID} AS ticket_id, account_id, subscription_id, l_partkey,
             CAST(DATE '2025-01-01' + CAST((17 * l_partkey + 5 * l_linenumber) % 380 AS INTEGER) AS TIMESTAMP)
               + to_hours(l_suppkey % 24) AS created_at,
             (3 * l_partkey + 7 * l_linenumber) % 20 AS turn,
             CASE WHEN turn < 2 THEN 'open' WHEN turn < 4 THEN 'pending' WHEN turn < 15 THEN 'resolved'
                  ELSE 'closed' END AS status,
             (11 * l_partkey + l_suppkey + l_linenumber) % 20 AS weight,
             CASE WHEN weight < 9 THEN 'low' WHEN weight < 16 THEN 'medium' WHEN weight < 19 THEN 'high'
                  ELSE 'critical' END AS severity,
             {_CATEGORIES}[1 + l_suppkey % 6] AS category
      FROM x_lines WHERE rf = 'R')""",
    "s_accounts": "SELECT * EXCLUDE (ck) FROM x_accounts",
    "s_contacts": "SELECT * RENAME (role AS contact_role) FROM x_contacts",
    "s_deals": "SELECT * EXCLUDE (ok, ck, os) FROM x_deals",
    "s_customers": "SELECT * FROM x_customers",
    "s_subscriptions": """
SELECT * EXCLUDE (ok, ck, leaning, status), status AS subscription_status, status = 'active' AS is_active,
       status = 'canceled' AS is_canceled, status = 'past_due' AS is_past_due FROM x_subscriptions""",
    "s_invoices": """
SELECT * EXCLUDE (status), status AS invoice_status, status = 'paid' AS is_paid, status = 'open' AS is_open
FROM x_invoices""",
    "s_payments": "SELECT * FROM x_payments",
    "s_events": "SELECT *, CAST(occurred_at AS DATE) AS event_date FROM x_events",
    # Whole days are counted from elapsed microseconds instead of interval fields.
    "s_tickets": """
SELECT ticket_id, account_id, subscription_id, created_at, CAST(created_at AS DATE) AS created_date, resolved_at,
       CAST(resolved_at AS DATE) AS resolved_date, status AS ticket_status, severity, category,
       status IN ('resolved', 'closed') AND coalesce(resolved_at < TIMESTAMP '2026-01-01', false) AS is_resolved,
       created_at < TIMESTAMP '2026-01-01'
         AND (status IN ('open', 'pending') OR coalesce(resolved_at >= TIMESTAMP '2026-01-01', false)) AS is_open,
       severity IN ('high', 'critical') AS is_high_priority,
       CAST(trunc((epoch_us(resolved_at) - epoch_us(created_at)) / 86400000000.0) AS INTEGER) AS resolution_days
FROM x_tickets""",
}

# Answers leave out the helper columns the derivation carries.
_ENTITY_SELECTS = {
    "crm_accounts": "SELECT * EXCLUDE (ck) FROM x_accounts",
    "crm_contacts": "SELECT * FROM x_contacts",
    "crm_deals": "SELECT * EXCLUDE (ok, ck, os) FROM x_deals",
    "billing_customers": "SELECT * FROM x_customers",
    "billing_subscriptions": "SELECT * EXCLUDE (ok, ck, leaning) FROM x_subscriptions",
    "billing_invoices": "SELECT * FROM x_invoices",
    "billing_payments": "SELECT * FROM x_payments",
    "product_events": "SELECT * FROM x_events",
    "support_tickets": """SELECT ticket_id, account_id, subscription_id, created_at, resolved_at, status, severity,
       category FROM x_tickets""",
}

ANSWERS = {
    **{f"raw_{n}": sql for n, sql in _ENTITY_SELECTS.items()},
    "stg_accounts": "SELECT * FROM s_accounts",
    "stg_contacts": "SELECT * FROM s_contacts",
    "stg_deals": "SELECT * FROM s_deals",
    "stg_billing_customers": "SELECT * FROM s_customers",
    "stg_subscriptions": "SELECT * FROM s_subscriptions",
    "stg_invoices": "SELECT * FROM s_invoices",
    "stg_payments": "SELECT * FROM s_payments",
    "stg_events": "SELECT * FROM s_events",
    "stg_tickets": "SELECT * FROM s_tickets",
    "stg_accounts_from_text": "SELECT * FROM s_accounts",
    "stg_contacts_from_text": "SELECT * FROM s_contacts",
    "stg_deals_from_text": "SELECT * FROM s_deals",
    "stg_billing_customers_from_text": "SELECT * FROM s_customers",
    "stg_subscriptions_from_text": "SELECT * FROM s_subscriptions",
    "stg_invoices_from_text": "SELECT * FROM s_invoices",
    "stg_payments_from_text": "SELECT * FROM s_payments",
    "stg_events_from_text": "SELECT * FROM s_events",
    "stg_tickets_from_text": "SELECT * FROM s_tickets",
}
