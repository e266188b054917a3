"""Account, revenue, usage and support results in integer arithmetic.

Ladders are written as list lookups and sums of reached thresholds, and rounded
quotients as integer division, so they share no structure with the Spark side.
"""

from __future__ import annotations

from revpulse.oracle.entities import usd


def quotient(num: str, den: str, places: int) -> str:
    """Half-up quotient of two non-negative integers with the given decimals."""
    whole = f"(({num})::HUGEINT * {2 * 10**places} + ({den})) // (2 * NULLIF(({den}), 0))"
    step = f"CAST({10**-places:.{places}f} AS DECIMAL({places + 1},{places}))"
    return f"CAST(CAST({whole} AS DECIMAL(18,0)) * {step} AS DECIMAL(18,{places}))"


def share(num: str, den: str) -> str:
    return f"coalesce({quotient(num, den, 4)}, CAST(0 AS DECIMAL(18,4)))"


def cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS BIGINT)"


def dollars(amount: str) -> str:
    return f"CAST(coalesce({amount}, 0) AS DECIMAL(18,2))"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def steps(value: str, results: list, *bounds) -> str:
    """Result picked by how many of the ascending bounds the value reaches."""
    picks = "[" + ", ".join(repr(r) for r in results) + "]"
    return f"{picks}[1 + " + " + ".join(f"CAST({value} >= {b} AS INTEGER)" for b in bounds) + "]"


_UNMET = "NOT is_current_customer AND account_lifecycle_stage IN ('prospect', 'won_not_subscribed')"
_SEGMENT_LIST = "['critical', 'at_risk', 'watch', 'healthy', 'not_customer']"
_PRIORITY = """CASE customer_health_segment
         WHEN 'critical' THEN CASE WHEN NOT is_current_customer THEN 'P5' WHEN big THEN 'P1' ELSE 'P2' END
         WHEN 'at_risk' THEN CASE WHEN big THEN 'P2' ELSE 'P3' END
         WHEN 'watch' THEN CASE WHEN current_mrr_usd >= 10000 THEN 'P3' ELSE 'P4' END ELSE 'P5' END"""
_RANK = """CASE customer_health_segment
         WHEN 'critical' THEN CASE WHEN is_current_customer THEN 1 ELSE 6 END
         WHEN 'at_risk' THEN CASE WHEN big THEN 2 ELSE 3 END
         WHEN 'watch' THEN CASE WHEN current_mrr_usd >= 10000 THEN 4 ELSE 5 END ELSE 7 END"""
# Position of the first true entry; 7 when none holds.
_EVIDENCE = """coalesce(nullif(list_position([account_lifecycle_stage = 'churned_customer', has_overdue_invoice,
         has_critical_ticket, payment_risk_flag, support_risk_flag, low_usage_paid_account], true), 0), 7)"""


def _money_sum(name: str) -> str:
    return f"CAST(SUM({name}) AS DECIMAL(18,2)) AS {name}"


def _sum(name: str) -> str:
    return f"CAST(SUM({name}) AS BIGINT) AS {name}"


def _mean(name: str, alias: str) -> str:
    return f"{quotient(f'SUM({name})', 'COUNT(*)', 2)} AS {alias}"


def _portion(name: str, alias: str) -> str:
    return f"{share(f'SUM(CAST({name} AS INTEGER))', 'COUNT(*)')} AS {alias}"


def _tally(name: str, alias: str) -> str:
    return f"CAST(SUM(CAST({name} AS INTEGER)) AS BIGINT) AS {alias}"


_GROUP = f"""COUNT(*) AS customer_count, {_tally("is_churn_risk", "churn_risk_customer_count")},
       {_money_sum("current_mrr_usd")}, {_money_sum("mrr_at_risk_usd")}"""

CTES = {
    "m_paid": """
SELECT invoice_id, COUNT(*) AS payment_count, SUM(amount_paid_usd) AS paid, min(payment_date) AS first_payment_date,
       max(payment_date) AS latest_payment_date
FROM s_payments WHERE payment_date < DATE '2026-01-01' GROUP BY invoice_id""",
    "m_invoices": f"""
SELECT invoice_id, subscription_id, billing_customer_id, account_id, invoice_date, due_date, amount_due_usd,
       invoice_status, left_over <= 0 AS is_paid, left_over > 0 AS is_open, {big("coalesce(payment_count, 0)")} AS payment_count,
       {dollars("paid")} AS total_paid_usd, first_payment_date, latest_payment_date,
       CAST(left_over AS DECIMAL(18,2)) AS outstanding_amount_usd, left_over <= 0 AS is_fully_paid,
       CAST(date_diff('day', invoice_date, first_payment_date) AS INTEGER) AS days_to_payment,
       left_over > 0 AND due_date < DATE '2025-12-31' AS is_overdue
FROM (SELECT *, amount_due_usd - coalesce(paid, 0) AS left_over FROM s_invoices LEFT JOIN m_paid USING (invoice_id))""",
    "m_invoiced": f"""
SELECT subscription_id, COUNT(*) AS invoice_count, {_tally("is_fully_paid", "paid_invoice_count")},
       {_tally("is_open", "open_invoice_count")}, {_tally("is_overdue", "overdue_invoice_count")},
       CAST(SUM(amount_due_usd) AS DECIMAL(18,2)) AS total_invoiced_usd, {_money_sum("total_paid_usd")},
       CAST(SUM(outstanding_amount_usd) AS DECIMAL(18,2)) AS total_outstanding_usd,
       min(invoice_date) AS first_invoice_date, max(invoice_date) AS latest_invoice_date,
       max(latest_payment_date) AS latest_payment_date,
       {quotient("SUM(days_to_payment)", "COUNT(days_to_payment)", 2)} AS avg_days_to_payment
FROM m_invoices GROUP BY subscription_id""",
    "m_subscriptions": f"""
SELECT s.subscription_id, s.billing_customer_id, s.account_id, a.account_name, a.industry, a.segment, a.country, s.plan,
       s.subscription_status, s.billing_cycle, s.mrr_usd, s.arr_usd, s.start_date, s.canceled_at, s.is_active,
       s.is_canceled, s.is_past_due, {", ".join(f"{big(f'coalesce({n}, 0)')} AS {n}" for n in
       ("invoice_count", "paid_invoice_count", "open_invoice_count", "overdue_invoice_count"))},
       {", ".join(f"{dollars(n)} AS {n}" for n in ("total_invoiced_usd", "total_paid_usd", "total_outstanding_usd"))},
       first_invoice_date, latest_invoice_date, latest_payment_date, avg_days_to_payment,
       {share(cents("coalesce(total_paid_usd, 0)"), cents("total_invoiced_usd"))} AS collection_rate,
       CASE subscription_status WHEN 'canceled' THEN CAST(0 AS DECIMAL(18,2)) ELSE mrr_usd END AS current_mrr_usd,
       CAST(date_diff('day', start_date, coalesce(canceled_at, DATE '2025-12-31')) AS INTEGER) AS subscription_age_days,
       coalesce(overdue_invoice_count, 0) <> 0 AS has_overdue_invoice
FROM s_subscriptions s JOIN s_accounts a USING (account_id) LEFT JOIN m_invoiced USING (subscription_id)""",
    "m_revenue": f"""
SELECT account_id, COUNT(*) AS subscription_count, {_tally("is_active", "active_subscription_count")},
       {_tally("is_past_due", "past_due_subscription_count")}, {_tally("is_canceled", "canceled_subscription_count")},
       {", ".join(_money_sum(n) for n in
       ("current_mrr_usd", "total_invoiced_usd", "total_paid_usd", "total_outstanding_usd"))},
       max(latest_invoice_date) AS latest_invoice_date, max(latest_payment_date) AS latest_payment_date,
       bool_or(has_overdue_invoice) AS has_overdue_invoice,
       {quotient("SUM(CAST(collection_rate * 10000 AS BIGINT))", "10000 * COUNT(*)", 4)} AS avg_collection_rate,
       {quotient("SUM(CAST(avg_days_to_payment * 100 AS BIGINT))", "100 * COUNT(avg_days_to_payment)", 2)} AS avg_days_to_payment
FROM m_subscriptions GROUP BY account_id""",
    "m_contacts": f"""
SELECT account_id, COUNT(*) AS contact_count, {_tally("contact_role = 'Executive Sponsor'", "executive_sponsor_count")},
       {_tally("contact_role = 'Admin'", "admin_contact_count")} FROM s_contacts GROUP BY account_id""",
    "m_won": """
SELECT account_id, COUNT(*) AS won_deals, CAST(SUM(deal_amount_usd) AS DECIMAL(18,2)) AS won_deal_amount_usd,
       CAST(SUM(expected_mrr_usd) AS DECIMAL(18,2)) AS won_expected_mrr_usd, max(close_date) AS latest_won_close_date
FROM s_deals WHERE deal_stage = 'closed_won' GROUP BY account_id""",
    "m_deals": f"""
SELECT account_id, total_deals, {big("coalesce(won_deals, 0)")} AS won_deals, lost_deals, won_deal_amount_usd,
       won_expected_mrr_usd, first_deal_created_at, latest_won_close_date
FROM (SELECT account_id, COUNT(*) AS total_deals, {_tally("deal_stage = 'closed_lost'", "lost_deals")},
             min(created_at) AS first_deal_created_at FROM s_deals GROUP BY account_id)
LEFT JOIN m_won USING (account_id)""",
    "m_contracts": f"""
SELECT account_id, COUNT(*) AS subscription_count, {_tally("is_active", "active_subscription_count")},
       {_tally("is_past_due", "past_due_subscription_count")}, {_tally("is_canceled", "canceled_subscription_count")},
       CAST(SUM(CASE WHEN canceled_at IS NULL THEN mrr_usd END) AS DECIMAL(18,2)) AS current_mrr_usd,
       CAST(SUM(CASE WHEN canceled_at IS NULL THEN arr_usd END) AS DECIMAL(18,2)) AS current_arr_usd,
       min(start_date) AS first_subscription_start_date, max(canceled_at) AS latest_canceled_at
FROM s_subscriptions GROUP BY account_id""",
    "m_base": f"""
SELECT a.* EXCLUDE (created_at, account_owner), a.created_at AS account_created_at, a.account_owner,
       {", ".join(f"{big(f'coalesce({n}, 0)')} AS {n}" for n in
       ("contact_count", "executive_sponsor_count", "admin_contact_count", "total_deals", "won_deals", "lost_deals",
        "subscription_count", "active_subscription_count", "past_due_subscription_count", "canceled_subscription_count"))},
       {", ".join(f"{dollars(n)} AS {n}" for n in
       ("won_deal_amount_usd", "won_expected_mrr_usd", "current_mrr_usd", "current_arr_usd"))},
       first_deal_created_at, latest_won_close_date, billing_customer_id, first_subscription_start_date, latest_canceled_at,
       ['active_customer', 'past_due_customer', 'churned_customer', 'won_not_subscribed', 'prospect'][
         list_position([active_subscription_count > 0, past_due_subscription_count > 0,
                        canceled_subscription_count > 0, won_deals > 0, true], true)] AS account_lifecycle_stage
FROM s_accounts a LEFT JOIN m_contacts USING (account_id) LEFT JOIN m_deals USING (account_id)
LEFT JOIN s_customers b USING (account_id) LEFT JOIN m_contracts USING (account_id)""",
    "m_usage": f"""
SELECT account_id, COUNT(*) AS total_events, COUNT(DISTINCT user_id) AS active_users,
       COUNT(DISTINCT event_date) AS active_days, min(event_date) AS first_event_date, max(event_date) AS latest_event_date,
       {_tally("event_type = 'login'", "login_events")}, {_tally("event_type = 'dashboard_viewed'", "dashboard_view_events")},
       {_tally("event_type = 'report_created'", "report_created_events")},
       {_tally("event_type = 'integration_connected'", "integration_connected_events")},
       {_tally("event_type = 'user_invited'", "user_invited_events")},
       {_tally("event_type = 'export_downloaded'", "export_downloaded_events")},
       COUNT(DISTINCT event_type) AS adopted_feature_count,
       {steps("COUNT(*)", ["no_usage", "low_usage", "medium_usage", "high_usage"], 1, 150, 500)} AS usage_intensity,
       bool_or(event_type = 'integration_connected') AS has_connected_integration,
       bool_or(event_type = 'report_created') AS has_created_report
FROM s_events WHERE event_date > DATE '2025-12-31' - 90 AND event_date <= DATE '2025-12-31' GROUP BY account_id""",
    "m_tickets": f"""
SELECT *, ['low_burden', 'medium_burden', 'high_burden'][greatest(
         1 + CAST(total_tickets >= 4 AS INTEGER) + CAST(total_tickets >= 8 AS INTEGER),
         1 + CAST(high_priority_tickets >= 1 AS INTEGER) + CAST(high_priority_tickets >= 3 AS INTEGER))] AS support_burden_level,
       open_tickets <> 0 AS has_open_tickets, critical_tickets <> 0 AS has_critical_ticket
FROM (SELECT account_id, COUNT(*) AS total_tickets, {_tally("is_open", "open_tickets")},
             {_tally("is_resolved", "resolved_tickets")}, {_tally("is_open AND is_high_priority", "high_priority_tickets")},
             {_tally("is_open AND severity = 'critical'", "critical_tickets")}, {_tally("severity = 'high'", "high_tickets")},
             {_tally("severity = 'medium'", "medium_tickets")}, {_tally("severity = 'low'", "low_tickets")},
             min(created_date) AS first_ticket_date, max(created_date) AS latest_ticket_date,
             {quotient("SUM(resolution_days)", "COUNT(resolution_days)", 2)} AS avg_resolution_days
      FROM s_tickets WHERE created_date < DATE '2026-01-01' GROUP BY account_id)""",
    "m_signals": f"""
SELECT b.account_id, account_name, industry, segment, employee_band, country, account_owner, account_lifecycle_stage,
       contact_count, executive_sponsor_count, admin_contact_count,
       {", ".join(f"{big(f'coalesce({n}, 0)')} AS {n.split('.')[1]}" for n in
       ("r.subscription_count", "r.active_subscription_count", "r.past_due_subscription_count",
        "r.canceled_subscription_count", "u.total_events", "u.active_users", "u.active_days", "u.adopted_feature_count",
        "t.total_tickets", "t.open_tickets", "t.resolved_tickets", "t.high_priority_tickets", "t.critical_tickets"))},
       {", ".join(f"{dollars('r.' + n)} AS {n}" for n in
       ("current_mrr_usd", "total_invoiced_usd", "total_paid_usd", "total_outstanding_usd"))},
       latest_invoice_date, latest_payment_date, first_event_date, latest_event_date, latest_ticket_date,
       avg_days_to_payment, avg_resolution_days,
       {", ".join(f"coalesce({n}, false) AS {n}" for n in
       ("has_overdue_invoice", "has_connected_integration", "has_created_report", "has_open_tickets",
        "has_critical_ticket"))},
       coalesce(avg_collection_rate, CAST(0 AS DECIMAL(18,4))) AS avg_collection_rate,
       coalesce(usage_intensity, 'no_usage') AS usage_intensity,
       coalesce(support_burden_level, 'no_burden') AS support_burden_level,
       coalesce(r.active_subscription_count + r.past_due_subscription_count > 0 OR r.current_mrr_usd > 0, false)
         AS is_current_customer
FROM m_base b LEFT JOIN m_revenue r USING (account_id) LEFT JOIN m_usage u USING (account_id)
LEFT JOIN m_tickets t USING (account_id)""",
    "m_flags": f"""
SELECT *, is_current_customer AND total_events < 150 AS low_usage_paid_account,
       has_overdue_invoice OR past_due_subscription_count > 0
         OR (total_invoiced_usd <> 0 AND avg_collection_rate * 10 < 9) AS payment_risk_flag,
       critical_tickets > 0 OR greatest(high_priority_tickets, open_tickets) > 2 AS support_risk_flag
FROM m_signals""",
    "m_scores": f"""
SELECT *, {steps("total_events", [0, 8, 25, 35], 1, 150, 500)} AS usage_score,
       {steps("adopted_feature_count", [0, 5, 12, 20], 1, 3, 5)} AS adoption_score,
       CASE WHEN has_overdue_invoice OR NOT is_current_customer THEN 0
            ELSE CASE WHEN past_due_subscription_count <> 0 THEN 5
                      ELSE CASE WHEN total_invoiced_usd = 0 THEN 18
                                ELSE {steps("avg_collection_rate", [0, 5, 10, 18, 25], "0.0001", "0.75", "0.9", "0.98")}
                           END END END AS payment_score,
       [0, 3, 6, 8, 11, 15][list_position([critical_tickets > 0, high_priority_tickets > 2, open_tickets > 2,
          support_burden_level = 'high_burden', support_burden_level = 'medium_burden', true], true)] AS support_score,
       [0, 1, 3, 5][1 + CAST(contact_count > 0 AS INTEGER) + CAST(executive_sponsor_count > 0 AS INTEGER)
          + CAST(admin_contact_count > 0 AS INTEGER)] AS relationship_score
FROM m_flags""",
    "m_scored": f"""
SELECT *, least(raw_customer_health_score,
         CASE WHEN {_UNMET} THEN 100 WHEN account_lifecycle_stage = 'churned_customer' THEN 20
              WHEN critical_tickets > 0 OR has_overdue_invoice THEN 49 WHEN any_flag THEN 64 ELSE 100 END
       ) AS customer_health_score
FROM (SELECT *, usage_score + adoption_score + payment_score + support_score + relationship_score
               AS raw_customer_health_score,
             low_usage_paid_account OR payment_risk_flag OR support_risk_flag AS any_flag FROM m_scores)""",
    "m_health": f"""
SELECT * EXCLUDE (any_flag),
       {_SEGMENT_LIST}[CASE WHEN {_UNMET} THEN 5 WHEN account_lifecycle_stage = 'churned_customer' THEN 1
         ELSE 1 + CAST(customer_health_score >= 35 AS INTEGER) + CAST(customer_health_score >= 60 AS INTEGER)
                + CAST(customer_health_score >= 80 AS INTEGER) END] AS customer_health_segment,
       NOT ({_UNMET}) AND (any_flag OR account_lifecycle_stage = 'churned_customer') AS is_churn_risk
FROM m_scored""",
    "m_customer_health": f"""
SELECT * EXCLUDE (subscription_count, active_subscription_count, past_due_subscription_count,
                  canceled_subscription_count, latest_invoice_date, latest_payment_date, first_event_date,
                  latest_event_date, resolved_tickets, latest_ticket_date, avg_resolution_days),
       ['Escalate immediately', 'Prioritize intervention', 'Monitor and drive adoption', 'Maintain and expand',
        'Exclude from customer health motion'][list_position({_SEGMENT_LIST}, customer_health_segment)] AS recommended_action,
       CAST(list_position({_SEGMENT_LIST}, customer_health_segment) AS INTEGER) AS health_priority_rank
FROM m_health""",
    "m_360": f"""
SELECT * EXCLUDE (usage_score, adoption_score, payment_score, support_score, relationship_score, live, big),
       CASE WHEN live THEN 'Customer' ELSE map {{'won_not_subscribed': 'Won - Not Subscribed', 'prospect': 'Prospect',
         'churned_customer': 'Churned Customer'}}[account_lifecycle_stage] END AS account_status_group,
       {dollars("CASE WHEN live AND is_churn_risk THEN current_mrr_usd END")} AS mrr_at_risk_usd,
       {dollars("CASE WHEN live AND customer_health_segment = 'healthy' THEN current_mrr_usd END")} AS healthy_mrr_usd,
       {dollars("CASE WHEN live AND customer_health_segment <> 'healthy' THEN current_mrr_usd END")} AS non_healthy_mrr_usd,
       CASE WHEN live THEN {steps("current_mrr_usd", ["unknown", "low_value", "mid_value", "high_value"], "0.01", 5000, 10000)}
            ELSE 'non_customer' END AS revenue_tier,
       CASE WHEN live THEN CASE customer_health_segment
              WHEN 'critical' THEN CASE WHEN big THEN 'P1 - Executive escalation' ELSE 'P2 - Immediate CS escalation' END
              WHEN 'at_risk' THEN CASE WHEN big THEN 'P2 - High-value rescue plan' ELSE 'P3 - CS intervention' END
              WHEN 'watch' THEN 'P4 - Adoption playbook'
              WHEN 'healthy' THEN CASE WHEN big THEN 'Expansion candidate' ELSE 'Maintain' END ELSE 'Review' END
            WHEN account_lifecycle_stage = 'churned_customer' THEN 'Churned - winback review'
            ELSE 'No customer action' END AS account_priority_action
FROM (SELECT *, is_current_customer AS live, current_mrr_usd >= 5000 AS big FROM m_customer_health)""",
    "m_churn": f"""
SELECT account_id, account_name, industry, segment, employee_band, country, account_owner, account_lifecycle_stage,
       account_status_group, customer_health_segment, account_priority_action, revenue_tier, customer_health_score,
       raw_customer_health_score, current_mrr_usd, mrr_at_risk_usd, usage_intensity, total_events, active_users,
       active_days, adopted_feature_count, low_usage_paid_account, support_burden_level, total_tickets, open_tickets,
       high_priority_tickets, critical_tickets, has_open_tickets, has_critical_ticket, support_risk_flag,
       has_overdue_invoice, total_outstanding_usd, avg_collection_rate, avg_days_to_payment, payment_risk_flag,
       ['churned_customer', 'overdue_invoice', 'critical_support_ticket', 'payment_risk', 'support_risk',
        'low_product_usage', 'general_risk'][{_EVIDENCE}] AS primary_risk_reason,
       ['closed_loss_or_churn_review', 'finance_collection_and_cs_outreach', 'support_escalation', 'payment_follow_up',
        'support_follow_up', 'adoption_intervention', 'manual_review'][{_EVIDENCE}] AS recommended_risk_playbook,
       {_PRIORITY} AS risk_priority, {_RANK} AS risk_priority_rank
FROM (SELECT *, current_mrr_usd >= 5000 AS big FROM m_360 WHERE is_churn_risk)""",
    "m_retention": f"""
SELECT customer_health_segment, revenue_tier, account_priority_action, {_GROUP}, {_money_sum("healthy_mrr_usd")},
       {_money_sum("non_healthy_mrr_usd")}, {_mean("customer_health_score", "avg_customer_health_score")},
       {_mean("raw_customer_health_score", "avg_raw_customer_health_score")},
       {share(cents("SUM(mrr_at_risk_usd)"), cents("SUM(current_mrr_usd)"))} AS mrr_at_risk_rate,
       {_portion("is_churn_risk", "customer_risk_rate")}
FROM m_360 WHERE is_current_customer GROUP BY ALL""",
    "m_adoption": f"""
SELECT customer_health_segment, revenue_tier, usage_intensity, {_GROUP}, {_sum("total_events")}, {_sum("active_users")},
       {_sum("active_days")}, {_mean("total_events", "avg_events_per_account")}, {_mean("active_users", "avg_active_users")},
       {_mean("active_days", "avg_active_days")}, {_mean("adopted_feature_count", "avg_adopted_feature_count")},
       {_mean("customer_health_score", "avg_customer_health_score")},
       {_tally("has_connected_integration", "accounts_with_integration")},
       {_tally("has_created_report", "accounts_with_created_report")},
       {_tally("low_usage_paid_account", "low_usage_paid_accounts")},
       {_portion("has_connected_integration", "integration_adoption_rate")},
       {_portion("has_created_report", "report_creation_rate")},
       {_portion("low_usage_paid_account", "low_usage_paid_account_rate")}
FROM m_360 WHERE is_current_customer GROUP BY ALL""",
    "m_operations": f"""
SELECT customer_health_segment, revenue_tier, support_burden_level, {_GROUP}, {_sum("total_tickets")},
       {_sum("open_tickets")}, {_sum("high_priority_tickets")}, {_sum("critical_tickets")},
       {_tally("has_open_tickets", "accounts_with_open_tickets")},
       {_tally("has_critical_ticket", "accounts_with_critical_ticket")},
       {_tally("support_risk_flag", "support_risk_accounts")}, {_mean("total_tickets", "avg_tickets_per_account")},
       {_mean("open_tickets", "avg_open_tickets_per_account")},
       {_mean("high_priority_tickets", "avg_high_priority_tickets_per_account")},
       {_mean("critical_tickets", "avg_critical_tickets_per_account")},
       {_mean("customer_health_score", "avg_customer_health_score")},
       {_portion("has_open_tickets", "open_ticket_account_rate")},
       {_portion("has_critical_ticket", "critical_ticket_account_rate")},
       {_portion("support_risk_flag", "support_risk_account_rate")}
FROM m_360 WHERE is_current_customer GROUP BY ALL""",
}

_USAGE_FLAGS = "account_id, usage_intensity, has_connected_integration, has_created_report"

ANSWERS = {
    "payments_as_of": "SELECT * FROM s_payments WHERE payment_date < DATE '2026-01-01'",
    "tickets_as_of": "SELECT * FROM s_tickets WHERE created_at < TIMESTAMP '2026-01-01'",
    "events_in_window": """SELECT * FROM s_events
WHERE occurred_at >= TIMESTAMP '2025-10-03' AND occurred_at < TIMESTAMP '2026-01-01'""",
    "current_customers": "SELECT * FROM m_360 WHERE is_current_customer",
    "risk_accounts": "SELECT * FROM m_360 WHERE is_churn_risk",
    "contacts_by_account": "SELECT * FROM m_contacts",
    "deals_by_account": "SELECT * FROM m_deals",
    "subscriptions_by_account": "SELECT * FROM m_contracts",
    "payments_by_invoice": """SELECT invoice_id, payment_count, CAST(paid AS DECIMAL(18,2)) AS total_paid_usd,
       first_payment_date, latest_payment_date FROM m_paid""",
    "invoices_by_subscription": "SELECT * FROM m_invoiced",
    "revenue_by_account": "SELECT * FROM m_revenue",
    "usage_by_account": f"SELECT * EXCLUDE ({_USAGE_FLAGS}), account_id FROM m_usage",
    "tickets_by_account": "SELECT * EXCLUDE (support_burden_level, has_open_tickets, has_critical_ticket) FROM m_tickets",
    "invoice_payment_summary": "SELECT * FROM m_invoices",
    "subscriptions_enriched": "SELECT * FROM m_subscriptions",
    "account_base": "SELECT * FROM m_base",
    "account_usage": "SELECT * FROM m_usage",
    "account_ticket_summary": "SELECT * FROM m_tickets",
    "health_signals": "SELECT * FROM m_health",
    "mart_customer_health": "SELECT * FROM m_customer_health",
    "mart_account_360": "SELECT * FROM m_360",
    "mart_churn_risk": "SELECT * FROM m_churn",
    "mart_revenue_retention": "SELECT * FROM m_retention",
    "mart_product_adoption": "SELECT * FROM m_adoption",
    "mart_support_operations": "SELECT * FROM m_operations",
    # Single policy rules, one row per entity they apply to.
    "lifecycle_stage": "SELECT account_id, account_lifecycle_stage FROM m_base",
    "usage_intensity": "SELECT account_id, usage_intensity FROM m_usage",
    "support_burden": "SELECT account_id, support_burden_level FROM m_tickets",
    "is_current_customer": "SELECT account_id, is_current_customer FROM m_signals",
    "risk_flags": "SELECT account_id, low_usage_paid_account, payment_risk_flag, support_risk_flag FROM m_flags",
    "usage_and_adoption_scores": "SELECT account_id, usage_score, adoption_score FROM m_scores",
    "payment_score": "SELECT account_id, payment_score FROM m_scores",
    "support_and_relationship_scores": "SELECT account_id, support_score, relationship_score FROM m_scores",
    "health_score": "SELECT account_id, raw_customer_health_score, customer_health_score FROM m_scored",
    "health_segment": "SELECT account_id, customer_health_segment, is_churn_risk FROM m_health",
    "recommended_action": "SELECT account_id, recommended_action, health_priority_rank FROM m_customer_health",
    "account_status_group": "SELECT account_id, account_status_group FROM m_360",
    "mrr_at_risk": "SELECT account_id, mrr_at_risk_usd FROM m_360",
    "healthy_and_other_mrr": "SELECT account_id, healthy_mrr_usd, non_healthy_mrr_usd FROM m_360",
    "revenue_tier": "SELECT account_id, revenue_tier FROM m_360",
    "account_priority_action": "SELECT account_id, account_priority_action FROM m_360",
    "primary_risk_reason": "SELECT account_id, primary_risk_reason FROM m_churn",
    "risk_playbook": "SELECT account_id, recommended_risk_playbook FROM m_churn",
    "risk_priority": "SELECT account_id, risk_priority FROM m_churn",
    "risk_priority_rank": "SELECT account_id, risk_priority_rank FROM m_churn",
    "subscription_age_days": "SELECT subscription_id, subscription_age_days FROM m_subscriptions",
    "collection_rate": "SELECT subscription_id, collection_rate, current_mrr_usd FROM m_subscriptions",
    "invoice_state": """SELECT invoice_id, is_paid, is_open, outstanding_amount_usd, is_fully_paid, days_to_payment,
       is_overdue FROM m_invoices""",
    "adoption_flags": "SELECT account_id, has_connected_integration, has_created_report FROM m_usage",
    "ticket_flags": "SELECT account_id, has_open_tickets, has_critical_ticket FROM m_tickets",
    "revenue_rates": "SELECT customer_health_segment, revenue_tier, account_priority_action, mrr_at_risk_rate, customer_risk_rate FROM m_retention",
    "adoption_rates": """SELECT customer_health_segment, revenue_tier, usage_intensity, integration_adoption_rate,
       report_creation_rate, low_usage_paid_account_rate FROM m_adoption""",
    "support_rates": """SELECT customer_health_segment, revenue_tier, support_burden_level, open_ticket_account_rate,
       critical_ticket_account_rate, support_risk_account_rate FROM m_operations""",
    # Month steps are counted from the start month and compared as dates.
    "expected_invoice_schedule": f"""
SELECT subscription_id, billing_customer_id, account_id, invoice_date, invoice_date + 15 AS due_date,
       CAST(CASE billing_cycle WHEN 'annual' THEN arr_usd ELSE mrr_usd END AS DECIMAL(18,2)) AS amount_due_usd
FROM (SELECT *, CAST(date_trunc('month', start_date) + to_months(CAST(step AS INTEGER)) AS DATE) AS invoice_date
      FROM (SELECT *, unnest(range(0, 1 + date_diff('month', start_date, DATE '2025-12-31'))) AS step FROM s_subscriptions))
WHERE invoice_date <= coalesce(canceled_at, DATE '2025-12-31')
  AND (billing_cycle = 'monthly' OR month(invoice_date) = month(start_date))""",
}
