"""Every operator as a named query over a folder of base tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revpulse import faults
from revpulse.operators import contracts, customer, invariants, marts, monitoring, product, raw_checks, revenue, support
from revpulse.params import Params
from revpulse.operators.keys import union_all
from revpulse.plans.build import derive, publish_layers, row_counts
from revpulse.plans.contracts import CONTRACTS, run_contracts
from revpulse.plans.relations import Warehouse, in_layer
from revpulse.schemas import CATALOG, ENTITIES, catalog_rows
from revpulse.session import fresh_folder, shared_folder
from revpulse.sources.bound import BASE_SCHEMAS, DEALT, LINE_MADE, BoundTables, bind, run_log
from revpulse.sources.files import read_raw, source_path, source_report, write_raw
from revpulse.sources.snapshot import (
    count_entities,
    open_snapshot,
    publish_snapshot,
    read_load_audit,
    reload_is_idempotent,
    table_fingerprint,
)
from revpulse.sources.snapshot import row_counts as load_rows
from revpulse.sources.warehouse import materialize_mart, register_view

Query = Callable[[SparkSession, str], DataFrame]
LOADED_AT = dt.datetime(2026, 1, 1, 6, 0)
OBSERVED_AT = dt.datetime(2026, 1, 1, 7, 0)
FIRST_LOADED_AT = dt.datetime(2025, 12, 31, 6, 0)
RUN_ID = "run_of_record"
SHORT_NAMES = {
    "accounts": "crm_accounts",
    "contacts": "crm_contacts",
    "deals": "crm_deals",
    "billing_customers": "billing_customers",
    "subscriptions": "billing_subscriptions",
    "invoices": "billing_invoices",
    "payments": "billing_payments",
    "events": "product_events",
    "tickets": "support_tickets",
}
STAGED = {
    "stg_accounts": "stg_crm__accounts",
    "stg_contacts": "stg_crm__contacts",
    "stg_deals": "stg_crm__deals",
    "stg_billing_customers": "stg_billing__customers",
    "stg_subscriptions": "stg_billing__subscriptions",
    "stg_invoices": "stg_billing__invoices",
    "stg_payments": "stg_billing__payments",
    "stg_events": "stg_product__events",
    "stg_tickets": "stg_support__tickets",
}


def warehouse(spark: SparkSession, folder: str) -> Warehouse:
    """All relations, lazily, straight from the base tables."""
    return Warehouse(bind(spark, folder), Params())


def _listing(spark: SparkSession, folder: str) -> tuple:
    """Name, size and time of every file of the base tables, so that changed files are a new state."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = []
    for table in BASE_SCHEMAS:
        path = hadoop.Path(f"{folder.rstrip('/')}/{table}.parquet")
        files = path.getFileSystem(conf).listFiles(path, True)
        while files.hasNext():
            f = files.next()
            found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(found))


@lru_cache(maxsize=4)
def _lines(application: str, spark: SparkSession, folder: str, listing: tuple) -> str:
    """The folder that the subscribed lines were stored in."""
    path = fresh_folder(spark, "lines")
    bind(spark, folder).store_lines(path)
    return path


def stored_tables(spark: SparkSession, folder: str) -> BoundTables:
    """The base tables with the subscribed lines stored once per session, for what reads them several times."""
    tables = bind(spark, folder)
    tables.take_lines(_lines(spark.sparkContext.applicationId, spark, folder, _listing(spark, folder)))
    return tables


@lru_cache(maxsize=4)
def _load(application: str, spark: SparkSession, folder: str, listing: tuple) -> str:
    """Two loads, the first of accounts alone; the folder they were published in."""
    root, tables = fresh_folder(spark, "snapshot"), stored_tables(spark, folder)
    publish_snapshot(spark, {"crm_accounts": tables["crm_accounts"]}, root, FIRST_LOADED_AT)
    publish_snapshot(spark, tables, root, LOADED_AT, dealt=DEALT)
    return root


@lru_cache(maxsize=4)
def _derived(application: str, spark: SparkSession, folder: str, listing: tuple) -> Warehouse:
    w = loaded(spark, folder)
    derive(w, spark, fresh_folder(spark, "warehouse"))
    return w


def load_folder(spark: SparkSession, folder: str) -> str:
    return _load(spark.sparkContext.applicationId, spark, folder, _listing(spark, folder))


def loaded(spark: SparkSession, folder: str) -> Warehouse:
    """The sources published once per session, as checks and audits find them after a load."""
    return Warehouse(open_snapshot(spark, load_folder(spark, folder)), Params())


def derived(spark: SparkSession, folder: str) -> Warehouse:
    """The loaded sources with the shared relations and marts written out."""
    return _derived(spark.sparkContext.applicationId, spark, folder, _listing(spark, folder))


def _relation(name: str) -> Query:
    return lambda spark, folder: warehouse(spark, folder)[name]


def _over_lines(name: str) -> Query:
    """A relation from the base tables that reads several of the entities made of lines."""
    return lambda spark, folder: Warehouse(stored_tables(spark, folder), Params())[name]


def _over(relation: str, op: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: op(warehouse(spark, folder)[relation])


def _columns(relation: str, *columns: str) -> Query:
    return lambda spark, folder: warehouse(spark, folder)[relation].select(*columns)


def _rule(relation: str, *columns: str) -> Query:
    """Columns of one relation, derived anew from the written relations before it."""

    def query(spark, folder):
        w = derived(spark, folder)
        return Warehouse(w.sources, w.params, w.policy, w.written(without=relation))[relation].select(*columns)

    return query


def _on_derived(op: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: op(derived(spark, folder))


def _sources() -> dict[str, Query]:
    raw = {f"raw_{e}": _relation(e) for e in ENTITIES}

    def from_csv(entity: str) -> Query:
        def query(spark, folder):
            path = source_path(fresh_folder(spark, "csv"), entity)
            write_raw(stored_tables(spark, folder)[entity] if entity in LINE_MADE else bind(spark, folder)[entity], path)
            return read_raw(spark, entity, path)

        return query

    def from_text(stage: str, entity: str) -> Query:
        """A staging relation over columns that are all text, with empty text for no value."""

        def query(spark, folder):
            df = bind(spark, folder)[entity]
            text = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))
            return Warehouse({entity: text}, Params())[stage]

        return query

    def sources(spark, folder):
        """Seven of nine files are there."""
        path, tables = fresh_folder(spark, "csv"), stored_tables(spark, folder)
        for entity in set(ENTITIES) - {"crm_contacts", "billing_payments"}:
            write_raw(tables[entity], source_path(path, entity))
        return source_report(spark, path)

    def catalog(spark, folder):
        """Every column of every source, with the rows of a load and those that have a value."""
        tables, rows = loaded(spark, folder).sources, catalog_rows()

        def filled(entity: str) -> DataFrame:
            counts = [F.struct(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("row_count"), F.count(c).alias("filled_rows")) for c in ENTITIES[entity].columns]
            return tables[entity].agg(F.array(*counts).alias("columns")).select(F.lit(entity).alias("source_name"), F.inline("columns"))

        counted = union_all(filled(entity) for entity in ENTITIES)
        return spark.createDataFrame(rows, CATALOG).join(F.broadcast(counted), ["source_name", "column_name"])  # a row for each column

    def layers(spark, folder):
        """Rows of every relation, found by ``layer.name`` in a second session."""
        names = publish_layers(derived(spark, folder), spark, fresh_folder(spark, "layers"))
        second = spark.newSession()
        return union_all(
            second.table(name).agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name.split(".")[0]).alias("schema_name"), F.lit(name.split(".")[1]).alias("relation_name"), "row_count"
            )
            for name in names
        )

    def reload(spark, folder):
        """Both loads of one session, and an account count through a view made before the second."""
        target, tables = fresh_folder(spark, "snapshot"), stored_tables(spark, folder)
        first = publish_snapshot(spark, tables, target, LOADED_AT, dealt=DEALT)
        before = table_fingerprint(first)
        register_view(first["crm_accounts"], "loaded_accounts")
        spark.sql("CREATE OR REPLACE TEMPORARY VIEW counted_accounts AS SELECT count(*) AS n FROM loaded_accounts")
        second = publish_snapshot(spark, tables, target, OBSERVED_AT, dealt=DEALT)
        register_view(second["crm_accounts"], "loaded_accounts")
        same = reload_is_idempotent(before, table_fingerprint(second))
        seen = spark.table("counted_accounts").select(
            F.lit("view of crm_accounts").alias("table_name"),
            F.lit(first["crm_accounts"].count()).alias("rows_before"),
            F.col("n").alias("rows_after"),
        )
        return same.union(seen.withColumn("unchanged", F.col("rows_before") == F.col("rows_after")))

    def view(spark, folder):
        name = register_view(warehouse(spark, folder)["stg_billing__subscriptions"], "stg_billing__subscriptions")
        return spark.sql(
            f"SELECT plan, count(*) AS subscriptions, CAST(sum(mrr_usd) AS DECIMAL(18,2)) AS mrr_usd "
            f"FROM {name} WHERE is_active GROUP BY plan"
        )

    def table(spark, folder):
        df = derived(spark, folder)["mart_revenue_retention"]
        return spark.table(materialize_mart(spark, df, "mart_revenue_retention", "marts", shared_folder(spark)))

    return {
        **raw,
        **{f"read_raw_{short}": from_csv(entity) for short, entity in SHORT_NAMES.items()},
        **{f"stg_{short}_from_text": from_text(STAGED[f"stg_{short}"], entity) for short, entity in SHORT_NAMES.items()},
        "publish_snapshot": lambda spark, folder: table_fingerprint(loaded(spark, folder).sources),
        "table_fingerprint": lambda spark, folder: table_fingerprint(bind(spark, folder)),
        "load_audit": lambda spark, folder: read_load_audit(spark, load_folder(spark, folder)),
        "count_entities": lambda spark, folder: count_entities(bind(spark, folder), LOADED_AT),
        "reload_is_idempotent": reload,
        "register_view": view,
        "layered_views": layers,
        "check_sources": sources,
        "source_catalog": catalog,
        "materialize_mart": table,
        "table_row_counts": _on_derived(lambda w: row_counts(w, RUN_ID, OBSERVED_AT)),
    }


def _models() -> dict[str, Query]:
    p = Params()
    staged = {
        **STAGED,
        "invoice_payment_summary": "int_revenue__invoice_payment_summary",
        "subscriptions_enriched": "int_revenue__subscriptions_enriched",
        "account_base": "int_customer__account_base",
        "account_ticket_summary": "int_support__account_ticket_summary",
        "health_signals": "int_customer__health_signals",
        **{m: m for m in in_layer("marts")},
    }
    subs, events, tickets = "stg_billing__subscriptions", "stg_product__events", "stg_support__tickets"
    invoices, enriched = "int_revenue__invoice_payment_summary", "int_revenue__subscriptions_enriched"
    return {
        **{query: _relation(name) if query in STAGED else _over_lines(name) for query, name in staged.items()},
        "account_usage": lambda spark, folder: loaded(spark, folder)["int_product__account_usage"],
        "events_in_window": lambda spark, folder: product.events_in_window(loaded(spark, folder).recent_events, p),
        "payments_as_of": _over("stg_billing__payments", lambda d: revenue.payments_as_of(d, p)),
        "tickets_as_of": _over(tickets, lambda d: support.tickets_as_of(d, p)),
        "current_customers": _over("mart_account_360", marts.current_customers),
        "risk_accounts": _over("mart_account_360", marts.risk_accounts),
        "contacts_by_account": _over("stg_crm__contacts", customer.contacts_by_account),
        "deals_by_account": _over("stg_crm__deals", customer.deals_by_account),
        "subscriptions_by_account": _over(subs, customer.subscriptions_by_account),
        "payments_by_invoice": _over("stg_billing__payments", lambda d: revenue.payments_by_invoice(d, p)),
        "invoices_by_subscription": _over(invoices, revenue.invoices_by_subscription),
        "revenue_by_account": lambda spark, folder: revenue.revenue_by_account(
            warehouse(spark, folder).subscription_facts
        ),
        "usage_by_account": lambda spark, folder: product.usage_by_account(_over_lines(events)(spark, folder), p),
        "tickets_by_account": _over(tickets, lambda d: support.tickets_by_account(d, p)),
        "expected_invoice_schedule": _over(subs, lambda d: revenue.expected_invoice_schedule(d, p)),
        "subscription_age_days": _columns(enriched, "subscription_id", "subscription_age_days"),
        "collection_rate": _columns(enriched, "subscription_id", "collection_rate", "current_mrr_usd"),
        "invoice_state": _columns(
            invoices,
            "invoice_id",
            "is_paid",
            "is_open",
            "outstanding_amount_usd",
            "is_fully_paid",
            "days_to_payment",
            "is_overdue",
        ),
    }


def _policy() -> dict[str, Query]:
    signals, m360, risk = "int_customer__health_signals", "mart_account_360", "mart_churn_risk"
    usage, load = "int_product__account_usage", "int_support__account_ticket_summary"
    per_account = {
        "lifecycle_stage": ("int_customer__account_base", "account_lifecycle_stage"),
        "usage_intensity": (usage, "usage_intensity"),
        "support_burden": (load, "support_burden_level"),
        "is_current_customer": (signals, "is_current_customer"),
        "risk_flags": (signals, "low_usage_paid_account", "payment_risk_flag", "support_risk_flag"),
        "usage_and_adoption_scores": (signals, "usage_score", "adoption_score"),
        "payment_score": (signals, "payment_score"),
        "support_and_relationship_scores": (signals, "support_score", "relationship_score"),
        "health_score": (signals, "raw_customer_health_score", "customer_health_score"),
        "health_segment": (signals, "customer_health_segment", "is_churn_risk"),
        "recommended_action": ("mart_customer_health", "recommended_action", "health_priority_rank"),
        "account_status_group": (m360, "account_status_group"),
        "mrr_at_risk": (m360, "mrr_at_risk_usd"),
        "healthy_and_other_mrr": (m360, "healthy_mrr_usd", "non_healthy_mrr_usd"),
        "revenue_tier": (m360, "revenue_tier"),
        "account_priority_action": (m360, "account_priority_action"),
        "primary_risk_reason": (risk, "primary_risk_reason"),
        "risk_playbook": (risk, "recommended_risk_playbook"),
        "risk_priority": (risk, "risk_priority"),
        "risk_priority_rank": (risk, "risk_priority_rank"),
        "adoption_flags": (usage, "has_connected_integration", "has_created_report"),
        "ticket_flags": (load, "has_open_tickets", "has_critical_ticket"),
    }
    segment = ("customer_health_segment", "revenue_tier")
    rates = {
        "revenue_rates": (
            "mart_revenue_retention",
            *segment,
            "account_priority_action",
            "mrr_at_risk_rate",
            "customer_risk_rate",
        ),
        "adoption_rates": (
            "mart_product_adoption",
            *segment,
            "usage_intensity",
            "integration_adoption_rate",
            "report_creation_rate",
            "low_usage_paid_account_rate",
        ),
        "support_rates": (
            "mart_support_operations",
            *segment,
            "support_burden_level",
            "open_ticket_account_rate",
            "critical_ticket_account_rate",
            "support_risk_account_rate",
        ),
    }
    out = {name: _rule(spec[0], "account_id", *spec[1:]) for name, spec in per_account.items()}
    out.update({name: _rule(*spec) for name, spec in rates.items()})
    return out


def _faulty_tables(w: Warehouse) -> dict[str, DataFrame]:
    return {
        "crm_accounts": faults.accounts(w["crm_accounts"]),
        "crm_contacts": faults.contacts(w["crm_contacts"]),
        "crm_deals": faults.deals(w["crm_deals"]),
        "billing_subscriptions": faults.subscriptions(w["billing_subscriptions"]),
        "billing_invoices": faults.invoices(w["billing_invoices"]),
        "billing_payments": faults.payments(w["billing_payments"]),
        "product_events": faults.events(w["product_events"]),
        "support_tickets": faults.tickets(w["support_tickets"]),
    }


def _checks() -> dict[str, Query]:
    def keys_of(tables) -> int:
        """Primary keys of a load. Its faulty copies have somewhat more."""
        return sum(load_rows(tables.facts).values())

    def raw_report(spark, folder):
        tables = loaded(spark, folder).sources
        return raw_checks.raw_validation_report(spark, tables, keys_of(tables))

    def report_of_load(spark, folder):
        """The same from what the load counted while it wrote, with one pass over the keys."""
        tables = loaded(spark, folder).sources
        references = raw_checks.references_of(tables)
        parents = sum(tables.facts[name, "rows", ""] for name in {r.parent for r in references})
        return raw_checks.report_of_facts(spark, tables.facts | raw_checks.key_facts(tables, references, parents, keys_of(tables)))

    def two_tables(spark, folder):
        """A load of two entities, as it is opened."""
        target, tables = fresh_folder(spark, "snapshot"), bind(spark, folder)
        two = {entity: tables[entity] for entity in ("crm_accounts", "crm_contacts")}
        return raw_checks.with_status(raw_checks.check_tables_exist(spark, publish_snapshot(spark, two, target, LOADED_AT)))

    def empty(spark, folder):
        w = loaded(spark, folder)
        tables = _faulty_tables(w) | {"crm_contacts": faults.no_rows(w["crm_contacts"])}
        return raw_checks.with_status(raw_checks.check_not_empty(tables))

    def faulty(check) -> Query:
        return lambda spark, folder: raw_checks.with_status(check(_faulty_tables(loaded(spark, folder))))

    def faults_report(spark, folder):
        w = loaded(spark, folder)
        return raw_checks.raw_validation_report(spark, _faulty_tables(w), keys_of(w.sources))

    def repeated_keys_of_faults(spark, folder):
        w = loaded(spark, folder)
        return raw_checks.with_status(raw_checks.check_pk_unique(_faulty_tables(w), keys_of(w.sources)))

    def staged_faults(w: Warehouse) -> Warehouse:
        return Warehouse({**w.sources, **_faulty_tables(w)}, w.params)

    def on_faulty_staging(op) -> Query:
        return lambda spark, folder: op(staged_faults(loaded(spark, folder)))

    deals, accounts = "stg_crm__deals", "stg_crm__accounts"
    account_contract, deal_contract = CONTRACTS[accounts], CONTRACTS[deals]
    return {
        "raw_validation_report": raw_report,
        "raw_validation_of_load": report_of_load,
        "check_tables_exist": two_tables,
        "raw_validation_of_faults": faults_report,
        "check_not_empty": empty,
        "check_pk_not_null": faulty(raw_checks.check_pk_not_null),
        "check_pk_unique": repeated_keys_of_faults,
        "check_relationships": faulty(raw_checks.check_relationships),
        "check_dates_present": faulty(raw_checks.check_dates_present),
        "check_non_negative": faulty(raw_checks.check_non_negative),
        "duplicate_keys": on_faulty_staging(lambda w: contracts.duplicate_keys(w[accounts], "account_id")),
        "orphan_rows": on_faulty_staging(
            lambda w: contracts.orphan_rows(w[deals], "account_id", w[accounts], "account_id")
        ),
        "expect_not_null": on_faulty_staging(
            lambda w: contracts.expect_not_null(w[deals], *deal_contract.not_null)
        ),
        "expect_unique": on_faulty_staging(lambda w: contracts.expect_unique(w[accounts], "account_id")),
        "expect_accepted_values": on_faulty_staging(
            lambda w: contracts.expect_accepted_values(w[accounts], account_contract.accepted)
        ),
        "expect_relationship": on_faulty_staging(
            lambda w: contracts.expect_relationship(w[deals], "account_id", w[accounts], "account_id")
        ),
        "run_contracts": _on_derived(run_contracts),
        "run_tagged_contracts": _on_derived(lambda w: run_contracts(w, "data_contract")),
        "assert_financials_non_negative": _on_derived(
            lambda w: invariants.assert_financials_non_negative(faults.account_360(w["mart_account_360"]))
        ),
        "assert_mrr_components_reconcile": _on_derived(
            lambda w: invariants.assert_mrr_components_reconcile(faults.account_360(w["mart_account_360"]))
        ),
        "assert_risk_mart_only_risk": _on_derived(
            lambda w: invariants.assert_risk_mart_only_risk(
                w["mart_churn_risk"], faults.account_360_with_gaps(w["mart_account_360"])
            )
        ),
        "assert_rank_in_band": _on_derived(
            lambda w: invariants.assert_rank_in_band(faults.churn_risk(w["mart_churn_risk"]))
        ),
        "assert_critical_flag_open_only": _on_derived(
            lambda w: invariants.assert_critical_flag_open_only(
                faults.ticket_summary(w["int_support__account_ticket_summary"]), w["stg_support__tickets"], w.params
            )
        ),
        "assert_scores_0_100": _on_derived(
            lambda w: invariants.assert_scores_0_100(faults.customer_health(w["mart_customer_health"]))
        ),
        "assert_healthy_not_risk": _on_derived(
            lambda w: invariants.assert_healthy_not_risk(faults.account_360(w["mart_account_360"]))
        ),
        "assert_non_customers_zero_mrr": _on_derived(
            lambda w: invariants.assert_non_customers_zero_mrr(faults.account_360(w["mart_account_360"]))
        ),
        "assert_non_risk_zero_at_risk": _on_derived(
            lambda w: invariants.assert_non_risk_zero_at_risk(faults.account_360(w["mart_account_360"]))
        ),
        "assert_adoption_rates_0_1": _on_derived(
            lambda w: invariants.assert_adoption_rates_0_1(
                faults.shifted(w["mart_product_adoption"], "report_creation_rate", 1, "high_value")
            )
        ),
        "assert_retention_rates_0_1": _on_derived(
            lambda w: invariants.assert_retention_rates_0_1(
                faults.shifted(w["mart_revenue_retention"], "mrr_at_risk_rate", -1, "low_value")
            )
        ),
        "assert_support_rates_0_1": _on_derived(
            lambda w: invariants.assert_support_rates_0_1(
                faults.shifted(w["mart_support_operations"], "open_ticket_account_rate", 1, "mid_value")
            )
        ),
        "global_totals": _on_derived(
            lambda w: invariants.global_totals(
                marts.current_customers(w["mart_account_360"]), F.count(F.lit(1))
            )
        ),
        "reconcile_totals": _on_derived(
            lambda w: invariants.reconcile_totals(w["mart_account_360"], w["mart_revenue_retention"])
        ),
        "assert_retention_matches_360": _on_derived(
            lambda w: invariants.assert_retention_matches_360(
                faults.account_360(w["mart_account_360"]), w["mart_revenue_retention"]
            )
        ),
    }


def _audits() -> dict[str, Query]:
    def runs(op) -> Query:
        return lambda spark, folder: op(monitoring.run_audit(run_log(spark, folder)))

    def stages(op) -> Query:
        return lambda spark, folder: op(monitoring.stage_audit(run_log(spark, folder)))

    def latest_run_stages(spark, folder):
        log = run_log(spark, folder)
        return monitoring.stage_durations_latest_run(monitoring.run_audit(log), monitoring.stage_audit(log))

    return {
        "run_audit": runs(lambda d: d),
        "stage_audit": stages(lambda d: d),
        "latest_runs": runs(monitoring.latest_runs),
        "latest_stage_audit": stages(monitoring.latest_stage_audit),
        "latest_running_stage": stages(monitoring.latest_running_stage),
        "stage_durations_latest_run": latest_run_stages,
        "latest_raw_loads": lambda spark, folder: monitoring.latest_raw_loads(
            read_load_audit(spark, load_folder(spark, folder))
        ),
        "latest_row_counts": _on_derived(
            lambda w: monitoring.latest_row_counts(row_counts(w, RUN_ID, OBSERVED_AT))
        ),
        "row_counts_latest": _on_derived(
            lambda w: monitoring.row_counts_latest(row_counts(w, RUN_ID, OBSERVED_AT))
        ),
    }


def queries() -> dict[str, Query]:
    return {**_sources(), **_models(), **_policy(), **_checks(), **_audits()}
