"""The nine entities derived from TPC-H style tables.

Every customer becomes an account and every order a deal; won and provisioned
deals become subscriptions, whose order lines become invoices, payments, usage
and, when returned, support tickets. Keys only choose attribute values.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revpulse.operators.keys import MOST_WORDS, key_filter, probed
from revpulse.schemas import CONTACT_ROLES, ENTITIES, PAYMENT_METHODS, PLANS, TICKET_CATEGORIES

AS_OF = "DATE'2025-12-31'"
#: Bytes of ``lineitem`` files for each task that makes events of its lines, some hundred thousand events.
LINE_BYTES = 1 << 20
#: The same in subscribed lines, once they are stored and counted; files of more or less compression say nothing then.
LINES_PER_TASK = 16_000
#: Entities that are made of the subscribed lines.
LINE_MADE = ("billing_invoices", "billing_payments", "product_events", "support_tickets")
#: Entities whose rows lie in tasks of a fair size and in the order of a column.
DEALT = {"product_events": "account_id"}
# Order dates end on 2001-08-01; this many days later is the observation date.
DAYS_TO_PRESENT = 8918

# Columns of the base tables that the entities are derived from.
BASE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def _pick(labels, index: str) -> str:
    listed = ", ".join(f"'{x}'" for x in labels)
    return f"elt(CAST(1 + {index} AS INT), {listed})"


def _whole(expr: str) -> str:
    return f"CAST({expr} AS INT)"


def _cents(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(18,2)) * 100 AS BIGINT)"


def _usd(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))"


_INVOICE_ID = "concat_ws('_', 'inv', l_orderkey, l_linenumber)"
_INVOICE_DAY = "date_add(start_date, 30 * l_linenumber)"
_UNPAID = "(returned AND (past_due OR (ongoing AND discount = 9)))"
_OWNERS = (
    "concat('sub_', l_orderkey) AS subscription_id",
    "concat('cus_', o_custkey) AS billing_customer_id",
    "concat('acc_', o_custkey) AS account_id",
)
_NEVER_WON = _pick(("prospecting", "qualified", "proposal", "negotiation", "closed_lost"), "o_orderkey % 5")
_STAGE = f"""CASE
    WHEN o_custkey % 10 = 2 AND o_orderstatus = 'P' AND o_orderkey % 4 = 0 THEN 'closed_won'
    WHEN o_custkey % 10 <= 2 THEN {_NEVER_WON}
    WHEN o_orderkey % 20 < 9 THEN 'closed_won'
    WHEN o_orderkey % 20 < 11 THEN 'closed_lost'
    WHEN o_orderkey % 20 < 13 THEN 'prospecting'
    WHEN o_orderkey % 20 < 16 THEN 'qualified'
    WHEN o_orderkey % 20 < 18 THEN 'proposal'
    ELSE 'negotiation' END"""
_LEANING = """CASE
    WHEN o_custkey % 10 = 3 THEN 'canceled'
    WHEN o_custkey % 10 = 4 THEN if(o_orderkey % 3 = 0, 'canceled', 'past_due')
    WHEN o_orderkey div 20 % 20 < 16 THEN 'active'
    WHEN o_orderkey div 20 % 20 = 16 THEN 'past_due'
    ELSE 'canceled' END"""


class BoundTables(Mapping):
    """Lazily derived entities over one folder of base tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._entities: dict[str, DataFrame] = {}
        self._stored_lines: int | None = None

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._entities:
            if name not in ENTITIES:
                raise KeyError(name)
            self._entities[name] = getattr(self, name)().selectExpr(*ENTITIES[name].columns)
        return self._entities[name]

    def __iter__(self) -> Iterator[str]:
        return iter(ENTITIES)

    def __len__(self) -> int:
        return len(ENTITIES)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{self.folder}/{name}.parquet")

    def bytes_of(self, name: str) -> int:
        """Size of the files of a base table."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}.parquet")
        conf = self.spark._jsparkSession.sessionState().newHadoopConf()
        return path.getFileSystem(conf).getContentSummary(path).getLength()

    @cached_property
    def _accounts(self) -> DataFrame:
        nations = self.table("nation").selectExpr("n_nationkey AS c_nationkey", "n_name AS country")
        return (
            self.table("customer")
            .join(nations, "c_nationkey", "left")
            .selectExpr(
                "c_custkey",
                "concat('acc_', c_custkey) AS account_id",
                "c_name AS account_name",
                "c_mktsegment AS industry",
                "CASE WHEN c_acctbal < 5000 THEN 'SMB' WHEN c_acctbal < 8500 THEN 'Mid-Market' ELSE 'Enterprise' END AS segment",
                "CASE WHEN c_acctbal < 2500 THEN '11-50' WHEN c_acctbal < 5000 THEN '51-100' "
                "WHEN c_acctbal < 8500 THEN '101-250' ELSE '1001-5000' END AS employee_band",
                "country",
                f"date_add(DATE'2019-01-01', {_whole('c_custkey * 37 % 600')}) AS created_at",
                "concat('owner_', c_custkey % 23) AS account_owner",
            )
        )

    def crm_accounts(self) -> DataFrame:
        return self._accounts

    def crm_contacts(self) -> DataFrame:
        copies = f"if(c_custkey % 4 = 0, array(), sequence(1, {_whole('c_custkey % 4')}))"
        return self._accounts.selectExpr("*", f"explode({copies}) AS i").selectExpr(
            "concat_ws('_', 'con', c_custkey, i) AS contact_id",
            "account_id",
            "concat('contact', i, '@', c_custkey, '.example') AS email",
            "concat(account_name, ' contact ', i) AS full_name",
            f"{_pick(CONTACT_ROLES, '(c_custkey + 5 * i) % 6')} AS role",
            "created_at",
        )

    @cached_property
    def _deals(self) -> DataFrame:
        """Deals with the order columns later steps need."""
        return (
            self.table("orders")
            .selectExpr(
                "*",
                f"{_cents('o_totalprice')} div 8 AS cents",
                f"date_add(CAST(o_orderdate AS DATE), {DAYS_TO_PRESENT}) AS created_at",
                f"{_STAGE} AS deal_stage",
            )
            .selectExpr(
                "o_orderkey",
                "o_custkey",
                "o_orderstatus",
                "concat('deal_', o_orderkey) AS deal_id",
                "concat('acc_', o_custkey) AS account_id",
                "concat('Order ', o_orderkey) AS deal_name",
                "'new_business' AS pipeline",
                "deal_stage",
                f"{_usd('cents')} AS deal_amount_usd",
                f"{_usd('cents div 12')} AS expected_mrr_usd",
                f"{_pick(PLANS, 'o_orderkey % 4')} AS plan",
                "created_at",
                f"if(startswith(deal_stage, 'closed'), date_add(created_at, {_whole('15 + o_orderkey % 106')}), NULL) AS close_date",
            )
        )

    def crm_deals(self) -> DataFrame:
        return self._deals

    @cached_property
    def _subscriptions(self) -> DataFrame:
        ends = f"date_add(start_date, {_whole('90 + o_orderkey % 361')})"
        return (
            self._deals.where("deal_stage = 'closed_won' AND o_orderstatus <> 'P'")
            .selectExpr("*", f"date_add(close_date, {_whole('o_orderkey % 11')}) AS start_date", f"{_LEANING} AS leaning")
            .where(f"start_date <= {AS_OF}")
            .selectExpr("*", f"if(leaning = 'canceled' AND {ends} < {AS_OF}, {ends}, NULL) AS canceled_at")
            .selectExpr(
                "o_orderkey",
                "o_custkey",
                "concat('sub_', o_orderkey) AS subscription_id",
                "concat('cus_', o_custkey) AS billing_customer_id",
                "account_id",
                "plan",
                "CASE WHEN canceled_at IS NOT NULL THEN 'canceled' WHEN leaning = 'past_due' THEN 'past_due' "
                "ELSE 'active' END AS status",
                "if(o_orderkey div 7 % 10 < 7, 'monthly', 'annual') AS billing_cycle",
                "expected_mrr_usd AS mrr_usd",
                "CAST(expected_mrr_usd * 12 AS DECIMAL(18,2)) AS arr_usd",
                "start_date",
                "canceled_at",
            )
        )

    def billing_subscriptions(self) -> DataFrame:
        return self._subscriptions

    def billing_customers(self) -> DataFrame:
        first = self._subscriptions.groupBy("account_id", "billing_customer_id").agg(
            F.expr("min(start_date) AS created_at")
        )
        about = self._accounts.selectExpr("account_id", "account_name AS customer_name", "country")
        return first.join(about, "account_id")

    @cached_property
    def _subscribed_lines(self) -> DataFrame:
        """Lines of subscribed orders, duplicates folded.

        The join comes first because few lines remain after it, and a filter of the subscribed orders, of
        bounded size, keeps most others from moving for it. Folding by a key of
        its own gives the join a shuffle to end in, so a join partition that one
        order dominates can still be split.
        """
        contracts = self._subscriptions.selectExpr(
            "o_orderkey AS l_orderkey", "o_custkey", "status = 'past_due' AS past_due", "start_date"
        )
        cents = _cents("l_extendedprice")
        kept = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_custkey", "start_date")
        subscribed = key_filter(contracts, "l_orderkey", MOST_WORDS)
        return (
            probed(self.table("lineitem"), "l_orderkey", subscribed, MOST_WORDS)
            .where("maybe")
            .drop("maybe")
            .join(contracts, "l_orderkey")
            .groupBy(F.expr("concat_ws('_', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS line_key"))
            .agg(
                *(F.expr(f"max({c}) AS {c}") for c in kept),
                F.expr("bool_or(past_due) AS past_due"),
                F.expr(f"sum({cents}) AS cents"),
                F.expr("bool_and(l_returnflag = 'R') AS returned"),
                F.expr("bool_or(l_returnflag = 'A') AS accepted"),
                F.expr("bool_and(l_linestatus = 'O') AS ongoing"),
                F.expr(f"min({_whole('round(l_discount * 100)')}) AS discount"),
            )
        )

    def store_lines(self, path: str) -> None:
        """Write the subscribed lines, which four entities are made of, and take those from the files."""
        self._subscribed_lines.write.option("compression", "zstd").parquet(path)
        self.take_lines(path)

    def take_lines(self, path: str) -> None:
        """Take the subscribed lines from where they were stored."""
        self._subscribed_lines = self.spark.read.schema(self._subscribed_lines.schema).parquet(path)
        self._stored_lines = self._subscribed_lines.count()

    def billing_invoices(self) -> DataFrame:
        return (
            self._subscribed_lines.groupBy("l_orderkey", "l_linenumber", "o_custkey", "start_date")
            .agg(F.expr("sum(cents) AS cents"), F.expr(f"bool_or({_UNPAID}) AS unpaid"))
            .selectExpr(
                f"{_INVOICE_ID} AS invoice_id",
                *_OWNERS,
                f"{_INVOICE_DAY} AS invoice_date",
                f"date_add({_INVOICE_DAY}, 15) AS due_date",
                f"{_usd('cents')} AS amount_due_usd",
                "if(unpaid, 'open', 'paid') AS status",
            )
        )

    def billing_payments(self) -> DataFrame:
        part_paid = "accepted AND ongoing AND discount = 8"
        return self._subscribed_lines.where(f"NOT {_UNPAID}").selectExpr(
            "concat('pay_', line_key) AS payment_id",
            f"{_INVOICE_ID} AS invoice_id",
            *_OWNERS,
            f"date_add({_INVOICE_DAY}, {_whole('10 + l_partkey % 16')}) AS payment_date",
            f"{_usd(f'if({part_paid}, cents div 2, cents)')} AS amount_paid_usd",
            f"{_pick(PAYMENT_METHODS, 'l_suppkey % 3')} AS payment_method",
        )

    def product_events(self) -> DataFrame:
        """Up to 60 events a line, so lines are dealt to tasks by what is made of them and not by their own size.

        They are dealt by ranges of accounts: the events of an account lie together, and one that has many
        lines goes to several tasks.
        """
        share = self.bytes_of("lineitem") / LINE_BYTES if self._stored_lines is None else self._stored_lines / LINES_PER_TASK
        order = ("o_custkey", "line_key")
        # To put the lines in order takes far less than to order their events by account afterwards.
        lines = self._subscribed_lines.repartitionByRange(max(1, math.ceil(share)), *order).sortWithinPartitions(*order)
        pace = "o_custkey div 10 % 10"
        copies = f"CASE WHEN {pace} < 4 THEN 60 WHEN {pace} < 7 THEN 18 WHEN {pace} < 9 THEN 3 END"
        kinds = (
            "login",
            "dashboard_viewed",
            "report_created",
            "user_invited",
            "integration_connected",
            "export_downloaded",
        )
        turn = "(l_partkey + i * (1 + o_custkey % 3)) % (1 + o_custkey % 6)"
        day = f"date_sub(DATE'2026-01-03', {_whole('(7 * l_partkey + 13 * i + l_linenumber) % 120')})"
        hours = f"make_dt_interval(0, {_whole('(l_partkey + i) % 24')})"
        return lines.selectExpr("*", f"explode(sequence(1, {copies})) AS i").selectExpr(
            "concat('evt_', line_key, '_', i) AS event_id",
            *_OWNERS,
            "concat('user_', (31 * l_suppkey + 7 * i + l_partkey) % 97) AS user_id",
            f"{_pick(kinds, turn)} AS event_type",
            f"CAST({day} AS TIMESTAMP_NTZ) + {hours} AS occurred_at",
        )

    def support_tickets(self) -> DataFrame:
        day = f"date_add(DATE'2025-01-01', {_whole('(17 * l_partkey + 5 * l_linenumber) % 380')})"
        took = f"make_dt_interval({_whole('1 + l_partkey % 20')}, {_whole('l_partkey % 24')})"
        return (
            self._subscribed_lines.where("returned")
            .selectExpr(
                "*",
                f"CAST({day} AS TIMESTAMP_NTZ) + make_dt_interval(0, {_whole('l_suppkey % 24')}) AS created_at",
                "(3 * l_partkey + 7 * l_linenumber) % 20 AS turn",
                "(11 * l_partkey + l_suppkey + l_linenumber) % 20 AS weight",
            )
            .selectExpr(
                "concat('tck_', line_key) AS ticket_id",
                *_OWNERS,
                "created_at",
                f"if(turn >= 4 AND l_partkey % 50 <> 7, created_at + {took}, NULL) AS resolved_at",
                "CASE WHEN turn < 2 THEN 'open' WHEN turn < 4 THEN 'pending' WHEN turn < 15 THEN 'resolved' "
                "ELSE 'closed' END AS status",
                "CASE WHEN weight < 9 THEN 'low' WHEN weight < 16 THEN 'medium' WHEN weight < 19 THEN 'high' "
                "ELSE 'critical' END AS severity",
                f"{_pick(TICKET_CATEGORIES, 'l_suppkey % 6')} AS category",
            )
        )


def bind(spark: SparkSession, folder: str) -> BoundTables:
    return BoundTables(spark, folder)


def run_log(spark: SparkSession, folder: str, run_name: str = "account_warehouse") -> DataFrame:
    """Run history derived from the event table: five events make a run, each one stage.

    Quick ``view`` stages never report an end, and a run with such a stage stays open.
    """
    stages = (
        BoundTables(spark, folder)
        .table("events")
        .selectExpr(
            "concat('run_', event_id div 5) AS run_id",
            f"'{run_name}' AS pipeline_name",
            "event_type AS stage_name",
            "ts AS started_at",
            "timestampadd(MICROSECOND, CAST(round(value * 100) AS BIGINT) * 10000, ts) AS ends_at",
            "event_type = 'view' AND value < 5 AS is_open",
            "event_type = 'error' AS is_failed",
        )
    )
    runs = (
        stages.groupBy("run_id", "pipeline_name")
        .agg(
            F.expr("min(started_at) AS started_at"),
            F.expr("max(ends_at) AS ends_at"),
            F.expr("bool_or(is_open) AS is_open"),
            F.expr("bool_or(is_failed) AS is_failed"),
        )
        .selectExpr("*", "CAST(NULL AS STRING) AS stage_name")
    )

    def rows(df, reason):
        what = ("run_id", "pipeline_name", "stage_name", "started_at")
        start = df.selectExpr(
            *what, "CAST(NULL AS TIMESTAMP_NTZ) AS finished_at", "'running' AS status", "'' AS error_message"
        )
        end = df.where("NOT is_open").selectExpr(
            *what,
            "ends_at AS finished_at",
            "if(is_failed, 'failed', 'success') AS status",
            f"if(is_failed, {reason}, '') AS error_message",
        )
        return start.unionByName(end)

    return rows(stages, "concat('exit code of ', stage_name)").unionByName(rows(runs, "'Stage failed: error'"))
