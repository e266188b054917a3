"""Time the headline queries and print one JSON line.

Every query runs end to end from the base tables into a sink that discards rows,
once to warm up and then BENCH_RUNS times; the median counts. ``publish`` loads all
nine sources, ``derive_all`` writes every shared relation and mart from that load,
and names ending in ``_loaded``, and ``account_usage``, read a published load instead of the
base tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from revpulse import registry
from revpulse.params import Params
from revpulse.plans.build import derive
from revpulse.plans.contracts import run_contracts
from revpulse.plans.relations import Warehouse
from revpulse.session import configure, fresh_folder
from revpulse.sources.bound import bind
from revpulse.sources.snapshot import publish_snapshot

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

FROM_BASE_TABLES = (
    "invoice_payment_summary",
    "subscriptions_enriched",
    "account_base",
    "account_usage",
    "account_ticket_summary",
    "mart_churn_risk",
    "mart_revenue_retention",
    "mart_product_adoption",
    "mart_support_operations",
    "expected_invoice_schedule",
    "stage_audit",
)
FROM_LOAD = {
    "account_usage_loaded": "int_product__account_usage",
    "health_signals_loaded": "int_customer__health_signals",
    "mart_churn_risk_loaded": "mart_churn_risk",
    "mart_revenue_retention_loaded": "mart_revenue_retention",
    "mart_product_adoption_loaded": "mart_product_adoption",
    "mart_support_operations_loaded": "mart_support_operations",
}


def discard(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    settings = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false",
    }
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="bench-")
    spark = configure(SparkSession.builder.master(f"local[{CPUS}]"), **settings).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, action, runs=RUNS, warm=True):
        if warm:
            action()
        spent = []
        for _ in range(runs):
            t = time.perf_counter()
            action()
            spent.append(time.perf_counter() - t)
        seconds[name] = round(statistics.median(spent), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    queries = registry.queries()
    for name in FROM_BASE_TABLES:
        timed(name, lambda name=name: discard(queries[name](spark, FOLDER)))

    def publish():
        return publish_snapshot(spark, bind(spark, FOLDER), fresh_folder(spark, "bench"), registry.LOADED_AT)

    timed("publish", publish, warm=False)
    tables = publish()
    for name, relation in FROM_LOAD.items():
        timed(name, lambda relation=relation: discard(Warehouse(tables, Params())[relation]))

    derived = Warehouse(tables, Params())

    def derive_all():
        nonlocal derived
        derived = Warehouse(tables, Params())
        derive(derived, spark, fresh_folder(spark, "bench"))

    timed("derive_all", derive_all)
    timed("run_contracts", lambda: discard(run_contracts(derived)))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of query times, each the median of three runs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
