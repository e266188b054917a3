"""One full run: load, validate, derive, check and count, with its history logged."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revpulse.operators import monitoring, raw_checks
from revpulse.operators.staging import staging_sql
from revpulse.params import Params, Policy
from revpulse.plans.contracts import run_contracts, staged_references
from revpulse.plans.relations import LAYERS, RELATIONS, Warehouse
from revpulse.schemas import ENTITIES
from revpulse.sources import Sources
from revpulse.sources.files import check_sources, read_folder
from revpulse.sources.history import History
from revpulse.sources.manifest import Manifest
from revpulse.sources.snapshot import Snapshot, append_audit, committed, facts_of, write_entities
from revpulse.sources.snapshot import row_counts as row_counts_of
from revpulse.sources.warehouse import over_files, publish_views, register_view, schema_name

RUN_NAME = "account_warehouse"
# Relations worth writing because several later ones read them, in dependency order.
# Those of one step do not read each other and are written side by side.
STEPS = (
    (
        "int_revenue__invoice_payment_summary",
        "int_customer__account_base",
        "int_product__account_usage",
        "int_support__account_ticket_summary",
    ),
    ("int_revenue__subscriptions_enriched",),
    ("int_customer__health_signals",),
    ("mart_customer_health",),
    ("mart_account_360",),
    ("mart_churn_risk", "mart_revenue_retention", "mart_product_adoption", "mart_support_operations"),
)


class ChecksFailed(RuntimeError):
    """Some check of the loaded sources or of the warehouse did not pass."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


@dataclass
class RunLog:
    """Appends start and end rows of one run and its stages."""

    spark: SparkSession
    folder: str
    run_id: str
    name: str = RUN_NAME
    clock: Callable[[], dt.datetime] = _now

    def _append(self, stage, started, finished, status, error=None):
        row = (self.run_id, self.name, stage, started, finished, status, error)
        self._history.append(self.spark.createDataFrame([row], monitoring.LOG_SCHEMA))

    @property
    def _history(self) -> History:
        return History(self.spark, self.folder, monitoring.LOG_SCHEMA)

    @contextmanager
    def _timed(self, stage, wrap):
        started = self.clock()
        self._append(stage, started, None, "running")
        try:
            yield
        except BaseException as e:
            self._append(stage, started, self.clock(), "failed", wrap(str(e)))
            raise
        self._append(stage, started, self.clock(), "success")

    def run(self):
        return self._timed(None, lambda e: e)

    @contextmanager
    def stage(self, name: str):
        try:
            with self._timed(name, lambda e: e):
                yield
        except Exception as e:
            raise RuntimeError(f"Stage failed: {name}. {e}") from e

    def read(self) -> DataFrame:
        return self._history.read()


def row_counts(w: Warehouse, run_id: str | None, observed_at: dt.datetime) -> DataFrame:
    layers = {r.name: (r.layer, r.kind) for r in RELATIONS.values()}
    return monitoring.table_row_counts(w, layers, run_id, RUN_NAME, observed_at)


def row_count_history(spark: SparkSession, root: str) -> History:
    """Row counts of all runs, see ``monitoring.table_row_counts``."""
    return History(spark, f"{root.rstrip('/')}/monitoring/table_row_count_audit", monitoring.ROW_COUNT_SCHEMA)


def derive(w: Warehouse, spark: SparkSession, root: str) -> dict[str, str]:
    """Write every step's relations to new folders; later relations read the written copies."""
    version, paths = uuid.uuid4().hex, {}

    def write(name: str, df: DataFrame) -> tuple[str, DataFrame]:
        path = f"{root}/{RELATIONS[name].layer}/{name}/v={version}"
        df.write.parquet(path)
        paths[name] = path
        return name, spark.read.schema(df.schema).parquet(path)

    for step in STEPS:
        frames = [(name, w[name]) for name in step]
        with ThreadPoolExecutor(len(step)) as pool:
            for name, stored in pool.map(lambda f: write(*f), frames):
                w.store(name, stored)
    w.paths = paths
    return paths


def open_warehouse(spark: SparkSession, root: str) -> Warehouse:
    """Sources, parameters and relations of the last run that passed its checks, all of one run."""
    state = Manifest(spark, root).read()
    if not state:
        raise FileNotFoundError(f"no run under {root} has passed its checks")
    w = Warehouse(Snapshot(spark, state["entities"], facts_of(state)), Params.from_json(state["params"]), Policy.from_json(state["policy"]))
    w.paths = state["relations"]
    for name, path in w.paths.items():
        w.store(name, spark.read.parquet(path))
    return w


def publish_layers(w: Warehouse, spark: SparkSession, root: str) -> list[str]:
    """Every relation of a run as a catalog view ``layer.name``, for other sessions; the names.

    Sources and derived relations are read from the files that the run wrote, staging from the views of its sources.
    """
    texts: dict[str, dict[str, str]] = {layer: {} for layer in LAYERS}
    for r in RELATIONS.values():
        if r.layer == "raw":
            texts[r.layer][r.name] = over_files(w.sources.paths[r.name], ENTITIES[r.name].columns)
        elif r.entity:
            texts[r.layer][r.name] = staging_sql(r.entity, f"`{schema_name('raw', '')}`.`{r.entity}`", w.params)
        else:
            texts[r.layer][r.name] = over_files(w.paths[r.name], w[r.name].columns)
    return publish_views(spark, texts, f"{root}/views")


def register_views(w: Warehouse) -> None:
    """Every relation as a session view of its name. A view made over one of them follows the next run."""
    for name in RELATIONS:
        register_view(w[name], name)


def _demand(report: DataFrame, what: str) -> None:
    failed = report.where(F.col("status") == "fail").count()
    if failed:
        raise ChecksFailed(f"{failed} {what} checks failed")


def build_warehouse(
    spark: SparkSession,
    source_folder: str | None,
    root: str,
    params: Params = Params(),
    policy: Policy = Policy(),
    sources: Sources | None = None,
    run_id: str | None = None,
) -> Warehouse:
    """Run everything once. Sources come from CSV files or are passed in; a failing check stops the run.

    Nothing that a reader opens changes before all checks have passed: sources, relations and parameters
    are then committed together.
    """
    root, run_id = root.rstrip("/"), run_id or uuid.uuid4().hex
    history = f"{root}/monitoring"
    log = RunLog(spark, f"{history}/run_log", run_id)
    with log.run():
        with log.stage("load"):
            if sources is None:
                check_sources(spark, source_folder)
                sources = read_folder(spark, source_folder)
            loaded_at = _now()
            entities, facts = write_entities(spark, sources, f"{root}/raw")
            tables = Snapshot(spark, entities, facts)
        with log.stage("validate"):
            checked_at = F.lit(_now()).cast("timestamp_ntz")
            # Keys and references of the raw and of the staged tables, which are the same columns.
            references = list(dict.fromkeys([*raw_checks.references_of(tables), *staged_references()]))
            parents = sum(facts[name, "rows", ""] for name in {r.parent for r in references})
            facts |= raw_checks.key_facts(tables, references, parents, sum(row_counts_of(facts).values()))
            report = raw_checks.report_of_facts(spark, facts).withColumn("checked_at", checked_at)
            path = f"{history}/raw_validation_results/run={run_id}"
            report.coalesce(1).write.parquet(path)
            _demand(spark.read.schema(report.schema).parquet(path), "source")
        with log.stage("derive"):
            w = Warehouse(tables, params, policy)
            relations = derive(w, spark, root)
        with log.stage("check"):
            report = run_contracts(w, facts=facts)
            path = f"{history}/contract_results/run={run_id}"
            report.coalesce(1).write.parquet(path)
            _demand(spark.read.schema(report.schema).parquet(path), "warehouse")
            state = {
                "run_id": run_id,
                **committed({}, entities, facts),
                "relations": relations,
                "params": params.to_json(),
                "policy": policy.to_json(),
            }
            Manifest(spark, root).commit(lambda was: state)
            append_audit(spark, root, row_counts_of(facts), loaded_at)
            register_views(w)
            publish_layers(w, spark, root)
        with log.stage("count"):
            counts = row_counts(w, run_id, _now())
            row_count_history(spark, root).append(counts)
    return w
