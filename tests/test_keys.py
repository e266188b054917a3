"""Exactness of the checks that count hashes, and of the facts that a load brings along."""

import datetime as dt
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from revpulse.operators import keys as K
from revpulse.operators import raw_checks
from revpulse.operators.staging import staging_sql
from revpulse.plans.build import derive, publish_layers
from revpulse.plans.contracts import CONTRACTS, run_contracts, staged_references
from revpulse.plans.relations import ENTITY_OF, RELATIONS, Warehouse
from revpulse.schemas import ENTITIES
from revpulse.sources.bound import bind
from revpulse.sources.snapshot import Snapshot, open_snapshot, publish_snapshot, write_entities

NOW = dt.datetime(2026, 1, 1)


def tables(spark, seed=0, rows=600):
    """A parent with repeated and null keys, and a child with a hot key, orphans and nulls."""
    rng = np.random.default_rng(seed)
    parent = [None if x % 17 == 0 else f"p{x}" for x in rng.integers(0, 300, rows // 2).tolist()]
    child = [(f"c{k % 580}" if k % 41 else None, None if x % 19 == 0 else "p1" if k % 3 == 0 else f"p{x}") for k, x in enumerate(rng.integers(0, 400, rows).tolist())]
    return parent, child, {
        "parent": spark.createDataFrame([(p, 1) for p in parent], "pk string, hash int").repartition(4),
        "child": spark.createDataFrame(child, "ck string, fk string").repartition(4),
    }


def expected(parent, child):
    twice = lambda values: sum(n > 1 for v, n in Counter(values).items() if v is not None)
    lost = sum(f is not None and f not in parent for _, f in child)
    return [twice(parent), twice([c for c, _ in child]), lost]


UNIQUES = [K.Unique("parent", "pk"), K.Unique("child", "ck")]
REFERENCES = [K.Reference("child", "fk", "parent", "pk")]


@pytest.mark.parametrize("parents", [None, 300, 10**12])
def test_all_keys_in_one_pass(spark, parents):
    parent, child, frames = tables(spark)
    got = {r["check"]: r["failed_rows"] for r in K.key_pass(frames, UNIQUES, REFERENCES, parents).collect()}
    assert [got[k] for k in range(3)] == expected(parent, child)
    one = K.key_pass(frames, [], REFERENCES, parents).collect()
    assert [tuple(r) for r in one] == [(0, expected(parent, child)[2])]
    sound = {"parent": spark.createDataFrame([("a", 1), ("b", 2)], "pk string, x int"), "child": spark.createDataFrame([("x", "a"), ("y", None)], "ck string, fk string")}
    assert {r["failed_rows"] for r in K.key_pass(sound, UNIQUES, REFERENCES, parents).collect()} == {0}
    empty = {name: df.limit(0) for name, df in sound.items()}
    assert [r["failed_rows"] for r in K.key_pass(empty, UNIQUES, REFERENCES, parents).collect()] == [0, 0, 0]


def test_keys_of_one_hash_are_told_apart(spark, monkeypatch):
    """With a hash that all keys share, and with one that few share, the counts are the same."""
    parent, child, frames = tables(spark, 3, 120)
    real = F.xxhash64
    for colliding in (lambda *c: F.lit(7).cast("bigint") + 0 * real(*c), lambda *c: F.pmod(real(*c), F.lit(5))):
        monkeypatch.setattr(F, "xxhash64", colliding)
        got = {r["check"]: r["failed_rows"] for r in K.key_pass(frames, UNIQUES, REFERENCES, 60).collect()}
        assert [got[k] for k in range(3)] == expected(parent, child)
        found = {r["ck"]: r["key_rows"] for r in K.repeated_keys(frames["child"], "ck").collect()}
        assert found == {c: n for c, n in Counter(c for c, _ in child).items() if n > 1 and c is not None}
        lost = {r["orphan_key"]: r["child_rows"] for r in K.lost_references(frames["child"], "fk", frames["parent"], "pk", 60).collect()}
        assert lost == Counter(f for _, f in child if f is not None and f not in parent)


def test_a_filter_lets_every_key_through_and_few_others(spark):
    inside = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    other = spark.range(20_000).select(F.concat(F.lit("other"), "id").alias("key"))
    words = K.filter_words(3000)
    made = K.key_filter(inside, "key", words)
    assert made.count() <= words
    assert K.probed(inside, "key", made, words).where("maybe").count() == 3000
    assert K.probed(other, "key", made, words).where("maybe").count() < 1500
    assert K.filter_words(10**9) == 0 and K.filter_words(0) == 1


def test_plans_show_the_filter_and_move_no_unique_texts(spark):
    _, _, frames = tables(spark)
    plan = K.lost_references(frames["child"], "fk", frames["parent"], "pk", 300)._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in plan and "BroadcastHashJoin" in plan
    plan = K.repeated_keys(frames["child"], "ck")._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan
    huge = K.lost_references(frames["child"], "fk", frames["parent"], "pk", 10**12)._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" not in huge


def test_null_counts_as_one_repeated_key(spark, entity):
    found = {"crm_accounts": entity("crm_accounts", {"account_id": None}, {"account_id": None}, {"account_id": "a"}, {"account_id": "a"})}
    (row,) = raw_checks.check_pk_unique(found).collect()
    assert row["failed_records"] == 2
    found = {"crm_accounts": entity("crm_accounts", {"account_id": None}, {"account_id": "a"})}
    assert raw_checks.check_pk_unique(found).first()["failed_records"] == 0


def _facts(spark, sources, folder):
    paths, facts = write_entities(spark, sources, folder)
    stored = Snapshot(spark, paths, facts)
    references = list(dict.fromkeys([*raw_checks.references_of(stored), *staged_references()]))
    parents = sum(facts[n, "rows", ""] for n in {r.parent for r in references})
    return stored, facts | raw_checks.key_facts(stored, references, parents)


def test_the_load_counts_what_the_checks_count(spark, entity, tmp_path):
    """One pass over every source, also over those that are split by month and those without rows."""
    sources = {e: entity(e) for e in ENTITIES}
    sources["crm_accounts"] = entity("crm_accounts", {"account_id": "a", "created_at": "2025-01-01"}, {"account_id": "a"}, {"account_id": None})
    sources["crm_deals"] = entity("crm_deals", {"deal_id": None, "account_id": "a", "deal_amount_usd": "-1.00"}, {"deal_id": None, "account_id": "lost"})
    sources["product_events"] = entity(
        "product_events", {"event_id": "1", "subscription_id": "s", "occurred_at": "2025-01-01T00:00:00"}, {"event_id": "2"}, {"event_id": "2", "occurred_at": "2025-02-01T00:00:00"}
    )
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = {name: df.mapInArrow(counting, df.schema) for name, df in sources.items()}
    stored, facts = _facts(spark, watched, str(tmp_path))
    assert seen.value == 3 + 2 + 3
    assert facts["product_events", "rows", ""] == 3 and facts["product_events", "blank", "occurred_at"] == 1
    assert facts["crm_deals", "null", "deal_id"] == 2 and facts["crm_deals", "negative", "deal_amount_usd"] == 1
    assert facts["support_tickets", "rows", ""] == 0
    rows = lambda report: sorted(map(tuple, report.collect()))
    assert rows(raw_checks.report_of_facts(spark, facts)) == rows(raw_checks.raw_validation_report(spark, stored))


def test_contracts_take_keys_from_the_load(spark, data, tmp_path):
    """The same failures with the load's counts as without, on sources with faults, and fewer keys read."""
    sources = bind(spark, data)
    frames = {name: sources[name] for name in ENTITIES}
    frames["crm_accounts"] = frames["crm_accounts"].union(frames["crm_accounts"].limit(3))
    frames["billing_payments"] = frames["billing_payments"].withColumn("invoice_id", F.concat(F.lit("lost_"), "invoice_id"))
    stored, facts = _facts(spark, frames, str(tmp_path))
    w = Warehouse(stored)
    staged = [name for name in CONTRACTS if name in ENTITY_OF]

    def keys(report):
        rows = report.where(F.col("contract").isin("unique", "relationship") & F.col("relation").isin(*staged)).collect()
        return sorted((r["relation"], r["contract"], r["column_name"], r["failed_rows"], r["status"]) for r in rows)

    without, with_ = keys(run_contracts(w)), keys(run_contracts(w, facts=facts))
    assert without == with_ and ("stg_crm__accounts", "unique", "account_id", 3, "fail") in with_
    assert any(r[:3] == ("stg_billing__payments", "relationship", "invoice_id") and r[3] > 0 for r in with_)


def test_facts_of_replaced_entities_are_replaced(spark, entity, tmp_path):
    publish_snapshot(spark, {"crm_accounts": entity("crm_accounts", {"account_id": "a"}), "crm_deals": entity("crm_deals")}, str(tmp_path), NOW)
    publish_snapshot(spark, {"crm_accounts": entity("crm_accounts", {"account_id": "a"}, {"account_id": None})}, str(tmp_path), NOW)
    facts = open_snapshot(spark, str(tmp_path)).facts
    assert facts["crm_accounts", "rows", ""] == 2 and facts["crm_accounts", "null", "account_id"] == 1 and facts["crm_deals", "rows", ""] == 0


def test_layers_are_found_in_another_session(spark, data, tmp_path):
    """All relations by ``layer.name``, with the rows of the relations, and what is defined over them follows a new run."""
    paths, facts = write_entities(spark, {n: bind(spark, data)[n] for n in ENTITIES}, f"{tmp_path}/raw")
    w = Warehouse(Snapshot(spark, paths, facts))
    derive(w, spark, str(tmp_path))
    names = publish_layers(w, spark, str(tmp_path))
    assert len(names) == 30 == len(RELATIONS)
    other = spark.newSession()
    for name in names:
        relation = name.split(".")[1]
        seen = other.table(name)
        assert seen.columns == w[relation].columns and [f.dataType for f in seen.schema] == [f.dataType for f in w[relation].schema]
    for relation in (*ENTITY_OF, "mart_churn_risk"):
        seen, ours = other.table(f"{RELATIONS[relation].layer}.{relation}"), w[relation]
        key = lambda df: Counter(map(str, df.collect()))
        assert key(seen) == key(ours)
    other.sql("CREATE OR REPLACE TEMPORARY VIEW counted AS SELECT count(*) AS n FROM staging.stg_crm__accounts")
    before = other.table("counted").first()["n"]
    few = {n: bind(spark, data)[n].limit(5) if n == "crm_accounts" else bind(spark, data)[n] for n in ENTITIES}
    paths, facts = write_entities(spark, few, f"{tmp_path}/raw")
    later = Warehouse(Snapshot(spark, paths, facts))
    later.paths = w.paths
    for name, path in w.paths.items():
        later.store(name, spark.read.parquet(path))
    publish_layers(later, spark, str(tmp_path))
    assert before > 5 and other.table("counted").first()["n"] == 5


def test_staging_sql_has_the_columns_of_the_operators(spark, entity):
    for relation, name in ENTITY_OF.items():
        entity(name).createOrReplaceTempView("staging_source")
        made = spark.sql(staging_sql(name, "staging_source"))
        ours = Warehouse({name: entity(name)})[relation]
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in ours.schema]
