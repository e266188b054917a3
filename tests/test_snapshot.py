import datetime as dt

import pytest
from pyspark.sql import functions as F

from revpulse.params import Params, Policy
from revpulse.plans.relations import Warehouse
from revpulse.schemas import ENTITIES, source_catalog
from revpulse.session import shared_folder
from revpulse.sources import Sources
from revpulse.sources.files import MissingSources, check_sources, read_folder, read_raw
from revpulse.sources.manifest import KEPT, Manifest
from revpulse.sources.snapshot import (
    open_snapshot,
    publish_snapshot,
    read_load_audit,
    reload_is_idempotent,
    table_fingerprint,
)
from revpulse.sources.warehouse import materialize_mart, register_view, schema_name

from conftest import by

T1, T2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)


def accounts(entity, *names):
    return entity("crm_accounts", *({"account_id": n} for n in names))


def contacts(entity, *names):
    return entity("crm_contacts", *({"contact_id": n} for n in names))


def test_catalog_names_nine_entities():
    catalog = source_catalog()
    assert len(catalog) == 9 and all(e.key in e.columns and e.description for e in catalog.values())


def test_every_missing_file_is_listed_before_loading(spark, tmp_path):
    (tmp_path / "crm_accounts.csv").write_text("account_id\n")
    with pytest.raises(MissingSources) as e:
        check_sources(spark, str(tmp_path))
    assert len(e.value.paths) == 8


def test_csv_is_typed_and_strict(spark, tmp_path):
    header = "ticket_id,account_id,subscription_id,created_at,resolved_at,status,severity,category\n"
    good = tmp_path / "good.csv"
    good.write_text(header + 't,a,s,2025-03-04T00:00:00,,open,low,bug\nu,a,s,2025-03-04T05:06:07,"",open,low,bug\n')
    rows = by(read_raw(spark, "support_tickets", str(good)), "ticket_id")
    assert rows["t"]["created_at"] == dt.datetime(2025, 3, 4) and rows["t"]["resolved_at"] is None
    assert rows["u"]["resolved_at"] is None

    shifted = tmp_path / "shifted.csv"
    shifted.write_text(header.replace("ticket_id,account_id", "account_id,ticket_id") + "a,t,s,2025-03-04T00:00:00,,open,low,bug\n")
    with pytest.raises(Exception):
        read_raw(spark, "support_tickets", str(shifted)).collect()

    broken = tmp_path / "broken.csv"
    broken.write_text(header + "t,a,s,yesterday,,open,low,bug\n")
    with pytest.raises(Exception):
        read_raw(spark, "support_tickets", str(broken)).collect()
    with pytest.raises(ValueError):
        read_raw(spark, "passwords", str(good))


def test_unknown_entities_are_refused(spark, entity, tmp_path):
    with pytest.raises(ValueError):
        publish_snapshot(spark, {"passwords": accounts(entity, "a")}, str(tmp_path), T1)
    with pytest.raises(ValueError):
        Sources({"passwords": None})


def test_reload_replaces_rows_and_views_follow(spark, entity, tmp_path):
    root = str(tmp_path)
    register_view(publish_snapshot(spark, {"crm_accounts": accounts(entity, "old")}, root, T1)["crm_accounts"], "loaded_accounts")
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW account_names AS SELECT account_id FROM loaded_accounts")
    assert [r.account_id for r in spark.table("account_names").collect()] == ["old"]
    register_view(publish_snapshot(spark, {"crm_accounts": accounts(entity, "new")}, root, T2)["crm_accounts"], "loaded_accounts")
    assert [r.account_id for r in spark.table("account_names").collect()] == ["new"]


def test_a_late_failure_keeps_every_old_table(spark, entity, tmp_path):
    root = str(tmp_path)
    publish_snapshot(spark, {"crm_accounts": accounts(entity, "old"), "crm_contacts": contacts(entity, "old")}, root, T1)
    exploding = contacts(entity, "new").withColumn("email", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception):
        publish_snapshot(
            spark, {"crm_accounts": accounts(entity, "new"), "crm_deals": entity("crm_deals"), "crm_contacts": exploding}, root, T2
        )
    with pytest.raises(Exception):
        publish_snapshot(spark, {"crm_accounts": accounts(entity, "new"), "crm_contacts": spark.range(1)}, root, T2)
    now = open_snapshot(spark, root)
    assert set(now) == {"crm_accounts", "crm_contacts"}
    assert [r.account_id for r in now["crm_accounts"].collect()] == ["old"]
    assert [r.contact_id for r in now["crm_contacts"].collect()] == ["old"]
    assert {r.loaded_at for r in read_load_audit(spark, root).collect()} == {T1}


def test_audit_rows_commit_with_the_load(spark, entity, tmp_path):
    root = str(tmp_path)
    assert read_load_audit(spark, root).count() == 0
    publish_snapshot(spark, {"crm_accounts": accounts(entity, "a", "b")}, root, T1)
    publish_snapshot(spark, {"crm_accounts": accounts(entity, "a", "b", "c")}, root, T2)
    rows = sorted((r.table_name, r.row_count, r.loaded_at) for r in read_load_audit(spark, root).collect())
    assert rows == [("crm_accounts", 2, T1), ("crm_accounts", 3, T2)]


def test_fingerprint_ignores_order_and_sees_every_change(spark, frame):
    def print_of(*rows):
        return tuple(table_fingerprint({"t": frame("a string, b string", *rows)}).first())

    base = print_of(("x", "y"), ("p", "q"))
    assert print_of(("p", "q"), ("x", "y")) == base
    assert print_of(("x", "y"), ("p", "q"), ("p", "q"), ("p", "q"))[2:] != base[2:]
    for changed in ([("y", "x"), ("p", "q")], [("xy", ""), ("p", "q")], [("x", None), ("p", "q")], [(None, "x"), ("p", "q")]):
        assert print_of(*changed) != base
    assert print_of((None, "x")) != print_of(("x", None))
    assert print_of((None, None)) != print_of(("-", None))


def test_idempotence_needs_both_sides(spark, frame):
    one = {"t": frame("a string", ("x",)), "u": frame("a string", ("x",))}
    two = {"t": frame("a string", ("x",)), "u": frame("a string", ("z",)), "v": frame("a string", ("x",))}
    rows = by(reload_is_idempotent(table_fingerprint(one), table_fingerprint(two)), "table_name")
    assert {k: r["unchanged"] for k, r in rows.items()} == {"t": True, "u": False, "v": False}


def test_csv_round_trip(spark, data, tmp_path):
    from revpulse.sources.bound import bind

    bound = bind(spark, data)
    for name, df in bound.items():
        df.write.option("header", True).csv(f"{tmp_path}/{name}.csv")
    back = read_folder(spark, str(tmp_path))
    assert set(back) == set(ENTITIES)
    same = reload_is_idempotent(table_fingerprint(bound), table_fingerprint(back))
    assert all(r.unchanged for r in same.collect())


def test_layers(spark, frame, tmp_path):
    assert schema_name(None, "analytics") == "analytics" and schema_name(" marts ", "analytics") == "marts"
    name = materialize_mart(spark, frame("a int", (1,)), "answers", "marts", str(tmp_path))
    assert name == "marts.answers"
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW answer_sum AS SELECT sum(a) AS s FROM {name}")
    opened = spark.table(name)
    materialize_mart(spark, frame("a int", (2,), (3,)), "answers", "marts", str(tmp_path))
    assert sorted(r.a for r in spark.table(name).collect()) == [2, 3] and spark.table("answer_sum").first().s == 5
    assert [r.a for r in opened.collect()] == [1]  # who has it open keeps reading the old files
    exploding = frame("a int", (4,)).select(F.raise_error(F.lit("boom")).cast("int").alias("a"))
    with pytest.raises(Exception):
        materialize_mart(spark, exploding, "answers", "marts", str(tmp_path))
    assert spark.table("answer_sum").first().s == 5


def test_overlapping_commits_lose_nothing(spark, tmp_path):
    one, other = Manifest(spark, str(tmp_path)), Manifest(spark, str(tmp_path))
    calls = []

    def slow(was):
        calls.append(was)
        if len(calls) == 1:  # another commit gets in between reading and writing
            other.commit(lambda w: {**w, "b": 2})
        return {**was, "a": 1}

    one.commit(slow)
    assert one.read() == {"a": 1, "b": 2} and calls == [{}, {"b": 2}]
    for k in range(KEPT + 5):
        one.commit(lambda was: {**was, "k": k})
    assert other.read() == {"a": 1, "b": 2, "k": KEPT + 4}
    assert len(list((tmp_path / "_manifests").glob("[0-9]*.json"))) == KEPT


def test_a_range_of_days_opens_only_its_months(spark, entity, tmp_path):
    rows = [{"event_id": f"e{m}_{d}", "account_id": "a", "event_type": "login", "occurred_at": f"2025-{m:02}-{d:02}T01:02:03"} for m in range(1, 13) for d in (1, 15, 28)]
    rows.append({"event_id": "never"})
    snapshot = publish_snapshot(spark, {"product_events": entity("product_events", *rows)}, str(tmp_path), T1)
    assert snapshot["product_events"].columns == list(ENTITIES["product_events"].columns)
    assert snapshot["product_events"].count() == 37
    window = snapshot.between("product_events", dt.date(2025, 10, 5), dt.date(2025, 12, 31))
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_month" in plan
    assert {r.event_id.split("_")[0] for r in window.collect()} == {"e10", "e11", "e12"}
    read = window.select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("_month=")[1][:10] for r in read} == {"2025-10-01", "2025-11-01", "2025-12-01"}
    assert len(snapshot["product_events"].inputFiles()) == 13
    w = Warehouse(snapshot, Params(dt.date(2025, 12, 31), 90))
    assert w["int_product__account_usage"].first().total_events == 9 - 1  # window starts on October 3


def test_intermediate_tables_need_the_shared_folder():
    class Session:
        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_policy_and_parameters_survive_json():
    policy, params = Policy(high_value_mrr=7), Params(dt.date(2024, 2, 29), 7)
    assert Policy.from_json(policy.to_json()) == policy and Params.from_json(params.to_json()) == params
