"""What a load and its checks write, and move, at scale."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from revpulse.operators import invariants, product, raw_checks, staging
from revpulse.operators import keys as K
from revpulse.plans.build import derive
from revpulse.plans.relations import Warehouse
from revpulse.schemas import ENTITIES
from revpulse.sources import bound
from revpulse.sources.bound import DEALT, bind
from revpulse.sources.files import read_raw, write_raw
from revpulse.sources.snapshot import publish_snapshot, reload_is_idempotent, table_fingerprint

NOW = dt.datetime(2026, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def same(before, after):
    return all(r.unchanged for r in reload_is_idempotent(table_fingerprint(before), table_fingerprint(after)).collect())


def test_events_are_made_by_tasks_of_a_fair_size(spark, data, monkeypatch):
    """As many tasks as the lines' files call for, however few partitions the lines have, and the same rows."""
    few = bind(spark, data)
    monkeypatch.setattr(bound, "LINE_BYTES", few.bytes_of("lineitem") // 7)
    many = bind(spark, data)["product_events"]
    sizes = [r["count"] for r in many.groupBy(F.spark_partition_id()).count().collect()]
    assert 6 <= len(sizes) <= 8 and max(sizes) < 0.5 * sum(sizes)
    monkeypatch.setattr(bound, "LINE_BYTES", 1 << 40)
    assert same({"product_events": few["product_events"]}, {"product_events": many})


def test_a_busy_account_goes_to_several_tasks(spark, data, monkeypatch):
    one = bind(spark, data)
    monkeypatch.setattr(bound, "LINE_BYTES", one.bytes_of("lineitem") // 7)
    one._subscribed_lines = one._subscribed_lines.withColumn("o_custkey", F.lit(7).cast("bigint"))
    sizes = [r["count"] for r in one["product_events"].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) >= 5 and max(sizes) < 0.5 * sum(sizes)


def test_dealt_rows_are_written_without_a_shuffle(spark, entity, tmp_path):
    rows = [{"event_id": f"e{k}", "account_id": f"a{k % 3}", "occurred_at": f"2025-{k % 3 + 1:02}-02T00:00:00"} for k in range(30)]
    events = entity("product_events", *rows).coalesce(1)
    stored = publish_snapshot(spark, {"product_events": events}, str(tmp_path), NOW, dealt=DEALT)
    assert len(stored["product_events"].inputFiles()) == 3 and same({"product_events": events}, stored)
    again = publish_snapshot(spark, {"product_events": events}, f"{tmp_path}/other", NOW)
    assert same(stored, again)
    by_file = stored["product_events"].select(F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("n"), "account_id").orderBy("f", "n").collect()
    assert [r.account_id for r in by_file if "2025-01" in r.f] == sorted(r.account_id for r in by_file if "2025-01" in r.f)


def test_stored_lines_give_the_same_entities(spark, data, tmp_path):
    stored = bind(spark, data)
    stored.store_lines(f"{tmp_path}/lines")
    names = ("billing_invoices", "billing_payments", "product_events", "support_tickets")
    assert "SortMergeJoin" not in plan_of(stored["billing_payments"]) and "BroadcastHashJoin" not in plan_of(stored["billing_payments"])
    assert same({n: bind(spark, data)[n] for n in names}, {n: stored[n] for n in names})


def test_many_repeated_keys_are_not_read_again(spark):
    """Every relation is scanned once, also if most keys repeat; both hashes have to agree."""
    frames = {"t": spark.range(3000).select(F.concat(F.lit("k"), (F.col("id") % 2000).cast("string")).alias("key"))}
    made = K.key_pass(frames, [K.Unique("t", "key")], [])
    assert [tuple(r) for r in made.collect()] == [(0, 1000)]
    assert plan_of(made).split("== Initial Plan ==")[-1].count("Range (0, 3000") == 1


def test_csv_is_written_compressed_and_read_as_it_is(spark, entity, tmp_path):
    rows = [{"event_id": f"evt_{k}", "account_id": "acc", "event_type": "login", "occurred_at": "2025-01-02T00:00:00"} for k in range(2000)]
    events, path = entity("product_events", *rows).coalesce(1), f"{tmp_path}/product_events.csv"
    write_raw(events, path)
    files = [f for f in (tmp_path / "product_events.csv").iterdir() if f.name.startswith("part")]
    assert files and all(f.name.endswith(".csv.gz") for f in files) and sum(f.stat().st_size for f in files) < 2000 * 20
    back = read_raw(spark, "product_events", path)
    assert back.columns == list(ENTITIES["product_events"].columns) and same({"e": events}, {"e": back})


def test_lines_that_are_not_subscribed_do_not_move(spark, data):
    """A filter of the subscribed orders stands before the join, also if the join itself shuffles."""
    plan = plan_of(bind(spark, data)["billing_payments"])
    assert "bit_or" in plan and "xxhash64(l_orderkey" in plan


def test_stored_lines_are_dealt_by_their_number(spark, data, tmp_path, monkeypatch):
    """However well the base files are compressed, a task makes events of so many lines, which lie in order of accounts."""
    stored = bind(spark, data)
    stored.store_lines(f"{tmp_path}/lines")
    monkeypatch.setattr(bound, "LINES_PER_TASK", stored._stored_lines // 5)
    rows = stored["product_events"].select(F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("n"), F.substring("account_id", 5, 20).cast("int").alias("a"))
    found = rows.orderBy("n").collect()
    assert 4 <= len({r.p for r in found}) <= 7
    for p in {r.p for r in found}:
        mine = [r.a for r in found if r.p == p]
        assert mine == sorted(mine)


def test_keys_of_a_known_number_are_dealt_to_enough_tasks(spark, monkeypatch):
    monkeypatch.setattr(K, "KEYS_PER_TASK", 100)
    frames = {"t": spark.range(3000).select(F.concat(F.lit("k"), (F.col("id") % 2000).cast("string")).alias("key"))}
    made = K.key_pass(frames, [K.Unique("t", "key")], [], keys=3000)
    assert [tuple(r) for r in made.collect()] == [(0, 1000)]
    assert "hashpartitioning(hash" in plan_of(made) and ", 30), REPARTITION_BY_NUM" in plan_of(made)


def test_members_of_an_account_move_as_keys_alone(spark, entity):
    """No measure stands beside the users, whose rows are most of what moves."""
    rows = [{"event_id": f"e{k}", "account_id": "a", "user_id": f"u{k % 7}", "event_type": "login", "occurred_at": "2025-12-02T00:00:00"} for k in range(50)]
    facts = product.usage_facts(staging.stg_events(entity("product_events", *rows)))
    found = facts.collect()
    assert len(found) == 8 and [r.total_events for r in found if r.slot == 0] == [50]
    assert {(r.total_events, r.login_events, r.days_0, r.latest_event_date) for r in found if r.slot == 1} == {(0, 0, None, None)}


def broadcast_unmeasured(df):
    """Broadcasts of a plan that no shuffle has measured; what Spark knows of them is the bytes of their files."""
    lines, found = plan_of(df).splitlines(), []
    depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
    for k, line in enumerate(lines):
        if line[depth[k] :].startswith("BroadcastExchange"):
            end = next((j for j in range(k + 1, len(lines)) if depth[j] <= depth[k]), len(lines))
            if not any("Exchange " in below for below in lines[k + 1 : end]):
                found.append(line)
    return found


def test_no_written_relation_is_broadcast_by_the_bytes_of_its_files(spark, entity, tmp_path):
    accounts = [{"account_id": f"a{k}", "account_name": f"n{k}", "created_at": "2024-01-01"} for k in range(20)]
    customers = [{"billing_customer_id": f"c{k}", "account_id": f"a{k // 2}"} for k in range(9)]
    subscriptions = [
        {"subscription_id": f"s{k}", "account_id": f"a{k}", "billing_customer_id": f"c{k}", "status": "active", "mrr_usd": "5", "arr_usd": "60", "start_date": "2025-01-01"} for k in range(9)
    ]
    sources = {e: entity(e) for e in ENTITIES} | {
        "crm_accounts": entity("crm_accounts", *accounts),
        "billing_customers": entity("billing_customers", *customers),
        "billing_subscriptions": entity("billing_subscriptions", *subscriptions),
    }
    w = Warehouse(publish_snapshot(spark, sources, f"{tmp_path}/load", NOW))
    derive(w, spark, f"{tmp_path}/derived")
    again = lambda name: Warehouse(w.sources, w.params, w.policy, w.written(without=name))[name]
    for name in ("int_customer__account_base", "int_revenue__subscriptions_enriched", "int_customer__health_signals"):
        assert broadcast_unmeasured(again(name)) == [], name
    assert again("int_customer__account_base").count() == 20 + 4 and again("int_revenue__subscriptions_enriched").count() == 9
    assert broadcast_unmeasured(invariants.assert_risk_mart_only_risk(w["mart_churn_risk"], w["mart_account_360"])) == []
    assert broadcast_unmeasured(K.lost_references(w["crm_deals"], "account_id", w["crm_accounts"], "account_id")) == []
    small = w["crm_accounts"].alias("l").join(w["billing_customers"].alias("r"), "account_id")
    assert broadcast_unmeasured(small)  # what Spark would do by itself


def test_a_fingerprint_adds_numbers_and_makes_each_text_once(spark, frame):
    """The digests are sums of md5 parts of length-prefixed fields; no decimal is made for a row, no text twice."""
    rows = [("a", "2025-12-02T03:04:05", "1.50"), (None, None, None), ("", "2025-12-02T03:04:05.100000", "-2"), ("größe", None, "0"), ("a", "2025-12-02T03:04:05", "1.50")]
    made = table_fingerprint({"t": frame("k string, at timestamp_ntz, x decimal(18,2)", *[(k, at and dt.datetime.fromisoformat(at), x) for k, at, x in rows])})
    texts = [(k, at and at.replace("T", " ").replace(".100000", ".1"), x and f"{float(x):.2f}") for k, at, x in rows]
    digests = [hashlib.md5("".join("-" if t is None else f"{len(t)}:{t}" for t in r).encode()).hexdigest() for r in texts]
    high, low = (str(sum(int(d[start : start + 15], 16) for d in digests)) for start in (0, 16))
    assert [tuple(r) for r in made.collect()] == [("t", 5, high, low)]
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(at#") == 1 and "sum(cast(conv" not in plan
    assert [tuple(r) for r in table_fingerprint({"t": frame("k string")}).collect()] == [("t", 0, "0", "0")]


def test_times_are_not_made_into_texts_to_find_blank_ones(spark, entity, frame):
    metrics = raw_checks.load_metrics(ENTITIES["product_events"], entity("product_events"))
    assert "STRING" not in str(metrics["blank", "occurred_at"]).upper()
    asked = [("2025-01-02T00:00:00",), (None,)]
    typed = frame("occurred_at timestamp_ntz", *[(t and dt.datetime.fromisoformat(t),) for (t,) in asked])
    texts = frame("occurred_at string", *asked, ("",))
    for df, n in ((typed, 1), (texts, 2)):
        assert df.agg(raw_checks.load_metrics(ENTITIES["product_events"], df)["blank", "occurred_at"].alias("n")).first().n == n
