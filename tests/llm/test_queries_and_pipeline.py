import random

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from revpulse.llm import mixing, ngram_join, params, pieces, registry, toxicity
from test_statistics_and_cascade import verdict


@pytest.mark.parametrize("name", sorted(registry.statements()))
def test_query_equals_its_sql(spark, data, name):
    got = registry.queries()[name](spark, data).toPandas()
    with duckdb.connect() as con:
        for table in ("documents", "pages", "labels", "embeddings"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
        expect = con.execute(registry.statements()[name]).df()
    columns = sorted(expect.columns)
    assert sorted(got.columns) == columns
    a, b = (x[columns].sort_values(columns).reset_index(drop=True).astype(str) for x in (got, expect))
    assert a.equals(b)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.queries()) == list(range(1, 14))


def test_stages_are_in_order_and_keep_the_columns(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = spark.read.parquet(f"{data}/labels.parquet")

    clean = pipeline.STAGES[0][1](spark, docs, data)
    score = {r["doc_id"]: r["score"] for r in toxicity.scored(docs, toxicity.trained(docs, labels)).collect()}
    assert clean.columns == columns
    assert {r["doc_id"] for r in clean.collect()} == {k for k, s in score.items() if s < toxicity.THRESHOLD}

    good = pipeline.STAGES[1][1](spark, clean, data)
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in clean.collect() if verdict(r["text"])[1]}

    single = pipeline.STAGES[2][1](spark, good, data)
    roots = {r["component_id"] for r in ngram_join.near_duplicates(good).collect()}
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(roots)

    mixed = pipeline.STAGES[3][1](spark, single, data)
    chosen = mixing.selection(single, params.DOMAIN_WEIGHTS).collect()
    assert mixed.columns == columns and sorted(r["doc_id"] for r in mixed.collect()) == sorted(r["doc_id"] for r in chosen)

    last = pipeline.STAGES[4][1](spark, mixed, data)
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(last, pieces.load(params.PIECE_MODEL)).collect()}
    assert back == {k: before[k] for k in back} and last.count() == mixed.count()


def test_run_equals_the_stages(spark, data):
    rows = pipeline.run(spark, data).select("doc_id", "n_tokens").collect()
    docs = spark.read.parquet(f"{data}/documents.parquet")
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, data)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, docs.select("doc_id", "n_tokens").collect()))


def test_pipeline_of_odd_and_no_documents(spark, tmp_path, data):
    text = " ".join(f"word{k}" for k in range(80))
    odd = [(1, text, "en", "src1", 3), (2, text, None, None, None), (3, None, "en", "src1", 0), (4, "", "en", "x", 0), (None, text, "en", "src1", 1)]
    for name, rows in (("odd", odd), ("none", [])):
        folder = f"{tmp_path}/{name}"
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        ids = [r["doc_id"] for r in pipeline.run(spark, folder).collect()]
        assert ids == ([] if name == "none" else [1])


def test_one_row_of_each_group_with_repeated_ids(spark, data):
    """Equal rows, an id with two rows of one text, and an id with texts of two groups."""
    one, two, three = (" ".join(f"{w}{k}" for k in range(80)) for w in ("apple", "pear", "plum"))
    rows = [(1, one, "en"), (1, one, "en"), (1, one, "de"), (2, one, "en"), (4, two, "en"), (3, two, "en"), (4, three, "fr"), (5, three, "fr"), (2, two, "es"), (None, one, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for table in (docs, docs.orderBy(F.desc("lang"), "doc_id")):
        got = [(r["doc_id"], r["text"]) for r in pipeline.one_of_each_group(spark, table, data).collect()]
        assert sorted(got) == [(1, one), (2, two), (4, three)]


def test_one_row_of_each_group_with_any_columns(spark, data):
    """Names that the stage uses itself, a map, and rows without words."""
    text = " ".join(f"word{k}" for k in range(60))
    rows = [(2, text, {"a": 1}, 5, 6, 7), (1, text, {"b": 2}, 5, 6, 7), (3, None, None, 5, 6, 7), (4, "", {}, 5, 6, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, m map<string, int>, key int, row int, component_id int")
    got = pipeline.one_of_each_group(spark, docs, data)
    assert got.columns == docs.columns and sorted(map(tuple, got.collect()), key=lambda r: r[0]) == [rows[1], rows[2], rows[3]]


def test_a_task_of_the_pipeline_runs_one_python_step(spark, tmp_path, monkeypatch):
    """Steps in a row would hold a worker each, and a worker keeps its memory for later stages."""
    draw = random.Random(5)
    texts = [" ".join(["vile"] * (k % 3 == 0) + draw.choices([f"{a}{b}" for a in "bdfgk" for b in ("orn", "ell", "ust", "ind")], k=60)) for k in range(300)]
    docs = [(k, text, "en", f"src{k % 2}", len(text)) for k, text in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1, int(k % 3 == 0)) for k in range(300)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame, made = type(spark.range(1)), []
    step = frame.mapInArrow
    monkeypatch.setattr(frame, "mapInArrow", lambda self, *a, **k: made.append(step(self, *a, **k)) or made[-1])
    pipeline.run(spark, str(tmp_path))
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in made]
    steps = [part.count("MapInArrow") for plan in plans for part in plan.split("Exchange")]
    assert len(plans) > 10 and max(steps) == 1
