"""The corpus pipeline: a table of documents through operators of the library, one written table a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revpulse.llm import mixing, ngram_join, pieces, rule_cascade, toxicity
from revpulse.llm.components import keyed, scratch, written
from revpulse.llm.params import DOMAIN_WEIGHTS, PIECE_MODEL


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the model learns from the labels of the stage's own documents.

    Null and empty texts have the score of the empty window and stay; rows of equal texts go or stay together.
    """
    return toxicity.keep(docs, toxicity.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def passing_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base counts nor a quality rule reject.

    Null and empty texts have too few words and go; rows of equal texts go or stay together.
    """
    return rule_cascade.keep(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of near copies: of the least id, and of several with that id the least hash of the text.

    Rows are grouped each by its own text, so an id that stands for two texts is in two groups. It stays in
    both only if it is the least id of both; of equal rows one stays. Rows without words are near copies of
    nothing and all stay. Rows with a null id are left out. Columns may have any names and types.
    """
    rows = keyed(docs.where("doc_id is not null"), f"{scratch(spark)}/rows")
    groups = ngram_join.near_duplicates(rows.select(F.col("key").alias("doc_id"), "row.text"))
    ids = rows.select("key", F.struct("row.doc_id", F.xxhash64("row.text").alias("hash"), "key").alias("rank"))
    ranked = groups.select(F.col("doc_id").alias("key"), "component_id").join(ids, "key")
    first = ranked.groupBy("component_id").agg(F.min("rank").alias("first")).select("first.key")
    return rows.join(first, "key", "left_semi").select("row.*")


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the weights of domains, languages and sources, once for each epoch.

    Rows without words or id are not drawn; every row is drawn by itself, also of a repeated id.
    """
    return mixing.mixed(docs, DOMAIN_WEIGHTS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids`` of every row; null for a null text, no ids for an empty one."""
    return pieces.encoded(docs, pieces.load(PIECE_MODEL))


STAGES = [
    ("toxicity", without_toxic),
    ("quality rules", passing_rules),
    ("n-gram Jaccard join", one_of_each_group),
    ("mixing sources to target weights", mixed_to_weights),
    ("SentencePiece encoding and decoding", encoded),
]

#: The toxicity stage learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"{folder}/stage-{k}")
    return docs
