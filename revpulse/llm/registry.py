"""One named query for each training-data operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment,
    centroids,
    grouping,
    host_reputation,
    language,
    mixing,
    ngram_join,
    oracle,
    packing,
    pieces,
    quality_rules,
    rule_cascade,
    toxicity,
    vector_graph,
)
from .params import BYTE_VOCABULARY, BYTE_VOCABULARY_JSON, DOMAIN_WEIGHTS, PIECE_MODEL, TOKEN_PATTERN, URL_RULES, WORD_VOCABULARY_JSON


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.selection(_table(spark, folder, "documents"), DOMAIN_WEIGHTS)


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, _table(spark, folder, "labels")))


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return language.predicted(docs, language.trained(docs))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(_table(spark, folder, "documents"), pieces.load(PIECE_MODEL), check=True)


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, folder, "documents"))


def op6_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    """A page's outcome is the quality label of the document whose number its path holds."""
    pages, labels = _table(spark, folder, "pages"), _table(spark, folder, "labels")
    number = F.regexp_extract(F.col("path"), r"/([0-9]{1,18})", 1)
    numbered = host_reputation.located(pages).select("page_id", F.nullif(number, F.lit("")).cast("long").alias("doc_id"))
    outcomes = numbered.join(labels.select("doc_id", F.col("quality").alias("good")), "doc_id")
    return host_reputation.judged(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op7_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_table(spark, folder, "documents"), packing.load_ranks(BYTE_VOCABULARY), TOKEN_PATTERN)


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graph.near_duplicates(_table(spark, folder, "embeddings"))


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.scored(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rule_cascade.judged(_table(spark, folder, "documents")).drop("rejected_by")


def op11_group_packing(spark: SparkSession, folder: str) -> DataFrame:
    encoder = grouping.word_level(WORD_VOCABULARY_JSON)
    return grouping.packed(_table(spark, folder, "documents"), encoder, shown=F.crc32, name="ids_crc32")


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    a, b = alignment.byte_level(BYTE_VOCABULARY_JSON), alignment.spaced_pieces(PIECE_MODEL)
    digest = lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256))
    return alignment.aligned(_table(spark, folder, "documents"), a, b, digest, "groups_sha256")


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    found = centroids.clustered(_table(spark, folder, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2("centroid", 256)).drop("centroid")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (
            op1_mixing,
            op2_toxicity,
            op3_language_id,
            op4_sentencepiece,
            op5_ngram_jaccard_join,
            op6_url_filters,
            op7_token_output,
            op8_embedding_near_dedup,
            op9_quality_classifier,
            op10_quality_rules,
            op11_group_packing,
            op12_token_alignment,
            op13_centroid_clustering,
        )
    }


def statements() -> dict[str, str]:
    return oracle.statements()
