"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Recording a call site for every column costs more than building the plan itself.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that every executor can reach: ``spark.checkpoint.dir`` of the session."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError(
            "this needs a folder that all executors share: start the session with the option spark.checkpoint.dir"
        )
    return named.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
