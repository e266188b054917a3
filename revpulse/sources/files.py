"""CSV source snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revpulse.operators.keys import union_all
from revpulse.schemas import ENTITIES
from revpulse.sources import Sources


class MissingSources(FileNotFoundError):
    def __init__(self, paths):
        self.paths = list(paths)
        super().__init__("missing source files:\n" + "\n".join(f"- {p}" for p in self.paths))


def source_path(folder: str, entity: str) -> str:
    return f"{folder.rstrip('/')}/{entity}.csv"


def missing_sources(spark: SparkSession, folder: str) -> list[str]:
    """Entities without a file in the folder, in the order of the catalogue."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    paths = {entity: hadoop.Path(source_path(folder, entity)) for entity in ENTITIES}
    return [entity for entity, path in paths.items() if not path.getFileSystem(conf).exists(path)]


def check_sources(spark: SparkSession, folder: str) -> None:
    """Raise once with every missing source, before anything is read."""
    missing = missing_sources(spark, folder)
    if missing:
        raise MissingSources(source_path(folder, entity) for entity in missing)


def source_report(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each source of the catalogue: whether its file is there, and how many rows are in it."""
    missing = missing_sources(spark, folder)
    kind = "source_name string, is_present boolean"
    listed = spark.createDataFrame([(entity, entity not in missing) for entity in ENTITIES], kind)
    counts = [
        read_raw(spark, entity, source_path(folder, entity)).agg(F.count(F.lit(1)).alias("row_count")).withColumn("source_name", F.lit(entity))
        for entity in ENTITIES
        if entity not in missing
    ]
    if not counts:
        return listed.withColumn("row_count", F.lit(None).cast("bigint"))
    return listed.join(F.broadcast(union_all(counts)), "source_name", "left").select("source_name", "is_present", "row_count")


def read_raw(spark: SparkSession, entity: str, path: str) -> DataFrame:
    """One entity from CSV with its declared types.

    A header that does not match the declared columns, or a value that does not
    parse, fails the read instead of shifting columns or leaving nulls.
    """
    if entity not in ENTITIES:
        raise ValueError(f"unknown source entity: {entity}")
    return (
        spark.read.schema(ENTITIES[entity].schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_raw(df: DataFrame, path: str) -> None:
    """One entity as compressed CSV files with a header, one for each task, which ``read_raw`` reads as they are."""
    df.write.option("header", True).option("compression", "gzip").csv(path)


def read_folder(spark: SparkSession, folder: str) -> Sources:
    check_sources(spark, folder)
    return Sources({e: read_raw(spark, e, source_path(folder, e)) for e in ENTITIES})
