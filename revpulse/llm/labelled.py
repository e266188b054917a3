"""Which rows may be learned from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fold(column: str, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string")) % folds


def quotas(counts: dict, most: int) -> dict:
    """How many of each class a sample of ``most`` takes: equally many, and what a class lacks goes to the others."""
    found, left = {}, most
    for k, (name, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], str(x[0])))):
        found[name] = min(n, left // (len(counts) - k))
        left -= found[name]
    return found


def sample_ids(rows: DataFrame, most: int, label: str) -> DataFrame:
    """``doc_id``, the class ``label`` and ``weight`` of at most ``most`` distinct ids, split between the classes.

    Of each class those with the least hashes are taken; an id with several classes has the least one. Weights
    give each class its share among all rows again; their mean is 1. Of more than ``most`` classes only the
    largest ones are in the sample. The result is bounded, so it may be broadcast. Before ids are numbered, a
    limit on the hash leaves little more than the sample of each class; only ids are ordered, never texts.
    """
    spark = rows.sparkSession
    once = rows.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull()).groupBy("doc_id").agg(F.min(label).alias(label))
    kind = once.schema[label].dataType.simpleString()
    largest = once.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label).limit(most).collect()
    counts = {r[label]: r["n"] for r in largest}
    taken = quotas(counts, most)
    total, sampled = sum(counts.values()), sum(taken.values())
    # Six deviations more than are wanted pass the limit, so the sample is full at any size.
    shares = [(k, q, min(1.0, (q + 6 * q**0.5 + 20) / counts[k]), counts[k] / total * sampled / q) for k, q in taken.items() if q]
    classes = spark.createDataFrame(shares, f"{label} {kind}, quota long, below double, weight double")
    hashed = once.withColumn("hash", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)))
    near = hashed.join(F.broadcast(classes), label).where(F.col("hash") < F.col("below") * (1 << 40))
    number = F.row_number().over(Window.partitionBy(label).orderBy("hash", "doc_id"))
    return near.withColumn("number", number).where("number <= quota").select("doc_id", label, "weight")
