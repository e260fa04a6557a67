"""What the operators need from the session."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.tables import shared_dir

ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package, and see that a checkpoint folder is set.

    spark.checkpoint.dir is the cluster's to name; a local folder is used only where it is
    unset and driver and executors are one process.  Where executors don't see the
    driver's folders, the package is sent along with --py-files.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    shared_dir(spark)


def held_out(doc_id) -> "F.Column":
    """crc32 of the doc_id as text, mod 5, is 0.  A null doc_id is not held out."""
    return F.coalesce((F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5) == 0, F.lit(False))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal rows out by a hash of the keys, in as many partitions as the session's shuffles have."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def low_hashes(key: str, hash_of: str, counts: dict, quota: int) -> "F.Column":
    """Whether a row's hash is so low that it may be among the `quota` lowest of its key.

    counts: rows by key.  Half as many again are let pass, so a sample by rank looks at few
    rows of each key, however frequent.
    """
    def most(n: int) -> int:
        share = min(1.0, (1.5 * quota + 50) / n)
        return min(2**63 - 1, int(share * 2**64) - 2**63)

    limits = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(most(n)))])
    return F.xxhash64(hash_of) <= limits[F.col(key)]


def label_sample(labels: DataFrame, label: str, max_rows: int) -> tuple[DataFrame, tuple[float, float]]:
    """(sample_id, sample_label) of at most max_rows labelled ids, evenly of both labels, and how many rows each stands for.

    Ids are taken by their hashes; an id with both labels may be taken twice.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("sample_id"), F.col(label).cast("int").alias("sample_label")).distinct()
    n = {r["sample_label"]: r["count"] for r in usable.groupBy("sample_label").count().collect()}
    rates = tuple(max(1.0, n.get(i, 0) / (max_rows // 2)) for i in (0, 1))
    if not n:
        return usable, rates
    rank = Window.partitionBy("sample_label").orderBy(F.xxhash64("sample_id"), "sample_id")
    chosen = usable.where(low_hashes("sample_label", "sample_id", n, max_rows // 2)).withColumn("sample_rank", F.row_number().over(rank)).where(F.col("sample_rank") <= max_rows // 2)
    return chosen.drop("sample_rank"), rates


def sampled_texts(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id (as text), label and text of the ids of label_sample(): the smallest text of each, so as many rows as ids."""
    texts = docs.select(F.col("doc_id").alias("text_id"), F.coalesce("text", F.lit("")).alias("text"))
    both = texts.join(F.broadcast(chosen), F.col("text_id") == F.col("sample_id"))
    return both.groupBy("sample_id", "sample_label").agg(F.min("text").alias("text")).select(F.col("sample_id").cast("string").alias("doc_id"), F.col("sample_label").alias("label"), "text")
