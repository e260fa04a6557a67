"""Manifests that arrive as files, each handled as a batch by the same plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import MANIFEST, conform, empty
from ..sources.tables import hadoop


def watch(spark: SparkSession, folder: str, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False) -> StreamingQuery:
    """Call handle(manifest rows, batch number) for new tab-separated manifests in a folder.

    The checkpoint remembers files, so one is handled again only if its batch had failed.
    """
    writer = manifests(spark, folder).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def manifests(spark: SparkSession, folder: str, files_a_batch: int | None = None) -> DataFrame:
    """A stream of the rows of tab-separated manifests that arrive in a folder."""
    reader = spark.readStream.schema(MANIFEST).option("sep", "\t").option("header", True)
    return (reader.option("maxFilesPerTrigger", files_a_batch) if files_a_batch else reader).csv(folder)


_BATCH = T.StructField("batch", T.LongType())


def _kept(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of all batches that were kept at a path, with their batch's number."""
    whole = T.StructType([*schema.fields, _BATCH])
    _, there, fs = hadoop(spark, path)
    return spark.read.schema(whole).parquet(path) if fs.exists(there) else empty(spark, whole)


def complete_runs(rows: DataFrame, batch: int, expected: DataFrame, kept: str) -> DataFrame:
    """The members of the runs that a batch of manifest rows completes; expected: runId, nMembers.

    Members are distinct studies, each as it came first; one that comes again, before its run is released or after, has no
    effect.  Rows of runs that are not expected are left out.  Members that came and runs that were released are tables
    below `kept`, a folder a batch, so no task holds a run; a batch that is done again writes its folders anew.  A batch
    reads the keys of the members kept before.
    """
    spark = rows.sparkSession
    wanted = expected.groupBy("runId").agg(F.max("nMembers").alias("_wanted"))
    names = T.StructType([f for f in MANIFEST.fields if f.name == "runId"])
    members, released = f"{kept}/members", f"{kept}/released"
    before = _kept(spark, released, names).where(F.col("batch") < batch).select("runId")
    come = conform(rows, MANIFEST).join(wanted, "runId", "left_semi").join(before, "runId", "left_anti")
    come.select(*MANIFEST.names).write.mode("overwrite").parquet(f"{members}/batch={batch}")
    held = _kept(spark, members, MANIFEST).where(F.col("batch") <= batch)
    touched = held.where(F.col("batch") == batch).select("runId").distinct()
    counted = held.join(touched, "runId", "left_semi").select("runId", "studyId").distinct().groupBy("runId").agg(F.count(F.lit(1)).alias("_n"))
    counted.join(wanted, "runId").where("_n >= _wanted").select("runId").write.mode("overwrite").parquet(f"{released}/batch={batch}")
    done = _kept(spark, released, names).where(F.col("batch") == batch).select("runId")
    first = Window.partitionBy("runId", "studyId").orderBy("batch", *[n for n in MANIFEST.names if n not in ("runId", "studyId")])
    return held.join(done, "runId", "left_semi").withColumn("_at", F.row_number().over(first)).where("_at = 1").select(*MANIFEST.names)


def watch_runs(spark: SparkSession, folder: str, expected: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False, files_a_batch: int | None = None) -> StreamingQuery:
    """Call handle(members of complete runs, batch number) as manifests arrive; a batch without a complete run has no rows.

    Members and released runs are kept beside the checkpoint's own folders, so after a restart a run goes on where it was
    and none is released twice.
    """
    kept = f"{checkpoint.rstrip('/')}/runs"
    writer = manifests(spark, folder, files_a_batch).writeStream.foreachBatch(lambda rows, n: handle(complete_runs(rows, n, expected, kept), n)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
