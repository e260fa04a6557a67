"""Parquet and delimited tables in and out."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def storage_options(*paths: str, region: str = "us-east-1", anonymous: bool = True) -> dict[str, str]:
    """Hadoop options that public references in S3 or Google storage need, by the paths' schemes; none for others.

    They can be given to a reader, or to the session with "spark.hadoop." before each name.
    """
    schemes = {p.partition("://")[0].lower() for p in paths if "://" in p}
    out: dict[str, str] = {}
    if schemes & {"s3", "s3a"}:
        out |= {"fs.s3.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem", "fs.s3a.endpoint.region": region}
        if anonymous:
            out["fs.s3a.aws.credentials.provider"] = "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider"
    if schemes & {"gs", "gcs"}:
        out["fs.gs.impl"] = "com.google.cloud.hadoop.fs.gcs.GoogleHadoopFileSystem"
    return out


def _reader(spark: SparkSession):
    return spark.read.option("mergeSchema", "true")


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file, or the files of a folder without those of its subfolders."""
    return _reader(spark).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "false").parquet(path)


def split_glob(path: str, glob: str) -> tuple[str, str]:
    """(path, file name pattern) of a glob of files below a path.

    Folders before ** may have patterns; ** is any folders, and may only stand right
    before the file name.  A glob without a folder is a name at any depth.
    """
    *folders, name = glob.split("/")
    if folders[-1:] == ["**"]:
        folders.pop()
    if "**" in folders or name == "**" or not name:
        raise ValueError(f"** may only stand before the file name: {glob}")
    return "/".join([path.rstrip("/"), *folders]), name


def read_tree(spark: SparkSession, *paths: str, glob: str = "*.parquet") -> DataFrame:
    """Parquet files below the paths, united by name; partition folders are columns, read as text.

    glob: of file names at any depth, or of paths below each path, such as x*/**/*.parquet or x/*.parquet.
    """
    frames = [_read_below(spark, p, glob) if "/" in glob else _read_partitions(spark, p, glob) for p in paths]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _read_partitions(spark: SparkSession, path: str, name: str) -> DataFrame:
    # Folders are listed by a few tasks for each core, not by one a folder.
    with setting(spark, "spark.sql.sources.partitionColumnTypeInference.enabled", "false"), setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(_tasks(spark))):
        return _reader(spark).option("pathGlobFilter", name).parquet(path)


def _read_below(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """Files of a path glob; key=value folders, at whatever depth, give columns that files elsewhere lack."""
    there, name = split_glob(path, glob)
    deep = "**" in glob
    rows = _reader(spark).option("pathGlobFilter", name).option("recursiveFileLookup", "true").parquet(there if deep else f"{there}/{name}")
    keys = sorted({part.split("=", 1)[0] for f in rows.inputFiles() for part in f.split("/")[:-1] if "=" in part})
    value = lambda k: F.url_decode(F.nullif(F.nullif(F.regexp_extract(F.col("_metadata.file_path"), f"/{re.escape(k)}=([^/]*)/", 1), F.lit("")), F.lit("__HIVE_DEFAULT_PARTITION__")))
    return rows.select("*", *[value(k).alias(k) for k in keys if k not in rows.columns])


def read_all(spark: SparkSession, *paths: str) -> DataFrame:
    """All Parquet files below any number of paths by one reader, united by name; folders give no columns."""
    return _reader(spark).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(*paths)


def read_files(spark: SparkSession, *paths: str, options: dict[str, str] | None = None) -> DataFrame:
    return _reader(spark).options(**options or {}).parquet(*paths)


def with_file(df: DataFrame, name: str = "sourceFile") -> DataFrame:
    """df with the path of the file that each row is from."""
    return df.withColumn(name, F.col("_metadata.file_path"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the session names for checkpoints, which all executors see.

    A machine-local one is made only where driver and executors are one process.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="locusweave-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named


#: Paths made by scratch() since each owned() block began that is open.
_OWNED: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/locusweave-{name}-{uuid.uuid4().hex}"
    if _OWNED:
        _OWNED[-1].append(path)
    return path


@contextmanager
def owned(spark: SparkSession) -> Iterator[None]:
    """A block whose scratch tables go when it ends, also by an error; what it gives must be read or written within."""
    _OWNED.append([])
    try:
        yield
    finally:
        for path in _OWNED.pop():
            remove_path(spark, path)


def hadoop(spark: SparkSession, path: str) -> tuple[Any, Any, Any]:
    """(the JVM, the path, its file system)."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, there, there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _is_output(name: str) -> bool:
    return name[:1] in "._" or name.startswith("part-") or "=" in name


def prepare_output(spark: SparkSession, path: str, folder: bool = True) -> None:
    """Make the parents of an output and clear its place.

    A file there goes.  A folder that holds what Spark writes gives way to a new one;
    another, or any where the output is one file (`folder` false), is refused.
    """
    _, target, fs = hadoop(spark, path)
    if fs.exists(target):
        if fs.getFileStatus(target).isDirectory():
            if not folder or not all(_is_output(s.getPath().getName()) for s in fs.listStatus(target)):
                raise IsADirectoryError(path)
        else:
            fs.delete(target, False)
    if target.getParent() is not None:
        fs.mkdirs(target.getParent())


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what was written at a path of any file system."""
    _, target, fs = hadoop(spark, path)
    fs.delete(target, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def written(df: DataFrame, name: str = "step") -> tuple[DataFrame, str]:
    """(df as a table in the shared folder, its path).

    Plans over it take their size from its files.  A checkpoint keeps the estimate of the
    plan that made it, so loops that join their last round's rows would double it each time.
    The shuffle files of the making are deleted with it.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def written_some(df: DataFrame, name: str = "step", such: Column | None = None) -> tuple[DataFrame, str, bool]:
    """written(), and whether there are rows (such ones, if told which): seen by the job that writes, so no job asks for it."""
    seen = Observation()
    table, path = written(df.observe(seen, F.count_if(F.lit(True) if such is None else such).alias("n")), name)
    return table, path, bool(seen.get.get("n"))


def materialise(df: DataFrame) -> DataFrame:
    """df computed once, as a table in the shared folder."""
    return written(df)[0]


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def write_table(df: DataFrame, path: str, order: list[Column | str] | None = None, compression: str = "zstd", files: int | None = None) -> None:
    """Parquet at path, replacing what is there; ordered over its files if an order is given.

    The order is a range partitioning, so large outputs are sorted in parallel; `files=1`
    makes one file of it where a single one is wanted.
    """
    out = df.orderBy(*order) if order else df
    out = out.coalesce(files) if files else out
    prepare_output(df.sparkSession, path)
    out.write.mode("overwrite").option("compression", compression).parquet(path)


def write_tsv_gz(df: DataFrame, path: str, files: int | None = 1) -> None:
    prepare_output(df.sparkSession, path)
    out = df.coalesce(files) if files else df
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("compression", "gzip").csv(path)


def _tasks(spark: SparkSession) -> int:
    """Tasks for work that counts by files rather than by bytes."""
    return max(32, 4 * spark.sparkContext.defaultParallelism)


def write_per_key(df: DataFrame, path: str, key: str, keep_key: bool = True) -> None:
    """One folder per value of key; rows with a null key are left out.

    Each key's rows are gathered first, so it has few files.  The time goes by folders: keys are dealt to a
    fixed number of tasks, which adaptive execution would make one of where rows are few.
    """
    rows = df.where(F.col(key).isNotNull())
    name = f"_{key}" if keep_key else key
    rows = rows.withColumn(name, F.col(key)) if keep_key else rows
    n = max(_tasks(df.sparkSession), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows.repartition(n, name).write.mode("overwrite").partitionBy(name).parquet(path)


def merge(spark: SparkSession, folder: str, path: str) -> None:
    """All files of a folder in one."""
    write_table(read_flat(spark, folder), path, files=1)
