"""What the footers of Parquet files tell, without reading a row."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession

from .tables import setting

GROUPS = "file string, row_group int, n_rows long, n_bytes long"


def row_count(spark: SparkSession, *paths: str) -> int:
    """Rows of a dataset: counts of its footers, added up where they are read; any file system that Spark has."""
    kept = [x for x in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if x != "parquet"]
    with setting(spark, "spark.sql.sources.useV1SourceList", ",".join(kept)), setting(spark, "spark.sql.parquet.aggregatePushdown", "true"):
        return counted(spark, *paths).first()[0]


def counted(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(*paths).groupBy().count()


def row_groups(spark: SparkSession, *paths: str, files_a_task: int = 64) -> DataFrame:
    """file, row_group, n_rows, n_bytes of every row group of the files below the paths.

    Files are listed by Spark and dealt over tasks, each of which opens a file for its
    footer alone.  File systems are those that pyarrow knows (local, HDFS, S3, Google storage).
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(list(paths)).select("path")
    n = files.count()

    def run(batches):
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, at = pyarrow.fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
                with fs.open_input_file(at) as f:
                    meta = pq.read_metadata(f)
                groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(groups), pa.string()), pa.array(range(len(groups)), pa.int32()), pa.array([g.num_rows for g in groups], pa.int64()), pa.array([g.total_byte_size for g in groups], pa.int64())], names=["file", "row_group", "n_rows", "n_bytes"])

    return files.repartition(max(1, -(-n // files_a_task))).mapInArrow(run, GROUPS)
