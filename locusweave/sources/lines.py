"""Lines of text files with their true numbers, at any size.

A file is read in splits, each of which gives its lines in order.  Counting the lines of
every split and adding up the counts of a file's splits before each (a row a split, not a
line) gives the number of each split's first line, so lines are numbered wherever they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import written


def split_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """file, split (the byte at which it starts), id (ascending within a split, without gaps) and value of every line."""
    at = F.col("_metadata")
    return spark.read.text(list(paths)).select(at["file_path"].alias("file"), at["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("id"), "value")


def split_index(lines: DataFrame, *more: Column) -> DataFrame:
    """A row a split: file, split, n, first id, and `before`, the file's lines before it; more: further aggregates."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    per = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"), *more)
    return per.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def numbered(spark: SparkSession, *paths: str) -> DataFrame:
    """file, line (from 1, blank ones counted) and value of every line of the files.

    The lines are a table in the shared folder, since ids are those of one scan.
    """
    lines, _ = written(split_lines(spark, *paths), "lines")
    index, _ = written(split_index(lines), "splits")  # small, so it is broadcast by its size
    return lines.join(index, ["file", "split"]).select("file", (F.col("before") + F.col("id") - F.col("first") + 1).alias("line"), "value")


def checked(lines: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """lines with `record`, the JSON object of the schema, and `bad`: not blank, but no object, or without a required field."""
    whole = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    bad = F.col("record").isNull() | F.col("record._bad").isNotNull()
    for name in required:
        bad = bad | F.col(f"record.{name}").isNull()
    return lines.withColumn("record", F.from_json("value", whole, {"columnNameOfCorruptRecord": "_bad"})).withColumn("bad", (F.trim("value") != "") & bad)


def first_bad_lines(spark: SparkSession, schema: T.StructType, required: tuple[str, ...], *paths: str) -> DataFrame:
    """file, line and value (its beginning) of the first bad line of each file that has one; the files are read once."""
    worst = F.min(F.when(F.col("bad"), F.struct("id", F.substring("value", 1, 200).alias("value")))).alias("worst")
    found = split_index(checked(split_lines(spark, *paths), schema, required), worst).where(F.col("worst").isNotNull())
    line = F.struct((F.col("before") + F.col("worst.id") - F.col("first") + 1).alias("line"), F.col("worst.value").alias("value"))
    return found.groupBy("file").agg(F.min(line).alias("at")).select("file", "at.*")
