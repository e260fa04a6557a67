"""Manifests, line-delimited JSON and report documents."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import semantics as S
from ..schema import MANIFEST
from . import lines
from .tables import hadoop, prepare_output


class RecordError(ValueError):
    """A line of a file that isn't a record of the kind wanted."""


def read_manifest(spark: SparkSession, path: str, base: str | None = None) -> DataFrame:
    """The rows of a tab-separated manifest: columns by place, header skipped, locations below base resolved, traits a list."""
    df = spark.read.schema(MANIFEST).option("sep", "\t").option("header", True).option("enforceSchema", True).csv(path)
    out = df.withColumn("traits", S.trait_list("traitFromSourceMappedIds"))
    return out.withColumn("summarystatsLocation", S.located("summarystatsLocation", base)) if base is not None else out


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Records of line-delimited JSON files; the first bad line, of the first file that has one, is an error with its number.

    Blank lines are skipped, but counted.
    """
    first = lines.first_bad_lines(spark, schema, required, path).orderBy("file").head(1)
    if first:
        raise RecordError(f"{first[0].file}, line {first[0].line}: not a record with {', '.join(required) or 'the declared fields'}: {first[0].value}")
    rows = lines.checked(spark.read.text(path).where(F.trim("value") != ""), schema)
    return rows.select(*[F.col(f"record.{f.name}").alias(f.name) for f in schema.fields])


def write_jsonl(df: DataFrame, path: str, by: str | None = None, files: int | None = None) -> None:
    """One JSON object a row; with `by`, a folder for each of its values; with `files`, at most so many files."""
    value = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")
    if by:
        df.select(F.col(by).alias(f"_{by}"), value).repartition(f"_{by}").write.mode("overwrite").partitionBy(f"_{by}").text(path)
    else:
        out = df.select(value)
        prepare_output(df.sparkSession, path)
        (out.coalesce(files) if files else out).write.mode("overwrite").text(path)


def write_report(spark: SparkSession, report: dict[str, Any], path: str) -> None:
    """A JSON document with sorted keys on any file system; parents are made, a folder is refused."""
    prepare_output(spark, path, folder=False)
    _, target, fs = hadoop(spark, path)
    out = fs.create(target, True)
    try:
        out.write((json.dumps(report, indent=2, sort_keys=True) + "\n").encode())
    finally:
        out.close()
