"""Gates between the stages: registries, status records and the rows that they remove."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import STATUS, conform, empty

#: Stages and reasons of status records.
MANIFEST_STAGE, LOCUS_BREAKER, LOCUS_COLLECTION, LD_ANNOTATION = "MANIFEST", "LOCUS_BREAKER", "LOCUS_COLLECTION", "LD_ANNOTATION"
EMPTY_DATASET, UNREGISTERED_ANCESTRY, EMPTY_LD_PAIRS = "EMPTY_DATASET", "UNREGISTERED_ANCESTRY", "EMPTY_LD_PAIRS"
#: Fields that a registry entry needs, by the kind of reference.
REGISTRY_FIELDS = {"native": ("ancestry", "ht_path", "bm_path"), "aligned": ("ancestry", "vi_path", "bm_path")}


class RegistryError(ValueError):
    """The LD registry or a method list is not usable."""


def validate_registry(entries: Any, backend: str = "native") -> list[dict[str, str]]:
    """The registry, if it is a non-empty list of complete entries of distinct ancestries."""
    if backend not in REGISTRY_FIELDS:
        raise RegistryError(f"Unknown LD backend: {backend}")
    if not isinstance(entries, list) or not entries:
        raise RegistryError("The LD registry must be a non-empty list")
    for n, e in enumerate(entries, 1):
        lost = [f for f in REGISTRY_FIELDS[backend] if not isinstance(e, dict) or not str(e.get(f) or "").strip()]
        if lost:
            raise RegistryError(f"Entry {n} of the LD registry lacks {', '.join(lost)}")
    names = [e["ancestry"] for e in entries]
    if len(set(names)) != len(names):
        raise RegistryError(f"Ancestries of the LD registry repeat: {', '.join(sorted({a for a in names if names.count(a) > 1}))}")
    return entries


def of_route(manifest: DataFrame, route: str) -> DataFrame:
    return manifest.where(F.col("route") == route)


def branch(manifest: DataFrame, ancestries: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of a registered ancestry, all others)."""
    ok = F.coalesce(F.col("majorAncestry").isin(ancestries), F.lit(False)) if ancestries else F.lit(False)
    return manifest.where(ok), manifest.where(~ok)


def status(rows: DataFrame, stage: str, reason: str, path: str | Column = "path") -> DataFrame:
    """A record of a failed check for each row, repeated ones once."""
    out = rows.withColumn("path", F.col(path) if isinstance(path, str) else path).withColumn("validationStage", F.lit(stage)).withColumn("reason", F.lit(reason))
    return conform(out, STATUS).distinct()


def manifest_status(manifest: DataFrame, ancestries: list[str]) -> DataFrame:
    return status(branch(manifest, ancestries)[1], MANIFEST_STAGE, UNREGISTERED_ANCESTRY, "summarystatsLocation")


def empty_status(spark: SparkSession, df: DataFrame, run_id: str, path: str, stage: str) -> DataFrame:
    """One EMPTY_DATASET record if df has no row, else none."""
    if df.limit(1).count():
        return empty(spark, STATUS)
    return spark.createDataFrame([(run_id, path, stage, EMPTY_DATASET)], STATUS)


def empty_members(expected: DataFrame, found: DataFrame, keys: list[str], stage: str, path: str | Column = "path") -> DataFrame:
    """EMPTY_DATASET records of the expected rows without a row in found; all runs are checked by one plan."""
    return status(expected.join(found.select(*keys).distinct(), keys, "left_anti"), stage, EMPTY_DATASET, path)


def ids(records: DataFrame, key: str = "runId") -> DataFrame:
    return records.select(key).where(F.col(key).isNotNull()).distinct()


def without(rows: DataFrame, records: DataFrame, key: str = "runId") -> DataFrame:
    """rows of runs (or sets) that no record is about; one bad member removes its whole run."""
    return rows.join(ids(records, key), key, "left_anti")


def grouped(rows: DataFrame, key: str = "runId", order: str = "studyId") -> DataFrame:
    """A row a run, members in study order."""
    first = [order, *[c for c in rows.columns if c not in (key, order)]]
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*first))).alias("members"))


def select_registry(requested: DataFrame, registry: DataFrame) -> DataFrame:
    """Registry entries of the requested ancestries; an error if one is missing."""
    lost = requested.select("ancestry").distinct().join(registry, "ancestry", "left_anti").orderBy("ancestry").limit(20).collect()
    if lost:
        raise RegistryError(f"Not in the LD registry: {', '.join(str(r.ancestry) for r in lost)}")
    return registry.join(requested.select("ancestry").distinct(), "ancestry", "left_semi")
