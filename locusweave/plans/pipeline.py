"""The whole dataflow as one set of plans over all runs at once.

Every stage's rows carry runId, so what a task-per-run scheduler would fan out is one
partitioned plan a stage; a failed member removes its run (or set) by an anti join and
leaves a status record.
"""

from __future__ import annotations

import platform
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import clumping, dataflow, ld, methods, overlap
from ..schema import LD_NATIVE_STATUS, LD_RUN_STATS, PAIRWISE_LD, conform, empty
from ..sources import publish, records, tables

RUN = ("runId",)
#: The engine's own version, part of the versions of every stage.
VERSION = "0.3"


Clumping = Callable[[DataFrame, clumping.ClumpConfig], DataFrame]
#: Methods of clumping by name; another is added by its function.
CLUMPING: dict[str, Clumping] = {"locus_breaker": clumping.clump, "windows": clumping.clump_windows}


def clumping_method(name: str) -> Clumping:
    if name.lower() not in CLUMPING:
        raise ValueError(f"Unknown clumping method {name!r}; known are {', '.join(sorted(CLUMPING))}")
    return CLUMPING[name.lower()]


@dataclass(frozen=True)
class PipelineConfig:
    route: str | None = None
    clump: clumping.ClumpConfig = field(default_factory=clumping.ClumpConfig)
    clump_method: str = "locus_breaker"  # a name of CLUMPING
    methods: tuple[str, ...] = methods.DEFAULT
    fits: tuple[methods.Method, ...] = ()  # models of some of the methods, fitted to every locus set
    prefix: str = ld.PREFIX
    strict: bool = False  # a run without loci is an error instead of a status


@dataclass
class PipelineResult:
    """The published datasets by name; nothing is computed before it is written or read."""

    tables: dict[str, DataFrame]

    def publish(self, root: str) -> str:
        """Write all as one set, which readers see whole or not at all; its id."""
        known = {table: folder for table, folder in ((TABLES.get(n), f) for n, f in publish.TARGETS.items()) if table}

        def writer(name: str, df: DataFrame) -> Callable[[str], None]:
            if name.endswith(("_status", "_stats")) or name == "status":
                return lambda path: records.write_jsonl(df, path)
            if name == "locus_sets":
                return lambda path: tables.write_per_key(df, path, "fineMappingLocusSetId")
            return lambda path: tables.write_table(df, path)

        spark = next(iter(self.tables.values())).sparkSession
        return publish.publish(spark, root, {n: writer(n, df) for n, df in self.tables.items()}, known)


#: The published outputs that are tables of a result; the others are made of these.
TABLES = {
    "manifest_validation_status": "manifest_status",
    "loci": "study_locus",
    "full_overlap_loci": "full_overlap",
    "partial_overlap_loci": "partial_overlap",
    "non_overlap_loci": "non_overlap",
    "collect_loci_stats": "collect_stats",
    "locus_breaker_status": "locus_breaker_status",
    "locus_collection_status": "locus_collection_status",
    "locus_annotation_status": "ld_annotation_status",
    "fine_mapping_locus_sets": "locus_sets",
    "multi_ancestry_pairwise_ld": "pairwise_ld",
    "ld_pair_stats": "ld_stats",
}


def read_sumstats(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Summary statistics of the manifest's studies; the manifest has a row a study, so its paths are few."""
    paths = [r[0] for r in manifest.select("summarystatsLocation").distinct().collect()]
    return tables.read_all(spark, *paths) if paths else empty(spark, clumping.SUMSTATS)


def ld_sources(spark: SparkSession, registry: Any, backend: str = "native", prefix: str = ld.PREFIX) -> dict[str, ld.LdSource]:
    """The references of a registry by ancestry; native ones are looked up in both orders of alleles, aligned ones in theirs."""
    entries = dataflow.validate_registry(registry, backend)
    opened = lambda path: spark.read.options(**tables.storage_options(path)).parquet(path)
    if backend == "aligned":
        return {e["ancestry"]: ld.AlignedSource(opened(e["vi_path"]), opened(e["bm_path"]), prefix) for e in entries}
    return {e["ancestry"]: ld.NativeSource(opened(e["ht_path"]), opened(e["bm_path"])) for e in entries}


def run(manifest: DataFrame, sumstats: DataFrame, sources: dict[str, ld.LdSource], config: PipelineConfig | None = None) -> PipelineResult:
    """manifest: its contract columns; sumstats: of all studies; sources: LD by ancestry."""
    config = config or PipelineConfig()
    spark = manifest.sparkSession
    methods.validate_methods(config.methods)
    clump = clumping_method(config.clump_method)
    if lost := sorted({f.name for f in config.fits} - set(config.methods)):
        raise dataflow.RegistryError(f"Not among the methods: {', '.join(lost)}")
    rows = dataflow.of_route(manifest, config.route) if config.route else manifest
    manifest_status = dataflow.manifest_status(rows, list(sources))
    valid = dataflow.without(rows, manifest_status)
    members = valid.select("runId", "studyId", "summarystatsLocation", F.col("majorAncestry").alias("ancestry")).distinct()
    ld.validate_studies(members, members.select("studyId", "ancestry").distinct(), list(sources))

    loci = clump(sumstats.join(members.select("studyId").distinct(), "studyId", "left_semi"), config.clump)
    loci = tables.materialise(members.select("runId", "studyId").join(loci, "studyId"))
    clump_status = dataflow.empty_members(members, loci, ["runId", "studyId"], dataflow.LOCUS_BREAKER, "summarystatsLocation")
    if config.strict and clump_status.head(1):
        raise clumping.EmptyResult("a study has no locus")
    loci = dataflow.without(loci, clump_status)

    edges = overlap.edges(loci, RUN)
    classified = tables.materialise(overlap.classify(loci, edges, keys=RUN))
    sets = overlap.full_sets(classified, RUN)
    full = tables.materialise(overlap.collect_full(classified, sets, RUN))
    runs = loci.select("runId").distinct()
    collect_status = dataflow.empty_members(runs, full, ["runId"], dataflow.LOCUS_COLLECTION, F.col("runId"))
    full = dataflow.without(full, collect_status)

    pairs, status, figures = empty(spark, PAIRWISE_LD), empty(spark, LD_NATIVE_STATUS).withColumn("ancestry", F.lit(None).cast("string")), []
    for ancestry, source in sources.items():
        studies = members.where(F.col("ancestry") == ancestry).select("studyId").distinct()
        done = ld.annotated(full.dropDuplicates(["studyLocusId"]), studies, source, ancestry, config.prefix)
        pairs = pairs.unionByName(done.pairs)
        status = status.unionByName(done.status.withColumn("ancestry", F.lit(ancestry)))
        figures.append(tuple(done.figures.values()))
    counted = spark.createDataFrame(figures, LD_RUN_STATS)
    # A set has pairs for an ancestry if one of its variants is resolved there, as each has a diagonal.
    resolved = status.where(F.col("status_code").isin(ld.EXACT, ld.FLIPPED)).groupBy(F.col("locus_id").alias("studyLocusId")).agg(F.count(F.lit(1)).alias("_n"))
    per = full.select("runId", "fineMappingLocusSetId", "studyId", "studyLocusId").join(members.select("runId", "studyId", "ancestry"), ["runId", "studyId"]).join(resolved, "studyLocusId", "left")
    poor = per.groupBy("runId", "fineMappingLocusSetId", "ancestry").agg(F.sum(F.coalesce("_n", F.lit(0))).alias("n")).where("n = 0")
    ld_status = dataflow.status(poor.withColumn("path", F.col("fineMappingLocusSetId")), dataflow.LD_ANNOTATION, dataflow.EMPTY_LD_PAIRS)
    kept = full.join(poor.select("fineMappingLocusSetId").distinct(), "fineMappingLocusSetId", "left_anti")

    variants = {m: (methods.union_variants if methods.METHODS[m] == "union" else methods.shared_variants)(kept, keys=RUN) for m in config.methods}
    collect_stats = overlap.run_statistics(loci, edges, classified, sets, RUN)
    tools = [("engine", VERSION), ("spark", spark.version), ("python", platform.python_version()), ("pyarrow", pa.__version__)]
    stages = {dataflow.MANIFEST_STAGE: "", dataflow.LOCUS_BREAKER: config.clump_method, dataflow.LOCUS_COLLECTION: "", dataflow.LD_ANNOTATION: "", "FINE_MAPPING": ",".join(config.methods)}
    versions = spark.createDataFrame([(stage, method, name, version) for stage, method in stages.items() for name, version in tools], "stage string, method string, name string, version string")
    out = {
        "versions": versions,
        "collect_stats": collect_stats,
        "ld_stats": counted,
        "manifest": valid,
        "manifest_status": manifest_status,
        "locus_breaker_status": clump_status,
        "locus_collection_status": collect_status,
        "ld_annotation_status": ld_status,
        "status": manifest_status.unionByName(clump_status).unionByName(collect_status).unionByName(ld_status),
        "study_locus": loci.select(*RUN, *clumping.STUDY_LOCUS.names),
        "partial_overlap": overlap.collect_class(classified, overlap.PARTIAL, RUN),
        "non_overlap": overlap.collect_class(classified, overlap.NONE, RUN),
        "full_overlap": full,
        "locus_sets": kept,
        "pairwise_ld": conform(pairs, PAIRWISE_LD),
    }
    if config.fits:
        out["fine_mapping"] = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [methods.fan_out(variants[f.name], [f], RUN) for f in config.fits])
    return PipelineResult(out | {f"variants_{m}": v for m, v in variants.items()})
