"""Command line: one command an operation of the engine."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import schema
from .operators import clumping, dataflow, ld, overlap, parity, reports, variants
from .sources import footers, records, tables


#: Columns that tell rows of the engine's outputs apart, as far as both tables have them.
KEYS = ("fineMappingLocusSetId", "studyLocusId", "studyId", "variantId", "chromosome", "position", "locusStart", "locusEnd")


def _session() -> SparkSession:
    return SparkSession.builder.appName("locusweave").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def _parquet_name(path: str) -> str:
    if not path.rstrip("/").endswith(".parquet"):
        raise argparse.ArgumentTypeError(f"{path} should have a .parquet extension")
    return path


def clump(spark: SparkSession, a: argparse.Namespace) -> None:
    config = clumping.ClumpConfig(**{f.name: getattr(a, f.name) for f in fields(clumping.ClumpConfig)})
    out = clumping.clump(tables.read_flat(spark, a.input), config)
    if a.strict and tables.is_empty(out):
        raise clumping.EmptyResult("no locus was found")
    tables.write_table(out, a.output, clumping.output_order(), files=a.files)


def collect_loci(spark: SparkSession, a: argparse.Namespace) -> None:
    frames = [tables.read_tree(spark, p).withColumn("_input", F.lit(p)) for p in a.input]
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f, allowMissingColumns=True)
    overlap.check_inputs(both, len(a.input))
    files = {r.studyId: r._input for r in both.select("studyId", "_input").distinct().collect()}
    rows = both.drop("_input")
    edges = tables.materialise(overlap.edges(rows))
    classified = tables.materialise(overlap.classify(rows, edges, len(a.input)))
    sets = tables.materialise(overlap.full_sets(classified))
    order = ["studyId", "locusStart", "locusEnd", "studyLocusId"]
    tables.write_table(overlap.collect_full(classified, sets), a.full_output, ["fineMappingLocusSetId", *order], files=a.files)
    tables.write_table(overlap.collect_class(classified, overlap.PARTIAL), a.partial_output, order, files=a.files)
    tables.write_table(overlap.collect_class(classified, overlap.NONE), a.non_overlap_output, order, files=a.files)
    records.write_report(spark, overlap.statistics(rows, edges, classified, sets, files), a.stats_output)


def split_loci(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = tables.read_tree(spark, a.input, glob=a.parquet_glob)
    if a.strict and tables.is_empty(rows.where(F.col("fineMappingLocusSetId").isNotNull())):
        raise clumping.EmptyResult("no non-null fineMappingLocusSetId")
    tables.write_per_key(rows, a.output, "fineMappingLocusSetId")


def annotate_ld(spark: SparkSession, a: argparse.Namespace) -> None:
    if not len(a.ancestry) == len(a.index) == len(a.entries):
        raise ValueError("--ancestry, --index and --entries must be given as often as each other")
    metadata = records.read_jsonl(spark, a.metadata, schema.STUDY_METADATA, ("studyId", "ancestry"))
    sources = {n: ld.NativeSource(tables.read_tree(spark, i), tables.read_tree(spark, e)) for n, i, e in zip(a.ancestry, a.index, a.entries, strict=True)}
    pairs, stats = ld.annotate(tables.read_tree(spark, a.input), metadata, sources, a.native_contig_prefix)
    tables.write_table(pairs, a.output, ["ancestry", "variantIdI", "variantIdJ"])
    records.write_jsonl(stats, a.stats_output, files=1)


def ld_parity(spark: SparkSession, a: argparse.Namespace) -> int:
    declared: set[str] = set()
    for path in (a.first_stats, a.second_stats):
        if path:
            declared |= {r.ancestry for r in records.read_jsonl(spark, path, schema.LD_STATS, ("ancestry",)).select("ancestry").distinct().collect()}
    report = parity.report(tables.read_tree(spark, a.first), tables.read_tree(spark, a.second), declared, a.tolerance)
    records.write_report(spark, report, a.report)
    return int(report["totals"]["shared_value_mismatches"] > 0)


def check_ld_pair_stats(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = records.read_jsonl(spark, a.input, schema.LD_STATS, ("ancestry", "n_ld_pairs"))
    if ld.without_pairs(rows).head(1):
        record = {"runId": a.run_id, "path": a.path, "validationStage": dataflow.LD_ANNOTATION, "reason": dataflow.EMPTY_LD_PAIRS, "fineMappingLocusSetId": a.set_id}
        print(json.dumps(record))


def empty_status(spark: SparkSession, a: argparse.Namespace) -> None:
    if not footers.row_count(spark, a.input):
        print(json.dumps({"runId": a.run_id, "path": a.input, "validationStage": a.stage, "reason": dataflow.EMPTY_DATASET}))


def merge(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.merge(spark, a.input, a.output)


def intersection(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.write_table(variants.intersection(tables.read_files(spark, *a.input), len(a.input)), a.output, files=a.files)


def transform(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.write_tsv_gz(variants.with_z_scores(tables.read_flat(spark, a.input)), a.output)


def clumping_report(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.write_table(reports.clumping_report_of([tables.read_flat(spark, p) for p in a.input]), a.output, files=1)


def compare(spark: SparkSession, a: argparse.Namespace) -> int:
    """Rows of a key that one table lacks, and fields that differ by more than the tolerance."""
    first, second = tables.read_tree(spark, a.first), tables.read_tree(spark, a.second)
    keys = tuple(a.key or [c for c in KEYS if c in first.columns and c in second.columns])
    rows = reports.field_differences(first, second, keys, a.tolerance).orderBy(*keys, "place", "field").limit(20).collect()
    for r in rows:
        print(f"{', '.join(f'{k} {r[k]}' for k in keys)}: {r.kind} {r.field or 'row'}: {str(r.first)[:100]} against {str(r.second)[:100]}, apart {r.difference}")
    return int(bool(rows))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="locusweave")
    sub = top.add_subparsers(required=True)

    def command(name: str, run, **options) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=(run.__doc__ or name))
        p.set_defaults(run=run)
        p.add_argument("--files", type=int, help="number of files of each output; by default as many as there are tasks")
        for option, settings in options.items():
            p.add_argument(f"--{option.replace('_', '-')}", dest=option, **settings)
        return p

    need, many, out = {"required": True}, {"required": True, "action": "append"}, {"required": True, "type": _parquet_name}
    p = command("locus_breaker", clump, input=need, output=out, strict={"action": "store_true"})
    for f in fields(clumping.ClumpConfig):
        if f.type in (bool, "bool"):
            p.add_argument(f"--{f.name.replace('_', '-')}", dest=f.name, action=argparse.BooleanOptionalAction, default=f.default)
        else:
            p.add_argument(f"--{f.name.replace('_', '-')}", dest=f.name, type=type(f.default), default=f.default)
    command("collect_finemapping_loci", collect_loci, input=many, full_output=out, partial_output=out, non_overlap_output=out, stats_output=need)
    command("split_finemapping_loci", split_loci, input=need, output=need, parquet_glob={"default": "**/*.parquet"}, strict={"action": "store_true"})
    command("annotate_ld", annotate_ld, input=need, metadata=need, ancestry=many, index=many, entries=many, output=out, stats_output=need, native_contig_prefix={"default": ld.PREFIX})
    command("ld_parity", ld_parity, first=need, second=need, first_stats={}, second_stats={}, report=need, tolerance={"type": float, "default": parity.TOLERANCE})
    command("check_ld_pair_stats", check_ld_pair_stats, input=need, run_id=need, set_id=need, path=need)
    command("empty_status", empty_status, input=need, run_id=need, stage={"required": True, "choices": [dataflow.MANIFEST_STAGE, dataflow.LOCUS_BREAKER, dataflow.LOCUS_COLLECTION]})
    command("collect", merge, input=need, output=out)
    command("intersection", intersection, input=many, output=out)
    command("transform", transform, input=need, output=need)
    command("clumping_report", clumping_report, input=many, output=out)
    command("compare", compare, first=need, second=need, key={"action": "append"}, tolerance={"type": float, "default": 1e-9})
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        return int(a.run(_session(), a) or 0)
    except ValueError as e:
        print(f"error: {e}", file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())
