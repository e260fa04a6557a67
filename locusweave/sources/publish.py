"""Outputs that become visible together.

A set of outputs is written below `<root>/sets/<id>`; a pointer file that names them is then
renamed into place.  Readers follow the pointer, so they see all of the last set or all of the
one before, whatever happened to a writer.  The set before stays, for readers that have opened it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import Any

from pyspark.sql import SparkSession

from .tables import hadoop, prepare_output, remove_path

POINTER = "CURRENT.json"
#: The published outputs of a whole run and their folders.
TARGETS = {
    "manifest_validation_status": "validation/manifest",
    "loci": "locus_breaker_clumped_study_locus",
    "full_overlap_loci": "collected_loci/full_overlaps",
    "partial_overlap_loci": "collected_loci/partial_overlaps",
    "non_overlap_loci": "collected_loci/non_overlaps",
    "collect_loci_stats": "collected_loci/stats",
    "locus_breaker_status": "status/locus_breaker",
    "locus_collection_status": "status/locus_collection",
    "locus_annotation_status": "status/locus_annotation",
    "locus_annotation": "locus_annotation",
    "fine_mapping_locus_sets": "locus_annotation/fine_mapping_locus_sets",
    "multi_ancestry_pairwise_ld": "locus_annotation/multi_ancestry_pairwise_ld",
    "ld_pair_stats": "locus_annotation/stats",
}


def _pointer(spark: SparkSession, root: str) -> dict[str, Any]:
    jvm, path, fs = hadoop(spark, f"{root}/{POINTER}")
    if not fs.exists(path):
        return {"set": None, "before": None, "outputs": {}}
    stream = fs.open(path)
    try:
        return json.loads(bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, writers: dict[str, Callable[[str], None]], folders: dict[str, str] | None = None) -> str:
    """Call each writer with the path of its output, and make all visible at once; the new set's id.

    folders: where below the set an output goes, by default as it is named.  If a writer
    fails, what is there of the set goes and the error is raised.
    """
    names = {n: (folders or {}).get(n, n) for n in writers}
    if len(set(names.values())) != len(names):
        raise ValueError("outputs share a folder")
    old, new = _pointer(spark, root), uuid.uuid4().hex
    base = f"{root}/sets/{new}"
    try:
        for name, write in writers.items():
            path = f"{base}/{names[name]}"
            prepare_output(spark, path)
            write(path)
        jvm, target, fs = hadoop(spark, f"{root}/{POINTER}")
        staged = jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}")
        out = fs.create(staged, True)
        try:
            out.write((json.dumps({"set": new, "before": old["set"], "outputs": names}, indent=2) + "\n").encode())
        finally:
            out.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context.rename(fs.makeQualified(staged), fs.makeQualified(target), how)
    except BaseException:
        remove_path(spark, base)
        raise
    if old["before"]:
        remove_path(spark, f"{root}/sets/{old['before']}")
    return new


def outputs(spark: SparkSession, root: str) -> dict[str, str]:
    """Paths of the outputs of the visible set by name; none before the first."""
    found = _pointer(spark, root)
    return {n: f"{root}/sets/{found['set']}/{folder}" for n, folder in found["outputs"].items()}


def clean(spark: SparkSession, root: str) -> int:
    """Remove what writers that were killed left, and the set before the visible one; no writer may be at work."""
    keep, (_, sets, fs) = _pointer(spark, root)["set"], hadoop(spark, f"{root}/sets")
    gone = [s.getPath() for s in fs.listStatus(sets) if s.getPath().getName() != keep] if fs.exists(sets) else []
    for path in gone:
        fs.delete(path, True)
    return len(gone)
