"""Overlap of study loci across the studies of a run, and exact candidate sets.

Every function takes `keys`, the columns that name a run; with none, all rows are one run.
"""

from __future__ import annotations

from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COLLECTED_LOCUS
from ..sources.tables import remove_path, written, written_some
from .intervals import overlapping, points_within

FULL, PARTIAL, NONE = "full", "partial", "non_overlap"
#: The quality-control label of each class.
LABELS = {FULL: "overlapping set", PARTIAL: "partial-overlapping studyLocus", NONE: "non-overlapping studyLocus"}
SPAN = ("locusStart", "locusEnd")


class InputMismatch(ValueError):
    """Inputs are not one per distinct studyId."""


def check_inputs(loci: DataFrame, n_inputs: int) -> None:
    n = loci.select("studyId").distinct().count()
    if n != n_inputs:
        raise InputMismatch(f"{n_inputs} inputs hold {n} distinct studyId values; each input must be of its own studyId")


def edges(loci: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Overlapping loci of different studies, in both directions."""
    rows = loci.select(*keys, "studyLocusId", "studyId", "chromosome", *SPAN)
    pairs = overlapping(rows, rows, (*keys, "chromosome"), SPAN, SPAN, F.col("l.studyId") != F.col("r.studyId"))
    return pairs.select(*[F.col(f"l.{k}").alias(k) for k in keys], F.col("l.studyLocusId").alias("studyLocusId1"), F.col("r.studyLocusId").alias("studyLocusId2"), F.col("r.studyId").alias("studyId2"))


def run_sizes(loci: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Number of studies of each run."""
    return loci.groupBy(*keys).agg(F.countDistinct("studyId").cast("int").alias("nStudies"))


def classify(loci: DataFrame, overlap_edges: DataFrame, n_inputs: int | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """loci with nOverlappingStudies (other studies) and overlapClass; a locus is full if it overlaps all others."""
    counts = overlap_edges.groupBy(*keys, F.col("studyLocusId1").alias("studyLocusId")).agg(F.countDistinct("studyId2").alias("nOverlappingStudies"))
    out = loci.join(counts, [*keys, "studyLocusId"], "left").withColumn("nOverlappingStudies", F.coalesce("nOverlappingStudies", F.lit(0)).cast("long"))
    if n_inputs is not None:
        others = F.lit(n_inputs - 1)
    elif keys:
        out = out.join(run_sizes(loci, keys), list(keys))
        others = F.col("nStudies") - 1
    else:
        others = F.lit(run_sizes(loci, keys).first()[0] - 1)
    n = F.col("nOverlappingStudies")
    out = out.withColumn("overlapClass", F.when(n == others, FULL).when(n > 0, PARTIAL).otherwise(NONE))
    return out.drop("nStudies")


#: Sets that are numbered in one array when they are spelled out.
_RUN_OF_SETS = 4096


def full_sets(classified: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """fineMappingLocusSetId and memberIds (in study order) of each set of one full locus of every study, all overlapping.

    Closed intervals of a line overlap pairwise if and only if they share a point, and then
    they share the start of the one that starts last.  So every locus, as the last of its
    sets, meets the loci of other studies that hold its start and started before (of equal starts, the
    smaller id): one join, whatever the number of studies.  Where all studies are there, its sets
    are the products of their loci, spelled out by number.
    """
    eligible = classified.where(F.col("overlapClass") == FULL).select(*keys, "studyLocusId", "studyId", "chromosome", *SPAN)
    sizes = run_sizes(classified, keys)
    pairs = points_within(eligible, eligible, (*keys, "chromosome"), SPAN[0], SPAN)
    before = F.struct(F.col(f"s.{SPAN[0]}"), F.col("s.studyLocusId")) < F.struct(F.col(f"p.{SPAN[0]}"), F.col("p.studyLocusId"))
    others = pairs.where((F.col("s.studyId") != F.col("p.studyId")) & before)
    last = [*[F.col(f"p.{k}").alias(k) for k in keys], F.col("p.studyLocusId").alias("lastId"), F.col("p.studyId").alias("lastStudy"), *[F.col(f"p.{c}").alias(f"last_{c}") for c in ("chromosome", *SPAN)]]
    group = [*keys, "lastId", "lastStudy", "last_chromosome", *[f"last_{c}" for c in SPAN]]
    member = others.select(*last, F.col("s.studyId").alias("studyId"), F.col("s.studyLocusId").alias("studyLocusId"))
    alone = eligible.select(*keys, F.col("studyLocusId").alias("lastId"), F.col("studyId").alias("lastStudy"), *[F.col(c).alias(f"last_{c}") for c in ("chromosome", *SPAN)], "studyId", "studyLocusId")
    per_study = member.unionByName(alone).groupBy(*group, "studyId").agg(F.array_sort(F.collect_list("studyLocusId")).alias("ids"))
    per = per_study.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("studyId", "ids"))).alias("studies"))
    if keys:
        whole = per.join(sizes, list(keys)).where(F.size("studies") == F.col("nStudies"))
    else:
        n = sizes.first()
        whole = per.where(F.size("studies") == (n[0] if n else 0))
    lists = F.transform("studies", lambda s: s["ids"])
    # strides[i] is the product of the sizes of the lists after i, and the first of all of them.
    strides = F.reverse(F.aggregate(F.reverse(lists), F.array(F.lit(1).cast("long")), lambda a, x: F.array_append(a, F.element_at(a, -1) * F.size(x))))
    rows = whole.select(*keys, lists.alias("lists"), strides.alias("strides")).withColumn("n", F.col("strides")[0])
    rows = rows.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {_RUN_OF_SETS}"))).alias("run"))
    rows = rows.select("*", F.explode(F.sequence(F.col("run") * _RUN_OF_SETS, F.least((F.col("run") + 1) * _RUN_OF_SETS, F.col("n")) - 1)).alias("number"))
    ids = F.transform("lists", lambda x, i: F.get(x, (F.call_function("div", F.col("number"), F.get("strides", i + 1)) % F.size(x)).cast("int")))
    return rows.select(*keys, ids.alias("memberIds")).select(*keys, set_id(F.col("memberIds")).alias("fineMappingLocusSetId"), "memberIds")


def set_id(members: Column) -> Column:
    return F.md5(F.array_join(F.array_sort(members), "|"))


def set_members(sets: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return sets.select(*keys, "fineMappingLocusSetId", F.explode("memberIds").alias("studyLocusId"))


def collected(rows: DataFrame, overlap_class: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """The collected-locus columns: class label appended to the quality controls, variants with five fields."""
    five = F.transform("locus", lambda v: F.struct(*[v[f.name].cast(f.dataType).alias(f.name) for f in COLLECTED_LOCUS["locus"].dataType.elementType.fields]))
    values = {
        "fineMappingLocusSetId": F.col("fineMappingLocusSetId") if "fineMappingLocusSetId" in rows.columns else F.lit(None),
        "qualityControls": F.array_append(F.coalesce("qualityControls", F.array().cast("array<string>")), F.lit(LABELS[overlap_class])),
        "locus": five,
    }
    return rows.select(*keys, *[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in COLLECTED_LOCUS.fields])


def collect_class(classified: DataFrame, overlap_class: str, keys: tuple[str, ...] = ()) -> DataFrame:
    return collected(classified.where(F.col("overlapClass") == overlap_class), overlap_class, keys)


def collect_full(classified: DataFrame, sets: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """A row for each member of each set; a locus may be in several."""
    return collected(set_members(sets, keys).join(classified, [*keys, "studyLocusId"]), FULL, keys)


#: Nodes that a task holds at once while it draws links together.
HELD_NODES = 1_000_000


def _stars(batches):
    """Links (a, b) of a partition as those of each node with the smallest one that it reaches there."""
    parent: dict = {}

    def root(x):
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def drawn(schema):
        ends = [(x, r) for x in parent if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([e[i] for e in ends], schema.field(i).type) for i in (0, 1)], names=["a", "b"])

    schema = None
    for batch in batches:
        schema = batch.schema
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        if len(parent) > HELD_NODES:
            yield drawn(schema)
            parent.clear()
    if schema is not None:
        yield drawn(schema)


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(id, component): the smallest id that each of the nodes reaches by undirected (a, b) links.

    The links of each partition are first replaced by those of its nodes with the smallest
    that they reach within it, so a small graph is nearly done at once.  Each round then
    contracts the rest: a node goes to its smallest neighbour if that is
    smaller, and on to where this one goes; links between nodes that are now one vanish.  The
    smallest id of a component never moves, so its label is what stays when no link is left.
    Each round's links and labels are tables, which replace those before.
    """
    spark = nodes.sparkSession
    links = links.select("a", "b").where("a <> b")
    links = links.mapInArrow(_stars, links.schema)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    (left, left_at, some), (labels, labels_at) = written_some(both, "links"), written(nodes.select("id").distinct().select("id", F.col("id").alias("component")), "labels")
    while some:
        hook = left.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("to"))
        to, to_at = written(hook, "hooks")
        moving = True
        while moving:  # to where chains of smaller neighbours end; each pass halves them
            ends = to.join(to.select(F.col("a").alias("to"), F.col("to").alias("next")), "to", "left").select("a", F.coalesce("next", "to").alias("to"), (F.col("next") < F.col("to")).alias("moved"))
            (further, further_at, moving), old_at = written_some(ends, "hooks", F.col("moved")), to_at
            to, to_at = further.select("a", "to"), further_at
            remove_path(spark, old_at)
        there = lambda df, c: df.join(to.select(F.col("a").alias(c), F.col("to").alias("_to")), c, "left").withColumn(c, F.coalesce("_to", c)).drop("_to")  # noqa: E731, B023
        (fewer, fewer_at, some), (moved, moved_at) = written_some(there(there(left, "a"), "b").select("a", "b").where("a <> b").distinct(), "links"), written(there(labels, "component").select("id", "component"), "labels")
        for path in (left_at, labels_at, to_at):
            remove_path(spark, path)
        left, left_at, labels, labels_at = fewer, fewer_at, moved, moved_at
    remove_path(spark, left_at)
    return labels


def component_metrics(classified: DataFrame, overlap_edges: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """componentCount, maxComponentLocusCount and maxComponentCandidateProductSize of each run's full loci.

    The product, a decimal of 38 digits, counts only components that hold every study of the run.
    """
    eligible = classified.where(F.col("overlapClass") == FULL).select(*keys, "studyLocusId", "studyId").distinct()
    label = lambda c: F.concat_ws("|", *[F.col(k) for k in keys], c) if keys else F.col(c)
    ids = eligible.withColumn("id", label("studyLocusId"))
    links = overlap_edges.select(label("studyLocusId1").alias("a"), label("studyLocusId2").alias("b"))
    known = ids.select("id")
    links = links.join(known.withColumnRenamed("id", "a"), "a", "left_semi").join(known.withColumnRenamed("id", "b"), "b", "left_semi")
    found = ids.join(components(known, links), "id")
    per_study = found.groupBy(*keys, "component", "studyId").agg(F.count(F.lit(1)).alias("n"))
    per = per_study.groupBy(*keys, "component").agg(F.sum("n").alias("loci"), F.count(F.lit(1)).alias("studies"), F.collect_list("n").alias("_each"))
    # An exact product; one of more than 38 digits is null.  A component has a number a study.
    per = per.withColumn("product", F.aggregate("_each", F.lit(1).cast("decimal(38,0)"), lambda p, n: F.try_multiply(p, n.cast("decimal(20,0)")).cast("decimal(38,0)"))).drop("_each")
    sizes = run_sizes(classified, keys)
    per = sizes.join(per, list(keys), "left") if keys else per.withColumn("nStudies", F.lit(sizes.first()[0]))
    whole = F.when(F.col("studies") == F.col("nStudies"), F.col("product"))
    return per.groupBy(*keys).agg(F.count("component").alias("componentCount"), F.coalesce(F.max("loci"), F.lit(0)).alias("maxComponentLocusCount"), F.coalesce(F.max(whole), F.lit(0)).alias("maxComponentCandidateProductSize"))


def class_counts(rows: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return rows.groupBy(*keys, "studyId").agg(F.count(F.lit(1)).alias("rowCount"))


def _section(rows: DataFrame) -> dict[str, Any]:
    by = {r.studyId: r.rowCount for r in class_counts(rows).orderBy("studyId").collect()}
    return {"rowCount": sum(by.values()), "studyIdsWithRows": list(by), "byStudyId": by}


def run_statistics(loci: DataFrame, overlap_edges: DataFrame, classified: DataFrame, sets: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The statistics document of every run as a row each, for runs with loci; what is gathered is a number a study."""
    n = F.count(F.lit(1))

    def section(rows: DataFrame, name: str) -> DataFrame:
        by = class_counts(rows, keys).groupBy(*keys).agg(F.sum("rowCount").alias("n"), F.sort_array(F.collect_list(F.struct("studyId", "rowCount"))).alias("by"))
        return by.select(*keys, F.struct("n", "by").alias(name))

    metrics = component_metrics(classified, overlap_edges, keys)
    figures = [c for c in metrics.columns if c not in keys]
    parts = [
        overlap_edges.groupBy(*keys).agg(n.alias("overlapEdgeCount")),
        classified.where(F.col("overlapClass") == FULL).groupBy(*keys).agg(n.alias("eligibleFullOverlapLocusCount")),
        sets.groupBy(*keys).agg(n.alias("fineMappingSetCount")),
        metrics,
        section(set_members(sets, keys).join(classified, [*keys, "studyLocusId"]), FULL),
        section(classified.where(F.col("overlapClass") == PARTIAL), PARTIAL),
        section(classified.where(F.col("overlapClass") == NONE), NONE),
    ]
    out = loci.groupBy(*keys).agg(F.sort_array(F.collect_set("studyId")).alias("studyIds"), n.alias("inputLocusRowCount"))
    for part in parts:
        out = out.join(part, list(keys), "left")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)

    def fields(name: str) -> list[Column]:
        by = F.coalesce(f"{name}.by", F.array().cast("array<struct<studyId:string,rowCount:bigint>>"))
        return [F.coalesce(f"{name}.n", F.lit(0)).alias("rowCount"), by["studyId"].alias("studyIdsWithRows"), F.map_from_entries(by).alias("byStudyId")]

    sets_n = count("fineMappingSetCount")
    full = F.struct(sets_n, (F.coalesce("fineMappingSetCount", F.lit(0)) == 0).alias("isEmpty"), *fields(FULL), *figures).alias("fullOverlap")
    return out.select(*keys, F.size("studyIds").alias("nInputStudies"), "studyIds", "inputLocusRowCount", count("overlapEdgeCount"), count("eligibleFullOverlapLocusCount"), full, F.struct(*fields(PARTIAL)).alias("partialOverlap"), F.struct(*fields(NONE)).alias("nonOverlap"))


def statistics(loci: DataFrame, overlap_edges: DataFrame, classified: DataFrame, sets: DataFrame, input_files: dict[str, str] | None = None) -> dict[str, Any]:
    """The statistics document of one run; what is gathered is a row a study."""
    n_sets = sets.count()
    metrics = component_metrics(classified, overlap_edges).first()
    figures = {k: int(v) for k, v in metrics.asDict().items()} if metrics else {"componentCount": 0, "maxComponentLocusCount": 0, "maxComponentCandidateProductSize": 0}
    studies = [r[0] for r in loci.select("studyId").distinct().orderBy("studyId").collect()]
    full = _section(set_members(sets).join(classified, "studyLocusId")) if n_sets else {"rowCount": 0, "studyIdsWithRows": [], "byStudyId": {}}
    return {
        "nInputStudies": len(studies),
        "studyIds": studies,
        "inputFiles": input_files or {},
        "inputLocusRowCount": loci.count(),
        "overlapEdgeCount": overlap_edges.count(),
        "eligibleFullOverlapLocusCount": classified.where(F.col("overlapClass") == FULL).count(),
        "fullOverlap": {"fineMappingSetCount": n_sets, "isEmpty": not n_sets, **full, **figures},
        "partialOverlap": _section(classified.where(F.col("overlapClass") == PARTIAL)),
        "nonOverlap": _section(classified.where(F.col("overlapClass") == NONE)),
    }
