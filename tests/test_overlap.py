"""Overlap classes and candidate sets."""

import random
from hashlib import md5
from itertools import product

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from locusweave.operators import overlap
from locusweave.schema import COLLECTED_LOCUS, STUDY_LOCUS, conform
from locusweave.sources.tables import written_some


@pytest.fixture()
def loci(spark):
    """Loci of {study: [(start, end[, quality control])]}."""

    def make(**studies):
        rows = [(md5(f"{s}{k}".encode()).hexdigest(), s, "1", a, b, [qc[0]] if qc else None, [(f"1_{a}_A_C",)]) for s, spans in studies.items() for k, (a, b, *qc) in enumerate(spans)]
        df = spark.createDataFrame(rows, "studyLocusId string, studyId string, chromosome string, locusStart int, locusEnd int, qualityControls array<string>, v array<struct<variantId string>>")
        locus = F.transform("v", lambda x: F.struct(*[(x["variantId"] if f.name == "variantId" else F.lit(None)).cast(f.dataType).alias(f.name) for f in STUDY_LOCUS["locus"].dataType.elementType.fields]))
        return conform(df.withColumn("locus", locus), STUDY_LOCUS)

    return make


def worked(rows, n=None):
    edges = overlap.edges(rows)
    classes = overlap.classify(rows, edges, n)
    return edges, classes, overlap.full_sets(classes)


def test_partial_and_none(loci):
    rows = loci(A=[(100, 150, "preexisting"), (1000, 1050)], B=[(140, 160)], C=[(2000, 2050)])
    edges, classes, sets = worked(rows, 3)
    assert edges.count() == 2 and sets.count() == 0
    partial = {r.studyId: r for r in overlap.collect_class(classes, overlap.PARTIAL).collect()}
    assert set(partial) == {"A", "B"} and partial["A"].qualityControls == ["preexisting", "partial-overlapping studyLocus"] and partial["A"].fineMappingLocusSetId is None
    assert sorted(r.studyId for r in overlap.collect_class(classes, overlap.NONE).collect()) == ["A", "C"]


def test_full_set(loci):
    rows = loci(A=[(100, 200)], B=[(150, 250)], C=[(175, 225)])
    edges, classes, sets = worked(rows, 3)
    ids = sorted(r.studyLocusId for r in rows.collect())
    out = overlap.collect_full(classes, sets)
    assert edges.count() == 6 and {r.fineMappingLocusSetId for r in out.collect()} == {md5("|".join(ids).encode()).hexdigest()}
    assert out.columns == COLLECTED_LOCUS.names and all(r.qualityControls == ["overlapping set"] for r in out.collect())


def test_single_input(loci):
    _, classes, sets = worked(loci(A=[(100, 200), (1000, 1100)]), 1)
    assert sorted(len(r.memberIds) for r in sets.collect()) == [1, 1] and classes.where("overlapClass = 'full'").count() == 2


def test_all_partial(loci):
    _, classes, sets = worked(loci(A=[(100, 150), (500, 550)], B=[(140, 160), (900, 950)], C=[(540, 560), (940, 960)]), 3)
    assert sets.count() == 0 and {r.studyId: r.rowCount for r in overlap.class_counts(classes.where("overlapClass = 'partial'")).collect()} == {"A": 2, "B": 2, "C": 2}


def test_a_locus_in_several_sets_in_any_order(loci):
    spans = {"A": [(100, 200), (300, 400)], "B": [(150, 180), (350, 380)], "C": [(175, 375)]}
    results = []
    for names in ("ABC", "CAB"):
        _, classes, sets = worked(loci(**{n: spans[n] for n in names}), 3)
        results.append(sorted((r.fineMappingLocusSetId, r.studyLocusId) for r in overlap.set_members(sets).collect()))
    assert results[0] == results[1] and len(results[0]) == 6 and len({s for s, _ in results[0]}) == 2


def test_components_and_statistics(loci):
    rows = loci(A=[(100, 200), (1000, 1100)], B=[(125, 225), (1025, 1125)], C=[(150, 250), (1050, 1150)])
    edges, classes, sets = worked(rows, 3)
    doc = overlap.statistics(rows, edges, classes, sets, {"A": "a.parquet"})
    assert doc["fullOverlap"] == {"fineMappingSetCount": 2, "isEmpty": False, "rowCount": 6, "studyIdsWithRows": ["A", "B", "C"], "byStudyId": {"A": 2, "B": 2, "C": 2}, "componentCount": 2, "maxComponentLocusCount": 3, "maxComponentCandidateProductSize": 1}
    assert doc["nInputStudies"] == 3 and doc["overlapEdgeCount"] == 12 and doc["eligibleFullOverlapLocusCount"] == 6


def test_runs_are_worked_together(loci):
    one = loci(A=[(100, 200)], B=[(150, 250)]).withColumn("runId", F.lit("r1"))
    two = loci(A=[(100, 200)], B=[(150, 250)], C=[(180, 300)]).withColumn("runId", F.lit("r2"))
    rows = one.unionByName(two)
    edges = overlap.edges(rows, ("runId",))
    sets = overlap.full_sets(overlap.classify(rows, edges, keys=("runId",)), ("runId",))
    assert sorted((r.runId, len(r.memberIds)) for r in sets.collect()) == [("r1", 2), ("r2", 3)]
    metrics = overlap.component_metrics(overlap.classify(rows, edges, keys=("runId",)), edges, ("runId",))
    assert sorted((r.runId, r.componentCount, r.maxComponentLocusCount) for r in metrics.collect()) == [("r1", 1, 2), ("r2", 1, 3)]


def test_inputs_must_be_distinct_studies(loci):
    with pytest.raises(overlap.InputMismatch, match="distinct studyId"):
        overlap.check_inputs(loci(A=[(1, 2)]), 2)


def test_wide_and_negative_spans(loci):
    edges = overlap.edges(loci(A=[(-700_000, 3_000_000)], B=[(2_999_999, 9_000_000)], C=[(-10, -5)]))
    assert edges.count() == 4


def test_components_of_a_long_chain(spark):
    """Labels of a chain settle, and the size estimate of the result doesn't grow with the rounds."""
    n = 1500
    links = spark.range(n - 1).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = overlap.components(spark.range(n), links)
    assert found.where("component <> 0").isEmpty() and found.count() == n
    assert int(str(found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 2**64


def test_exact_product(spark):
    """A component of 20 studies with 9 loci each has 9^20 candidates, more than a double holds exactly."""
    rows = [(f"L{s}-{k}", f"S{s:02d}") for s in range(20) for k in range(9)]
    classified = spark.createDataFrame([(i, s, overlap.FULL) for i, s in rows], "studyLocusId string, studyId string, overlapClass string")
    edges = spark.createDataFrame([(rows[0][0], i) for i, _ in rows[1:]], "studyLocusId1 string, studyLocusId2 string")
    assert int(overlap.component_metrics(classified, edges).first().maxComponentCandidateProductSize) == 9**20


def test_sets_of_twelve_studies_match_brute_force(loci, monkeypatch):
    """Also of equal starts, equal spans and several loci a study; sets are spelled out in runs of a few."""
    monkeypatch.setattr(overlap, "_RUN_OF_SETS", 3)
    rng = random.Random(42)
    spans = {f"S{k:02d}": [(100, 130), (100, 130)] if k == 3 else [(100 + rng.randrange(4), 120 + rng.randrange(20))] + [(a := rng.randrange(100, 135), a + rng.randrange(40))] * (k % 3 == 0) + [(5000 * (k + 1), 5000 * (k + 1) + 10)] for k in range(12)}
    rows = loci(**spans)
    classes = overlap.classify(rows, overlap.edges(rows), 12)
    full = {}
    for r in classes.where("overlapClass = 'full'").collect():
        full.setdefault(r.studyId, []).append(r)
    want = sorted(tuple(x.studyLocusId for x in pick) for pick in product(*(full[s] for s in sorted(full))) if max(x.locusStart for x in pick) <= min(x.locusEnd for x in pick))
    got = sorted(tuple(r.memberIds) for r in overlap.full_sets(classes).collect())
    assert got == want and len(want) >= 8


def test_the_plan_of_sets_does_not_grow_with_studies(loci):
    def joins(n):
        rows = loci(**{f"S{k:02d}": [(100, 200 + k)] for k in range(n)})
        classes = rows.selectExpr("*", "'full' AS overlapClass")
        return overlap.full_sets(classes)._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(3) == joins(12) <= 2


def test_components_of_any_partitions(spark, monkeypatch):
    """The same labels however links are dealt, and if tasks hold few nodes at once."""
    rng = random.Random(44)
    pairs = [(f"n{rng.randrange(300):03d}", f"n{rng.randrange(300):03d}") for _ in range(220)]
    label = {n: n for n in {x for p in pairs for x in p} | {"alone"}}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    nodes = spark.createDataFrame([(n,) for n in label], "id string")
    links = spark.createDataFrame(pairs, "a string, b string")
    for parts in (1, 5):
        assert {r.id: r.component for r in overlap.components(nodes, links.repartition(parts)).collect()} == label
    monkeypatch.setattr(overlap, "HELD_NODES", 10)
    batches = [pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs[k : k + 20]]) for i in (0, 1)], names=["a", "b"]) for k in range(0, 220, 20)]
    drawn = [b for b in overlap._stars(iter(batches))]
    again = spark.createDataFrame([(x, y) for b in drawn for x, y in zip(*b.to_pydict().values(), strict=True)], "a string, b string")
    assert len(drawn) > 3 and {r.id: r.component for r in overlap.components(nodes, again).collect()} == label
    assert overlap.components(nodes, links.limit(0)).where("id <> component").isEmpty()


def test_rows_are_seen_by_the_job_that_writes_them(spark):
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("written_some"))
    spark.sparkContext.setJobGroup("written_some", "")
    try:
        table, _, some = written_some(spark.range(5))
        assert some and jobs() == 1
        assert not written_some(spark.range(5), "step", F.col("id") > 4)[2] and written_some(spark.range(5), "step", F.col("id") > 3)[2]
        assert not written_some(spark.range(5).where("id > 4"))[2] and not written_some(table.limit(0))[2]
        assert not written_some(table.join(table.where("id > 4"), "id").distinct())[2]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
