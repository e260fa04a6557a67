"""Clumping: boundary cases on a few rows each."""

import random

import pytest
from pyspark.sql import functions as F

from locusweave.functions import semantics as S
from locusweave.operators import clumping, reports, variants
from locusweave.schema import STUDY_LOCUS, SUMSTATS
from locusweave.sources import layout, tables

INPUT = "studyId string, variantId string, chromosome string, position int, beta float, sampleSize int, pValueMantissa float, pValueExponent int, effectAlleleFrequencyFromSource float, standardError float"


@pytest.fixture()
def stats(spark):
    """Summary statistics of (study, chromosome, position, mantissa, exponent[, frequency]) rows."""

    def make(*rows):
        full = [(s, f"{c}_{p}_A_C", c, p, 0.1, 100, m, e, f[0] if f else 0.5, 0.01) for s, c, p, m, e, *f in rows]
        return spark.createDataFrame(full, INPUT)

    return make


def one(stats, *rows):
    return stats(*[("S", "1", *r) for r in rows])


def config(cutoff, flank, **more):
    return clumping.ClumpConfig(**{"lbc_distance_cutoff": cutoff, "lbc_flanking_distance": flank, "large_loci_size": 10**6, "collect_locus": False} | more)


def found(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or ("position", "locusStart", "locusEnd"))).collect())


def test_split_pvalue():
    assert [S.split_pvalue(p) for p in (0.00001234, 1, 0.123, 0.99, 0)] == [(1.234, -5), (1.0, 0), (1.23, -1), (9.9, -1), (0, 0)]
    assert [S.split_pvalue(p) for p in (9.9996e-6, 0.99996, 1e-5, 1e-8)] == [(10.0, -6), (10.0, -1), (1.0, -5), (1.0, -8)]
    for p in (-0.1, 1.1):
        with pytest.raises(ValueError, match="not a p-value"):
            S.split_pvalue(p)


def test_threshold_mantissa_is_a_float(spark):
    df = spark.createDataFrame([(1.1, -5), (1.2, -5), (9.0, -6), (None, -5)], "pValueMantissa float, pValueExponent int")
    assert df.where(S.pvalue_at_most(1.1e-5)).count() == 2


def test_ties_give_several_leads(stats):
    out = clumping.clump(one(stats, (100, 9.0, -9), (110, 9.0, -9), (120, 1.001, -8), (130, 1.0, -7)), config(100, 10))
    assert found(out) == [(100, 90, 140), (110, 90, 140)]
    assert out.where("qualityControls IS NULL AND locus IS NULL").count() == 2


def test_threshold_is_strict(stats):
    assert clumping.clump(one(stats, (100, 1.0, -8)), config(100, 10)).count() == 0


def test_split_and_floor(stats):
    assert found(clumping.clump(one(stats, (5, 1.0, -9), (25, 2.0, -8), (60, 1.0, -9)), config(30, 10))) == [(5, 0, 35), (60, 50, 70)]


def test_breaks_among_variants_of_one_position(stats, spark):
    rows = one(stats, *[(p, 1.0, -9) for p in (10, 100, 100, 100)]).withColumn("variantId", F.concat("variantId", F.monotonically_increasing_id()))
    for order in (F.asc("variantId"), F.desc("variantId")):
        broken = clumping.with_breaks(rows.coalesce(1).sortWithinPartitions(order), config(50, 10))
        first, *rest = sorted(tuple(r) for r in broken.where("position = 100").select("variantId", "previousPosition", "locusBreakPosition").collect())
        assert first[1:] == (10, 100) and [r[1:] for r in rest] == [(100, None)] * 2


def test_studies_and_chromosomes_are_apart(stats):
    rows = stats(("A", "1", 100, 1.0, -9), ("A", "2", 100, 1.0, -9), ("B", "1", 105, 1.0, -9))
    assert found(clumping.clump(rows, config(100, 10)), "studyId", "locusStart", "locusEnd") == [("A", 90, 110), ("A", 90, 110), ("B", 95, 115)]


def test_zero_mantissa_leads(stats):
    assert found(clumping.clump(one(stats, (100, 0.0, -300), (110, 1.0, -320)), config(100, 0)), "position") == [(100,)]


def test_study_locus_id(spark):
    df = spark.createDataFrame([("GCST000001", "1_1000_A_C"), (None, "x")], "studyId string, variantId string").select(S.study_locus_id().alias("i"))
    assert [r.i for r in df.collect()][0] == "97c69178520980bdc5494c7521d007b9"


def test_no_large_locus(stats):
    assert found(clumping.clump(one(stats, (100, 1.0, -9), (150, 2.0, -9)), config(100, 0, large_loci_size=1000))) == [(100, 100, 150)]


REPLACE = {"lbc_baseline_pvalue": 1e-4, "large_loci_size": 100, "wbc_clump_distance": 50, "wbc_pvalue_threshold": 1e-5}


def test_large_loci_are_replaced(stats):
    rows = one(stats, (100, 1.0, -10), (149, 2.0, -10), (150, 3.0, -10), (260, 1.001, -5), (1000, 1.0, -9))
    out = clumping.clump(rows, config(500, 0, **REPLACE))
    assert found(out) == [(100, 50, 150), (150, 100, 200), (1000, 1000, 1000)]
    assert found(out.where("qualityControls IS NULL"), "position") == [(1000,)]
    assert found(out.where(F.size("qualityControls") == 0), "position") == [(100,), (150,)]


def test_window_p_filter_and_floats(stats):
    rows = one(stats, (100, 1.0, -10), (200, 1.001, -5), (300, 2.0, -10))
    assert found(clumping.clump(rows, config(500, 0, **REPLACE)), "position") == [(100,), (300,)]
    kept = clumping.clump(one(stats, (100, 1.57, -26, 0.91635), (260, 2.0, -10)), config(500, 0, **REPLACE)).where("position = 100").first()
    assert round(kept.pValueMantissa, 10) == 1.5700000525 and round(kept.effectAlleleFrequencyFromSource, 10) == 0.9163500071


def test_region_goes_after_replacement(stats):
    rows = stats(("S", "6", 30_000_000, 1.0, -10), ("S", "1", 100, 1.0, -9))
    assert found(clumping.clump(rows, config(100, 100, large_loci_size=100, wbc_clump_distance=50))) == [(100, 50, 150)]
    assert clumping.clump(rows, config(100, 100, remove_mhc=False)).count() == 2


def test_duplicates_are_no_members(stats, spark):
    rows = one(stats, (100, 1.0, -9), (105, 2.0, -3), (500, 1.0, -3))
    rows = rows.unionByName(rows.where("position = 105").withColumn("pValueMantissa", F.lit(None).cast("float")))
    out = clumping.clump(rows, config(100, 10, collect_locus=True)).collect()
    assert len(out) == 1 and [v.variantId for v in out[0].locus] == ["1_100_A_C"] and out[0].locus[0].logBF is None


def test_members_are_ordered_and_columns_in_order(stats):
    out = clumping.clump(one(stats, (120, 1.0, -3), (100, 1.0, -9), (110, 5.0, -1)), config(100, 50, collect_locus=True))
    assert out.columns == STUDY_LOCUS.names and [v.variantId for v in out.first().locus] == ["1_100_A_C", "1_110_A_C", "1_120_A_C"]
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in STUDY_LOCUS.fields]


def test_members_without_arrays_agree_with_arrays(stats, spark):
    rows = stats(*[("S", "1", p, 1.0, -9 if p % 40 == 0 else -3) for p in range(0, 400, 5)], *[("T", "1", 200, 1.0, -9)] * 2, ("T", "1", 210, 1.0, -9))
    copies, cfg = clumping.copied_keys(rows), config(30, 60)
    assert found(copies, "studyId", "variantId") == [("T", "1_200_A_C")]
    loci = clumping.clump(rows, cfg, copies=copies)
    arrays = tables.materialise(clumping.with_members(loci, rows, copies))
    sized = clumping.with_sizes(loci, rows, copies)
    assert found(sized, "studyLocusId", "nVariants") == found(arrays.select("studyLocusId", F.size("locus").alias("n")), "studyLocusId", "n")
    members = clumping.member_variants(loci, rows, copies)
    assert members.count() == members.distinct().count()
    assert found(variants.named(members), "variantId", "chromosome") == found(variants.variant_filter(arrays), "variantId", "chromosome")
    assert found(reports.clumping_report(sized), "studyId", "nLoci", "meanLocusSize") == found(reports.clumping_report(arrays), "studyId", "nLoci", "meanLocusSize")


def test_members_shuffle_each_value_once(stats):
    """What is collected for a locus is the six values of the order; flags of nulls and empty fields are made after the exchange."""
    rows = one(stats, (120, 1.0, -3), (100, 1.0, -9), (110, 5.0, -1))
    loci = clumping.clump(rows, config(100, 50))
    made = clumping.with_members(loci, rows, clumping.copied_keys(rows))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    collected = plan[plan.index("collect_list(") :].split(", 0, 0)")[0]
    assert "isnull" not in collected and "_item" not in plan
    assert [v.variantId for v in made.first().locus] == ["1_100_A_C", "1_110_A_C", "1_120_A_C"]


def test_layout_deals_whole_rows_once(stats, spark, monkeypatch):
    """Copies are found by hashes of keys, so no window exchanges whole rows before they are dealt into buckets."""
    seen, conform = [], layout.conform
    monkeypatch.setattr(layout, "conform", lambda df, schema: seen.append(df) or conform(df, schema))
    table = layout.lay_out(stats(*[("S", "1", p % 7, 1.0, -9) for p in range(12)]), "dealt_once", 2)
    assert "Window" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r.position for r in table.collect()) == [5, 6]
    spark.sql("DROP TABLE dealt_once")


def test_chromosomes_sort_by_number(stats):
    rows = stats(*[("S", c, 100, 1.0, -9) for c in ("10", "2", "X")])
    assert [r.chromosome for r in clumping.clump(rows, config(100, 0)).orderBy(*clumping.output_order()).collect()] == ["2", "10", "X"]


def test_unique_ways_agree(stats):
    rows = one(stats, *[(p % 7, 1.0, -9) for p in range(12)])
    assert sorted(map(tuple, clumping.unique_sumstats(rows).collect())) == sorted(map(tuple, clumping.unique_among(rows, rows).collect()))


def test_config_is_checked_and_no_rows_pass(spark):
    for bad in ({"lbc_pvalue_threshold": 0}, {"lbc_distance_cutoff": -1}, {"wbc_clump_distance": 0}):
        with pytest.raises(ValueError):
            clumping.ClumpConfig(**bad)
    assert clumping.clump(spark.createDataFrame([], SUMSTATS)).count() == 0


def greedy(rows, distance):
    """Leads of each cluster by trying one variant after another."""
    out = []
    for key in sorted({r[:2] for r in rows}):
        ordered, clusters = sorted((r for r in rows if r[:2] == key), key=lambda r: r[2]), []
        for r in ordered:
            if not clusters or r[2] - clusters[-1][-1][2] > distance:
                clusters.append([])
            clusters[-1].append(r)
        for cluster in clusters:
            leads = []
            for r in sorted(cluster, key=lambda r: (r[4], r[3], r[2])):
                if all(abs(r[2] - x[2]) >= distance for x in leads):
                    leads.append(r)
            out += leads
    return sorted(r[:3] for r in out)


@pytest.mark.parametrize(("swept", "rounds"), [(10**6, 8), (0, 8), (5, 8), (0, 1)])
def test_window_leads_in_any_way(stats, monkeypatch, swept, rounds):
    """By sweeping alone, and by peeling large clusters first, to the end or in part."""
    rng = random.Random(41)
    places = lambda n: rng.sample(range(3000), n)
    rows = [("A", "1", p, rng.choice((1.0, 2.0, 3.0)), -rng.randrange(6, 12)) for p in places(150)]
    rows += [("B", "1", p, 1.0, -6) for p in places(40)] + [("B", "2", 7, 1.0, -9)]
    rows += [("C", "1", 30 * k, 1.0, -6 - k) for k in range(40)]  # a chain in which each variant waits for the one after it
    monkeypatch.setattr(clumping, "ROUNDS", rounds)
    config = clumping.ClumpConfig(wbc_clump_distance=50, wbc_pvalue_threshold=1e-5)
    peel = clumping._peeled
    monkeypatch.setattr(clumping, "_peeled", lambda r, d: peel(r, d, rounds))
    out = clumping.window_leads(clumping.window_clusters(stats(*rows), config), config, swept)
    assert found(out, "studyId", "chromosome", "position") == greedy(rows, 50)
    assert "collect_list" not in out._jdf.queryExecution().toString()


def test_laid_out_statistics_are_not_exchanged(stats, spark):
    """The same loci and members, and neither keys nor members shuffle the layout."""
    rng = random.Random(45)
    rows = stats(*[(rng.choice("AB"), rng.choice("12"), rng.randrange(4_000_000), 1.0, -rng.randrange(12)) for _ in range(600)])
    rows = rows.unionByName(rows.limit(5))
    given = config(100_000, 50_000, collect_locus=True, large_loci_size=300_000, wbc_clump_distance=100_000)
    table = layout.lay_out(rows, "laid_out_sumstats", 3)
    key = lambda r: (r.studyLocusId, r.locusStart)
    got = sorted(clumping.clump(table, given, laid_out=True).collect(), key=key)
    assert got == sorted(clumping.clump(rows, given).collect(), key=key) and len(got) > 20
    loci = clumping.clump(table, config(100_000, 50_000), laid_out=True)
    with tables.setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"), tables.setting(spark, "spark.sql.adaptive.enabled", "false"):
        plan = clumping.members(loci, table, laid_out=True)._jdf.queryExecution().executedPlan().toString()
    side = plan[plan.index("SortMergeJoin") :]
    scan = side[: side.index("laid_out_sumstats")]
    assert "Exchange" not in scan and "Bucketed: true" in plan
    spark.sql("DROP TABLE laid_out_sumstats")
