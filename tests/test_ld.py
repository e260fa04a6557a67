"""LD requests, lookup, adaptation and comparison."""

import pytest
from pyspark.sql import functions as F

from locusweave.operators import ld, parity
from locusweave.schema import LD_NATIVE_PAIR, LD_NATIVE_STATUS, LD_RUN_STATS, PAIRWISE_LD

NAMES = ["1_100_A_G", "1_150_A_AT", "1_175_N_A", "1_180_G_C", "1_200_C_T"]


@pytest.fixture()
def loci(spark):
    return spark.createDataFrame([("study-locus-1", "study-1", "1", 100, 200, [(v,) for v in NAMES])], "studyLocusId string, studyId string, chromosome string, locusStart int, locusEnd int, locus array<struct<variantId string>>")


@pytest.fixture()
def native(spark):
    pairs = spark.createDataFrame([("study-locus-1", 10, 15, 0.10), ("study-locus-1", 10, 20, -0.25), ("study-locus-1", 10, 20, -0.25), ("study-locus-1", 15, 20, -0.20)], LD_NATIVE_PAIR)
    status = spark.createDataFrame([("study-locus-1", f"chr{v}", i, o, c) for v, i, o, c in zip(NAMES, (10, 15, None, None, 20), (1, 1, None, None, -1), (0, 0, 5, 2, 1), strict=True)], LD_NATIVE_STATUS)
    return ld.FixedSource(pairs, status)


@pytest.fixture()
def metadata(spark):
    return spark.createDataFrame([("study-1", "eas")], "studyId string, ancestry string")


def test_requests_and_mapping(loci):
    r = ld.requests(loci).first()
    assert (r.locus_id, r.locus, r.variant_ids) == ("study-locus-1", "chr1:100-200", [f"chr{v}" for v in NAMES])
    assert sorted(tuple(x)[1:] for x in ld.mapping(loci).collect()) == sorted((f"chr{v}", v) for v in NAMES)


def test_annotation(loci, native, metadata):
    pairs, stats = ld.annotate(loci, metadata, {"eas": native, "nfe": native})
    got = sorted((r.variantIdI, r.variantIdJ, r.r) for r in pairs.collect())
    a, b, c = NAMES[0], NAMES[1], NAMES[4]
    assert got == sorted([(a, a, 1.0), (b, b, 1.0), (c, c, 1.0), (a, b, 0.1), (a, c, -0.25), (b, c, -0.2)])
    assert stats.columns == LD_RUN_STATS.names
    assert sorted(tuple(r)[:6] for r in stats.collect()) == [("eas", 5, 3, 1, 1, 6), ("nfe", 0, 0, 0, 0, 0)]
    one = stats.where("ancestry = 'eas'").first()
    assert one.native_materialize_seconds > 0 and one.adapter_seconds > 0 and one.peak_child_rss_kib > 1000
    assert [r.ancestry for r in ld.without_pairs(stats).collect()] == ["nfe"]


def test_conflicts_are_errors(spark, loci, native, metadata):
    bad = ld.FixedSource(native.pairs.unionByName(spark.createDataFrame([("study-locus-1", 10, 20, 0.5)], LD_NATIVE_PAIR)), native.status)
    with pytest.raises(ld.LdError, match=f"^Conflicting LD values for eas: {NAMES[0]}, {NAMES[4]}"):
        ld.annotate(loci, metadata, {"eas": bad})
    assert [tuple(r) for r in ld.conflicts(ld.adapt(bad.pairs, bad.status, ld.mapping(loci), "eas")).collect()] == [("eas", NAMES[0], NAMES[4], 2)]


@pytest.mark.parametrize(("rows", "refs", "words"), [([("study-1", "eas"), ("study-1", "nfe")], ["eas"], "Conflicting ancestry"), ([("other", "eas")], ["eas"], "No study metadata"), ([("study-1", "eas")], ["eas", "eas"], "Duplicate"), ([("study-1", "eas")], ["nfe"], "No LD reference")])
def test_metadata_is_checked(spark, loci, rows, refs, words):
    with pytest.raises(ld.LdError, match=words):
        ld.validate_studies(loci, spark.createDataFrame(rows, "studyId string, ancestry string"), refs)


def test_lookup_by_either_order_of_alleles(spark, loci):
    index = spark.createDataFrame([(1, "chr1_100_A_G"), (2, "chr1_150_AT_A"), (4, "chr1_200_C_T")], "idx long, variantId string")
    entries = spark.createDataFrame([(1, 2, 0.5), (2, 4, 0.25), (1, 4, 0.0), (4, 1, 9.0)], "i long, j long, r double")
    pairs, status = ld.NativeSource(index, entries).materialise(ld.requests(loci))
    assert {r.requested_variant_id[3:]: (r.idx, r.allele_order, r.status_code) for r in status.collect()} == {NAMES[0]: (1, 1, 0), NAMES[1]: (2, -1, 1), NAMES[2]: (None, None, 5), NAMES[3]: (None, None, 2), NAMES[4]: (4, 1, 0)}
    assert sorted((r.idx_i, r.idx_j, r.r) for r in pairs.collect()) == [(1, 2, -0.5), (2, 4, -0.25)]


def table(spark, rows):
    return spark.createDataFrame(rows, PAIRWISE_LD)


def test_parity_without_regard_to_form(spark):
    one = table(spark, [("eas", "chr1_1_A_C", "1_2_A_C", 0.5), ("eas", "1_1_A_C", "1_1_A_C", 1.0), ("nfe", "1_9_A_C", "1_9_A_C", 1.0)])
    two = table(spark, [("eas", "1_2_A_C", "chr1_1_A_C", 0.5 + 1e-11), ("eas", "1_3_A_C", "1_2_A_C", 0.1)])
    doc = parity.report(one, two, {"afr"})
    assert {r["ancestry"]: (r["first_pairs"], r["second_pairs"], r["shared_pairs"]) for r in doc["ancestries"]} == {"afr": (0, 0, 0), "eas": (2, 2, 1), "nfe": (1, 0, 0)}
    assert doc["totals"]["shared_value_mismatches"] == 0 and 0 < doc["totals"]["max_abs_ld_difference"] < 1e-10
    assert doc["diagonal_differences"] == {"first_only": 2, "second_only": 0, "shared_value_mismatches": 0}


def test_parity_mismatch(spark):
    doc = parity.report(table(spark, [("eas", "a", "b", 0.4)]), table(spark, [("eas", "b", "a", -0.4)]), tolerance=1e-6)
    assert doc["totals"]["shared_value_mismatches"] == 1 and abs(doc["totals"]["max_abs_ld_difference"] - 0.8) < 1e-12
    with pytest.raises(ld.LdError):
        parity.report(table(spark, [("eas", "a", "b", 0.4), ("eas", "b", "a", 0.5)]), table(spark, [("eas", "a", "b", 0.4)]))


def test_flips_and_neighbours(spark):
    pairs = spark.createDataFrame([("l", 1, 2, 0.5), ("l", 2, 3, 0.2)], LD_NATIVE_PAIR)
    turned = pairs.withColumn("r", F.when(F.col("idx_i") == 1, -F.col("r")).otherwise(F.col("r")))
    assert tuple(ld.flip_differences(pairs, turned, 1).first()) == (2, 0, 0) and tuple(ld.flip_differences(pairs, pairs, 1).first()) == (2, 1, 0)
    index = spark.createDataFrame([(i, f"chr{1 + i % 2}_{100 * i}_A_C") for i in range(20)], "idx long, variantId string")
    assert [r.idx for r in ld.neighbourhood(index, 4, 500, 3).collect()] == [4, 2, 6]


def test_request_of_a_sample(spark):
    index = spark.createDataFrame([(3, "chr1_120_A_G"), (1, "chr1_100_C_T"), (2, "chr1_100_G_A"), (9, "chr1_900_A_T"), (8, "chr2_110_A_T")], "idx long, variantId string")
    near = ld.neighbourhood(index, 1, flank=50)
    assert ld.request_of(near, "x").first().asDict() == {"locus_id": "x", "locus": "chr1:100-120", "variant_ids": ["chr1_100_C_T", "chr1_100_G_A", "chr1_120_A_G"]}
    assert ld.request_of(near, "x", 1).first().variant_ids == ["chr1_100_T_C", "chr1_100_G_A", "chr1_120_A_G"]
    assert ld.request_of(near.limit(0), "x").count() == 0


def test_pairs_shuffle_once(loci, native):
    """Guard, combination and count are one aggregation behind broadcasts of measured names."""
    names = ld.resolved_names(native.status, ld.mapping(loci))
    out = ld.combined(native.pairs, names, "eas", small=True)
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, ld.combine([ld.adapt(native.pairs, native.status, ld.mapping(loci), "eas")]).collect()))
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("BroadcastHashJoin [locus_id") == 2 and plan.count("HashAggregate(keys=[variantIdI") == 2
