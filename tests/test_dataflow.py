"""Sources, gates, the whole pipeline and the command line."""

import gzip
import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from locusweave import cli
from locusweave.operators import clumping, dataflow, ld, methods, reports, variants
from locusweave.plans import pipeline
from locusweave.schema import MANIFEST, STUDY_METADATA, SUMSTATS, conform
from locusweave.sources import footers, publish, records, tables
from locusweave.streaming import arrivals

HEAD = "\t".join(MANIFEST.names) + "\n"


def manifest_file(tmp_path, rows):
    path = tmp_path / "manifest.tsv"
    path.write_text(HEAD + "".join("\t".join(map(str, r)) + "\n" for r in rows))
    return str(path)


def test_manifest(spark, tmp_path):
    path = manifest_file(tmp_path, [("R1", "A", "main", "x/a", "eas", "['EFO_1','EFO_2']", 10), ("R1", "B", "main", "/abs/b", "amr", "EFO_1", 20)])
    got = records.read_manifest(spark, path, "/base").orderBy("studyId").collect()
    assert [r.summarystatsLocation for r in got] == ["/base/x/a", "/abs/b"] and got[0].traits == ["['EFO_1'", "'EFO_2']"] and got[1].effectiveSampleSize == 20


@pytest.mark.parametrize(("entries", "backend"), [([], "native"), ({}, "native"), ([{"ancestry": "eas"}], "native"), ([{"ancestry": "eas", "ht_path": "h", "bm_path": "b"}] * 2, "native"), ([{"ancestry": "eas", "ht_path": "h", "bm_path": "b"}], "aligned"), ([{"ancestry": "e", "ht_path": "h", "bm_path": "b"}], "none")])
def test_bad_registries(entries, backend):
    with pytest.raises(dataflow.RegistryError):
        dataflow.validate_registry(entries, backend)


def test_good_registry_and_methods():
    assert dataflow.validate_registry([{"ancestry": "eas", "ht_path": "h", "bm_path": "b"}])
    assert methods.validate_methods(["sushie", "multisusie"])
    for bad in ([], ["sushie", "sushie"], ["other"], None):
        with pytest.raises(dataflow.RegistryError):
            methods.validate_methods(bad)


def test_one_bad_member_removes_its_run(spark):
    rows = spark.createDataFrame([("R1", "A", "p", "eas"), ("R1", "B", "p", "amr"), ("R2", "C", "p", "eas"), ("R3", "D", "p", None)], "runId string, studyId string, summarystatsLocation string, majorAncestry string")
    status = dataflow.manifest_status(rows, ["eas"])
    assert sorted(r.runId for r in status.collect()) == ["R1", "R3"] and status.first().reason == "UNREGISTERED_ANCESTRY"
    assert [r.studyId for r in dataflow.without(rows, status).collect()] == ["C"]
    assert [r.members[0].studyId for r in dataflow.grouped(rows).orderBy("runId").collect()] == ["A", "C", "D"]
    assert dataflow.empty_status(spark, rows, "R", "p", "LOCUS_BREAKER").count() == 0 and dataflow.empty_status(spark, rows.limit(0), "R", "p", "LOCUS_BREAKER").first().reason == "EMPTY_DATASET"


def test_jsonl_errors_have_line_numbers(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text('{"studyId": "a", "ancestry": "eas", "sampleSize": 1}\n\n{"studyId": "b"}\n')
    with pytest.raises(records.RecordError, match="line 3: "):  # blank lines count
        records.read_jsonl(spark, str(path), STUDY_METADATA, ("studyId", "ancestry"))
    dense = tmp_path / "dense.jsonl"
    dense.write_text(path.read_text().replace("\n\n", "\n"))
    with pytest.raises(records.RecordError, match="line 2: "):
        records.read_jsonl(spark, str(dense), STUDY_METADATA, ("studyId", "ancestry"))
    assert records.read_jsonl(spark, str(path), STUDY_METADATA, ("studyId",)).count() == 2


def test_scans_and_sinks(spark, tmp_path):
    root = tmp_path / "d"
    spark.range(3).withColumn("k", F.lit("001")).write.partitionBy("k").parquet(str(root))
    got = tables.read_tree(spark, str(root))
    assert got.schema["k"].dataType.simpleString() == "string" and got.first().k == "001"
    other = tmp_path / "e"
    spark.range(2).withColumn("extra", F.lit(1)).coalesce(1).write.parquet(str(other))
    assert tables.read_tree(spark, str(root), str(other)).count() == 5 and footers.row_count(spark, str(other)) == 2
    tables.write_per_key(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "fineMappingLocusSetId string, x int"), str(tmp_path / "sets"), "fineMappingLocusSetId")
    assert sorted(p.name for p in (tmp_path / "sets").glob("_fine*")) == ["_fineMappingLocusSetId=a", "_fineMappingLocusSetId=b"]
    tables.merge(spark, str(other), str(tmp_path / "one.parquet"))
    assert len(list((tmp_path / "one.parquet").glob("*.parquet"))) == 1
    assert tables.with_file(spark.read.parquet(str(other))).first().sourceFile.endswith(".parquet")
    with pytest.raises(IsADirectoryError):
        records.write_report(spark, {}, str(tmp_path))


def test_fractions_round_half_to_even(spark):
    df = spark.createDataFrame([(2.5,), (3.5,), (2.7,)], "position double")
    assert [r.position for r in conform(df, SUMSTATS).collect()] == [2, 4, 3]


def test_small_operators(spark):
    sites = spark.createDataFrame([("chr1", 1000, "A", "G")] * 2 + [("chr2", 5, "A", "T")], "chrom string, pos int, ref string, alt string")
    assert [r.pos for r in variants.intersection(sites, 2).collect()] == [1000]
    z = spark.createDataFrame([("1", "1_10_A_G", 10, 0.5, 0.1), ("1", "x", 11, 1.0, 0.0)], "chromosome string, variantId string, position int, beta double, standardError double")
    got = variants.with_z_scores(z).orderBy("position").collect()
    assert (got[0].zScore, got[0].referenceAllele, got[0].alternateAllele) == (5.0, "A", "G") and got[1].zScore == float("inf") and got[1].referenceAllele == ""


def test_differences_ignore_order_and_noise(spark):
    a = spark.createDataFrame([(1, [2.0, 1.0]), (2, None)], "k int, a array<double>")
    b = spark.createDataFrame([(2, None), (1, [1.0, 2.0 + 1e-14])], "k int, a array<double>")
    assert reports.differences(a, b).count() == 0 and reports.differences(a, b.limit(1)).first().side == "first"


def _stats(spark, studies):
    rows = [(s, f"1_{p}_A_C", "1", p, 0.1, 10, 1.0, -9 if sig else -1, 0.5, 0.1) for s, sig in studies for p in (1000, 1010, 1020)]
    return spark.createDataFrame([tuple(r) for r in rows], SUMSTATS)


def test_pipeline_of_all_runs(spark, tmp_path):
    rows = [("R1", "A", "main", "p", "eas"), ("R1", "B", "main", "p", "eas"), ("R2", "C", "main", "p", "amr"), ("R3", "D", "main", "p", "eas"), ("R3", "E", "main", "p", "eas"), ("R4", "F", "other", "p", "eas")]
    manifest = conform(spark.createDataFrame(rows, "runId string, studyId string, route string, summarystatsLocation string, majorAncestry string"), MANIFEST)
    stats = _stats(spark, [("A", True), ("B", True), ("C", True), ("D", True), ("E", False), ("F", True)])
    index = spark.createDataFrame([(1, "chr1_1000_A_C"), (2, "chr1_1010_A_C")], "idx long, variantId string")
    entries = spark.createDataFrame([(1, 2, 0.5)], "i long, j long, r double")
    one = methods.Method("multisusie", lambda p: p.assign(n=len(p))[["runId", "fineMappingLocusSetId", "n"]].head(1), "runId string, fineMappingLocusSetId string, n long")
    out = pipeline.run(manifest, stats, {"eas": ld.NativeSource(index, entries)}, pipeline.PipelineConfig(route="main", fits=(one,))).tables
    status = sorted((r.runId, r.validationStage) for r in out["status"].collect())
    assert status == [("R2", "MANIFEST"), ("R3", "LOCUS_BREAKER")]
    assert {r.studyId for r in out["locus_sets"].collect()} == {"A", "B"} and {r.runId for r in out["study_locus"].collect()} == {"R1"}
    assert sorted((r.variantIdI, r.variantIdJ) for r in out["pairwise_ld"].collect())[0] == ("1_1000_A_C", "1_1000_A_C") and out["variants_multisusie"].count() % 3 == 0
    doc = {r.runId: r for r in out["collect_stats"].collect()}
    assert set(doc) == {"R1"} and doc["R1"].studyIds == ["A", "B"] and doc["R1"].fullOverlap.byStudyId == {"A": doc["R1"].fullOverlap.rowCount // 2, "B": doc["R1"].fullOverlap.rowCount // 2}
    assert doc["R1"].fullOverlap.componentCount == 1 and not doc["R1"].fullOverlap.isEmpty and doc["R1"].partialOverlap.rowCount == 0 and doc["R1"].nonOverlap.byStudyId == {}
    counted = out["ld_stats"].first()
    assert counted.ancestry == "eas" and counted.n_requested_variants > counted.n_resolved_variants > 0 and counted.n_ld_pairs == 3
    assert {(r.runId, r.n, r.method) for r in out["fine_mapping"].collect()} == {("R1", 3, "multisusie")}
    with pytest.raises(ld.LdError, match="Conflicting LD values"):
        pipeline.run(manifest, stats, {"eas": ld.NativeSource(index, entries.unionByName(entries.withColumn("r", F.lit(0.25))))}, pipeline.PipelineConfig(route="main"))
    with pytest.raises(ld.LdError, match="Conflicting ancestry"):
        pipeline.run(manifest.unionByName(manifest.where("studyId = 'A'").withColumn("majorAncestry", F.lit("nfe"))), stats, {a: ld.NativeSource(index, entries) for a in ("eas", "nfe")}, pipeline.PipelineConfig(route="main"))
    none = pipeline.run(manifest, stats, {"eas": ld.NativeSource(index.limit(0), entries)}, pipeline.PipelineConfig(route="main"))
    assert none.tables["locus_sets"].count() == 0 and none.tables["ld_annotation_status"].first().reason == "EMPTY_LD_PAIRS"
    pipeline.PipelineResult({k: out[k] for k in ("status", "locus_sets", "full_overlap")}).publish(str(tmp_path / "pub"))
    published = publish.outputs(spark, str(tmp_path / "pub"))
    assert set(published) == {"status", "locus_sets", "full_overlap"} and spark.read.parquet(published["full_overlap"]).count() > 0
    assert {(r.stage, r.method) for r in out["versions"].where("name = 'engine'").collect()} >= {("LOCUS_BREAKER", "locus_breaker"), ("FINE_MAPPING", "multisusie")}


def test_references_of_a_registry(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    spark.createDataFrame([(1, "chr1_1000_A_C"), (2, "chr1_1010_C_A")], "idx long, variantId string").write.parquet(p("ht"))
    spark.createDataFrame([(1, "1_1000_A_C", 1), (2, "1_1010_A_C", -1)], "idx long, variantId string, alleleOrder int").write.parquet(p("vi"))
    spark.createDataFrame([(1, 2, 0.5)], "i long, j long, r double").write.parquet(p("bm"))
    asked = spark.createDataFrame([("l", ["chr1_1000_A_C", "chr1_1010_A_C", "chr1_1020_A_C", "chr1_1_N_C"])], "locus_id string, variant_ids array<string>")
    entry = {"ancestry": "eas", "ht_path": p("ht"), "vi_path": p("vi"), "bm_path": p("bm")}
    for backend in ("native", "aligned"):
        pairs, status = pipeline.ld_sources(spark, [entry], backend)["eas"].materialise(asked)
        assert sorted((r.requested_variant_id, r.idx, r.status_code) for r in status.collect() if r.idx) == [("chr1_1000_A_C", 1, ld.EXACT), ("chr1_1010_A_C", 2, ld.FLIPPED)]
        assert sorted(r.status_code for r in status.collect()) == [0, 1, 2, 5] and [(r.idx_i, r.idx_j, r.r) for r in pairs.collect()] == [(1, 2, -0.5)]
    with pytest.raises(dataflow.RegistryError):
        pipeline.ld_sources(spark, [entry] * 2, "aligned")


def test_methods_on_sets(spark):
    v = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "a")], "fineMappingLocusSetId string, variantId string")
    schema = "fineMappingLocusSetId string, n long"
    fit = methods.Method("susiex", lambda p: pd.DataFrame({"fineMappingLocusSetId": [p.fineMappingLocusSetId.iloc[0]], "n": [len(p)]}), schema)
    assert sorted((r.fineMappingLocusSetId, r.n, r.method) for r in methods.fan_out(v, [fit]).collect()) == [("s1", 2, "susiex"), ("s2", 1, "susiex")]


def test_signatures_agree_with_collected_sets(spark):
    """Variants in several loci, sets and studies, one that is missing, and a null."""
    loci = spark.createDataFrame([("a", "S"), ("b", "T"), ("c", "T"), ("d", "S")], "studyLocusId string, studyId string")
    members = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s2", "a"), ("s2", "c"), ("s3", "d"), ("s3", "c")], "fineMappingLocusSetId string, studyLocusId string")
    rows = spark.createDataFrame([("a", "v1"), ("a", "v2"), ("b", "v1"), ("c", "v2"), ("c", "v3"), ("d", "v3"), ("d", "v1"), ("d", None)], "studyLocusId string, variantId string")
    collected = members.join(loci, "studyLocusId").join(rows.where("variantId IS NOT NULL").groupBy("studyLocusId").agg(F.collect_list(F.struct("variantId")).alias("locus")), "studyLocusId")
    s = methods.signatures(members, loci, rows)
    pairs = lambda df: sorted(tuple(r) for r in df.select("fineMappingLocusSetId", "variantId").collect())
    assert pairs(methods.union_of(s)) == pairs(methods.union_variants(collected)) and len(pairs(methods.union_of(s))) == 8
    assert pairs(methods.shared_of(s)) == pairs(methods.shared_variants(collected)) == [("s1", "v1"), ("s2", "v2"), ("s3", "v3")]
    schema = "fineMappingLocusSetId string, n long"
    fit = methods.Method("multisusie", lambda x: x.groupby("fineMappingLocusSetId", as_index=False).agg(n=("variantId", "nunique")), schema)
    fanned = lambda df: sorted(tuple(r) for r in df.collect())
    assert fanned(methods.fan_out_of(s, members, [fit])) == fanned(methods.fan_out(methods.union_variants(collected), [fit]))



def test_arriving_manifests(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    manifest_file(folder, [("R1", "A", "main", "x", "eas", "t", 1)])
    seen = []
    arrivals.watch(spark, str(folder), lambda df, n: seen.extend(r.studyId for r in df.collect()), str(tmp_path / "cp"), once=True).awaitTermination(60)
    assert seen == ["A"]


def test_runs_are_released_when_complete(spark, tmp_path):
    """A run over two files is released with the second, and not again, also after a restart from the checkpoint."""
    folder = tmp_path / "in"
    folder.mkdir()
    expected = spark.createDataFrame([("R1", 2), ("R2", 1), ("R3", 2)], "runId string, nMembers int")
    seen = []

    def arrive(name, *members):
        rows = [(run, study, "main", "x", "eas", "t", n) for run, study, n in members]
        (folder / name).write_text(HEAD + "".join("\t".join(map(str, r)) + "\n" for r in rows))

    def work():
        handle = lambda df, n: seen.append(sorted((r.runId, r.studyId, r.effectiveSampleSize) for r in df.collect()))
        arrivals.watch_runs(spark, str(folder), expected, handle, str(tmp_path / "cp"), once=True, files_a_batch=1).awaitTermination(120)
        found = [x for x in seen if x]
        seen.clear()
        return found

    arrive("a.tsv", ("R1", "A", 1), ("R3", "D", 4), ("none", "X", 0))
    assert work() == []
    arrive("b.tsv", ("R2", "C", 3), ("R1", "A", 1))
    assert work() == [[("R2", "C", 3)]]
    arrive("c.tsv", ("R1", "B", 2), ("R2", "C", 3))
    assert work() == [[("R1", "A", 1), ("R1", "B", 2)]]
    arrive("d.tsv", ("R1", "A", 1), ("R1", "B", 2), ("R1", "Z", 9), ("R3", "E", 5))
    assert work() == [[("R3", "D", 4), ("R3", "E", 5)]]
    assert work() == []


def test_members_of_runs_are_tables(spark, tmp_path):
    """No Python task gathers a run's members; a batch that is done again gives the same, and first comers stay."""
    expected = spark.createDataFrame([("R", 3)], "runId string, nMembers int")
    batch = lambda *rows: spark.createDataFrame([("R", s, "main", "x", "eas", "t", n) for s, n in rows], arrivals.MANIFEST)
    work = lambda n, *rows: arrivals.complete_runs(batch(*rows), n, expected, str(tmp_path / "kept"))
    assert work(0, ("A", 1), ("B", 1), ("A", 1)).count() == 0
    for _ in range(2):
        out = work(1, ("A", 9), ("C", 2))
        assert sorted((r.studyId, r.effectiveSampleSize) for r in out.collect()) == [("A", 1), ("B", 1), ("C", 2)]
    assert "Pandas" not in out._jdf.queryExecution().toString()
    assert work(2, ("A", 1), ("D", 1)).count() == 0


def test_commands(spark, tmp_path, capsys):
    p = lambda name: str(tmp_path / name)
    for s, sig in (("A", True), ("B", True)):
        _stats(spark, [(s, sig)]).coalesce(1).write.parquet(p(f"{s}.stats"))
        assert cli.main(["locus_breaker", "--input", p(f"{s}.stats"), "--output", p(f"{s}.parquet"), "--no-remove-mhc"]) == 0
    assert spark.read.parquet(p("A.parquet")).first().locusEnd == 101_020
    assert cli.main(["collect_finemapping_loci", "--input", p("A.parquet"), "--input", p("B.parquet"), "--full-output", p("full.parquet"), "--partial-output", p("part.parquet"), "--non-overlap-output", p("none.parquet"), "--stats-output", p("stats.json")]) == 0
    doc = json.loads((tmp_path / "stats.json").read_text())
    assert doc["studyIds"] == ["A", "B"] and doc["inputFiles"]["A"] == p("A.parquet")
    assert cli.main(["collect_finemapping_loci", "--input", p("A.parquet"), "--input", p("A.parquet"), "--full-output", p("x.parquet"), "--partial-output", p("y.parquet"), "--non-overlap-output", p("z.parquet"), "--stats-output", p("s.json")]) == 2
    assert cli.main(["split_finemapping_loci", "--input", p("full.parquet"), "--output", p("split")]) == 0
    assert cli.main(["clumping_report", "--input", p("A.parquet"), "--input", p("B.parquet"), "--output", p("report.parquet")]) == 0
    assert spark.read.parquet(p("report.parquet")).count() == 2
    assert cli.main(["compare", "--first", p("A.parquet"), "--second", p("A.parquet")]) == 0 and cli.main(["compare", "--first", p("A.parquet"), "--second", p("B.parquet")]) == 1
    assert cli.main(["transform", "--input", p("A.stats"), "--output", p("z")]) == 0
    text = gzip.open(next((tmp_path / "z").glob("*.gz")), "rt").read()
    assert text.splitlines()[0] == "chromosome\tvariantId\tposition\treferenceAllele\talternateAllele\tzScore" and "\tA\tC\t" in text
    spark.createDataFrame([], clumping.STUDY_LOCUS).coalesce(1).write.parquet(p("empty.parquet"))
    capsys.readouterr()
    assert cli.main(["empty_status", "--input", p("empty.parquet"), "--run-id", "R", "--stage", "LOCUS_BREAKER"]) == 0
    assert json.loads(capsys.readouterr().out)["reason"] == "EMPTY_DATASET"
    (tmp_path / "s.jsonl").write_text('{"ancestry": "eas", "n_ld_pairs": 0}\n')
    assert cli.main(["check_ld_pair_stats", "--input", p("s.jsonl"), "--run-id", "R", "--set-id", "S", "--path", "x"]) == 0
    assert json.loads(capsys.readouterr().out)["reason"] == "EMPTY_LD_PAIRS"


def test_storage_options_follow_the_schemes(spark, tmp_path):
    assert tables.storage_options("/a", "hdfs://x/y", "file:///z") == {}
    s3 = tables.storage_options("s3://b/x", "/a", region="eu-west-1", anonymous=False)
    assert s3 == {"fs.s3.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem", "fs.s3a.endpoint.region": "eu-west-1"}
    assert len(tables.storage_options("S3A://b/x", "gs://c/y")) == 4
    spark.range(3).write.parquet(str(tmp_path / "t"))
    assert tables.read_files(spark, str(tmp_path / "t"), options=s3).count() == 3
