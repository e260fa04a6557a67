"""Published sets, prepared outputs, footers, path globs and field-wise comparison."""

import json
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from locusweave.operators import ld, methods, reports
from locusweave.plans import pipeline
from locusweave.sources import footers, publish, records, tables


def writers(spark, n, names):
    return {name: (lambda path, k=k: tables.write_table(spark.range(n + k), path)) for k, name in enumerate(names)}


def seen(spark, root):
    return {n: spark.read.parquet(p).count() for n, p in publish.outputs(spark, root).items()}


def test_a_set_shows_whole_or_not_at_all(spark, tmp_path):
    root, names = str(tmp_path / "new" / "root"), list(publish.TARGETS)
    assert len(names) == 13 and publish.outputs(spark, root) == {}
    first = publish.publish(spark, root, writers(spark, 1, names), publish.TARGETS)
    whole = {n: 1 + k for k, n in enumerate(names)}
    assert seen(spark, root) == whole
    assert publish.outputs(spark, root)["ld_pair_stats"].endswith(f"{first}/locus_annotation/stats")

    def killed(path):
        tables.write_table(spark.range(5), path)
        assert seen(spark, root) == whole  # readers see the old set while the new one is written
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        publish.publish(spark, root, writers(spark, 50, names[:3]) | {"locus_annotation": killed}, publish.TARGETS)
    assert seen(spark, root) == whole and [p.name for p in (tmp_path / "new/root/sets").iterdir()] == [first]
    held = publish.outputs(spark, root)
    second = publish.publish(spark, root, writers(spark, 3, names), publish.TARGETS)
    assert seen(spark, root) == {n: 3 + k for k, n in enumerate(names)}
    assert spark.read.parquet(held["loci"]).count() == whole["loci"]  # the set before stays for its readers
    third = publish.publish(spark, root, writers(spark, 4, names[:2]))
    assert {p.name for p in (tmp_path / "new/root/sets").iterdir()} == {second, third}
    (tmp_path / "new/root/sets/left-by-a-killed-writer").mkdir()
    assert publish.clean(spark, root) == 2 and seen(spark, root) == {names[0]: 4, names[1]: 5}
    with pytest.raises(ValueError, match="share a folder"):
        publish.publish(spark, root, writers(spark, 1, names[:2]), {names[0]: "x", names[1]: "x"})


def test_readers_never_see_a_part(spark, tmp_path):
    """Sets of equal numbers of rows are replaced while another thread reads."""
    root, wrong, stop = str(tmp_path / "root"), [], threading.Event()
    publish.publish(spark, root, {n: (lambda p: tables.write_table(spark.range(7), p)) for n in "ab"})

    def read():
        while not stop.is_set():
            counts = set(seen(spark, root).values())
            if len(counts) != 1:
                wrong.append(counts)

    reader = threading.Thread(target=read)
    reader.start()
    publish.publish(spark, root, {n: (lambda p: tables.write_table(spark.range(9), p)) for n in "ab"})
    stop.set()
    reader.join()
    assert not wrong and set(seen(spark, root).values()) == {9}


def test_places_of_outputs_are_prepared(spark, tmp_path):
    p = lambda name: str(tmp_path / name)
    tables.write_table(spark.range(3), p("a/b/c.parquet"))
    tables.write_table(spark.range(4), p("a/b/c.parquet"))
    assert spark.read.parquet(p("a/b/c.parquet")).count() == 4
    (tmp_path / "file").write_text("old")
    records.write_jsonl(spark.range(2), p("file"))
    assert spark.read.text(p("file")).count() == 2
    (tmp_path / "own").mkdir()
    (tmp_path / "own" / "thesis.txt").write_text("mine")
    for write in (lambda: tables.write_table(spark.range(1), p("own")), lambda: tables.write_tsv_gz(spark.range(1), p("own")), lambda: records.write_jsonl(spark.range(1), p("own"))):
        with pytest.raises(IsADirectoryError):
            write()
    assert (tmp_path / "own" / "thesis.txt").read_text() == "mine"
    records.write_report(spark, {"b": 1, "a": [2]}, p("x/y/report.json"))
    records.write_report(spark, {"b": 2}, p("x/y/report.json"))
    assert json.loads((tmp_path / "x/y/report.json").read_text()) == {"b": 2}


def test_a_result_is_published_as_one_set(spark, tmp_path):
    result = pipeline.PipelineResult({"study_locus": spark.range(3), "status": spark.range(2), "locus_sets": spark.createDataFrame([("a", 1)], "fineMappingLocusSetId string, x int")})
    result.publish(str(tmp_path))
    found = publish.outputs(spark, str(tmp_path))
    assert found["study_locus"].endswith("/locus_breaker_clumped_study_locus") and spark.read.parquet(found["study_locus"]).count() == 3
    assert spark.read.text(found["status"]).count() == 2 and spark.read.parquet(found["locus_sets"]).columns == ["fineMappingLocusSetId", "x", "_fineMappingLocusSetId"]


def test_unknown_clumping_methods(spark):
    assert pipeline.clumping_method("Windows") is pipeline.CLUMPING["windows"]
    with pytest.raises(ValueError, match="Unknown clumping method 'other'; known are locus_breaker, windows"):
        pipeline.clumping_method("other")


def test_footers_tell_rows_without_a_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(0, 5000, 1, 3).withColumn("x", F.repeat(F.lit("y"), 50)).write.option("parquet.block.size", 16_384).parquet(path)
    spark.range(10).coalesce(1).write.parquet(f"{path}/below/k=1")
    assert footers.row_count(spark, path) == 5010
    groups = footers.row_groups(spark, path, files_a_task=1)
    rows = groups.collect()
    assert sum(r.n_rows for r in rows) == 5010 and len({r.file for r in rows}) == 4 and all(r.n_bytes > 0 for r in rows)
    assert groups.rdd.getNumPartitions() == 4
    key = "spark.sql.sources.useV1SourceList"
    with tables.setting(spark, key, "csv,json,text"), tables.setting(spark, "spark.sql.parquet.aggregatePushdown", "true"):
        assert "PushedAggregation: [COUNT(*)]" in footers.counted(spark, path)._jdf.queryExecution().toString()


def test_path_globs(spark, tmp_path):
    root = str(tmp_path)
    for n, below in enumerate(("x1/a/b", "x2", "y/x1")):
        spark.range(n + 1).coalesce(1).write.parquet(f"{root}/{below}")
    spark.range(4).withColumn("k", F.lit("u v")).coalesce(1).write.partitionBy("k").parquet(f"{root}/x3")
    count = lambda glob: tables.read_tree(spark, root, glob=glob).count()
    assert (count("**/*.parquet"), count("x*/**/*.parquet"), count("x*/*.parquet"), count("y/x?/*.parquet")) == (10, 7, 2, 3)
    got = tables.read_tree(spark, root, glob="**/*.parquet")
    assert {(r.k, r["count"]) for r in got.groupBy("k").count().collect()} == {("u v", 4), (None, 6)}
    for bad in ("**/x/*.parquet", "x/**", "x/"):
        with pytest.raises(ValueError, match="before the file name"):
            tables.read_tree(spark, root, glob=bad)


SCHEMA = "k long, s string, x double, q array<string>, l array<struct<v string, b double>>, o struct<a int, f float>, m map<string,double>"


def differences(spark, first, second, keys=("k",), tolerance=1e-8):
    a, b = spark.createDataFrame(first, SCHEMA), spark.createDataFrame(second, SCHEMA)
    return sorted(((r[0], r.place, r.kind, r.field) for r in reports.field_differences(a, b, keys, tolerance).collect()), key=str)


def test_differences_by_key_and_field(spark):
    row = lambda k, s="s", x=0.5, q=("b", "a"), l=(("v", 1.0), ("u", 2.0)), o=(1, 0.5), m=None: (k, s, x, None if q is None else list(q), None if l is None else list(l), o, m)  # noqa: E741, E731
    edge = 0.12345678905  # rounded to ten digits it turns with the noise
    same = [row(1), row(2, x=edge), row(3, x=float("nan")), row(4, q=None, l=None, o=None), row(None), row(5, q=(), l=()), row(6, m={"a": 1.0, "b": None})]
    other = [row(6, m={"b": None, "a": 1.0 + 1e-10}), row(None), row(5, q=(), l=()), row(4, q=None, l=None, o=None), row(3, x=None), row(2, x=edge - 2e-13), row(1, q=("a", "b"), l=(("u", 2.0 - 1e-12), ("v", 1.0)))]
    assert differences(spark, same, other) == []
    assert differences(spark, [row(1, x=1.0)], [row(1, x=1.0 + 1e-6)]) == [(1, 1, "value", "x")] and differences(spark, [row(1, x=1.0)], [row(1, x=1.0 + 1e-6)], tolerance=1e-5) == []
    assert differences(spark, [row(1, s="a", q=("a",))], [row(1, s=None, q=("a", "b"))]) == [(1, 1, "value", "q"), (1, 1, "value", "s")]
    assert differences(spark, [row(1, l=(("u", 1.0), ("v", None)), o=(1, 0.5))], [row(1, l=(("v", 3.0), ("u", 1.0)), o=(2, 0.5))]) == [(1, 1, "nested", "l[1].b"), (1, 1, "nested", "o.a")]
    assert differences(spark, [row(1, q=("a",), l=None)], [row(1, q=("b",), o=None)]) == [(1, 1, "nested", "q[0]"), (1, 1, "value", "l"), (1, 1, "value", "o")]
    assert differences(spark, [row(1), row(1), row(2), row(None)], [row(1), row(3)]) == [(1, 2, "missing", None), (2, 1, "missing", None), (3, 1, "extra", None), (None, 1, "missing", None)]
    assert differences(spark, [], []) == [] and len(differences(spark, [row(1)], [])) == 1


def test_differences_of_ties_meet_by_rank(spark):
    row = lambda x: (1, "s", x, None, None, None, None)
    assert differences(spark, [row(3.0), row(1.0), row(2.0)], [row(2.0 + 1e-10), row(3.0), row(1.0)]) == []
    a, b = spark.createDataFrame([(1, 2.0)], "k long, x double"), spark.createDataFrame([(1, 2.0, "new")], "k long, x double, y string")
    found = reports.field_differences(a, b, ("k",)).collect()
    assert [(r.kind, r.field, r.first, r.second) for r in found] == [("value", "y", None, "new")]
    assert reports.field_differences(a.select("k"), a.select("k"), ("k",)).count() == 0
    with pytest.raises(ValueError, match="must not be floats"):
        reports.field_differences(a, b, ("x",))
    with pytest.raises(KeyError, match="not in both"):
        reports.field_differences(a, b, ("y",))


def test_differences_take_one_exchange_and_sort_arrays_once(spark):
    """Both tables go through one exchange by key, and an array is sorted once a side, however many fields its structs have."""
    a, b = (spark.createDataFrame([(1, [("v", 1.0, 2.0, 3.0), ("u", 2.0, 3.0, x)])], "k long, l array<struct<v string, b double, c double, d double>>") for x in (4.0, 5.0))
    found = reports.field_differences(a, b, ("k",))
    assert [(r.field, r.first, r.second) for r in found.collect()] == [("l[0].d", "4.0", "5.0")]
    with tables.setting(spark, "spark.sql.adaptive.enabled", "false"):
        plan = reports.field_differences(a, b, ("k",))._jdf.queryExecution()
    assert plan.executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert plan.optimizedPlan().toString().count("array_sort(") <= 4


def test_nearest_of_many_anchors(spark):
    places = [(i, f"chr{1 + i % 2}_{p}_A_C") for i, p in enumerate([5, 5, 9, 14, 14, 15, 100, 130, 131, 500, 900, 900, 901, 902, 903, 904, 905, 2000])]
    index = spark.createDataFrame([*places, (99, "odd")], "idx long, variantId string")

    def plain(k, flank):
        at = [(i, v.split("_")[0], int(v.split("_")[1])) for i, v in places]
        out = []
        for i, c, p in at:
            near = sorted((abs(q - p), j) for j, d, q in at if c == d and abs(q - p) <= flank)[:k]
            out += [(i, j, d, n + 1) for n, (d, j) in enumerate(near)]
        return sorted(out)

    for k, flank, ring in ((3, 40, 1), (3, 40, None), (2, 1000, 3), (50, 5000, 700), (1, 0, None)):
        got = ld.nearest(index, index, k, flank, ring)
        assert sorted((r.anchor_idx, r.idx, r.distance, r.place) for r in got.collect()) == plain(k, flank)


def test_problems_of_method_lists(spark):
    rows = [(["sushie", "susiex"],), ([],), (None,), (["sushie", "sushie"],), (["b", "a", "sushie"],), (["sushie", None],)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("m", T.ArrayType(T.StringType()))]))
    assert [r[0] for r in df.select(methods.problem(F.col("m"))).collect()] == [None, "empty", "empty", "repeated", "unknown: a, b", "null"]


def test_many_keys_are_written_by_many_tasks(spark, tmp_path):
    """Few rows of many keys: folders cost the time, so one task would take them all if its bytes were the measure."""
    rows = spark.range(120).select((F.col("id") % 60).cast("string").alias("k"), F.col("id").alias("x"))
    tables.write_per_key(rows, str(tmp_path / "keys"), "k", keep_key=False)
    files = list((tmp_path / "keys").glob("k=*/part-*.parquet"))
    assert len(files) == 60 and len({f.name.split("-")[1] for f in files}) > 10
    assert sorted((r.k, r.n) for r in tables.read_tree(spark, str(tmp_path / "keys")).groupBy("k").agg(F.count("x").alias("n")).collect()) == sorted((str(k), 2) for k in range(60))
