"""Line numbers over files and splits."""

import random

from pyspark.sql import types as T

from locusweave.sources import lines, tables

SCHEMA = T.StructType([T.StructField("k", T.LongType())])


def files(tmp_path):
    rng, out = random.Random(3), {}
    for name, n in (("a", 900), ("b", 400), ("c", 50), ("d", 0)):
        rows = [rng.choice(["", "  ", '{"k": %d}' % i, '{"k": %d, "more": "%s"}' % (i, "x" * rng.randrange(60))]) for i in range(n)]
        out[name] = rows
    out["a"][700], out["a"][850], out["b"][0], out["c"] = "no json", '{"k": null}', '{"k": "text"}', [r for r in out["c"] if r.strip()]
    for name, rows in out.items():
        (tmp_path / f"{name}.jsonl").write_text("".join(r + "\n" for r in rows))
    return out


def test_every_line_has_its_number(spark, tmp_path):
    want = [(n, i, r) for n, rows in files(tmp_path).items() for i, r in enumerate(rows, 1)]
    with tables.setting(spark, "spark.sql.files.maxPartitionBytes", "2k"):
        assert lines.split_index(lines.split_lines(spark, str(tmp_path))).count() > 8
        got = [(r.file.rsplit("/", 1)[1][0], r.line, r.value) for r in lines.numbered(spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted(want)


def test_the_first_bad_line_of_each_file(spark, tmp_path):
    files(tmp_path)
    with tables.setting(spark, "spark.sql.files.maxPartitionBytes", "2k"):
        got = sorted((r.file.rsplit("/", 1)[1], r.line, r.value) for r in lines.first_bad_lines(spark, SCHEMA, ("k",), str(tmp_path)).collect())
    assert got == [("a.jsonl", 701, "no json"), ("b.jsonl", 1, '{"k": "text"}')]
    assert lines.first_bad_lines(spark, SCHEMA, (), str(tmp_path / "d.jsonl")).isEmpty()


def test_splits_grow_with_the_files(spark, tmp_path):
    from locusweave.plans import io_cases

    for n, size in ((10, 8192), (3_000_000, 11_719)):
        path = tmp_path / str(n)
        path.mkdir()
        (path / "a.txt").write_text("x" * n)
        assert io_cases._splits(spark, str(path)) == ("spark.sql.files.maxPartitionBytes", str(size))
