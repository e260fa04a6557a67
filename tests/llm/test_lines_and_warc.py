"""Line dedup and WARC archives."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import zstandard
from pyspark.sql import functions as F

from locusweave.llm import line_dedup, warc

from .conftest import rows


def brute_lines(pages, ratio, least):
    total, seen = Counter(h for h, _ in pages), defaultdict(Counter)
    for h, t in pages:
        seen[h].update({x.strip(" ") for x in (t or "").split("\n")} - {""} if t is not None else ())
    return [None if t is None else "\n".join(x for x in t.split("\n") if not (seen[h][x.strip(" ")] >= least and seen[h][x.strip(" ")] > ratio * total[h])) for h, t in pages]


def test_lines_above_the_ratio_go(spark):
    rng = random.Random(5)
    lines = ["menu", "footer ", " footer", "", "a", "b", "c\tt"] + [f"u{i}" for i in range(200)]
    pages = [(rng.choice(["x", "x", "y", None]), None if rng.random() < 0.05 else "\n".join(rng.choices(lines, weights=[20] * 4 + [5] * 3 + [1] * 200, k=rng.randint(0, 12)))) for _ in range(120)]
    df = spark.createDataFrame([(i, h, t, None if t is None else len(t), "z") for i, (h, t) in enumerate(pages)], "doc_id long, source string, text string, n_chars long, pages string")
    out = line_dedup.remove(df, max_ratio=0.1, min_pages=3)
    got = {r["doc_id"]: r for r in rows(out)}
    want = brute_lines(pages, 0.1, 3)
    assert {i: got[i]["text"] for i in got} == dict(enumerate(want))
    assert all(got[i]["n_chars"] == (None if t is None else len(t)) for i, t in enumerate(want))
    assert out.columns == [*df.columns, "_n_dropped"] and any(got[i]["_n_dropped"] for i in got)
    assert line_dedup.remove(df.limit(0)).count() == 0


def test_records_survive_the_round_trip(spark):
    big, small = "<p>ü</p>" * 30, "tiny"
    pages = [(5, "http://a/", big), (3, "http://b/", big), (9, None, big), (1, "u", small), (2, "u", small), (4, "u", None), (6, "u", ""), (7, "v\r\nX: y", "x" * 100), (8, "v", "x" * 100), (None, "n", big), (3, "http://b/", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("first", F.lit("f"))
    got = sorted(rows(warc.round_trip(df)), key=str)
    want = []
    for i, u, h in pages:
        raw = (h or "").encode()
        same = [j for j, _, x in pages if x == h and j is not None] if len(raw) >= 100 and i is not None else []
        first = min(same, default=i)
        want.append({"page_id": i, "url": "".join((u or "").splitlines()), "payload_bytes": len(raw), "payload_digest": hashlib.sha256(raw).hexdigest(), "record_type": "revisit" if i != first else "response", "refers_to": first if i != first else None})
    assert got == sorted(want, key=str)
    assert warc.round_trip(df.limit(0)).count() == 0


def test_frames_are_read_alone(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}", f"page {i} " * 40) for i in range(50)], "page_id long, url string, html string")
    path = f"file://{tmp_path}/archive"
    warc.write_archive(pages.coalesce(2), path, bundle_bytes=8000, frame_bytes=3000)
    index = spark.read.parquet(path).selectExpr("bundle", "inline(index)").collect()
    assert len({r.bundle for r in index}) > 2 and {0, 1} <= {r.frame for r in index}
    assert next(r.offset for r in index if r.page_id == 17) > 0 or next(r.offset for r in index if r.page_id == 18) > 0
    assert len({(r.bundle, r.frame) for r in index}) < 50 == len({(r.bundle, r.frame, r.offset) for r in index})
    found = {i: p for i, _, p in warc.lookup(spark, path, [0, 17, 18, 49])}
    assert found == {i: (f"page {i} " * 40).encode() for i in (0, 17, 18, 49)}
    warc.export(spark, path, str(tmp_path / "files"))
    files = sorted((tmp_path / "files").glob("*.warc.zst"))
    text = b"".join(zstandard.ZstdDecompressor().stream_reader(f.read_bytes(), read_across_frames=True).read() for f in files)
    assert text.count(b"WARC/1.1\r\n") == 50


def test_copies_count_as_one_page(spark):
    article = "first unique line\nsecond unique line\nmenu"
    pages = [("x", f"menu\nown {i}") for i in range(20)] + [("x", article)] * 10 + [(None, article)] * 6 + [("x", None)] * 3
    df = spark.createDataFrame([(i, h, t) for i, (h, t) in enumerate(pages)], "doc_id long, source string, text string")
    got = {r["doc_id"]: r["text"] for r in rows(line_dedup.remove(df, counted=None, copies_once=True))}
    want = [None if t is None else t if h is None else t.replace("menu\n", "").replace("\nmenu", "") for h, t in pages]
    assert got == dict(enumerate(want))


def test_a_long_payload_is_one_record(spark):
    long = "ä" * (1 << 21)
    df = spark.createDataFrame([(1, "u", long), (2, "u", long), (3, "u", "x")], "page_id long, url string, html string")
    got = sorted(rows(warc.round_trip(df)), key=lambda r: r["page_id"])
    assert [(r["payload_bytes"], r["record_type"], r["refers_to"]) for r in got] == [(1 << 22, "response", None), (1 << 22, "revisit", 1), (1, "response", None)]


def test_large_drop_lists_join_by_host_and_salt(spark, monkeypatch):
    pages = [(i % 2, f"menu {i % 2}\nown {i}\nfoot") for i in range(60)]
    df = spark.createDataFrame([(i, f"h{h}", t) for i, (h, t) in enumerate(pages)], "doc_id long, source string, text string")
    one = sorted(rows(line_dedup.remove(df)), key=str)
    monkeypatch.setattr(line_dedup, "MAX_BROADCAST", 0)
    monkeypatch.setattr(line_dedup, "PAGES_A_TASK", 7)
    assert sorted(rows(line_dedup.remove(df)), key=str) == one and one[0]["_n_dropped"] == 2


def test_a_very_long_page(spark):
    text = "\n".join(["menu", *(f"line {i}" for i in range(200_000)), "menu"])
    df = spark.createDataFrame([(0, "h", text), *((i, "h", f"menu\nown {i}") for i in range(1, 9))], "doc_id long, source string, text string")
    got = {r["doc_id"]: r for r in rows(line_dedup.remove(df))}
    assert got[0]["text"] == text.removeprefix("menu\n").removesuffix("\nmenu") and got[0]["_n_dropped"] == 2


def test_lines_beside_any_columns(docs):
    """Columns named as the operator's own are kept, and one named as the count makes way for it."""
    names = ("_host", "_lines", "_drop", "_pages", "_salt", "_n_dropped", "h", "a")
    d = docs(["menu\n" + f"text {i}" for i in range(60)])
    for c in names:
        d = d.withColumn(c, F.lit("kept"))
    got = rows(line_dedup.remove(d))
    assert all(r["text"] == f"text {r['doc_id']}" and r["_n_dropped"] == 1 for r in got)
    assert all(r[c] == "kept" for r in got for c in names if c != "_n_dropped")


def test_many_groups_of_copies_meet_by_salt(spark, monkeypatch, tmp_path):
    """Beyond the bound of what is broadcast, with the same records; a wrong index is an error."""
    pages = spark.createDataFrame([(i, "u", "page " * 30 + str(i % 7)) for i in range(40)] + [(50, "u", "short")] * 3, "page_id long, url string, html string")
    want = sorted(map(tuple, warc.round_trip(pages).collect()))
    monkeypatch.setattr(warc, "MAX_BROADCAST", 3)
    assert sorted(map(tuple, warc.round_trip(pages).collect())) == want and sum(r[4] == "revisit" for r in want) == 33
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    bad = spark.read.parquet(path).withColumn("index", F.reverse("index"))
    bad.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="leads to no record"):
        warc.read_archive(spark, str(tmp_path / "bad")).collect()
