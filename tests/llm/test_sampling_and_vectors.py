"""Importance resampling, centroid clustering and the quality classifier."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from locusweave.llm import centroids, importance, quality, queries
from locusweave.llm import textbatch as tb

from .conftest import rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]
    return len(w), Counter(zlib.crc32(x.encode()) % 10_000 for x in runs)


def brute_importance(docs, target):
    mine, aim = [(d, *buckets(t)) for d, t in docs], sum((buckets(t)[1] for t in target), Counter())
    corpus = sum((c for *_, c in mine), Counter())
    s_all, t_all = sum(corpus.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1.0) * (s_all + 10_000.0) / ((n + 1.0) * (t_all + 10_000.0)))) for b, n in corpus.items()}
    out = []
    for d, n, c in mine:
        h = int(hashlib.sha256(f"42:{'null' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * k for b, k in c.items())
        out.append([d, n, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fits = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = {id(r): k + 1 for k, r in enumerate(fits[: 5 * len(fits) // 100])}
    return [(*r, drawn.get(id(r))) for r in out]


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(31)
    text = lambda n, words: " ".join(rng.choice(words) for _ in range(n))
    plain, aim = [f"p{k}" for k in range(60)], [f"q{k}" for k in range(20)]
    texts = [None, "", " ... ", "one", "One TWO", "one two three", "Ünïcode Ωmega — dash one-two", "a " * 30_000]
    texts += [text(rng.randrange(60), rng.choice((plain, plain, plain + aim, aim))) for _ in range(180)]
    same = text(40, aim)
    pairs = [*enumerate(texts), (900, same), (900, same), (901, same), (3, "other text of a known id"), (None, same), (None, None)]
    return pairs, [text(30, aim) for _ in range(12)] + [None, "", "one"]


def test_importance_matches_brute_force(spark, docs, prose):
    pairs, target = prose
    d = docs(pairs).withColumn("row", F.lit(1)).withColumn("bucket", F.lit(2)).withColumn("weight", F.lit("x")).repartition(3)
    t = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id int, text string")
    got = rows(importance.ranked(importance.scored(d, t)))
    key = lambda r: tuple(map(str, r))
    columns = ("doc_id", "n_words", "n_features", "weight", "score", "rank")
    assert sorted((tuple(r[c] for c in columns) for r in got), key=key) == sorted(brute_importance(pairs, target), key=key)
    drawn = sorted(r["rank"] for r in got if r["rank"])
    assert drawn == list(range(1, 1 + 5 * sum(r["n_words"] >= 20 for r in got) // 100)) and drawn


def test_drawn_rows_keep_their_columns(spark, docs, prose):
    pairs, target = prose
    d = docs(pairs).withColumn("_drawn", F.lit(7))
    t = spark.createDataFrame([(x,) for x in target], "text string")
    want = {r[0] for r in brute_importance(pairs, target) if r[5]}
    got = importance.draw(d, t)
    assert {r["doc_id"] for r in rows(got)} == want - {None} and got.columns == d.columns


def test_importance_of_nothing(spark, docs):
    none = docs([])
    assert importance.ranked(importance.scored(none, none)).count() == 0
    one = rows(importance.ranked(importance.scored(docs(["word " * 25]), none)))[0]
    assert one["n_features"] == 72 and one["rank"] is None


def test_words_of_a_number_of_runs(spark):
    n = list(range(8))
    for orders in (1, 2, 3, 4):
        runs = [sum(max(0, k - j) for j in range(orders)) for k in n]
        df = spark.createDataFrame(list(zip(n, runs, strict=True)), "n long, f long")
        assert df.where(importance._n_words(F.col("f"), orders) != F.col("n")).count() == 0


def brute_kmeans(pairs, k=40, rounds=5):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in pairs if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"2:{'null' if i is None else i}".encode()).hexdigest(), p) for i, p in kept)
    means = np.array([p for _, p in first[:k]], np.int64)
    x = np.array([p for _, p in kept], np.int64)
    for n in range(rounds + 1):
        d = ((x[:, None, :] - means[None]) ** 2).sum(2)
        own = d.argmin(1)
        if n < rounds:
            means = np.array([x[own == c].sum(0) // (own == c).sum() if (own == c).any() else means[c] for c in range(len(means))])
    least = d.min(1)
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in means.tolist()]
    return [(i, int(c), int(e), int(least[own == c].sum()), int(least.sum()), sha[c]) for (i, _), c, e in zip(kept, own, least, strict=True)]


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(32)
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(12)]
    near = lambda m: [float(np.float32(x + rng.gauss(0, 0.1))) for x in m]
    pairs = [(i, near(rng.choice(middles))) for i in range(260)]
    copy = near(middles[0])
    pairs += [(1000 + i, copy) for i in range(120)] + [(5, near(middles[1])), (5, copy), (None, copy), (None, near(middles[2]))]
    pairs += [(2000, None), (2001, []), (2002, copy[:63]), (2003, [*copy, 0.0]), (2004, [*copy[:63], None]), (2005, [*copy[:63], math.nan]), (2006, [*copy[:63], math.inf])]
    grid = [[float(i % 3) / 4] * 64 for i in range(30)]  # ties between centroids
    return pairs + [(3000 + i, v) for i, v in enumerate(grid)]


SCHEMA = "vec_id long, embedding array<float>"


def test_clusters_match_plain_rounds(spark, vectors):
    df = spark.createDataFrame(vectors, SCHEMA).withColumn("cluster", F.lit("c")).withColumn("point", F.lit(1)).repartition(5)
    got = [tuple(r.values()) for r in rows(centroids.digest(*centroids.cluster(df)))]
    assert sorted(got, key=str) == sorted(brute_kmeans(vectors), key=str)


def test_few_or_no_vectors(spark, vectors):
    few = [v for v in vectors if v[0] is not None and v[0] < 7]
    got = [tuple(r.values()) for r in rows(centroids.digest(*centroids.cluster(spark.createDataFrame(few, SCHEMA))))]
    assert sorted(got, key=str) == sorted(brute_kmeans(few), key=str)
    out = centroids.digest(*centroids.cluster(spark.createDataFrame([(1, None)], SCHEMA)))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_a_component_beyond_the_limit_is_an_error(spark):
    with pytest.raises(Exception, match="vector 8 has a component beyond"):
        centroids.points(spark.createDataFrame([(8, [1e30] * 64)], SCHEMA)).collect()


def test_scans_stop_strictly_beyond_twice_the_distance():
    order = centroids.Order(np.array([[0, 0], [4, 0], [0, 9]]))
    cluster, distance = order.nearest(np.array([[2, 0], [2, 0], [3, 0], [0, 0], [0, 9]]), np.array([1, 0, 0, 2, 0]))
    assert cluster.tolist() == [0, 0, 1, 0, 2] and distance.tolist() == [4, 4, 1, 0, 0]


@pytest.mark.parametrize(("name", "table"), [("op11_importance", "documents"), ("op12_centroids", "embeddings")])
def test_sql_agrees(spark, docs, prose, vectors, tmp_path, name, table):
    pairs, target = prose
    docs(pairs).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([v for v in vectors if v[1] is not None], SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.SQL[name]}) q").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect()) and table


@pytest.fixture(scope="module")
def graded():
    rng = random.Random(33)
    out = []
    for i in range(500):
        words, good = [rng.choice([f"wo{k}" for k in range(150)]) for _ in range(rng.randrange(15, 60))], rng.random() < 0.8
        if not good:
            words = rng.choice((lambda w: [x + "###" for x in w], lambda w: [x.upper() + "!!" for x in w], lambda w: [w[0]] * len(w)))(words)
        out.append((i, " ".join(words), int(good)))
    return out


def test_quality_of_held_out_texts(spark, docs, graded):
    d = docs([(i, t) for i, t, _ in graded]).withColumn("label", F.lit("l")).withColumn("sample_id", F.lit(3))
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in graded], "doc_id long, quality int, text int")
    model = quality.fit(d, labels.where("doc_id % 5 != 0"))
    got = {r["doc_id"]: r for r in rows(quality.score(d, model))}
    held = [(got[i]["score"] >= 0.3, bool(y)) for i, _, y in graded if i % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    odd = {r["doc_id"]: r for r in rows(quality.score(docs(["", None, "xx### " * 100_000, "wo1 wo2 wo3 wo4 wo5 wo6", " \n "]), model))}
    base = sum(y for i, _, y in graded if i % 5) / sum(1 for i, *_ in graded if i % 5)
    assert [odd[i]["evidence"] for i in (0, 1, 4)] == [[]] * 3 and all(abs(odd[i]["score"] - base) < 1e-9 for i in (0, 1, 4))
    assert odd[2]["score"] < 0.3 < odd[3]["score"]


def test_neighbours_are_the_nearest_by_plain_cosine(spark, docs, graded):
    d = docs([(i, t) for i, t, _ in graded[:200]])
    model = quality.fit(d, spark.createDataFrame([(i, y) for i, _, y in graded[:200]], "doc_id long, quality int").where("doc_id % 5 != 0"), rank=12)
    got = {r["doc_id"]: r for r in rows(quality.score(d, model))}
    raw = [t.encode() for _, t, _ in graded[:200]]
    vectors = {}
    for first, n, row, term, times in quality.terms(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])):
        for i in range(n):
            dense = np.zeros(quality.DIMS)
            dense[term[row == i]] = quality.weighted(np.zeros((row == i).sum(), int), term[row == i], times[row == i], model.idf, 1)
            vectors[first + i] = dense
    x = np.stack([vectors[int(i)] for i in model.ids])
    turn = np.linalg.svd(x, full_matrices=False)[2][:12].T
    unit = lambda v: v / np.linalg.norm(v)
    examples = [unit(v @ turn) for v in x]
    for i in range(0, 200, 5):
        q = unit(vectors[i] @ turn)
        want = sorted((float(q @ e) for e in examples), reverse=True)[: quality.K]
        assert np.allclose([e["cosine"] for e in got[i]["evidence"]], want, atol=1e-3)
        w = [max(0, e["cosine"]) ** quality.SHARPNESS * model.rates[0] for e in got[i]["evidence"]]
        assert set(model.rates) == {1.0} and abs(got[i]["score"] - sum(a * e["label"] for a, e in zip(w, got[i]["evidence"], strict=True)) / sum(w)) < 1e-9


def test_quality_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(docs(["a b"]), none)
    assert rows(quality.score(docs(["a b"]), model))[0]["score"] == 0 and quality.score(docs([]), model).count() == 0


def test_samples_have_a_bound(spark, docs):
    """An id of many rows teaches one text; the smallest."""
    d = docs([(1, f"text {i}") for i in range(300)] + [(2, "two"), (3, None)])
    labels = spark.createDataFrame([(1, 1)] * 50 + [(2, 0), (3, 1)], "doc_id long, quality int")
    model = quality.fit(d, labels, max_rows=4)
    assert model.ids == ["1", "2", "3"] and model.rates.tolist() == [1, 1, 1]


def test_shapes_of_tokens():
    texts = ["abc Def9### é", "é", "", "AB!! x\ty"]
    raw = [t.encode() for t in texts]
    h, row = quality.shapes(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    same = lambda t: tb.Words(np.frombuffer(t, np.uint8), np.array([0, len(t)]), tb.NONSPACE).hashes(lower=False)[0]
    assert row.tolist() == [0, 0, 0, 1, 3, 3, 3] and h.tolist() == [same(x) for x in (b"a", b"Aa0#", b"a", b"a", b"A!", b"a", b"a")]
