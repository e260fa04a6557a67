"""Operators that read each text once: licenses, decontamination, language, fingerprints."""

import hashlib
import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusweave.llm import decontaminate, fingerprints, langid, licenses
from locusweave.llm import textbatch as tb

from .conftest import rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = ["", None, " \n\t", "Ünïcode Ωmega — dash", "GNU general-PUBLIC license! mit license mit LICENSE", "cc by", "apache", "x" * 5000, "a b " * 3000]


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s or "")


def test_words_and_hashes_match_a_regular_expression():
    texts = [t or "" for t in ODD] + ["abc", "def"]
    raw = [t.encode() for t in texts]
    offs = np.cumsum([0, *map(len, raw)])
    w = tb.Words(np.frombuffer(b"".join(raw), np.uint8), offs, tb.ALNUM)
    want = [(r, m.encode()) for r, t in enumerate(texts) for m in WORD.findall(lower(t))]
    assert [(int(w.row[i]), w.word(i)) for i in range(len(w.starts))] == want
    by = {}
    for h, (_, word) in zip(w.hashes().tolist(), want, strict=True):
        assert by.setdefault(word, h) == h
    assert len(set(by.values())) == len(by)


def brute_licenses(text):
    words = WORD.findall(lower(text))
    hits = sorted((i, t.label) for t in licenses.BASE for i in range(len(words)) if words[i : i + len(t.phrase.split())] == t.phrase.split())
    return len(words), [i for i, _ in hits], sorted({x for _, x in hits})


def test_licenses_find_every_place(docs):
    texts = [*ODD, "Licensed under the Apache License, Version 2.0. Also the GNU General Public License and CC BY-NC 4.0", "the mit, license cc cc by by apache-license"]
    got = {r["doc_id"]: r for r in rows(licenses.digest(licenses.scan(docs(texts))))}
    for i, t in enumerate(texts):
        n, at, labels = brute_licenses(t)
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (n, len(at), min(at, default=None), max(at, default=None), ",".join(labels))
        assert set(labels) <= set(r["labels"].split(",")) | {""}
        assert 0 <= r["score"] <= 1
    assert "apache-2.0" in got[len(ODD)]["labels"]


def test_licenses_merge_neighbouring_diagonals(docs):
    body = next(t.phrase for t in licenses.BODIES if t.label == "bsd")
    broken = body.replace("with or", "with extra or")
    spans = rows(licenses.scan(docs([broken, body.replace(" ", "\n*** ")])))
    assert {s["label"] for r in spans for s in r["spans"]} == {"bsd"}
    assert sorted(round(r["spans"][0]["share"], 2) for r in spans) == [0.95, 1.0]


def test_licenses_count_a_lone_vote_beside_a_word_put_in(docs):
    texts = ["Licensed under the CC BY-NC 4.0", "the GNU lesser old general public license", "cc by nc 4 0", "x licensed under y", "licensed under " + "z " * 40 + "cc by nc 4 0"]
    got = {r["doc_id"]: r for r in rows(licenses.scan(docs(texts)))}
    spans = [[(s["start"], s["end"], round(s["share"], 2)) for s in got[i]["spans"] if s["label"] == label] for i, label in enumerate(["cc-by-nc", "lgpl", "cc-by-nc", "cc-by-nc", "cc-by-nc"])]
    assert spans == [[(0, 8, 0.83)], [(1, 7, 0.75)], [], [], []]


def test_licenses_need_their_words_in_order(docs):
    """Every 2-gram of a template stands there, on neighbouring diagonals, but pairwise swapped."""
    got = rows(licenses.digest(licenses.scan(docs(["under cc licensed under by nc cc by 4 0 nc 4", "licensed under by nc cc by nc 4 0"]))))
    assert [(r["labels"], round(r["score"], 2)) for r in sorted(got, key=lambda r: r["doc_id"])] == [("cc-by", 1.0), ("cc-by,cc-by-nc", 1.0)]
    assert min(s["share"] for r in rows(licenses.scan(docs(["licensed under by nc cc by nc 4 0"]))) for s in r["spans"]) == 5 / 6


def test_licenses_of_repeated_null_and_no_rows(docs):
    d = docs([(1, "mit license"), (1, "mit license"), (None, "cc by")]).withColumn("h", F.lit("x")).withColumn("template", F.lit(1))
    got = {r["doc_id"]: r["n_base"] for r in rows(licenses.digest(licenses.scan(d)))}
    assert got == {1: 1, None: 1}
    assert licenses.scan(docs([])).count() == 0


def brute_contamination(text, items, size=10):
    words, hit, ids = WORD.findall(lower(text)), set(), set()
    for item, t in items:
        iw = WORD.findall(lower(t))
        k = min(size, len(iw))
        for i in range(len(iw) - k + 1 if k else 0):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == iw[i : i + k]:
                    hit |= set(range(j, j + k))
                    ids.add(str(item))
    return len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


@pytest.fixture(scope="module")
def bench_items():
    rng = random.Random(1)
    v = [f"w{i}" for i in range(40)]
    return [(i, " ".join(rng.choices(v, k=rng.randint(0, 30)))) for i in range(12)] + [(99, "short one"), (100, None), (7, "")]


@pytest.mark.parametrize("max_bytes", [1 << 24, 200])
def test_decontamination_matches_brute_force(spark, docs, bench_items, max_bytes):
    rng = random.Random(2)
    v = [f"W{i}" for i in range(40)]
    texts = [*ODD]
    for _ in range(25):
        t = rng.choices(v, k=rng.randint(0, 60))
        src = (rng.choice(bench_items)[1] or "").split()
        at = rng.randint(0, len(t))
        texts.append(", ".join(t[:at] + src[rng.randint(0, 3) :] + t[at:]))
    b = spark.createDataFrame(bench_items, "item_id long, text string")
    got = {r["doc_id"]: tuple(r.values())[1:] for r in rows(decontaminate.digest(decontaminate.scan(docs(texts), b, max_bytes=max_bytes)))}
    assert got == {i: brute_contamination(t, bench_items) for i, t in enumerate(texts)}


def test_removal_cuts_spans_or_drops_documents(spark, docs):
    b = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    d = docs(["so Alpha, beta; gamma ends", "alpha beta", None]).withColumn("items", F.lit(3))
    cut = {r["doc_id"]: r for r in rows(decontaminate.remove(d, b))}
    assert cut[0]["text"] == "so  ends" and cut[0]["n_chars"] == 8 and cut[1]["text"] == "alpha beta" and cut[2]["text"] is None
    assert sorted(r["doc_id"] for r in rows(decontaminate.remove(d, b, "documents"))) == [1, 2]
    assert decontaminate.remove(docs([]), b).count() == 0
    assert decontaminate.scan(d, spark.createDataFrame([], "item_id long, text string")).where("n_hit > 0").count() == 0


def test_removal_of_many_groups_is_that_of_one(spark, docs):
    w = [f"w{i}" for i in range(54)]
    items = [(i, " ".join(w[4 * i : 4 * i + 14])) for i in range(11)] + [(50, "u0 u1 u2 u3"), (51, "u4 u5 u6 u7"), (52, "u2 u3 u8 u9")]
    texts = ["so " + ", ".join(w) + " ends", "a u0 u1 u2 u3 - u4 u5 u6 u7 b", "u2 u0 u1 u2 u3 u3 u8 u9", "nothing", "", None]
    b = spark.createDataFrame(items, "item_id long, text string")
    d = docs(texts)
    assert decontaminate.item_groups(b, 100)[0] > 3
    one, many = ({r["doc_id"]: (r["text"], r["n_chars"]) for r in rows(decontaminate.remove(d, b, max_bytes=m))} for m in (1 << 24, 100))
    assert many == one and many[0] == ("so  ends", 8) and many[1][0] == "a  b" and many[2][0] == "u2  u3 u8 u9"
    assert decontaminate.remove(d, b, max_bytes=100).columns == d.columns
    assert {r["doc_id"] for r in rows(decontaminate.remove(d, b, "documents", max_bytes=100))} == {3, 4, 5}


def _language_docs(docs, n=240):
    rng = random.Random(3)
    stems = {"aa": ["the", "ther", "ing", "ow"], "bb": ["ñas", "ción", "jo", "el"], "cc": ["schü", "der", "zu", "ung"]}
    made = [(i, " ".join("".join(rng.choices(stems[k], k=2)) for _ in range(rng.randint(3, 40))), k) for i in range(n) for k in [rng.choice(sorted(stems))]]
    return made, docs([(i, t) for i, t, _ in made]).drop("lang").join(docs([]).sparkSession.createDataFrame([(i, k) for i, _, k in made], "doc_id long, lang string"), "doc_id")


def test_language_of_unseen_documents(docs):
    made, d = _language_docs(docs)
    model = langid.fit(d.where("doc_id % 5 != 0"))
    got = {r["doc_id"]: r for r in rows(langid.predict(d, model))}
    held = [(got[i]["lang_pred"], k) for i, _, k in made if i % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    odd = rows(langid.predict(docs(ODD + ["123 !!", "²³"]), model))
    assert [r["lang_pred"] == "und" for r in odd] == [True, True, True, False, False, False, False, False, False, True, True]
    assert all(0 <= r["score"] <= 1 for r in odd)
    kept = langid.select_known(docs(["", "der ther", None]).withColumn("score", F.lit("x")), model)
    assert [r["doc_id"] for r in rows(kept)] == [1] and "score" in kept.columns


def test_language_without_labels_or_rows(docs):
    model = langid.fit(docs(["a b"]).withColumn("lang", F.lit(None).cast("string")))
    assert rows(langid.predict(docs(["a b"]), model))[0]["lang_pred"] == "und"
    assert langid.predict(docs([]), model).count() == 0


def test_the_driver_holds_language_features_once():
    rng = np.random.default_rng(5)
    raw = np.sqrt(rng.dirichlet(np.full(langid.DIMS, 0.01), 400)).astype(np.float16)
    langs = ["aa", "bb", "cc"]
    got = [SimpleNamespace(lang=langs[i % 3], x=bytearray(raw[i].tobytes())) for i in range(len(raw))]
    ordered = sorted(range(len(raw)), key=lambda i: (langs[i % 3], raw[i].tobytes()))
    size = raw.nbytes * 2
    tracemalloc.start()
    x, y = langid._gathered(got, langs)
    assert np.array_equal(x, raw[ordered].astype(np.float32)) and y.tolist() == [i % 3 for i in ordered] and not got
    plain = x.copy()
    tracemalloc.reset_peak()
    before = tracemalloc.get_traced_memory()[0]
    model = langid.Model(langs, x, y)
    most = tracemalloc.get_traced_memory()[1] - before
    tracemalloc.stop()
    assert most < 2 * size  # four times with the rows of the product as doubles
    plain -= model.mean
    w = np.sqrt(1 / np.bincount(y)[y])[:, None].astype(np.float32)
    weighed = plain * w
    k = (weighed @ weighed.T).astype(float)
    k[np.diag_indices_from(k)] += 0.01 * np.trace(k) / len(k) + 1e-9
    assert np.allclose(model.weights, weighed.T @ np.linalg.solve(k, model.code[y] * w), rtol=1e-5, atol=1e-7)


def test_codewords_differ_for_any_number_of_languages():
    for n in range(2, 30):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code}) == n


def test_fingerprints_merge_and_estimate():
    rng = random.Random(4)
    words = [f"t{i}" for i in range(5000)]
    a = words[:3000]
    b = words[1000:4000]
    sa, sb = (fingerprints.Sketch.of(" ".join(x)) for x in (a, b))
    assert abs(sa.resemblance(sb) - 0.5) < 0.15
    assert abs(sa.containment(sb) - 0.667) < 0.2
    assert abs(sa.distinct() / 2996 - 1) < 0.3
    parts = [" ".join(a[i : i + 504]) for i in range(0, 3000, 500)]
    merged = fingerprints.Sketch.of(parts[0])
    for p in parts[1:]:
        merged = merged.merge(fingerprints.Sketch.of(p))
    assert merged.hex() == sa.hex()
    assert fingerprints.Sketch.parse(sa.hex()).hex() == sa.hex()
    assert fingerprints.Sketch.of("").resemblance(fingerprints.Sketch.of(None)) == 1 and fingerprints.Sketch.of("a").resemblance(fingerprints.Sketch.of("")) == 0
    assert rng


def brute_next(pairs):
    order = sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    out = []
    for i, (d, t) in enumerate(order):
        t, n = t or "", order[(i + 1) % len(order)][1] or ""
        cut = len(t) // 4
        e = t[: len(t) - cut] + n[:cut]
        s, c, m = (fingerprints.Sketch.of(x) for x in (t, e, n))
        out.append((d, len(t), hashlib.sha256(e.encode()).hexdigest(), s.hex(), c.hex(), s.resemblance(c), s.resemblance(m)))
    return out


@pytest.mark.parametrize("n", [1, 2, 57])
def test_fingerprints_against_the_next_document(docs, n):
    rng = random.Random(n)
    ids = rng.sample(range(-1000, 10**6), n)
    pairs = [(i, None if rng.random() < 0.1 else " ".join(rng.choices(["ü", "be", "cee", "dé", "f"], k=rng.randint(0, 60)))) for i in ids]
    pairs += [(None, "no id"), pairs[0], (ids[0], "another text of that id")] * (n > 2)
    got = [tuple(r.values()) for r in rows(fingerprints.compare_with_next(docs(pairs).repartition(3)))]
    key = lambda x: tuple(map(str, x))
    assert sorted(got, key=key) == sorted(brute_next(pairs), key=key)


def test_fingerprints_of_no_rows(docs):
    assert fingerprints.compare_with_next(docs([])).count() == 0
    assert fingerprints.fingerprint(docs(["a b c d e f", None])).count() == 2


def test_languages_beside_any_columns(spark, docs):
    """Columns named as the operator's own don't disturb; an id of many rows teaches one text a language; rare languages are learned, too."""
    texts = [(i % 4, f"der die das und {i}" if i % 2 else f"the and of to {i}") for i in range(80)] + [(100 + i, f"mot{i} le la les") for i in range(3)]
    d = docs(texts).withColumn("lang", F.when(F.col("doc_id") >= 100, "fr").when(F.col("doc_id") % 2 == 1, "de").otherwise("en"))
    for c in ("id", "as_lang", "rank", "x"):
        d = d.withColumn(c, F.lit(1))
    model = langid.fit(d, max_rows=6)
    assert model.langs == ["de", "en", "fr"]
    got = {r["doc_id"]: r["lang_pred"] for r in rows(langid.predict(d, model))}
    assert got[0] == "en" and got[1] == "de" and got[101] == "fr"
    kept = langid.select_known(d, model)
    assert kept.columns == d.columns and kept.count() == 83


def test_licenses_of_rows_that_share_an_id(docs):
    """Every row has its row, with its own words and places."""
    pairs = [(1, "mit license"), (1, "mit license"), (1, "x apache license y"), (1, None), (None, "cc by"), (None, "cc by"), (None, "")]
    got = rows(licenses.digest(licenses.scan(docs(pairs).withColumn("row", F.lit("r")).repartition(3))))
    want = [(1, 2, 1, 0, "mit"), (1, 2, 1, 0, "mit"), (1, 4, 1, 1, "apache"), (1, 0, 0, None, ""), (None, 2, 1, 0, "cc-by"), (None, 2, 1, 0, "cc-by"), (None, 0, 0, None, "")]
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["base_labels"]) for r in got), key=str) == sorted(want, key=str)
