"""Whole results of operators without SQL against plain versions that share no code with them."""

import hashlib
import math
import random
import zlib
from collections import Counter
from itertools import product

import numpy as np

from locusweave.llm import fingerprints, langid, queries

from .conftest import DOCS, rows

ALL = 2**64 - 1
GOLD = 0x9E3779B97F4A7C15


def mix(x):
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> shift)) * times & ALL
    return x


def stream(i, seed):
    return mix((i + 1 + seed) * GOLD & ALL)


def word_hash(word):
    """Bytes of A-Z lower-cased, each a random value times the odd multiplier of its place."""
    low = [b + 32 if 65 <= b <= 90 else b for b in word]
    return mix((sum(stream(b, 11) * (stream(i, 77) | 1) for i, b in enumerate(low)) + len(low) * 0xD6E8FEB86659FD93) & ALL)


def shingles(text, k=5):
    h = [word_hash(w) for w in text.encode().split()]
    if not h:
        return set()
    n = min(k, len(h))
    out = set()
    for i in range(len(h) - n + 1):
        x = h[i]
        for y in h[i + 1 : i + n]:
            x = (x * GOLD + y) & ALL
        out.add(mix(x) ^ (n if n < k else 0))
    return out


def likeness(a, b, k=128):
    """Of the k smallest of both sets' k smallest, the share that both have; exact for small sets."""
    x, y = sorted(a)[:k], sorted(b)[:k]
    union = sorted({*x, *y})
    if len(a) > k or len(b) > k:
        union = union[:k]
    return len({*x} & {*y} & {*union}) / len(union) if union else 1.0


def printed(s, k=128):
    return ("w" if len(s) <= k else "k") + "".join(f"{x:016x}" for x in sorted(s)[:k])


def test_op9_against_plain_sketches(spark, tmp_path):
    rng = random.Random(51)
    text = lambda n: " ".join("".join(rng.choices("abCDéx", k=rng.randrange(1, 9))) for _ in range(n))
    base = text(300)
    texts = [None, "", " \t\n ", "one two", "a b c d e", base, base, base[:900] + text(40), text(1000), "漢字 " * 50, "\x1c\x1d x", text(200)]
    pairs = list(enumerate(texts)) + [(100, text(60)), (100, None), (None, text(30))]
    spark.createDataFrame([(i, t, "en", "s", 0) for i, t in pairs], DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = rows(queries.op9_fingerprints(spark, str(tmp_path)))
    order = sorted(((i, t or "") for i, t in pairs), key=lambda p: (p[0] is not None, p[0] or 0, p[1].encode()))
    want = []
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        cut = len(t) // 4
        edited = t[: len(t) - cut] + n[:cut]
        a, e, b = shingles(t), shingles(edited), shingles(n)
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(e), likeness(a, e), likeness(a, b)))
    assert sorted((tuple(r.values()) for r in got), key=str) == sorted(want, key=str)
    assert fingerprints.K == 128


def grams(text):
    """Square roots of the shares of 4,096 hashed byte pairs and triples, of length 1."""
    b = [x + 32 if 65 <= x <= 90 else x for x in text.encode()]
    seen = Counter()
    for i in range(len(b) - 1):
        pair = (b[i] * 0x01000193 + b[i + 1] * 0x9E3779B1) % 2**32
        seen[pair >> 20] += 1
        if i + 2 < len(b):
            seen[(pair * 0x85EBCA6B + b[i + 2] * 0xC2B2AE35) % 2**32 >> 20] += 1
    x = np.zeros(4096)
    for k, n in seen.items():
        x[k] = math.sqrt(n / sum(seen.values()))
    return x


def plain_languages(train, texts):
    """Ridge classifiers of all splits of a few languages, in the features themselves, and the nearest codeword."""
    langs = sorted({y for _, y in train})
    code = np.array([c for c in product((1, -1), repeat=len(langs)) if c[0] == 1 and -1 in c]).T
    x = np.array([grams(t).astype(np.float16).astype(float) for t, _ in train])
    y = np.array([langs.index(y) for _, y in train])
    mean = x.mean(0)
    w = 1 / np.sqrt(np.bincount(y))[y]
    xw = (x - mean) * w[:, None]
    weights = np.linalg.solve(xw.T @ xw + (0.01 * (xw**2).sum() / len(xw) + 1e-9) * np.eye(4096), xw.T @ (code[y] * w[:, None]))
    good = np.maximum(0.05, (np.sign((x - mean) @ weights) == code[y]).mean(0) - 0.5)
    good /= good.sum()
    out = []
    for t in texts:
        if not any(c.isalpha() for c in t or ""):
            out.append(("und", 0.0))
            continue
        margin = (grams(t) - mean) @ weights
        loss = [sum(g * max(0, 1 - m * c) for g, m, c in zip(good, margin, row, strict=True)) for row in code]
        p = np.exp(-4 * (np.array(loss) - min(loss)))
        out.append((langs[int(np.argmin(loss))], float(p.max() / p.sum())))
    return out


def test_op8_against_a_plain_fit(spark, tmp_path):
    rng = random.Random(52)
    kinds = {"aa": ["the", "ing", "of", "and"], "bb": ["der", "ung", "ßch", "und"], "cc": ["que", "ión", "los", "ñar"], "dd": ["les", "eau", "ent", "çue"]}
    pairs = [(i, " ".join("".join(rng.choices(kinds[y], k=2)) for _ in range(rng.randrange(3, 40))), y) for i, y in enumerate(rng.choices(list(kinds), k=240))]
    pairs += [(300, None, "aa"), (301, "", "aa"), (302, "12 34 !", "bb"), (303, "the les und", None)]
    spark.createDataFrame([(i, t, y, "s", 0) for i, t, y in pairs], DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in rows(queries.op8_language_id(spark, str(tmp_path)))}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in pairs}
    want = plain_languages([(t, y) for i, t, y in pairs if t is not None and y and not held[i]], [t for _, t, _ in pairs])
    assert all(got[i]["held_out"] == held[i] for i in got)
    assert [got[i]["lang_pred"] for i, *_ in pairs] == [lang for lang, _ in want]
    assert max(abs(got[i]["score"] - p) for (i, *_), (_, p) in zip(pairs, want, strict=True)) < 2e-3
    assert langid.DIMS == 4096
