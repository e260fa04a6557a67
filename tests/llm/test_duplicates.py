"""Jaccard join and suffix dedup against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from locusweave.llm import jaccard_join, suffix_dedup

from .conftest import rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(pairs):
    sets = [shingles(t) for _, t in pairs]
    parent = list(range(len(pairs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[top(i)] = top(j)
    names = defaultdict(list)
    for i, (d, _) in enumerate(pairs):
        names[top(i)].append(d)
    low = {k: min((x for x in v if x is not None), default=None) for k, v in names.items()}
    return [(d, len(s), low[top(i)] if len(names[top(i)]) > 1 else d) for i, ((d, _), s) in enumerate(zip(pairs, sets, strict=True))]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def near_copies():
    rng = random.Random(6)
    vocab = [f"w{i}" for i in range(3000)]
    texts = ["", None, " \t", "one two", "One  TWO", "one two three", "a b c d e", "a b c d e f"]
    passage = rng.choices(vocab, k=60)
    for size in (6, 12, 40, 130, 400, 900):
        for _ in range(5):
            base = rng.choices(vocab, k=size)
            texts += [" ".join(edited(rng, base, k)) for k in (0, 0, 1, max(1, size // 40), max(1, size // 25), max(1, size // 12))]
            texts.append(" ".join(base[: size * 4 // 5]))
    texts += [" ".join(rng.choices(vocab, k=40) + passage + rng.choices(vocab, k=30)) for _ in range(60)]
    many = rng.choices(vocab, k=150)
    texts += [" ".join(edited(rng, many, rng.randrange(6))) for _ in range(80)]
    return list(enumerate(texts)) + [(None, "one two"), (5000, texts[20]), (5000, texts[20])]


def test_components_match_brute_force(docs, near_copies):
    d = docs(near_copies).withColumn("node", F.lit(1)).withColumn("comp", F.lit("c")).repartition(3)
    key = lambda r: tuple(map(str, r))
    got = sorted((tuple(r.values()) for r in rows(jaccard_join.linked(d))), key=key)
    assert got == sorted(brute_components(near_copies), key=key)


def test_one_of_each_component_stays(docs, near_copies):
    kept = rows(jaccard_join.keep_one(docs(near_copies)))
    found = brute_components(near_copies)
    want = sorted({d for d, _, c in found if d is not None and c == d})
    assert sorted({r["doc_id"] for r in kept if r["doc_id"] is not None}) == want
    empty = sum(n == 0 for _, n, _ in found)
    assert sum(not (r["text"] or "").strip() for r in kept) == empty
    assert jaccard_join.keep_one(docs([])).count() == 0 and jaccard_join.linked(docs([])).count() == 0


def test_rows_that_share_an_id_are_decided_by_their_texts(docs):
    """One is a near copy of others and goes; the others stay, whatever their ids."""
    r = random.Random(6)
    text = lambda n: " ".join("".join(r.choices("abcdefgh", k=6)) for _ in range(n))
    x, y, z, near = text(60), text(60), text(60), text(60)
    pairs = [(5, x), (5, y), (4, y + " end"), (7, y), (7, z), (7, z), (8, ""), (8, ""), (8, None), (None, z), (None, near), (None, near + " end"), (None, text(20)), (9, near)]
    d = docs(pairs).withColumn("node", F.lit(1)).withColumn("state", F.lit("s")).withColumn("_id", F.lit(2)).repartition(3)
    got = jaccard_join.keep_one(d)
    assert got.columns == d.columns
    want = [(5, x), (4, y + " end"), (7, z), (8, ""), (8, ""), (8, None), (None, pairs[12][1]), (9, near)]
    assert sorted(((r["doc_id"], r["text"]) for r in rows(got)), key=str) == sorted(want, key=str)
    only = jaccard_join.keep_one(docs([(None, near), (None, near + " end"), (None, near)]))
    assert len(rows(only)) == 1


def test_salted_names_are_not_broadcast(docs, monkeypatch):
    d = docs([(1, "a b c d e f"), (2, "a b c d e f"), (3, "g h i j k l")])
    seen, names = [], jaccard_join._names
    monkeypatch.setattr(jaccard_join, "_names", lambda x, *more: (seen.append(x.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")), names(x, *more))[1])
    out = jaccard_join.linked(d)
    assert out.count() == 3 and "BroadcastExchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert seen == [jaccard_join.BROADCAST] != [d.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")]


def test_bands_hold_every_linked_pair():
    for a in range(1, 3000, 7):
        for b in {a, a + 1, 100 * a // 75}:
            shared = {x[0] for x in jaccard_join.bands(a)} & {x[0] for x in jaccard_join.bands(b)}
            most = (a + b) // 7
            assert any(x[2] >= most and y[2] >= most for x in jaccard_join.bands(a) for y in jaccard_join.bands(b) if x[0] == y[0] in shared)


def test_sets_with_too_few_pieces_meet_by_shingles(docs):
    """The sizes of such sets come back, and single shingles then find every pair of these sizes."""
    band, pieces, most = jaccard_join.bands(17)[0]
    h = np.random.default_rng(3).integers(0, 2**63, 5000, dtype=np.uint64)
    cell = jaccard_join.tb.mix64(h + np.uint64((0x9E3779B97F4A7C15 * (2 * band + 1)) % 2**64)) % np.uint64(pieces)
    thin = h[cell < most][:17]
    assert jaccard_join.join_keys(thin, np.zeros(17, np.uint8))[1] and not jaccard_join.join_keys(h[:17], np.zeros(17, np.uint8))[1]
    assert len(jaccard_join.join_keys(thin, np.zeros(17, np.uint8), plain=True)[0]) == sum(m + 1 for _, _, m in jaccard_join.bands(17))
    r = random.Random(5)
    base = [f"w{i}" for i in range(24)]
    texts = [" ".join(base), " ".join([*base[:-1], "x"]), " ".join(r.choices(base, k=24)), " ".join(base[:8])]
    groups = jaccard_join.candidate_groups(docs(texts), np.zeros(1 << jaccard_join.HOT_BITS, np.uint8), plain=(12, 30))
    assert groups.where("node is not null").select("node").distinct().count() == 2


def test_parity_sketches_bound_the_difference():
    rng = np.random.default_rng(8)
    for _ in range(50):
        x = rng.integers(0, 2**63, 300).astype(np.uint64)
        y = np.concatenate([x[rng.integers(0, 60) :], rng.integers(0, 2**63, rng.integers(0, 60)).astype(np.uint64)])
        far = int(np.bitwise_count((jaccard_join.parity(np.unique(x)) ^ jaccard_join.parity(np.unique(y))).view(np.uint64)).sum())
        assert far <= len(np.setxor1d(x, y))
        whole = jaccard_join.parity(np.unique(x), 16)
        assert (whole[:8] ^ whole[8:] == jaccard_join.parity(np.unique(x))).all()


def test_deep_shallow_sort():
    rng = random.Random(9)
    for alphabet in (b"ab", b"a", bytes(range(256))):
        strings = list({bytes(rng.choices(alphabet, k=rng.randrange(80))) for _ in range(200)} | {b"a" * 40 + bytes(rng.choices(b"ab", k=9)) for _ in range(50)})
        order, lcp = suffix_dedup.deep_shallow_sort(strings, 8)
        assert [strings[i] for i in order] == sorted(strings)
        assert lcp[1:] == [suffix_dedup.common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]


def brute_repeats(pairs, length):
    docs = list(dict.fromkeys(pairs))
    seen = defaultdict(list)
    raws = [(t or "").encode() for _, t in docs]
    for d, raw in enumerate(raws):
        for i in range(len(raw) - length + 1):
            seen[raw[i : i + length]].append((d, i))
    cover = [bytearray(len(r)) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                cover[d][i : i + length] = b"\1" * length
    out = {}
    for k, raw, c in zip(docs, raws, cover, strict=True):
        runs = len([x for x in bytes(c).split(b"\0") if x])
        out[k] = (k[0], len(raw), sum(c), runs, hashlib.sha256(bytes(b for b, x in zip(raw, c, strict=True) if not x)).hexdigest())
    return sorted((out[p] for p in pairs), key=str)


def test_repeats_match_brute_force(docs):
    rng = random.Random(10)
    word = lambda: "".join(rng.choices("abcdefghü ", k=rng.randrange(2, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage, short = text(300), text(70), text(20)
    texts = [None, "", "x" * 399, "x" * 400, "y" * 1500, base, base, base[:700], base[300:], base[500:900] + "Z" + base[100:600], passage + text(9) + passage, "tail" + base[-450:]]
    for _ in range(25):
        cut = rng.randrange(200)
        texts.append(text(rng.randrange(60)) + passage[cut : cut + rng.randrange(380, 460)] + text(rng.randrange(60)))
        texts.append(text(rng.randrange(60)) + passage + text(rng.randrange(20)) + short)
    pairs = list(enumerate(texts)) + [(700, base), (700, base), (701, "only twice as a row" * 40), (701, "only twice as a row" * 40), (None, passage)]
    got = sorted((tuple(r.values())[:5] for r in rows(suffix_dedup.digest(suffix_dedup.dedup(docs(pairs).withColumn("uid", F.lit(1)).repartition(3))))), key=str)
    assert got == brute_repeats(pairs, 400)
    assert suffix_dedup.dedup(docs([])).count() == 0


def test_windows_of_large_groups(docs, monkeypatch):
    """Exercises the path for groups that would outgrow a task."""
    monkeypatch.setattr(suffix_dedup, "MAX_GROUP", 2)
    rng = random.Random(11)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))
    passage = text(120)
    pairs = [(i, text(30) + passage[rng.randrange(40) : 560 + rng.randrange(60)] + text(30)) for i in range(12)]
    live = suffix_dedup._live
    rows_ = []
    import pyarrow as pa

    table = pa.RecordBatch.from_arrays([pa.array([1, 1, 1, 1, 2, 3, 3]), pa.array([b"u"] * 7), *[pa.array(range(7))] * 3, pa.array([0] * 7, pa.int32())], names=["key", "uid", "at", "first", "last", "kind"])
    for b in live([table.slice(0, 2), table.slice(2, 3), table.slice(5)]):
        rows_ += list(zip(b.column("key").to_pylist(), b.column("kind").to_pylist(), strict=True))
    assert sorted(rows_) == [(1, suffix_dedup.WINDOW)] * 4 + [(3, suffix_dedup.REGION)] * 2
    import pandas as pd

    spark = docs([]).sparkSession
    d = spark.createDataFrame(pd.DataFrame({"uid": [i.to_bytes(16, "big") for i, _ in pairs], "text": [t for _, t in pairs]}))
    found = [(r.key, r.uid, r.at, r.first, r.last, suffix_dedup.WINDOW) for r in suffix_dedup._scan(d, 400).collect()]
    f = spark.createDataFrame(found, suffix_dedup.ANCHORS).groupBy("uid").agg(F.collect_list(F.struct("key", "at", "first", "last", "kind")).alias("found"))
    ranges = d.join(f, "uid").mapInArrow(suffix_dedup._contexts(400), suffix_dedup.CONTEXTS).coalesce(1).sortWithinPartitions("kind", "key", "at", "uid", "first").mapInArrow(suffix_dedup._decide(400), suffix_dedup.RANGES)
    got = defaultdict(set)
    for r in ranges.collect():
        for s in range(r.first, r.last + 1):
            got[int.from_bytes(r.uid, "big")] |= set(range(s, s + 400))
    assert sorted((i, len(t), len(got[i])) for i, t in pairs) == [x[:3] for x in sorted(brute_repeats(pairs, 400))]


def test_a_text_longer_than_a_piece(docs):
    """Repeats are found across the borders of the pieces in which a long text is scanned."""
    rng = random.Random(12)
    long = "".join(rng.choices("abcdefghijklmnop", k=2_300_000))
    border = 1 << 20
    pairs = [(0, long), (1, "x" + long[border - 300 : border + 300]), (2, long[-500:]), (3, long[:401])]
    got = {r["doc_id"]: r for r in rows(suffix_dedup.digest(suffix_dedup.dedup(docs(pairs))).drop("text"))}
    assert [(got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) for i in range(4)] == [(2_300_000, 600 + 500 + 401, 3), (601, 600, 1), (500, 500, 1), (401, 401, 1)]
    assert [got[i]["has_repeats"] for i in range(4)] == [True] * 4


def test_a_cut_within_a_character(docs):
    """Two texts that share 400 bytes from the middle of a character on: what is left is no UTF-8; its text has whole characters only."""
    tail = "b" * 399  # both characters before it end in the same byte
    got = {r["doc_id"]: r for r in rows(suffix_dedup.digest(suffix_dedup.dedup(docs([(1, "\u00fc" + tail), (2, "\u0100\u017c" + tail)]))))}
    assert [(got[i]["n_removed"], got[i]["has_repeats"], got[i]["text"]) for i in (1, 2)] == [(400, True, ""), (400, True, "\u0100")]
