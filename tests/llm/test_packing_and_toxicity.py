"""Packing and toxicity."""

import math
import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations_with_replacement

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from locusweave.llm import packing, tokens, toxicity

from .conftest import rows


def check_patterns(counts, patterns, capacity):
    used = Counter()
    for lens, times in patterns:
        assert sum(lens) <= capacity and times > 0
        for x in lens:
            used[x] += times
    assert used == Counter({k: v for k, v in counts.items() if v})
    return sum(t for _, t in patterns)


def fewest_bins(items, capacity):
    """By search over all packings of a few items."""
    best = len(items)
    items = sorted(items, reverse=True)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for room in {b for b in bins if b >= items[i]}:
            k = bins.index(room)
            go(i + 1, bins[:k] + [room - items[i]] + bins[k + 1 :])
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best


def test_packing_uses_every_item_once_and_few_bins():
    rng = random.Random(12)
    for _ in range(150):
        capacity = rng.choice([7, 10, 20])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        counts = Counter(items)
        bins = check_patterns(counts, packing.pack_histogram(counts, capacity), capacity)
        assert bins <= fewest_bins(items, capacity) + 1
    for _ in range(20):
        counts = Counter(rng.randint(1, 2048) for _ in range(5000)) + Counter({rng.randint(1, 2048): 10**7})
        bins = check_patterns(counts, packing.pack_histogram(counts), 2048)
        assert bins <= 1.02 * sum(k * v for k, v in counts.items()) / 2048 + max(v for v in counts.values())


def test_dominance_never_costs_a_bin():
    rng = random.Random(13)
    for _ in range(150):
        capacity = rng.choice([8, 12, 15])
        items = [rng.randint(capacity // 5, capacity) for _ in range(rng.randint(1, 8))]
        left = Counter(items)
        fixed = packing.reduce_dominant(left, capacity)
        rest = [x for x, n in left.items() for _ in range(n)]
        assert sum(t for _, t in fixed) + fewest_bins(rest, capacity) == fewest_bins(items, capacity)


#: Strings of special tokens are ordinary text, as the tokenizers' description loads them.
TEXTS = ["", None, "a", "It's we'll they've I'D 'tis  ''s don't\n\n \t x", "  lead and trail  ", "ünï côdé 漢字 ١٢٣ ²³ á   z", "x" * 3000, "num 123abc 4,5.6!?", "\n", " \n a", "tab\t tab", "emoji 😀😀 ok", "'re 're're", "a'", "end '", "<|endoftext|> kept"]


def test_token_ids_are_the_tokenizers():
    path = packing.default_tokenizer()
    ref = Tokenizer.from_file(path)
    ref.encode_special_tokens = True
    rng = random.Random(14)
    pieces = ["'", "s", "ll", " ", "  ", "\n", "é", "1", ".", "the", " ", "'re", "漢"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choices(pieces, k=rng.randint(0, 30))) for _ in range(800)]
    ids, counts = tokens.ByteBpe(path).encode(texts)
    ends = np.cumsum(counts)
    for t, e, n in zip(texts, ends, counts, strict=True):
        assert ids[e - n : e].tolist() == ref.encode(t, add_special_tokens=False).ids, t


def test_pieces_fill_sequences_without_gaps(docs):
    path, capacity = packing.default_tokenizer(), 64
    ref = Tokenizer.from_file(path)
    ref.encode_special_tokens = True
    rng = random.Random(15)
    texts = TEXTS + [" ".join(rng.choices(["alpha", "beta", "gamma,", "delta."], k=rng.randint(0, 150))) for _ in range(120)]
    pairs = [*enumerate(texts), (3, TEXTS[3]), (None, "no id")]
    got = rows(packing.pack(docs(pairs).withColumn("offset", F.lit(1)), path, capacity, with_ids=True))
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
    for d, t in pairs:
        want = [*ref.encode(t or "", add_special_tokens=False).ids, 0]
        mine = sorted(by_doc[d], key=lambda r: (r["piece"], r["sequence_id"]))
        times = sum(x == d for x, _ in pairs)
        mine = mine[::times] if times > 1 else mine
        assert [x for r in mine for x in np.frombuffer(r["ids"], "<u4").tolist()] == want
        assert [r["piece"] for r in mine] == list(range(len(mine))) and all(r["length"] == capacity for r in mine[1:])
        assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and r["length"] * 4 == len(r["ids"]) for r in mine)
        assert [r["start"] for r in mine] == [sum(r["length"] for r in mine[:i]) for i in range(len(mine))]
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    assert packing.pack(docs([]), path).count() == 0


def test_block_max_search_is_exact():
    rng = random.Random(16)
    vectors = [toxicity.unit({t: rng.randint(1, 4) for t in rng.sample(range(30), rng.randint(1, 6))}, np.ones(30)) for _ in range(300)]
    index = toxicity.BlockMax(vectors, 30)
    for _ in range(60):
        q = toxicity.unit({t: rng.randint(1, 4) for t in rng.sample(range(30), rng.randint(1, 5))}, np.ones(30))
        scores = [(round(sum(w * v.get(t, 0) for t, w in q.items()), 9), -i) for i, v in enumerate(vectors)]
        want = [s for s in sorted(scores, reverse=True)[:10] if s[0] > 0]
        got = index.search(q, 10)
        assert [round(s, 9) for s, _ in got] == [s for s, _ in want]


def test_isotonic_fit():
    knots, values = toxicity.monotone(np.array([0.1, 0.2, 0.3, 0.3, 0.9]), np.array([0, 1, 0, 1, 1.0]), np.ones(5))
    assert (np.diff(values) >= 0).all() and (np.diff(knots) >= 0).all() and values[0] == 0 and values[-1] == 1


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(17)
    out = []
    for i in range(600):
        words, toxic = rng.choices([f"w{k}" for k in range(200)], k=40), rng.random() < 0.15
        for k in range(3 * toxic):
            words[k] = rng.choice(["idiot", "Scum", "lösér", "trash"])
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_toxic_documents_are_found(spark, docs, labelled):
    d = docs([(i, t) for i, t, _ in labelled])
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled], "doc_id long, toxic int")
    model = toxicity.fit(d, labels.where("doc_id % 5 != 0"))
    got = {r["doc_id"]: r for r in rows(toxicity.score(d, model))}
    held = [(got[i]["score"] >= 0.5, bool(y)) for i, _, y in labelled if i % 5 == 0]
    assert sum(a == b for a, b in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    worst = max(got.values(), key=lambda r: r["score"])
    assert worst["evidence"] and all(e["cosine"] > 0 for e in worst["evidence"])
    odd = {r["doc_id"]: r["score"] for r in rows(toxicity.score(docs(["", None, "you idiot trash scum " * 2000]), model))}
    assert odd[0] < 0.2 and odd[1] < 0.2 and odd[2] > 0.8


def test_every_text_is_searched_by_its_whole_vector(spark, docs, labelled):
    plain = {i: Counter(t.lower().split()) for i, t, _ in labelled}
    rare = next(i for i, _, y in labelled if y and i % 5)
    texts = [(i, t if i != rare else "quite other words of no list") for i, t, _ in labelled]
    plain[rare] = Counter(dict(texts)[rare].split())
    d = docs(texts)
    model = toxicity.fit(d, spark.createDataFrame([(i, y) for i, _, y in labelled], "doc_id long, toxic int").where("doc_id % 5 != 0"))
    df = Counter(w for c in plain.values() for w in c)
    known = {w for i, c in plain.items() if i % 5 for w in c}
    idf = {w: math.log((1 + len(plain)) / (1 + df[w])) + 1 for w in df}
    assert known == set(df)

    def vector(c):
        v = {w: (1 + math.log(n)) * idf[w] for w, n in c.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    vectors = {i: vector(c) for i, c in plain.items()}
    got = {r["doc_id"]: r["evidence"] for r in rows(toxicity.score(d, model))}
    for i in [rare, *range(0, 60, 5)]:
        cosines = sorted((sum(x * v.get(w, 0) for w, x in vectors[i].items()) for j, v in vectors.items() if j % 5), reverse=True)[: toxicity.K]
        assert [round(e["cosine"], 9) for e in got[i]] == [round(x, 9) for x in cosines if x > 0]
    assert got[rare] == [{"doc_id": rare, "cosine": 1.0, "toxic": 1}]


def test_unknown_words_lengthen_a_text(spark, docs):
    """A text of an example's words and 1,000 others is no copy of the example; its unknown words have their own document frequencies."""
    d = docs([(1, "bad insult"), (2, "kind words"), (3, "bad insult " + " ".join(f"u{i}" for i in range(1000))), (4, "bad insult " + " ".join(f"u{i}" for i in range(1000)) + " u0"), (5, "nothing known")])
    model = toxicity.fit(d, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r["evidence"] for r in rows(toxicity.score(d, model))}
    idf = lambda n: math.log(6 / (1 + n)) + 1
    known, unknown = 2 * idf(3) ** 2, 1000 * idf(2) ** 2
    assert abs(got[1][0]["cosine"] - 1) < 1e-9 and got[5] == []
    assert abs(got[3][0]["cosine"] - math.sqrt(known / (known + unknown))) < 0.02 and got[3][0]["cosine"] < 0.1


def test_clashing_columns_and_repeated_ids(spark, docs):
    d = docs([(1, f"bad {i}") for i in range(300)] + [(2, "kind")])
    for c in ("_id", "_toxic", "id", "sample_id", "label", "toxic"):
        d = d.withColumn(c, F.lit(1))
    model = toxicity.fit(d, spark.createDataFrame([(1, 1), (1, 1), (2, 0)], "doc_id long, toxic int"), max_rows=4)
    assert model.ids == [1, 2] and toxicity.score(d, model).count() == 301


def test_toxicity_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs(["a b"]), none)
    assert rows(toxicity.score(docs(["a b"]), model))[0]["score"] == 0
    assert toxicity.score(docs([]), model).count() == 0
