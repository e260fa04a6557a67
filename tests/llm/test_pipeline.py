"""The corpus pipeline against a plain version of its stages."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from locusweave.llm import langid, line_dedup, packing
from locusweave.llm.runtime import held_out

from .conftest import DOCS, rows
from .test_duplicates import brute_components
from .test_lines_and_warc import brute_lines
from .test_text_operators import WORD, lower


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder with documents and benchmark: sites with menus, copies, leaks, texts without letters."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choices(["the", "ing", "ou", "er", "an"], k=2))
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(14)) for i in range(4)] + [(9, "zz yy xx"), (10, None)]
    docs = []
    for i in range(90):
        lines = ["home | about"] * (i % 3 != 0) + [text(rng.randint(5, 40)) for _ in range(rng.randint(1, 4))]
        if i % 9 == 0:
            lines.append(f"{text(4)} {items[i % 4][1]} {text(3)}")
        docs.append([i, "\n".join(lines), "en", f"site{i % 3}"])
    for i in range(90, 100):
        docs.append([i, docs[i - 60][1], "en", docs[i - 60][3]])
    docs += [[100, None, None, "site0"], [101, "", "en", None], [102, "123 456", "en", "site1"], [103, "x zz yy xx y", "en", None], [None, "no id at all here", "en", "site1"]]
    root = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(*d, None if d[1] is None else len(d[1])) for d in docs], DOCS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root), items


def without_leaks(text, items, size=10):
    places = [m.span() for m in WORD.finditer(lower(text))]
    words = [lower(text)[a:b] for a, b in places]
    hit = set()
    for _, t in items:
        w = WORD.findall(lower(t))
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if k else 0):
            for j in range(len(words) - k + 1):
                if words[j : j + k] == w[i : i + k]:
                    hit |= set(range(j, j + k))
    out, at = "", 0
    runs = [j for j in sorted(hit) if j - 1 not in hit]
    for j in runs:
        e = j
        while e + 1 in hit:
            e += 1
        out += text[at : places[j][0]]
        at = places[e][1]
    return out + text[at:]


def test_each_stage_does_its_work(spark, corpus):
    sf, items = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plain = [r.asDict() for r in docs.collect()]
    state = docs
    stages = dict(corpus_pipeline.STAGES)
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)

    def step(name):
        nonlocal state
        state = stages[name](spark, state, sf).checkpoint()
        return sorted(rows(state), key=key)

    model = langid.fit(docs.where(~held_out("doc_id")))
    known = {r["doc_id"] for r in rows(langid.predict(docs, model)) if r["lang_pred"] != "und"}
    want = sorted((r for r in plain if r["doc_id"] in known), key=key)
    assert step("language_id") == want and not {100, 101, 102} & known

    texts = brute_lines([(r["source"], r["text"]) for r in want], line_dedup.MAX_RATIO, line_dedup.MIN_PAGES)
    want = [r | {"text": t, "n_chars": len(t)} for r, t in zip(want, texts, strict=True)]
    assert step("line_dedup") == want and any("home" not in r["text"] for r in want if r["doc_id"] % 3 if r["doc_id"] is not None)

    comps = {d: c for d, _, c in brute_components([(r["doc_id"], r["text"]) for r in want])}
    want = [r for r in want if r["doc_id"] is None or comps[r["doc_id"]] == r["doc_id"]]
    assert step("ngram_jaccard_join") == want and len(want) < len(texts)

    cleaned = [without_leaks(r["text"], items) for r in want]
    assert any(t != r["text"] for t, r in zip(cleaned, want, strict=True))
    want = [r | {"text": t, "n_chars": len(t)} for r, t in zip(want, cleaned, strict=True)]
    assert step("benchmark_decontamination") == want

    out = step("best_fit_packing")
    lengths = defaultdict(int)
    for r in out:
        lengths[r["doc_id"]] += r["length"]
    assert set(lengths) == {r["doc_id"] for r in want}
    filled = defaultdict(int)
    for r in out:
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= packing.CAPACITY and len(filled) <= -(-sum(lengths.values()) // packing.CAPACITY) + 1
    assert corpus_pipeline.ORACLE_SQL is None

    # The whole run against the plain version: pieces of the texts that the plain stages left, by the tokenizer itself.
    ref, pieces = Tokenizer.from_file(packing.default_tokenizer()), []
    for r in want:
        ids = [*ref.encode(r["text"], add_special_tokens=False).ids, 0]
        first = len(ids) % packing.CAPACITY or packing.CAPACITY
        bounds = [0, *range(first, len(ids) + 1, packing.CAPACITY)]
        pieces += [(r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False))]
    run = rows(corpus_pipeline.run(spark, sf))
    assert sorted((tuple(r[c] for c in packing.PIECES) for r in run), key=str) == sorted(pieces, key=str)
    at = defaultdict(list)
    for r in run:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in at.values():
        ends = [0]
        for offset, n in sorted(places):
            assert offset == ends[-1]
            ends.append(offset + n)
        assert ends[-1] <= packing.CAPACITY
    assert len(at) == len(filled)


def test_a_run_over_no_documents(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() == 0 and "sequence_id" in out.columns


def test_run_gives_the_last_stage(spark, corpus):
    out = corpus_pipeline.run(spark, corpus[0])
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(out.columns) and out.count() > 50


def test_a_large_copy_group_keeps_its_text(spark):
    rng = random.Random(4)
    text = lambda n: " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    article = "\n".join(text(30) for _ in range(4))
    texts = [f"home | about\n{text(30)}" for _ in range(20)] + [f"home | about\n{article}"] * 10
    docs = spark.createDataFrame([(i, t, "en", "site", len(t)) for i, t in enumerate(texts)], DOCS)
    state = docs
    for name in ("line_dedup", "ngram_jaccard_join"):
        state = dict(corpus_pipeline.STAGES)[name](spark, state, "").checkpoint()
    kept = {r["doc_id"]: r["text"] for r in rows(state)}
    assert set(kept) == set(range(21)) and kept[20] == article and not any("home" in t for t in kept.values())
