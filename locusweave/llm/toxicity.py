"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Every text is compared with the labelled examples twice.  First by its whole TF-IDF vector:
all words of the examples are dimensions (a word is its 64-bit hash), with document
frequencies of all documents, a text's length is that of all its words (those that no example
has have the document frequency of their hash bucket, of OTHERS), and all products of a text's words are summed, so the `k`
nearest are exact; they are the evidence.  (Bounds by block skip next to nothing here, as
whole texts of one language share their frequent words, so this search has none.)  Since topics outweigh insults in whole vectors,
a second search looks at telling terms only.

Terms there are words and the first bytes of longer words, so inflected and compound insults of
one stem meet; all other words of a text together are one more dimension, so that one weak
term in a long text is no strong sign.  Examples are at most `max_rows` labelled rows (a parameter), dealt evenly over the two
labels and taken by a hash of doc_id, whole texts.  Their vocabulary is the at most
MAX_TERMS terms whose presence differs between the labels by more than chance; document
frequencies of these terms are counted over all documents.  Every text is then a query: a
block-max inverted index over the examples gives its `k` nearest exactly (a block whose
upper bound can't beat the kth best is skipped).  Neighbours' labels vote with weights
falling with distance; the two votes are mixed in the proportion that suits the examples
best, and an isotonic map fitted on the examples, each left out of its own vote, turns
votes into probabilities at the labels' natural rate.  Texts without a telling term have
the first vote only, and a map of their own.

Examples, terms and index are bounded by parameters, whatever the corpus; scoring is one
pass without a shuffle.

Defined cases: null or empty text and text without a word of the examples gets the rate of
examples without a telling term and no evidence; a very long text is one vector, whose words
are held by its task; neighbours that tie are taken by the smaller example; with no labels at all every score is 0; rows with a null label or doc_id
teach nothing; repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

import copy
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import remove_path, written
from . import textbatch as tb
from .runtime import label_sample, prepare, sampled_texts

MAX_ROWS = 4000
MAX_TERMS = 1024
MIN_Z = 5.0
PREFIXES = (4, 5, 6, 7, 8)
K = 15
BLOCK = 256
#: Words that have a row of the matrix of whole vectors, and texts that are searched at once.
HEAVY, AT_ONCE = 512, 128
#: Hash buckets by which document frequencies of the words are known that no example has.
OTHERS = 1 << 18
#: Shares of the whole vectors' vote that are tried.
SHARES = (0.0, 0.25, 0.5, 0.75, 1.0)


def _prefixes(words: tb.Words, n: int) -> tuple[tb.Words, np.ndarray]:
    """(the first n bytes of each longer word, the numbers of these words)."""
    at = np.flatnonzero(words.ends - words.starts > n)
    part = copy.copy(words)
    part.starts, part.ends = words.starts[at], words.starts[at] + n
    return part, at


class Terms:
    """Term numbers of a text's words and beginnings of words, with how often each stands there.

    A beginning is written with a star behind it.  Number n is all words that are no term.
    """

    def __init__(self, terms: list[bytes]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.n = len(terms)
        whole = [t for t in terms if not t.endswith(b"*")]
        self.sets = {0: self._set(whole)} | {k: self._set([t[:-1] for t in terms if t.endswith(b"*") and len(t) == k + 1]) for k in PREFIXES}

    @staticmethod
    def _set(raw: list[bytes]) -> tb.HashSet:
        offs = np.cumsum([0, *map(len, raw)])
        return tb.HashSet(tb.Words(np.frombuffer(b"".join(raw), np.uint8), offs, tb.ALNUM).hashes())

    def counts(self, data: np.ndarray, offs: np.ndarray):
        """(row, {term: times}) of the rows that have any."""
        if not self.n:
            return
        for lo, hi in tb.blocks(offs):
            words = tb.Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], tb.ALNUM)
            found: dict[int, Counter] = {}
            hit: dict[int, set[int]] = {}
            for k, members in self.sets.items():
                part, at = _prefixes(words, k) if k else (words, None)
                for i in members.where(part.hashes()):
                    term = self.number.get(part.word(i) + (b"*" if k else b""))
                    if term is not None:
                        w = int(at[i]) if k else int(i)
                        row = int(words.row[w])
                        found.setdefault(lo + row, Counter())[term] += 1
                        hit.setdefault(lo + row, set()).add(w)
            for row, c in found.items():
                if rest := int(words.counts[row - lo]) - len(hit[row]):
                    c[self.n] = rest
                yield row, c


class BlockMax:
    """Inverted lists by term, in blocks of examples with the largest weight of each block."""

    def __init__(self, vectors: list[dict[int, float]], n_terms: int, block: int = BLOCK):
        self.n, self.block = len(vectors), block
        self.n_blocks = -(-self.n // block)
        lists: list[list[tuple[int, float]]] = [[] for _ in range(n_terms)]
        for d, v in enumerate(vectors):
            for t, w in v.items():
                lists[t].append((d, w))
        self.docs = [np.array([d for d, _ in x], np.int64) for x in lists]
        self.weights = [np.array([w for _, w in x]) for x in lists]
        self.cuts = [np.searchsorted(d, np.arange(self.n_blocks + 1) * block) for d in self.docs]
        self.most = np.zeros((n_terms, self.n_blocks))
        for t, d in enumerate(self.docs):
            np.maximum.at(self.most[t], d // block, self.weights[t])

    def search(self, query: dict[int, float], k: int, skip: int = -1) -> list[tuple[float, int]]:
        """The k best (cosine, example), best first, of those with a term in common; ties go to the smaller number."""
        terms = list(query)
        bound = sum(query[t] * self.most[t] for t in terms)
        best, found, least = np.zeros(0), np.zeros(0, np.int64), 0.0
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == k and bound[b] < least - 1e-9:
                break
            lo = b * self.block
            score = np.zeros(min(self.block, self.n - lo))
            for t in terms:
                s, e = self.cuts[t][b], self.cuts[t][b + 1]
                score[self.docs[t][s:e] - lo] += query[t] * self.weights[t][s:e]
            score = score.round(12)
            if 0 <= skip - lo < len(score):
                score[skip - lo] = 0
            near = np.flatnonzero(score >= max(least, 1e-12))
            best, found = np.concatenate([best, score[near]]), np.concatenate([found, lo + near])
            top = np.lexsort((found, -best))[:k]
            best, found = best[top], found[top]
            least = best[-1] if len(best) == k else 0.0
        return list(zip(best.tolist(), found.tolist(), strict=True))


def bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - OTHERS.bit_length() + 1)).astype(np.int64)


class Whole:
    """Whole TF-IDF vectors of the examples: a matrix of the words that most of them have, postings of the others."""

    def __init__(self, words: np.ndarray, idf: np.ndarray, examples: list[tuple[np.ndarray, np.ndarray]], heavy: int = HEAVY, other_idf: np.ndarray | None = None):
        """words: sorted hashes; examples: (word hashes, times) of each; other_idf: by hash bucket, of words that no example has."""
        self.words, self.idf, self.n = words, idf, len(examples)
        self.other_idf = np.ones(OTHERS) if other_idf is None else other_idf
        vectors = [self.vector(*e) for e in examples]
        at = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        docs = np.repeat(np.arange(self.n), [len(t) for t, _ in vectors])
        weights = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        often = np.argsort(-np.bincount(at, minlength=len(words)), kind="stable")[:heavy]
        self.row = np.full(len(words), -1, np.int32)  # in the matrix
        self.row[often] = np.arange(len(often))
        self.matrix = np.zeros((len(often), self.n))
        dense = self.row[at] >= 0
        self.matrix[self.row[at[dense]], docs[dense]] = weights[dense]
        at, docs, weights = at[~dense], docs[~dense], weights[~dense]
        order = np.argsort(at, kind="stable")
        self.docs, self.weights = docs[order].astype(np.int32), weights[order]
        self.first = np.searchsorted(at[order], np.arange(len(words) + 1))

    def vector(self, hashes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, weights) of the words that examples have, in a vector of all words that has length 1."""
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        known = self.words[at] == hashes if len(self.words) else np.zeros(len(at), bool)
        w = 1 + np.log(times)
        w[known] *= self.idf[at[known]]
        w[~known] *= self.other_idf[bucket(hashes[~known])]
        return at[known], w[known] / np.sqrt((w * w).sum()) if known.any() else w[known]

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int, skip: int | None = None) -> list[list[tuple[float, int]]]:
        """As BlockMax.search, for each of some (word hashes, times); with skip, query i leaves out example skip + i."""
        if not self.n:
            return [[] for _ in queries]
        vectors = [self.vector(*q) for q in queries]
        dense = np.zeros((len(queries), len(self.matrix)))
        for i, (at, w) in enumerate(vectors):
            row = self.row[at]
            dense[i, row[row >= 0]] = w[row >= 0]
        scores, out = dense @ self.matrix, []
        for i, (at, w) in enumerate(vectors):
            rare = self.row[at] < 0
            at, w = at[rare], w[rare]
            size = self.first[at + 1] - self.first[at]
            where = np.repeat(self.first[at] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            score = (scores[i] + np.bincount(self.docs[where], np.repeat(w, size) * self.weights[where], minlength=self.n)).round(12)
            if skip is not None:
                score[skip + i] = 0
            near = np.flatnonzero(score >= max(np.partition(score, -k)[-k] if self.n > k else 0, 1e-12))
            near = near[np.argsort(-score[near], kind="stable")][:k]
            out.append([(min(1.0, s), j) for s, j in zip(score[near].tolist(), near.tolist(), strict=True)])
        return out


def word_counts(data: np.ndarray, offs: np.ndarray):
    """(row, sorted hashes of its words, times) of the rows that have any."""
    for lo, hi in tb.blocks(offs):
        words = tb.Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], tb.ALNUM)
        h = words.hashes()
        for r in np.flatnonzero(words.counts):
            yield lo + int(r), *np.unique(h[words.first[r] : words.first[r + 1]], return_counts=True)


def unit(counts: dict[int, int], idf: np.ndarray) -> dict[int, float]:
    v = {t: (1 + np.log(n)) * idf[t] for t, n in sorted(counts.items())}
    norm = float(np.sqrt(sum(x * x for x in v.values())))
    return {t: x / norm for t, x in v.items()}


def monotone(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic fit by pooling adjacent violators: (knots, values)."""
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []  # value, weight, lowest x, highest x
    for i in order:
        pools.append([y[i], w[i], x[i], x[i]])
        while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
            b, a = pools.pop(), pools.pop()
            pools.append([(a[0] * a[1] + b[0] * b[1]) / (a[1] + b[1]), a[1] + b[1], a[2], b[3]])
    return np.array([v for p in pools for v in (p[2], p[3])]), np.array([p[0] for p in pools for _ in (0, 1)])


class Model:
    def __init__(self, terms: list[bytes], idf: np.ndarray, examples: list[tuple[int, int, dict[int, int], np.ndarray, np.ndarray]], rates: tuple[float, float], words: np.ndarray, word_idf: np.ndarray, k: int = K, other_idf: np.ndarray | None = None):
        """examples: (doc_id, label, term counts, word hashes, times); rates: natural weight of an example of label 0 and 1."""
        self.terms, self.idf, self.k = Terms(terms), idf, k
        weight = lambda label: rates[label]
        bare = [(label, weight(label)) for _, label, c, *_ in examples if not c]
        prior = sum(w for label, w in bare if label) + 1e-3
        total = sum(w for _, w in bare) + 2e-3
        self.bare = 0.0 if not examples else min(prior / total, 1.0)
        full = [(i, label, unit(c, idf), n) for n, (i, label, c, *_) in enumerate(examples) if c]
        rest = len(terms)
        full.sort(key=lambda e: (max((t for t in e[2] if t != rest), key=lambda t: (e[2][t], -t)), e[2].get(rest, 0), e[1], e[0]))
        self.numbers = np.array([e[3] for e in full], np.int64)
        self.ids = [e[0] for e in examples]
        self.labels = np.array([e[1] for e in examples], np.int64)
        self.rate = np.array([weight(e[1]) for e in examples])
        self.index = BlockMax([e[2] for e in full], len(terms) + 1)
        self.whole = Whole(words, word_idf, [e[3:] for e in examples], other_idf=other_idf)
        first = np.array([self._vote(near) for lo in range(0, len(examples), AT_ONCE) for near in self.whole.search([e[3:] for e in examples[lo : lo + AT_ONCE]], k, lo)])
        second = np.array([self._vote(self._told(e[2], skip=i)) for i, e in enumerate(full)])
        none = np.setdiff1d(np.arange(len(examples)), self.numbers)
        self.share, self.knots, self.values = 0.0, np.zeros(1), np.zeros(1)
        self.bare_knots, self.bare_values = np.zeros(1), np.full(1, self.bare)
        if full:
            y, w, best = self.labels[self.numbers].astype(float), self.rate[self.numbers], np.inf
            for share in SHARES:
                raw = (1 - share) * second + share * first[self.numbers]
                knots, values = monotone(raw, y, w)
                if (loss := float((w * (np.interp(raw, knots, values) - y) ** 2).sum())) < best - 1e-9:
                    best, self.share, self.knots, self.values = loss, share, knots, values
        if len(none):
            self.bare_knots, self.bare_values = monotone(first[none], self.labels[none].astype(float), self.rate[none])
        self.memo: dict[tuple, float] = {}

    def _told(self, vector: dict[int, float], skip: int = -1) -> list[tuple[float, int]]:
        """The nearest examples by telling terms."""
        return [(s, int(self.numbers[d])) for s, d in self.index.search(vector, self.k, skip)]

    def _vote(self, near: list[tuple[float, int]]) -> float:
        """Share of label 1 among the neighbours, each weighing its rate / (distance + 0.05)."""
        if not near:
            return 0.0
        at = np.array([d for _, d in near])
        w = self.rate[at] / (1.05 - np.minimum(1.0, np.array([s for s, _ in near])))
        return float((w * self.labels[at]).sum() / w.sum())

    def score(self, texts: list[tuple[dict[int, int] | None, np.ndarray, np.ndarray]]) -> list[tuple[float, list[dict]]]:
        """(probability, evidence) of each text of term counts, words and times."""
        if not self.ids:
            return [(self.bare, [])] * len(texts)
        out = []
        for (counts, *_), near in zip(texts, self.whole.search([t[1:] for t in texts], self.k), strict=True):
            if not near:
                out.append((self.bare, []))
                continue
            vote = self._vote(near)
            if counts and len(self.numbers):
                key = tuple(sorted(counts.items()))
                if key not in self.memo:
                    if len(self.memo) > 20_000:
                        self.memo.clear()
                    self.memo[key] = self._vote(self._told(unit(counts, self.idf)))
                p = np.interp((1 - self.share) * self.memo[key] + self.share * vote, self.knots, self.values)
            else:
                p = np.interp(vote, self.bare_knots, self.bare_values)
            out.append((float(p), [{"doc_id": self.ids[d], "cosine": s, "toxic": int(self.labels[d])} for s, d in near]))
        return out


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_terms: int = MAX_TERMS, k: int = K) -> Model:
    """A model of labelled documents; document frequencies are of all docs."""
    spark = docs.sparkSession
    prepare(spark)
    chosen, rates = label_sample(labels, "toxic", max_rows)
    texts = sampled_texts(docs, chosen).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").alias("_toxic"), "text")
    texts, examples_path = written(texts, "examples")

    def vocabulary(batches):
        for b in batches:
            data, offs = tb.text_buffers(b.column("text"))
            label, seen = b.column("_toxic").to_pylist(), Counter()
            for i in range(b.num_rows):
                w = tb.Words(data[offs[i] : offs[i + 1]], np.array([0, offs[i + 1] - offs[i]]), tb.ALNUM)
                own = {w.word(j) for j in range(len(w.starts))}
                seen.update((x, label[i]) for x in own | {x[:k] + b"*" for x in own for k in PREFIXES if len(x) > k})
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in seen], pa.binary()), pa.array([y for _, y in seen], pa.int32()), pa.array(list(seen.values()), pa.int64())], names=["term", "toxic", "n"])

    totals = {r["_toxic"]: r["count"] for r in texts.groupBy("_toxic").count().collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    terms: list[bytes] = []
    if n0 and n1:
        a, b = F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)), F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0))
        share = (F.col("a") + F.col("b")) / (n0 + n1)
        z = F.abs(F.col("a") / n1 - F.col("b") / n0) / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) * (1 / n0 + 1 / n1))
        ranked = texts.mapInArrow(tb.task(vocabulary), "term binary, toxic int, n long").groupBy("term").agg(a.alias("a"), b.alias("b")).withColumn("z", z).where(F.col("z") >= MIN_Z)
        terms = sorted(bytes(r.term) for r in ranked.orderBy(F.desc("z"), "term").limit(max_terms).select("term").collect())
    shared = spark.sparkContext.broadcast(terms)

    def frequencies(batches):
        terms, df, n = Terms(shared.value), Counter(), 0
        for b in batches:
            data, offs = tb.text_buffers(b.column("text"))
            n += b.num_rows
            for _, c in terms.counts(data, offs):
                df.update(t for t in c if t < terms.n)
        df[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.int32()), pa.array(list(df.values()), pa.int64())], names=["term", "n"])

    df = {r.term: r.n for r in docs.select("text").mapInArrow(tb.task(frequencies), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()} if terms else {}
    idf = np.array([np.log((1 + df.get(-1, 0)) / (1 + df.get(t, 0))) + 1 for t in range(len(terms))] + [1.0])

    def vectors(batches):
        terms = Terms(shared.value)
        for b in batches:
            data, offs = tb.text_buffers(b.column("text"))
            found = dict(terms.counts(data, offs))
            words = {i: (h.tobytes(), n.astype(np.int64).tobytes()) for i, h, n in word_counts(data, offs)}
            h, n = zip(*(words.get(i, (b"", b"")) for i in range(b.num_rows)), strict=True) if b.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_toxic"), pa.array([list(found.get(i, {}).items()) for i in range(b.num_rows)], pa.map_(pa.int32(), pa.int32())), pa.array(h, pa.binary()), pa.array(n, pa.binary())], names=["doc_id", "toxic", "terms", "words", "times"])

    got = texts.mapInArrow(tb.task(vectors), "doc_id long, toxic int, terms map<int,int>, words binary, times binary").collect()
    examples = sorted(((r.doc_id, r.toxic, dict(r.terms), np.frombuffer(r.words, np.uint64), np.frombuffer(r.times, np.int64)) for r in got), key=lambda e: (e[0], e[1], sorted(e[2].items()), e[3].tobytes()))
    words = np.unique(np.concatenate([np.zeros(0, np.uint64), *(e[3] for e in examples)]))
    remove_path(spark, examples_path)
    vocabulary_of = spark.sparkContext.broadcast(words)

    def word_frequencies(batches):
        words = vocabulary_of.value
        size = len(words)
        df = np.zeros(size + OTHERS + 1, np.int64)
        for b in batches:
            df[-1] += b.num_rows
            for _, h, _ in word_counts(*tb.text_buffers(b.column("text"))):
                at = np.searchsorted(words, h)
                at[at == size] = 0
                known = words[at] == h
                df[at[known]] += 1
                df[size + np.unique(bucket(h[~known]))] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["word", "n"])

    n_docs = np.zeros(len(words) + OTHERS + 1)
    if len(words):
        counted = docs.select("text").mapInArrow(tb.task(word_frequencies), "word int, n long").groupBy("word").agg(F.sum("n").alias("n")).toArrow()
        n_docs[counted["word"].to_numpy()] = counted["n"].to_numpy()
    word_idf = np.log((1 + n_docs[-1]) / (1 + n_docs[:-1])) + 1
    return Model(terms, idf, examples, rates, words, word_idf[: len(words)], k, word_idf[len(words) :])


SCORED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("evidence", T.ArrayType(T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("cosine", T.DoubleType()), T.StructField("toxic", T.IntegerType())]))),
    ]
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, evidence (nearest examples with cosine and label) of each row."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    evidence = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))

    def run(batches):
        model = shared.value
        for b in batches:
            data, offs = tb.text_buffers(b.column("text"))
            found = dict(model.terms.counts(data, offs))
            out, held = [(model.bare, [])] * b.num_rows, []
            for row in chain(word_counts(data, offs), [None]):
                if row:
                    held.append(row)
                if held and (not row or len(held) == AT_ONCE):
                    for (i, *_), got in zip(held, model.score([(found.get(i), h, n) for i, h, n in held]), strict=True):
                        out[i] = got
                    held = []
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([p for p, _ in out], pa.float64()), pa.array([e for _, e in out], evidence)], names=["doc_id", "score", "evidence"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tb.task(run), SCORED)
