"""Text quality by the nearest labelled examples in a latent-semantic space.

A text's terms are its words, the shapes of its blank-separated tokens (runs of small letters,
capitals and digits drawn together, other characters as they are) and repetitions (a word
that is the one before, or the one before that), hashed to DIMS numbers in all.  Document
frequencies of the terms are counted over all documents.  The TF-IDF vectors of labelled
examples give a latent space of `rank` dimensions by singular value decomposition; their
vectors there, with labels, are broadcast.  Every text is brought into that space and compared with
all examples by blocked matrix products, so cosines are exact; its `k` nearest vote with
weights that fall off with similarity, each label at its natural rate.

Examples are at most `max_rows` labelled rows (a parameter), dealt evenly over the two labels,
taken by a hash of doc_id, and one text a doc_id; the space is DIMS * rank numbers.  Both are
bounded whatever the corpus; scoring is one pass without a shuffle.

Defined cases: null and empty text and text without a term, and text whose terms no example
has, get the share of label 1 among all labelled rows; a very long text is one row, whose
terms are counted in blocks of words; neighbours that tie are taken by the smaller example;
with no labels every score is 0; rows with a null label or doc_id teach nothing; of rows that
share a labelled doc_id the smallest text teaches; repeated rows each get their row; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .runtime import label_sample, prepare, sampled_texts

WORDS, SHAPES = 1 << 14, 1 << 12
DIMS = WORDS + SHAPES + 2
MAX_ROWS, RANK, K = 2000, 96, 25
#: How much shapes and repetitions count beside words, in squares of their lengths.
SHARE = 0.6
SHARPNESS = 8
AT_ONCE = 256  # texts compared with all examples at once
COLUMNS = 2048  # terms handled at once when the space is made

CLASS = np.arange(256, dtype=np.uint8)
CLASS[0x61:0x7B] = CLASS[0x80:] = 0x61
CLASS[0x41:0x5B] = 0x41
CLASS[0x30:0x3A] = 0x30


def shapes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the shape of every blank-separated token."""
    kind = CLASS[data]
    first = np.ones(len(kind), bool)
    first[1:] = kind[1:] != kind[:-1]
    first[offs[:-1][offs[:-1] < len(kind)]] = True
    first |= ~tb.NONSPACE[kind]
    upto = np.concatenate([[0], np.cumsum(first)])
    tokens = tb.Words(kind[first], upto[offs], tb.NONSPACE)
    return tokens.hashes(lower=False), tokens.row


def terms(data: np.ndarray, offs: np.ndarray):
    """(first row, number of rows, row of each term, term, times) of blocks of rows; terms of a row ascend."""
    for lo, hi in tb.blocks(offs):
        part, at = data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        words = tb.Words(part, at, tb.ALNUM)
        h = words.hashes()
        again = [np.flatnonzero((h[n:] == h[:-n]) & (words.row[n:] == words.row[:-n])) + n if len(h) > n else np.zeros(0, np.int64) for n in (1, 2)]
        s, row = shapes(part, at)
        rows = np.concatenate([words.row, row, *(words.row[a] for a in again)])
        found = np.concatenate([(h % tb.U64(WORDS)).astype(np.int64), WORDS + (s % tb.U64(SHAPES)).astype(np.int64), *(np.full(len(a), WORDS + SHAPES + n) for n, a in enumerate(again))])
        keys, times = np.unique(rows * DIMS + found, return_counts=True)
        yield lo, hi - lo, keys // DIMS, keys % DIMS, times


def weighted(row: np.ndarray, term: np.ndarray, times: np.ndarray, idf: np.ndarray, n_rows: int) -> np.ndarray:
    """TF-IDF weights of terms: those of words and the others each of fixed length in a row."""
    w = (1 + np.log(times)) * idf[term]
    other = term >= WORDS
    for part, square in ((~other, 1 - SHARE), (other, SHARE)):
        length = np.bincount(row[part], w[part] ** 2, minlength=n_rows)
        w[part] *= np.sqrt(square / np.maximum(length, 1e-30))[row[part]]
    return w.astype(np.float32)


class Space:
    """The latent space of some TF-IDF vectors, given as rows of (terms, weights)."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], rank: int = RANK):
        n = len(vectors)
        row = np.repeat(np.arange(n), [len(t) for t, _ in vectors])
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        weight = np.concatenate([np.zeros(0, np.float32), *(w for _, w in vectors)])
        order = np.argsort(term, kind="stable")
        row, term, weight = row[order], term[order], weight[order]
        products = np.zeros((n, n))
        blocks = []
        for lo in range(0, DIMS, COLUMNS):
            a, b = np.searchsorted(term, (lo, lo + COLUMNS))
            blocks.append((lo, a, b))
            x = self._dense(row[a:b], term[a:b] - lo, weight[a:b], n)
            products += x @ x.T
        values, left = np.linalg.eigh(products) if n else (np.zeros(0), np.zeros((0, 0)))
        keep = np.flatnonzero(values > 1e-6 * max(values.max(initial=0), 1e-30))[::-1][:rank]
        turn = (left[:, keep] / np.sqrt(values[keep])).astype(np.float32)
        self.axes = np.zeros((DIMS, len(keep)), np.float32)
        for lo, a, b in blocks:
            x = self._dense(row[a:b], term[a:b] - lo, weight[a:b], n)
            self.axes[lo : lo + COLUMNS] = (x.T @ turn)[: DIMS - lo]

    @staticmethod
    def _dense(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
        x = np.zeros((n, COLUMNS), np.float32)
        x[row, term] = weight
        return x

    def bring(self, row: np.ndarray, term: np.ndarray, weight: np.ndarray, n_rows: int) -> np.ndarray:
        """Vectors of length 1 (or 0) in the space; terms are sorted by row."""
        out = np.zeros((n_rows, self.axes.shape[1]), np.float32)
        for lo in range(0, len(term), 1 << 16):  # a row may go on in the next part
            r, t, w = row[lo : lo + (1 << 16)], term[lo : lo + (1 << 16)], weight[lo : lo + (1 << 16)]
            starts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            out[r[starts]] += np.add.reduceat(self.axes[t] * w[:, None], starts)
        length = np.sqrt((out**2).sum(1, keepdims=True))
        return np.where(length > 1e-6, out / np.maximum(length, 1e-6), 0)


class Model:
    def __init__(self, examples: list[tuple[int, int, np.ndarray, np.ndarray]], rates: tuple[float, float], idf: np.ndarray, rank: int = RANK, k: int = K):
        """examples: (doc_id, label, terms, times); rates: natural weight of an example of label 0 and 1."""
        self.idf, self.k = idf, k
        self.ids = [e[0] for e in examples]
        self.labels = np.array([e[1] for e in examples], float)
        self.rates = np.array([rates[e[1]] for e in examples])
        self.base = float((self.labels * self.rates).sum() / self.rates.sum()) if examples else 0.0
        vectors = [(t, weighted(np.zeros(len(t), np.int64), t, n, idf, 1)) for *_, t, n in examples]
        self.space = Space(vectors, rank)
        at = np.repeat(np.arange(len(vectors)), [len(t) for t, _ in vectors])
        self.vectors = self.space.bring(at, np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)]), np.concatenate([np.zeros(0, np.float32), *(w for _, w in vectors)]), len(vectors))

    def vote(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(score, numbers and cosines of the nearest examples) of vectors of the space."""
        k = min(self.k, len(self.labels))
        if not k:
            return np.zeros(len(x)), np.zeros((len(x), 0), int), np.zeros((len(x), 0))
        cosine = np.clip((x @ self.vectors.T).astype(float).round(6), -1, 1)
        near = np.argsort(-cosine, 1, kind="stable")[:, :k]
        cosine = np.take_along_axis(cosine, near, 1)
        w = np.maximum(cosine, 0) ** SHARPNESS * self.rates[near]
        total = w.sum(1)
        return np.where(total > 0, (w * self.labels[near]).sum(1) / np.maximum(total, 1e-30), self.base), near, cosine

    def score(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(score, (nearest examples, cosines)) of each row."""
        score, near = np.full(len(offs) - 1, self.base), [(np.zeros(0, int), np.zeros(0))] * (len(offs) - 1)
        for first, n, row, term, times in terms(data, offs):
            x = self.space.bring(row, term, weighted(row, term, times, self.idf, n), n)
            some = np.flatnonzero(x.any(1)) if x.shape[1] else np.zeros(0, int)
            for lo in range(0, len(some), AT_ONCE):
                at = some[lo : lo + AT_ONCE]
                got, who, cosine = self.vote(x[at])
                score[first + at] = got
                for i, j, c in zip((first + at).tolist(), who, cosine, strict=True):
                    near[i] = (j, c)
        return score, near


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS, rank: int = RANK, k: int = K) -> Model:
    """A model of labelled documents; document frequencies are of all docs."""
    spark = docs.sparkSession
    prepare(spark)
    chosen, rates = label_sample(labels, label, max_rows)

    def counted(batches):
        for b in batches:
            data, offs = tb.text_buffers(b.column("text"))
            out = {first + i: (term[row == i], times[row == i]) for first, n, row, term, times in terms(data, offs) for i in range(n)}
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), *(pa.array([out[i][j].astype(np.int32).tobytes() for i in range(b.num_rows)], pa.binary()) for j in (0, 1))], names=["doc_id", "label", "terms", "times"])

    def frequencies(batches):
        df = np.zeros(DIMS + 1, np.int64)
        for b in batches:
            df[DIMS] += b.num_rows
            for *_, term, _ in terms(*tb.text_buffers(b.column("text"))):
                df[:DIMS] += np.bincount(term, minlength=DIMS)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(df[at])], names=["term", "n"])

    got = sampled_texts(docs, chosen).mapInArrow(tb.task(counted), "doc_id string, label int, terms binary, times binary").collect()
    examples = sorted(((r.doc_id, r.label, np.frombuffer(r.terms, np.int32).astype(np.int64), np.frombuffer(r.times, np.int32)) for r in got), key=lambda e: (len(e[0]), e[0], e[1]))
    df = np.zeros(DIMS + 1)
    if examples:
        rows = docs.select("text").mapInArrow(tb.task(frequencies), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # DIMS rows
        df[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return Model(examples, rates, np.log((1 + df[DIMS]) / (1 + df[:DIMS])) + 1, rank, k)


SCORED = "score double, evidence array<struct<doc_id: string, cosine: double, label: int>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, evidence (nearest examples with cosine and label) of each row."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # DIMS * rank and max_rows * rank numbers
    evidence = pa.list_(pa.struct([("doc_id", pa.string()), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches):
        model = shared.value
        for b in batches:
            got, near = model.score(*tb.text_buffers(b.column("text")))
            told = [[{"doc_id": model.ids[j], "cosine": float(c), "label": int(model.labels[j])} for j, c in zip(who, cosine, strict=True)] for who, cosine in near]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(got), pa.array(told, evidence)], names=["doc_id", "score", "evidence"])

    schema = T.StructType([docs.schema["doc_id"], *T._parse_datatype_string(SCORED).fields])
    return docs.select("doc_id", "text").mapInArrow(tb.task(run), schema)
