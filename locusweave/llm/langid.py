"""Language identification with error-correcting output codes.

Each language gets a binary codeword; one linear classifier of byte 2- and 3-gram counts
is fitted for each bit.  A text's bit margins are compared with every codeword by a loss
weighted with the bits' accuracies, the nearest codeword wins, and a text whose two
nearest codewords are almost as near is flagged as ambiguous.

Fitting uses at most `max_rows` rows (a parameter), dealt evenly over the languages and
taken by a hash of doc_id, whole texts, one a doc_id and language.  So many rows can't teach more
languages than there are rows; beyond, the most frequent are learned, by ties of name.  Only counts in `DIMS` hashed features leave the
executors, so what the driver gathers is bounded by max_rows * DIMS; it holds these rows
once, with one further array of their size at a time.  Prediction is one pass without a shuffle.

Defined cases: null text and text without a letter get "und", score 0, not ambiguous; with
no labelled row at all everything is "und"; repeated rows each get their row; other
columns are ignored by `predict` and kept by `select_known`; a very long text is counted
whole; of codewords that tie the first language by name wins, and the text is ambiguous.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .runtime import low_hashes, prepare

DIMS = 4096
MAX_ROWS = 2000
#: Features whose weights are worked out at once.
PART = 512
AMBIGUOUS = 0.2
LETTER = regex.compile(r"\p{L}")
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[0x41:0x5B] = ASCII_LETTER[0x61:0x7B] = True


def features(data: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed byte 2- and 3-grams of lower-cased text, of length 1."""
    out = np.zeros(DIMS, np.float32)
    if len(data) >= 2:
        b = tb.LOWER[data].astype(np.uint32)
        pair = b[:-1] * np.uint32(0x01000193) + b[1:] * np.uint32(0x9E3779B1)
        triple = pair[:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
        shift = np.uint32(32 - DIMS.bit_length() + 1)
        counts = np.bincount(np.concatenate([pair, triple]) >> shift, minlength=DIMS)
        out = np.sqrt(counts / counts.sum()).astype(np.float32)
    return out


def codewords(n: int) -> np.ndarray:
    """n rows of +1 and -1: all distinct splits of up to 5 classes, else random ones far apart."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 5:
        return np.array([c for c in product((1, -1), repeat=n) if c[0] == 1 and -1 in c]).T.astype(float)
    rng, best, apart = np.random.default_rng(7), None, -1
    for _ in range(200):
        code = rng.choice((-1.0, 1.0), size=(n, 4 * int(np.ceil(np.log2(n))) + 4))
        code = code[:, np.abs(code.sum(0)) < n]
        if (d := min((np.sum(a != b) for i, a in enumerate(code) for b in code[:i]), default=0)) > apart:
            best, apart = code, d
    return best


class Model:
    def __init__(self, langs: list[str], x: np.ndarray, y: np.ndarray, ridge: float = 0.01):
        """x: feature rows, which are overwritten, as the driver holds them; y: indices into langs."""
        self.langs, self.code = langs, codewords(len(langs))
        if not langs:
            return
        self.mean = x.mean(0, dtype=np.float64).astype(np.float32)
        x -= self.mean
        target = self.code[y]
        per_class = np.bincount(y, minlength=len(langs))
        w = np.sqrt(1.0 / per_class[y])[:, None].astype(np.float32)  # every language weighs alike
        xw = x * w
        k = xw @ xw.T
        del xw
        k = k.astype(np.float64)
        k[np.diag_indices_from(k)] += ridge * np.trace(k) / len(k) + 1e-9
        dual = np.linalg.solve(k, target * w)
        del k
        # By parts, since the product is in doubles and would hold all rows as such.
        self.weights = np.concatenate([((x[:, i : i + PART] * w).T @ dual).astype(np.float32) for i in range(0, DIMS, PART)])
        fitted = x @ self.weights
        self.bits = np.maximum(0.05, (np.sign(fitted) == target).mean(0) - 0.5)
        self.bits /= self.bits.sum()

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language index, score, ambiguous) of each feature row."""
        margin = (x - self.mean) @ self.weights
        loss = (np.maximum(0, 1 - margin[:, None, :] * self.code[None]) * self.bits).sum(2)
        p = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        p /= p.sum(1, keepdims=True)
        near = np.sort(loss, 1)
        doubt = near[:, 1] - near[:, 0] < AMBIGUOUS if len(self.langs) > 1 else np.zeros(len(x), bool)
        return loss.argmin(1), p.max(1), doubt


def _block_features(batches, column="text"):
    for b in batches:
        data, offs = tb.text_buffers(b.column(column))
        yield b, data, offs


def fit(rows: DataFrame, max_rows: int = MAX_ROWS) -> Model:
    """A model of (doc_id, text, lang) rows; those without lang or text are left out."""
    prepare(rows.sparkSession)
    known = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").alias("id"), "lang", "text")
    narrow = known.select("id", "lang").distinct()
    counts = {r["lang"]: r["count"] for r in narrow.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_rows).collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, DIMS)), np.zeros(0, int))
    quota = max(1, max_rows // len(langs))
    rank = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = narrow.where(low_hashes("lang", "id", counts, quota)).withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= quota).select("id", "lang")
    same = F.col("k.id").eqNullSafe(F.col("c.id")) & (F.col("k.lang") == F.col("c.lang"))
    texts = known.alias("k").join(F.broadcast(chosen).alias("c"), same).groupBy("k.id", "k.lang").agg(F.min("k.text").alias("text")).select("lang", "text")

    def counted(batches):
        for b, data, offs in _block_features(batches):
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([features(data[offs[i] : offs[i + 1]]).astype(np.float16).tobytes() for i in range(b.num_rows)], pa.binary())], names=["lang", "x"])

    model = Model(langs, *_gathered(texts.mapInArrow(tb.task(counted), "lang string, x binary").collect(), langs))
    tb.release()
    return model


def _gathered(got: list, langs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and their languages' places in langs.  The rows that came go one by one as they are copied."""
    got.sort(key=lambda r: (r.lang, bytes(r.x)), reverse=True)
    x, y = np.empty((len(got), DIMS), np.float32), np.empty(len(got), int)
    for i in range(len(got)):
        r = got.pop()
        x[i], y[i] = np.frombuffer(r.x, np.float16), langs.index(r.lang)
    return x, y


def _labelled(model: Model, column: pa.Array):
    """(language or "und", score, ambiguous) lists of a text column."""
    data, offs = tb.text_buffers(column)
    n = len(offs) - 1
    lang, score, doubt = ["und"] * n, np.zeros(n), np.zeros(n, bool)
    if not model.langs:
        return lang, score, doubt
    for lo, hi in tb.blocks(offs):
        size = min(256, hi - lo)
        for at in range(lo, hi, size):
            rows = [i for i in range(at, min(hi, at + size)) if _has_letter(data[offs[i] : offs[i + 1]])]
            if rows:
                best, p, d = model.predict(np.stack([features(data[offs[i] : offs[i + 1]]) for i in rows]))
                score[rows], doubt[rows] = p, d
                for i, k in zip(rows, best, strict=True):
                    lang[i] = model.langs[k]
    return lang, score, doubt


def _has_letter(data: np.ndarray) -> bool:
    return bool(ASCII_LETTER[data[:256]].any() or ASCII_LETTER[data].any() or (data >= 0x80).any() and LETTER.search(bytes(data).decode("utf-8", "replace")))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of each row."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            lang, score, doubt = _labelled(shared.value, b.column("text"))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score), pa.array(doubt)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())])
    return docs.select("doc_id", "text").mapInArrow(tb.task(run), schema)


def select_known(docs: DataFrame, model: Model) -> DataFrame:
    """The rows whose text has a language, all columns kept: those predicted "und" go."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            lang, _, _ = _labelled(shared.value, b.column("text"))
            yield b.filter(pa.array([x != "und" for x in lang], pa.bool_()))

    return docs.mapInArrow(tb.task(run), T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema]))
