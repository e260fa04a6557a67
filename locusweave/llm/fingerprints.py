"""Document fingerprints: bottom-k sketches of word shingle hashes.

A fingerprint holds the k smallest distinct 64-bit hashes of a text's 5-word shingles and
whether that is all of them.  Fingerprints of parts merge into the fingerprint of the
whole; two of them estimate resemblance, containment and distinct counts.

`with_next` sets each document beside the next one by doc_id without a global window:
doc_id is cut at approximate quantiles into ranges, the first document of each range is
also sent to the range before it, and each range is sorted and streamed.  Texts shuffle
once and a task holds two documents at a time.

Defined cases: null text is empty; a text of fewer than 5 words has one shingle of them
all, one without words an empty fingerprint, which resembles only another empty one;
repeated rows and rows sharing a doc_id each get a row, ordered by text, nulls first; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .runtime import prepare, spread

K = 128
WORDS = 5
ROWS_PER_RANGE = 20_000
MAX_RANGES = 20_000


class Sketch:
    """The k smallest hashes, ascending; whole: these are all."""

    __slots__ = ("hashes", "k", "whole")

    def __init__(self, hashes: np.ndarray, k: int = K, whole: bool = True):
        hashes = np.unique(hashes)
        self.k, self.whole, self.hashes = k, whole and len(hashes) <= k, hashes[:k]

    @classmethod
    def of(cls, text: str | bytes | None, k: int = K, words: int = WORDS) -> Sketch:
        data = np.frombuffer(text if isinstance(text, bytes) else (text or "").encode(), np.uint8)
        w = tb.Words(data, np.array([0, len(data)]), tb.NONSPACE)
        return cls(tb.shingle_hashes(w, w.hashes(), words)[0], k)

    def merge(self, other: Sketch) -> Sketch:
        """Of the union of both shingle sets."""
        return Sketch(np.concatenate([self.hashes, other.hashes]), self.k, self.whole and other.whole)

    def distinct(self) -> float:
        """Number of distinct shingles: exact if whole, else (k - 1) / kth smallest hash in (0, 1]."""
        return float(len(self.hashes)) if self.whole else (self.k - 1) / ((float(self.hashes[-1]) + 1) / 2.0**64)

    def _shared(self, other: Sketch) -> tuple[int, int]:
        """(members of both, size) of the bottom-k of the union."""
        union = np.union1d(self.hashes, other.hashes)
        if not (self.whole and other.whole):
            union = union[: min(self.k, other.k)]
        return int((np.isin(union, self.hashes, True) & np.isin(union, other.hashes, True)).sum()), len(union)

    def resemblance(self, other: Sketch) -> float:
        both, n = self._shared(other)
        return both / n if n else 1.0

    def containment(self, other: Sketch) -> float:
        """Share of this set's shingles that the other has."""
        union = self.merge(other).distinct()
        return min(1.0, self.resemblance(other) * union / max(self.distinct(), 1.0)) if len(self.hashes) else 1.0

    def hex(self) -> str:
        """Equal texts have equal strings: a mark for wholeness, then the hashes."""
        return ("w" if self.whole else "k") + self.hashes.astype(">u8").tobytes().hex()

    @classmethod
    def parse(cls, text: str, k: int = K) -> Sketch:
        return cls(np.frombuffer(bytes.fromhex(text[1:]), ">u8").astype(np.uint64), k, text[0] == "w")


def fingerprint(docs: DataFrame, k: int = K) -> DataFrame:
    """doc_id, fingerprint, n_distinct of each row."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            found = [Sketch.of(t, k) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([s.hex() for s in found], pa.string()), pa.array([s.distinct() for s in found], pa.float64())], names=["doc_id", "fingerprint", "n_distinct"])

    return docs.select("doc_id", "text").mapInArrow(tb.task(run), T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("fingerprint", T.StringType()), T.StructField("n_distinct", T.DoubleType())]))


COMPARED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (part, doc_id, text, last): each range of documents in order, then the document after it, marked last.

    Partitions hold whole ranges, sorted by (part, last, doc_id, text).  There are at most
    MAX_RANGES, so the cuts and heads that are gathered and broadcast are bounded; larger
    tables have longer ranges.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = d.select("doc_id")
    n = ids.count()
    wide = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MAX_RANGES, max(min(4 * wide, n), -(-n // ROWS_PER_RANGE), 1))
    cuts = sorted({int(c) for c in ids.stat.approxQuantile("doc_id", [i / parts for i in range(1, parts)], min(0.001, 0.2 / parts))}) if parts > 1 else []
    cuts = np.array(cuts, np.int64)

    def first(batches):
        for b in batches:
            part, ids, null = _parts(b.column("doc_id"), cuts)
            order = np.lexsort((ids, ~null, part))
            at = order[np.unique(part[order], return_index=True)[1]]
            yield pa.RecordBatch.from_arrays([pa.array(part[at]), pa.array(ids[at], mask=null[at])], names=["part", "doc_id"])

    heads = ids.mapInArrow(tb.task(first), "part int, doc_id long").groupBy("part").agg(F.min(F.struct("doc_id")).alias("h")).orderBy("part").collect()
    back = {r.h.doc_id: heads[i - 1].part for i, r in enumerate(heads)}
    none = back.pop(None, -1)
    at, to = np.array(sorted(back), np.int64), np.array([back[h] for h in sorted(back)], np.int32)

    def deal(batches):
        for b in batches:
            part, ids, null = _parts(b.column("doc_id"), cuts)
            is_head = null & (none >= 0)
            goes = np.where(is_head, none, -1).astype(np.int32)
            if len(at):
                k = np.minimum(np.searchsorted(at, ids), len(at) - 1)
                goes = np.where(~null & (at[k] == ids), to[k], goes).astype(np.int32)
            copies = np.flatnonzero(goes >= 0)
            rows = pa.array(np.concatenate([np.arange(b.num_rows), copies]))
            text = b.column("text").take(rows)
            last = np.arange(len(rows)) >= b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([part, goes[copies]])), b.column("doc_id").take(rows), text, pa.array(last)], names=["part", "doc_id", "text", "last"])

    dealt = d.mapInArrow(tb.task(deal), "part int, doc_id long, text string, last boolean")
    return spread(dealt, "part").sortWithinPartitions("part", "last", F.asc_nulls_first("doc_id"), "text")


def _parts(column: pa.Array, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(range, doc_id, is null) of each row; a null doc_id is before all others."""
    null = np.asarray(column.is_null())
    ids = np.asarray(column.fill_null(np.iinfo(np.int64).min) if column.null_count else column)
    return np.searchsorted(cuts, ids, "right").astype(np.int32), ids, null


def compare_with_next(docs: DataFrame, k: int = K, share: int = 4) -> DataFrame:
    """Each document's fingerprint against that of its edited text and of the next document.

    The edited text has the last floor(n / share) code points replaced by the first as
    many, or all, of the next document.
    """
    prepare(docs.sparkSession)

    def run(batches):
        waiting = None  # (part, doc_id, text, sketch)
        rows = []
        for b in batches:
            for part, doc_id, text, last in zip(*(b.column(c).to_pylist() for c in ("part", "doc_id", "text", "last")), strict=True):
                if last and (waiting is None or waiting[0] != part):
                    continue  # a further row of the doc_id that came back
                sketch = Sketch.of(text, k)
                if waiting is not None:
                    n = len(waiting[2])
                    cut = n // share
                    edited = waiting[2][: n - cut] + text[:cut]
                    changed = Sketch.of(edited, k)
                    rows.append((waiting[1], n, hashlib.sha256(edited.encode()).hexdigest(), waiting[3].hex(), changed.hex(), waiting[3].resemblance(changed), waiting[3].resemblance(sketch)))
                waiting = None if last else (part, doc_id, text, sketch)
            if len(rows) >= 512:
                yield _table(rows)
                rows = []
        yield _table(rows)

    return with_next(docs).mapInArrow(tb.task(run), COMPARED)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=COMPARED.names)
