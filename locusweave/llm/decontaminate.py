"""Benchmark decontamination.

The normalised word windows of the benchmark become a hash set that is broadcast; every
document's rolling windows are looked up in it and each hit is verified word by word.  A
window is `size` consecutive item words; an item of fewer words, but not none, is one
window.  One pass over the documents, no shuffle.

The broadcast is bounded: the items' bytes are summed first and items are split into
groups of at most `max_bytes`; each group is a further scan chained behind the first in
the same stage, so any benchmark is handled exactly with a bounded table per worker.

Defined cases: null or empty text has no words and no hits; repeated rows each get their
row; an item with a null id hits and is listed as "null"; empty tables give empty or
hit-free results; further columns are ignored by `scan` and kept by `remove`;
a very long text is looked up whole; items that share a window are all listed, so nothing ties.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .runtime import prepare

WINDOW = 10
MAX_BYTES = 16 << 20

SCAN_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
    ]
)


class Windows:
    """Windows of benchmark items by length, with their exact words."""

    def __init__(self, items: list[tuple[str, str]], size: int):
        self.items: dict[bytes, set[str]] = {}
        by_length: dict[int, list[np.ndarray]] = {}
        for item_id, text in items:
            data = np.frombuffer((text or "").encode(), np.uint8)
            words = tb.Words(data, np.array([0, len(data)]), tb.ALNUM)
            n = len(words.starts)
            if not n:
                continue
            k = min(size, n)
            by_length.setdefault(k, []).append(tb.grams(words.hashes(), k))
            for i in range(n - k + 1):
                self.items.setdefault(words.phrase(i, k), set()).add(item_id)
        self.sets = {k: tb.HashSet(np.concatenate(v)) for k, v in by_length.items()}

    def scan(self, words: tb.Words) -> tuple[np.ndarray, dict[int, set[str]]]:
        """(hit mask over the words, items by row)."""
        h = words.hashes()
        cover = np.zeros(len(h) + 1, np.int64)
        found: dict[int, set[str]] = {}
        for k, members in self.sets.items():
            at = members.where(tb.grams(h, k))
            for i in at[words.row[at] == words.row[at + k - 1]] if len(at) else ():
                ids = self.items.get(words.phrase(i, k))
                if ids:
                    cover[i] += 1
                    cover[i + k] -= 1
                    found.setdefault(int(words.row[i]), set()).update(ids)
        return np.cumsum(cover[:-1]) > 0, found


def item_groups(benchmark: DataFrame, max_bytes: int) -> tuple[int, Iterator[list[tuple[str, str]]]]:
    """The number of groups of items whose texts have about `max_bytes` at most, and the groups, each collected when its turn comes."""
    b = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), F.col("text").alias("t")).where(F.col("t").isNotNull())
    total = b.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0
    n = -(-total // max_bytes)
    key = F.pmod(F.xxhash64("i", "t"), F.lit(max(n, 1)))
    return n, ([(r.i, r.t) for r in b.where(key == g).collect()] for g in range(n))


def _hits(words: tb.Words, hit: np.ndarray, row: int) -> list[list[int]]:
    """Byte spans of the runs of hit words of a row, from the row's start."""
    lo, hi = words.first[row], words.first[row + 1]
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit[lo:hi].astype(np.int8), [0]])))
    base = words.offs[row]
    return [[int(words.starts[lo + a] - base), int(words.ends[lo + b - 1] - base)] for a, b in edge.reshape(-1, 2)]


def _rows(batch: pa.RecordBatch, windows: Windows):
    """Per row: n_words, byte spans hit, items."""
    data, offs = tb.text_buffers(batch.column("text"))
    for lo, hi in tb.blocks(offs):
        words = tb.Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], tb.ALNUM)
        hit, found = windows.scan(words)
        for r in range(hi - lo):
            yield lo + r, int(words.counts[r]), int(hit[words.first[r] : words.first[r + 1]].sum()) if r in found else 0, _hits(words, hit, r) if r in found else [], sorted(found.get(r, ()))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids), spans (byte ranges of hit words) of each row of docs."""
    spark = docs.sparkSession
    prepare(spark)
    count, groups = item_groups(benchmark, max_bytes)
    many = count > 1
    schema = T.StructType([*SCAN_SCHEMA.fields, T.StructField("text", T.StringType())]) if many else SCAN_SCHEMA
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for n, group in enumerate(groups if count else [[]]):
        shared = spark.sparkContext.broadcast((group, size))
        del group  # the broadcast has it on disk; the driver holds one group at a time

        def run(batches, shared=shared, n=n):
            windows = Windows(*shared.value)
            for b in batches:
                rows = list(_rows(b, windows))
                spans, items = [x[3] for x in rows], [x[4] for x in rows]
                if n:
                    items = [sorted({*x, *y}) for x, y in zip(items, b.column("items").to_pylist(), strict=True)]
                    spans = [[*x, *y] for x, y in zip(spans, b.column("spans").to_pylist(), strict=True)]
                    hits = [_count(t, s) for t, s in zip(b.column("text").to_pylist(), spans, strict=True)]
                else:
                    hits = [x[2] for x in rows]
                cols = [b.column("doc_id"), pa.array([x[1] for x in rows], pa.int64()), pa.array(hits, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array([_merged(s) for s in spans], pa.list_(pa.list_(pa.int32())))]
                names = ["doc_id", "n_words", "n_hit", "items", "spans"]
                if many:
                    cols, names = [*cols, b.column("text")], [*names, "text"]
                yield pa.RecordBatch.from_arrays(cols, names=names)

        out = out.mapInArrow(tb.task(run), schema)
    return out.drop("text")


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _in_spans(text: str | None, spans: list[list[int]]) -> tuple[tb.Words, np.ndarray]:
    """(the text's words, which of them start in a span)."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    words, merged = tb.Words(data, np.array([0, len(data)]), tb.ALNUM), _merged(spans)
    at = np.searchsorted([a for a, _ in merged], words.starts, "right") - 1
    return words, (at >= 0) & (words.starts < np.array([b for _, b in merged])[at])


def _count(text: str | None, spans: list[list[int]]) -> int:
    """Words of the text that start in a span."""
    return int(_in_spans(text, spans)[1].sum()) if spans else 0


def _cut(text: str, spans: list[list[int]]) -> str:
    """The text without the runs of words that start in a span, and what stands between these words."""
    words, hit = _in_spans(text, spans)
    raw, at, parts = text.encode(), 0, []
    for s, e in _hits(words, hit, 0):
        parts.append(raw[at:s])
        at = e
    return (b"".join(parts) + raw[at:]).decode()


def remove(docs: DataFrame, benchmark: DataFrame, action: str = "spans", size: int = WINDOW, max_bytes: int = MAX_BYTES) -> DataFrame:
    """docs without what the benchmark holds, all columns kept.

    action "documents" drops each document with a hit; "spans" cuts the hit words, with
    what stands between them, out of its text and sets n_chars, where there is such a column.
    Every group of items is looked up in the whole text, and the last one's task cuts.
    """
    if action not in ("spans", "documents"):
        raise ValueError(f"unknown action: {action}")
    spark = docs.sparkSession
    prepare(spark)
    out, counted = docs, "n_chars" in docs.columns
    count, groups = item_groups(benchmark, max_bytes)
    plain = T.StructType([T.StructField(f.name, f.dataType, True) for f in docs.schema])
    carried = "_spans" + "_" * max([0, *map(len, docs.columns)])
    kind = pa.list_(pa.list_(pa.int32()))
    for n, group in enumerate(groups):
        shared = spark.sparkContext.broadcast((group, size))
        del group
        last = n == count - 1

        def run(batches, shared=shared, n=n, last=last):
            windows = Windows(*shared.value)
            for b in batches:
                found = [x[3] for x in _rows(b, windows)]
                if action == "documents":
                    yield b.filter(pa.array([not x for x in found], pa.bool_())) if any(found) else b
                    continue
                if n:
                    found = [[*x, *y] for x, y in zip(found, b.column(carried).to_pylist(), strict=True)]
                    b = b.drop_columns([carried])
                if not last:
                    yield b.append_column(carried, pa.array([_merged(x) for x in found], kind))
                    continue
                texts = {i: _cut(b.column("text")[i].as_py(), x) for i, x in enumerate(found) if x}
                if texts:
                    old = b.column("text").to_pylist()
                    new = [texts.get(i, t) for i, t in enumerate(old)]
                    b = b.set_column(b.schema.get_field_index("text"), b.schema.field("text"), pa.array(new, b.schema.field("text").type))
                    if counted:
                        k = b.schema.get_field_index("n_chars")
                        b = b.set_column(k, b.schema.field(k), pa.array([len(texts[i]) if i in texts else n for i, n in enumerate(b.column(k).to_pylist())], b.schema.field(k).type))
                yield b

        more = [] if last or action == "documents" else [T.StructField(carried, T.ArrayType(T.ArrayType(T.IntegerType())), True)]
        out = out.mapInArrow(tb.task(run), T.StructType([*plain.fields, *more]))
    return out


def digest(scanned: DataFrame) -> DataFrame:
    """The report of one row a document: counts, and a digest of the items hit."""
    return scanned.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
