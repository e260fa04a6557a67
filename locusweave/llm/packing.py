"""Best-fit packing of tokenized documents into sequences.

A document's ids, with an end id behind them, are cut into pieces if longer than a
sequence (the first piece takes the remainder).  Only the number of pieces of each length
matters for packing, so the instance is a histogram of at most `capacity` lengths, however
large the corpus.  The driver reduces it by Martello and Toth's dominance criterion, which
fixes small sets that some optimal packing contains, and packs the rest by best fit,
longest first; equal bins are handled as one pattern with a multiplicity.

Pieces take their places by rank within their length.  Ranks come from windows over
(length, salt), so a length that a third of all pieces share is ranked by SALTS tasks, and
from the histogram's running sums.  Texts are read once and never shuffle; the pieces are
written to the shared folder so that a lost executor can't change them between counting and placing.

Defined cases: null and empty text is one piece, the end id alone; repeated rows are
separate pieces, ranked in any order, as they are equal; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import written
from . import textbatch as tb
from . import tokens
from .runtime import prepare

CAPACITY = 2048
END_ID = 0
SALTS = 64


def _less(lengths: list[int], counts: dict[int, int], limit: int) -> int | None:
    """The largest length left that is <= limit; lengths ascend."""
    i = int(np.searchsorted(lengths, limit, "right")) - 1
    while i >= 0 and not counts[lengths[i]]:
        i -= 1
    return lengths[i] if i >= 0 else None


def reduce_dominant(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, times) fixed by dominance; counts keeps what is left.

    For the longest item left, with k the number of smallest others that fit beside it:
    k = 0: it stands alone.  The largest that fits fills the bin, or k = 1: both are fixed.
    k = 2: the largest that fits dominates if it is at least as long as the best pair; the
    best pair is fixed if it begins with that item and nothing better can follow it.
    """
    fixed = []

    def take(*lens: int) -> None:
        need = {x: lens.count(x) for x in lens}
        times = min(counts[x] // n for x, n in need.items())
        for x, n in need.items():
            counts[x] -= times * n
        fixed.append((lens, times))

    changed = True
    while changed:
        changed = False
        lengths = sorted(x for x in counts if counts[x])
        for length in reversed(lengths):
            while counts[length]:
                counts[length] -= 1  # what others can stand beside one such item
                room = capacity - length
                partner = _less(lengths, counts, room)
                small = _smallest(lengths, counts, 3)
                pair = None
                if partner is not None and partner != room and sum(small[:2]) <= room and (len(small) < 3 or sum(small) > room) and len(small) > 1:
                    pair = _best_pair(lengths, counts, room)
                after = _less(lengths, counts, pair[1] - 1) if pair else None
                counts[length] += 1
                if partner is None:
                    take(length)
                elif partner == room or len(small) < 2 or sum(small[:2]) > room:
                    take(length, partner)
                elif pair and partner >= sum(pair):
                    take(length, partner)
                elif pair and pair[0] == partner and (after is None or counts[pair[0]] + counts[pair[1]] <= 2 and len(lengths) <= 3):
                    take(length, *pair)
                else:
                    break
                changed = True
    return fixed


def _smallest(lengths: list[int], counts: dict[int, int], n: int) -> list[int]:
    out: list[int] = []
    for x in lengths:
        out += [x] * min(counts[x], n - len(out))
        if len(out) == n:
            break
    return out


def _best_pair(lengths: list[int], counts: dict[int, int], room: int) -> tuple[int, int] | None:
    """(a, b), a >= b, of the largest sum that fits, and of these with the largest a."""
    best = None
    for a in reversed(lengths):
        if not counts[a] or a >= room:
            continue
        counts[a] -= 1
        b = _less(lengths, counts, min(a, room - a))
        counts[a] += 1
        if b is not None and (best is None or a + b > sum(best)):
            best = (a, b)
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit, longest first, of a histogram: patterns (lengths, times)."""
    rooms: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)  # by room left

    def put(pattern: tuple[int, ...], times: int, room: int) -> None:
        if times:
            rooms[room][pattern] = rooms[room].get(pattern, 0) + times

    for length in sorted((x for x in counts if counts[x]), reverse=True):
        left = counts[length]
        for room in sorted(r for r in rooms if r >= length):
            each = room // length
            for pattern in list(rooms[room]):
                if not left:
                    break
                have = rooms[room][pattern]
                full = min(have, left // each)
                rest = left - full * each if full < have and left - full * each < each else 0
                rooms[room][pattern] -= full + (rest > 0)
                if not rooms[room][pattern]:
                    del rooms[room][pattern]
                put(pattern + (length,) * each, full, room - each * length)
                put(pattern + (length,) * rest, int(rest > 0), room - rest * length)
                left -= full * each + rest
            if not rooms[room]:
                del rooms[room]
        each = capacity // length
        put((length,) * each, left // each, capacity - each * length)
        if left % each:
            put((length,) * (left % each), 1, capacity - left % each * length)
    return [(p, t) for group in rooms.values() for p, t in group.items()]


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths with multiplicities that use every item once."""
    if any(not 0 < x <= capacity for x in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    left = dict(counts)
    return [(p, t) for p, t in [*reduce_dominant(left, capacity), *best_fit(left, capacity)] if t]


class Places:
    """Where the piece of a given rank within its length goes."""

    def __init__(self, patterns: list[tuple[tuple[int, ...], int]]):
        used: dict[int, int] = defaultdict(int)
        rows, bins = [], 0
        for lens, times in patterns:
            offset = 0
            for length in dict.fromkeys(lens):
                m = lens.count(length)
                rows.append((length, used[length], bins, m, offset))
                used[length] += m * times
                offset += m * length
            bins += times
        rows.sort()
        self.length, self.rank, self.bin, self.many, self.offset = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else [np.zeros(0, np.int64)] * 5
        self.bins = bins
        self.width = 1 + max(used.values(), default=0)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset)."""
        at = np.searchsorted(self.length * self.width + self.rank, length * self.width + rank, "right") - 1
        q = rank - self.rank[at]
        return self.bin[at] + q // self.many[at], self.offset[at] + q % self.many[at] * length


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian 32-bit) of each piece."""
    prepare(docs.sparkSession)

    def run(batches):
        for b in batches:
            ids = b.column("doc_id")
            rows: list[tuple] = []
            for row, found in tokens.encoded(b.column("text"), path):
                found = np.append(found, np.uint32(END_ID)).astype("<u4")
                first = len(found) % capacity or capacity
                bounds = [0, *range(first, len(found) + 1, capacity)]
                for k, (s, e) in enumerate(zip(bounds, bounds[1:], strict=False)):
                    raw = found[s:e].tobytes()
                    rows.append((row, k, s, e - s, zlib.crc32(raw), raw if with_ids else None))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            out = [ids.take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.int32()), *(pa.array(c, pa.int64()) for c in cols[2:5])]
            yield pa.RecordBatch.from_arrays(out + ([pa.array(cols[5], pa.binary())] if with_ids else []), names=PIECES + ["ids"] * with_ids)

    fields = [T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in PIECES[2:])]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tb.task(run), T.StructType(fields + [T.StructField("ids", T.BinaryType())] * with_ids))


PIECES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def place(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset; they must not change when read again."""
    spark = pieces.sparkSession
    prepare(spark)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int"))
    counts = np.zeros((capacity + 1, SALTS), np.int64)
    got = salted.groupBy("length", "_salt").count().toArrow()
    counts[got["length"].to_numpy(), got["_salt"].to_numpy()] = got["count"].to_numpy()
    before = np.cumsum(counts, 1) - counts
    places = Places(pack_histogram({i: int(n) for i, n in enumerate(counts.sum(1)) if n}, capacity))
    shared = spark.sparkContext.broadcast((before, places))
    order = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "start", "ids_crc32")

    def run(batches):
        before, places = shared.value
        for b in batches:
            length, salt, nth = (np.asarray(b.column(c)).astype(np.int64) for c in ("length", "_salt", "_nth"))
            seq, offset = places.find(length, before[length, salt] + nth - 1)
            kept = [c for c in b.schema.names if c not in ("_salt", "_nth")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(seq), pa.array(offset)], names=[*kept, "sequence_id", "offset"])

    schema = T.StructType([*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return salted.withColumn("_nth", F.row_number().over(order)).mapInArrow(tb.task(run), schema)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    prepare(docs.sparkSession)
    return place(written(cut(docs, path or default_tokenizer(), capacity, with_ids), "pieces")[0], capacity)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
