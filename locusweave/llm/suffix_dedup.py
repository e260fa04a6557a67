"""Suffix-array dedup: every byte that a repeated string of `length` bytes covers goes.

*Anchors.*  Of each window of `length` bytes the leftmost smallest hash of its 64-byte
grams is its anchor.  Equal windows have equal anchors at equal offsets, so only windows
whose anchors' grams occur again need to be looked at: a sparse suffix array over anchors
decides about all suffixes.  Windows that follow each other and share an anchor are one
region.  A task drops all but one of the equal regions that it meets, which are settled, so
a passage on a third of all documents leaves a task once.

*Sorting.*  Regions of one gram meet in a task.  The contexts right of the anchors are
suffix-sorted, and those left of them, read backwards, too: a multikey quicksort orders
them to a shallow depth, then blind tries order each group that still ties.  Neighbours'
common prefixes R and L give the repeated windows: a window that starts `o` bytes before
its anchor is repeated if some other anchor has R >= length - o and L >= o.  For each
depth at which the right order splits, the best L is that of a neighbour in the left
order.  Groups of more than MAX_GROUP regions, which would outgrow a task, are settled by
128-bit hashes of their windows instead, as rows that Spark spreads.

Texts shuffle once; both joins with them use that exchange.

Defined cases: null text is empty; a text shorter than `length` keeps all its bytes; a very
long text is scanned in overlapping pieces of some megabytes; of strings that tie all are
repeats, so none has to be chosen; rows
with equal doc_id and equal text are one document, whose row is repeated; cuts may fall
within a UTF-8 character, so what is kept is bytes; an empty table gives an empty result;
other columns are ignored.
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

LENGTH = 400
GRAM = 64  # a power of two
SHALLOW = 24
MAX_GROUP = 4000
MET = 300_000  # regions that a task remembers
POSITION_BITS = 21
REGION, WINDOW, SETTLED = range(3)


# --- deep-shallow sorting ---------------------------------------------------------------


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo = 0
    while n - lo > 1:
        mid = (lo + n) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            n = mid
    return lo


class BlindTrie:
    """Orders strings by branching bytes alone; each insertion compares with one string."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root = None  # a leaf is an int, a node [depth, {byte or -1: child}]

    def _byte(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else -1

    def insert(self, i: int) -> None:
        if self.root is None:
            self.root = i
            return
        node = self.root
        while not isinstance(node, int):
            child = node[1].get(self._byte(i, node[0]))
            node = next(iter(node[1].values())) if child is None else child
        depth = common(self.strings[i], self.strings[node])
        other = self._byte(node, depth)
        above, edge, node = None, None, self.root
        while not isinstance(node, int) and node[0] < depth:
            above, edge = node, self._byte(i, node[0])
            node = node[1][edge]
        if not isinstance(node, int) and node[0] == depth:
            node[1][self._byte(i, depth)] = i
            return
        fresh = [depth, {other: node, self._byte(i, depth): i}]
        if above is None:
            self.root = fresh
        else:
            above[1][edge] = fresh

    def ordered(self) -> list[tuple[int, int]]:
        """(string, common prefix with the one before), in order."""
        out: list[tuple[int, int]] = []
        todo: list[tuple] = [(self.root, 0)]
        while todo:
            node, before = todo.pop()
            if isinstance(node, int):
                out.append((node, before))
                continue
            keys = sorted(node[1])
            todo += [(node[1][k], node[0] if j else before) for j, k in reversed(list(enumerate(keys)))]
        return out


def deep_shallow_sort(strings: list[bytes], shallow: int = SHALLOW) -> tuple[list[int], list[int]]:
    """(order, lcp): the sorted order of distinct strings, and each one's common prefix with the one before."""
    order: list[int] = []
    lcp: list[int] = []

    def put(i: int, before: int | None = None) -> None:
        lcp.append(0 if not order else common(strings[order[-1]], strings[i]) if before is None else before)
        order.append(i)

    todo = [(list(range(len(strings))), 0)]
    while todo:
        group, depth = todo.pop()
        if not group:
            continue
        if len(group) == 1:
            put(group[0])
        elif depth >= shallow:
            trie = BlindTrie(strings)
            for i in group:
                trie.insert(i)
            for j, (i, before) in enumerate(trie.ordered()):
                put(i, before if j else None)
        else:
            pivot = strings[group[len(group) // 2]][depth : depth + 8]
            less, same, more, ended = [], [], [], []
            for i in group:
                c = strings[i][depth : depth + 8]
                (less if c < pivot else more if c > pivot else ended if len(c) < 8 else same).append(i)
            todo += [(more, depth), (same, depth + 8), *((([i], depth)) for i in ended), (less, depth)]
    return order, lcp


def repeated(regions: list[tuple[bytes, int]], length: int) -> list[list[tuple[int, int]]]:
    """Ranges of repeated window starts of each of some distinct regions.

    A region is its bytes and where in them its anchor stands; all have one anchor gram.
    """
    right, left = [r[a:] for r, a in regions], [r[:a][::-1] for r, a in regions]
    out: list[list[tuple[int, int]]] = [[] for _ in regions]

    def mark(i: int, r: int, l: int) -> None:  # noqa: E741
        a = regions[i][1]
        first, last = max(a - l, 0), min(a - (length - r), len(regions[i][0]) - length)
        if first <= last:
            out[i].append((first, last))

    if len(regions) == 2:
        r, l = common(*right), common(*left)  # noqa: E741
        if r + l >= length:
            mark(0, r, l)
            mark(1, r, l)
        return out
    rights = list(dict.fromkeys(right))
    number = {s: i for i, s in enumerate(rights)}
    order, lcp = deep_shallow_sort(rights)
    owners: list[list[int]] = [[] for _ in rights]
    for i, s in enumerate(right):
        owners[number[s]].append(i)
    lefts = list(dict.fromkeys(left))
    l_number = {s: i for i, s in enumerate(lefts)}
    l_order, l_lcp = deep_shallow_sort(lefts)
    rank_of = {s: k for k, s in enumerate(l_order)}
    rank = [rank_of[l_number[s]] for s in left]

    def block(members: list[int], depth: int) -> None:
        """Members share `depth` bytes to the right of the anchor."""
        members = sorted(members, key=lambda i: rank[i])
        best = [0] * len(members)
        for j in range(len(members) - 1):
            a, b = rank[members[j]], rank[members[j + 1]]
            l = len(left[members[j]]) if a == b else min(l_lcp[a + 1 : b + 1])  # noqa: E741
            best[j], best[j + 1] = max(best[j], l), max(best[j + 1], l)
        for i, l in zip(members, best, strict=True):  # noqa: E741
            if depth + l >= length:
                mark(i, depth, l)

    for s, own in enumerate(owners):
        if len(own) > 1:
            block(own, len(rights[s]))
    depths = sorted({d for d in lcp[1:] if d >= GRAM}, reverse=True)
    for d in depths:
        lo = 0
        for k in range(1, len(order) + 1):
            if k == len(order) or lcp[k] < d:
                if k - lo > 1 and d in lcp[lo + 1 : k]:
                    block([i for s in order[lo:k] for i in owners[s]], d)
                lo = k
    return out


# --- anchors ----------------------------------------------------------------------------


def gram_hashes(data: np.ndarray, n: int, power: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Rolling hashes of n bytes by doubling; another odd power gives independent ones."""
    out, width = tb.BYTE_VALUE[data], 1
    total, have = None, 0
    while True:
        if n & width:
            part = out
            if total is None:
                total, have = part, width
            else:
                m = min(len(total), len(part) - have)
                total = total[: max(m, 0)] * tb.U64(power) + part[have : have + max(m, 0)]
                have += width
        if have == n or len(out) <= width:
            break
        out = out[:-width] * tb.U64(power) + out[width:]
        power = power * power % 2**64
        width *= 2
    return tb.mix64(total) if total is not None and have == n else np.zeros(0, tb.U64)


def _smallest(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each `width` consecutive entries."""
    if len(x) < width:
        return x[:0]
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray, offs: np.ndarray, length: int):
    """(row, gram hash, anchor, first start, last start) arrays of all regions; positions within rows."""
    h = gram_hashes(data, GRAM)
    mask = tb.U64((1 << POSITION_BITS) - 1)
    found = [np.zeros((0, 4), np.int64)]
    names = [np.zeros(0, tb.U64)]
    if len(h):
        low = _smallest((h & ~mask) | np.arange(len(h), dtype=tb.U64), length - GRAM + 1)
        at = (low & mask).astype(np.int64)
        starts = np.arange(len(at))
        row = np.searchsorted(offs, starts, "right") - 1
        ok = starts + length <= offs[row + 1]
        starts, at, row = starts[ok], at[ok], row[ok]
        if len(starts):
            fresh = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1) | (row[1:] != row[:-1])]))
            last = np.append(fresh[1:], len(starts)) - 1
            r = row[fresh]
            found.append(np.stack([r, at[fresh] - offs[r], starts[fresh] - offs[r], starts[last] - offs[r]], 1))
            names.append(h[at[fresh]])
    return np.concatenate(found), np.concatenate(names)


def _pieces(data: np.ndarray, offs: np.ndarray, length: int):
    """(first row, byte shift, bytes, offsets) blocks whose positions fit POSITION_BITS; long rows overlap by a window."""
    limit = 1 << POSITION_BITS
    for lo, hi in tb.blocks(offs, limit - 1):
        start, end = offs[lo], offs[hi]
        if end - start < limit:
            yield lo, 0, data[start:end], offs[lo : hi + 1] - start
            continue
        step = limit // 2
        for shift in range(0, end - start, step):
            part = data[start + shift : min(end, start + shift + step + length - 1)]
            yield lo, shift, part, np.array([0, len(part)])


ANCHORS = "key long, uid binary, at long, first long, last long, kind int"
COLUMNS = {"key": pa.int64(), "uid": pa.binary(), "at": pa.int64(), "first": pa.int64(), "last": pa.int64(), "kind": pa.int32(), "region": pa.binary()}
SECOND = 0xD1342543DE82EF95


def _table(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, COLUMNS[n]) for c, n in zip(cols, names, strict=True)], names=names)


def _key(uid: bytes) -> int:
    """Where the settled ranges of a document go."""
    return int.from_bytes(uid[:8], "big", signed=True)


def _scan(docs: DataFrame, length: int) -> DataFrame:
    def run(batches):
        met: dict[bytes, tuple | None] = {}
        for b in batches:
            uid = b.column("uid").to_pylist()
            data, offs = tb.text_buffers(b.column("text"))
            rows: list[tuple] = []
            for lo, shift, part, cut in _pieces(data, offs, length):
                found, names = anchors(part, cut, length)
                names = names.view(np.int64).tolist()
                raw = part.tobytes()
                for (r, at, first, last), key in zip(found.tolist(), names, strict=True):
                    base = int(cut[r])
                    name = hashlib.blake2b(raw[base + first : base + last + length], digest_size=16, key=(at - first).to_bytes(8, "big")).digest()
                    here = (uid[lo + r], at + shift, first + shift, last + shift)
                    if len(met) > MET:
                        met.clear()
                    if met.get(name) == here:
                        continue  # a row that repeats a document
                    if name in met:
                        rows.append((_key(here[0]), *here, SETTLED))
                        if met[name] is not None:  # the one that was sent is settled now, too
                            rows.append((_key(met[name][0]), *met[name], SETTLED))
                            met[name] = None
                    else:
                        met[name] = here
                        rows.append((key, *here, REGION))
            yield _table(rows, list(COLUMNS)[:6])

    return docs.select("uid", "text").mapInArrow(tb.task(run), ANCHORS)


def _live(batches):
    """Of regions sorted by (kind, key) those whose key occurs again; those of a large group are to go by windows."""
    held: list[pa.RecordBatch] = []  # the last key's rows, until it is known to be large
    key_of, size = None, 0

    def sent(rows: pa.RecordBatch) -> pa.RecordBatch:
        return rows.set_column(5, "kind", pa.array(np.full(rows.num_rows, WINDOW if size > MAX_GROUP else REGION, np.int32)))

    for b in batches:
        kind = np.asarray(b.column("kind"))
        if len(settled := np.flatnonzero(kind == SETTLED)):
            yield b.take(pa.array(settled))
            b = b.take(pa.array(np.flatnonzero(kind != SETTLED)))
        key = np.asarray(b.column("key"))
        if not len(key):
            continue
        cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])).tolist()
        for s, e in zip(cut, [*cut[1:], len(key)], strict=True):
            if key[s] != key_of:
                if size > 1:
                    yield from map(sent, held)
                held, key_of, size = [], key[s], 0
            held.append(b.slice(s, e - s))
            size += e - s
            if size > MAX_GROUP:
                yield from map(sent, held)
                held = []
    if size > 1:
        yield from map(sent, held)


CONTEXTS = "key long, uid binary, at long, first long, last long, kind int, region binary"


def _contexts(length: int):
    """From texts and their regions: the bytes of regions, hashes of the windows of large groups, and settled ranges."""

    def run(batches):
        for b in batches:
            rows: list[tuple] = []
            held = 0
            for uid, text, found in zip(*(b.column(c).to_pylist() for c in ("uid", "text", "found")), strict=True):
                raw = text.encode()
                done = []
                for x in found:
                    first, last = x["first"], x["last"]
                    part = raw[first : last + length]
                    if x["kind"] == REGION:
                        rows.append((x["key"], uid, x["at"], first, last, REGION, part))
                        held += len(part)
                    elif x["kind"] == WINDOW:
                        data = np.frombuffer(part, np.uint8)
                        one, two = (gram_hashes(data, length, *p).view(np.int64).tolist() for p in ((), (SECOND,)))
                        rows += [(h, uid, g, first + o, first + o, WINDOW, None) for o, (h, g) in enumerate(zip(one, two, strict=True))]
                    else:
                        done.append((first, last))
                rows += [(_key(uid), uid, 0, s, e, SETTLED, None) for s, e in _joined(done)]
                if held > 4 << 20 or len(rows) > 20_000:
                    yield _table(rows, list(COLUMNS))
                    rows, held = [], 0
            yield _table(rows, list(COLUMNS))

    return run


def _joined(ranges) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [tuple(x) for x in out]


RANGES = "uid binary, first long, last long"


def _decide(length: int):
    """From rows sorted by (kind, key, at): ranges of window starts that are repeated; a window's second hash stands in at."""

    def group(rows: list[tuple], out: list[tuple]) -> None:
        same: dict[tuple[bytes, int], list[tuple]] = {}
        for r in dict.fromkeys(rows):  # a row that repeats a document is no other place
            same.setdefault((r[4], r[1] - r[2]), []).append(r)
        for own in same.values():
            if len(own) > 1:
                out += [(r[0], r[2], r[3]) for r in own]
        if len(same) > 1:
            for own, ranges in zip(same.values(), repeated(list(same), length), strict=True):
                if len(own) == 1:
                    out += [(own[0][0], own[0][2] + s, own[0][2] + e) for s, e in _joined(ranges)]

    def run(batches):
        rows: list[tuple] = []
        at = None
        window = None  # (both hashes, row or None if it has been sent)
        for b in batches:
            out: list[tuple] = []
            for key, kind, *r in zip(*(b.column(c).to_pylist() for c in ("key", "kind", "uid", "at", "first", "last", "region")), strict=True):
                if kind == SETTLED:
                    out.append((r[0], r[2], r[3]))
                elif kind == WINDOW:
                    here, name = (r[0], r[2], r[3]), (key, r[1])
                    if window is not None and window == (name, here):
                        continue
                    if window is not None and window[0] == name:
                        out += [here] if window[1] is None else [window[1], here]
                        window = (name, None)
                    else:
                        window = (name, here)
                else:
                    if key != at:
                        if len(rows) > 1:
                            group(rows, out)
                        rows, at = [], key
                    rows.append(tuple(r))
            yield _ranges(out)
        out = []
        if len(rows) > 1:
            group(rows, out)
        yield _ranges(out)

    return run


def _ranges(rows: list[tuple]) -> pa.RecordBatch:
    return _table(rows, ["uid", "first", "last"])


# --- the operator -----------------------------------------------------------------------


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, spans (byte ranges removed), kept (the bytes left), text (the whole characters left) of every row."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    prepare(docs.sparkSession)
    name = F.unhex(F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text"))))
    # Never null, and known to be: else one of the joins would filter the texts first and not share the other's exchange.
    d = docs.select(F.coalesce(name, F.lit(b"")).alias("uid"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    live = spread(_scan(d, length), "key").sortWithinPartitions("kind", "key").mapInArrow(tb.task(_live), ANCHORS)
    found = live.groupBy("uid").agg(F.collect_list(F.struct("key", "at", "first", "last", "kind")).alias("found"))
    # Rows that repeat a document have its uid; their regions are its own, once.
    found = found.withColumn("found", F.array_distinct("found"))
    contexts = d.join(found, "uid").mapInArrow(tb.task(_contexts(length)), CONTEXTS)
    ranges = spread(contexts, "key").sortWithinPartitions("kind", "key", "at", "uid", "first").mapInArrow(tb.task(_decide(length)), RANGES)
    spans = ranges.groupBy("uid").agg(F.collect_list(F.struct("first", "last")).alias("ranges"))

    def cut(batches):
        for b in batches:
            n, out, kept, whole = [], [], [], []
            for text, got in zip(b.column("text").to_pylist(), b.column("ranges").to_pylist(), strict=True):
                raw = text.encode()
                cover: list[list[int]] = []
                for x in sorted((x["first"], x["last"] + length) for x in got or ()):
                    if cover and x[0] <= cover[-1][1]:
                        cover[-1][1] = max(cover[-1][1], x[1])
                    else:
                        cover.append(list(x))
                at, parts = 0, []
                for s, e in cover:
                    parts.append(raw[at:s])
                    at = e
                n.append(len(raw))
                out.append(cover)
                parts.append(raw[at:])
                kept.append(b"".join(parts))
                whole.append("".join(p.decode("utf-8", "ignore") for p in parts) if cover else text)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(out, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary()), pa.array(whole, pa.string())], names=["doc_id", "n_bytes", "spans", "kept", "text"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("kept", T.BinaryType()), T.StructField("text", T.StringType())])
    return d.join(spans, "uid", "left").mapInArrow(tb.task(cut), schema)


def digest(deduped: DataFrame) -> DataFrame:
    """Counts, a digest of the bytes left, whether any went, and the text left, without characters that a cut has split."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return deduped.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), (F.size("spans") > 0).alias("has_repeats"), "text")
