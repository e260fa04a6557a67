"""N-gram Jaccard join by parity sketches.

A document's set holds its distinct 5-word shingles; two documents link when
100 * |A and B| >= 75 * |A or B|.  Then |A xor B| <= (|A| + |B|) / 7, and that many bits at
most differ between sketches into which every shingle flips one bit (XOR), as each element
of A xor B flips one.

*Pigeonhole join.*  Sizes fall into bands, and sets whose partners may lie in the next band
join there too.  In a band a sketch is cut into fewer pieces than a set has members, kept
sparse: a piece is the XOR of its members' 64-bit hashes.  At most D pieces of linked sets
differ, so under any common order of pieces each has an equal non-empty piece among its
first D + 1.  Those D + 1 are the join keys; pieces made of very frequent shingles come last
in the order, so passages that many documents share seldom are keys.  A set with no more
than D non-empty pieces, which is rare, could differ in all of them: sets of its size and
of its possible partners' sizes then also meet by single shingles, of which the same holds
for certain.  Below the first band every shingle is a piece of its own.

*Verification.*  Documents with equal sets collapse first.  The members of a group of equal
keys meet its smallest set, and the smallest one that has the same minimum under each of
four hash orders of its shingles; since near copies share most minima, large groups of
copies end in few components for as many rows as they have members.  Members of groups that
still hold several components are then compared by a join whose condition is a size filter
and the Hamming distance of parity sketches of two bits a shingle, and each pair that passes
in any of these ways is verified by exact intersection.  So every linked pair ends in one
component.  The comparisons of the last join, not its rows, grow with the square of a group
that stays divided; adaptive execution splits such a group over tasks.

Sets are known by 64-bit hashes.  What is broadcast is bounded by constants: 2^20 frequency
levels, a 2^24-bit filter of the sets to fetch, which when full lets all pass, and in
`keep_one` MAX_BROADCAST ids, beyond which documents shuffle once by id.  In `linked` texts
never shuffle; only keys, and the sets of candidates, do.

Defined cases: null text and text without words have size 0 and link with nothing; fewer
than 5 words are one shingle; a very long text is one set, whose hashes are held at once by
the task that makes it; equal sets tie and are one node; a null doc_id links by its text but
is never a component's name unless alone; repeated rows each get a row; an empty table gives
an empty result; other columns are ignored, and kept by `keep_one`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.overlap import components
from ..sources.tables import remove_path, setting, written, written_some
from . import textbatch as tb
from .runtime import prepare, spread

WORDS = 5
PERCENT = 75
#: Sizes at which bands begin; below the first every shingle is a piece of its own.
FIRST_BAND, RATIO = 16, 2
#: Pieces an element of the band's largest set, for bands up to and above 128.
FINE, COARSE = 0.7, 0.4
HOT_BITS = 20
FILTER_BITS = 24
SALTS = 32
SKETCH_WORDS = 8
LONG_RUN = 100_000
MAX_BROADCAST = 1 << 20  # ids of 8 bytes, some 24 in a hash table
#: Size on disk up to which a table is broadcast while links are sought; there are some thirty joins, and the driver holds what they broadcast.
BROADCAST = "256k"
#: Multipliers of the hash orders whose minima are compared.
ORDERS = tb.mix64(np.arange(1, 5, dtype=np.uint64)) | tb.U64(1)
#: Key of the rows that name sizes of sets with too few pieces.
THIN = 0


def bands(n: int, percent: int = PERCENT) -> list[tuple[int, int, int]]:
    """(band, pieces or 0 for one a shingle, D) of every band that a set of size n joins in."""
    largest = 100 * n // percent
    out, lo, band = [], 0, 0
    hi = FIRST_BAND
    while lo <= largest:
        if n < hi and (n >= lo or largest >= lo):
            top = min(largest, hi - 1)
            out.append((band, 0 if not band else int((FINE if hi <= 128 else COARSE) * hi) + 1, (n + top) * (100 - percent) // (100 + percent)))
        lo, hi, band = hi, hi * RATIO, band + 1
    return out


def join_keys(h: np.ndarray, level: np.ndarray, percent: int = PERCENT, plain: bool = False) -> tuple[np.ndarray, bool]:
    """(keys, some band's pieces are too few) of a set of distinct shingle hashes with their frequency levels."""
    out, thin = [], False
    for band, pieces, most in bands(len(h), percent):
        x = tb.mix64(h + tb.U64((0x9E3779B97F4A7C15 * (2 * band + plain + 1)) % 2**64))
        if not pieces or plain:
            key, lev, at = x, level, x
        else:
            at = x % tb.U64(pieces)
            order = np.argsort(at, kind="stable")
            at = at[order]
            cut = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            at = at[cut]
            key = tb.mix64(np.bitwise_xor.reduceat(x[order], cut) + at)
            lev = np.minimum.reduceat(level[order], cut)
            thin = thin or len(key) <= most
        if len(key) > most + 1:
            key = key[np.lexsort((at, lev))[: most + 1]]
        out.append(key | tb.U64(1))
    return np.concatenate(out) if out else np.zeros(0, tb.U64), thin


def parity(h: np.ndarray, n_words: int = SKETCH_WORDS) -> np.ndarray:
    """The dense sketch: each shingle flips one of 64 * n_words bits; XOR of its halves is the sketch of half the size."""
    flips = np.bincount((h >> tb.U64(3)) & tb.U64(64 * n_words - 1), minlength=64 * n_words).astype(np.uint8) & 1
    return np.packbits(flips).view(np.int64)


def wide(h: np.ndarray) -> np.ndarray:
    """A dense sketch of two bits a shingle or more, and 512 bits at least."""
    return parity(h, max(SKETCH_WORDS, 1 << max(0, (len(h) - 1) // 32).bit_length()))


def minima(h: np.ndarray) -> np.ndarray:
    """The smallest hash under each of the orders."""
    return np.array([(h * m).min() for m in ORDERS]) if len(h) else ORDERS


def set_hash(h: np.ndarray) -> int:
    return int(tb.mix64(np.array([tb.mix64(h).sum(dtype=tb.U64) + tb.U64(len(h))]))[0].view(np.int64)) if len(h) else 0


def _sets(column: pa.Array, words: int):
    """(row, ascending distinct shingle hashes) of every row."""
    data, offs = tb.text_buffers(column)
    for lo, hi in tb.blocks(offs):
        w = tb.Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], tb.NONSPACE)
        g, row = tb.shingle_hashes(w, w.hashes(), words)
        order = np.argsort(row, kind="stable")
        g = g[order]
        cut = np.searchsorted(row[order], np.arange(hi - lo + 1))
        for r in range(hi - lo):
            yield lo + r, np.unique(g[cut[r] : cut[r + 1]])


def _long(x) -> pa.Array:
    return pa.array(np.asarray(x).view(np.int64) if len(x) else np.zeros(0, np.int64))


def measure(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n, node (hash of the set), sketch, wide sketch and minima of each row, and rows of n = -1: frequent hash buckets of a task with their counts."""
    longs = pa.list_(pa.int64())

    def run(batches):
        seen: set[int] = set()
        counts = np.zeros(1 << HOT_BITS, np.int64)
        for b in batches:
            n, node, sketch, broad, least = [], [], [], [], []
            for _, h in _sets(b.column("text"), words):
                k = set_hash(h)
                n.append(len(h))
                node.append(k)
                sketch.append(parity(h))
                broad.append(wide(h))
                least.append(minima(h).view(np.int64))
                if k not in seen:
                    seen.add(k)
                    np.add.at(counts, (h >> tb.U64(64 - HOT_BITS)).astype(np.int64), 1)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(node, pa.int64()), pa.array(sketch, longs), pa.array(broad, longs), pa.array(least, longs)], names=MEASURED)
        hot = np.flatnonzero(counts >= 4 + 4 * counts.mean())
        yield pa.RecordBatch.from_arrays([_long(counts[hot]), pa.array(np.full(len(hot), -1)), _long(hot), *[pa.nulls(len(hot), longs)] * 3], names=MEASURED)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tb.task(run), "doc_id long, n long, node long, sketch array<long>, wide array<long>, minima array<long>")


MEASURED = ["doc_id", "n", "node", "sketch", "wide", "minima"]


def _levels(measured: DataFrame) -> np.ndarray:
    """By hash bucket, the logarithm of how much more frequent than the mean it is."""
    total = measured.where("n > 0").agg(F.sum("n")).first()[0] or 0
    levels = np.zeros(1 << HOT_BITS, np.uint8)
    hot = measured.where("n = -1").groupBy("node").agg(F.sum("doc_id").alias("c")).toArrow()
    more = hot["c"].to_numpy() / max(1.0, total / len(levels))
    levels[hot["node"].to_numpy()] = np.log2(np.maximum(1.0, more)).astype(np.uint8)
    return levels


def candidate_groups(docs: DataFrame, levels: np.ndarray, words: int = WORDS, percent: int = PERCENT, plain: tuple[int, int] | None = None) -> DataFrame:
    """grp, node, size: the members of every group of equal keys of two or more sets.

    Groups of the same smallest member are one group, named by it: the many keys that near
    copies share make one group, not one a key.  Rows without a node give the sizes of sets
    of too few pieces.  With plain, sets of sizes from the first to the second number meet
    by single shingles.
    """
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def emit(batches):
        seen: set[int] = set()
        thin: set[int] = set()
        for b in batches:
            keys, nodes, size = [], [], []
            for _, h in _sets(b.column("text"), words):
                if not len(h) or plain and not plain[0] <= len(h) <= plain[1] or (k := set_hash(h)) in seen:
                    continue
                seen.add(k)
                key, few = join_keys(h, shared.value[(h >> tb.U64(64 - HOT_BITS)).astype(np.int64)], percent, plain is not None)
                if few:
                    thin.add(len(h))
                keys.append(key)
                nodes.append(k)
                size.append(len(key))
                if sum(size[-64:]) > 500_000:
                    yield _keyed(keys, nodes, size)
                    keys, nodes, size = [], [], []
            yield _keyed(keys, nodes, size)
        yield pa.RecordBatch.from_arrays([_long(np.full(len(thin), THIN)), _long(np.array(sorted(thin), np.int64))], names=["key", "node"])

    def match(batches):
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64))  # the last run so far
        streaming = None  # (key, smallest, last) of a run too long to hold
        for b in batches:
            key, node = np.asarray(b.column("key")), np.asarray(b.column("node"))
            if len(at := np.flatnonzero(key == THIN)):
                yield _members(np.full(len(at), THIN), node[at], size=True)
                key, node = key[key != THIN], node[key != THIN]
            if streaming is not None:
                end = int(np.searchsorted(key != streaming[0], True)) if (key != streaming[0]).any() else len(key)
                part = np.unique(node[:end])
                part = part[part != streaming[2]]
                yield _members(np.full(len(part), streaming[1]), part)
                if end == len(key):
                    if len(part):
                        streaming = (*streaming[:2], part[-1])
                    continue
                key, node, streaming = key[end:], node[end:], None
            key, node = np.concatenate([held[0], key]), np.concatenate([held[1], node])
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            if len(key) - last > LONG_RUN:
                part = np.unique(node[last:])
                yield _members(np.full(len(part), part[0]), part)
                streaming = (key[-1], part[0], part[-1])
                held = (np.zeros(0, np.int64), np.zeros(0, np.int64))
            else:
                held = (key[last:].copy(), node[last:].copy())
            yield _runs(key[:last], node[:last])
        yield _runs(*held)

    keyed = docs.select("text").mapInArrow(tb.task(emit), "key long, node long")
    return spread(keyed, "key").sortWithinPartitions("key", "node").mapInArrow(tb.task(match), "grp long, node long, size long").distinct()


def _keyed(keys: list, nodes: list, size: list) -> pa.RecordBatch:
    key = np.concatenate(keys) if keys else np.zeros(0, tb.U64)
    return pa.RecordBatch.from_arrays([_long(key), _long(np.repeat(np.array(nodes, np.int64), size))], names=["key", "node"])


def _members(grp, node, size: bool = False) -> pa.RecordBatch:
    none = pa.nulls(len(grp), pa.int64())
    return pa.RecordBatch.from_arrays([_long(grp), none if size else _long(node), _long(node) if size else none], names=["grp", "node", "size"])


def _runs(key: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
    """Members of the runs of two or more nodes, of rows sorted by (key, node)."""
    if len(key) < 2:
        return _members(*[np.zeros(0, np.int64)] * 2)
    fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
    key, node = key[fresh], node[fresh]
    cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(cut, len(key)))
    keep = np.repeat(size > 1, size)
    rows = np.stack([np.repeat(node[cut], size), node], 1)[keep]
    if len(rows):
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        rows = rows[np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)])]
    return _members(*(np.ascontiguousarray(rows[:, i]) for i in range(2)))


def fetch_sets(docs: DataFrame, nodes: DataFrame, words: int = WORDS) -> DataFrame:
    """node, size, shingles of the given nodes; a bounded filter keeps most others from the shuffle."""
    bits = F.expr(f"node & {(1 << FILTER_BITS) - 1}")
    filled = nodes.select(bits.alias("p")).groupBy(F.expr("p div 64").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("m")).toArrow()
    wanted = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    wanted[filled["w"].to_numpy()] = filled["m"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            rows: list[tuple] = []
            for _, h in _sets(b.column("text"), words):
                if not len(h):
                    continue
                k = set_hash(h)
                p = k & ((1 << FILTER_BITS) - 1)
                if k in seen or not int(shared.value[p >> 6]) >> (p & 63) & 1:
                    continue
                seen.add(k)
                rows.append((k, len(h), h.view(np.int64)))
                if len(rows) == 200:
                    yield _fetched(rows)
                    rows = []
            yield _fetched(rows)

    found = docs.select("text").mapInArrow(tb.task(run), "node long, size long, shingles array<long>")
    return found.join(nodes, "node", "left_semi").dropDuplicates(["node"])


def _fetched(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [[]] * 3
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64()))], names=["node", "size", "shingles"])


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The (a, b) pairs that link.  A hub b meets its partners in SALTS parts."""
    p = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)))
    a = p.join(sets.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("shingles").alias("set_a")), "a")
    b = p.select("b", "salt").distinct().join(sets.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("shingles").alias("set_b")), "b")
    both = a.join(b, ["b", "salt"]).where((F.col("size_a") * 100 >= F.col("size_b") * percent) & (F.col("size_b") * 100 >= F.col("size_a") * percent))
    i = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(100 * i >= percent * (F.col("size_a") + F.col("size_b") - i)).select("a", "b")


def _near(percent: int, l: str, r: str, far: F.Column) -> F.Column:  # noqa: E741
    m, n = F.col(f"{l}.size"), F.col(f"{r}.size")
    sizes = (m * 100 >= n * percent) & (n * 100 >= m * percent)
    return F.when(~sizes, False).otherwise(far * (100 + percent) <= (m + n) * (100 - percent))


def distance(l: str, r: str) -> F.Column:  # noqa: E741
    """Hamming distance of the short sketches of rows l and r.  A few compiled instructions."""
    x, y = F.col(f"{l}.sketch"), F.col(f"{r}.sketch")
    far = F.lit(0)
    for i in range(SKETCH_WORDS):
        far = far + F.bit_count(x[i].bitwiseXOR(y[i]))
    return far


def close(percent: int, l: str, r: str) -> F.Column:  # noqa: E741
    """Can the sets of rows l and r link, by size and the distance of their short sketches?"""
    return _near(percent, l, r, distance(l, r))


def closer(percent: int, l: str, r: str) -> F.Column:  # noqa: E741
    """The same by the wide sketches; those of unlike width are compared at the smaller one, the larger folded once."""

    def fitted(a, b):
        half = (F.size(a) / 2).cast("int")
        folded = F.zip_with(F.slice(a, F.lit(1), half), F.slice(a, half + 1, half), lambda p, q: p.bitwiseXOR(q))
        return F.when(F.size(a) > F.size(b), folded).otherwise(a)

    x, y = F.col(f"{l}.wide"), F.col(f"{r}.wide")
    return _near(percent, l, r, F.aggregate(F.zip_with(fitted(x, y), fitted(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda t, d: t + d))


def stars(groups: DataFrame, known: DataFrame) -> DataFrame:
    """a, b: each member of a group with the group's smallest one, and with the smallest of those that share one of its minima."""
    centres = groups.where("node <> grp").select(F.col("node").alias("a"), F.col("grp").alias("b"))
    rows = groups.select("grp", "node").join(known.select("node", "minima"), "node").select("grp", "node", F.posexplode("minima").alias("nth", "least"))
    first = rows.groupBy("grp", "nth", "least").agg(F.min("node").alias("b"), F.max("node").alias("other")).where("b <> other").drop("other")
    near = rows.join(first, ["grp", "nth", "least"]).where("node <> b").select(F.col("node").alias("a"), "b")
    return centres.unionByName(near).distinct()


def split(groups: DataFrame, comps: DataFrame) -> DataFrame:
    """grp, node, comp of the groups that hold several components."""
    named = groups.select("grp", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    several = named.groupBy("grp").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x <> y").select("grp")
    return named.join(several, "grp")


def facing(named: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """a, b: members of one group, in different components, whose sketches let them link.

    Both sides are one exchange by group; a hot group is split by adaptive execution.
    """
    rows = named.join(known.select("node", "size", "sketch", "wide"), "node")
    other = (F.col("l.grp") == F.col("r.grp")) & (F.col("l.node") < F.col("r.node")) & (F.col("l.comp") != F.col("r.comp"))
    return rows.alias("l").join(rows.alias("r"), other & close(percent, "l", "r") & closer(percent, "l", "r")).select(F.col("l.node").alias("b"), F.col("r.node").alias("a")).distinct()


def _named(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """_names() with only small tables broadcast: those of a few MB on disk are tens of MB of the driver's memory each."""
    with setting(docs.sparkSession, "spark.sql.autoBroadcastJoinThreshold", BROADCAST), setting(docs.sparkSession, "spark.sql.adaptive.autoBroadcastJoinThreshold", BROADCAST):
        return _names(docs, words, percent)


def _names(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(measured rows; node, component_id, kept_node and kept_id of the sets that several rows have or that link).

    The row of a component that stays has its smallest doc_id (null last), and then its smallest node.
    """
    spark = docs.sparkSession
    prepare(spark)
    made: list[str] = []  # tables that go when the names are known

    def keep(df: DataFrame, name: str) -> DataFrame:
        return keep_some(df, name)[0]

    def keep_some(df: DataFrame, name: str) -> tuple[DataFrame, bool]:
        table, path, some = written_some(df, name)
        made.append(path)
        return table, some

    measured, _ = written(measure(docs, words), "measured")
    levels = _levels(measured)
    found = keep(candidate_groups(docs, levels, words, percent), "groups")
    thin = found.where(F.col("node").isNull()).agg(F.min("size"), F.max("size")).first()
    groups = found.where(F.col("node").isNotNull()).select("grp", "node")
    if thin[0] is not None:
        sizes = (thin[0] * percent // 100, -(-thin[1] * 100 // percent))
        groups = groups.unionByName(keep(candidate_groups(docs, levels, words, percent, sizes), "groups").select("grp", "node")).distinct()
    members = groups.select("node").distinct()
    known = keep(measured.where("n > 0").select("node", F.col("n").alias("size"), "sketch", "wide", "minima").join(members, "node", "left_semi").dropDuplicates(["node"]), "known")

    def likely(pairs: DataFrame) -> DataFrame:
        """The (a, b) pairs that their sketches don't rule out."""
        ends = pairs.join(known.alias("l"), F.col("a") == F.col("l.node")).join(known.alias("r"), F.col("b") == F.col("r.node"))
        return ends.where(close(percent, "l", "r") & closer(percent, "l", "r")).select("a", "b")

    def links(pairs: DataFrame, name: str) -> tuple[DataFrame, bool]:
        """(the (a, b) pairs that link, there are some); only the sets that these need are fetched."""
        pairs, some = keep_some(pairs, name)
        if not some:
            return pairs, False
        return keep_some(verify(pairs, fetch_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), words), percent), name)

    def joined(edges: DataFrame) -> DataFrame:
        nodes = edges.select(F.explode(F.array("a", "b")).alias("id"))
        return components(nodes, edges).select(F.col("id").alias("node"), F.col("component").alias("comp"))

    edges, _ = links(likely(stars(groups, known)), "stars")
    comps = joined(edges)
    more, some = links(facing(split(groups, comps), known, percent), "facing")
    if some:
        comps = joined(edges.unionByName(more))
    classes = measured.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("many"))
    chosen = keep(classes.join(comps, "node", "left").where("many > 1 or comp is not null").withColumn("comp", F.coalesce("comp", "node")).select("node", "comp", "first"), "chosen")
    best = F.min(F.struct(F.col("first").isNull(), "first", "node"))
    kept = chosen.groupBy("comp").agg(F.min("first").alias("component_id"), best.alias("best")).select("comp", "component_id", F.col("best.node").alias("kept_node"), F.col("best.first").alias("kept_id"))
    names, _ = written(chosen.join(kept, "comp").select("node", "component_id", "kept_node", "kept_id"), "names")
    for path in made:
        remove_path(spark, path)
    return measured, names


def _met(measured: DataFrame, names: DataFrame) -> DataFrame:
    """The measured rows with their names; a set that a third of all rows have is met in SALTS parts.

    Names have SALTS rows each then, which their size on disk does not tell, so they are never broadcast.
    """
    salted = names.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = measured.where("n >= 0").select("doc_id", "n", "node", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int").alias("salt"))
    return rows.join(salted.hint("merge"), ["node", "salt"], "left")


def linked(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of docs."""
    return _met(*_named(docs, words, percent)).select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def with_node(docs: DataFrame, name: str, words: int = WORDS) -> DataFrame:
    """docs with a further column, the hash of each row's set."""

    def run(batches):
        for b in batches:
            nodes = pa.array([set_hash(h) for _, h in _sets(b.column("text"), words)], pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, nodes], names=[*b.schema.names, name])

    return docs.mapInArrow(tb.task(run), T.StructType([*[T.StructField(f.name, f.dataType, True) for f in docs.schema], T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with one row of each component, that of the smallest doc_id; all columns kept.

    Rows are told apart by doc_id and set, so one that shares its doc_id with a near copy of
    others stays if its own text links with nothing.  Texts meet the ids of rows that go; only
    rows whose doc_id is null or has several rows, one of which is linked, are looked at by
    their sets.  Rows without a shingle stay.
    """
    spark = docs.sparkSession
    measured, names = _named(docs, words, percent)
    stays = (F.col("node") == F.col("kept_node")) & F.col("doc_id").eqNullSafe(F.col("kept_id"))
    state = F.when(F.col("kept_node").isNull(), 0).when(stays, 1).otherwise(2)  # linked with nothing, the one that stays, one that goes
    found, found_at = written(_met(measured, names).select("doc_id", "node", state.alias("state")), "linked")
    ids = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("c"), F.max("state").alias("most"))
    looked, _ = written(ids.where("most > 0 and (c > 1 or doc_id is null)").select("doc_id"), "again")
    gone, _ = written(ids.where("most = 2 and c = 1 and doc_id is not null").select("doc_id"), "gone")
    pairs, _ = written(found.where("state > 0").join(looked.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")), "left_semi").groupBy("doc_id", "node").agg(F.max("state").alias("state")), "pairs")
    remove_path(spark, found_at)
    n_looked, n_gone = looked.count(), gone.count()
    own = lambda name: "_" * max(map(len, docs.columns)) + name  # noqa: E731  no column of docs has such a name

    def some(ids: DataFrame, n: int) -> DataFrame:
        """Ids that are broadcast if there are MAX_BROADCAST or fewer, so that texts needn't shuffle."""
        ids = ids.select(F.col("doc_id").alias(own("id")))
        return F.broadcast(ids) if n <= MAX_BROADCAST else ids

    same = F.col("doc_id").cast("long") == F.col(own("id"))
    out = docs.join(some(gone.unionByName(looked), n_looked + n_gone), same, "left_anti")
    if n_looked:
        null = not looked.where("doc_id is null").isEmpty()
        several = docs.join(some(looked, n_looked), same, "left_semi")
        if null:
            out, several = out.where(F.col("doc_id").isNotNull()), several.unionByName(docs.where(F.col("doc_id").isNull()))
        decided = pairs.select(F.col("doc_id").alias(own("id")), F.col("node").alias(own("set")), F.col("state").alias(own("state"))).hint("merge")
        met = with_node(several, own("node"), words).join(decided, F.col("doc_id").cast("long").eqNullSafe(F.col(own("id"))) & (F.col(own("node")) == F.col(own("set"))), "left")
        alone = met.where(F.col(own("state")).isNull())
        once = met.where(F.col(own("state")) == 1).dropDuplicates(["doc_id", own("node")])
        out = out.unionByName(alone.unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns]))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
