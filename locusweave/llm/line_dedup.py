"""Line dedup by site-relative frequency, in built-in functions only.

Rows are grouped by host.  For each line (white space at its ends ignored) the pages of a
host that contain it are counted, once a page, and divided by the host's number of pages;
lines above `max_ratio` that stand on at least `min_pages` pages are boilerplate and go.
With `copies_once`, pages of a host with equal text count as one page, above and below the
line of the fraction, so copies of a document are no evidence that its lines are
boilerplate; pages whose texts differ at all are still separate pages.

Counting sends one (host, line hash) row per distinct line and map task.  A host has at
most (mean lines a page) / max_ratio boilerplate lines, so they fit one array a host.  These
lists are written and measured: MAX_BROADCAST keys or fewer are broadcast, and texts don't
shuffle at all; more of them meet the pages by (host, salt), with as many salts as the
largest host has times PAGES_A_TASK pages.  With `copies_once` the line hashes of each
distinct text go to one task first.  Lines are filtered in place, in order; a page's lines
are looked up in its host's list by one hash set a page.

Defined cases: a null host is a host of its own; null text is a page without lines and
stays null; empty lines are kept and never counted; a very long text is one row, whose lines
are an array in its task; a line that stands exactly at the ratio stays, so ties with it
don't matter; repeated rows are separate pages; an empty table gives an empty result; other
columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written

MAX_RATIO = 0.02
MIN_PAGES = 5
#: Keys of 16 bytes (some 40 as rows) that are broadcast at most, and pages of a host that one task gets beyond.
MAX_BROADCAST = 1 << 20
PAGES_A_TASK = 200_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """128 bits of a trimmed line."""
    return F.struct(F.xxhash64(F.trim(line)).alias("a"), F.xxhash64(F.trim(line), F.lit(1)).alias("b"))


def boilerplate(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, copies_once: bool = False) -> DataFrame:
    """_host (a struct, so that a null host equals itself), _pages, _drop: the keys of the host's boilerplate lines."""
    d = docs.select(F.struct(F.col(host).alias("h")).alias("_host"), F.col("text").alias("_text"))
    # Distinct by sorting, which takes n log n steps for a page of n lines; array_distinct of structs takes n * n.
    ordered = F.sort_array(F.transform(F.filter(_lines(F.col("_text")), lambda x: F.trim(x) != ""), _key))
    keys = F.get(F.transform(F.array(ordered), lambda s: F.filter(s, lambda x, i: (i == 0) | (x != F.get(s, i - 1)))), F.lit(0))
    if copies_once:
        texts = d.select("_host", F.xxhash64("_text").alias("_a"), F.xxhash64("_text", F.lit(1)).alias("_b"), keys.alias("_keys")).groupBy("_host", "_a", "_b")
        d, lines = texts.agg(F.lit(1).alias("_one")), texts.agg(F.first("_keys").alias("_keys")).select("_host", F.explode("_keys").alias("_k"))
    else:
        lines = d.select("_host", F.explode(keys).alias("_k"))
    pages = d.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    counts = lines.groupBy("_host", "_k.a", "_k.b").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_pages)
    over = counts.join(pages, "_host").where(F.col("_n") > F.lit(max_ratio) * F.col("_pages"))
    return over.groupBy("_host").agg(F.first("_pages").alias("_pages"), F.array_sort(F.collect_list(F.struct("a", "b"))).alias("_drop"))


def remove(docs: DataFrame, host: str = "source", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES, counted: str | None = "_n_dropped", copies_once: bool = False) -> DataFrame:
    """docs with boilerplate lines gone from text; n_chars, if there, is set anew.

    counted names a further column with the number of lines dropped, in place of one of that name, or is None.
    """
    drop, _ = written(boilerplate(docs, host, max_ratio, min_pages, copies_once), "lines")
    size = drop.agg(F.sum(F.size("_drop")).alias("keys"), F.max("_pages").alias("pages")).first()
    own = lambda name: "_" * max(map(len, docs.columns)) + name  # noqa: E731  no column of docs has such a name
    drop = drop.select(F.col("_host").alias(own("host")), F.col("_drop").alias(own("drop")))
    d = docs.withColumn(own("host"), F.struct(F.col(host).alias("h")))
    if (size["keys"] or 0) <= MAX_BROADCAST:
        joined = d.join(F.broadcast(drop), own("host"), "left")
    else:
        salts = -(-size["pages"] // PAGES_A_TASK)
        spread = drop.withColumn(own("salt"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = d.withColumn(own("salt"), F.pmod(F.xxhash64("text"), F.lit(salts)).cast("int")).join(spread, [own("host"), own("salt")], "left")
    # Long hashes meet in a hash set; the whole keys of the few lines that it finds decide.
    # What is found is bound as a lambda's variable, so it is worked out once a page.
    lines, dropped = _lines(F.col("text")), F.col(own("drop"))
    maybe = F.array_intersect(F.transform(lines, lambda x: F.xxhash64(F.trim(x))), F.transform(dropped, lambda k: k["a"]))
    stays = lambda m: F.filter(lines, lambda x: ~(F.array_contains(m, F.xxhash64(F.trim(x))) & F.array_contains(dropped, _key(x))))
    out = joined.withColumn(own("lines"), F.get(F.transform(F.array(maybe), lambda m: F.when(F.size(m) > 0, stays(m))), F.lit(0)))
    kept = F.col(own("lines"))
    n_dropped = F.when(kept.isNull(), 0).otherwise(F.size(_lines(F.col("text"))) - F.size(kept)).cast("long")
    text = F.when(kept.isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(text.alias("text"))
        elif c == "n_chars":
            columns.append(F.when(n_dropped > 0, F.length(text)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType).alias("n_chars"))
        elif c != counted:
            columns.append(F.col(f"`{c}`"))
    return out.select(*columns, *([n_dropped.alias(counted)] if counted else []))
