"""License scans by diagonal voting.

Every rolling word 2-gram of every document is hashed and joined by Spark with the
positions of the same 2-grams in the templates.  A match votes for the offset diagonal
(document position - template position); votes are aggregated by diagonal, neighbouring
diagonals of a template are merged with all their votes, and a merged span is verified: a base phrase needs all
of its 2-grams on one diagonal; for another template the span's votes are aligned with it in order, and the
longest run of votes that ascends in both must hold a given share of its positions.
A 2-gram whose hash is a template's but whose words are not is sent on under no hash, so
every vote is of equal words.

The templates are a parameter of at most MAX_TEMPLATES phrases of 64 words, so the
broadcast side of the join is bounded by that product; documents never shuffle, only
their votes and one count each do.

Defined cases: null or empty text has no words and no spans; every row is a document of its
own, also if it shares its doc_id, null included, or its text with others (rows are numbered
as they are read, so a table must give them in the same order again, as files do); an empty table gives an empty result; other columns are ignored.  A very
long text is scanned whole, its votes are rows.  Ties: the longest alignment may be several,
of which only the length counts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbatch as tb
from .runtime import prepare

K = 2
MAX_TEMPLATES = 1000
ROW_SCHEMA = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("pos", T.LongType()), T.StructField("h", T.LongType())])
#: Hash of the row that carries a document's word count, and of a 2-gram that may not match.
COUNT, NOTHING = 0, 1


@dataclass(frozen=True)
class Template:
    """exact: each place of the phrase counts, whole; else a share of it within one stretch is enough."""

    label: str
    phrase: str
    exact: bool = False


BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
BODIES = (
    Template("apache-2.0", "licensed under the apache license version 2 0"),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license"),
    Template("warranty-disclaimer", "the software is provided as is without warranty of any kind express or implied"),
)


def _words(phrase: str) -> tb.Words:
    data = np.frombuffer(phrase.encode(), np.uint8)
    return tb.Words(data, np.array([0, len(data)]), tb.ALNUM)


def _signed(h: np.ndarray) -> np.ndarray:
    """As Spark's long; the two values that have a meaning of their own are kept free."""
    return (h | tb.U64(2)).view(np.int64)


def _longest(votes: Column, size: Column) -> Column:
    """Length of the longest run of sorted votes that ascends in position and in template place."""

    def take(best: Column, vote: Column) -> Column:
        at = (-vote["less"]).cast("int")
        here = F.when(at > 0, F.array_max(F.slice(best, 1, at))).otherwise(0) + 1
        return F.transform(best, lambda n, i: F.when(i == at, F.greatest(n, here)).otherwise(n))

    return F.array_max(F.aggregate(votes, F.array_repeat(F.lit(0), size), take))


def scan(docs: DataFrame, templates: tuple[Template, ...] = BASE + BODIES, min_share: float = 0.75, max_shift: int = 3, max_gap: int = 8) -> DataFrame:
    """doc_id, n_words, spans: array of (label, start, end, share, exact), words from 0, of each document.

    Diagonals of a template are merged if they differ by `max_shift` and their stretches
    are `max_gap` words apart at most; `min_share` of its 2-grams must then have matched.
    """
    spark = docs.sparkSession
    prepare(spark)
    parsed = [_words(t.phrase) for t in templates]
    if len(templates) > MAX_TEMPLATES or any(not K <= len(w.starts) <= 64 for w in parsed):
        raise ValueError(f"at most {MAX_TEMPLATES} templates of {K} to 64 words")
    known: dict[int, set[bytes]] = {}
    rows = [(COUNT, -1, 0, 0, True)]
    for n, (t, w) in enumerate(zip(templates, parsed, strict=True)):
        for at, h in enumerate(_signed(tb.grams(w.hashes(), K)).tolist()):
            known.setdefault(h, set()).add(w.phrase(at, K))
            rows.append((h, n, at, len(w.starts) - K + 1, t.exact))
    positions = spark.createDataFrame(rows, "h long, template int, at int, size int, exact boolean")

    def hashed(batches):
        members = tb.HashSet(np.array(list(known), np.int64).view(np.uint64))
        for b in batches:
            ids, rows = b.column("doc_id"), np.asarray(b.column("row"))
            data, offs = tb.text_buffers(b.column("text"))
            for lo, hi in tb.blocks(offs):
                words = tb.Words(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo], tb.ALNUM)
                h, ok = tb.grams(words.hashes(), K), tb.inside(words, K)
                at = np.flatnonzero(ok)
                h = _signed(h[ok])
                for i in members.where(h.view(np.uint64)):
                    if words.phrase(at[i], K) not in known[int(h[i])]:
                        h[i] = NOTHING
                row = words.row[at]
                row, pos, h = np.concatenate([row, np.arange(hi - lo)]), np.concatenate([at - words.first[row], words.counts]), np.concatenate([h, np.full(hi - lo, COUNT)])
                named = pa.concat_arrays([pa.nulls(len(at), pa.int64()), ids.slice(lo, hi - lo)])  # with the count of its words
                yield pa.RecordBatch.from_arrays([pa.array(rows[row + lo]), named, pa.array(pos.astype(np.int64)), pa.array(h)], names=["row", "doc_id", "pos", "h"])

    votes = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tb.task(hashed), ROW_SCHEMA).join(F.broadcast(positions), "h")
    loose = ~F.col("exact") & (F.col("template") >= 0)
    diagonals = (
        votes.groupBy("row", "template", "size", "exact", (F.col("pos") - F.col("at")).alias("diagonal"))
        .agg(F.max("doc_id").alias("doc_id"), F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.collect_list(F.when(loose, F.col("pos"))).alias("places"))
        .where(~F.col("exact") | (F.col("template") < 0) | (F.bit_count("bits") == F.col("size")))
    )
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.col("exact") | F.lag("diagonal").over(near).isNull() | (F.col("diagonal") - F.lag("diagonal").over(near) > max_shift)
    order = Window.partitionBy("row", "template", "band").orderBy("first", "diagonal")
    before = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # By position, and at one position the template's later places first, so that an alignment takes one of them.
    placed = F.transform("places", lambda p: F.struct(p.alias("pos"), (F.col("diagonal") - p).alias("less")))
    merged = (
        diagonals.withColumn("apart", apart.cast("int"))
        .withColumn("band", F.sum("apart").over(near))
        .withColumn("fresh", (before.isNull() | (F.col("first") - before > max_gap)).cast("int"))
        .withColumn("stretch", F.sum("fresh").over(order))
        .groupBy("row", "template", "size", "exact", "band", "stretch")
        .agg(F.max("doc_id").alias("doc_id"), F.bit_count(F.bit_or("bits")).alias("matched"), F.min("first").alias("first"), F.max("last").alias("last"), F.array_sort(F.flatten(F.collect_list(placed))).alias("votes"))
        .withColumn("share", F.when(F.col("template") >= 0, F.col("matched") / F.greatest("size", F.lit(1))))
    )
    enough = (F.col("template") < 0) | (F.col("share") >= F.when(F.col("exact"), 1.0).otherwise(min_share)) & (F.col("matched") >= F.least(F.lit(2), F.col("size")))
    # Distinct places bound an alignment from above, so only spans that have enough of them are aligned.
    aligned = F.when(loose & enough, _longest(F.col("votes"), F.col("size"))).otherwise(F.col("matched"))
    merged = merged.withColumn("matched", aligned).withColumn("share", F.when(F.col("template") >= 0, F.col("matched") / F.greatest("size", F.lit(1)))).where(enough)
    labels = F.array(*[F.lit(t.label) for t in templates]) if templates else F.array().cast("array<string>")
    span = F.struct(F.get(labels, F.col("template")).alias("label"), F.col("first").alias("start"), (F.col("last") + K).alias("end"), F.col("share").alias("share"), F.col("exact").alias("exact"))
    return merged.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max(F.when(F.col("template") < 0, F.col("last"))).alias("n_words"),
        F.array_sort(F.collect_list(F.when(F.col("template") >= 0, span))).alias("spans"),
    ).drop("row")


def digest(scanned: DataFrame) -> DataFrame:
    """One row a document: places and labels of the base phrases, and all labels."""
    base = F.filter("spans", lambda s: s["exact"])
    starts = F.transform(base, lambda s: s["start"])
    names = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return scanned.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names(base).alias("base_labels"),
        names(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
