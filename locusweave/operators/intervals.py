"""Joins of intervals and points on a bin key.

An interval takes part in every bin that it touches, so an equi join on (keys, bin) finds
all overlaps; a chromosome, of which there are few, is then no bottleneck.  A pair that
shares several bins is kept in the first of them alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BIN = 500_000


def bin_of(position: Column, width: int) -> Column:
    return F.floor(position / F.lit(width)).cast("long")


def binned(df: DataFrame, start: str, end: str, width: int = BIN, name: str = "_bin") -> DataFrame:
    """A row for each bin that [start, end] touches; intervals that are null or end before they start have none."""
    return df.where(F.col(start) <= F.col(end)).withColumn(name, F.explode(F.sequence(bin_of(F.col(start), width), bin_of(F.col(end), width))))


def overlapping(left: DataFrame, right: DataFrame, keys: tuple[str, ...], lspan: tuple[str, str], rspan: tuple[str, str], extra: Column | None = None, width: int = BIN) -> DataFrame:
    """Rows of both whose closed intervals overlap within equal keys; columns as l.* and r.* of aliases."""
    a, b = binned(left, *lspan, width).alias("l"), binned(right, *rspan, width).alias("r")
    ls, le, rs, re_ = F.col(f"l.{lspan[0]}"), F.col(f"l.{lspan[1]}"), F.col(f"r.{rspan[0]}"), F.col(f"r.{rspan[1]}")
    cond = (F.col("l._bin") == F.col("r._bin")) & (ls <= re_) & (rs <= le) & (F.col("l._bin") == bin_of(F.greatest(ls, rs), width))
    for k in keys:
        cond = cond & (F.col(f"l.{k}") == F.col(f"r.{k}"))
    return a.join(b, cond if extra is None else cond & extra)


def points_within(points: DataFrame, spans: DataFrame, keys: tuple[str, ...], position: str, span: tuple[str, str], how: str = "inner", width: int = BIN, bin_column: str | None = None) -> DataFrame:
    """Points and the closed spans that contain them, as p.* and s.*; "left_semi" keeps points alone.

    bin_column: the points' column that holds their bins already.
    """
    a = (points if bin_column else points.withColumn("_bin", bin_of(F.col(position), width))).alias("p")
    b = binned(spans, *span, width).alias("s")
    cond = (F.col(f"p.{bin_column or '_bin'}") == F.col("s._bin")) & F.col(f"p.{position}").between(F.col(f"s.{span[0]}"), F.col(f"s.{span[1]}"))
    for k in keys:
        cond = cond & (F.col(f"p.{k}") == F.col(f"s.{k}"))
    return a.join(b, cond, how)
