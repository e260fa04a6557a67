"""Comparison of pairwise LD tables, independent of order, prefix and orientation."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S
from .ld import LdError

TOLERANCE = 1e-8


def oriented(pairs: DataFrame) -> DataFrame:
    """ancestry, variantIdI <= variantIdJ without chr, r."""
    i, j = S.unordered(S.without_prefix(F.col("variantIdI")), S.without_prefix(F.col("variantIdJ")))
    return pairs.select(F.col("ancestry").cast("string").alias("ancestry"), i.alias("variantIdI"), j.alias("variantIdJ"), F.col("r").cast("double").alias("r"))


def normalised(pairs: DataFrame) -> DataFrame:
    """One row for each unordered pair with one value."""
    return oriented(pairs).groupBy("ancestry", "variantIdI", "variantIdJ").agg(F.min("r").alias("r"), F.countDistinct("r").alias("_n")).where("_n = 1").drop("_n")


def assert_consistent(pairs: DataFrame, name: str) -> None:
    bad = oriented(pairs).groupBy("ancestry", "variantIdI", "variantIdJ").agg(F.countDistinct("r").alias("n")).where("n > 1").head(1)
    if bad:
        raise LdError(f"Conflicting LD values in {name} for {bad[0].ancestry}: {bad[0].variantIdI}, {bad[0].variantIdJ}")


def compared(first: DataFrame, second: DataFrame) -> DataFrame:
    key = ["ancestry", "variantIdI", "variantIdJ"]
    return normalised(first).withColumnRenamed("r", "r1").join(normalised(second).withColumnRenamed("r", "r2"), key, "full")


def _differs(tolerance: float):
    return F.abs(F.col("r1") - F.col("r2")) > tolerance


def by_ancestry(both: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    one, two = F.col("r1").isNotNull(), F.col("r2").isNotNull()
    n = lambda c: F.count(F.when(c, 1))
    return both.groupBy("ancestry").agg(
        F.count("r1").alias("first_pairs"),
        F.count("r2").alias("second_pairs"),
        n(one & two).alias("shared_pairs"),
        n(one & ~two).alias("first_only_pairs"),
        n(~one & two).alias("second_only_pairs"),
        n(one & two & _differs(tolerance)).alias("shared_value_mismatches"),
        F.max(F.when(one & two, F.abs(F.col("r1") - F.col("r2")))).alias("max_abs_ld_difference"),
    )


def diagonal(both: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    on = F.col("variantIdI") == F.col("variantIdJ")
    one, two = F.col("r1").isNotNull(), F.col("r2").isNotNull()
    n = lambda c: F.count(F.when(c, 1))
    return both.agg(n(on & one & ~two).alias("first_only"), n(on & ~one & two).alias("second_only"), n(on & one & two & _differs(tolerance)).alias("shared_value_mismatches"))


def report(first: DataFrame, second: DataFrame, declared: set[str] = frozenset(), tolerance: float = TOLERANCE) -> dict[str, Any]:
    """The comparison document; gathered are one row an ancestry and one of the diagonal."""
    assert_consistent(first, "the first table")
    assert_consistent(second, "the second table")
    both = compared(first, second)
    rows = {r.ancestry: r.asDict() for r in by_ancestry(both, tolerance).collect()}
    counters = ("first_pairs", "second_pairs", "shared_pairs", "first_only_pairs", "second_only_pairs", "shared_value_mismatches")
    for a in declared - rows.keys():
        rows[a] = {"ancestry": a, **dict.fromkeys(counters, 0), "max_abs_ld_difference": None}
    ordered = [rows[a] | {"first_zero_pairs": not rows[a]["first_pairs"], "second_zero_pairs": not rows[a]["second_pairs"]} for a in sorted(rows)]
    most = [r["max_abs_ld_difference"] for r in ordered if r["max_abs_ld_difference"] is not None]
    return {
        "tolerance": tolerance,
        "totals": {c: sum(r[c] for r in ordered) for c in counters} | {"max_abs_ld_difference": max(most, default=None)},
        "diagonal_differences": diagonal(both, tolerance).first().asDict(),
        "ancestries": ordered,
    }
