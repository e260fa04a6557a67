"""Linkage disequilibrium: requests, lookup, adaptation, checks and statistics.

A reference is an index (idx, variantId) and entries (i, j, r) of a correlation matrix.
`NativeSource` looks loci up in such tables; anything with a `materialise` method of the
same result can stand in for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Protocol

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..schema import LD_MAPPING, LD_NATIVE_PAIR, LD_NATIVE_STATUS, LD_REQUEST, LD_RUN_STATS, LD_STATS, PAIRWISE_LD, conform, empty
from ..sources.metrics import observed, peak_executor_kib, timed
from ..sources.tables import remove_path, written
from .intervals import bin_of

#: Status codes of requested variants.
EXACT, FLIPPED, UNRESOLVED, UNSUPPORTED = 0, 1, 2, 5
PREFIX = "chr"


class LdError(ValueError):
    """Inputs or results of an LD lookup contradict each other."""


def requests(loci: DataFrame, studies: DataFrame | None = None, prefix: str = PREFIX) -> DataFrame:
    """locus_id, locus (chrN:start-end) and native variant ids of loci, of the given studies only."""
    rows = _of_studies(loci, studies).where(F.col("locus").isNotNull())
    contig = S.native_contig(F.col("chromosome"), prefix)
    out = rows.select(
        F.col("studyLocusId").alias("locus_id"),
        F.concat(contig, F.lit(":"), F.col("locusStart").cast("string"), F.lit("-"), F.col("locusEnd").cast("string")).alias("locus"),
        F.transform("locus", lambda v: S.native_variant(v["variantId"], prefix)).alias("variant_ids"),
    )
    return conform(out, LD_REQUEST)


def mapping(loci: DataFrame, studies: DataFrame | None = None, prefix: str = PREFIX) -> DataFrame:
    """Native and original id of every variant of every locus."""
    v = _of_studies(loci, studies).select(F.col("studyLocusId").alias("locus_id"), F.explode("locus.variantId").alias("original_variant_id"))
    return conform(v.withColumn("native_variant_id", S.native_variant(F.col("original_variant_id"), prefix)), LD_MAPPING)


def _of_studies(loci: DataFrame, studies: DataFrame | None) -> DataFrame:
    return loci if studies is None else loci.join(studies.select(F.col("studyId").cast("string").alias("studyId")).distinct(), "studyId", "left_semi")


class LdSource(Protocol):
    def materialise(self, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(native pairs, native status) of requests."""


@dataclass
class NativeSource:
    """Lookup in tables of one reference; the requests of all loci are answered by one plan."""

    index: DataFrame  # idx, variantId
    entries: DataFrame  # i, j, r

    def status(self, wanted: DataFrame) -> DataFrame:
        asked = wanted.select("locus_id", F.explode("variant_ids").alias("requested_variant_id")).distinct()
        p = S.variant_parts("requested_variant_id")
        asked = asked.withColumn("_swapped", F.concat_ws("_", p["contig"], F.split_part("requested_variant_id", F.lit("_"), F.lit(2)), p["alternateAllele"], p["referenceAllele"])).withColumn("_ok", S.is_acgt(p["referenceAllele"]) & S.is_acgt(p["alternateAllele"]))
        known = self.index.select(F.col("variantId").alias("_id"), F.col("idx").cast("long").alias("_idx")).dropDuplicates(["_id"])
        # One join answers both spellings: each asked variant looks for two ids.
        tries = asked.select("*", F.explode(F.array(F.struct(F.col("requested_variant_id").alias("_id"), F.lit(1).alias("_order")), F.struct(F.col("_swapped").alias("_id"), F.lit(-1).alias("_order")))).alias("_t")).where("_ok").select("locus_id", "requested_variant_id", "_t.*")
        best = tries.join(known, "_id").groupBy("locus_id", "requested_variant_id").agg(F.max(F.struct("_order", "_idx")).alias("hit"))
        out = asked.join(best, ["locus_id", "requested_variant_id"], "left")
        code = F.when(~F.col("_ok"), UNSUPPORTED).when(F.col("hit").isNull(), UNRESOLVED).when(F.col("hit._order") == 1, EXACT).otherwise(FLIPPED)
        return conform(out.select("locus_id", "requested_variant_id", F.col("hit._idx").alias("idx"), F.col("hit._order").alias("allele_order"), code.alias("status_code")), LD_NATIVE_STATUS)

    def pairs_of(self, status: DataFrame) -> DataFrame:
        """Native pairs of the resolved variants of a status."""
        found = status.where(F.col("status_code").isin(EXACT, FLIPPED)).select("locus_id", "idx", "allele_order")
        # Entries meet resolved variants one side at a time, so pairs without an entry never exist.
        e = self.entries.where((F.col("i") < F.col("j")) & (F.col("r") != 0)).select(F.col("i").cast("long").alias("idx_i"), F.col("j").cast("long").alias("idx_j"), "r")
        a = found.select("locus_id", F.col("idx").alias("idx_i"), F.col("allele_order").alias("_a")).distinct()
        b = found.select("locus_id", F.col("idx").alias("idx_j"), F.col("allele_order").alias("_b")).distinct()
        pairs = e.join(a, "idx_i").join(b, ["locus_id", "idx_j"]).withColumn("r", F.col("r") * F.col("_a") * F.col("_b"))
        return conform(pairs, LD_NATIVE_PAIR)

    def materialise(self, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
        status = self.status(wanted)
        return self.pairs_of(status), status


@dataclass
class AlignedSource(NativeSource):
    """Lookup in an index of original ids (idx, variantId, alleleOrder) that was aligned before: one spelling, its own sign."""

    prefix: str = PREFIX

    def status(self, wanted: DataFrame) -> DataFrame:
        asked = wanted.select("locus_id", F.explode("variant_ids").alias("requested_variant_id")).distinct()
        p = S.variant_parts("requested_variant_id")
        ok = S.is_acgt(p["referenceAllele"]) & S.is_acgt(p["alternateAllele"])
        entry = F.struct(F.col("idx").cast("long").alias("_idx"), F.col("alleleOrder").cast("int").alias("_order"))
        known = self.index.groupBy(S.native_variant(F.col("variantId"), self.prefix).alias("requested_variant_id")).agg(F.min(entry).alias("hit"))
        out = asked.join(known, "requested_variant_id", "left").withColumn("hit", F.when(ok, F.col("hit")))
        code = F.when(~ok, UNSUPPORTED).when(F.col("hit").isNull(), UNRESOLVED).when(F.col("hit._order") == 1, EXACT).otherwise(FLIPPED)
        return conform(out.select("locus_id", "requested_variant_id", F.col("hit._idx").alias("idx"), F.col("hit._order").alias("allele_order"), code.alias("status_code")), LD_NATIVE_STATUS)


@dataclass
class FixedSource:
    """Pairs and status that are there already."""

    pairs: DataFrame
    status: DataFrame

    def materialise(self, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
        return self.pairs, self.status


def matrix_entries(blocks: DataFrame, row: str = "row", values: str = "values", first: str | None = None) -> DataFrame:
    """(i, j, r) of rows of a matrix held as arrays: the strict upper triangle without zeros.

    An array begins at column 0, or at the number in the column `first` where a matrix is
    banded or in diagonal blocks, so rows of any number have arrays of one block's width.
    """
    at = F.col(first).cast("long") if first else F.lit(0).cast("long")
    cells = blocks.select(F.col(row).cast("long").alias("i"), at.alias("_first"), F.posexplode(values).alias("_k", "r"))
    return cells.select("i", (F.col("_first") + F.col("_k")).alias("j"), F.col("r").cast("double").alias("r")).where("i < j AND r <> 0")


#: Names of resolved variants that are broadcast at most, some 100 bytes each.
MAX_BROADCAST = 1 << 19


def resolved_names(status: DataFrame, ids: DataFrame) -> DataFrame:
    """locus_id, idx, original_variant_id of every resolved variant."""
    return status.where(F.col("status_code").isin(EXACT, FLIPPED)).join(ids.withColumnRenamed("native_variant_id", "requested_variant_id"), ["locus_id", "requested_variant_id"]).select("locus_id", "idx", "original_variant_id")


def adapt(pairs: DataFrame, status: DataFrame, ids: DataFrame, ancestry: str) -> DataFrame:
    """Pairs under their original ids, and a diagonal of 1 for every resolved variant."""
    names = resolved_names(status, ids)
    side = lambda x: names.select("locus_id", F.col("idx").alias(f"idx_{x}"), F.col("original_variant_id").alias(f"variantId{x.upper()}"))
    off = pairs.join(side("i"), ["locus_id", "idx_i"]).join(side("j"), ["locus_id", "idx_j"]).select("variantIdI", "variantIdJ", F.col("r").cast("double").alias("r"))
    on = names.select(F.col("original_variant_id").alias("variantIdI"), F.col("original_variant_id").alias("variantIdJ"), F.lit(1.0).alias("r"))
    return conform(off.unionByName(on).withColumn("ancestry", F.lit(ancestry)), PAIRWISE_LD)


def conflicts(pairs: DataFrame) -> DataFrame:
    """Pairs with more than one value."""
    return pairs.groupBy("ancestry", "variantIdI", "variantIdJ").agg(F.countDistinct("r").alias("nValues")).where("nValues > 1")


#: How the error of a pair with several values begins.
CONFLICT = "Conflicting LD values"


def combine(adapted: list[DataFrame]) -> DataFrame:
    """One value a pair and ancestry."""
    return reduce(DataFrame.unionByName, adapted).groupBy("ancestry", "variantIdI", "variantIdJ").agg(F.min("r").alias("r"))


def combined(pairs: DataFrame, names: DataFrame, ancestry: str, small: bool = False) -> DataFrame:
    """What `adapt` and `combine` give, with a pair of several values as an error of the same aggregation.

    With `small`, names, which are counted then and few, are gathered once and broadcast, so that pairs shuffle once.
    """
    if small:
        names = F.broadcast(names.coalesce(1))
    side = lambda x: names.select("locus_id", F.col("idx").alias(f"idx_{x}"), F.col("original_variant_id").alias(f"variantId{x.upper()}"))
    off = pairs.join(side("i"), ["locus_id", "idx_i"]).join(side("j"), ["locus_id", "idx_j"]).select("variantIdI", "variantIdJ", F.col("r").cast("double").alias("r"))
    on = names.select(F.col("original_variant_id").alias("variantIdI"), F.col("original_variant_id").alias("variantIdJ"), F.lit(1.0).alias("r"))
    values = off.unionByName(on).groupBy("variantIdI", "variantIdJ").agg(F.min("r").alias("r"), F.max("r").alias("most"))
    told = F.concat(F.lit(f"{CONFLICT} for {ancestry}: "), F.col("variantIdI"), F.lit(", "), F.col("variantIdJ"))
    r = F.when(F.col("r").eqNullSafe(F.col("most")), F.col("r")).otherwise(F.raise_error(told).cast("double"))
    return conform(values.select(F.lit(ancestry).alias("ancestry"), "variantIdI", "variantIdJ", r.alias("r")), PAIRWISE_LD)


def adapted(pairs: DataFrame, status: DataFrame, ids: DataFrame, ancestry: str) -> DataFrame:
    """Native pairs under their original ids with the diagonal, guarded and combined by one shuffle.

    A variant has one status, so there are no more names than ids, whose number decides on the broadcast.
    """
    return combined(pairs, resolved_names(status, ids), ancestry, ids.count() <= MAX_BROADCAST)


@dataclass
class Annotated:
    """LD of one ancestry: tables in the shared folder, and the figures of making them."""

    pairs: DataFrame
    status: DataFrame
    figures: dict[str, int | float]


def annotated(loci: DataFrame, studies: DataFrame | None, source: LdSource, ancestry: str, prefix: str = PREFIX) -> Annotated:
    """Requests, lookup and adaptation of one ancestry's loci.

    Status, native pairs and names are tables, so nothing is looked up twice; counts are
    observed by the jobs that write.  One shuffle of pairs guards, combines and counts them.
    """
    n, seconds = F.count(F.lit(1)), {}
    of = lambda *codes: F.count(F.when(F.col("status_code").isin(*codes), 1))
    wanted, spark = requests(loci, studies, prefix), loci.sparkSession
    counts = (n.alias("requested"), of(EXACT, FLIPPED).alias("resolved"), of(UNSUPPORTED).alias("unsupported"))
    with timed(seconds, "native"):
        if isinstance(source, NativeSource):
            status, found = observed(source.status(wanted), "status", *counts)
            native = source.pairs_of(status)
        else:
            native, status = source.materialise(wanted)
            status, found = observed(status, "status", *counts)
        native, native_at = written(native, "native")
    with timed(seconds, "adapter"):
        try:
            names, named = observed(resolved_names(status, mapping(loci, studies, prefix)), "names", n.alias("n"))
            pairs, kept = observed(combined(native, names, ancestry, named["n"] <= MAX_BROADCAST), "pairs", n.alias("n"))
        except Exception as e:
            if CONFLICT not in str(e):
                raise
            raise LdError(str(e)[str(e).index(CONFLICT) :].splitlines()[0]) from e
    remove_path(spark, native_at)
    rest = found["requested"] - found["resolved"] - found["unsupported"]
    figures = (found["requested"], found["resolved"], rest, found["unsupported"], kept["n"], seconds["native"], seconds["adapter"], peak_executor_kib(spark))
    return Annotated(pairs, status, dict(zip(LD_RUN_STATS.names, (ancestry, *figures), strict=True)))


def stats(status: DataFrame, adapted: DataFrame, ancestry: str) -> DataFrame:
    """One row of counts: variants requested, resolved, unresolved, unsupported, and distinct pairs."""
    count = lambda c: F.count(F.when(c, 1))
    code = F.col("status_code")
    variants = status.select(code, F.lit(None).cast("int").alias("pair"))
    pairs = adapted.select("variantIdI", "variantIdJ").distinct().select(F.lit(None).cast("int").alias("status_code"), F.lit(1).alias("pair"))
    counts = variants.unionByName(pairs).agg(count(F.col("pair").isNull()).alias("n_requested_variants"), count(code.isin(EXACT, FLIPPED)).alias("n_resolved_variants"), count(code == UNSUPPORTED).alias("n_unsupported_variants"), F.count("pair").alias("n_ld_pairs"))
    both = counts.withColumn("ancestry", F.lit(ancestry)).withColumn("n_unresolved_variants", F.expr("n_requested_variants - n_resolved_variants - n_unsupported_variants"))
    return conform(both, LD_STATS)


def validate_studies(loci: DataFrame, metadata: DataFrame, references: list[str]) -> None:
    """Every study of loci has one ancestry, every ancestry one reference."""
    if len(set(references)) != len(references):
        raise LdError("Duplicate LD reference ancestry")
    two = metadata.groupBy("studyId").agg(F.countDistinct("ancestry").alias("n")).where("n > 1").head(1)
    if two:
        raise LdError(f"Conflicting ancestry for studyId {two[0].studyId}")
    studies = loci.select(F.col("studyId").cast("string").alias("studyId")).distinct()
    lost = studies.join(metadata, "studyId", "left_anti").orderBy("studyId").limit(20).collect()
    if lost:
        raise LdError(f"No study metadata for: {', '.join(r.studyId for r in lost)}")
    known = metadata.sparkSession.createDataFrame([(a,) for a in references], "ancestry string")
    none = studies.join(metadata, "studyId").join(known, "ancestry", "left_anti").select("ancestry").distinct().orderBy("ancestry").limit(20).collect()
    if none:
        raise LdError(f"No LD reference for ancestry: {', '.join(r.ancestry for r in none)}")


def annotate(loci: DataFrame, metadata: DataFrame, sources: dict[str, LdSource], prefix: str = PREFIX) -> tuple[DataFrame, DataFrame]:
    """(pairs of all ancestries, figures a row an ancestry) of the loci; an ancestry without a study has zeros."""
    spark = loci.sparkSession
    validate_studies(loci, metadata, list(sources))
    present = {r.ancestry for r in loci.select(F.col("studyId").cast("string").alias("studyId")).distinct().join(metadata, "studyId").select("ancestry").distinct().collect()}
    found, figures = [], []
    for ancestry, source in sources.items():
        if ancestry not in present:
            figures.append((ancestry, 0, 0, 0, 0, 0, 0.0, 0.0, 0))
            continue
        done = annotated(loci, metadata.where(F.col("ancestry") == ancestry).select("studyId"), source, ancestry, prefix)
        found.append(done.pairs)
        figures.append(tuple(done.figures.values()))
    return (reduce(DataFrame.unionByName, found) if found else empty(spark, PAIRWISE_LD)), spark.createDataFrame(figures, LD_RUN_STATS)


def without_pairs(stats_rows: DataFrame) -> DataFrame:
    """Ancestries with no pair at all."""
    if "n_ld_pairs" not in stats_rows.columns or stats_rows.where(F.col("n_ld_pairs").isNull()).head(1):
        raise LdError("LD statistics lack n_ld_pairs")
    return stats_rows.where("n_ld_pairs = 0")


def flip_differences(direct: DataFrame, flipped: DataFrame, index: int, tolerance: float = 1e-8) -> DataFrame:
    """Counts of a lookup against one with variant `index` flipped: its pairs must change sign, others must not."""
    both = direct.alias("d").join(flipped.alias("f"), ["locus_id", "idx_i", "idx_j"])
    of = (F.col("idx_i") == index) | (F.col("idx_j") == index)
    return both.agg(F.count(F.lit(1)).alias("sharedPairs"), F.count(F.when(of & (F.abs(F.col("d.r") + F.col("f.r")) > tolerance), 1)).alias("signErrors"), F.count(F.when(~of & (F.abs(F.col("d.r") - F.col("f.r")) > tolerance), 1)).alias("valueErrors"))


def request_of(sample: DataFrame, locus_id: str, turned: int | None = None, prefix: str = PREFIX) -> DataFrame:
    """One request for the variants of a sample by position, then idx; the alleles of the one whose idx is `turned` are swapped."""
    ref, alt = F.col("referenceAllele"), F.col("alternateAllele")
    swap = F.coalesce(F.col("idx") == F.lit(turned), F.lit(False))
    name = F.concat_ws("_", S.native_contig(F.col("contig"), prefix), "position", F.when(swap, alt).otherwise(ref), F.when(swap, ref).otherwise(alt))
    place = F.concat(F.any_value(S.native_contig(F.col("contig"), prefix)), F.lit(":"), F.min("position").cast("string"), F.lit("-"), F.max("position").cast("string"))
    ids = F.transform(F.array_sort(F.collect_list(F.struct("position", "idx", name.alias("name")))), lambda v: v["name"])
    out = sample.agg(place.alias("locus"), ids.alias("variant_ids")).where(F.size("variant_ids") > 0)
    return conform(out.withColumn("locus_id", F.lit(locus_id)), LD_REQUEST)


def neighbourhood(index: DataFrame, anchor_id: int, flank: int = 100_000, k: int = 12) -> DataFrame:
    """The k variants nearest to an anchor within the flank, on its chromosome."""
    rows = index.select("idx", "variantId", *[S.variant_parts()[c].alias(c) for c in ("contig", "position", "referenceAllele", "alternateAllele")])
    at = rows.where(F.col("idx") == anchor_id).select("contig", "position").head(1)
    away = F.abs(F.col("position") - F.lit(at[0].position if at else None))
    there = (F.col("contig") == F.lit(at[0].contig if at else None)) & (away <= flank)
    return rows.where(there).withColumn("distance", away).orderBy("distance", "idx").limit(k)


def nearest(anchors: DataFrame, index: DataFrame, k: int = 12, flank: int = 100_000, ring: int | None = None) -> DataFrame:
    """anchor_idx, idx, variantId, distance, place: the k variants nearest to each anchor (itself too) within the flank.

    Both are (idx, variantId) tables.  Anchors meet the variants of their own and the next bins of a
    ring's width; one that has k of them within the width is done, others go on to a ring of four times
    the width, until it is the flank.  So a dense stretch gives few candidates an anchor, and
    anchors that are done cost nothing more.  Ties go to the smaller idx.
    """
    parts = lambda df: df.select("idx", "variantId", *[S.variant_parts()[c].alias(c) for c in ("contig", "position")]).where(F.col("position").isNotNull())
    of, there = parts(anchors).select(F.col("idx").alias("anchor_idx"), "contig", F.col("position").alias("at")), parts(index)
    place = F.row_number().over(Window.partitionBy("anchor_idx", "contig", "at").orderBy("distance", "idx"))
    width, done = max(1, min(flank, ring or max(1, flank // 64))), []
    left, left_at = written(of.distinct(), "anchors")
    while True:
        here = left.withColumn("bin", F.explode(F.array(*[bin_of(F.col("at"), width) + n for n in (-1, 0, 1)])))
        met = here.join(there.withColumn("bin", bin_of(F.col("position"), width)), ["contig", "bin"]).withColumn("distance", F.abs(F.col("position") - F.col("at"))).where(F.col("distance") <= width)
        best, best_at = written(met.withColumn("place", place).where(F.col("place") <= k).select("anchor_idx", "contig", "at", "idx", "variantId", "distance", "place"), "nearest")
        last = width >= flank
        full = best.where(F.col("place") == k).select("anchor_idx", "contig", "at")
        done.append(best if last else best.join(full, ["anchor_idx", "contig", "at"], "left_semi"))
        (rest, rest_at), before = written(left.join(full, ["anchor_idx", "contig", "at"], "left_anti"), "anchors"), left_at
        remove_path(left.sparkSession, before)
        left, left_at = rest, rest_at
        if last or left.isEmpty():
            break
        width = min(flank, 4 * width)
    remove_path(left.sparkSession, left_at)
    return reduce(DataFrame.unionByName, done).select("anchor_idx", "idx", "variantId", "distance", "place")
