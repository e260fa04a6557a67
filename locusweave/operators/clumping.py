"""Clumping of significant variants into loci."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log10

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import semantics as S
from ..schema import LOCUS_VARIANT, STUDY_LOCUS, SUMSTATS, conform
from ..sources.tables import materialise, remove_path, written
from .intervals import bin_of, points_within

#: The excluded region: chromosome, first and last position.
MHC = ("6", 25_726_063, 33_400_556)


class EmptyResult(ValueError):
    """Strict mode: a step that must give rows gave none."""


@dataclass(frozen=True)
class ClumpConfig:
    lbc_baseline_pvalue: float = 1e-5
    lbc_distance_cutoff: int = 250_000
    lbc_pvalue_threshold: float = 1e-8
    lbc_flanking_distance: int = 100_000
    large_loci_size: int = 1_500_000
    wbc_clump_distance: int = 500_000
    wbc_pvalue_threshold: float = 1e-5
    collect_locus: bool = True
    remove_mhc: bool = True

    def __post_init__(self) -> None:
        for name in ("lbc_baseline_pvalue", "lbc_pvalue_threshold", "wbc_pvalue_threshold"):
            if not 0 < getattr(self, name) <= 1:
                raise ValueError(f"{name} must be above 0 and at most 1")
        for name in ("lbc_distance_cutoff", "lbc_flanking_distance"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")
        for name in ("large_loci_size", "wbc_clump_distance"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")


def unique_sumstats(sumstats: DataFrame) -> DataFrame:
    """Rows whose (studyId, variantId) occurs once; all copies of others go."""
    w = Window.partitionBy("studyId", "variantId")
    return sumstats.withColumn("_n", F.count(F.lit(1)).over(w)).where("_n = 1").drop("_n")


_KEYS = ("studyId", "variantId")
#: The column of a laid-out table of summary statistics that holds a row's bin of the interval join.
BIN_COLUMN = "positionBin"


def _same_keys(a: str, b: str) -> Column:
    return F.col(f"{a}.studyId").eqNullSafe(F.col(f"{b}.studyId")) & F.col(f"{a}.variantId").eqNullSafe(F.col(f"{b}.variantId"))


def _several(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")


def copied_keys(sumstats: DataFrame) -> DataFrame:
    """The (studyId, variantId) that several rows have; a hash of the two is shuffled, and they themselves where hashes are equal."""
    hashed = sumstats.select(*_KEYS, F.xxhash64(*_KEYS).alias("_h"))
    again = hashed.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")
    return _several(hashed.join(again, "_h", "left_semi"))


def without_copies(rows: DataFrame, copies: DataFrame) -> DataFrame:
    return rows.alias("r").join(copies.alias("c"), _same_keys("r", "c"), "left_anti")


def unique_among(rows: DataFrame, sumstats: DataFrame) -> DataFrame:
    """The rows, taken from sumstats, that are unique in all of it.

    Only the keys of the rows meet the keys of sumstats, so neither side's columns shuffle
    for rows that filters have dropped before.
    """
    wanted = rows.select(*_KEYS).distinct().alias("w")
    return without_copies(rows, _several(sumstats.select(*_KEYS).alias("k").join(wanted, _same_keys("k", "w"), "left_semi")))


def candidates(sumstats: DataFrame, pvalue: float, copies: DataFrame | None = None) -> DataFrame:
    """Contract columns of the rows with a p-value of at most `pvalue`, unique in sumstats; copies: its copied_keys, if known."""
    rows = conform(sumstats.where(S.pvalue_at_most(pvalue)), SUMSTATS)
    return unique_among(rows, sumstats) if copies is None else without_copies(rows, copies)


def with_breaks(filtered: DataFrame, config: ClumpConfig) -> DataFrame:
    """negLogPValue, previousPosition and locusBreakPosition: a break has no neighbour before it within the cutoff; variants of one position stand by their ids."""
    w = Window.partitionBy("studyId", "chromosome").orderBy("position", "variantId")
    gap = F.col("position") - F.col("previousPosition")
    return (
        filtered.withColumn("negLogPValue", S.neg_log10_p())
        .withColumn("previousPosition", F.lag("position").over(w))
        .withColumn("locusBreakPosition", F.when(F.col("previousPosition").isNull() | (gap > config.lbc_distance_cutoff), F.col("position")))
    )


def with_bounds(broken: DataFrame, config: ClumpConfig) -> DataFrame:
    """locusStart from the last break, floored at 0, and locusEnd; breaks floored to one start are one locus."""
    flank = config.lbc_flanking_distance
    w = Window.partitionBy("studyId", "chromosome").orderBy("position", "variantId").rowsBetween(Window.unboundedPreceding, 0)
    start = F.last("locusBreakPosition", ignorenulls=True).over(w) - flank
    return broken.withColumn("locusStart", F.when(start > 0, start).otherwise(0).cast("int")).withColumn("locusEnd", F.max(F.col("position") + flank).over(Window.partitionBy("studyId", "chromosome", "locusStart")).cast("int"))


def ranked_leads(bounded: DataFrame) -> DataFrame:
    w = Window.partitionBy("studyId", "chromosome", "locusStart", "locusEnd").orderBy(F.desc_nulls_last("negLogPValue"))
    return bounded.withColumn("leadRank", F.rank().over(w))


def _study_loci(rows: DataFrame, start: Column, end: Column, controls: Column) -> DataFrame:
    locus = STUDY_LOCUS["locus"].dataType
    out = rows.withColumn("_start", start).withColumn("_end", end).select(S.study_locus_id().alias("studyLocusId"), *SUMSTATS.names, controls.cast("array<string>").alias("qualityControls"), F.col("_start").cast("int").alias("locusStart"), F.col("_end").cast("int").alias("locusEnd"), F.lit(None).cast(locus).alias("locus"))
    return out


def loci_of(found: DataFrame, config: ClumpConfig) -> DataFrame:
    """Loci of candidates of the baseline p-value."""
    ranked = ranked_leads(with_bounds(with_breaks(found, config), config))
    leads = ranked.where((F.col("leadRank") == 1) & (F.col("negLogPValue") > -log10(config.lbc_pvalue_threshold)))
    return _study_loci(leads, F.col("locusStart"), F.col("locusEnd"), F.lit(None))


def locus_breaker_loci(sumstats: DataFrame, config: ClumpConfig) -> DataFrame:
    """Loci of runs of significant variants; ties in significance give a locus several leads."""
    return loci_of(candidates(sumstats, config.lbc_baseline_pvalue), config)


def clusters_of(found: DataFrame, config: ClumpConfig) -> DataFrame:
    """Candidates with the number of their cluster: one begins where the gap to the position before exceeds the distance."""
    w = Window.partitionBy("studyId", "chromosome").orderBy("position", "variantId")
    gap = F.col("position") - F.lag("position").over(w)
    begins = F.when(gap.isNull() | (gap > config.wbc_clump_distance), 1).otherwise(0)
    return found.withColumn("_begins", begins).withColumn("clusterNumber", F.sum("_begins").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_begins")


def window_clusters(sumstats: DataFrame, config: ClumpConfig) -> DataFrame:
    return clusters_of(candidates(sumstats, config.wbc_pvalue_threshold), config)


CLUSTER = ("studyId", "chromosome", "clusterNumber")
#: The order in which variants become leads.
SIGNIFICANCE = ("pValueExponent", "pValueMantissa", "position", "variantId")
#: Rows of a cluster that one task sweeps, and rounds in which larger clusters are peeled before.
SWEPT_ROWS, ROUNDS = 200_000, 8


def window_leads(clusters: DataFrame, config: ClumpConfig, swept_rows: int = SWEPT_ROWS) -> DataFrame:
    """In each cluster, most significant first, the variants that have no lead nearer than the distance.

    Clusters are independent, so each is swept in order of significance by one task, which
    keeps one lead a bin of the distance and no rows.  Clusters of more than swept_rows are first
    peeled over all tasks: in bins of the distance, a variant that no other near one precedes
    is a lead, and those near it fall, round by round.
    """
    rows, _ = written(clusters.select(*SUMSTATS.names, "clusterNumber"), "clusters")
    large = rows.groupBy(*CLUSTER).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > swept_rows).drop("_n")
    if large.isEmpty():
        return _swept(rows, config.wbc_clump_distance).select(*SUMSTATS.names)
    large, _ = written(large, "large")
    same = F.col("a.studyId").eqNullSafe(F.col("b.studyId")) & F.col("a.chromosome").eqNullSafe(F.col("b.chromosome")) & (F.col("a.clusterNumber") == F.col("b.clusterNumber"))
    both = lambda how: rows.alias("a").join(large.alias("b"), same, how)
    leads, rest = _peeled(both("left_semi"), config.wbc_clump_distance)
    return leads.select(*SUMSTATS.names).unionByName(_swept(both("left_anti").unionByName(rest), config.wbc_clump_distance).select(*SUMSTATS.names))


def _swept(rows: DataFrame, distance: int) -> DataFrame:
    """The leads of whole clusters, each a run of one task's rows."""

    def run(batches):
        cluster, leads = None, {}
        for b in batches:
            keep = []
            for i, (*at, p) in enumerate(zip(*(b.column(c).to_pylist() for c in (*CLUSTER, "position")), strict=True)):
                if at != cluster:
                    cluster, leads = at, {}
                if p is not None:
                    n = p // distance  # a bin has one lead at most
                    if any(abs(p - leads[m]) < distance for m in (n - 1, n, n + 1) if m in leads):
                        continue
                    leads[n] = p
                keep.append(i)
            yield b.take(pa.array(keep, pa.int64()))

    return rows.repartition(*CLUSTER).sortWithinPartitions(*CLUSTER, *SIGNIFICANCE).mapInArrow(run, rows.schema)


def _peeled(rows: DataFrame, distance: int, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """(leads, rows that are neither a lead nor near one) after some rounds over bins of the distance."""
    spark = rows.sparkSession
    first = F.struct(*SIGNIFICANCE)
    there = (F.col("a.studyId").eqNullSafe(F.col("b.studyId"))) & (F.col("a.chromosome").eqNullSafe(F.col("b.chromosome"))) & (F.col("a.clusterNumber") == F.col("b.clusterNumber")) & (F.col("a.bin") == F.col("b.bin"))
    near = F.abs(F.col("a.position") - F.col("b.position")) < distance
    around = lambda df, steps: df.withColumn("bin", F.explode(F.array(*[F.col("bin") + n for n in steps])))
    (open_, open_at), leads = written(rows.withColumn("bin", bin_of(F.col("position"), distance)), "open"), []
    for _ in range(rounds):
        best = open_.groupBy(*CLUSTER, "bin").agg(F.min(first).alias("best"))
        best, best_at = written(best.select(*CLUSTER, "bin", "best", F.col("best.position").alias("position")), "best")
        rivals = around(open_.select(*CLUSTER, "position", "bin", first.alias("first")), (-1, 1))
        won = best.alias("a").join(rivals.alias("b"), there & near & (F.col("b.first") < F.col("a.best")), "left_anti")
        won, won_at = written(won, "won")
        mine = open_.alias("a").join(won.alias("b"), there & (first_of("a") == F.col("b.best")), "left_semi").dropDuplicates([*CLUSTER, "bin"])
        leads.append(written(mine, "leads")[0])
        (left, left_at), before = written(open_.alias("a").join(around(won, (-1, 0, 1)).alias("b"), there & near, "left_anti"), "open"), open_at
        for path in (before, best_at, won_at):
            remove_path(spark, path)
        open_, open_at = left, left_at
        if open_.isEmpty():
            break
    return reduce(DataFrame.unionByName, leads).drop("bin"), open_.drop("bin")


def first_of(alias: str) -> Column:
    return F.struct(*[F.col(f"{alias}.{c}").alias(c) for c in SIGNIFICANCE])


def replace_large(loci: DataFrame, leads: DataFrame, config: ClumpConfig) -> DataFrame:
    """Loci wider than the limit give way to the window leads within them, of fixed width and without a floor."""
    width = F.col("locusEnd") - F.col("locusStart")
    half = config.large_loci_size // 2
    large = loci.where(width > config.large_loci_size).select("studyId", "chromosome", "locusStart", "locusEnd")
    inside = points_within(leads, large, ("studyId", "chromosome"), "position", ("locusStart", "locusEnd"), "left_semi")
    new = _study_loci(inside, F.col("position") - half, F.col("position") + half, F.array())
    return loci.where(width <= config.large_loci_size).unionByName(new)


def without_region(loci: DataFrame, region: tuple[str, int, int] = MHC) -> DataFrame:
    """Loci that don't overlap the region; one for which that is unknown goes, too."""
    chromosome, start, end = region
    return loci.where(~((F.col("chromosome") == chromosome) & (F.col("locusStart") <= end) & (F.col("locusEnd") >= start)))


_ORDER = ("position", "variantId", "pValueExponent", "pValueMantissa", "beta", "standardError")


def members(loci: DataFrame, sumstats: DataFrame, copies: DataFrame | None = None, laid_out: bool = False) -> DataFrame:
    """studyLocusId with each unique variant, significant or not, within its bounds."""
    narrow = conform(sumstats, SUMSTATS).drop("sampleSize", "effectAlleleFrequencyFromSource")
    points = sumstats.select(*narrow.columns, BIN_COLUMN) if laid_out else narrow
    within = points_within(points, loci.select("studyLocusId", "studyId", "chromosome", "locusStart", "locusEnd"), ("studyId", "chromosome"), "position", ("locusStart", "locusEnd"), bin_column=BIN_COLUMN if laid_out else None)
    found = within.select("s.studyLocusId", *[F.col(f"p.{c}").alias(c) for c in narrow.columns])
    if laid_out:
        return found
    return unique_among(found, sumstats) if copies is None else without_copies(found, copies)


def with_members(loci: DataFrame, sumstats: DataFrame, copies: DataFrame | None = None, laid_out: bool = False) -> DataFrame:
    """loci with their variants as an ordered array, empty if there is none.

    Only the values of the order shuffle, of which the variants are made; nulls come last.
    """
    found = members(loci, sumstats, copies, laid_out).groupBy("studyLocusId").agg(F.collect_list(F.struct(*_ORDER)).alias("_found"))
    ordered = F.array_sort(F.transform("_found", lambda x: F.struct(*[k for c in _ORDER for k in (x[c].isNull().alias(f"_{c}"), x[c].alias(c))])))
    variant = lambda x: F.struct(*[(x[f.name] if f.name in _ORDER else F.lit(None)).cast(f.dataType).alias(f.name) for f in LOCUS_VARIANT.fields])
    arrays = found.select("studyLocusId", F.transform(ordered, variant).alias("_locus"))
    none = F.array().cast(STUDY_LOCUS["locus"].dataType)
    return loci.drop("locus").join(arrays, "studyLocusId", "left").withColumn("locus", F.coalesce("_locus", none)).select(*STUDY_LOCUS.names)


def member_variants(loci: DataFrame, sumstats: DataFrame, copies: DataFrame) -> DataFrame:
    """studyId, variantId and chromosome of each unique variant within any locus of its study, once, however many loci hold it."""
    points = conform(sumstats, SUMSTATS).select(*_KEYS, "chromosome", "position")
    inside = points_within(points, loci.select("studyId", "chromosome", "locusStart", "locusEnd"), ("studyId", "chromosome"), "position", ("locusStart", "locusEnd"), "left_semi")
    return without_copies(inside.select(*_KEYS, "chromosome"), copies)


def with_sizes(loci: DataFrame, sumstats: DataFrame, copies: DataFrame) -> DataFrame:
    """loci with nVariants, the size that `with_members` would give their arrays; variants are counted where they are read."""
    points = without_copies(conform(sumstats, SUMSTATS).select(*_KEYS, "chromosome", "position"), copies)
    spans = loci.select("studyLocusId", "studyId", "chromosome", "locusStart", "locusEnd")
    n = points_within(points, spans, ("studyId", "chromosome"), "position", ("locusStart", "locusEnd")).groupBy("s.studyLocusId").agg(F.count(F.lit(1)).cast("int").alias("_n"))
    return loci.join(n, "studyLocusId", "left").withColumn("nVariants", F.coalesce("_n", F.lit(0))).drop("_n")


def output_order() -> list[Column]:
    last = lambda c: F.col(c).asc_nulls_last()
    return [last("studyId"), *S.chromosome_order(), last("locusStart"), last("locusEnd"), last("position"), last("variantId"), last("studyLocusId")]


def clump(sumstats: DataFrame, config: ClumpConfig | None = None, laid_out: bool = False, copies: DataFrame | None = None) -> DataFrame:
    """Study loci of all studies in sumstats, unordered.

    The summary statistics are read three times: two columns of all rows for the keys of
    copies, the rows below the larger p-value for both kinds of clumping, and what the members
    need.  Copies, candidates and loci are tables in the shared folder.  Window leads are
    sought only if a locus is large.  With `laid_out`, sumstats is a table that `layout.lay_out` wrote: it has no
    copies, so keys are not read, and members are found within its buckets.  copies: copied_keys of
    sumstats, if known.
    """
    config = config or ClumpConfig()
    pvalue = max(config.lbc_baseline_pvalue, config.wbc_pvalue_threshold)
    if copies is None and not laid_out:
        copies, _ = written(copied_keys(sumstats), "copies")
    found = conform(sumstats.where(S.pvalue_at_most(pvalue)), SUMSTATS) if laid_out else candidates(sumstats, pvalue, copies)
    found, _ = written(found, "candidates")
    loci, _ = written(loci_of(found.where(S.pvalue_at_most(config.lbc_baseline_pvalue)), config), "loci")
    if not loci.where(F.col("locusEnd") - F.col("locusStart") > config.large_loci_size).isEmpty():
        loci = replace_large(loci, window_leads(clusters_of(found.where(S.pvalue_at_most(config.wbc_pvalue_threshold)), config), config), config)
    loci = without_region(loci) if config.remove_mhc else loci
    return with_members(materialise(loci), sumstats, copies, laid_out) if config.collect_locus else loci.select(*STUDY_LOCUS.names)


def clump_windows(sumstats: DataFrame, config: ClumpConfig | None = None) -> DataFrame:
    """Loci of fixed width around the window leads of all studies, with the same switches as `clump`."""
    config = config or ClumpConfig()
    copies, _ = written(copied_keys(sumstats), "copies")
    found = candidates(sumstats, config.wbc_pvalue_threshold, copies)
    half = config.large_loci_size // 2
    loci = _study_loci(window_leads(clusters_of(found, config), config), F.col("position") - half, F.col("position") + half, F.array())
    loci = without_region(loci) if config.remove_mhc else loci
    return with_members(materialise(loci), sumstats, copies) if config.collect_locus else loci.select(*STUDY_LOCUS.names)
