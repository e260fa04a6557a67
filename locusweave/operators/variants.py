"""Small table operators on variants."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import semantics as S


def intersection(rows: DataFrame, n_inputs: int) -> DataFrame:
    """Variants with as many rows as there are inputs; rows are counted, not inputs."""
    return rows.groupBy("chrom", "pos", "ref", "alt").count().where(F.col("count") == n_inputs).drop("count")


def with_z_scores(rows: DataFrame) -> DataFrame:
    return rows.select("chromosome", "variantId", "position", S.allele("reference").alias("referenceAllele"), S.allele("alternate").alias("alternateAllele"), S.z_score().alias("zScore"))


def variant_filter(loci: DataFrame) -> DataFrame:
    """Distinct (variantId, chromosome) in the loci's arrays."""
    return named(loci.select(F.explode("locus.variantId").alias("variantId"), "chromosome"))


def named(members: DataFrame) -> DataFrame:
    """Distinct (variantId, chromosome) of the members of loci, a row each; no arrays are made for it."""
    return members.where("variantId IS NOT NULL AND chromosome IS NOT NULL").select("variantId", "chromosome").distinct()


def filter_summary(rows: DataFrame, name: str) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.countDistinct("variantId").alias("variant_count"), F.countDistinct("chromosome").alias("chromosome_count")).select(F.lit(name).alias("filter_name"), "*")


def variant_index(*filters: DataFrame) -> DataFrame:
    """Parsed alleles of the requested variants, of those ids that name their own chromosome, a position and two alleles."""
    wanted = reduce(DataFrame.unionByName, [f.select("variantId", "chromosome") for f in filters]).distinct()
    p = S.variant_parts()
    four = (p["n_parts"] == 4) & (F.length(p["referenceAllele"]) > 0) & (F.length(p["alternateAllele"]) > 0)
    kept = wanted.where(four & (p["contig"] == F.col("chromosome")) & p["position"].isNotNull())
    return kept.select("variantId", "chromosome", *[p[c].alias(c) for c in ("position", "referenceAllele", "alternateAllele")])


def index_summary(requested: DataFrame, index: DataFrame) -> DataFrame:
    n = requested.select("variantId", "chromosome").distinct().agg(F.count(F.lit(1)).alias("requested_variant_count"))
    both = n.crossJoin(index.agg(F.count(F.lit(1)).alias("variant_index_count")))
    return both.withColumn("dropped_unparseable_variant_count", F.expr("requested_variant_count - variant_index_count"))


def sample_supported(index: DataFrame, limit: int = 512) -> DataFrame:
    """The first variants by idx with plain alleles, marked whether they are indels."""
    p = S.variant_parts()
    rows = index.select("idx", "variantId", p["referenceAllele"].alias("referenceAllele"), p["alternateAllele"].alias("alternateAllele"))
    ok = S.is_acgt(F.col("referenceAllele")) & S.is_acgt(F.col("alternateAllele"))
    return rows.where(ok).withColumn("isIndel", S.is_indel(F.col("referenceAllele"), F.col("alternateAllele"))).orderBy("idx").limit(limit)
