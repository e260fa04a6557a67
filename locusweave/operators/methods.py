"""Fine-mapping methods: list checks, variant assembly, fan-out to a function a locus set."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import written
from .dataflow import RegistryError

#: Known methods and how each joins the variants of a set's studies.
METHODS = {"multisusie": "union", "susiex": "union", "sushie": "intersection"}
DEFAULT = ("multisusie",)


def validate_methods(names: list[str] | tuple[str, ...]) -> list[str]:
    if not isinstance(names, list | tuple) or not names:
        raise RegistryError("The list of fine-mapping methods is empty")
    if len(set(names)) != len(names):
        raise RegistryError("Fine-mapping methods repeat")
    if unknown := sorted(set(names) - METHODS.keys()):
        raise RegistryError(f"Unknown fine-mapping methods: {', '.join(unknown)}")
    return list(names)


def problem(names: Column) -> Column:
    """Why a list of method names, an array column, is not usable; null if it is."""
    known = F.array(*[F.lit(n) for n in sorted(METHODS)])
    unknown = F.array_sort(F.array_distinct(F.array_except(F.filter(names, lambda x: x.isNotNull()), known)))
    empty = F.coalesce(F.size(names) <= 0, F.lit(True))
    return F.when(empty, "empty").when(F.exists(names, lambda x: x.isNull()), "null").when(F.size(F.array_distinct(names)) < F.size(names), "repeated").when(F.size(unknown) > 0, F.concat(F.lit("unknown: "), F.array_join(unknown, ", ")))


def set_variants(collected: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Variants of each locus set with the number of its studies that have them."""
    v = collected.select(*keys, "fineMappingLocusSetId", "studyId", F.explode("locus.variantId").alias("variantId"))
    sizes = collected.groupBy(*keys, "fineMappingLocusSetId").agg(F.countDistinct("studyId").alias("nStudies"))
    counts = v.groupBy(*keys, "fineMappingLocusSetId", "variantId").agg(F.countDistinct("studyId").alias("nWith"))
    return counts.join(sizes, [*keys, "fineMappingLocusSetId"])


def union_variants(collected: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    return set_variants(collected, keys).select(*keys, "fineMappingLocusSetId", "variantId")


def shared_variants(collected: DataFrame, ld: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """Variants that all studies of a set have and, if LD is given, that every ancestry in it has resolved."""
    out = set_variants(collected, keys).where("nWith = nStudies").select(*keys, "fineMappingLocusSetId", "variantId")
    if ld is not None:
        n = ld.select("ancestry").distinct().count()
        complete = ld.where(F.col("variantIdI") == F.col("variantIdJ")).groupBy(F.col("variantIdI").alias("variantId")).agg(F.countDistinct("ancestry").alias("n")).where(F.col("n") == n)
        out = out.join(complete, "variantId", "left_semi")
    return out


@dataclass(frozen=True)
class Signatures:
    """Variants of locus sets, each variant once.

    Variants that lie in the same loci lie in the same sets, and there are far fewer such
    groups than variants.  variants: variantId and sig, the sorted numbers of its loci;
    sets: sig, fineMappingLocusSetId and nWith, the number of the set's studies that have
    the variants; sizes: fineMappingLocusSetId and nStudies.
    """

    variants: DataFrame
    sets: DataFrame
    sizes: DataFrame


def signatures(members: DataFrame, loci: DataFrame, variants: DataFrame) -> Signatures:
    """members: fineMappingLocusSetId, studyLocusId; loci: studyLocusId, studyId and others; variants: studyLocusId, variantId.

    Only variants of loci that are in sets should be given; one shuffle of them by their id.
    """
    numbered, _ = written(loci.select("studyLocusId", "studyId").distinct().withColumn("number", F.monotonically_increasing_id()), "numbers")
    met = variants.where("variantId IS NOT NULL").join(numbered.select("studyLocusId", "number"), "studyLocusId")
    per, _ = written(met.groupBy("variantId").agg(F.array_sort(F.collect_set("number")).alias("sig")), "signed")
    sets = members.join(numbered, "studyLocusId")
    sizes, _ = written(sets.groupBy("fineMappingLocusSetId").agg(F.countDistinct("studyId").alias("nStudies")), "sizes")
    spread = per.select("sig").distinct().select("sig", F.explode("sig").alias("number"))
    found = spread.join(sets.select("number", "fineMappingLocusSetId", "studyId"), "number")
    counted, _ = written(found.groupBy("sig", "fineMappingLocusSetId").agg(F.countDistinct("studyId").alias("nWith")), "signatures")
    return Signatures(per, counted, sizes)


def _spelled(variants: DataFrame, sets: DataFrame) -> DataFrame:
    """fineMappingLocusSetId, variantId: each variant meets its sets as one row, spelled out where it is read."""
    lists = sets.groupBy("sig").agg(F.collect_list("fineMappingLocusSetId").alias("sets"))
    return variants.join(lists, "sig").select(F.explode("sets").alias("fineMappingLocusSetId"), "variantId")


def union_of(s: Signatures) -> DataFrame:
    """The result of `union_variants`, with a shuffle of a row a variant, not of one a variant and set."""
    return _spelled(s.variants, s.sets)


def shared_of(s: Signatures) -> DataFrame:
    """The result of `shared_variants`: sets that have a group of variants in all studies are few, and known before variants are met."""
    return _spelled(s.variants, s.sets.join(s.sizes, "fineMappingLocusSetId").where("nWith = nStudies"))


@dataclass(frozen=True)
class Method:
    """A model fitted to one locus set: a pandas frame of its variants in, result rows out."""

    name: str
    fit: Callable[[pd.DataFrame], pd.DataFrame]
    schema: T.StructType


def fan_out(variants: DataFrame, methods: list[Method], keys: tuple[str, ...] = ()) -> DataFrame:
    """Results of every method on every set, with the method's name; a set is one group, bounded by its loci."""
    validate_methods([m.name for m in methods])
    group = [*keys, "fineMappingLocusSetId"]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [variants.groupBy(*group).applyInPandas(m.fit, m.schema).withColumn("method", F.lit(m.name)) for m in methods])


def fan_out_of(s: Signatures, members: DataFrame, methods: list[Method]) -> DataFrame:
    """The result of `fan_out` on the union of each set's variants.

    Sets of one first member are fitted by one task, which gets each variant of their loci
    once, so variants shuffle once for each such member near them, not for each set.
    """
    validate_methods([m.name for m in methods])
    home = members.groupBy("fineMappingLocusSetId").agg(F.min("studyLocusId").alias("home"))
    block = s.sets.join(home, "fineMappingLocusSetId").select("home", "fineMappingLocusSetId", "sig")
    wanted, _ = written(block.groupBy("home", "sig").agg(F.collect_list("fineMappingLocusSetId").alias("sets")).withColumn("group", F.monotonically_increasing_id()), "blocks")
    held = wanted.select("sig", "home", "group").join(s.variants, "sig").select("home", "group", "variantId")
    sets = wanted.select(F.col("home").alias("at"), F.col("group").alias("number"), F.explode("sets").alias("fineMappingLocusSetId"))

    def fitted(m: Method) -> DataFrame:
        def run(variants: pd.DataFrame, sets: pd.DataFrame) -> pd.DataFrame:
            groups = {k: g.to_numpy() for k, g in variants.groupby("group")["variantId"]}
            out = []
            for name, numbers in sets.groupby("fineMappingLocusSetId")["number"]:
                ids = np.concatenate([groups[k] for k in numbers])
                out.append(m.fit(pd.DataFrame({"fineMappingLocusSetId": name, "variantId": ids})))
            return pd.concat(out, ignore_index=True)

        return held.groupBy("home").cogroup(sets.groupBy("at")).applyInPandas(run, m.schema).withColumn("method", F.lit(m.name))

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [fitted(m) for m in methods])
