"""Reports, study-set analysis and the comparison of outputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import semantics as S


def _n_variants(loci: DataFrame) -> Column:
    """A locus's number of variants: nVariants where it is counted already (`clumping.with_sizes`), else the size of its array."""
    return F.col("nVariants") if "nVariants" in loci.columns else F.size("locus")


def clumping_report(loci: DataFrame, per: tuple[str, ...] = ()) -> DataFrame:
    """Per study: loci, and mean, largest and smallest number of their variants."""
    n = _n_variants(loci)
    return loci.groupBy(*per, "studyId").agg(F.count(F.lit(1)).alias("nLoci"), F.avg(n).alias("meanLocusSize"), F.max(n).alias("maxLocusSize"), F.min(n).alias("minLocusSize"))


def clumping_report_of(inputs: list[DataFrame]) -> DataFrame:
    """The reports of several inputs under each other: a study in two of them has two rows."""
    return reduce(DataFrame.unionByName, [clumping_report(x) for x in inputs])


def project_counts(study: DataFrame, types: tuple[str, ...] = ("gwas", "pqtl")) -> DataFrame:
    return study.where(F.col("studyType").isin(*types)).groupBy("projectId").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "projectId")


def credible_set_counts(credible_set: DataFrame, study: DataFrame, projects: tuple[str, ...], by_method: bool = False) -> DataFrame:
    rows = credible_set.join(study.where(F.col("projectId").isin(*projects)).select("studyId", "projectId"), "studyId")
    if by_method:
        return rows.groupBy("finemappingMethod", "projectId").agg(F.count(F.lit(1)).alias("n"))
    return rows.groupBy("projectId").agg(F.count(F.lit(1)).alias("n_credible_sets"), F.countDistinct("studyId").alias("n_studies"))


def _populations(study: DataFrame) -> DataFrame:
    ok = study.where((F.col("studyType") == "gwas") & F.col("hasSumstats") & (F.size("ldPopulationStructure") >= 1))
    return ok.select("studyId", "nSamples", S.trait_key("diseaseIds").alias("trait_key"), F.explode("ldPopulationStructure.ldPopulation").alias("pop"))


def trait_sets(study: DataFrame) -> DataFrame:
    """One row: sets of studies of one trait, how many span ancestries, and the largest."""
    sets = _populations(study).groupBy("trait_key").agg(F.countDistinct("studyId").alias("n_studies"), F.countDistinct("pop").alias("n_ancestries"))
    n = lambda c: F.count(F.when(c, 1))
    a = F.col("n_ancestries")
    return sets.agg(F.count(F.lit(1)).alias("total_sets"), n(a >= 2).alias("cross_ancestry_sets"), n(a == 1).alias("single_ancestry_sets"), F.max("n_studies").alias("max_studies_in_a_set"), F.max("n_ancestries").alias("max_ancestries_in_a_set"))


def representatives(study: DataFrame) -> DataFrame:
    """The largest study of each trait and ancestry; ties go to the smaller studyId."""
    w = Window.partitionBy("trait_key", "pop").orderBy(F.desc_nulls_last("nSamples"), "studyId")
    return _populations(study).withColumn("rk", F.row_number().over(w)).where("rk = 1").drop("rk")


def ancestry_distribution(study: DataFrame) -> DataFrame:
    sets = representatives(study).groupBy("trait_key").agg(F.countDistinct("pop").alias("n_ancestries"))
    return sets.where("n_ancestries >= 2").groupBy("n_ancestries").agg(F.count(F.lit(1)).alias("n_sets")).orderBy("n_ancestries")


def largest_file(with_file: DataFrame, file: str = "sourceFile") -> DataFrame:
    """The file whose loci have most variants in all."""
    return with_file.groupBy(file).agg(F.sum(_n_variants(with_file)).alias("nVariants")).orderBy(F.desc("nVariants"), file).limit(1)


def normalised(df: DataFrame, decimals: int = 10) -> DataFrame:
    """Columns by name, NaN as null, numbers rounded, arrays sorted: equal rows are equal whatever their order."""

    def of(c, kind):
        if isinstance(kind, T.DoubleType | T.FloatType):
            d = c.cast("double")
            return F.when(F.isnan(d), F.lit(None)).otherwise(F.round(d, decimals))
        if isinstance(kind, T.ArrayType):
            return F.array_sort(F.transform(c, lambda x: of(x, kind.elementType)))
        if isinstance(kind, T.StructType):
            return F.when(c.isNotNull(), F.struct(*[of(c[f.name], f.dataType).alias(f.name) for f in sorted(kind.fields, key=lambda f: f.name)]))
        return c

    return df.select(*[of(F.col(f.name), f.dataType).alias(f.name) for f in sorted(df.schema.fields, key=lambda f: f.name)])


def differences(first: DataFrame, second: DataFrame, decimals: int = 10) -> DataFrame:
    """Rows, with their side and count, that one of the two has more often than the other.

    Rows are grouped by their whole normalised JSON, in one shuffle; `field_differences` has a tolerance and tells fields.
    """
    side = lambda df, s: normalised(df, decimals).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")).withColumn("n", F.lit(s))
    both = side(first, 1).unionByName(side(second, -1))
    return both.groupBy("row").agg(F.sum("n").alias("n")).where("n <> 0").select(F.when(F.col("n") > 0, "first").otherwise("second").alias("side"), F.abs("n").alias("count"), "row")


_DIFFERENCE = "array<struct<field: string, first: string, second: string, difference: double>>"
_FLOATS = (T.DoubleType, T.FloatType)


def _is_float(kind: T.DataType) -> bool:
    return isinstance(kind, _FLOATS)


def _exact_first(df_fields: list[T.StructField]) -> list[T.StructField]:
    """Fields in the order by which rows are ranked: those without floats, then floats, both by name; no nested ones."""
    plain = [f for f in sorted(df_fields, key=lambda f: f.name) if not isinstance(f.dataType, T.ArrayType | T.StructType | T.MapType)]
    return [f for f in plain if not _is_float(f.dataType)] + [f for f in plain if _is_float(f.dataType)]


def _sorted(c: Column, element: T.DataType) -> Column:
    """An array in an order that small differences of floats don't change, as far as other fields tell."""
    if isinstance(element, T.StructType):
        order = F.transform(c, lambda x: F.struct(F.struct(*[x[f.name].alias(f.name) for f in _exact_first(element.fields)]).alias("k"), x.alias("x")))
        return F.transform(F.array_sort(order), lambda y: y["x"])
    return F.array_sort(c)


def _different(path: Column, a: Column, b: Column, kind: T.DataType, tolerance: float) -> Column:
    """The differences of two values of one type, as structs in an array."""
    none = F.array().cast(_DIFFERENCE)

    def told(first: Column, second: Column, far: Column | None = None) -> Column:
        return F.array(F.struct(path.alias("field"), first.cast("string").alias("first"), second.cast("string").alias("second"), (F.lit(None) if far is None else far).cast("double").alias("difference"))).cast(_DIFFERENCE)

    if _is_float(kind):
        value = lambda c: F.when(~F.isnan(c.cast("double")), c.cast("double"))  # noqa: E731  NaN is as good as null
        x, y = value(a), value(b)
        far = F.abs(x - y)
        return F.when(x.eqNullSafe(y) | F.coalesce(far <= tolerance, F.lit(False)), none).otherwise(told(x, y, far))
    if isinstance(kind, T.StructType):
        parts = F.concat(*[_different(F.concat(path, F.lit(f".{f.name}")), a[f.name], b[f.name], f.dataType, tolerance) for f in kind.fields])
        return F.when(a.isNull() & b.isNull(), none).when(a.isNull() | b.isNull(), told(F.to_json(a), F.to_json(b))).otherwise(parts)
    if isinstance(kind, T.ArrayType):
        at = lambda p, i: _different(F.concat(path, F.lit("["), i.cast("string"), F.lit("]")), F.get(p["x"], i), F.get(p["y"], i), kind.elementType, tolerance)
        # The sorted arrays are an element of their own, so they are sorted once and not at each mention.
        pair = F.array(F.struct(_sorted(a, kind.elementType).alias("x"), _sorted(b, kind.elementType).alias("y")))
        through = lambda p: F.flatten(F.transform(F.sequence(F.lit(0), F.size(p["x"]) - 1), lambda i: at(p, i)))
        each = F.when(F.size(a) > 0, F.flatten(F.transform(pair, through))).otherwise(none)
        size = lambda c: F.when(c.isNotNull(), F.size(c))
        sizes = told(F.concat(F.lit("size "), size(a).cast("string")), F.concat(F.lit("size "), size(b).cast("string")))
        return F.when(a.isNull() & b.isNull(), none).when(~size(a).eqNullSafe(size(b)), sizes).otherwise(each)
    if isinstance(kind, T.MapType):
        entries = T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]))
        return _different(path, F.map_entries(a), F.map_entries(b), entries, tolerance)
    return F.when(a.eqNullSafe(b), none).otherwise(told(a, b))


def field_differences(first: DataFrame, second: DataFrame, keys: tuple[str, ...], tolerance: float = 1e-9) -> DataFrame:
    """The keys, place, kind, field, first, second and difference of all that differs between two tables of one schema.

    Rows of equal keys are ranked, by their fields without floats and then by floats, and meet
    by rank; a row that has no partner is `missing` (from second) or `extra`.  Partners are
    compared field by field: floats by the absolute tolerance (NaN as null), arrays without regard to
    their order, structs in them by field, arrays of unlike size by size.  Keys must not be
    floats.  A column that only one table has is null in the other.
    """
    both = {f.name: f for f in [*second.schema.fields, *first.schema.fields]}
    if lost := [k for k in keys if k not in first.columns or k not in second.columns]:
        raise KeyError(f"not in both tables: {', '.join(lost)}")
    if bad := [k for k in keys if _is_float(both[k].dataType)]:
        raise ValueError(f"keys must not be floats: {', '.join(bad)}")
    fields = [both[n] for n in sorted(both) if n not in keys]

    names = [f"k{i}" for i in range(len(keys))]

    def side(df: DataFrame, name: str) -> DataFrame:
        value = F.struct(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]) if fields else F.lit(None)
        return df.select(*[F.col(f"`{k}`").alias(n) for n, k in zip(names, keys, strict=True)], F.lit(name).alias("side"), F.struct(value.alias("v")).alias("row"))

    # One exchange by key for both tables: ranks, and partners of one rank, are found within its partitions.
    both_sides = side(first, "a").unionByName(side(second, "b")).repartition(*names)
    order = [F.col(f"row.v.`{f.name}`") for f in _exact_first(fields)] or [F.lit(0)]
    placed = both_sides.withColumn("place", F.row_number().over(Window.partitionBy(*names, "side").orderBy(*order)))
    partner = Window.partitionBy(*names, "place").orderBy("side")
    met = placed.select("*", F.lead("row").over(partner).alias("_next"), F.lag("side").over(partner).alias("_before"))
    met = met.where((F.col("side") == "a") | F.col("_before").isNull())
    met = met.select(*names, "place", F.when(F.col("side") == "a", F.col("row")).alias("a"), F.when(F.col("side") == "b", F.col("row")).otherwise(F.col("_next")).alias("b"))
    here, there = F.col("a").isNotNull(), F.col("b").isNotNull()
    whole = lambda kind: F.array(F.struct(F.lit(kind).alias("kind"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("first"), F.lit(None).cast("string").alias("second"), F.lit(None).cast("double").alias("difference")))
    values = F.concat(F.array().cast(_DIFFERENCE), *[_different(F.lit(f.name), F.col(f"a.v.`{f.name}`"), F.col(f"b.v.`{f.name}`"), f.dataType, tolerance) for f in fields])
    told = F.transform(values, lambda d: F.struct(F.when(d["field"].contains(".") | d["field"].contains("["), "nested").otherwise("value").alias("kind"), d["field"].alias("field"), d["first"].alias("first"), d["second"].alias("second"), d["difference"].alias("difference")))
    found = met.select(*[F.col(n).alias(k) for n, k in zip(names, keys, strict=True)], "place", F.explode(F.when(~there, whole("missing")).when(~here, whole("extra")).otherwise(told)).alias("d"))
    return found.select(*[F.col(f"`{k}`") for k in keys], "place", "d.*")
