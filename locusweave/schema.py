"""Dataset contracts: column order and types of every input and output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_s, _i, _d, _f, _b, _l = T.StringType(), T.IntegerType(), T.DoubleType(), T.FloatType(), T.BooleanType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


SUMSTATS = _struct(studyId=_s, variantId=_s, chromosome=_s, position=_i, beta=_d, sampleSize=_i, pValueMantissa=_f, pValueExponent=_i, effectAlleleFrequencyFromSource=_f, standardError=_d)

LOCUS_VARIANT = _struct(is95CredibleSet=_b, is99CredibleSet=_b, logBF=_d, posteriorProbability=_d, variantId=_s, pValueMantissa=_f, pValueExponent=_i, beta=_d, standardError=_d, r2Overall=_d)

STUDY_LOCUS = T.StructType(
    [
        T.StructField("studyLocusId", _s, False),
        T.StructField("studyId", _s, False),
        T.StructField("variantId", _s, False),
        *SUMSTATS.fields[2:],
        T.StructField("qualityControls", T.ArrayType(_s)),
        T.StructField("locusStart", _i),
        T.StructField("locusEnd", _i),
        T.StructField("locus", T.ArrayType(LOCUS_VARIANT)),
    ]
)

COLLECTED_VARIANT = _struct(variantId=_s, pValueMantissa=_f, pValueExponent=_i, beta=_d, standardError=_d)
COLLECTED_LOCUS = _struct(fineMappingLocusSetId=_s, studyLocusId=_s, studyId=_s, chromosome=_s, locusStart=_i, locusEnd=_i, qualityControls=T.ArrayType(_s), locus=T.ArrayType(COLLECTED_VARIANT))

PAIRWISE_LD = _struct(ancestry=_s, variantIdI=_s, variantIdJ=_s, r=_d)
LD_REQUEST = _struct(locus_id=_s, locus=_s, variant_ids=T.ArrayType(_s))
LD_MAPPING = _struct(locus_id=_s, native_variant_id=_s, original_variant_id=_s)
LD_NATIVE_PAIR = _struct(locus_id=_s, idx_i=_l, idx_j=_l, r=_d)
LD_NATIVE_STATUS = _struct(locus_id=_s, requested_variant_id=_s, idx=_l, allele_order=_i, status_code=_i)
LD_STATS = _struct(ancestry=_s, n_requested_variants=_l, n_resolved_variants=_l, n_unresolved_variants=_l, n_unsupported_variants=_l, n_ld_pairs=_l)
LD_RUN_STATS = T.StructType([*LD_STATS.fields, *_struct(native_materialize_seconds=_d, adapter_seconds=_d, peak_child_rss_kib=_l).fields])

STATUS = _struct(runId=_s, path=_s, validationStage=_s, reason=_s)
MANIFEST = _struct(runId=_s, studyId=_s, route=_s, summarystatsLocation=_s, majorAncestry=_s, traitFromSourceMappedIds=_s, effectiveSampleSize=_i)
STUDY_METADATA = _struct(studyId=_s, ancestry=_s, sampleSize=_i)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """df with the contract's columns in its order and types; missing columns are null.

    A fractional number becomes an integer by rounding half to even.
    """
    have = {f.name.lower(): f for f in df.schema.fields}
    out = []
    for f in schema.fields:
        own = have.get(f.name.lower())
        if own is None:
            col = F.lit(None)
        elif isinstance(f.dataType, T.IntegerType | T.LongType) and isinstance(own.dataType, T.DoubleType | T.FloatType | T.DecimalType):
            col = F.rint(F.col(own.name))
        else:
            col = F.col(own.name)
        out.append(col.cast(f.dataType).alias(f.name))
    return df.select(*out)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed dataset without rows."""
    return spark.createDataFrame([], schema)
