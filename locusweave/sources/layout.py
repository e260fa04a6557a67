"""Summary statistics laid out for clumping: unique, bucketed by (studyId, chromosome, bin), sorted by position.

Writing the layout settles uniqueness once, for all later runs.  Loci then meet their members
bucket by bucket: the bins of the layout are those of the interval join, so the table is
never exchanged again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clumping import BIN_COLUMN, copied_keys, without_copies
from ..operators.intervals import BIN, bin_of
from ..schema import SUMSTATS, conform
from .tables import materialise, scratch

KEYS = ("studyId", "chromosome", BIN_COLUMN)


def lay_out(sumstats: DataFrame, table: str, buckets: int | None = None, path: str | None = None) -> DataFrame:
    """Write the layout as a table of the catalogue, at the path or in the shared folder, and open it.

    Copies of a variant in a study go, all of them; hashes of keys are shuffled to find them, and rows once, into buckets.
    As many buckets as shuffles have partitions, unless told otherwise.
    """
    spark = sumstats.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = without_copies(sumstats, materialise(copied_keys(sumstats)))
    rows = conform(unique, SUMSTATS).withColumn(BIN_COLUMN, bin_of(F.col("position"), BIN))
    # One writer a bucket: the exchange that the buckets are made by deals rows as they are bucketed.
    dealt = rows.repartition(n, *KEYS)
    dealt.write.mode("overwrite").option("path", path or scratch(spark, "layout")).bucketBy(n, *KEYS).sortBy("position").saveAsTable(table)
    return opened(spark, table)


def opened(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
