"""Resampling documents toward a target's n-gram distribution, from tables of word positions.

Words of all texts are exploded with their positions; a window over each document leads the
following words to every position, so each row names the runs of 1 to `orders` words that
begin there.  A run's bucket is its crc32 modulo `dims`.  Counting buckets over all
documents and over all target texts gives a gain a bucket (a scaled logarithm of the ratio
of their smoothed shares), buckets join their gains, and a document's weight is their sum.
Gumbel noise from a hash of doc_id makes the highest scores a sample without replacement,
in proportion to the exponentials of the weights.

Texts shuffle once, whole, dealt by row, so a window has no exchange and no word, source or
doc_id is a hot key.  The buckets of all positions are a table in the shared folder, read
for the counts and again for the weights.  Gains are at most `dims` rows, a parameter, and
broadcast.  Ranks come from a range sort whose partitions are counted, so no task ranks all.

Defined cases: null and empty text and text without a word has no feature, weight 0, and its
noise alone as score; a very long text is one window, which spills; rows with one doc_id are documents
of their own with one noise; a null doc_id is hashed as "null" and ranks behind others of its score;
documents with equal score and doc_id rank in any order; an empty target gives
gains by the corpus alone; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import remove_path, written
from .runtime import prepare, spread

ORDERS, DIMS = 3, 10_000
MIN_WORDS, PERCENT, SEED = 20, 5, 42
SCALE = 1000
#: What stands between words, and the letters that are lower-cased.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, CAPITALS, SMALL), BETWEEN), "")


def positions(texts: DataFrame, orders: int = ORDERS, dims: int = DIMS) -> DataFrame:
    """row, doc_id, b1 to b<orders>: buckets of the runs that begin at each word, null where the text ends before.

    A text without a word has one row without buckets.
    """
    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    table = spread(rows, "row").select("row", "doc_id", F.posexplode_outer(words(F.col("text"))).alias("pos", "word"))
    at = Window.partitionBy("row").orderBy("pos")
    table = table.select("row", "doc_id", F.col("word").alias("w1"), *[F.lead("word", k).over(at).alias(f"w{k + 1}") for k in range(1, orders)])
    bucket = lambda n: (F.crc32(reduce(lambda a, b: F.concat(a, F.lit(" "), b), [F.col(f"w{k}") for k in range(1, n + 1)]).cast("binary")) % dims).cast("int")
    return table.select("row", "doc_id", *[bucket(n).alias(f"b{n}") for n in range(1, orders + 1)])


def _each(table: DataFrame, orders: int, *columns: str) -> DataFrame:
    """A row with `bucket` for each bucket of each position, null ones too."""
    return table.select(*columns, F.explode(F.array(*[f"b{n}" for n in range(1, orders + 1)])).alias("bucket"))


def counts(table: DataFrame, orders: int = ORDERS) -> DataFrame:
    """bucket, n over all rows of a table of positions."""
    return _each(table, orders).where(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))


def gains(corpus: DataFrame, target: DataFrame, dims: int = DIMS) -> DataFrame:
    """bucket, gain of the buckets that the corpus has, from counts of both."""
    total = lambda df: F.lit(float(df.agg(F.sum("n")).first()[0] or 0))
    mine, other = total(corpus), total(target)
    both = corpus.select("bucket", F.col("n").cast("double").alias("s")).join(target.select("bucket", F.col("n").cast("double").alias("t")), "bucket", "left")
    t = F.coalesce("t", F.lit(0.0)) + 1.0
    return both.select("bucket", F.floor(SCALE * F.ln(t * (mine + float(dims)) / ((F.col("s") + 1.0) * (other + float(dims))))).alias("gain"))


def noise(doc_id: str | Column, seed: int = SEED) -> Column:
    """Gumbel noise, scaled and floored, from the first 32 bits of a hash of seed and doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit("null")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def scored(docs: DataFrame, target: DataFrame, orders: int = ORDERS, dims: int = DIMS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row of docs; target: rows with a text."""
    spark = docs.sparkSession
    prepare(spark)
    table, at = written(positions(docs.select("doc_id", "text"), orders, dims), "positions")
    aims, aims_at = written(positions(target.select(F.lit(None).cast("string").alias("doc_id"), "text"), orders, dims), "positions")
    worth, worth_at = written(gains(counts(table, orders), counts(aims, orders), dims), "gains")  # at most dims rows
    joined = _each(table.withColumn("words", F.col("b1").isNotNull().cast("int")), orders, "row", "doc_id").join(F.broadcast(worth), "bucket", "left")
    sums = joined.groupBy("row", "doc_id").agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))
    out, _ = written(sums.select("doc_id", _n_words(F.col("n_features"), orders).alias("n_words"), "n_features", "weight", (F.col("weight") + noise("doc_id", seed)).alias("score")), "scores")
    for path in (at, aims_at, worth_at):
        remove_path(spark, path)
    return out


def _n_words(n_features: Column, orders: int) -> Column:
    """How many words have so many runs: n + (n - 1) + ... for as many orders as fit."""
    short = reduce(lambda c, n: c.when(n_features == sum(range(n, max(n - orders, 0), -1)), n), range(1, orders), F.when(n_features == 0, 0))
    return short.otherwise(F.floor((n_features + orders * (orders - 1) // 2) / orders)).cast("long")


def ranked(scores: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """scores with the rank of the drawn: `percent` of the documents of min_words or more, by score, ties to the smaller doc_id."""
    spark = scores.sparkSession
    fits = F.coalesce(F.col("n_words") >= min_words, F.lit(False))
    n = scores.agg(F.count(F.when(fits, 1))).first()[0]
    order = [F.desc("_fits"), F.desc("score"), F.asc_nulls_last("doc_id")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = scores.withColumn("_fits", fits).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number of a row is that of its partition, shifted, and its place there.
    placed, _ = written(sorted_rows.withColumn("_at", F.monotonically_increasing_id()), "ranks")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))  # a row a partition
    rank = F.col("_before") + place + 1
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(*scores.columns, F.when(F.col("_fits") & (rank <= n * percent // 100), rank).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn rows of docs, all columns kept; of rows that share a doc_id all come, if one is drawn; rows without doc_id don't."""
    chosen = ranked(scored(docs, target, seed=seed), percent, min_words).where("rank is not null and doc_id is not null").select(F.col("doc_id").alias("_drawn_doc_id")).distinct()
    return docs.join(chosen, F.col("doc_id") == F.col("_drawn_doc_id"), "left_semi")
