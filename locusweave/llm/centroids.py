"""Centroid clustering by sort-means, in exact integers.

Before each round the other centroids are ordered by their distance from each centroid.  A
vector scans this order from the centroid it had: by the triangle inequality none is nearer
(nor as near) that lies strictly beyond twice the vector's distance from the one it had, so
the scan stops there.  Distances are squared and integer, the rule being D(c, c') > 4 D(x, c), so
results are those of a full scan, whatever the order of rows.

Each round is a pass of Arrow batches over a table of vectors with their clusters, whose result is the next
table; the one before goes.  Sums by cluster are combined on the map side, so a hot cluster is
a row a task.  The driver sees k centroids of `dims` numbers and k sums, whatever the input.

Defined cases: vectors of another length, or with a null or non-finite component, are left
out, as is a null vector; components are floor(`scale` * x), and one beyond +-LIMIT is an
error, since its distances may not fit a long; repeated rows are vectors of their own; a null vec_id hashes as "null"; of
centroids equally near the smaller number wins; with fewer vectors than k there are as many
centroids; an empty cluster keeps its centroid; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.tables import remove_path, written
from . import textbatch as tb
from .runtime import prepare

K, DIMS, ROUNDS, SCALE, SEED = 40, 64, 5, 256, 2
LIMIT = 1 << 27
BATCH = 4096  # vectors handled at once


def points(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id, point (array of ints) of the vectors that count."""
    x = F.transform(F.col(vector), lambda v: v.cast("double"))
    whole = (F.size(x) == dims) & F.forall(x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False)))
    rows = vectors.select(F.col(id).alias("vec_id"), x.alias("x"), whole.alias("whole")).where("whole")
    beyond = F.raise_error(F.concat(F.lit("vector "), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")), F.lit(f" has a component beyond {LIMIT}"))).cast("array<double>")
    scaled = F.transform("x", lambda v: v * float(scale))
    fit = F.when(F.forall(scaled, lambda v: F.abs(v) <= float(LIMIT)), scaled).otherwise(beyond)
    return rows.select("vec_id", F.transform(fit, lambda v: F.floor(v).cast("int")).alias("point"))


def first_centroids(rows: DataFrame, k: int = K, seed: int = SEED) -> np.ndarray:
    """The k vectors whose ids have the smallest hashes, in their order."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null")))
    got = rows.select(F.sha2(name, 256).alias("h"), "point").orderBy("h", "point").limit(k).collect()
    return np.array([r.point for r in got], np.int64)


class Order:
    """Centroids, with the others of each by distance."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        apart = ((centroids[:, None, :] - centroids[None]) ** 2).sum(2)
        self.others = np.argsort(apart, 1, kind="stable")
        self.apart = np.take_along_axis(apart, self.others, 1)

    def nearest(self, x: np.ndarray, had: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cluster, squared distance) of each row of x, each scanned from the cluster it had."""
        own = ((x - self.centroids[had]) ** 2).sum(1)
        best, least = had.astype(np.int64), own.copy()
        for c in np.unique(had):
            rows = np.flatnonzero(had == c)
            rows = rows[np.argsort(-own[rows], kind="stable")]  # those whose scan goes farthest first
            reach = -4 * own[rows]
            for other, apart in zip(self.others[c].tolist(), self.apart[c].tolist(), strict=True):
                if other == c:
                    continue
                n = int(np.searchsorted(reach, -apart, "right"))
                if not n:
                    break
                at = rows[:n]
                d = ((x[at] - self.centroids[other]) ** 2).sum(1)
                wins = (d < least[at]) | (d == least[at]) & (other < best[at])
                best[at[wins]], least[at[wins]] = other, d[wins]
        return best, least


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """rows (vec_id, point, cluster) with the nearest centroid as cluster, and its squared distance."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)  # k * dims numbers

    def run(batches):
        order = Order(shared.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                b = batch.slice(lo, BATCH)
                flat = b.column("point").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                cluster, distance = order.nearest(flat.reshape(b.num_rows, -1), b.column("cluster").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("point"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "point", "cluster", "distance"])

    schema = T.StructType([rows.schema["vec_id"], T.StructField("point", T.ArrayType(T.IntegerType())), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    return rows.select("vec_id", "point", "cluster").mapInArrow(tb.task(run), schema)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Floors of the means of the clusters' vectors; those of empty ones stay."""
    out = centroids.copy()
    each = [F.sum(F.col("point")[i].cast("long")).alias(f"s{i}") for i in range(centroids.shape[1])]
    for r in rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *each).collect():  # k rows
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(centroids.shape[1])]
    return out


def cluster(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", k: int = K, dims: int = DIMS, rounds: int = ROUNDS, scale: int = SCALE, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, point, cluster and distance of every vector that counts; the centroids)."""
    spark = vectors.sparkSession
    prepare(spark)
    rows, at = written(points(vectors, id, vector, dims, scale).withColumn("cluster", F.lit(0)), "vectors")
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return rows.withColumn("distance", F.lit(0).cast("long")), np.zeros((0, dims), np.int64)
    for _ in range(rounds):
        (rows, here), before = written(assign(rows, centroids), "vectors"), at
        remove_path(spark, before)
        at, centroids = here, moved(rows, centroids)
    out, _ = written(assign(rows, centroids), "vectors")
    remove_path(spark, at)
    return out, centroids


def digest(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of cluster()'s result."""
    spark = rows.sparkSession
    names = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())], "cluster int, centroid_sha256 string")
    per = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    total = per.agg(F.sum("cluster_inertia")).first()[0]
    own = per.join(names, "cluster").withColumn("inertia", F.lit(total).cast("long"))  # k rows
    return rows.select("vec_id", "cluster", "distance").join(F.broadcast(own), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
