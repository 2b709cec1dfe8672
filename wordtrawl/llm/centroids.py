"""Centroid clustering of integer vectors with a LAESA pivot table.

Vectors become integers once, and their distances to a few fixed pivots are stored beside them. In every round the pivot
distances of a centroid are computed once; by the triangle inequality the difference to a vector's pivot distances is a lower
bound of their distance. The centroid with the least bound is measured exactly, in integers, and only centroids whose bound
does not exceed that distance are measured too. Bounds are doubles with a margin far above their rounding, so a centroid
that could be nearest, or tie, always survives; distances and means are exact.

A round is one map over the stored table, which gives each task's sums (at most one row per centroid), and an aggregate of
those in two levels. The driver sees the centroids and their sums, never vectors, except for the start: the first ``k``
vectors in hash order, and ``PIVOT_SAMPLE`` more to choose pivots from. Pivots decide only the cost.

Defined cases: vectors that are null, of another length, or hold null or non-finite components are left out, and so are those
with an integer component of 2^26 or more in size, whose squared distances would not fit a long; a null id hashes like the
empty text; repeated rows are vectors of their own (equal ids in the hash order go by their components); fewer than ``k``
vectors give as many centroids; an empty table gives no rows; ties go to the smaller centroid number; a sum of distances that
does not fit a long is null. Other columns are not looked at. There are no texts here.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordtrawl.llm.common import ship, stored

SIZE = 64
CENTROIDS = 8
ROUNDS = 10
SCALE = 1024
#: Fixed pivots, and the vectors (first in hash order) that they are chosen from.
PIVOTS = 12
PIVOT_SAMPLE = 1024
LIMIT = 1 << 26
#: Relative slack of the bounds: far above the rounding of a double, far below a difference that matters for the cost.
SLACK = 1e-9
#: Groups that the sums of tasks meet in first.
GROUPS = 64
BATCH = 16_384


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of ``a`` and ``b``, as 64-bit integers."""
    gap = a.astype(np.int64) - b
    return np.einsum("ij,ij->i", gap, gap)


def _to_each(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of every vector to every point, as doubles of the exact squares."""
    return np.sqrt(np.stack([_squares(vectors, p[None, :]) for p in points], 1).astype(float)) if len(points) else np.zeros((len(vectors), 0))


def spread_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """``n`` vectors of a sample, each the farthest from those chosen before."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = _squares(sample, sample[:1])
    while len(chosen) < min(n, len(sample)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, _squares(sample, sample[chosen[-1]][None, :]))
    return sample[chosen]


def nearest_centroids(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray):
    """(number, squared distance, exact distances computed) of each vector's nearest centroid; ties to the smaller number."""
    own = _to_each(centroids, pivots)
    bounds = np.zeros((len(vectors), len(centroids)))
    for p in range(own.shape[1]):
        np.maximum(bounds, np.abs(to_pivots[:, p, None] - own[None, :, p]), out=bounds)
    slack = SLACK * (1.0 + (to_pivots.max(1) if own.shape[1] else 0.0) + own.max(initial=0.0))
    number = bounds.argmin(1)
    distance = _squares(vectors, centroids[number])
    first = number.copy()
    measured = len(vectors)
    for c in range(len(centroids)):
        alive = np.flatnonzero((first != c) & (bounds[:, c] <= np.sqrt(distance.astype(float)) + slack))
        exact = _squares(vectors[alive], centroids[c][None, :])
        better = (exact < distance[alive]) | ((exact == distance[alive]) & (c < number[alive]))
        number[alive[better]], distance[alive[better]] = c, exact[better]
        measured += len(alive)
    return number, distance, measured


def integer_vectors(table: DataFrame, vector: str = "embedding", key: str = "vec_id", size: int = SIZE, scale: int = SCALE) -> DataFrame:
    """(key, v): floor(scale * x) of every component of the vectors that take part."""
    rows = table.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * scale) < LIMIT)
    kept = rows.filter((F.size("v") == size) & F.forall("v", lambda x: F.coalesce(fine(x), F.lit(False))))
    return kept.select("key", F.transform("v", lambda x: F.floor(x * scale).cast("int")).alias("v"))


def in_hash_order(vectors: DataFrame, seed: int, n: int) -> np.ndarray:
    """The first ``n`` vectors by the hex sha256 of ``seed:key``."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.select(hashed.alias("h"), "v").orderBy("h", "v").limit(n).collect()
    return np.array([row["v"] for row in first], np.int64)


@dataclass(frozen=True)
class Clusters:
    """``assigned``: (key, cluster, distance) of every vector, lazily; the rest is small and final."""

    assigned: DataFrame
    centroids: np.ndarray
    inertias: list[int]
    measured: int


def _arrays(batch: pa.RecordBatch, size: int) -> tuple[np.ndarray, np.ndarray]:
    vectors = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return vectors, batch.column("pivots").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _pieces(batches):
    for batch in batches:
        for first in range(0, batch.num_rows, BATCH):
            yield batch.slice(first, BATCH)


def cluster(
    vectors: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = 3, size: int = SIZE, pivots: int = PIVOTS
) -> Clusters:
    """``rounds`` rounds of assignment and exact floor means over (key, v), then one last assignment."""
    spark = vectors.sparkSession
    ship(spark)
    key_type = vectors.schema["key"].dataType.simpleString()
    vectors = stored(vectors)
    sample = in_hash_order(vectors, seed, max(k, PIVOT_SAMPLE))
    start, chosen = sample[:k], spread_pivots(sample, pivots)

    def measured_to_pivots(batches):
        for batch in _pieces(batches):
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            far = _to_each(values, chosen)
            ends = np.arange(0, far.size + 1, len(chosen) or 1, dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["key", "v", "pivots"])

    if not len(start):
        return Clusters(vectors.selectExpr("key", "0 AS cluster", "0L AS distance"), start, [], 0)
    table = stored(vectors.mapInArrow(measured_to_pivots, f"key {key_type}, v array<int>, pivots array<double>"))

    def sums_for(centroids: np.ndarray):
        def sums(batches):
            total = np.zeros((len(centroids), size + 3), object)
            for batch in _pieces(batches):
                values, far = _arrays(batch, size)
                number, distance, exact = nearest_centroids(values, far, centroids, chosen)
                for c in np.unique(number).tolist():
                    mine = number == c
                    total[c, :size] += values[mine].sum(0, dtype=np.int64).astype(object)
                    total[c, size] += int(mine.sum())
                    total[c, size + 1] += sum(distance[mine].tolist())
                total[0, size + 2] += exact
            cluster, place = (x.ravel() for x in np.indices(total.shape, dtype=np.int32))
            values = pa.array([Decimal(int(x)) for x in total.ravel()], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(cluster), pa.array(place), values], names=["cluster", "place", "value"])

        parts = table.mapInArrow(sums, "cluster int, place int, value decimal(38,0)")
        some = parts.groupBy("cluster", "place", F.spark_partition_id() % GROUPS).agg(F.sum("value").alias("value"))
        whole = some.groupBy("cluster", "place").agg(F.sum("value").cast("decimal(38,0)").alias("value"))
        found = np.zeros((len(centroids), size + 3), object)
        for row in whole.collect():
            found[row["cluster"], row["place"]] = int(row["value"])
        return found.tolist()

    centroids, measured = start, 0
    for _ in range(rounds):
        means = []
        for old, (*sums, n, _, exact) in zip(centroids.tolist(), sums_for(centroids)):
            means.append([s // n for s in sums] if n else old)
            measured += exact
        centroids = np.array(means, np.int64)
    last = sums_for(centroids)
    measured += sum(row[-1] for row in last)

    def assigned(batches):
        for batch in _pieces(batches):
            values, far = _arrays(batch, size)
            number, distance, _ = nearest_centroids(values, far, centroids, chosen)
            columns = [batch.column("key"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "cluster", "distance"])

    rows = table.mapInArrow(assigned, f"key {key_type}, cluster int, distance bigint")
    return Clusters(rows, centroids, [row[-2] for row in last], measured)


def described(clusters: Clusters, key: str = "vec_id") -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector."""
    spark = clusters.assigned.sparkSession
    fits = lambda n: n if n < 1 << 63 else None
    total = fits(sum(clusters.inertias))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in clusters.centroids.tolist()]
    facts = [(c, fits(own), total, digest) for c, (own, digest) in enumerate(zip(clusters.inertias, digests))]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    rows = clusters.assigned.join(F.broadcast(facts), "cluster")
    return rows.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
