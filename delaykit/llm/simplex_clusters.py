"""Centroid clustering of integer vectors, centroids filtered by n-simplex projection (method 12).

The distances of every vector to a few pivots are taken once and kept as apex coordinates: the place of
the vector's foot in the simplex of the pivots, and its height above it. For two points so described, the
Euclidean distance with the heights on one side is a lower bound of their distance, with the heights on
both sides an upper bound. In each round the centroids get their own apex; a vector is compared in whole
numbers only with centroids whose lower bound is not above the least upper bound.

Components are floor(1024 * x). Vectors of another length, with a null or non-finite component, or with
one of 131072 (2^17) or more, whose squared distances would not fit a long, are left out. Rows with equal
ids are separate rows; a null id is hashed as the empty text. Where hashes of ids tie, the lesser vector
goes first. Fewer vectors than clusters: each is a centroid. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit.llm.common import in_arrow, written

SCALE = 1024
LARGEST = 1 << 17
PIVOTS = 6


class Simplex:
    """Apex coordinates over the first pivots that span something."""

    def __init__(self, points: np.ndarray, count: int = PIVOTS):
        points = points.astype(np.float64)
        self.pivots, self.base = points[:1], np.zeros((1, 0))
        for p in points[1:]:
            if len(self.pivots) == count:
                break
            apex = self.apexes(p[None])[0]
            # a pivot that lies in the plane of the others adds no coordinate
            if apex[-1] > 1e-3 * np.sqrt(((p - self.pivots[0]) ** 2).sum()) and apex[-1] > 1:
                self.base = np.vstack([np.pad(self.base, ((0, 0), (0, 1))), apex])
                self.pivots = np.vstack([self.pivots, p])

    def apexes(self, points: np.ndarray) -> np.ndarray:
        """One row of foot and height for each point, from its distances to the pivots alone."""
        squares = np.stack([((points - p) ** 2).sum(1) for p in self.pivots.astype(points.dtype)], 1).astype(np.float64)
        foot = np.zeros((len(points), len(self.pivots) - 1))
        for j in range(1, len(self.pivots)):
            own = self.base[j, :j]
            right = (squares[:, 0] - squares[:, j] + (own**2).sum()) / 2
            foot[:, j - 1] = (right - foot[:, : j - 1] @ own[:-1]) / own[-1]
        height = np.sqrt(np.maximum(0, squares[:, 0] - (foot**2).sum(1)))
        return np.column_stack([foot, height])


def candidates(own: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each point (rows of apexes) and centroid: may it be the nearest?"""
    flat = ((own[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(2)
    low = flat + (own[:, None, -1] - centres[None, :, -1]) ** 2
    high = flat + (own[:, None, -1] + centres[None, :, -1]) ** 2
    slack = 1e-6 * (1 + high.max(1, initial=0) + (own**2).sum(1))  # far more than the rounding of the bounds
    return low <= (high.min(1) + slack)[:, None]


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each vector; the smaller number wins a tie."""
    may = candidates(apexes, centres)
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    cluster = np.zeros(len(vectors), np.int32)
    for k, centroid in enumerate(centroids):
        rows = np.flatnonzero(may[:, k])
        distance = ((vectors[rows] - centroid) ** 2).sum(1)
        closer = distance < best[rows]
        best[rows[closer]], cluster[rows[closer]] = distance[closer], k
    return cluster, best


def whole_vectors(df: DataFrame, dimension: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    x = F.transform(F.col(f"`{vector_col}`"), lambda c: c.cast("double"))
    fit = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    return df.filter((F.size(F.col(f"`{vector_col}`")) == dimension) & fit).select(
        F.col(f"`{id_col}`").alias("vec_id"), F.transform(x, lambda c: F.floor(SCALE * c).cast("int")).alias("v")
    )


def matrix(lists: pa.Array, dtype) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(lists), -1)


def with_apex(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                apex = simplex.apexes(matrix(batch.column(1), np.int64))
                at = np.arange(0, apex.size + 1, apex.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(pa.array(at), pa.array(apex.ravel()))], ["vec_id", "v", "apex"]
                )

    fields = T.StructType([*vectors.schema.fields, T.StructField("apex", T.ArrayType(T.DoubleType()))])
    return in_arrow(vectors, run, fields)


def sums(known: DataFrame, centroids: np.ndarray, centres: np.ndarray) -> list:
    """Rows (cluster, n, total): one short row per task and cluster is shuffled."""
    k, width = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)
        for batch in batches:
            if batch.num_rows:
                vectors = matrix(batch.column(0), np.int64)
                cluster, _ = nearest(vectors, matrix(batch.column(1), np.float64), centroids, centres)
                count += np.bincount(cluster, minlength=k)
                for c in np.unique(cluster):
                    total[c] += vectors[cluster == c].sum(0)
        at = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(at) * width + 1, width, dtype=np.int32)), pa.array(total[at].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at]), lists], ["cluster", "n", "total"])

    parts = in_arrow(known.select("v", "apex"), run, "cluster int, n long, total array<long>")
    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *exact).collect()


def assigned(known: DataFrame, centroids: np.ndarray, centres: np.ndarray) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                found = nearest(matrix(batch.column(1), np.int64), matrix(batch.column(2), np.float64), centroids, centres)
                yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, found)], ["vec_id", "cluster", "distance"])

    fields = T.StructType([known.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    return in_arrow(known.select("vec_id", "v", "apex"), run, fields)


def clusters(
    df: DataFrame, k: int = 8, rounds: int = 10, dimension: int = 64, seed: int = 3, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector kept.

    The ``k`` first centroids are the vectors with the smallest SHA-256 of ``seed:id``; each of ``rounds``
    rounds puts a centroid at the floor of its vectors' mean. Centroids, k short rows, are all that
    reaches the driver; a round that moves none is the last one that can.
    """
    spark = df.sparkSession
    vectors = whole_vectors(df, dimension, id_col, vector_col)
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    first = vectors.withColumn("mark", mark).orderBy("mark", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(len(first), dimension)
    simplex = Simplex(centroids) if len(first) else None
    if simplex is None:
        return spark.createDataFrame([], T.StructType([
            vectors.schema["vec_id"], *[T.StructField(n, t()) for n, t in (
                ("cluster", T.IntegerType), ("distance", T.LongType), ("cluster_inertia", T.LongType),
                ("inertia", T.LongType), ("centroid_sha256", T.StringType))]]))
    known = written(with_apex(vectors, simplex), "vectors")
    for _ in range(rounds):
        moved = centroids.copy()
        for row in sums(known, centroids, simplex.apexes(centroids)):
            moved[row["cluster"]] = [int(row[f"s{i}"]) // row["n"] for i in range(dimension)]
        if (moved == centroids).all():
            break
        centroids = moved
    found = written(assigned(known, centroids, simplex.apexes(centroids)), "assigned")
    per = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    digest = lambda c: hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()
    whole = sum(int(r["d"]) for r in per)
    facts = spark.createDataFrame(
        [(r["cluster"], int(r["d"]), whole, digest(centroids[r["cluster"]])) for r in per],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return found.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
