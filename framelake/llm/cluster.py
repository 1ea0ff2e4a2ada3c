"""Exact k-means: whole numbers, distances by matrix products.

Vectors become whole numbers, floor(scale * x).  Squared distances are |x|^2 - 2 x.c + |c|^2, one double-precision
matrix product for a batch of rows.  Every number in it is whole; while dims * (max |x| + max |c|)^2 is below 2^53, all
of them and all partial sums are exact, whatever order the product adds in.  The bound is checked for each row; rows
beyond it are computed from differences in 64-bit integers, or Python's where those don't do.

Each round sends the centroids (k * dims numbers, bounded by the parameters) to the tasks, and each task gives one row of
sums and counts; these are whole numbers of any size, merged by an RDD's treeAggregate, so the means are exact and do
not depend on partitions or their order.

The first centroids are the k vectors with the smallest SHA-256 of "<seed>:<id>", repeated ids by their components; with
fewer vectors there are as many centroids.  Ties of distance go to the smaller number, and a centroid without vectors
stays where it is.

Vectors that are null, have another number of components, or hold a null, a non-finite component or one that
scale takes beyond a double take no part.  A null id counts as "null" in the hash and stays null.  Rows that repeat an id,
a vector or both are vectors of their own.  A distance or an inertia of more than 64 bits is null, as no long can hold it.  An
empty table gives an empty result.  Further columns are left out, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import small_batches, written
from framelake.llm.vectors import EXACT, LONG, doubles, exact_sum, fits, floored, gathered, matrix, sound, whole

#: Rows of one matrix product.
BLOCK = 4096


def integers(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """id, v (array of double, whole numbers) of the vectors that take part."""
    v = vectors.select(F.col("vec_id").alias("id"), doubles().alias("v")).where(F.size("v") == dims).where(sound(F.col("v"), scale))
    return v.select("id", F.transform("v", lambda x: floored(x * scale)).alias("v"))


def first_centroids(v: DataFrame, k: int, seed: int) -> list[list[int]]:
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("null"))).cast("binary"), 256)
    return [[int(x) for x in r["v"]] for r in v.select(name.alias("h"), "v").orderBy("h", "v").limit(k).collect()]


class Centroids:
    """Centroids and the nearest of them for many rows at once."""

    def __init__(self, at: list[list[int]]) -> None:
        self.at, self.dims = at, len(at[0])
        self.whole = np.array([[int(x) for x in c] for c in at], object).reshape(len(at), self.dims)
        self.most = max(abs(x) for c in at for x in c)
        self.near = np.array(at, float) if self.most < EXACT else None
        self.square = (self.near * self.near).sum(axis=1) if self.near is not None and self.dims * self.most**2 < EXACT else None

    def reach(self, limit: int) -> float:
        """Components up to this keep every number of a distance below the limit."""
        return float(int((limit / self.dims) ** 0.5 * 0.999999)) - self.most

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance of each row of whole numbers."""
        size = np.abs(x).max(axis=1, initial=0)
        short = size < self.reach(EXACT) if self.square is not None else np.zeros(len(x), bool)
        if short.all():
            return self._product(x)
        cluster, distance = np.zeros(len(x), int), np.zeros(len(x), object)
        for rows, found in ((np.flatnonzero(short), self._product), (np.flatnonzero(~short & (size < self.reach(LONG))), self._long), (np.flatnonzero(~short & ~(size < self.reach(LONG))), self._any)):
            if len(rows):
                cluster[rows], d = found(x[rows])
                distance[rows] = whole(d)
        return cluster, distance

    def _product(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ self.near.T) + self.square[None, :]
        best = d.argmin(axis=1)
        return best, d[np.arange(len(x)), best].astype(np.int64)

    def _long(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._apart(x.astype(np.int64), self.whole.astype(np.int64))

    def _any(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._apart(whole(x), self.whole)

    @staticmethod
    def _apart(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1)
        best = d.argmin(axis=1)
        return best, d[np.arange(len(x)), best]


def blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for i in range(0, b.num_rows, BLOCK):
            part = b.slice(i, BLOCK)
            yield part, matrix(part.column(part.num_columns - 1), dims)


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return a[0] + b[0], a[1] + b[1]


def moved(v: DataFrame, at: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: exact floors of the means of their vectors."""
    own = Centroids(at)
    k, dims = len(at), own.dims

    def part(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray]:
        sums, counts = np.zeros((k, dims), object), np.zeros(k, object)
        for _, x in blocks(batches, dims):
            cluster, _ = own.nearest(x)
            for c in np.unique(cluster):
                mine = x[cluster == c]
                sums[c] += exact_sum(mine)
                counts[c] += len(mine)
        return sums, counts

    sums, counts = gathered(v.select("v"), part, _merged, (np.zeros((k, dims), object), np.zeros(k, object)))
    return [[s // n for s in row] if n else old for row, n, old in zip(sums.tolist(), counts.tolist(), at, strict=True)]


def assigned(v: DataFrame, at: list[list[int]]) -> DataFrame:
    """id, cluster, distance of every vector."""
    own = Centroids(at)
    kind = v.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in blocks(batches, own.dims):
            cluster, distance = own.nearest(x)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cluster, pa.int32()), fits(distance)], ["id", "cluster", "distance"])

    return v.select("id", "v").mapInArrow(run, f"id {kind}, cluster int, distance long")


def centroid_sha256(c: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()


def clusters(vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256 of every vector that takes part."""
    spark = vectors.sparkSession
    small_batches(spark)
    v = written(integers(vectors, dims, scale), "whole-vectors")
    at = first_centroids(v, k, seed)
    schema = f"vec_id {vectors.schema['vec_id'].dataType.simpleString()}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not at:
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        at = moved(v, at)
    found = written(assigned(v, at), "assigned")
    total = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(20,0)")))
    sums = found.groupBy("cluster").agg(total.alias("s")).collect()  # k rows at most
    all_ = None if any(r["s"] is None for r in sums) else sum(int(r["s"]) for r in sums)
    long = lambda s: None if s is None or int(s) > LONG else int(s)
    figures = spark.createDataFrame([(r["cluster"], long(r["s"]), long(all_), centroid_sha256(at[r["cluster"]])) for r in sums], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(figures), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
