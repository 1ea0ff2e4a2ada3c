"""Embedding whitening by a tall-skinny QR, without a covariance matrix.

Entries become whole numbers x = floor(scale * c) + shift.  Their number n and sums S are exact, so n * x - S is a whole
number and a row is centred as (n * x - S) / n with a single rounding, however far the mean is from zero.  Each
partition folds its centred rows, block by block, into one triangular factor R; the factors are merged along a tree of
tasks by QR of two at a time.  The right singular vectors of the last R are the components, by falling singular value s:
the variance along one is e = s^2 / n, and a row's whitened value is its projection times sqrt(n) / s.  A second pass over
the rows measures how far the whitened values' covariance is from the identity, centred before multiplying.

Vectors that are null or hold null or non-finite entries, or entries whose x is no long, are dropped, and empty ones.
All of one table have one length: vectors of another length than most have (of equally frequent lengths the longer)
are dropped too.  Null ids stay null; repeated rows count each.  Components along which nothing varies, to double precision,
have null whitened values and explained 0 (null where nothing varies at all).  A deviation of more than 64 bits is
null.  An empty table gives an empty result.  Further columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.common import small_batches, written
from framelake.llm.vectors import LONG, doubles, exact_sum, fits, gathered, matrix, sound, whole

#: Rows of one block of a partition's QR.
BLOCK = 4096


def integers(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """id, v (array of long) of the vectors that take part."""
    v = vectors.select(F.col("vec_id").alias("id"), doubles().alias("v")).where(F.size("v") > 0).where(sound(F.col("v"), scale, 2.0**62))
    return v.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("long") + F.lit(shift).cast("long")).alias("v"))


def triangle(*parts: np.ndarray) -> np.ndarray:
    """The R factor of stacked matrices."""
    return np.linalg.qr(np.vstack(parts), mode="r")


@dataclass
class Fit:
    """Exact count and sums, components (rows), and the square roots of their variances."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    spread: np.ndarray
    explained: list[float | None]

    def raised(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
        if self.n * most + max(map(abs, self.sums), default=0) <= LONG:
            return self.n * x - self.sums.astype(np.int64)
        return self.n * whole(x) - self.sums

    def deviation(self, raised: np.ndarray) -> pa.Array:
        most = max(abs(int(raised.max(initial=0))), abs(int(raised.min(initial=0))))
        raised = raised if raised.dtype != object and most**2 * raised.shape[1] <= LONG else whole(raised)
        return fits((raised * raised).sum(axis=1))

    def whitened(self, raised: np.ndarray) -> np.ndarray:
        """A column for each component; nan where nothing varies."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = (raised / self.n).astype(float) @ self.components.T / self.spread
        out[:, self.spread == 0] = np.nan
        return out


def blocks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for i in range(0, b.num_rows, BLOCK):
            part = b.slice(i, BLOCK)
            yield part, matrix(part.column(part.num_columns - 1), dims)


def fit(v: DataFrame, dims: int, most: int) -> Fit:
    """The components of the vectors v, most of them at most."""
    add = lambda a, b: (a[0] + b[0], a[1] + b[1])

    def count(batches: Iterator[pa.RecordBatch]) -> tuple[int, np.ndarray]:
        total = (0, np.zeros(dims, object))
        for b, x in blocks(batches, dims):
            total = add(total, (b.num_rows, exact_sum(x)))
        return total

    n, sums = gathered(v.select("v"), count, add, (0, np.zeros(dims, object)))
    centred = Fit(n, sums, np.zeros((0, dims)), np.zeros(0), [])

    def factor(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        r = np.zeros((0, dims))
        for _, x in blocks(batches, dims):
            r = triangle(r, (centred.raised(x) / n).astype(float))
        return r

    r = gathered(v.select("v"), factor, triangle, np.zeros((0, dims)))
    _, s, right = np.linalg.svd(r, full_matrices=True)
    s = np.concatenate([s, np.zeros(dims - len(s))])
    s[s <= s.max() * dims * np.finfo(float).eps] = 0.0
    trace = float((s * s).sum())
    k = min(most, dims)
    return Fit(n, sums, right[:k], s[:k] / n**0.5, [float(x * x) / trace if trace else None for x in s[:k]])


@dataclass
class Moments:
    """Count, means and centred products of rows; two merge without a second look at the rows."""

    n: int
    mean: np.ndarray
    products: np.ndarray

    @classmethod
    def of(cls, w: np.ndarray) -> Moments:
        mean = w.mean(axis=0)
        return cls(len(w), mean, (w - mean).T @ (w - mean))

    def merged(self, other: Moments) -> Moments:
        n, off = self.n + other.n, other.mean - self.mean
        if not n:
            return self
        return Moments(n, self.mean + off * (other.n / n), self.products + other.products + np.outer(off, off) * (self.n * other.n / n))


def identity_error(v: DataFrame, own: Fit) -> float | None:
    """Largest absolute entry of the whitened values' covariance minus the identity, over components that vary."""
    some = np.flatnonzero(own.spread)
    if not len(some):
        return None
    zero = Moments(0, np.zeros(len(some)), np.zeros((len(some), len(some))))

    def part(batches: Iterator[pa.RecordBatch]) -> Moments:
        total = zero
        for _, x in blocks(batches, own.components.shape[1]):
            total = total.merged(Moments.of(own.whitened(own.raised(x))[:, some]))
        return total

    m = gathered(v.select("v"), part, Moments.merged, zero)
    return float(np.abs(m.products / m.n - np.eye(len(some))).max())


def whitened(vectors: DataFrame, components: int = 8, scale: int = 1024, shift: int = 100_000) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each vector and component."""
    spark = vectors.sparkSession
    small_batches(spark)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    v = written(integers(vectors, scale, shift), "whole-vectors")
    lengths = v.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("m")).orderBy(F.desc("m"), F.desc("dims")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    dims = lengths["dims"]
    v = v.where(F.size("v") == dims)
    own = fit(v, dims, components)
    error, k = identity_error(v, own), len(own.components)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in blocks(batches, dims):
            raised, rows = own.raised(x), np.repeat(np.arange(b.num_rows), k)
            w = own.whitened(raised).ravel()
            cols = [b.column(0).take(pa.array(rows)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), b.num_rows)), pa.array(np.full(len(rows), own.n)), own.deviation(raised).take(pa.array(rows)), pa.array(w, pa.float64(), mask=np.isnan(w)), pa.array(own.explained * b.num_rows, pa.float64()), pa.array([error] * len(rows), pa.float64())]
            yield pa.RecordBatch.from_arrays(cols, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return v.select("id", "v").mapInArrow(run, schema)
