"""What the operators on vectors share: which vectors count, whole numbers, exact sums over a table."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Whole numbers up to this are exact as doubles; the largest long.
EXACT, LONG = 2**53, 2**63 - 1


def doubles(c: str = "embedding") -> Column:
    return F.col(c).cast("array<double>")


def sound(v: Column, scale: int, most: float = float("inf")) -> Column:
    """Whether a vector is there and scale times each of its entries is a number below most."""
    return v.isNotNull() & ~F.coalesce(F.exists(v, lambda x: x.isNull() | F.isnan(x) | ~(F.abs(x * scale) < most)), F.lit(True))


def floored(x: Column) -> Column:
    """The largest whole number up to x, as a double of any size; floor() itself ends at 64 bits."""
    return F.rint(x) - F.when(F.rint(x) > x, 1.0).otherwise(0.0) + 0.0


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The rows of a column of lists without nulls, without a copy."""
    flat = column.flatten()
    return flat.to_numpy(zero_copy_only=flat.null_count == 0).reshape(-1, dims)


def whole(x: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python's, of any size."""
    return np.array([int(v) for v in x.ravel()], object).reshape(x.shape)


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Sums of the columns of whole numbers, as Python's."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    limit = EXACT if x.dtype == np.float64 else LONG
    return whole((x if most * max(1, len(x)) <= limit else whole(x)).sum(axis=0))


def fits(values: np.ndarray) -> pa.Array:
    """Longs; null where a whole number has more than 64 bits."""
    if values.dtype != object:
        return pa.array(values.astype(np.int64))
    return pa.array([int(v) if -LONG - 1 <= v <= LONG else None for v in values], pa.int64())


def gathered(rows: DataFrame, part: Callable[[Iterator[pa.RecordBatch]], object], merge: Callable[[object, object], object], zero: object) -> object:
    """One value of each partition, merged along a tree of tasks; part sees a partition's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(part(batches))], pa.binary())], ["part"])

    return rows.mapInArrow(run, "part binary").rdd.map(lambda r: pickle.loads(r[0])).treeAggregate(zero, merge, merge)
