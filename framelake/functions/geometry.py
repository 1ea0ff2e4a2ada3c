"""Marker geometry as column expressions: a marker is four [x, y] corners, an image's markers an array of those.

Boxes around markers, and boxes by the markers in them, are plans over flat tables: framelake.operators.flat.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A marker box reaches this many median sides beyond the corners; it needs this many markers.
REACH, LEAST_MARKERS = 2.0, 3
#: Health of a track: least coverage of marker centres, bounds of the area against the reference.
LEAST_COVERAGE, LEAST_RATIO, MOST_RATIO = 0.5, 0.5, 2.0


def four_points(corners: Column) -> Column:
    """Corners as detectors give them, with one more leading axis, as four points of doubles."""
    return F.transform(F.flatten(corners), lambda p: F.transform(p, lambda v: v.cast("double")))


def _xy(p: Column) -> tuple[Column, Column]:
    return F.element_at(p, 1), F.element_at(p, 2)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once; lambdas run interpreted, where equal parts are not shared."""
    return F.element_at(F.transform(F.array(value), use), 1)


def sides(corners: Column) -> Column:
    """Lengths of the four edges, from each corner to the next (cyclic)."""

    def edge(i: int) -> Column:
        (x0, y0), (x1, y1) = _xy(F.element_at(corners, i + 1)), _xy(F.element_at(corners, (i + 1) % 4 + 1))
        return F.sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0))

    return F.array(*map(edge, range(4)))


def median(values: Column) -> Column:
    """Exact median of an array without nulls: the mean of the middle two, if the count is even; null for an empty array."""

    def middle(s: Column) -> Column:
        n = F.size(s)
        lo, hi = F.floor((n + 1) / 2).cast("int"), (F.floor(n / 2) + 1).cast("int")
        return F.when(n > 0, (F.try_element_at(s, F.greatest(lo, F.lit(1))) + F.try_element_at(s, F.greatest(hi, F.lit(1)))) / 2)

    return bound(F.sort_array(values), middle)


def median_side(markers: Column) -> Column:
    """Median of all edges of all markers, pooled."""
    return median(F.flatten(F.transform(markers, sides)))


def center(corners: Column) -> Column:
    total = lambda k: F.aggregate(corners, F.lit(0.0), lambda a, p: a + F.element_at(p, k))
    return F.struct((total(1) / F.size(corners)).alias("x"), (total(2) / F.size(corners)).alias("y"))


def centers(markers: Column) -> Column:
    return F.transform(markers, center)


def pixel(v: Column, size: Column | int) -> Column:
    """Nearest pixel, halves to even, clipped to the raster."""
    return F.least(F.greatest(F.rint(v), F.lit(0.0)), F.lit(size) - 1.0 if isinstance(size, int) else size - 1.0).cast("int")


def coverage(mask: Column, points: Column, width: int, height: Column | int) -> Column:
    """Share of the points whose pixel is set in a row-major mask (array of boolean); 1 without points."""
    hit = F.size(F.filter(points, lambda p: F.element_at(mask, pixel(p["y"], height) * width + pixel(p["x"], width) + 1)))
    return F.when(F.size(points) == 0, F.lit(1.0)).otherwise(hit / F.size(points))


def normal_area(mask: Column, side: Column) -> Column:
    """Set pixels in units of a marker's area; a side of 0 is an error, as division by zero is."""
    return F.size(F.filter(mask, lambda b: b)) / (side * side)
