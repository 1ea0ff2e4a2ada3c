"""Masks as relations: a row (y, lo, hi) for each run of set pixels of a mask's line, ends included.

Masks and filled polygons become runs, unions are gaps and islands of a line's runs, dilation moves and widens them, and
areas and coverage are sums and joins on them.  All of it is column expressions and windows, and no step holds more than
the runs of one line of one mask: a mask of a million pixels is as many rows as it has edges.

by names the columns that tell masks apart.  Masks without set pixels have no runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions.geometry import pixel
from framelake.operators.raster import GROW


def of_masks(rows: DataFrame, by: list[str], mask: str, width: int) -> DataFrame:
    """by, y, lo, hi of row-major masks (arrays of boolean; null is not set)."""
    at = rows.select(*by, F.posexplode(mask).alias("__i", "__set")).where("__set")
    at = at.select(*by, F.floor(F.col("__i") / width).cast("int").alias("y"), (F.col("__i") % width).alias("__x"))
    run = F.col("__x") - F.row_number().over(Window.partitionBy(*by, "y").orderBy("__x"))
    return at.withColumn("__run", run).groupBy(*by, "y", "__run").agg(F.min("__x").alias("lo"), F.max("__x").alias("hi")).drop("__run")


def of_polygons(rows: DataFrame, by: list[str], polygons: str, width: int, height: Column | int) -> DataFrame:
    """by, y, lo, hi of filled polygons (arrays of [x, y] corners), crossed or concave ones too; the edges are filled.

    Corners go to the nearest pixel.  A line's inner runs lie between its crossings with the edges, in pairs.
    """
    height = F.lit(height) if isinstance(height, int) else height
    one = rows.select(*by, height.cast("int").alias("__h"), F.posexplode(polygons).alias("__n", "__p"))
    near = F.transform("__p", lambda c: F.transform(c, lambda v: F.rint(v).cast("int")))
    n = F.size("__p")
    edge = lambda c, i: F.struct(*[F.element_at(F.element_at(c, k), j).alias(name) for k, j, name in ((i + 1, 1, "xa"), (i + 1, 2, "ya"), ((i + 1) % n + 1, 1, "xb"), ((i + 1) % n + 1, 2, "yb"))])
    edges = one.withColumn("__p", near).where(n > 0).select(*by, "__h", "__n", F.inline(F.transform("__p", lambda _, i: edge(F.col("__p"), i))))
    # inner runs
    crossed = edges.where("ya <> yb").withColumn("__a", F.greatest(F.least("ya", "yb"), F.lit(0))).withColumn("__b", F.least(F.greatest("ya", "yb") - 1, F.col("__h") - 1)).where("__a <= __b")
    crossed = crossed.withColumn("y", F.explode(F.sequence("__a", "__b"))).withColumn("__x", F.col("xa") + (F.col("y") - F.col("ya")) * (F.col("xb") - F.col("xa")) / (F.col("yb") - F.col("ya")))
    lines = crossed.groupBy(*by, "__n", "y").agg(F.sort_array(F.collect_list("__x")).alias("__c"))  # as many as the polygon has edges at most
    pair = lambda k: F.struct(F.greatest(F.ceil(F.element_at("__c", 2 * k - 1)), F.lit(0)).cast("int").alias("lo"), F.least(F.ceil(F.element_at("__c", 2 * k)) - 1, F.lit(width - 1)).cast("int").alias("hi"))
    inner = lines.select(*by, "y", F.inline(F.transform(F.sequence(F.lit(1), (F.size("__c") / 2).cast("int")), pair))).where("lo <= hi")
    # the edges' own pixels
    steps = F.greatest(F.abs(F.col("xb") - F.col("xa")), F.abs(F.col("yb") - F.col("ya")), F.lit(1))
    on = edges.withColumn("__m", steps).withColumn("__s", F.explode(F.sequence(F.lit(0), "__m")))
    at = lambda u, v: F.when(F.col("__s") == F.col("__m"), F.col(v)).otherwise(F.rint(F.col(u) + F.col("__s") * ((F.col(v) - F.col(u)) / F.col("__m"))).cast("int"))
    line = on.select(*by, "__h", at("ya", "yb").alias("y"), at("xa", "xb").alias("lo")).where(F.col("y").between(0, F.col("__h") - 1) & F.col("lo").between(0, width - 1))
    return inner.unionByName(line.select(*by, "y", "lo", F.col("lo").alias("hi")))


def united(runs: DataFrame, by: list[str]) -> DataFrame:
    """The runs of all masks of one key together, as few as there are: those that touch or overlap are one."""
    w = Window.partitionBy(*by, "y").orderBy("lo", "hi")
    before = F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1))
    marked = runs.select(*by, "y", "lo", "hi", F.when(F.col("lo") <= before + 1, 0).otherwise(1).alias("__new"))
    island = marked.withColumn("__island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*by, "y", "__island").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("__island")


def grown(runs: DataFrame, by: list[str], radius: Column, width: int, height: Column | int) -> DataFrame:
    """Dilation by a disk; the runs come united."""
    height = F.lit(height) if isinstance(height, int) else height
    r = F.greatest(radius, F.lit(0)).cast("int")
    moved = runs.select(*by, "y", "lo", "hi", r.alias("__r"), height.cast("int").alias("__h")).withColumn("__d", F.explode(F.sequence(-F.col("__r"), F.col("__r"))))
    part = F.col("__d") / F.col("__r")
    reach = F.when(F.col("__r") > 0, F.rint(F.col("__r") * F.sqrt(F.greatest(F.lit(0.0), 1 - part * part)))).otherwise(0).cast("int")
    wide = moved.select(*by, "__h", (F.col("y") + F.col("__d")).alias("y"), F.greatest(F.col("lo") - reach, F.lit(0)).alias("lo"), F.least(F.col("hi") + reach, F.lit(width - 1)).alias("hi"))
    return united(wide.where(F.col("y").between(0, F.col("__h") - 1)), by)


def finished(masks: DataFrame, by: list[str], mask: str, markers: str, side: Column, width: int, height: Column | int) -> DataFrame:
    """by, y, lo, hi: the mask and its filled markers, grown by a quarter of their median side; without markers the mask as it is.

    by tells the rows of masks apart; side is that median.
    """
    grow = F.when(F.size(markers) > 0, F.rint(GROW * side)).otherwise(0)
    height = F.lit(height) if isinstance(height, int) else height
    each = masks.select(*by, grow.alias("__grow"), height.alias("__height"))
    both = united(of_masks(masks, by, mask, width).unionByName(of_polygons(masks, by, markers, width, height)), by)
    same = reduce(lambda a, b: a & b, [F.col(f"r.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by])
    rows = both.alias("r").join(each.alias("e"), same).select("r.*", "__grow", "__height")
    return grown(rows, by, F.col("__grow"), width, F.col("__height"))


def areas(runs: DataFrame, by: list[str]) -> DataFrame:
    """by, area: set pixels of united runs."""
    return runs.groupBy(*by).agg(F.sum(F.col("hi") - F.col("lo") + 1).cast("long").alias("area"))


def coverage(runs: DataFrame, points: DataFrame, by: list[str], width: int, height: int) -> DataFrame:
    """by, coverage: the share of each mask's points (x, y) whose nearest pixel is set; masks without points have no row."""
    own = points.select(*by, pixel(F.col("x"), width).alias("__x"), pixel(F.col("y"), height).alias("__y")).groupBy(*by, "__x", "__y").agg(F.count("*").alias("__m"))
    same = reduce(lambda a, b: a & b, [F.col(f"p.{c}").eqNullSafe(F.col(f"r.{c}")) for c in by])
    hit = own.alias("p").join(runs.alias("r"), same & (F.col("p.__y") == F.col("r.y")) & F.col("p.__x").between(F.col("r.lo"), F.col("r.hi")), "left")
    return hit.groupBy(*[F.col(f"p.{c}").alias(c) for c in by]).agg((F.coalesce(F.sum(F.when(F.col("r.y").isNotNull(), F.col("p.__m"))), F.lit(0)) / F.sum("p.__m")).alias("coverage"))
