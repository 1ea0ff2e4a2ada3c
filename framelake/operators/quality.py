"""The robust lower fence: median - k * 1.4826 * MAD for each session."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.sources import storage

#: Fence width, consistency factor, least population (fixed values).
MAD_K, CONSISTENT, LEAST = 3.0, 1.4826, 3
#: Rows of a group that may be held at once, and cells that a range is cut into.
EXACT, CELLS = 1_000_000, 4096
#: Buckets of an octave and an octave's place above zero.
PARTS, ABOVE = 64, 2**20


def bucket_of(v: Column) -> Column:
    """A whole number that never falls as v grows; zero is 0, the infinities and NaN lie outside all others."""
    size = F.floor(F.log2(F.abs(v)) * PARTS) + ABOVE
    finite = F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)
    return F.when(F.isnan(v), F.lit(2**41)).when(v == float("inf"), F.lit(2**40)).when(v == float("-inf"), F.lit(-(2**40))).otherwise(finite).cast("long")


def _same(a: str, b: str, by: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in by])


def medians(rows: DataFrame, by: list[str], value: str, exact: int = EXACT) -> DataFrame:
    """by, n, median: exact, for groups of any size.

    Where no group has more than ``exact`` rows, the built-in median holds a group's values.  Otherwise each group's
    range is narrowed first, by a count of buckets that are a part of an octave and then of CELLS equal parts of what is left,
    to what holds the two middle ranks, until that is few rows of every group.  Only counts are shuffled until then; what stays
    is ranked at the end.  Each pass over the rows is made once: its counts and the medians are written.
    """
    spark, at = rows.sparkSession, storage.fresh(rows.sparkSession, "medians")
    rows = rows.select(*by, F.col(value).cast("double").alias("__v"))

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{at}/{name}")
        return spark.read.schema(df.schema).parquet(f"{at}/{name}")

    figures = (F.count("*").alias("m"), F.min("__v").alias("a"), F.max("__v").alias("b"))
    counts = kept(rows.groupBy(*by, bucket_of(F.col("__v")).alias("cell")).agg(*figures), "buckets")
    sizes = counts.groupBy(*by).agg(F.sum("m").alias("n"))
    most = sizes.agg(F.max("n")).first()[0] or 0
    if most <= exact:
        return rows.groupBy(*by).agg(F.count("*").alias("n"), F.median("__v").alias("median"))
    lower, upper = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    own = counts.withColumns({"n": F.sum("m").over(Window.partitionBy(*by)), "below": F.lit(0).cast("long")})
    for turn in range(64):  # a range is 2^12 times as short each time
        ranges = kept(_middle(own, by, lower, upper), f"ranges{turn}")
        now = ranges.where("lo < hi").agg(F.max("left")).first()[0] or 0  # one value repeated needs no narrowing
        if now <= exact or turn and now >= most:
            break
        most = now
        v, lo, hi = F.col("v"), F.col("lo"), F.col("hi")
        span = hi / 2 - lo / 2
        part = F.greatest(F.lit(1), F.least(F.lit(CELLS - 1), F.floor((v / 2 - lo / 2) / F.when((span > 0) & (span < float("inf")), span) * CELLS)))
        cell = F.when(v <= lo, 0).when(v >= hi, CELLS).otherwise(F.coalesce(part, F.lit(1)))
        own = _within(rows, ranges, by).withColumn("cell", cell).groupBy(*by, "n", "below", "cell").agg(F.count("*").alias("m"), F.min("v").alias("a"), F.max("v").alias("b"))
    counted = _within(rows, ranges, by).groupBy(*by, "n", "below", "v").agg(F.count("*").alias("m"))
    ranked = counted.withColumn("upto", F.col("below") + F.sum("m").over(Window.partitionBy(*by).orderBy("v")))
    middle = lambda rank: F.min(F.when(F.col("upto") >= rank, F.col("v")))
    a, b = middle(lower), middle(upper)
    return kept(ranked.groupBy(*by, "n").agg(F.when(a == b, a).otherwise((a + b) / 2).alias("median")), "medians")


def _middle(counts: DataFrame, by: list[str], lower: Column, upper: Column) -> DataFrame:
    """by, n, below, left, lo, hi: from a group's counts of cells, the range of those that hold its middle ranks."""
    upto = F.col("below") + F.sum("m").over(Window.partitionBy(*by).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("m"))
    return ranked.where((F.col("upto") >= lower) & (F.col("before") < upper)).groupBy(*by, "n").agg(F.min("before").alias("below"), F.sum("m").alias("left"), F.min("a").alias("lo"), F.max("b").alias("hi"))


def _within(rows: DataFrame, ranges: DataFrame, by: list[str]) -> DataFrame:
    """by, n, below, lo, hi, v of the rows within their group's range."""
    both = rows.alias("r").join(ranges.alias("k"), _same("r", "k", by)).where(F.col("r.__v").between(F.col("k.lo"), F.col("k.hi")))
    return both.select(*[F.col(f"k.{c}").alias(c) for c in by], "n", "below", "lo", "hi", F.col("r.__v").alias("v"))


def fence(scores: DataFrame, by: list[str], score: str = "score", exact: int = EXACT) -> DataFrame:
    """by, frames_scored, median, mad, threshold: one row for each session.

    Null scores (unreadable frames) are not in the population.  Sessions of fewer than three scores get null figures.
    """
    known = scores.where(F.col(score).isNotNull())
    mid = medians(known, by, score, exact)
    off = known.alias("s").join(mid.alias("m"), _same("s", "m", by)).select(*[F.col(f"m.{c}").alias(c) for c in by], F.abs(F.col(f"s.{score}") - F.col("m.median")).alias("off"))
    spread = medians(off, by, "off", exact).withColumnRenamed("median", "mad").drop("n")
    out = mid.alias("m").join(spread.alias("s"), _same("m", "s", by)).select(*[F.col(f"m.{c}").alias(c) for c in by], F.col("n").alias("frames_scored"), "median", "mad")
    enough = F.col("frames_scored") >= LEAST
    return out.select(*by, "frames_scored", F.when(enough, F.col("median")).alias("median"), F.when(enough, F.col("mad")).alias("mad"), F.when(enough, F.greatest(F.col("median") - MAD_K * CONSISTENT * F.col("mad"), F.lit(0.0))).alias("threshold"))


def rejects(scores: DataFrame, figures: DataFrame, by: list[str], score: str = "score") -> DataFrame:
    """The rows whose score is strictly below their session's threshold."""
    t = figures.select(*[F.col(c).alias(f"__{c}") for c in by], "threshold")
    cond = None
    for c in by:
        e = F.col(c).eqNullSafe(F.col(f"__{c}"))
        cond = e if cond is None else cond & e
    return scores.join(t, cond).where(F.col(score) < F.col("threshold")).drop("threshold", *[f"__{c}" for c in by])


def sharpness_block(figures: DataFrame, rejected: DataFrame, by: list[str]) -> DataFrame:
    """by, sharpness: the figures as they go into a manifest."""
    n = rejected.groupBy(*by).agg(F.count("*").cast("int").alias("frames_rejected"))
    block = F.struct(F.lit("laplacian_variance").alias("metric"), F.lit(MAD_K).alias("mad_k"), F.col("frames_scored").cast("int").alias("frames_scored"), "threshold", "median", "mad", F.coalesce("frames_rejected", F.lit(0)).alias("frames_rejected"))
    return figures.join(n, by, "left").select(*by, block.alias("sharpness"))
