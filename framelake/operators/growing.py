"""The robust fence over scores that keep coming, without reading the old ones again.

Each increment is kept as two tables: its different scores with how often each came (by, slot, bucket, v, n), and a
histogram of ordered buckets (by, bucket, n).  A bucket is a 64th of an octave, so a group has as many as its scores have
magnitudes, whatever their number.  Histograms of increments add up.  The median is found in the sum: the bucket that holds
the middle rank, then the scores of that bucket alone; files are laid out by slots of buckets, so the others are not
read.  The deviations from it go the same way in one pass over the different scores.  All of it is plans: nothing runs
before the fence is asked for, and the figures are exact, those of the union of all increments.

An increment is there once its mark is written, so one that fails halfway is not counted.  Null scores are not in the
population.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.operators.quality import CONSISTENT, LEAST, MAD_K, bucket_of
from framelake.sources import storage

#: Slots that a values table is laid out in.
SLOTS = 64


def _same(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names])


def _middles(hist: DataFrame, by: list[str]) -> DataFrame:
    """by, total, bucket, lo, hi: the buckets with a group's middle ranks, and those ranks within them (null: not there)."""
    w = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = hist.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy(*by)))
    within = lambda rank: F.when((rank > F.col("upto") - F.col("n")) & (rank <= F.col("upto")), rank - F.col("upto") + F.col("n"))
    found = upto.select(*by, "total", "bucket", within(F.floor((F.col("total") + 1) / 2)).alias("lo"), within(F.floor(F.col("total") / 2) + 1).alias("hi"))
    return found.where("lo > 0 or hi > 0")  # ranks begin at 1


def _median(values: DataFrame, hist: DataFrame, by: list[str]) -> DataFrame:
    """by, total, median of values (by, slot, bucket, v, n) whose histogram is hist; only buckets with a middle rank are read."""
    at = _middles(hist, by).withColumn("slot", F.pmod("bucket", F.lit(SLOTS)).cast("int"))
    # SLOTS rows at most: the scan of the values takes them for the folders that it opens
    values = values.join(F.broadcast(at.select("slot").distinct()), "slot")
    own = values.alias("v").join(at.alias("m"), _same("v", "m", by) & (F.col("v.slot") == F.col("m.slot")) & (F.col("v.bucket") == F.col("m.bucket")))
    own = own.groupBy(*[F.col(f"m.{c}").alias(c) for c in by], "total", F.col("m.bucket").alias("bucket"), "lo", "hi", "v").agg(F.sum("v.n").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*by, "bucket").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = own.withColumn("upto", upto)
    at_rank = lambda rank: F.min(F.when(F.col("upto") >= F.col(rank), F.col("v")))
    # per bucket first, as the two middle ranks may lie in two
    each = ranked.groupBy(*by, "total", "bucket").agg(at_rank("lo").alias("a"), at_rank("hi").alias("b"))
    return each.groupBy(*by, "total").agg(((F.max("a") + F.max("b")) / 2).alias("median"))


@dataclass
class Scores:
    """The scores of groups, kept in a folder that all executors share."""

    spark: SparkSession
    folder: str
    by: list[str]

    def add(self, rows: DataFrame, score: str = "score") -> None:
        """One more increment: rows (by, score)."""
        name = uuid.uuid4().hex
        v = rows.select(*self.by, F.col(score).cast("double").alias("v")).where("v is not null").withColumn("v", F.col("v") + 0.0)
        each = v.groupBy(*self.by, "v").agg(F.count("*").alias("n")).withColumn("bucket", bucket_of(F.col("v")))
        # dealt by bucket, so that a slot's folder has a file for each task with some of its buckets and no more
        each.withColumn("slot", F.pmod("bucket", F.lit(SLOTS)).cast("int")).repartition("slot", "bucket").write.partitionBy("slot").parquet(f"{self.folder}/values/increment={name}")
        kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*self.by).schema)
        self._values(kind, [name]).groupBy(*self.by, "bucket").agg(F.sum("n").alias("n")).write.parquet(f"{self.folder}/counts/increment={name}")
        storage.replaced(f"{self.folder}/marks/{name}", kind.encode())

    def _values(self, kind: str, names: list[str]) -> DataFrame:
        read = self.spark.read.schema(f"{kind}, bucket long, v double, n long, increment string, slot int").parquet(f"{self.folder}/values")
        return read.where(F.col("increment").isin(names)).drop("increment")

    def increments(self) -> list[str]:
        """The increments that count."""
        return [p.rsplit("/", 1)[1] for p in storage.listed(f"{self.folder}/marks/*")]

    def fence(self) -> DataFrame:
        """by, frames_scored, median, mad, threshold over all increments; groups of fewer than LEAST scores get null figures."""
        names = self.increments()
        if not names:
            raise ValueError(f"{self.folder}: no scores")
        with storage.opened(f"{self.folder}/marks/{names[0]}") as f:
            kind = f.read().decode()
        values = self._values(kind, names)
        counts = self.spark.read.schema(f"{kind}, bucket long, n long, increment string").parquet(f"{self.folder}/counts").where(F.col("increment").isin(names))
        hist = counts.groupBy(*self.by, "bucket").agg(F.sum("n").alias("n"))
        mid = _median(values, hist, self.by)
        off = values.alias("v").join(mid.alias("m"), _same("v", "m", self.by)).select(*[F.col(f"m.{c}").alias(c) for c in self.by], F.abs(F.col("v.v") - F.col("m.median")).alias("v"), "n")
        off = off.withColumn("bucket", bucket_of(F.col("v"))).withColumn("slot", F.pmod("bucket", F.lit(SLOTS)).cast("int"))
        spread = _median(off, off.groupBy(*self.by, "bucket").agg(F.sum("n").alias("n")), self.by)
        both = mid.alias("m").join(spread.alias("s"), _same("m", "s", self.by)).select(*[F.col(f"m.{c}").alias(c) for c in self.by], F.col("m.total").alias("frames_scored"), F.col("m.median").alias("median"), F.col("s.median").alias("mad"))
        enough = F.col("frames_scored") >= LEAST
        own = lambda c: F.when(enough, c)
        return both.select(*self.by, "frames_scored", own(F.col("median")).alias("median"), own(F.col("mad")).alias("mad"), own(F.greatest(F.col("median") - MAD_K * CONSISTENT * F.col("mad"), F.lit(0.0))).alias("threshold"))
