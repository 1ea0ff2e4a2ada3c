"""Marker geometry over flat tables: a row for each marker with its corners as columns x1, y1, ... x4, y4.

For very many markers: plain columns stay within generated code, where lambdas over nested arrays are interpreted.  Each
function is one aggregation by the frame's key, which is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions.geometry import LEAST_MARKERS, REACH
from framelake.sources import storage

CORNERS = tuple((f"x{i}", f"y{i}") for i in range(1, 5))


def corner_rows(markers: DataFrame, by: list[str]) -> DataFrame:
    """by, x, y, side of every corner; side is the edge to the marker's next corner."""

    def one(i: int) -> Column:
        (x, y), (u, v) = CORNERS[i], CORNERS[(i + 1) % 4]
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"), F.sqrt((F.col(u) - F.col(x)) * (F.col(u) - F.col(x)) + (F.col(v) - F.col(y)) * (F.col(v) - F.col(y))).alias("side"))

    return markers.select(*by, F.inline(F.array(*map(one, range(4)))))


def prompts(markers: DataFrame, by: list[str], width: int, height: int, least: int = LEAST_MARKERS) -> DataFrame:
    """by, x0, y0, x1, y1: the box around a frame's markers, REACH median sides wider, clipped; frames of too few have no row."""
    ends = corner_rows(markers, by).groupBy(*by).agg(F.count("*").alias("n"), (REACH * F.median("side")).alias("pad"), *[f(c).alias(f"{c}_{n}") for c in "xy" for f, n in ((F.min, "lo"), (F.max, "hi"))])
    clip = lambda v, top: F.least(F.greatest(v, F.lit(0.0)), F.lit(top - 1.0))
    pad = F.col("pad")
    return ends.where(F.col("n") >= 4 * least).select(*by, clip(F.col("x_lo") - pad, width).alias("x0"), clip(F.col("y_lo") - pad, height).alias("y0"), clip(F.col("x_hi") + pad, width).alias("x1"), clip(F.col("y_hi") + pad, height).alias("y1"))


def middle(axis: str) -> Column:
    """A marker's middle on an axis."""
    return sum((F.col(f"{axis}{i}") for i in range(1, 5)), F.lit(0.0)) / 4


#: Rows of a task where tasks are as many as the rows ask for.
ROWS = 250_000


def tasks_for(spark: SparkSession, rows: int) -> int:
    """How many tasks hold so many rows, ROWS each, but as many as there are cores at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS))


def best_boxes(boxes: DataFrame, points: DataFrame, by: list[str], tasks: int | None = None) -> DataFrame:
    """by, box: of each frame's boxes (x0, y0, x1, y1, score, place) the one that holds most of its points (x, y).

    Then the higher score and the smaller place win.  A frame with points, none of them in a box, has no row; one without points has its highest score.
    tasks: how many the frames are dealt to, for tables of many rows; else as the session says.
    """
    key = F.struct(*by).alias("__by")  # never null, and equal where its fields are, so that one deal serves the join and what follows
    own = boxes.select(key, "x0", "y0", "x1", "y1", "score", "place")
    some = points.select(key, F.col("x").cast("double").alias("__x"), F.col("y").cast("double").alias("__y"))
    own, some = (df.repartition(tasks, "__by") if tasks else df for df in (own, some))
    both = own.join(some, "__by", "left")
    inside = F.col("__x").between(F.col("x0"), F.col("x1")) & F.col("__y").between(F.col("y0"), F.col("y1"))
    held = both.groupBy("__by", "x0", "y0", "x1", "y1", "score", "place").agg(F.count_if(inside).alias("held"), F.count("__x").alias("points"))
    rank = F.struct("held", "score", (-F.col("place")).alias("place"))
    best = held.groupBy("__by").agg(F.max_by(F.struct("x0", "y0", "x1", "y1", "score", "place", "held", "points"), rank).alias("box"))
    return best.where("box.held > 0 or box.points = 0").select(*[F.col("__by")[c].alias(c) for c in by], F.col("box").dropFields("held", "points").alias("box"))


#: Points of a strip of a crowded table, most strips, boxes that are counted together at least, points for each strip that place the cuts.
STRIP, STRIPS, ASKED, TRIED = 65_536, 512, 262_144, 64
EDGES = ("x0", "y0", "x1", "y1")


def _upto(keys: list[np.ndarray], at: list[np.ndarray], same: bool) -> np.ndarray:
    """How many of the keys (columns, the first weighs most) come before each place, or with same are equal to it."""
    n = len(keys[0])
    kind = np.concatenate([np.zeros(n), np.full(len(at[0]), 1 if same else -1)])
    order = np.lexsort([kind, *[np.concatenate(c) for c in zip(keys[::-1], at[::-1], strict=True)]])
    own = order < n
    out = np.empty(len(at[0]), np.int64)
    out[order[~own] - n] = np.cumsum(own)[~own]
    return out


def _below(values: np.ndarray, weights: np.ndarray, lo: np.ndarray, hi: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The weight of the entries up to hi, less that up to lo, whose value is below most: bit by bit, zeros put first (a wavelet matrix)."""
    total = np.zeros(len(lo), np.int64)
    for bit in reversed(range(int(max(values.max(initial=0), most.max(initial=0))).bit_length())):
        one, up = (values >> bit & 1).astype(bool), (most >> bit & 1).astype(bool)
        zeros, heavy = (np.concatenate([[0], np.cumsum(c)]) for c in (~one, np.where(one, 0, weights)))
        total += np.where(up, heavy[hi] - heavy[lo], 0)
        lo, hi = (np.where(up, zeros[-1] + i - zeros[i], zeros[i]) for i in (lo, hi))
        order = np.concatenate([np.flatnonzero(~one), np.flatnonzero(one)])
        values, weights = values[order], weights[order]
    return total


def _columns(t: pa.Table | pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [t.column(c).to_numpy(zero_copy_only=False) if isinstance(t, pa.RecordBatch) else t.column(c).to_numpy() for c in names]


#: Lets Spark delete a step's shuffle files when the step is done, instead of when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Most counts that are sent to every executor.
SENT = 1_000_000


def kept(df: DataFrame, at: str) -> DataFrame:
    """The table, written to a shared folder; the shuffle files it was made from are deleted."""
    spark = df.sparkSession
    old = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(at)
    finally:
        spark.conf.set(CLEANUP, old)
    return spark.read.schema(df.schema).parquet(at)


def held_counts(boxes: DataFrame, points: DataFrame, by: list[str], times: str | None = None) -> DataFrame:
    """by, x0, y0, x1, y1, held of the different boxes that hold points: how many of their frame's points (x, y), borders included.

    For frames of very many boxes and points, whose pairs are not made.  Equal boxes and equal points are counted once
    first.  Points are cut into strips by (frame, x, y) and into bands by (frame, y, x), of about as many points each.  A box holds
    what is up to its right edge less what is before its left one, each up to its top less before its bottom; of each such
    count, whole strips and bands come from a table of their sums, the rest from the strips of its sides and the bands of
    its ends.  So each point goes to two tasks' groups and each box to four at most, and a group is counted by sorting.  The cuts lie
    between some of the points, which tells how even the groups are and no more.  Boxes or points with a null or NaN hold
    nothing and are in nothing.  Of the tables between, only the counts stay in the shared folder.
    times: the points' column that says how many points a row is; else each is one.
    """
    spark, at = boxes.sparkSession, storage.fresh(boxes.sparkSession, "crowd")
    number = lambda *names: reduce(lambda a, b: a & b, [F.col(c).isNotNull() & ~F.isnan(c) for c in names])
    own = kept(boxes.select(*by, *(F.col(c).cast("double").alias(c) for c in EDGES)).where(number(*EDGES)).where("x0 <= x1 and y0 <= y1").distinct(), f"{at}/boxes")
    some = kept(points.select(*by, F.col("x").cast("double").alias("__x"), F.col("y").cast("double").alias("__y"), *([times] if times else [])).where(number("__x", "__y")).groupBy(*by, "__x", "__y").agg((F.sum(times) if times else F.count("*")).cast("long").alias("__m")), f"{at}/points")
    all_, seed = own.select(*by).union(some.select(*by)).distinct(), 0
    frame = lambda: F.xxhash64(*by, *[F.col(c).isNull() for c in by], F.lit(seed)).alias("__f")
    while len(set(all_.select(frame()).agg(F.count("*"), F.count_distinct("__f")).first())) > 1:  # two frames of one number
        seed += 1
    some = some.select(frame(), "__x", "__y", "__m")
    n_points = some.count()
    strips = max(1, min(STRIPS, -(-n_points // STRIP)))
    together = max(ASKED, 2 * n_points // strips)  # so points are copied to half as many rows as boxes ask, at most
    tried = some.select("__f", "__x", "__y").orderBy(F.xxhash64("__f", "__x", "__y")).limit(TRIED * strips).toArrow()
    f, x, y = _columns(tried, "__f", "__x", "__y")
    cut = lambda a, b: [c[np.lexsort((b, a, f))][TRIED::TRIED] for c in (f, a, b)]
    across, along = cut(x, y), cut(y, x)
    placed_as = T.StructType([*some.schema, T.StructField("__strip", T.IntegerType()), T.StructField("__band", T.IntegerType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f, x, y = _columns(b, "__f", "__x", "__y")
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(_upto(across, [f, x, y], True), pa.int32()), pa.array(_upto(along, [f, y, x], True), pa.int32())], placed_as.names)

    placed = kept(some.mapInArrow(place, placed_as), f"{at}/placed")
    storage.removed(f"{at}/points")
    sums = np.zeros((len(across[0]) + 2, len(along[0]) + 2), np.int64)  # of all before a strip and before a band
    for r in placed.groupBy("__strip", "__band").agg(F.sum("__m")).collect():  # STRIPS^2 rows at most
        sums[r[0] + 1, r[1] + 1] = r[2]
    sums = sums.cumsum(0).cumsum(1)
    own = own.select(*by, *EDGES, frame())
    sides = ("__s0", "__s1", "__b0", "__b1")
    asked_as = T.StructType([*own.schema, *[T.StructField(c, T.IntegerType()) for c in sides], T.StructField("held", T.LongType())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f, x0, y0, x1, y1 = _columns(b, "__f", *EDGES)
            far = np.full(len(f), np.inf)
            s0, s1, b0, b1 = (_upto(cuts, [f, v, side], True) for cuts, v, side in ((across, x0, -far), (across, x1, far), (along, y0, -far), (along, y1, far)))
            whole = sums[s1, b1] - sums[s0, b1] - sums[s1, b0] + sums[s0, b0]
            yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array(c, pa.int32()) for c in (s0, s1, b0, b1)), pa.array(whole)], asked_as.names)

    asked = kept(own.mapInArrow(ask, asked_as).withColumn("__id", F.monotonically_increasing_id()), f"{at}/asked")
    storage.removed(f"{at}/boxes")
    counted_as = T.StructType([T.StructField("__id", T.LongType()), T.StructField("held", T.LongType())])

    def counted(group: str, edges: tuple[str, str], ends: tuple[str, str], first: str, second: str | None, others: tuple[str, str]) -> DataFrame:
        """What the groups at the edges of an axis add; the other axis tells by its edges, or by its strips."""
        rows = asked.withColumn("__at", F.explode(F.array_distinct(F.array(*ends)))).select("__id", "__f", *edges, *others, *((F.col(c) == F.col("__at")).alias(c) for c in ends), "__at")  # what a count needs
        n = {r["__at"]: r["count"] for r in rows.groupBy("__at").count().collect()}  # STRIPS rows at most
        shares = F.lit([-(-n.get(i, 0) // together) for i in range(len(across[0]) + 1)])
        share = F.pmod(F.xxhash64("__id"), F.get(shares, F.col("__at"))).cast("int")
        parts = placed.select("__f", first, second or "__strip", "__m", F.col(group).alias("__at")).where(F.get(shares, F.col("__at")) > 0).withColumn("__part", F.explode(F.sequence(F.lit(0), F.get(shares, F.col("__at")) - 1)))

        def count(boxes: pa.Table, points: pa.Table) -> pa.Table:
            f, v, w = _columns(points, "__f", first, "__m")
            g, lo, hi, starts, stops = _columns(boxes, "__f", *edges, *ends)
            low = np.where(starts, _upto([f, v], [g, lo], False), 0)
            high = np.where(stops, _upto([f, v], [g, hi], True), 0)
            least, most = _columns(boxes, *others)
            if second is None:
                (values,) = _columns(points, "__strip")
            else:
                (u,) = _columns(points, second)
                values = np.empty(len(u), np.int64)
                values[np.lexsort((u, f))] = np.arange(len(u))
                least, most = _upto([f, u], [g, least], False), _upto([f, u], [g, most], True)
            order, n = np.lexsort((v, f)), len(g)
            both = _below(values[order].astype(np.int64), w[order], np.tile(low, 2), np.tile(high, 2), np.concatenate([most, least]).astype(np.int64))
            return pa.Table.from_arrays([boxes.column("__id"), pa.array(both[:n] - both[n:])], counted_as.names)

        return rows.withColumn("__part", share).groupBy("__at", "__part").cogroup(parts.groupBy("__at", "__part")).applyInArrow(count, counted_as)

    # each is written by itself, so that the shuffles don't lie on the disks together
    strips_ = kept(counted("__strip", ("x0", "x1"), ("__s0", "__s1"), "__x", "__y", ("y0", "y1")), f"{at}/strips")
    bands = kept(counted("__band", ("y0", "y1"), ("__b0", "__b1"), "__y", None, ("__s0", "__s1")), f"{at}/bands")
    storage.removed(f"{at}/placed")
    every = asked.select(*counted_as.names, *by, *EDGES).unionByName(strips_.unionByName(bands), allowMissingColumns=True)  # a box's columns come once
    held = every.groupBy("__id").agg(*(F.first(c, True).alias(c) for c in (*by, *EDGES)), F.sum("held").alias("held")).where("held > 0")
    out = kept(held.select(*by, *EDGES, "held"), f"{at}/held")
    for name in ("asked", "strips", "bands"):
        storage.removed(f"{at}/{name}")
    return out


def with_held(rows: DataFrame, held: DataFrame, edges: dict[str, Column]) -> DataFrame:
    """The rows whose box (edges: from its columns) is among the counts, of one frame, and how many points it holds.

    Up to SENT counts go to every executor.  For more, rows and counts are dealt to as many tasks as the rows ask for.
    """
    held = held.select(*(F.col(c).alias(f"__{c}") for c in edges), "held")
    if held.count() <= SENT:
        held = F.broadcast(held)
    else:
        tasks = tasks_for(rows.sparkSession, rows.count())
        rows, held = rows.repartition(tasks, *edges.values()), held.repartition(tasks, *(f"__{c}" for c in edges))
    return rows.join(held, reduce(lambda a, b: a & b, [v == F.col(f"__{c}") for c, v in edges.items()])).select(*rows.columns, "held")


def best_boxes_crowded(boxes: DataFrame, points: DataFrame, by: list[str], held: DataFrame | None = None) -> DataFrame:
    """best_boxes for frames of very many boxes and points; held: their held_counts, if they are there."""
    spark = boxes.sparkSession
    at, on = storage.fresh(spark, "best"), (*by, *EDGES)
    held = held_counts(boxes, points, by) if held is None else held
    same = lambda a, b, names: reduce(lambda u, v: u & v, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in names])
    # these are mostly small; as files they tell their size, so that where they are, no box is sent
    most = kept(held.groupBy(*by).agg(F.max("held").alias("most")), f"{at}/most")
    top = kept(held.alias("h").join(most.alias("m"), same("h", "m", by) & (F.col("h.held") == F.col("m.most"))).select(*[F.col(f"h.{c}").alias(c) for c in on]), f"{at}/top")  # others can't be best
    seen = kept(points.select(*by).distinct(), f"{at}/seen")
    rated = boxes.alias("b").join(top.alias("t"), same("b", "t", on), "left_semi").unionByName(boxes.alias("b").join(seen.alias("s"), same("b", "s", by), "left_anti"))
    rank = F.struct("score", (-F.col("place")).alias("place"))
    return rated.groupBy(*by).agg(F.max_by(F.struct(*EDGES, "score", "place"), rank).alias("box"))
