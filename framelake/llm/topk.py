"""Exact top-k search by inner product: ball trees in shards, branch and bound.

Vectors are turned into integers (floor(256 * x)), so scores are exact.  Rows are dealt into shards of bounded bytes by
a hash of their place in the table; each shard's ball tree is built once and stored as one row.  A query opens a tree's
nodes in the order of their upper bounds q.c + |q| r and stops when the best bound left is below its current k-th score.

That score is shared as it grows: the shards are searched in rounds of 1, 1, 2, 4, ... of them, each starting from
the k-th scores of all rounds before, and within a round a task hands the k-th scores of one shard on to its next ones.
Queries travel in packed blocks, a row for each block and shard; a tree travels once a round.

Vectors that are null, empty, or hold a null or a non-finite component take no part, nor do null ids.  Every row is a
candidate, repeated rows too, and, where its id is a query's, a query (equal rows are one query): a query meets no row
of its own id, and the rows of one id share one list of the k best of all their scores.  A query meets only vectors of its own length.  Ties go to smaller ids.  Scores
beyond 64 bits are given as the nearest long.  An empty table gives an empty result.  Further columns are left out.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import written

#: Sums of products below this are exact as doubles.
_EXACT = 2.0**52
_LONG = 2**63 - 1


def integers(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """id, dim, v (array of double, whole numbers), at (the row's place) of the rows that take part; at changes between runs."""
    ok = F.col("v").isNotNull() & (F.size("v") > 0) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    v = vectors.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("v")).where(F.col("id").isNotNull()).where(ok)

    def floor(y: Column) -> Column:  # floor() itself ends at 64 bits
        return F.rint(y) - F.when(F.rint(y) > y, 1.0).otherwise(0.0) + 0.0

    return v.select("id", F.size("v").alias("dim"), F.transform("v", lambda x: floor(x * scale)).alias("v"), F.monotonically_increasing_id().alias("at"))


class BallTree:
    """Leaves are ranges of the reordered vectors; nodes are split at the median of their widest direction."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, leaf: int = 256) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.v = ids[order], v[order]
        self.center, self.radius, self.lo, self.hi, self.child = [], [], [], [], []
        self._node(0, len(ids), leaf)
        self.center, self.radius = np.array(self.center), np.array(self.radius)
        self.exact = float(np.abs(self.v).max(initial=0)) ** 2 * self.v.shape[1] < _EXACT

    def _node(self, lo: int, hi: int, leaf: int) -> int:
        at, part = len(self.lo), self.v[lo:hi]
        c = part.mean(axis=0)
        self.center.append(c)
        self.radius.append(float(np.sqrt(((part - c) ** 2).sum(axis=1).max())))
        self.lo.append(lo)
        self.hi.append(hi)
        self.child.append(None)
        if hi - lo > leaf:
            far = part[((part - c) ** 2).sum(axis=1).argmax()]
            order = np.argsort(part @ (far - c), kind="stable")
            self.ids[lo:hi], self.v[lo:hi] = self.ids[lo:hi][order], part[order]
            mid = (lo + hi) // 2
            self.child[at] = (self._node(lo, mid, leaf), self._node(mid, hi, leaf))
        return at

    def scores(self, q: np.ndarray, lo: int, hi: int) -> np.ndarray:
        if self.exact and float(np.abs(q).max(initial=0)) * float(np.abs(self.v[lo:hi]).max(initial=0)) * len(q) < _EXACT:
            return self.v[lo:hi] @ q
        whole = [int(x) for x in q]  # beyond doubles: whole numbers of any size
        return np.array([sum(a * int(b) for a, b in zip(whole, row, strict=True)) for row in self.v[lo:hi]], object)

    def search(self, q: np.ndarray, own: int, k: int, floor: float) -> list[tuple[int, int]]:
        """(score, id) of the k best but own, those below floor left out at will."""
        norm = float(np.sqrt(q @ q))
        bounds = self.center @ q + norm * self.radius
        slack = 1.0 + 1e-9 * (np.abs(bounds) + norm * np.abs(self.radius))
        bounds = bounds + slack
        best: list[tuple] = []  # a heap of (score, -id): the worst first
        heap = [(-bounds[0], 0)]
        while heap:
            bound, at = heapq.heappop(heap)
            least = max(floor, best[0][0]) if len(best) == k else floor
            if -bound < least:
                break
            if self.child[at]:
                for c in self.child[at]:
                    if bounds[c] >= least:
                        heapq.heappush(heap, (-bounds[c], c))
                continue
            lo, hi = self.lo[at], self.hi[at]
            s = self.scores(q, lo, hi)
            pick = np.flatnonzero(s >= least)
            for i in pick:
                item = (int(s[i]), -int(self.ids[lo + i]))
                if item[1] == -own:
                    continue
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
        return [(s, -i) for s, i in best]


def trees(vectors: DataFrame, n_shards: int) -> DataFrame:
    """dim, shard, tree."""

    def build(t: pa.Table) -> pa.Table:
        v = np.array(t.column("v").to_pylist(), float)
        tree = BallTree(t.column("id").to_numpy(), v)
        return pa.table({"dim": t.column("dim").slice(0, 1), "shard": t.column("shard").slice(0, 1), "tree": pa.array([pickle.dumps(tree, 5)], pa.binary())})

    return vectors.withColumn("shard", F.pmod(F.xxhash64("at"), F.lit(n_shards)).cast("int")).groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, tree binary")


def packed(queries: DataFrame, blocks: int) -> DataFrame:
    """dim, block, ids, v, floor: the queries of a block as one row."""

    def pack(t: pa.Table) -> pa.Table:
        floor = np.array([-np.inf if x is None else x for x in t.column("floor").to_pylist()], float)
        cols = [t.column("id").to_numpy(), np.array(t.column("v").to_pylist(), float), floor]
        return pa.table({"dim": t.column("dim").slice(0, 1), "block": t.column("block").slice(0, 1)} | {n: pa.array([c.tobytes()], pa.binary()) for n, c in zip(("ids", "v", "floor"), cols, strict=True)})

    return queries.withColumn("block", F.pmod(F.xxhash64("at"), F.lit(blocks)).cast("int")).groupBy("dim", "block").applyInArrow(pack, "dim int, block int, ids binary, v binary, floor binary")


def search(index: DataFrame, blocks: DataFrame, first: int, end: int, k: int, handed: int = 64) -> DataFrame:
    """query_id, score, vec_id: each query's k best of every shard from first to before end."""
    sent = blocks.withColumn("shard", F.explode(F.sequence(F.lit(first), F.lit(end - 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        floors: dict[tuple[int, int], np.ndarray] = {}  # of the blocks seen last
        for b in batches:
            for dim, shard, block, ids, v, floor, tree in zip(*(b.column(c).to_pylist() for c in range(7)), strict=True):
                if held is None or held[0] != (dim, shard):
                    held = ((dim, shard), pickle.loads(tree))
                ids, v = np.frombuffer(ids, np.int64), np.frombuffer(v, float).reshape(-1, dim)
                least = floors.pop((dim, block), None)
                least = np.frombuffer(floor, float).copy() if least is None else least
                out: tuple[list, list, list] = ([], [], [])
                for i, own in enumerate(ids.tolist()):
                    got = held[1].search(v[i], own, k, least[i])
                    if len(got) == k:
                        least[i] = max(least[i], _below(min(s for s, _ in got)))
                    out[0].extend([own] * len(got))
                    out[1].extend(max(-_LONG - 1, min(_LONG, s)) for s, _ in got)
                    out[2].extend(x for _, x in got)
                floors[dim, block] = least
                if len(floors) > handed:
                    del floors[next(iter(floors))]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["query_id", "score", "vec_id"])

    both = sent.join(index, ["dim", "shard"]).select("dim", "shard", "block", "ids", "v", "floor", "tree")
    return both.mapInArrow(run, "query_id long, score long, vec_id long")


def _below(score: int) -> float:
    """A double that is not above the score."""
    return float(score) - abs(float(score)) * 1e-15


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The k best rows of each query id; a query has k rows for each shard at most."""
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, per_shard: int = 8192, per_block: int = 4096, most_bytes: int = 16_000_000) -> DataFrame:
    """query_id, rank, vec_id, score for the vectors whose id is divisible by every, against all.

    A shard has per_shard rows, a block per_block queries, fewer where their vectors take more than most_bytes.
    """
    v = written(integers(vectors), "vectors")
    n, n_queries, dim = v.agg(F.count("*"), F.coalesce(F.sum((F.col("id") % every == 0).cast("long")), F.lit(0)), F.coalesce(F.max("dim"), F.lit(1))).first()
    per_shard, per_block = (max(1, min(x, most_bytes // (8 * dim))) for x in (per_shard, per_block))
    n_shards, blocks = max(1, -(-n // per_shard)), max(1, -(-n_queries // per_block))
    index = written(trees(v, n_shards), "trees")
    queries = v.where(F.col("id") % every == 0).groupBy("id", "dim", "v").agg(F.min("at").alias("at"))  # equal rows are one query
    best, first, end = None, 0, 1
    while first < n_shards:
        if best is None:
            own = queries.withColumn("floor", F.lit(None).cast("double"))
        else:
            floors = best.where(F.col("rank") == k).select(F.col("query_id").alias("id"), (F.col("score").cast("double") - F.abs(F.col("score").cast("double")) * 1e-15).alias("floor"))
            own = queries.join(floors, "id", "left")
        found = search(index, packed(own, blocks), first, end, k)
        best = written(_best(found if best is None else found.unionByName(best.drop("rank")), k), "best")
        first, end = end, min(n_shards, 2 * end)
    return best.select("query_id", "rank", "vec_id", "score")
