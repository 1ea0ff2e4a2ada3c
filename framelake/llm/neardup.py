"""MinHash near-duplicates: circulant MinHash, banding, exact Jaccard verification, components.

A document's set is its distinct 5-word shingles (the whole sequence, if it has fewer words).  Circulant MinHash
needs two permutations of the 32-bit universe only: the first scatters the shingles, the second is applied once for
each coordinate to the scattered value shifted circularly by one more step.  32 bands of 4 coordinates miss a pair of
similarity 0.85 with probability 6e-11.

Documents with equal word sequences are one class and are compared once.  In each bucket of each band, classes are
compared with the bucket's smallest class first (a star: as many pairs as members).  Links are confirmed on the full
sets.  Pairs of one bucket that are still in different components are then compared with each other on their sets, if
their signatures agree in enough coordinates (a pair above the threshold fails this with probability below 1e-9);
large buckets are dealt out as pairs of blocks, and each block gives at most a spanning forest of its links, which are
confirmed on the texts.  So no link that joins two components is lost, no bucket is capped, and the
links and components stay in tables.

Nulls: a null text and a text without words have an empty set and no links.  A null doc_id is an id of its own, the
smallest.  Repeated ids: each of the rows' texts is a class of its own and is compared with all others; clusters() gives
the rows of one id one component, representatives() joins only texts that are alike.  An empty table gives an empty
result.  Further columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from framelake.llm.bpe import pieces
from framelake.llm.common import WORDS_B, key, small_batches, unkey, written
from framelake.llm.components import components
from framelake.llm.hashing import hashes

#: Words of a shingle, bands, coordinates of a band.
SHINGLE, BANDS, ROWS = 5, 32, 4
COORDINATES = BANDS * ROWS
#: Members of a block of a large bucket.
BLOCK = 512
#: Step of the circular shift, and constants of the two permutations of 32-bit numbers (odd, hence bijective).
STEP = 0x9E3779B1
MIX = (0x85EBCA6B, 0xC2B2AE35, 0x7FEB352D, 0x846CA68B)
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def _permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of the 32-bit numbers: xor-shifts and odd multiplications, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(a)
    x ^= x >> np.uint32(13)
    x *= np.uint32(b)
    x ^= x >> np.uint32(16)
    return x


_SHIFTS = (np.arange(COORDINATES, dtype=np.uint64) * STEP % 2**32).astype(np.uint32)


def shingle_hashes(text: bytes) -> tuple[np.ndarray, int]:
    """Distinct 64-bit hashes of the shingles of a lower-cased text, and the number of words."""
    raw = np.frombuffer(text, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.concatenate([[True], space, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    n = len(starts)
    if not n:
        return np.zeros(0, np.uint64), 0
    w = hashes(raw, starts, ends, 5)
    k = min(SHINGLE, n)
    h = np.zeros(n - k + 1, np.uint64)
    for i in range(k):
        h = (h ^ w[i : n - k + 1 + i]) * np.uint64(0x9FB21C651E98DF25)
        h ^= h >> np.uint64(31)
    return np.unique(h), n


def signature(hashes: np.ndarray, chunk: int = 1024) -> np.ndarray:
    """The circulant MinHash signature of a set: all coordinates of a chunk of shingles at once."""
    best = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    scattered = _permute((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32), MIX[0], MIX[1])
    for i in range(0, len(scattered), chunk):
        shifted = scattered[None, i : i + chunk] - _SHIFTS[:, None]
        np.minimum(best, _permute(shifted, MIX[2], MIX[3]).min(axis=1), out=best)
    return best


def normal(text: str | None) -> bytes:
    """The lower-cased words, one space between them."""
    return b" ".join(WORDS_B.findall(text.encode("utf-8", "replace").translate(_LOWER))) if text else b""


def shingles(text: str | None) -> set[tuple[bytes, ...]]:
    """The full set, for verification."""
    w = normal(text).split(b" ") if text else []
    if not w or w == [b""]:
        return set()
    k = min(SHINGLE, len(w))
    return set(zip(*(w[i : len(w) - k + 1 + i] for i in range(k)), strict=True))


def signed(docs: DataFrame) -> DataFrame:
    """k, t, n (set size), cls (hash of the word sequence), sig (signature; null without words) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            ns, cls, sigs = [], [], []
            for t in b.column(2).to_pylist():
                words = normal(t)
                h, _ = shingle_hashes(words)
                ns.append(len(h))
                cls.append(xxhash.xxh3_128_digest(words) if len(h) else None)
                sigs.append(signature(h).tobytes() if len(h) else None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ns, pa.int64()), pa.array(cls, pa.binary()), pa.array(sigs, pa.binary())], ["k", "t", "n", "cls", "sig"])

    return docs.select("k", "t", "text").mapInArrow(run, "k long, t long, n long, cls binary, sig binary")


def linked(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    ta, tb = texts.select(F.col("k").alias("a"), F.col("text").alias("ta")), texts.select(F.col("k").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(ta, "a").join(tb, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str | None, set] = (None, set())
        for batch in pieces(batches):
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if last[0] != x:
                    last = (x, shingles(x))
                s, t = last[1], shingles(y)
                small, large = min(len(s), len(t)), max(len(s), len(t))
                if 100 * small < percent * large:
                    keep.append(False)
                    continue
                common = len(s & t)
                keep.append(bool(common) and 100 * common >= percent * (len(s) + len(t) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def with_sets(texts: DataFrame) -> DataFrame:
    """k, full: the sorted 64-bit hashes of each text's full set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_hashes(normal(t))[0].tobytes() for t in b.column(1).to_pylist()], pa.binary())], ["k", "full"])

    return texts.select("k", "text").mapInArrow(run, "k long, full binary")


def _alike(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    at = np.searchsorted(t, s)
    common = int((t[np.minimum(at, len(t) - 1)] == s).sum())
    return 100 * common >= percent * (len(s) + len(t) - common)


def pairs_of_blocks(buckets: DataFrame, block: int) -> DataFrame:
    """bucket, k, comp, own, i, j: a bucket's members (bucket, k, comp, m; m of them) dealt into blocks, each member once for each pair of blocks that holds its own."""
    rows = buckets.withColumn("blocks", F.ceil(F.col("m") / block).cast("int")).withColumn("own", F.pmod(F.xxhash64("k"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select("bucket", "k", "comp", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))


def rest_links(buckets: DataFrame, sets: DataFrame, least_equal: int, percent: int, block: int = BLOCK) -> DataFrame:
    """Links (a, b) of one bucket that join components which the stars left apart.

    buckets: bucket, k, comp, m; sets: k, sig, full.  A bucket of many members is dealt out as pairs of blocks, each one group
    and a task's work of its own: the sets join the members once these are dealt, so the groups go to tasks by all of
    (bucket, i, j).  Pairs whose signatures agree in least_equal coordinates are compared on their sets, unless links found
    before have joined their components; so a group gives fewer links than it has members.
    """
    rows = pairs_of_blocks(buckets, block).join(sets, "k")

    def run(t: pa.Table) -> pa.Table:
        k, comp, own, i = (t.column(c).to_numpy() for c in ("k", "comp", "own", "i"))
        sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(len(k), -1)
        full = [np.frombuffer(x, np.uint64) for x in t.column("full").to_pylist()]
        band, j = int(t.column("bucket")[0].as_py().split(":")[0]), int(t.column("j")[0].as_py())
        left = np.flatnonzero(own == i)
        right = left if i[0] == j else np.flatnonzero(own == j)
        label = np.unique(comp, return_inverse=True)[1]  # of each member; joined components get one label
        out_a, out_b = [], []
        for x in left:
            c = right[(label[right] != label[x]) & ((k[right] > k[x]) if i[0] == j else True)]
            if not len(c):
                continue
            c = c[(sig[c] == sig[x]).sum(axis=1) >= least_equal]
            if not len(c):
                continue
            # a pair belongs to the first band in which it meets
            meets = (sig[c].reshape(len(c), BANDS, ROWS) == sig[x].reshape(BANDS, ROWS)).all(axis=2)
            for y in c[meets.argmax(axis=1) == band]:
                if label[y] != label[x] and _alike(full[x], full[y], percent):
                    out_a.append(min(int(k[x]), int(k[y])))
                    out_b.append(max(int(k[x]), int(k[y])))
                    label[label == label[y]] = label[x]
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return rows.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long")


def joined(docs: DataFrame, percent: int, key_of: str, by_id: bool, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (k, t, n, rep, node, v), classes (cls, rep, node), and the components of the vertices (node, component).

    t is the text's hash, rep the smallest id of the row's class, node the class's vertex (null without words), v the
    row's: its class, or the id where there is none.  by_id links the vertices of one id to each other.
    """
    small_batches(docs.sparkSession)
    base = docs.select(key(key_of).alias("k"), F.xxhash64("text").alias("t"), "text")
    sigs = written(signed(base), "signatures")
    # written, so that both sides of the joins below are dealt anew and a hot class can be split
    least_ids = written(sigs.where("cls is not null").groupBy("cls").agg(F.min("k").alias("rep")).withColumn("h", F.xxhash64("cls")), "smallest-ids")
    # a class goes by its smallest id; where that is the smallest of several classes, all but one go by their hash
    several = least_ids.groupBy("rep").agg(F.min("h").alias("lead"), F.count("*").alias("m")).where("m > 1").select("rep", "lead")
    reps = written(least_ids.join(several, "rep", "left").select("cls", "rep", F.when(F.col("lead") != F.col("h"), F.col("h")).otherwise(F.col("rep")).alias("node")), "representatives")
    rows = written(sigs.select("k", "t", "n", "cls").join(reps, "cls", "left").select("k", "t", "n", "rep", "node", F.coalesce("node", "k").alias("v")), "classes")
    # from here to the links k is the class's vertex; (id, t) names one of its texts
    distinct = sigs.join(reps.withColumnRenamed("rep", "k"), ["cls", "k"]).select(F.col("node").alias("k"), F.col("k").alias("id"), "t", "sig")
    distinct = written(distinct.dropDuplicates(["k"]), "distinct")
    coordinates = lambda r: F.substring("sig", r * 4 * ROWS + 1, 4 * ROWS)
    bands = distinct.select("k", F.explode(F.array(*[F.concat(F.lit(f"{r}:"), F.base64(coordinates(r))) for r in range(BANDS)])).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.min("k").alias("first"), F.count("*").alias("m")).where("m > 1")
    members = written(bands.join(shared, "bucket"), "buckets")
    used = distinct.join(members.select("k").distinct(), "k", "left_semi").select(F.col("k").alias("node"), F.col("id").alias("k"), "t")
    texts = written(base.join(used, ["k", "t"]).groupBy("node").agg(F.first("text").alias("text")).select(F.col("node").alias("k"), "text"), "texts")
    star = members.where("k != first").select(F.col("first").alias("a"), F.col("k").alias("b")).distinct()
    links = written(linked(star, texts, percent), "linked")
    found = components(links)
    # the smallest member of a bucket has been compared with all others; what is left are pairs of these
    others = members.where("m > 2 and k != first").select("bucket", "k", (F.col("m") - 1).alias("m"))
    placed = others.join(found.withColumnRenamed("node", "k"), "k", "left").select("bucket", "k", "m", F.coalesce("component", "k").alias("comp"))
    mixed = placed.groupBy("bucket").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).where("x != y").select("bucket")
    rest = written(placed.join(mixed, "bucket"), "rest")
    needed = distinct.select("k", "sig").join(rest.select("k").distinct(), "k", "left_semi").join(with_sets(texts.join(rest.select("k").distinct(), "k", "left_semi")), "k")
    # six standard deviations below the threshold's expectation
    p = percent / 100
    least = int(COORDINATES * p - 6 * (COORDINATES * p * (1 - p)) ** 0.5)
    more = linked(written(rest_links(rest, needed, least, percent, block).distinct(), "rest-links"), texts, percent)
    links = links.unionByName(written(more, "linked"))
    if by_id:
        repeated = rows.groupBy("k").agg(F.min("v").alias("x"), F.max("v").alias("y")).where("x != y").select("k")
        links = links.unionByName(rows.select("k", "v").join(repeated, "k", "left_semi").select(F.col("k").alias("a"), F.col("v").alias("b")).distinct())
    return rows, reps, written(components(links), "components")


def clusters(docs: DataFrame, percent: int = 85, key_of: str = "doc_id", block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, class_id of every document."""
    rows, reps, found = joined(docs, percent, key_of, by_id=True, block=block)
    # a component goes by its smallest id; vertices that are no class are ids
    least = found.join(reps.select("node", "rep"), "node", "left").groupBy("component").agg(F.min(F.coalesce("rep", "node")).alias("least"))
    named = found.join(least, "component").select(F.col("node").alias("v"), F.col("least").alias("component"))
    out = rows.join(named, "v", "left")
    comp = F.coalesce("component", "rep", "k")
    return out.select(unkey("k").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(comp != -(2**63), comp).alias("component_id"), (F.col("k") == comp).alias("kept"), F.coalesce("rep", "k").alias("class_id"))


def representatives(docs: DataFrame, percent: int = 85, key_of: str = "doc_id") -> DataFrame:
    """k, t (id and text hash) of one text, that of the smallest id, of each group of texts that are alike, and of all texts without words."""
    rows, _, found = joined(docs, percent, key_of, by_id=False)
    placed = rows.where("node is not null").join(found, "node", "left").select(F.coalesce("component", "node").alias("c"), "k", "t")
    first = placed.groupBy("c").agg(F.min(F.struct("k", "t")).alias("r")).select("r.k", "r.t")
    return first.unionByName(rows.where("node is null").select("k", "t").distinct())
