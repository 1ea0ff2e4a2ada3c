"""Mixing sources to target weights, with DataFrame functions only.

Each source's words are packed, in the order of its documents, into blocks of ``block`` words (a source of less than
64 blocks has shorter ones, of one length again, so that its target can be met to a sixty-fourth).  A source gets as many
slots as its target takes blocks.  All slots are dealt over the output shards, ``slots`` places each, by one
pseudorandom permutation of all places, so a shard's source counts are a multinomial draw from the target shares, given
that each source's total is met (a multivariate hypergeometric draw; independent draws would leave a source of ten words
without any slot in a good part of all runs).  A slot is the i-th of its source; a pseudorandom permutation of the
source's blocks that depends on the source and the pass maps i to a block, so that a source's blocks are all used once
before any is used again and none more than twice.  Blocks are joined to documents by index.

The permutations are swap-or-not shuffles (Hoang, Morris and Rogaway, 2012): each round sends x to key - x or leaves
it, as a hash of the larger of the two says, which is one-to-one on any number of places, and plain column arithmetic.

Prefix sums run in two levels (rows in buckets of about the square root of their number, then the buckets), so a hot
source is in no single task.  Rows that are equal in id, text and source are packed one after the other, as one run
until the end.  Draws depend only on the seed, the source's rank and the slot's number: reruns agree.

Nulls: a null text has size 0, a null source is a source of its own and sorts last, a null doc_id is an id of its own
and sorts first.  Documents of size 0 take nothing.  Repeated rows are packed one after the other and each gets a row.
Very long texts spread over many blocks.  An empty table gives an empty result; taken() leaves further columns out,
mixed() keeps them, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import WORD, free_prefix, in_order, key, unkey, written

#: Weights by rank of the source, repeating.
WEIGHTS = (5, 2, 1)
#: Rounds of a permutation, and slots that one row makes.
ROUNDS, CHUNK = 12, 65536


def targets(sizes: DataFrame, share: float = 1.5, cap: float = 2.0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """From source, source_size: rank, target.

    Sources stop at cap times their size; the excess goes to the others by weight, until none is above.  With the
    sources sorted by size/weight, those that stop are a prefix: the first k for which k's fill level is not reached.
    The table has one row for each source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")).cast("double")
    ranked = ranked.withColumn("w", w).withColumn("cap", cap * F.col("source_size")).withColumn("fill", F.col("cap") / F.col("w"))
    order = Window.orderBy("fill", "rank")
    below, all_ = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    left = share * F.sum("source_size").over(all_) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    weight_left = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", left / weight_left).withColumn("full", F.col("fill") <= F.col("level"))
    level = F.min(F.when(~F.col("full"), F.struct("fill", "rank", "level"))).over(all_)["level"]
    return ranked.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("w") * level)).select("source", "source_size", "rank", "target")


def permuted(x: Column, n: Column, *keys: Column | int) -> Column:
    """The place of x in a permutation of 0..n-1 that the keys choose."""
    key = F.xxhash64(*[k if isinstance(k, Column) else F.lit(k) for k in keys])

    def swap_or_not(a: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - a, n)
        heads = F.xxhash64(F.greatest(a, other), r, key).bitwiseAND(F.lit(1)) == 1
        return F.when(heads, other).otherwise(a)

    # one bound variable a round; a chain of projections would make a method too long to be compiled
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x.cast("long"), swap_or_not)


def block_of(size: Column, block: int) -> Column:
    """Words of a source's blocks: block, less for a source of few words, which has some 64 blocks then."""
    return F.least(F.lit(block), F.ceil(size / 64)).cast("long")


def tie() -> Column:
    """Tells rows of one id apart by text and source."""
    return F.xxhash64(F.coalesce("text", F.lit("")), F.coalesce("source", F.lit("")), F.col("source").isNull())


def mix(docs: DataFrame, block: int = 64, slots: int = 4096, seed: int = 17) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (k, tie, source, size, lo, ...), the sources' targets, and how often each block is used.

    lo is the document's first word in its source's order, blocks are (rank, b, turn).
    """
    sized = docs.select(key().alias("k"), tie().alias("tie"), F.col("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sized = written(sized.groupBy("k", "tie", "source", "size").agg(F.count("*").alias("copies")), "sizes")  # 40 bytes a document; the texts are not read again
    total = sized.agg(F.count("*")).first()[0]
    n_buckets = max(1, int(total**0.5))
    sized = sized.withColumn("bucket", F.pmod(F.xxhash64("k", "tie"), F.lit(n_buckets))).withColumn("run", F.col("size") * F.col("copies"))
    sums = sized.groupBy("source", "bucket").agg(F.sum("run").alias("bucket_size"))
    sources = targets(sums.groupBy("source").agg(F.sum("bucket_size").alias("source_size")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("bucket_lo", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))).drop("bucket_size")
    inside = Window.partitionBy("source", "bucket").orderBy("k", "tie").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("own_lo", F.coalesce(F.sum("run").over(inside), F.lit(0)))
    same = placed["source"].eqNullSafe(starts["source"]) & (placed["bucket"] == starts["bucket"])
    placed = placed.join(starts, same).select(placed["k"], placed["tie"], placed["source"], placed["size"], placed["copies"], (F.col("own_lo") + F.col("bucket_lo")).alias("lo"))
    t = sources.select(F.col("source").alias("s"), "source_size", "rank", "target")
    placed = placed.join(t, placed["source"].eqNullSafe(t["s"])).drop("s")
    # the copies of a run, each in its place; a long run is dealt out in chunks first
    chunks = placed.where("copies > 1").withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / CHUNK).cast("long"))))
    chunks = chunks.repartition("k", "tie", "c")
    last = F.least(F.col("copies"), (F.col("c") + 1) * CHUNK) - 1
    copies = chunks.withColumn("i", F.explode(F.sequence(F.col("c") * CHUNK, last))).withColumn("lo", F.col("lo") + F.col("i") * F.col("size"))
    placed = placed.where("copies = 1").drop("copies").unionByName(copies.drop("copies", "c", "i"))
    return placed, sources, used(sources, block, slots, seed)


def used(sources: DataFrame, block: int, slots: int, seed: int) -> DataFrame:
    """rank, b, turn, shard: block b of the source is used in pass turn (0 or 1), in a place of an output shard."""
    all_ = Window.partitionBy()
    upto = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    # a source's slots are counted by the words that its blocks hold on average, as its last block may be short
    s = sources.where("source_size > 0").withColumn("n", F.ceil(F.col("source_size") / block_of(F.col("source_size"), block)).cast("long"))
    s = s.withColumn("want", F.least(F.rint(F.col("target") * F.col("n") / F.col("source_size")).cast("long"), 2 * F.col("n"))).where("want > 0")
    s = s.select("rank", "n", "want", F.coalesce(F.sum("want").over(upto), F.lit(0)).alias("lo"), F.sum("want").over(all_).alias("all"))
    chunks = s.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("want") - 1) / CHUNK).cast("long"))))
    # few rows become very many here: dealt out first, into a number of tasks that is not folded
    session = sources.sparkSession
    chunks = chunks.repartition(max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism), "rank", "c")
    last = F.least(F.col("want"), (F.col("c") + 1) * CHUNK) - 1
    i = chunks.select("rank", "n", "lo", "all", F.explode(F.sequence(F.col("c") * CHUNK, last)).alias("i"))
    turn = F.floor(F.col("i") / F.col("n")).cast("long")
    place = permuted(F.col("lo") + F.col("i"), F.col("all"), seed)
    b = permuted(F.col("i") % F.col("n"), F.col("n"), F.col("rank"), turn, seed + 1)
    return i.select("rank", b.alias("b"), turn.alias("turn"), F.floor(place / slots).cast("long").alias("shard"))


def counts(use: DataFrame) -> DataFrame:
    """shard, rank, n: the source counts of each output shard."""
    return use.groupBy("shard", "rank").agg(F.count("*").alias("n"))


def spread(placed: DataFrame, block: int) -> DataFrame:
    """A row for each block that a document has words in: rank, b, k, tie, a and z (word range within the document)."""
    own = placed.where("size > 0").withColumn("block", block_of(F.col("source_size"), block))
    first, last = F.floor(F.col("lo") / F.col("block")).cast("long"), F.floor((F.col("lo") + F.col("size") - 1) / F.col("block")).cast("long")
    rows = own.select("k", "tie", "rank", "lo", "size", "block", F.explode(F.sequence(first, last)).alias("b"))
    return rows.select("k", "tie", "lo", "rank", "b", F.greatest(F.col("b") * F.col("block") - F.col("lo"), F.lit(0)).alias("a"), F.least((F.col("b") + 1) * F.col("block") - F.col("lo"), F.col("size")).alias("z"))


def taken(docs: DataFrame, block: int = 64, slots: int = 4096, seed: int = 17) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, first_shard of every document (null: in no output shard)."""
    placed, _, use = mix(docs, block, slots, seed)
    times = use.groupBy("rank", "b").agg(F.count("*").alias("times"), F.min("shard").alias("shard"))
    got = spread(placed, block).join(times.hint("merge"), ["rank", "b"]).groupBy("rank", "k", "tie", "lo").agg(F.sum((F.col("z") - F.col("a")) * F.col("times")).alias("taken"), F.min("shard").alias("first_shard"))
    out = placed.join(got, ["rank", "k", "tie", "lo"], "left")
    return out.select(unkey("k").alias("doc_id"), "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_shard")


def mixed(docs: DataFrame, block: int = 64, slots: int = 4096, seed: int = 17) -> DataFrame:
    """The mix as documents: a row for each document and pass with the words that were taken, white space as one space."""
    placed, _, use = mix(docs, block, slots, seed)
    p = free_prefix(docs)
    cut = spread(placed, block).join(use.hint("merge"), ["rank", "b"]).groupBy("k", "tie", "lo", "turn").agg(F.array_sort(F.collect_list(F.struct("a", "z"))).alias(f"{p}cuts"), F.sum(F.col("z") - F.col("a")).alias(f"{p}n"))
    cut = cut.select(F.col("k").alias(f"{p}k"), F.col("tie").alias(f"{p}tie"), f"{p}cuts", f"{p}n")
    # rows that repeat id, text and source share the text, of the first of them by all columns; each has cuts of its own
    keyed = docs.withColumns({f"{p}k": key(), f"{p}tie": tie()})
    text = keyed.groupBy(f"{p}k", f"{p}tie").agg(F.min_by(F.struct(*docs.columns), in_order(docs, ("doc_id", "text", "source"))).alias(f"{p}row")).select(f"{p}k", f"{p}tie", f"{p}row.*")
    rows = text.join(cut, [f"{p}k", f"{p}tie"])
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    whole = F.size(f"{p}w") == F.col(f"{p}n")
    some = F.array_join(F.flatten(F.transform(f"{p}cuts", lambda c: F.slice(f"{p}w", (c["a"] + 1).cast("int"), (c["z"] - c["a"]).cast("int")))), " ")
    rows = rows.withColumn(f"{p}w", words).withColumn("text", F.when(whole, F.col("text")).otherwise(some))
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)
