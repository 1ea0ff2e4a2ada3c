"""Document fingerprints: invertible Bloom lookup sketches, with DataFrame functions only.

A text's paragraphs are its lines, long ones cut after every 256 code points.  Each distinct paragraph's 64-bit digest
goes to one cell in each of three parts of a sketch; a cell holds a count, the exclusive or of the digests and that of
their check values.  Subtracting two sketches leaves the digests in which the texts differ; cells that hold one
digest are peeled until nothing is left.  Where peeling fails, sketches four times as large are tried, again and again
until one succeeds: there is no largest size.  As a sketch of m cells gives m digests at most, sizes below the
difference of the two counts, which the cells' counts tell, with the cells that peeling needs for each, are passed over.
The likeness of two texts is the Jaccard
measure of their digest sets, got from the two counts and the peeled digests.

A sketch of m cells over n digests is filled, and peeled, in about n log m + m steps: entries are dealt into FAN parts of the
cells, these into FAN parts each, and so on until each part is one cell.

The fingerprint is the smallest sketch as hexadecimal text: a fixed size for any document, equal for equal texts.

Null texts are empty (no paragraph; two empty texts are alike: 1).  Null ids come first in the order; rows that repeat
an id and its text count as one document in the order and get equal rows; equal ids with different texts follow by
hash.  A single document's next is itself.  An empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from framelake.llm.common import key, unkey, written

#: Cells of the fingerprint, which is the first sketch tried; how much larger the next one is.
CELLS, LARGER = 18, 4
#: Parts that a deal makes of a part, and digits of the largest cell number; cells that peeling needs for each digest of a difference, nearly.
FAN, MOST_DIGITS, ROOM = 5, 16, 1.2
#: Sizes that there are (18 * 4^15 cells are beyond any text), and peeling rounds of each attempt.
ATTEMPTS, ROUNDS = 16, 12


def digests(text: Column) -> Column:
    """The sorted distinct 64-bit digests of a text's paragraphs."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(r"[^\n]{1,256}"), F.lit(0)), lambda p: F.xxhash64(p))))


def _check(d: Column) -> Column:
    return F.xxhash64(d, F.lit(3)).bitwiseAND(F.lit(0xFFFFFFFF))


def _entries(d: Column, n: Column, m: Column) -> Column:
    """The three entries (cell, count, key, check) of a digest: other bits of it for each part."""
    third = (m / F.lit(3)).cast("long")

    def entry(part: int) -> Column:
        at = F.shiftrightunsigned(F.xxhash64(d, F.lit(part)), 20) % third + F.lit(part) * third
        return F.struct(at.alias("c"), n.cast("long").alias("n"), d.alias("key"), _check(d).alias("check"))

    return F.array(*map(entry, range(3)))


def _bound(value: Column, use) -> Column:
    """use(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _add(a: Column, x: Column) -> Column:
    return F.struct((a["n"] + x["n"]).alias("n"), a["key"].bitwiseXOR(x["key"]).alias("key"), a["check"].bitwiseXOR(x["check"]).alias("check"))


def cells(entries: Column, m: Column) -> Column:
    """The m cells (n, key, check) of entries, which are dealt to them digit by digit of the cell's number."""
    zero = F.struct(*(F.lit(0).cast("long").alias(x) for x in ("n", "key", "check")))
    digits = F.ceil(F.log(m.cast("double")) / math.log(FAN) - 1e-9).cast("int")
    place = lambda left: F.element_at(F.array(*[F.lit(FAN**i) for i in range(MOST_DIGITS)]), left + 1)

    def deal(parts: Column, left: Column) -> Column:
        """Each part in FAN parts by the digit that has so many behind it."""
        at = place(left)
        return F.flatten(F.transform(parts, lambda own: F.transform(F.array(*map(F.lit, range(FAN))), lambda q: F.filter(own, lambda x: F.floor(x["c"] / at) % FAN == q))))

    dealt = F.aggregate(F.reverse(F.sequence(F.lit(0), digits - 1)), F.array(entries), deal)
    return F.transform(F.slice(dealt, F.lit(1), m.cast("int")), lambda own: F.aggregate(own, zero, _add))


def sketch(d: Column, m: Column | int) -> Column:
    """Array of m cells of the digests in array d."""
    m = F.lit(m).cast("long") if isinstance(m, int) else m
    return cells(F.flatten(F.transform(d, lambda x: _entries(x, F.lit(1), m))), m)


def peel(a: Column, b: Column, m: Column) -> Column:
    """Struct (ok, plus, minus): how many digests only a, only b has, from their sketches of m cells."""
    less = lambda x, y: F.struct((x["n"] - y["n"]).alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check"))
    pure_type = "array<struct<n:bigint,key:bigint>>"
    start = F.struct(F.zip_with(a, b, less).alias("cells"), F.array().cast(pure_type).alias("pure"), F.lit(0).cast("long").alias("plus"), F.lit(0).cast("long").alias("minus"), F.lit(False).alias("idle"))

    def step(s: Column, turn: Column) -> Column:
        # even turns look for cells with one digest, odd ones take what was found out of its cells
        alone = F.filter(s["cells"], lambda c: (F.abs(c["n"]) == 1) & (_check(c["key"]) == c["check"]))
        pure = F.array_distinct(F.transform(alone, lambda c: F.struct(c["n"].alias("n"), c["key"].alias("key"))))
        found = _bound(pure, lambda p: F.struct(s["cells"].alias("cells"), p.alias("pure"), s["plus"].alias("plus"), s["minus"].alias("minus"), (F.size(p) == 0).alias("idle")))
        out = cells(F.flatten(F.transform(s["pure"], lambda p: _entries(p["key"], p["n"], m))), m)
        plus, minus = F.size(F.filter(s["pure"], lambda p: p["n"] > 0)), F.size(F.filter(s["pure"], lambda p: p["n"] < 0))
        done = F.struct(F.zip_with(s["cells"], out, less).alias("cells"), F.array().cast(pure_type).alias("pure"), (s["plus"] + plus).alias("plus"), (s["minus"] + minus).alias("minus"), F.lit(False).alias("idle"))
        return F.when(s["idle"], s).when(turn % 2 == 0, found).otherwise(done)

    end = F.aggregate(F.sequence(F.lit(0), F.lit(2 * ROUNDS - 1)), start, step)
    return _bound(end, lambda s: F.struct((~F.exists(s["cells"], lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))).alias("ok"), s["plus"].alias("plus"), s["minus"].alias("minus")))


def difference(a: Column, b: Column, sa: Column, sb: Column) -> Column:
    """Struct (m, plus, minus) of two digest arrays: the size at which peeling succeeded, and what it recovered.

    sa and sb are their sketches of CELLS cells.
    """
    least = ROOM * F.abs(F.size(a) - F.size(b))
    start = F.struct(F.lit(None).cast("long").alias("m"), F.lit(None).cast("long").alias("plus"), F.lit(None).cast("long").alias("minus"))

    def attempt(m: Column) -> Column:
        first = m == CELLS
        got = peel(F.when(first, sa).otherwise(sketch(a, m)), F.when(first, sb).otherwise(sketch(b, m)), m)
        return _bound(got, lambda g: F.when(g["ok"], F.struct(m.alias("m"), g["plus"].alias("plus"), g["minus"].alias("minus"))).otherwise(start))

    return F.aggregate(F.array(*(F.lit(CELLS * LARGER**i).cast("long") for i in range(ATTEMPTS))), start, lambda s, m: F.when(s["m"].isNotNull() | (m < least), s).otherwise(attempt(m)))


def likeness(a: Column, b: Column, sa: Column, sb: Column) -> Column:
    """Jaccard measure of two digest arrays from their peeled difference."""
    na, nb = F.size(a).cast("long"), F.size(b).cast("long")
    return _bound(difference(a, b, sa, sb), lambda x: F.when(na + nb == 0, F.lit(1.0)).otherwise((na - x["plus"]) / (na + x["minus"])))


def as_text(cells: Column) -> Column:
    """Hexadecimal text of a sketch: 4 digits of count, 16 of key, 8 of check for each cell."""
    one = lambda c: F.concat(F.lpad(F.hex(c["n"].bitwiseAND(F.lit(0xFFFF))), 4, "0"), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(c["check"]), 8, "0"))
    return F.array_join(F.transform(cells, one), "")


def following(docs: DataFrame) -> DataFrame:
    """k, h, n_chars of the distinct documents with the key of the next one (cyclic): nk, nh.

    The narrow keys are range-partitioned and written; each partition looks ahead by itself, and its last row takes the
    first row of the next partition from a table with one row for each partition.
    """
    keys = docs.select("k", "h", F.length("text").cast("long").alias("n")).groupBy("k", "h").agg(F.first("n").alias("n"))
    ranged = written(keys.repartitionByRange("k", "h").withColumn("part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("part").orderBy("k", "h")
    ahead = ranged.withColumn("next", F.lead(F.struct("k", "h")).over(inside))
    firsts = ranged.groupBy("part").agg(F.min(F.struct("k", "h")).alias("head"))
    row = Window.orderBy("part")
    firsts = firsts.withColumn("after", F.coalesce(F.lead("head").over(row), F.first("head").over(row))).select("part", "after")
    out = ahead.join(F.broadcast(firsts), "part")  # one row for each partition of the range exchange
    nxt = F.coalesce("next", "after")
    return out.select("k", "h", "n", nxt["k"].alias("nk"), nxt["h"].alias("nh"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    base = docs.select(key().alias("k"), F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    order = written(following(base), "next")
    back = order.select(F.col("nk").alias("k"), F.col("nh").alias("h"), F.col("k").alias("pk"), F.col("h").alias("ph"), F.col("n").alias("pn"))
    # only as much of the next text as the edit takes, and its digests, move to the document before it
    gave = base.join(back, ["k", "h"]).select(F.col("pk").alias("k"), F.col("ph").alias("h"), F.expr("substring(text, 1, cast(pn div 4 as int))").alias("head"), digests(F.col("text")).alias("dn"))
    gave = gave.dropDuplicates(["k", "h"])
    rows = base.join(gave, ["k", "h"])
    n = F.length("text")
    rows = rows.select("k", n.cast("long").alias("n_chars"), digests(F.col("text")).alias("d"), F.expr("concat(substring(text, 1, length(text) - cast(length(text) div 4 as int)), head)").alias("edited"), "dn")
    rows = rows.select("k", "n_chars", "d", "dn", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), digests(F.col("edited")).alias("de"))
    rows = rows.select("*", sketch(F.col("d"), CELLS).alias("s"), sketch(F.col("de"), CELLS).alias("se"), sketch(F.col("dn"), CELLS).alias("sn"))
    near = lambda other, cells: likeness(F.col("d"), F.col(other), F.col("s"), F.col(cells))
    return rows.select(unkey("k").alias("doc_id"), "n_chars", "edited_sha256", as_text(F.col("s")).alias("fingerprint"), as_text(F.col("se")).alias("edited_fingerprint"), near("de", "se").alias("near_edited"), near("dn", "sn").alias("near_next"))
