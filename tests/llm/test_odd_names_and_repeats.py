"""Columns named like those that operators put beside the input's, rows that repeat id and text, ties, and the pipeline's values."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from framelake.llm import fingerprint, mixing, recompress
from framelake.llm.common import free_prefix, in_order

from .conftest import prose

SCHEMA = "doc_id long, text string, lang string, source string"
NAMES = ("__g", "__k", "__t", "__tie", "__w", "__cuts", "__n", "__own", "__row", "___k", "__words", "__removed", "__kept", "_p", "n", "size", "copies", "tie")


def corpus():
    shared = prose(2, 40)
    rows = [(i, prose(i, 30 + i) + (" " + shared if i % 3 == 0 else ""), "en", f"s{i % 3}") for i in range(20)]
    rows += [(100, None, None, None), (101, "", "en", None), (None, prose(50, 25), None, "s1"), (3, None, "en", "s0")]
    rows += [(200, "w " * 30 + shared, "en", "s2")] * 7 + [(5, rows[5][1], "de", "s9"), (201, shared, "en", "s1"), (201, shared, "en", "s1")]
    return rows


def plain(rows):
    """n_words, n_removed, kept of each row, by plain loops."""
    key = lambda i: -(2**63) if i is None else i
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    first = {}
    for (i, *_), w in zip(rows, words):
        for p in range(len(w) - 19):
            g = tuple(w[p : p + 20])
            first[g] = min(first.get(g, (key(i), p)), (key(i), p))
    out = []
    for (i, *_), w in zip(rows, words):
        gone = set()
        for p in range(len(w) - 19):
            if first[tuple(w[p : p + 20])] != (key(i), p):
                gone.update(range(p, p + 20))
        out.append((key(i), len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out)


def test_free_prefix(spark):
    assert free_prefix(spark.createDataFrame([], "a int, _b int")) == "__" and free_prefix(spark.createDataFrame([], "__a int, ____b int")) == "_____"
    df = spark.createDataFrame([(1, {"a": 1}), (1, {"a": 2})], "x int, m map<string,int>")
    assert df.agg(F.min(in_order(df))).first()[0]["m"] == '{"m":{"a":1}}' and df.agg(F.max(in_order(df, ("m",)))).first()[0].asDict() == {"none": 0, "x": 1}


@pytest.mark.parametrize("names", [(), NAMES])
def test_passages_with_repeated_rows_and_any_names(spark, names):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(7) for c in names}).repartition(3)
    got = recompress.deduped(df, group_bytes=2000).collect()
    assert sorted((-(2**63) if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got) == plain(rows)
    assert all(r[c] == 7 for r in got for c in names if c != "n_words")
    assert Counter((r["doc_id"], r["lang"], r["source"]) for r in got) == Counter((i, a, b) for i, _, a, b in rows)


def test_many_repeats_are_one_row_of_a_group(spark):
    text = prose(9, 60)
    df = spark.range(400).select(F.lit(1).cast("long").alias("doc_id"), F.lit(text).alias("text"), F.col("id").alias("other"))
    got = recompress.deduped(df.unionByName(spark.createDataFrame([(2, text, -1)], "doc_id long, text string, other long"))).collect()
    assert len(got) == 401 and {r["other"] for r in got} == set(range(-1, 400))
    assert all((r["n_removed"], r["kept"]) == ((60, "") if r["doc_id"] == 2 else (0, text)) for r in got)


@pytest.mark.parametrize("names", [(), NAMES])
def test_mixed_with_any_names(spark, names):
    rows = [(i, t, a, b, 5) for i, t, a, b in corpus()]
    df = spark.createDataFrame(rows, SCHEMA + ", n_chars long").withColumns({c: F.lit(7) for c in names})
    got, plain_ = mixing.mixed(df), mixing.mixed(df.select("doc_id", "text", "lang", "source", "n_chars"))
    assert got.columns == df.columns and got.count() > 20
    key = lambda d: sorted(d.select("doc_id", "text", "lang", "source", "n_chars").collect(), key=repr)
    assert key(got) == key(plain_) and all(r[c] == 7 for r in got.collect() for c in names)


def test_near_duplicates_keep_the_first_row_whatever_their_order(spark):
    rows = [(1, prose(1, 60), "en", "s", x) for x in (9, 4, 6)] + [(2, prose(1, 60), "en", "s", 1), (3, None, "en", "s", 2), (3, None, "en", "s", 1), (4, prose(2, 60), None, None, None), (4, prose(2, 60), None, None, 3)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, SCHEMA + ", x int").withColumns({"__k": F.lit(7), "__t": F.lit(8), "__row": F.lit(9)}).repartition(3)
        got = corpus_pipeline.drop_near_duplicates(spark, df, "")
        assert got.columns == df.columns
        assert sorted((r["doc_id"], r["x"] or 0, r["__k"], r["__t"], r["__row"]) for r in got.collect()) == [(1, 4, 7, 8, 9), (3, 1, 7, 8, 9), (4, 0, 7, 8, 9)]


def test_pipeline_stages_against_plain_versions(spark):
    """Near-duplicates and passages of one table, stage after stage."""
    words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
    sets = lambda t: {tuple(w[k : k + 5]) for w in [words(t)] for k in range(max(1, len(w) - 4)) if w}
    rows = [(i, t, a, b) for i, t, a, b in dict.fromkeys(corpus()) if i is not None]
    base = prose(70, 90).split(" ")
    rows += [(300 + k, " ".join(w if j != 13 * k else "other" for j, w in enumerate(base)), "en", "s0") for k in range(5)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_chars", F.length("text").cast("long"))
    # one text of each group of alike ones
    texts = sorted({(i, t) for i, t, *_ in rows}, key=lambda x: (x[0], x[1] is not None))
    group = {x: x for x in texts}
    for a in texts:
        for b in texts:
            s, t = sets(a[1]), sets(b[1])
            if a < b if None not in (a[1], b[1]) else False:
                if s and t and 100 * len(s & t) >= 80 * len(s | t):
                    group = {k: group[a] if v == group[b] else v for k, v in group.items()}
    least = {}
    for x, g in group.items():
        least[g] = min(least.get(g, x), x, key=lambda y: (y[0], repr(y[1])))
    kept = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert sorted({(r["doc_id"], r["text"] or "") for r in kept.collect()}) == sorted({(i, t or "") for i, t in least.values()})
    out = corpus_pipeline.drop_repeated_passages(spark, kept, "")
    want = plain([tuple(r)[:4] for r in kept.collect()])
    got = sorted((r["doc_id"], len(words(r["text"]))) for r in out.collect())
    assert got == sorted((i, n - gone) for i, n, gone, _ in want) and any(gone for _, _, gone, _ in want)


@pytest.mark.parametrize("n", [3, 300, 3000])
def test_large_differences_peel(spark, n):
    """Sets of digests that differ in very many: the recovered numbers are those of the sets, at a size below twice what is needed."""
    a, b = spark.range(n).select(F.xxhash64("id").alias("d")), spark.range(n // 3, n + n // 2).select(F.xxhash64("id").alias("d"))
    row = a.agg(F.array_sort(F.collect_list("d")).alias("a")).crossJoin(b.agg(F.array_sort(F.collect_list("d")).alias("b")))
    s = lambda c: fingerprint.sketch(F.col(c), fingerprint.CELLS)
    got = row.select(fingerprint.difference(F.col("a"), F.col("b"), s("a"), s("b")).alias("x")).first()["x"]
    assert (got["plus"], got["minus"]) == (n // 3, n // 2) and got["m"] <= max(18, 1.3 * 4 * (n // 3 + n // 2))


@pytest.mark.parametrize("m", [18, 72, 288])
def test_cells_against_plain_folding(spark, m):
    rows = [(int(c), k % 3 - 1, k * 7, k * 11) for k, c in enumerate([*range(m), *range(0, m, 5), 0, m - 1])]
    e = F.array(*[F.struct(F.lit(c).cast("long").alias("c"), F.lit(n).cast("long").alias("n"), F.lit(x).cast("long").alias("key"), F.lit(y).cast("long").alias("check")) for c, n, x, y in rows])
    got = [tuple(r) for r in spark.range(1).select(fingerprint.cells(e, F.lit(m).cast("long")).alias("c")).first()["c"]]
    want = [[0, 0, 0] for _ in range(m)]
    for c, n, x, y in rows:
        want[c] = [want[c][0] + n, want[c][1] ^ x, want[c][2] ^ y]
    assert got == [tuple(w) for w in want]
