"""op11, op12 and op13 against plain versions, on odd rows and on the given tables."""

import hashlib
import math
import os

import numpy as np
import pytest
from oracle import SF, same

from framelake.llm import cluster, queries, vectors, warc, whiten
from framelake.llm.common import fresh, table

CLASH = ("id", "v", "cluster", "distance", "component", "n", "first", "digest", "path", "at", "payload", "page", "part")
VECTORS = "vec_id long, embedding array<float>"


def odd_vectors(spark, dims=4):
    """Nulls everywhere, other lengths, repeated rows and ids, ties, and clashing names."""
    from pyspark.sql import functions as F

    r = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r.normal(size=dims)]) for i in range(60)]
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, rows[9][1]), (100, None), (101, [None] * dims), (102, [float("nan")] + [0.0] * (dims - 1)), (103, [float("inf")] * dims), (104, []), (105, [1.0] * (dims + 1)), (106, [0.0] * dims), (107, [0.0] * dims)]
    return spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in CLASH}), rows


def sound(rows, dims):
    return [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]


def plain_kmeans(rows, k, rounds, scale, seed):
    x = [(i, [math.floor(scale * c) for c in v]) for i, v in rows]
    at = [v for _, v in sorted((hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest(), v) for i, v in x)[:k]]
    far = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    nearest = lambda v: min((far(v, c), j) for j, c in enumerate(at))
    for _ in range(rounds):
        own = {}
        for _, v in x:
            own.setdefault(nearest(v)[1], []).append(v)
        at = [[sum(c) // len(own[j]) for c in zip(*own[j])] if j in own else at[j] for j in range(len(at))]
    found = [(i, *reversed(nearest(v))) for i, v in x]
    inertia = {}
    for _, j, d in found:
        inertia[j] = inertia.get(j, 0) + d
    return sorted(((i is None, i or 0), j, d, inertia[j], sum(inertia.values()), hashlib.sha256(",".join(map(str, at[j])).encode()).hexdigest()) for i, j, d in found)


def got(df):
    return sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["cluster"], r["distance"], r["cluster_inertia"], r["inertia"], r["centroid_sha256"]) for r in df.collect())


@pytest.mark.parametrize("k", [1, 5, 200])
def test_clusters_against_brute_force(spark, k):
    df, rows = odd_vectors(spark)
    assert got(cluster.clusters(df.repartition(3), k, 3, 4, 64, 1)) == plain_kmeans(sound(rows, 4), k, 3, 64, 1)


@pytest.mark.parametrize("size", [1e3, 1e7, 1e9, 1e18])
def test_clusters_beyond_the_bounds(spark, size):
    """Products, 64-bit integers, Python's: all three ways give exact results, rows of one batch by their own."""
    r = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=4) * (size if i % 3 else 1.0)]) for i in range(40)]
    want = [(a, j, *(x if x is not None and x < 2**63 else None for x in (d, s, t)), c) for a, j, d, s, t, c in plain_kmeans(rows, 4, 2, 64, 1)]
    assert got(cluster.clusters(spark.createDataFrame(rows, VECTORS), 4, 2, 4, 64, 1)) == want


def test_the_three_ways_agree():
    r = np.random.default_rng(5)
    at = r.integers(-100, 100, (6, 8)).tolist()
    own, x = cluster.Centroids(at), r.integers(-100, 100, (50, 8)).astype(float)
    ways = [f(x) for f in (own._product, own._long, own._any)]
    assert all((w[0] == ways[0][0]).all() and [int(d) for d in w[1]] == [int(d) for d in ways[0][1]] for w in ways)
    assert vectors.exact_sum(np.full((3, 1), 2.0**60)) == [3 * 2**60]


def test_clusters_of_an_empty_table(spark):
    assert cluster.clusters(spark.createDataFrame([], VECTORS)).collect() == []


@pytest.mark.parametrize("name", ["op11_gemm_clusters", "op12_warc_records"])
def test_query_matches_sql(spark, name):
    same(queries.queries()[name](spark, SF), queries.oracle_sql()[name])


# --- whitening ---------------------------------------------------------------------------------------------------


def plain_whitening(x, k):
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    e, v = np.linalg.eigh(c.T @ c / n)
    e, v = e[::-1], v[:, ::-1]
    return (n * x - s), e, c @ v[:, :k] / np.sqrt(e[:k])


def whitened_rows(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["component"], []).append(r)
    return out


def test_whitening_of_the_given_vectors(spark):
    df = table(spark, SF, "embeddings")
    rows = [(r["vec_id"], [math.floor(1024 * c) + 100000 for c in r["embedding"]]) for r in df.collect()]
    x = np.array([v for _, v in rows], np.int64)
    raised, e, w = plain_whitening(x, 8)
    place = {i: k for k, (i, _) in enumerate(rows)}
    found = whitened_rows(queries.queries()["op13_tsqr_whitening"](spark, SF))
    assert sorted(found) == list(range(1, 9))
    for c, own in found.items():
        assert len(own) == len(rows) and {r["n"] for r in own} == {len(rows)}
        at = [place[r["vec_id"]] for r in own]
        assert [r["deviation"] for r in own] == (raised**2).sum(axis=1)[at].tolist()
        mine, theirs = np.array([r["whitened"] for r in own]), w[at, c - 1]
        assert np.abs(mine - theirs * np.sign(mine @ theirs)).max() < 1e-8
        assert abs(own[0]["explained"] / (e[c - 1] / e.sum()) - 1) < 1e-9 and own[0]["identity_error"] < 1e-10


def test_whitening_of_odd_rows(spark):
    df, rows = odd_vectors(spark)
    good = sound(rows, 4)
    x = np.array([[math.floor(1024 * c) + 100000 for c in v] for _, v in good], np.int64)
    raised, e, w = plain_whitening(x, 4)
    found = whitened_rows(whiten.whitened(df.repartition(5), 8))
    assert sorted(found) == [1, 2, 3, 4]
    for c, own in found.items():
        assert sorted(((r["vec_id"] is None, r["vec_id"] or 0), r["deviation"]) for r in own) == sorted(((i is None, i or 0), d) for (i, _), d in zip(good, (raised**2).sum(axis=1).tolist()))
        assert np.allclose(sorted(abs(r["whitened"]) for r in own), sorted(np.abs(w[:, c - 1])), atol=1e-9)


def test_whitening_far_from_the_mean(spark):
    """Centred with exact sums: a mean that is 10^12 times the spread loses nothing."""
    r = np.random.default_rng(6)
    rows = [(i, [float(x) for x in r.integers(-5, 6, 3)]) for i in range(300)]
    near = whitened_rows(whiten.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3, 1, 0))
    far = whitened_rows(whiten.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 3, 1, 10**13))
    for c in near:
        a, b = ({r["vec_id"]: r["whitened"] for r in t[c]} for t in (near, far))
        assert max(abs(abs(a[i]) - abs(b[i])) for i in a) < 1e-9
        assert {r["vec_id"]: r["deviation"] for r in near[c]} == {r["vec_id"]: r["deviation"] for r in far[c]}


def test_whitening_where_nothing_varies(spark):
    flat = whiten.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 3.0])], VECTORS)).collect()
    assert {(r["vec_id"], r["component"], None if r["whitened"] is None else round(abs(r["whitened"]), 9)) for r in flat} == {(1, 1, 1.0), (2, 1, 1.0), (1, 2, None), (2, 2, None)}
    one = whiten.whitened(spark.createDataFrame([(1, [1.0, 2.0])], VECTORS)).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"]) for r in one} == {(None, None, None, 0)}
    assert whiten.whitened(spark.createDataFrame([], VECTORS)).collect() == []


# --- archives ----------------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string"
#: What looks like the start of a record, and one whole that leads on to where the next real one begins.
MAGIC = "WARC/1.1\r\n"
WHOLE = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
LEAD = "x\r\n\r\n" + MAGIC + "WARC-Type: response\r\nContent-Length: 0\r\n\r\n"


def odd_pages():
    copy, other = "<p>copy</p>" * 20, "y" * 100
    rows = [(i, f"http://h{i % 3}/{i}", f"<p>{i}</p>" * (i % 40)) for i in range(120)]
    rows += [(200, None, None), (201, "", ""), (None, "u", copy), (203, "u", copy), (202, "v", copy), (204, "w", copy), (204, "w", copy), (202, "v2", copy)]
    rows += [(300, "a\r\nb: c", WHOLE * 7), (301, "é", MAGIC * 50), (302, "z", LEAD), (303, "z", "q" * 500 + LEAD), (304, "l", "ß" * 300_000), (305, "l", MAGIC + "A: b\r\n" * 2000), (306, "m", other), (307, "m", other), (308, "m", other[1:]), (309, "m", other[1:])]
    return rows


def expected(rows, least=100):
    out = []
    pay = lambda h: (h or "").encode()
    for i, _, h in rows:
        p = pay(h)
        first = min((j for j, _, g in rows if pay(g) == p and j is not None), default=None) if len(p) >= least else None
        again = i is not None and first is not None and i > first
        out.append((i if i is not None else -1, len(p), hashlib.sha256(p).hexdigest(), "revisit" if again else "response", first if again else -1))
    return sorted(out)


def records(df):
    return sorted((r["page_id"] if r["page_id"] is not None else -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] if r["refers_to"] is not None else -1) for r in df.collect())


@pytest.mark.parametrize("range_bytes", [211, 700, 5000, 10**7])
def test_archives_of_odd_pages(spark, range_bytes):
    from pyspark.sql import functions as F

    rows = odd_pages() if range_bytes > 211 else [r for r in odd_pages() if r[0] is None or r[0] < 304]
    df = spark.createDataFrame(rows, PAGES).withColumns({c: F.lit(1) for c in CLASH}).repartition(2)
    manifest = warc.write(df, file_bytes=60_000, small=0 if range_bytes == 700 else 10**6)
    assert manifest.count() > 2 or range_bytes == 211
    found = warc.read(spark, manifest, range_bytes)
    assert records(found) == expected(rows)
    assert records(warc.read(spark, manifest, range_bytes, with_payload=False)) == expected(rows)
    texts = sorted((r["page_id"] or -1, r["url"] is None, r["url"] or "", bytes(r["payload"]).decode()) for r in warc.resolved(found).collect())
    assert texts == sorted((i or -1, u is None, (u or "").replace("\r", "%0D").replace("\n", "%0A"), h or "") for i, u, h in rows)


def test_false_candidates_are_seen_and_left_out(spark):
    """The chain decides: payloads hold candidates with successors of their own, one of them a real boundary."""
    rows = [(i, "u", WHOLE * 3 + "t" * i + LEAD) for i in range(30)]
    manifest = warc.write(spark.createDataFrame(rows, PAGES).coalesce(1), least=10**9)
    found = warc.pointers(manifest, 900).collect()
    real = {(r["path"], r["offset"]) for r in warc.read(spark, manifest, 900).collect()}
    assert len(found) == 30 * 5 and len(real) == 30 and real < {(r["path"], r["at"]) for r in found}
    assert {r["successor"] for r in found if (r["path"], r["at"]) not in real} & {o for _, o in real}


def test_broken_archives(spark):
    manifest = warc.write(spark.createDataFrame([(i, "u", "p" * 200) for i in range(50)], PAGES).coalesce(1), least=10**9)
    path = manifest.first()["path"].removeprefix("file:")
    path = path if not path.startswith("//") else "/" + path.lstrip("/")
    data = open(path, "rb").read()
    cut = fresh(spark, "cut").removeprefix("file:") + ".warc"
    with open(cut, "wb") as f:
        f.write(data[: len(data) // 2])
    short = spark.createDataFrame([(cut, os.path.getsize(cut))], "path string, bytes long")
    with pytest.raises(ValueError, match="no chain"):
        warc.read(spark, short, 1000)
    kept = warc.read(spark, short, 1000, strict=False).collect()
    assert 20 <= len(kept) < 50 and {bytes(r["payload"]) for r in kept} == {b"p" * 200}
    with open(cut, "wb") as f:
        f.write(data.replace(b"ppp", b"qpp", 1))
    with pytest.raises(Exception, match="not that of its digest"):
        warc.read(spark, short.selectExpr("path", f"{len(data)}L as bytes"), 1000).collect()


def test_heads_as_others_write_them(spark):
    """Other fields, folded lines, lower-case names, records of other types, the older version."""
    body = b"HTTP/1.1 200 OK\r\n\r\nhello"
    digest = hashlib.sha256(b"hello").hexdigest().encode()
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Length: 6\r\n\r\na: b\r\n\r\n\r\n"
    own = b"WARC/1.0\r\nwarc-type:response\r\nX-Note: one\r\n two\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Payload-Digest: sha256:" + digest + b"\r\ncontent-length : %d\r\n\r\n" % len(body) + body + b"\r\n\r\n"
    path = fresh(spark, "other").removeprefix("file:") + ".warc"
    with open(path, "wb") as f:
        f.write(info + own + own)
    found = warc.read(spark, spark.createDataFrame([(path, os.path.getsize(path))], "path string, bytes long"), 64).collect()
    assert [(r["page_id"], bytes(r["payload"]), r["record_type"]) for r in found] == [(None, b"hello", "response")] * 2


def test_archives_of_an_empty_table(spark):
    assert warc.read(spark, warc.write(spark.createDataFrame([], PAGES))).collect() == []
