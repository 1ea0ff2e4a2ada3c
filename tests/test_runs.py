"""Masks as runs against masks as arrays; sharpness as column expressions against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake.functions import geometry
from framelake.operators import raster, runs

W, H = 17, 13


def cases():
    r = np.random.default_rng(7)
    out = []
    for i in range(40):
        mask = r.random((H, W)) < r.choice([0.0, 0.05, 0.5, 1.0])
        quads = r.uniform(-6, 20, (r.integers(0, 4), 4, 2)).round(r.integers(0, 3))  # crossed, concave and outside ones among them
        out.append((i, mask.ravel().tolist(), [[list(map(float, p)) for p in q] for q in quads]))
    square = [[2.5, 3.5], [8.0, 3.5], [8.0, 9.0], [2.5, 9.0]]
    return [*out, (90, [False] * (W * H), [square]), (91, [None] * (W * H), [[[4.0, 4.0]] * 4]), (92, [False] * (W * H), [])]


def pixels(df):
    out = {}
    for r in df.collect():
        m = out.setdefault(r["i"], np.zeros((H, W), bool))
        assert 0 <= r["y"] < H and 0 <= r["lo"] <= r["hi"] < W and not m[r["y"], max(0, r["lo"] - 1) : r["hi"] + 2].any()  # as few as there are
        m[r["y"], r["lo"] : r["hi"] + 1] = True
    return out


@pytest.fixture(scope="module")
def masks(spark):
    return spark.createDataFrame(cases(), "i int, mask array<boolean>, quads array<array<array<double>>>").withColumn("lo", F.lit(1)).withColumn("y", F.lit(1))


def test_masks_and_polygons(masks):
    rows = {i: np.array([bool(x) for x in m]).reshape(H, W) for i, m, _ in cases()}
    got = pixels(runs.of_masks(masks, ["i"], "mask", W))
    assert all((got.get(i, np.zeros((H, W), bool)) == m).all() for i, m in rows.items())
    got = pixels(runs.united(runs.of_polygons(masks, ["i"], "quads", W, H), ["i"]))
    for i, _, quads in cases():
        want = np.zeros((H, W), bool)
        for q in quads:
            raster.polygon(want, np.array(q))
        assert (got.get(i, np.zeros((H, W), bool)) == want).all(), i


@pytest.mark.parametrize("radius", [0, 1, 2, 5])
def test_growth_and_areas(masks, radius):
    grown = runs.grown(runs.of_masks(masks, ["i"], "mask", W), ["i"], F.lit(radius), W, H)
    got, area = pixels(grown), {r["i"]: r["area"] for r in runs.areas(grown, ["i"]).collect()}
    for i, m, _ in cases():
        want = raster.dilated(np.array([bool(x) for x in m]).reshape(H, W), radius)
        assert (got.get(i, np.zeros((H, W), bool)) == want).all() and area.get(i, 0) == want.sum()


def test_finished_masks(masks):
    got = pixels(runs.finished(masks, ["i"], "mask", "quads", geometry.median_side(F.col("quads")), W, H))
    for i, m, quads in cases():
        want = raster.finished(np.array([bool(x) for x in m]).reshape(H, W), raster.Marks(quads)) > 0
        assert (got.get(i, np.zeros((H, W), bool)) == want).all(), i


def test_coverage_on_runs(masks):
    points = masks.select("i", F.explode(F.transform("quads", geometry.center)).alias("p")).select("i", "p.x", "p.y")
    got = {r["i"]: r["coverage"] for r in runs.coverage(runs.of_masks(masks, ["i"], "mask", W), points, ["i"], W, H).collect()}
    for i, m, quads in cases():
        if quads and i != 91:  # a marker without extent has no area to measure by
            assert abs(got.pop(i) - raster.Marks(quads).measured(np.array([bool(x) for x in m]).reshape(H, W))[1]) < 1e-12
    assert got == {91: 0.0}


@pytest.mark.parametrize("width", [1, 2, 3, 8])
def test_sharpness_of_any_raster(spark, width):
    r = np.random.default_rng(width)
    rows = [(i, [float(x) for x in r.normal(size=n)]) for i, n in enumerate([0, 1, 2, 3, 4, 6, 7, 8, 9, 12, 16, 24, 64])] + [(99, None)]
    got = {x["i"]: x["s"] for x in spark.createDataFrame(rows, "i int, v array<double>").select("i", raster.sharpness_of("v", width).alias("s")).collect()}
    for i, v in rows:
        want = raster.laplacian_variance(np.array(v).reshape(-1, width)) if v and len(v) % width == 0 else None
        assert (want is None) == (got[i] is None) and (want is None or abs(want - got[i]) < 1e-9)
