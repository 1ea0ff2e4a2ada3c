"""One session, one frame or one folder that holds everything: segments, grids, documents that are broken."""

import json
import math
import random
import re
from pathlib import Path

import pytest
from oracle import SF
from pyspark.sql import functions as F

from framelake.operators import flat, tracking
from framelake.plans import programs, workloads
from framelake.sources import files, storage

SIGNAL = "s long, k long, area double, cov double, marked boolean, a1 double, a2 double"


def signal(seed, sizes, quiet):
    r = random.Random(seed)
    rows = []
    for s, n in sizes:
        for k in range(n):
            off = r.random() < quiet
            some = lambda *x: None if off else r.choice([None, 0.0, *x])
            rows.append((s, k, some(10.0, 12.0, 50.0), r.choice([None, 0.2, 0.9]), r.random() < 0.7, some(11.0, 30.0), some(9.0)))
    r.shuffle(rows)
    return rows


def decided(df, split):
    return sorted((r["s"] is None, r["s"] or 0, r["k"], r["source"], r["reanchor"], r["track_reset"]) for r in tracking.decisions(df, "s", ["k"], split).collect())


@pytest.mark.parametrize(("sizes", "quiet"), [([(1, 900)], 0.05), ([(1, 3), (2, 400), (3, 1), (4, 2), (None, 300), (6, 50)], 0.1), ([(i, 2) for i in range(150)], 0.5), ([(1, 300)], 0.0), ([(1, 200)], 1.0), ([], 0.0)])
def test_segments_equal_the_plain_fold(spark, sizes, quiet):
    df = spark.createDataFrame(signal(len(sizes), sizes, quiet), SIGNAL).withColumn("first", F.lit(1))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert decided(df, True) == decided(df, False)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_one_session_is_many_tasks(spark):
    df = spark.createDataFrame(signal(9, [(1, 1000)], 0.05), SIGNAL)
    parts = tracking.segmented(df, "s", ["k"]).repartition(4, "s", "__segment").withColumn("at", F.spark_partition_id()).groupBy("__segment").agg(F.count("*").alias("n"), F.countDistinct("at").alias("p"), F.min("k").alias("lo"), F.max("k").alias("hi"), F.first("at").alias("at")).collect()
    assert len(parts) > 20 and all(r["p"] == 1 and r["hi"] - r["lo"] + 1 == r["n"] for r in parts) and len({r["at"] for r in parts}) == 4


def boxes_and_points(seed, frames, n):
    r = random.Random(seed)
    at = lambda: r.choice([r.uniform(-50, 50), float(r.randint(-5, 5)), 2.0**r.randint(-3, 6)])
    boxes, points = [], []
    for f in frames:
        for i in range(n):
            x, y, w, h = at(), at(), r.choice([0.0, 1e-9, 1.0, 2.0, 7.3, 300.0]), r.choice([0.0, 0.5, 4.0, 100.0])
            boxes.append((f, x, y, x + w, y + h, r.choice([0.1, 0.2, 0.2]), i))
            points.append((f, at(), at()))
        boxes += [boxes[-1][:6] + (n,), (f, None, 0.0, 1.0, 1.0, 0.9, n + 1), (f, float("nan"), 0.0, 1.0, 1.0, 0.9, n + 2), (f, -math.inf, -math.inf, math.inf, math.inf, 0.05, n + 3), (f, 3.0, 3.0, 2.0, 2.0, 0.9, n + 4)]
        points += [points[-1], (f, None, 1.0), (f, float("nan"), 0.0), (f, 1e200, -1e250), (f, boxes[0][1], boxes[0][2])]
    return boxes, points


BOXES, POINTS = "f long, x0 double, y0 double, x1 double, y1 double, score double, place long", "f long, x double, y double"


def test_grid_counts_against_brute_force(spark):
    boxes, points = boxes_and_points(1, [1, 2, None], 60)
    good = lambda v: v is not None and not math.isnan(v)
    want = {}
    for f, x0, y0, x1, y1, *_ in boxes:
        n = sum(g == f and good(x) and good(y) and x0 <= x <= x1 and y0 <= y <= y1 for g, x, y in points) if all(map(good, (x0, y0, x1, y1))) else 0
        if n:
            want[(f, x0, y0, x1, y1)] = n
    got = {(r["f"], r["x0"], r["y0"], r["x1"], r["y1"]): r["held"] for r in flat.held_counts(spark.createDataFrame(boxes, BOXES), spark.createDataFrame(points, POINTS), ["f"]).collect()}
    assert got == want and len(got) > 50


@pytest.mark.parametrize(("strip", "asked"), [(8, 7), (40, 1000)])
def test_boxes_over_many_strips(spark, monkeypatch, strip, asked):
    """Boxes within, along and across strips and bands, and places that repeat."""
    for k, v in (("STRIP", strip), ("ASKED", asked), ("TRIED", 2)):
        monkeypatch.setattr(flat, k, v)
    r = random.Random(strip)
    place = lambda: (r.choice([0.0, -0.0, 1.5, float(r.randint(-9, 9)), r.uniform(-9, 9), math.inf, -math.inf]), float(r.randint(0, 4)))
    points = [(r.choice([1, 1, 1, None, 2]), *place()) for _ in range(400)]
    boxes = []
    for i in range(300):
        (a, b), (c, d) = place(), place()
        boxes.append((r.choice([1, 1, 1, None, 2]), min(a, c), min(b, d), max(a, c), max(b, d), 0.5, i))
    got = {tuple(x)[:5]: x["held"] for x in flat.held_counts(spark.createDataFrame(boxes, BOXES), spark.createDataFrame(points, POINTS), ["f"]).collect()}
    want = {b[:5]: sum(p[0] == b[0] and b[1] <= p[1] <= b[3] and b[2] <= p[2] <= b[4] for p in points) for b in boxes}
    assert got == {b: n for b, n in want.items() if n}


def rows_made(spark, since):
    """The most rows that a step of the plans run since then gave."""
    store, most = spark._jsparkSession.sharedState().statusStore(), 0
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    for e in range(since, store.executionsCount()):
        at = store.executionsList().apply(e).executionId()
        nodes, values = store.planGraph(at).allNodes(), store.executionMetrics(at)
        for i in range(nodes.size()):
            metrics = nodes.apply(i).metrics()
            own = [metrics.apply(k) for k in range(metrics.size()) if metrics.apply(k).name() == "number of output rows"]
            most = max([most, *(int(values.apply(m.accumulatorId()).replace(",", "")) for m in own if values.contains(m.accumulatorId()))])
    return most


def test_crowded_frames_meet_no_pairs(spark):
    """n boxes that hold n points each: rows grow with n, not with its square."""
    n = 2000
    boxes, points = [(1, -float(i), 0.0, 1.0, 1.0, 0.5, i) for i in range(n)], [(1, i / n, 0.5) for i in range(n)]
    since = spark._jsparkSession.sharedState().statusStore().executionsCount()
    held = flat.held_counts(spark.createDataFrame(boxes, BOXES), spark.createDataFrame(points, POINTS), ["f"])
    assert held.agg(F.count("*"), F.min("held"), F.max("held")).first() == (n, n, n)
    assert n <= rows_made(spark, since) < 10 * n


def test_crowded_frames_have_the_same_best_boxes(spark):
    boxes, points = boxes_and_points(2, [1, 2], 30)
    clean = lambda rows: [r for r in rows if all(v is not None and not (isinstance(v, float) and math.isnan(v)) for v in r)]
    boxes, points = clean(boxes) + [(8, 0.0, 0.0, 1.0, 1.0, 0.4, 0), (8, 0.0, 0.0, 2.0, 1.0, 0.5, 1), (9, 0.0, 0.0, 1.0, 1.0, 0.4, 0)], clean(points) + [(9, 5.0, 5.0)]
    b, p = spark.createDataFrame(boxes, BOXES), spark.createDataFrame(points, POINTS)
    rows = lambda df: sorted((r["f"], *r["box"]) for r in df.collect())
    assert rows(flat.best_boxes_crowded(b, p, ["f"])) == rows(flat.best_boxes(b, p, ["f"]))
    assert [r[0] for r in rows(flat.best_boxes_crowded(b, p, ["f"]))] == [1, 2, 8]
    none = spark.createDataFrame([], BOXES)
    assert flat.best_boxes_crowded(none, p, ["f"]).count() == 0 and flat.held_counts(none, p, ["f"]).count() == 0
    assert flat.best_boxes_crowded(b, spark.createDataFrame([], POINTS), ["f"]).count() == 4


def test_crowded_frames_leave_their_counts_only(spark):
    """The tables between are gone from the shared folder, and a point that stands for several counts as many."""
    folders = lambda: {p for p in Path(storage.shared(spark)).iterdir() if p.name.startswith("crowd-")}
    old, (boxes, points) = folders(), boxes_and_points(4, [1, None], 20)
    b, p = spark.createDataFrame(boxes, BOXES), spark.createDataFrame(points, POINTS)
    rows = lambda df: sorted(map(repr, df.collect()))
    plain = flat.held_counts(b, p, ["f"])
    (new,) = folders() - old
    assert [c.name for c in new.iterdir()] == ["held"]
    assert rows(flat.held_counts(b, p.groupBy("f", "x", "y").agg(F.count("*").alias("n")), ["f"], "n")) == rows(plain)


def test_lines_of_a_crowded_frame_are_not_sent_where_counts_are_few(spark, monkeypatch):
    exchanges = lambda df: re.findall(r"Exchange hashpartitioning\((?!frame#\d+, )", df._jdf.queryExecution().executedPlan().toString())
    own = workloads.crowded_frame(spark, SF)
    assert not exchanges(own)
    monkeypatch.setattr(flat, "SENT", 0)
    sent = workloads.crowded_frame(spark, SF)
    assert exchanges(sent)
    assert sorted(own.collect()) == sorted(sent.collect()) and own.count() == spark.read.parquet(f"{SF}/lineitem.parquet").count()


def test_lines_are_not_sent_where_points_are_few_and_widths_differ(spark, monkeypatch, tmp_path):
    one = spark.read.parquet(f"{SF}/lineitem.parquet").limit(2000)
    one.union(one.withColumn("l_suppkey", F.col("l_suppkey") + 1).withColumn("l_orderkey", F.col("l_orderkey") + 100_000)).write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(flat, "SENT", 2000)
    own = workloads.crowded_frame(spark, str(tmp_path))
    assert not re.findall(r"Exchange hashpartitioning\((?!frame#\d+, )", own._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(flat, "SENT", 0)
    assert sorted(own.collect()) == sorted(workloads.crowded_frame(spark, str(tmp_path)).collect()) and own.count() == 4000


def test_points_of_large_strips_are_copied_seldom(spark, monkeypatch):
    """With strips that can't be more, what is counted together grows with their points."""
    for k, v in (("STRIP", 8), ("STRIPS", 2), ("ASKED", 1)):
        monkeypatch.setattr(flat, k, v)
    n, store = 400, spark._jsparkSession.sharedState().statusStore()
    ids = lambda: [store.executionsList().apply(i).executionId() for i in range(store.executionsList().size())]
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    last = max(ids(), default=-1)
    held = flat.held_counts(spark.createDataFrame([(1, -float(i), 0.0, 1.0, 1.0, 0.5, i) for i in range(n)], BOXES), spark.createDataFrame([(1, i / n, 0.5) for i in range(n)], POINTS), ["f"])
    assert held.agg(F.count("*"), F.min("held"), F.max("held")).first() == (n, n, n)
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    most = 0
    for at in (i for i in ids() if i > last):
        nodes, values = store.planGraph(at).allNodes(), store.executionMetrics(at)
        metrics = [nodes.apply(i).metrics().apply(k) for i in range(nodes.size()) for k in range(nodes.apply(i).metrics().size())]
        most = max([most, *(int(values.apply(m.accumulatorId()).replace(",", "")) for m in metrics if m.name() == "number of output rows" and values.contains(m.accumulatorId()))])
    assert n <= most < 10 * n


def test_best_boxes_in_as_many_tasks_as_rows_ask_for(spark, monkeypatch):
    """The tasks of the joins and of the query grow with the rows, and null frames keep their own points."""
    boxes, points = boxes_and_points(3, [1, None, 4], 20)
    b, p = spark.createDataFrame(boxes, BOXES).where("score is not null"), spark.createDataFrame(points, POINTS)
    rows = lambda df: sorted(map(repr, df.collect()))
    many = flat.best_boxes(b, p, ["f"], 11)
    assert many.rdd.getNumPartitions() == 11 and rows(many) == rows(flat.best_boxes(b, p, ["f"])) and many.where("f is null").count() == 1
    monkeypatch.setattr(flat, "ROWS", 500)
    assert workloads.point_in_box_top1(spark, SF).rdd.getNumPartitions() == 12  # of 6,000 lines


def test_faults_of_documents(spark):
    texts = {
        None: "no text", "": "broken JSON", "{": "broken JSON", '{"a": 1}, {"a": 2}': "broken JSON", '{"a": 1}], [2': "broken JSON", '{"a": 1}, "b": 2': "broken JSON", '1} {"a": 1': "broken JSON", '{"a": 1} x': "broken JSON", "[]": "not an object", "7": "not an object", "null": "not an object",
        "{}": "missing keys frame_index, timestamp_s, filename", '{"frame_index": 1, "filename": "f"}': "missing keys timestamp_s",
        '{"frame_index": {}, "timestamp_s": [], "filename": "f"}': "other types frame_index, timestamp_s",
        '{"frame_index": null, "timestamp_s": 0.5, "filename": "f", "more": {"x": 1}}': None, '{"frame_index": 3, "timestamp_s": 2, "filename": "f"}': None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("record", F.lit(1))
    got = {r["t"]: (r["fault"], r["record"]) for r in files.checked(df, "t", "FRAME").collect()}
    assert {t: f for t, (f, _) in got.items()} == texts
    assert all((r is None) == (f is not None) for f, r in got.values())
    assert got['{"frame_index": 3, "timestamp_s": 2, "filename": "f"}'][1].asDict() == {"frame_index": 3, "timestamp_s": 2.0, "filename": "f"}
    nested = '{"dictionary": "D", "total_frames": 1, "frames_with_detections": 0, "detections": [{"filename": "f", "frame_index": 1, "markers_detected": 1, "marker_ids": [4], "corners": [[[0.0, 1.0]]]}]}'
    row = files.checked(spark.createDataFrame([(nested,)], "t string"), "t", "DETECTIONS").first()
    assert row["fault"] is None and row["record"]["detections"][0]["corners"] == [[[0.0, 1.0]]]


def test_a_broken_document_does_not_stop_the_others(spark, tmp_path):
    out = tmp_path / "out"
    meta = {"source_video": "v", "fps": 25.0, "total_frames": 1, "resolution": {"width": 4, "height": 3}, "stride": 1, "frames_extracted": 1, "extracted_at": "t", "opencv_version": "n", "frames": [{"frame_index": 0, "timestamp_s": 0.0, "filename": "a.png"}]}
    from framelake.operators import raster

    words = raster.code_words(4, 5)
    for s, text in (("good", json.dumps(meta)), ("cut", json.dumps(meta)[:50]), ("short", json.dumps({k: v for k, v in meta.items() if k != "fps"}))):
        (out / s).mkdir(parents=True)
        (out / s / "metadata.json").write_text(text)
    (out / "good" / "a.jpg").write_bytes(raster.png(raster.with_margin(raster.marker(words[3], 60), 20)))
    with pytest.raises(Exception, match="metadata.json"):
        programs.detect(spark, str(out), words, "DICT_4X4_50")
    programs.detect(spark, str(out), words, "DICT_4X4_50", rejected=str(tmp_path / "rejected"))
    assert [p.parent.name for p in sorted(out.glob("*/detections.json"))] == ["good"]
    bad = {r["session_id"]: (r["fault"], r["path"].rsplit("/", 2)[1:]) for r in spark.read.parquet(str(tmp_path / "rejected")).collect()}
    assert bad == {"cut": ("broken JSON", ["cut", "metadata.json"]), "short": ("missing keys fps", ["short", "metadata.json"])}
