import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from framelake import schemas, settings
from framelake.functions import geometry, probe, records
from framelake.operators import documents, flat, quality, raster, selection, tracking
from framelake.plans import programs
from framelake.sources import files, sinks, storage, video


def one(spark, c):
    return spark.range(1).select(c.alias("x")).first()["x"]


def diamond(x, y, r):
    """A marker that stands on its tip."""
    return [[x, y - r], [x + r, y], [x, y + r], [x - r, y]]


#: Four markers of unlike size in a 90 x 70 image.
FOUR = [diamond(20.0, 15.0, 6.0), diamond(45.0, 22.0, 4.0), diamond(62.0, 40.0, 8.0), diamond(30.0, 50.0, 5.0)]


def lit(spark, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}")


def test_stride_rules(spark):
    f = spark.range(10).withColumnRenamed("id", "frame_index")
    assert [r[0] for r in selection.strided(f, 3).collect()] == [0, 3, 6, 9]
    assert selection.strided(f, -1).count() == 0
    with pytest.raises(ValueError):
        selection.strided(f, 0)
    empty = spark.createDataFrame([("s", 30.0, 0)], "session_id string, fps double, total_frames int")
    assert selection.sample_indices(empty, 1).count() == 0
    v = spark.createDataFrame([("s", 30.0, 100)], "session_id string, fps double, total_frames int")
    got = selection.sample_indices(v, 45).collect()
    assert [(r.frame_index, r.timestamp_s, r.filename) for r in got] == [(0, 0.0, "frame_000.jpg"), (45, 1.5, "frame_045.jpg"), (90, 3.0, "frame_090.jpg")]


MARKS = "array<struct<id:int,corners:array<array<double>>>>"


@pytest.mark.parametrize(("valid", "want"), [([0, 1, 2, 3, 4, 5], [0, 5]), ([], []), (None, [0, 99, 5])])
def test_whitelist_none_is_not_empty(spark, valid, want):
    d = lit(spark, [(0, [[0.0, 0.0]]), (99, [[1.0, 1.0]]), (5, [[2.0, 2.0]])], MARKS)
    got = d.select(records.whitelisted(F.col("v"), valid).alias("m")).first()["m"]
    assert [m["id"] for m in got] == want
    if want == [0, 5]:
        assert got[1]["corners"] == [[2.0, 2.0]]


def test_zip_truncates(spark):
    d = spark.createDataFrame([([1, 2, 3], [[[0.0]]])], "ids array<int>, c array<array<array<double>>>")
    assert len(d.select(records.zipped(F.col("ids"), F.col("c")).alias("z")).first()["z"]) == 1


def test_stored_count_decides_without_whitelist(spark):
    rows = spark.createDataFrame([("s", "a", 2, []), ("s", "b", 0, [])], f"session_id string, filename string, markers_detected int, markers {MARKS}")
    assert [r.filename for r in selection.select(rows, 1).collect()] == ["a"]
    assert selection.select(rows, 0, valid_ids=[]).count() == 2
    assert selection.select(rows, 1, valid_ids=[1]).count() == 0


def test_fence_rules(spark):
    s = spark.createDataFrame([("a", float(x)) for x in (10, 10, 10, 9, 10)] + [("b", 1.0), ("b", 9.0), ("c", 1.0), ("c", 50.0), ("c", 100.0), ("d", None)], "session_id string, score double")
    f = {r.session_id: r for r in quality.fence(s, ["session_id"]).collect()}
    assert f["a"].threshold == 10.0 and f["b"].threshold is None and f["b"].frames_scored == 2 and f["c"].threshold == 0.0 and "d" not in f
    assert [(r.session_id, r.score) for r in quality.rejects(s, quality.fence(s, ["session_id"]), ["session_id"]).collect()] == [("a", 9.0)]


def test_geometry(spark):
    """Flat plans and numpy give the same boxes and choices, and those of plain loops."""
    m = lit(spark, FOUR, "array<array<array<double>>>")
    side = float(np.median([np.hypot(6, 6), np.hypot(4, 4), np.hypot(8, 8), np.hypot(5, 5)]))
    xs, ys = [p[0] for q in FOUR for p in q], [p[1] for q in FOUR for p in q]
    want = [max(0, min(xs) - 2 * side), max(0, min(ys) - 2 * side), min(89, max(xs) + 2 * side), min(69, max(ys) + 2 * side)]
    assert m.select(geometry.median_side(F.col("v"))).first()[0] == pytest.approx(side)
    marks = raster.Marks(FOUR)
    assert marks.prompt((70, 90)).tolist() == pytest.approx(want) and raster.Marks(FOUR[:2]).prompt((70, 90)) is None
    cols = [c for xy in flat.CORNERS for c in xy]
    rows = spark.createDataFrame([(1, *[float(v) for p in q for v in p]) for q in FOUR] + [(2, *[float(v) for p in q for v in p]) for q in FOUR[:2]], ["k", *cols])
    got = flat.prompts(rows, ["k"], 90, 70).collect()
    assert [r.k for r in got] == [1] and list(got[0])[1:] == pytest.approx(want)
    boxes = [(0.0, 0.0, 50.0, 30.0, 0.4), (10.0, 10.0, 70.0, 45.0, 0.3), (10.0, 10.0, 70.0, 45.0, 0.3), (80.0, 60.0, 89.0, 69.0, 0.99)]
    pts = m.select(F.explode(geometry.centers(F.col("v"))).alias("p")).select(F.lit(1).alias("k"), "p.x", "p.y")
    for flat_points, np_marks, place in ((pts, marks, 1), (pts.where("false"), raster.Marks([]), 3), (spark.createDataFrame([(1, 85.0, 5.0)], "k int, x double, y double"), raster.Marks([diamond(85.0, 5.0, 2.0)]), None)):
        y = flat.best_boxes(spark.createDataFrame([(1, *v, i) for i, v in enumerate(boxes)], "k int, x0 double, y0 double, x1 double, y1 double, score double, place int"), flat_points, ["k"]).collect()
        z = np_marks.choose(np.array(boxes)[:, :4], np.array(boxes)[:, 4])
        assert (not y) == (z is None) == (place is None)
        if place is not None:
            assert y[0].box.place == place and z.tolist() == list(boxes[place][:4])
    nested = lit(spark, [[[[1, 2], [3, 4], [5, 6], [7, 8]]]], "array<array<array<array<int>>>>")
    assert nested.select(F.transform("v", geometry.four_points).alias("x")).first()["x"] == [[[1.0, 2.0], [3.0, 4.0], [5.0, 6.0], [7.0, 8.0]]]


def test_measures():
    mask = np.zeros((70, 90), bool)
    mask[10:30, 15:50] = True
    marks = raster.Marks(FOUR)
    area, covered = marks.measured(mask)
    assert covered == 0.5 and area == pytest.approx(700 / marks.side**2) and raster.Marks([]).measured(mask) == (700.0, 1.0)
    with pytest.raises(ZeroDivisionError):
        raster.Marks([[[3, 3]] * 4]).measured(mask)


@pytest.mark.parametrize("quad", [[[5, 5], [30, 8], [28, 30], [4, 25]], [[5, 5], [30, 30], [30, 5], [5, 30]], [[5, 5], [30, 5], [12, 12], [5, 30]], [[-9, 10], [50, 10], [50, 14], [-9, 14]], [[60, 60], [70, 60], [70, 70], [60, 70]]])
def test_polygons_against_crossing_counts(quad):
    got = np.zeros((40, 40), bool)
    raster.polygon(got, np.array(quad, float))
    for y in range(40):
        for x in range(40):
            crossings, near = 0, 9.0
            for (xa, ya), (xb, yb) in zip(quad, quad[1:] + quad[:1]):
                if (ya <= y) != (yb <= y) and x < xa + (y - ya) * (xb - xa) / (yb - ya):
                    crossings += 1
                t = np.clip(((x - xa) * (xb - xa) + (y - ya) * (yb - ya)) / max(1, (xb - xa) ** 2 + (yb - ya) ** 2), 0, 1)
                near = min(near, np.hypot(x - xa - t * (xb - xa), y - ya - t * (yb - ya)))
            if near > 0.8:  # pixels on an edge's line count as inside
                assert got[y, x] == (crossings % 2 == 1), (x, y)
            elif near < 0.1:
                assert got[y, x]


@pytest.mark.parametrize("exact", [40, 10**6])
def test_medians_of_groups_of_any_size(spark, exact):
    rng = np.random.default_rng(7)
    groups = {"a": rng.normal(size=3000), "b": rng.integers(0, 4, 2001).astype(float), "c": np.full(500, 2.5), "d": rng.exponential(size=7), "e": np.array([1.0]), "f": np.r_[np.zeros(400), rng.random(400)], None: rng.random(1000)}
    d = spark.createDataFrame([(k, float(v)) for k, vs in groups.items() for v in vs], "g string, v double")
    got = {r.g: (r.n, r.median) for r in quality.medians(d, ["g"], "v", exact).collect()}
    assert set(got) == set(groups) and all(got[k] == (len(v), pytest.approx(np.median(v), abs=0)) for k, v in groups.items())
    f = {r.g: r for r in quality.fence(d, ["g"], "v", exact).collect()}
    for k, v in groups.items():
        if len(v) >= 3:
            mad = np.median(np.abs(v - np.median(v)))
            assert f[k].mad == pytest.approx(mad, abs=1e-15) and f[k].threshold == pytest.approx(max(np.median(v) - 3 * 1.4826 * mad, 0))
    assert quality.medians(d.where("false"), ["g"], "v", exact).count() == 0


@pytest.mark.parametrize("values", [[-1e308] * 40 + [1e308] * 41, [float("-inf")] * 30 + [0.0] * 5 + [5e-324] * 6 + [float("inf")] * 30, [1.0 + i * 2**-52 for i in range(301)], [-3.0, *[-0.0, 0.0] * 50, 4.0], [float("inf")] * 50 + [1.0, 2.0], [1.0 + i / 1e6 for i in range(300)] + [1e9] * 299])
def test_medians_of_far_and_near_values(spark, values):
    d = spark.createDataFrame([(v,) for v in values], "v double").withColumn("g", F.lit(1))
    assert quality.medians(d, ["g"], "v", 10).select("n", "median").first() == (len(values), pytest.approx(float(np.median(values)), abs=0))


def test_passes_over_the_rows_of_a_fence(spark):
    """Each pass is made once: rows are read for two medians of two passes and a few more, not again for each step."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    n = 5000
    d = spark.range(n).selectExpr("0 as g", "1 + id / 1000.0D as v").mapInArrow(run, "g int, v double")
    f = quality.fence(d, ["g"], "v", 1000)
    assert quality.rejects(d, f, ["g"], "v").count() == 0
    assert f.first()["median"] == pytest.approx(1 + (n - 1) / 2000)
    assert seen.value <= 8 * n


TAG, KEY = b"FocalLengthIn35mmFilm", probe.APPLE.encode()


@pytest.mark.parametrize(("payload", "want"), [
    (TAG + b"='77'", 77.0),
    (TAG.upper() + b": 105/3;", 35.0),
    (TAG + b"=31/0 " + TAG + b"=44", 44.0),
    (TAG + b"=5 " + TAG + b"=200", 200.0),
    (TAG + b"=201", None),
    (KEY + b"....33.25", 33.25),
    (KEY.upper() + b"....33.25", None),
    (KEY + bytes(64) + b"33", None),
    (TAG + b"=9 " + KEY + b" 10", 10.0),
    (b"", None),
])
def test_focal(spark, payload, want):
    d = spark.createDataFrame([(bytearray(bytes(64) + payload + bytes(64)),)], "v binary")
    assert d.select(probe.focal_35mm(probe.as_text(probe.edges(F.col("v"))))).first()[0] == want


def test_records_round_trip_and_missing_keys(spark):
    raw = '{"dictionary":"D","min_markers":1,"total_frames_input":1,"frames_filtered_out":0,"frames":["a"],"marker_detections":{"a":[{"id":3,"corners":[[0,0]]}]},"camera":{"focal_length_35mm":null,"width_px":1,"height_px":2},"extra":1}'
    d = lit(spark, raw, "string").select(records.decoded(F.col("v"), "SELECTION").alias("r"))
    text = d.select(records.encoded(F.col("r"), "SELECTION")).first()[0]
    back = json.loads(text)
    assert back["camera"] == {"focal_length_35mm": None, "width_px": 1, "height_px": 2} and "sharpness" not in back and "extra" not in back and back["marker_detections"]["a"][0]["id"] == 3
    with pytest.raises(Exception, match="missing keys .*fps"):
        lit(spark, '{"stride": null}', "string").select(records.decoded(F.col("v"), "VIDEO").alias("r")).collect()
    assert "focal_length_35mm" not in schemas.required("VIDEO")


def test_settings(tmp_path):
    p = tmp_path / "s.yaml"
    p.write_text("dictionary: X\nframe_extraction: {stride: 5, other: 1}\nframe_filtering: 7\nmarkers: {dpi: null}\nunknown: {a: 1}\n")
    s = settings.load(str(p))
    assert (s.dictionary, s.frame_extraction.stride, s.frame_filtering.min_markers, s.markers.dpi, s.markers.dictionary) == ("X", 5, 1, None, "DICT_4X4_50")
    assert settings.load(str(tmp_path / "none")) == settings.Settings()
    assert settings.first_given(None, 0, 3) == 0
    with pytest.raises(ValueError):
        settings.dictionary_code("DICT_9")
    with pytest.raises(ValueError):
        settings.check_video("a.txt")
    settings.check_video("A.MOV")


def test_last_wins(spark):
    r = spark.createDataFrame([("s", "a", 0, "x"), ("s", "a", 1, "y"), ("s", "b", 2, "z")], "session_id string, filename string, frame_index int, m string")
    assert documents.last_wins(r, ["session_id"], "filename", "m", "frame_index").first()["entries"] == {"a": "y", "b": "z"}


class Lists(tracking.BoxTracker):
    """Answers from lists: what the detector sees in each frame, and of each segment whether it comes out empty."""

    def __init__(self, seen, empty=""):
        super().__init__()
        self.log, self.seen, self.empty = "", list(seen), empty

    def detect(self, rgb):
        self.log += "D"
        box = self.seen.pop(0)
        return (np.array([box], float), np.ones(1)) if box else (np.zeros((0, 4)), np.zeros(0))

    def _mask(self, box):
        self.log += "m"
        return super()._mask(box) & (self.empty[self.log.count("m") - 1 : self.log.count("m")] != "x")


WIDE = [10, 8, 75, 60]


@pytest.mark.parametrize(("seen", "empty", "marks", "log", "sources", "events"), [
    # found at once, then followed without asking the detector again
    ([WIDE], "", [4, 4, 0, 4], "Dmmmm", "dino tracked tracked tracked", (0, 0)),
    # the second frame's track is empty: corrected by the detector's box
    ([WIDE, WIDE], ".x..", [4, 4, 4], "DmmDmm", "dino dino tracked", (1, 0)),
    # corrected by the markers' box, as the detector sees nothing
    ([WIDE, None], ".x..", [4, 4], "DmmDm", "dino aruco_box", (1, 0)),
    # nothing helps: the whole image, and the search begins anew
    ([WIDE, WIDE, WIDE], ".xxx.", [4, 4, 0], "DmmDmmDm", "dino fallback_full dino", (0, 1)),
    # two markers make no box, and the detector's box holds none of them
    ([[80, 60, 89, 69], None], "", [2, 0], "DD", "fallback_full fallback_full", (0, 0)),
    # the area jumps from one frame to the next: the track is no longer trusted
    ([WIDE, [12, 9, 70, 55]], "", [4, 4], "DmmDm", "dino dino", (1, 0)),
])
def test_sessions(seen, empty, marks, log, sources, events):
    tracker = Lists(seen, empty)
    session = tracking.Session(tracker)
    got = []
    for i, n in enumerate(marks):
        if log == "DmmDm" and sources == "dino dino" and i:
            tracker.box = np.array([44, 21, 46, 23])  # the model has lost most of it
        got.append(session.frame(np.zeros((70, 90, 3), np.uint8), [np.array(c) for c in FOUR[:n]])[1])
    assert tracker.log == log and " ".join(got) == sources
    stats = session.stats()
    assert (stats["reanchors"], stats["track_resets"]) == events and sum(stats[f"frames_{s}"] for s in tracking.SOURCES) == len(marks) and stats["device"] == "cpu"


def test_state_keeps_and_drops_its_reference():
    s = tracking.State()
    assert s.row(5.0, 1.0, True, None, 40.0) == (2, False, False) and s.ref == 40.0
    assert s.row(21.0, 0.5, True, None, None) == (0, False, False) and s.ref == 21.0
    assert s.row(900.0, 0.0, False, None, None) == (0, False, False) and s.ref == 21.0
    assert s.row(43.0, 1.0, True, 42.0, None) == (1, True, False) and s.ref == 42.0
    assert s.row(42.0, 0.49, True, 0.0, 20.9) == (3, False, True) and (s.on, s.ref) == (False, None)
    with pytest.raises(RuntimeError):
        tracking.BoxTracker().step(np.zeros((2, 2, 3)))
    with pytest.raises(RuntimeError):
        tracking.BoxTracker().correct(np.zeros(4))


def test_rasters():
    rng = np.random.default_rng(1)
    g = rng.integers(0, 255, (40, 50)).astype(np.uint8)
    p = np.pad(g.astype(float), 1, mode="reflect")
    want = np.var([[p[y, x + 1] + p[y + 2, x + 1] + p[y + 1, x] + p[y + 1, x + 2] - 4 * p[y + 1, x + 1] for x in range(50)] for y in range(40)])
    assert raster.laplacian_variance(g) == pytest.approx(want)
    m = np.zeros((40, 50), bool)
    m[20, 25] = True
    d = raster.dilated(m, 3)
    y, x = np.nonzero(d)
    assert d[20, 22:29].all() and d[17:24, 25].all() and ((y - 20) ** 2 + (x - 25) ** 2 <= 3.6**2).all()
    marks = raster.Marks(FOUR)
    f, grow = raster.finished(np.zeros((70, 90), bool), marks), int(np.rint(0.25 * marks.side))
    assert grow == 2 and f[40, 62] == 255 and f[40, 62 + 8 + grow] == 255 and f[40, 62 + 8 + grow + 1] == 0
    assert (raster.finished(m, raster.Marks([])) == m * 255).all()


def test_words_from_a_table(tmp_path):
    words = raster.code_words(4, 3)
    (tmp_path / "t.txt").write_text("\n".join(" ".join(map(str, w.ravel())) for w in words))
    assert (raster.words_from(str(tmp_path / "t.txt")) == words).all()
    (tmp_path / "t.txt").write_text("101")
    with pytest.raises(ValueError):
        raster.words_from(str(tmp_path / "t.txt"))


def test_markers_are_found_again():
    words = raster.code_words(4, 20)
    for i in (0, 7, 19):
        g = raster.with_margin(raster.marker(words[i], 200), 40)
        ids, corners = raster.detect(g, words)
        assert ids == [i] and np.allclose(corners[0], [[40, 40], [239, 40], [239, 239], [40, 239]], atol=1.5)
        ids, corners = raster.detect(np.rot90(g), words)
        assert ids == [i] and np.allclose(corners[0][0], [40, 239], atol=1.5)
    assert raster.detect(np.zeros((200, 200), np.uint8), words) == ([], [])


def test_markers_in_uneven_light():
    words = raster.code_words(4, 20)
    g = np.full((200, 420), 255, np.uint8)
    for k, i in enumerate((4, 11, 17)):
        g[50:150, 30 + 130 * k : 130 + 130 * k] = raster.marker(words[i], 100)
    light = np.linspace(0.2, 1, 420)
    shaded = np.rint((0.25 + 0.75 * (g / 255)) * 255 * light).astype(np.uint8)
    # the left marker's white is darker than the middle of the image's range
    assert shaded[:, :130].max() < (int(shaded.max()) + int(shaded.min())) / 2
    ids, corners = raster.detect(shaded, words)
    assert ids == [4, 11, 17]
    for k, c in enumerate(corners):
        x = 30 + 130 * k
        assert np.allclose(c, [[x, 50], [x + 99, 50], [x + 99, 149], [x, 149]], atol=2)
    twice = np.concatenate([shaded[:, :150], shaded[:, :150]], axis=1)
    assert raster.detect(twice, words)[0] == [4, 4]  # one word in two places


def test_regions_against_a_flood():
    rng = np.random.default_rng(5)
    for share in (0.45, 0.6, 0.7):
        dark = rng.random((40, 60)) < share
        left, want = {tuple(p) for p in np.argwhere(dark)}, []
        while left:
            todo, own = [left.pop()], []
            while todo:
                y, x = todo.pop()
                own.append((x, y))
                near = {(y + 1, x), (y - 1, x), (y, x + 1), (y, x - 1)} & left
                left -= near
                todo += near
            x0, y0 = np.min(own, axis=0)
            x1, y1 = np.max(own, axis=0)
            if x1 - x0 >= 3 and y1 - y0 >= 3 and x0 > 0 and y0 > 0 and x1 < 59 and y1 < 39:
                want.append((x0, y0, x1, y1))
        got = [(*e.min(axis=0), *e.max(axis=0)) for e in raster._regions(dark, 3)]
        assert sorted(got) == sorted(want)
    assert list(raster._regions(np.zeros((5, 5), bool), 1)) == []


def test_files_through_spark(spark, tmp_path):
    words = raster.code_words(4, 5)
    shots = tmp_path / "shots" / "s1"
    shots.mkdir(parents=True)
    (shots / "a.png").write_bytes(raster.png(raster.with_margin(raster.marker(words[3], 200), 40)))
    (shots / "b.png").write_bytes(raster.png(np.zeros((60, 60, 3), np.uint8)))
    (shots / "c.png").write_bytes(b"img")
    found = files.images(spark, str(shots))
    got = {r.filename: [m["id"] for m in r.markers] for r in raster.detections(found, words).collect()}
    assert got == {"a.png": [3], "b.png": [], "c.png": []}
    sharp = {r.filename: r.s for r in found.select("filename", raster.sharpness().alias("s")).collect()}
    assert sharp["a.png"] > 0 and sharp["b.png"] == 0 and sharp["c.png"] is None
    assert sorted(r.filename for r in files.listing(spark, str(shots)).collect()) == ["a.png", "b.png", "c.png"]
    frames = found.select("session_id", F.lit(0).alias("frame_index"), "filename", "image.height", "image.width", F.when(F.col("image.height") > 0, F.col("image.data")).alias("data"), F.array().cast("array<array<array<double>>>").alias("corners")).where("filename = 'b.png'")
    m = tracking.masks(frames)
    sinks.mask_files(m, str(tmp_path / "out"))
    assert os.listdir(tmp_path / "out" / "s1" / "filtered" / "masks") == ["b.png.png"]
    sinks.marker_files(raster.marker_images(spark, words, 60, 10), str(tmp_path / "sheet"))
    assert len([f for f in os.listdir(tmp_path / "sheet") if f.endswith(".png")]) == 5
    sinks.sheet_pdf([raster.marker(w, 60) for w in words], list("01234"), [(0, 15 + 30 * i, 15) for i in range(5)], 20, (210, 297), str(tmp_path / "s.pdf"))
    assert (tmp_path / "s.pdf").read_bytes().startswith(b"%PDF")


def test_video_source(spark, tmp_path):
    p = str(tmp_path / "clip.avi")
    jpegs = [b"\xff\xd8" + bytes([i]) * (i + 1) + b"\xff\xd9" for i in range(10)]
    jpegs[4] = b"broken"
    video.write_avi(p, jpegs, 30, 64, 48)
    rows = video.frames(spark, p, 2).orderBy("frame_index").collect()
    assert [r.frame_index for r in rows] == [0, 2, 6, 8] and bytes(rows[1].jpeg) == jpegs[2]
    h = video.headers(spark, p).first()
    assert (h.session_id, h.fps, h.total_frames, h.width, h.height, h.focal_length_35mm) == ("clip", 30.0, 10, 64, 48, None)
    sinks.jpeg_frames(video.frames(spark, p), str(tmp_path / "out"))
    assert sorted(os.listdir(tmp_path / "out" / "clip"))[:2] == ["frame_00.jpg", "frame_01.jpg"]
    with pytest.raises(Exception):
        video.frames(spark, str(tmp_path / "none.avi")).collect()


@pytest.mark.parametrize("with_index", [True, False])
def test_frames_by_index_and_by_heads(tmp_path, with_index):
    p = str(tmp_path / "clip.avi")
    shots = [b"\xff\xd8" + bytes(i) + b"\xff\xd9" for i in (3, 0, 8, 1)]
    video.write_avi(p, shots, 25, 4, 4, with_index)
    raw = (tmp_path / "clip.avi").read_bytes()
    assert (b"idx1" in raw) == with_index
    assert [raw[a : a + n] for a, n in video.header(p).frames] == shots
    with storage.opened(p) as f:
        assert (video.indexed(f, raw.index(b"movi"), int.from_bytes(raw[raw.index(b"movi") - 4 : raw.index(b"movi")], "little")) is not None) == with_index
    if with_index:  # offsets from the file's start, and an index that is wrong
        at, base = raw.index(b"idx1") + 8, raw.index(b"movi")
        for shift in (base, 1):
            moved = bytearray(raw)
            for k in range(len(shots)):
                i = at + 16 * k + 8
                moved[i : i + 4] = (int.from_bytes(raw[i : i + 4], "little") + shift).to_bytes(4, "little")
            (tmp_path / "clip.avi").write_bytes(bytes(moved))
            assert [raw[a : a + n] for a, n in video.header(p).frames] == shots


@pytest.mark.parametrize("root", ["{tmp}", "file://{tmp}", "file:{tmp}", "mock://box"])
def test_storage(tmp_path, root):
    root = root.format(tmp=tmp_path)
    for name in ("a/x.avi", "a/y.avi", "a/z.txt", "b/x.avi", "a/deep/x.avi"):
        storage.replaced(storage.joined(root, name), name.encode())
    storage.replaced(storage.joined(root, "a/x.avi"), b"new")
    with storage.opened(storage.joined(root, "a/x.avi")) as f:
        assert f.read() == b"new" and f.size() == 3 and f.seek(1) == 1 and f.read(1) == b"e"
    ends = lambda pattern: [p.rpartition("/")[0][-1:] + p[-6:] for p in storage.listed(storage.joined(root, pattern))]
    assert ends("a/*.avi") == ["a/x.avi", "a/y.avi"] and ends("*/x.avi") == ["a/x.avi", "b/x.avi"] and ends("c/*") == [] and ends("a/x.avi") == ["a/x.avi"] and ends("none") == []
    assert all(storage.exists(p) for p in storage.listed(storage.joined(root, "*/[xz].*")))
    assert storage.is_folder(storage.joined(root, "a")) and not storage.exists(storage.joined(root, "a"))
    assert storage.copied(storage.joined(root, "a/y.avi"), storage.joined(root, "c/d/y.avi")) and not storage.copied(storage.joined(root, "none"), storage.joined(root, "c/n"))
    assert storage.exists(storage.joined(root, "c/d/y.avi")) and storage.local(root) == (not root.startswith("mock"))


def jpeg(spark, gray):
    """JPEG bytes of a gray image, by the JVM's encoder."""
    jvm, (h, w) = spark._jvm, gray.shape
    image = jvm.java.awt.image.BufferedImage(w, h, 10)
    px = spark.sparkContext._gateway.new_array(jvm.int, h * w)
    for i, v in enumerate(gray.ravel().tolist()):
        px[i] = v
    image.getRaster().setPixels(0, 0, w, h, px)
    out = jvm.java.io.ByteArrayOutputStream()
    jvm.javax.imageio.ImageIO.write(image, "jpg", out)
    return bytes(out.toByteArray())


def test_programs_from_video_to_masks(spark, tmp_path):
    """extract, detect, choose, mask and sheet, each from the files of the one before."""
    words = raster.code_words(4, 30)

    def shot(ids, grain):
        g = np.full((60, 150), 255, np.uint8)
        for k, i in enumerate(ids):
            g[10:46, 6 + 48 * k : 42 + 48 * k] = raster.marker(words[i], 36)
        return g if grain else np.full((60, 150), 90, np.uint8)

    frames = [shot([3, 7, 9], 1), shot([], 1), shot([3, 7, 9], 1), shot([], 1), shot([3, 20], 1), shot([], 1), shot([], 0)]
    clip, out = str(tmp_path / "walk.avi"), str(tmp_path / "out")
    video.write_avi(clip, [jpeg(spark, g) for g in frames], 10, 150, 60)
    with open(clip, "ab") as f:
        f.write(b"FocalLengthIn35mmFilm=28")
    rows = programs.extract(spark, clip, out, stride=2)
    assert sorted(r.filename for r in rows.collect()) == [f"frame_{i}.jpg" for i in (0, 2, 4, 6)]
    meta = json.loads(open(f"{out}/walk/metadata.json").read())
    assert (meta["total_frames"], meta["frames_extracted"], meta["stride"], meta["resolution"], meta["focal_length_35mm"]) == (7, 4, 2, {"width": 150, "height": 60}, 28.0)
    assert meta["frames"][1] == {"frame_index": 2, "timestamp_s": 0.2, "filename": "frame_2.jpg"} and open(f"{out}/walk/metadata.json").read().startswith('{\n  "')
    programs.detect(spark, out, words)
    found = json.loads(open(f"{out}/walk/detections.json").read())
    assert (found["dictionary"], found["total_frames"], found["frames_with_detections"]) == ("DICT_4X4_250", 4, 3)
    assert [d["marker_ids"] for d in found["detections"]] == [[3, 7, 9], [3, 7, 9], [3, 20], []]
    programs.choose(spark, out, min_markers=2, valid_ids=[3, 7, 9])
    made = json.loads(open(f"{out}/walk/manifest.json").read())
    assert made["frames"] == ["frame_0.jpg", "frame_2.jpg"] and made["frames_filtered_out"] == 2 and "mask_dir" not in made
    assert made["sharpness"]["frames_scored"] == 4 and made["camera"] == {"focal_length_35mm": 28.0, "width_px": 150, "height_px": 60}
    assert sorted(os.listdir(f"{out}/walk/filtered")) == ["frame_0.jpg", "frame_2.jpg"]
    stats = programs.mask(spark, out).collect()[0]
    made = json.loads(open(f"{out}/walk/manifest.json").read())
    assert made["mask_dir"] == "masks" and made["mask_generation"]["frames_tracked"] + made["mask_generation"]["frames_dino"] + made["mask_generation"]["frames_aruco_box"] + made["mask_generation"]["frames_fallback_full"] == 2
    assert made["mask_generation"]["detector_model"] == stats["detector_model"] == "bright" and made["frames"] == ["frame_0.jpg", "frame_2.jpg"]
    assert sorted(os.listdir(f"{out}/walk/filtered/masks")) == ["frame_0.jpg.png", "frame_2.jpg.png"]
    programs.sheet(spark, str(tmp_path / "sheet"), words, num_markers=8, side_pixels=60, margin_pixels=10, dpi=100)
    sheet = json.loads(open(tmp_path / "sheet" / "manifest.json").read())
    assert (sheet["ids"], sheet["total_image_side_pixels"], sheet["total_image_side_mm"], sheet["dictionary"]) == (list(range(8)), 80, 20.32, "DICT_4X4_50") and sheet["generated_at"].endswith("+00:00")
    assert len([f for f in os.listdir(tmp_path / "sheet") if f.endswith(".png")]) == 8 and (tmp_path / "sheet" / "sheet.pdf").read_bytes().count(b"/Subtype /Image") == 8


@pytest.mark.parametrize(("name", "doc"), [
    ("FRAME", {"frame_index": 1, "timestamp_s": 0.5, "filename": "f"}),
    ("VIDEO", {"source_video": "v", "fps": 25.0, "total_frames": 9, "resolution": {"width": 4, "height": 3}, "stride": 2, "frames_extracted": 1, "extracted_at": "t", "opencv_version": "n", "frames": [{"frame_index": 0, "timestamp_s": 0.0, "filename": "a"}]}),
    ("DETECTION", {"filename": "f", "frame_index": 1, "markers_detected": 1, "marker_ids": [4], "corners": [[[0.0, 1.0], [2.0, 3.0]]]}),
    ("DETECTIONS", {"dictionary": "D", "total_frames": 1, "frames_with_detections": 0, "detections": []}),
    ("MARKER", {"id": 3, "corners": [[0.0, 0.5]]}),
    ("SHEET", {"dictionary": "D", "num_markers": 1, "ids": [0], "side_pixels": 5, "margin_pixels": 1, "total_image_side_pixels": 7, "dpi": 300, "total_image_side_mm": 0.593, "generated_at": "t"}),
])
def test_every_record_comes_back(spark, tmp_path, name, doc):
    (tmp_path / "s9").mkdir()
    (tmp_path / "s9" / "x.json").write_text(json.dumps(doc | {"unknown": 1}))
    d = files.documents(spark, f"{tmp_path}/*/x.json", name)
    assert json.loads(d.select(records.encoded(F.col("record"), name)).first()[0]) == doc and d.first().session_id == "s9"
    gone = next(iter(schemas.required(name)))
    (tmp_path / "s9" / "x.json").write_text(json.dumps({k: v for k, v in doc.items() if k != gone}))
    with pytest.raises(Exception, match=f"missing keys {gone}"):
        files.documents(spark, f"{tmp_path}/*/x.json", name).collect()
    (tmp_path / "s9" / "x.json").write_text("{broken")
    with pytest.raises(Exception):
        files.documents(spark, f"{tmp_path}/*/x.json", name).collect()
    with pytest.raises(Exception):
        files.documents(spark, f"{tmp_path}/*/none.json", name).collect()


def test_large_files_are_probed_at_both_ends(tmp_path, monkeypatch):
    monkeypatch.setattr(probe, "EDGE", 10)
    p = tmp_path / "v"
    for n in (5, 20, 21, 100):
        p.write_bytes(bytes(range(n)))
        assert video.edges(str(p)) == (bytes(range(n)) if n <= 20 else bytes(range(10)) + bytes(range(n - 10, n)))


def test_progress_and_names(spark, caplog):
    rows, seen = sinks.counted(spark.range(7), "seven")
    assert rows.count() == 7 and seen.get["rows"] == 7
    assert settings.device("auto", True) == "cuda" and settings.device("auto") == "cpu" and settings.session_name("/a/b.c.mp4", "1") == "b.c_1"
    with pytest.raises(ValueError):
        settings.device("tpu")
    with pytest.raises(RuntimeError):
        settings.device("cuda", False)
    d = spark.createDataFrame([("/x/A.MoV", 0.41, 0.31), ("/x/b.txt", 0.4, 0.9)], "p string, s double, t double")
    assert [tuple(r) for r in d.select(settings.is_video(F.col("p")), settings.strong_enough(F.col("s"), F.col("t")), settings.session_column(F.col("p"), F.lit("2024-01-02 03:04:05").cast("timestamp"))).collect()] == [(True, True, "A_20240102_030405"), (False, False, "b_20240102_030405")]
