"""Jobs of committed files, and the video source's index, filters and stream."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from framelake.plans import workloads
from framelake.sources import committed, files, sinks, storage, video


def visible(folder):
    """The files that a reader sees, with their bytes."""
    own = (p for p in glob.glob(f"{folder}/**", recursive=True) if os.path.isfile(p))
    return {os.path.relpath(p, folder): open(p, "rb").read() for p in own if not os.path.relpath(p, folder).startswith("_")}


def rows_of(spark, n=300):
    return spark.range(n, numPartitions=4).select(F.concat(F.lit("d"), (F.col("id") % 3).cast("string"), F.lit("/"), F.col("id").cast("string")).alias("name"), F.encode(F.col("id").cast("string"), "UTF-8").alias("data"), (F.col("id") == 260).alias("bad"))


def test_a_failed_job_leaves_nothing_and_the_next_one_all(spark, tmp_path):
    at, flag = str(tmp_path / "out"), str(tmp_path / "flag")
    rows = workloads.failing_once(rows_of(spark), "bad", flag, 8)
    with pytest.raises(Exception, match="this attempt fails"):
        committed.write(rows, at)
    assert visible(at) == {} and committed.jobs(at) == {} and not glob.glob(f"{at}/_jobs/*")
    os.remove(flag)
    job = committed.write(rows, at, tries=2)
    assert visible(at) == {f"d{i % 3}/{i}": str(i).encode() for i in range(300)}
    assert committed.jobs(at) == {job: True} and committed.figures(at, job)["files"] == 300 and len(committed.figures(at, job)["attempts"]) <= 4
    listed = {r["name"]: r["bytes"] for r in committed.manifest(spark, at, job).collect()}
    assert listed == {k: len(v) for k, v in visible(at).items()} and not os.path.exists(f"{at}/_jobs/{job}/attempts")


def test_a_job_that_stopped_after_its_commit_is_finished_later(spark, tmp_path, monkeypatch):
    at = str(tmp_path / "out")
    with monkeypatch.context() as m:
        m.setattr(committed, "publish", lambda *_: None)  # the driver is lost here
        job = committed.write(rows_of(spark), at)
    assert visible(at) == {} and committed.jobs(at) == {job: False}
    # some of the moves had been made
    first = committed.manifest(spark, at, job).first()
    storage.moved(first["staged"], f"{at}/{first['name']}", first["bytes"])
    assert committed.recover(spark, at) == [job] and committed.recover(spark, at) == []
    assert len(visible(at)) == 300
    committed.publish(spark, at, job)  # once more does no harm
    assert len(visible(at)) == 300


def test_names(spark, tmp_path):
    at = str(tmp_path / "out")
    make = lambda names: spark.createDataFrame([(n, b"x") for n in names], "name string, data binary")
    with pytest.raises(ValueError, match="names given twice: a"):
        committed.write(make(["a", "b", "a"]), at)
    assert visible(at) == {} and committed.jobs(at) == {}
    for bad in (None, "../x", "/x", "_x"):
        with pytest.raises(Exception, match="not a name"):
            committed.write(make(["fine", bad]), at)
    assert visible(at) == {}
    committed.write(make(["a", "b"]), at)
    committed.write(make(["a"]).withColumn("data", F.lit(b"new")).withColumn("source", F.lit("unused")).withColumn("other", F.lit(1)), at)
    committed.write(make([]), at)
    assert visible(at) == {"a": b"new", "b": b"x"}


def test_copies_and_documents_are_jobs(spark, tmp_path):
    src = tmp_path / "src" / "s1"
    src.mkdir(parents=True)
    for i in range(3):
        (src / f"f{i}.jpg").write_bytes(bytes([i]))
        os.utime(src / f"f{i}.jpg", (1000 + i, 1000 + i))
    rows = spark.createDataFrame([("s1", f"f{i}.jpg") for i in (0, 2, 9)], "session_id string, filename string")
    sinks.copies(rows, str(tmp_path / "src"), str(tmp_path / "to"))
    assert visible(tmp_path / "to") == {"s1/filtered/f0.jpg": b"\0", "s1/filtered/f2.jpg": b"\2"}
    assert os.stat(tmp_path / "to/s1/filtered/f2.jpg").st_mtime == 1002
    # a plan may replace the documents that it reads
    docs = spark.createDataFrame([("s1", '{"a": 1}'), ("s2", '{"a": 2}')], "session_id string, t string")
    sinks.json_documents(docs, F.col("t"), str(tmp_path / "doc"), "m.json")
    again = spark.read.text(str(tmp_path / "doc" / "*" / "m.json"), wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)/[^/]+$", 1).alias("session_id"), F.regexp_replace("value", "1", "3").alias("t"))
    sinks.json_documents(again, F.col("t"), str(tmp_path / "doc"), "m.json")
    assert visible(tmp_path / "doc") == {"s1/m.json": b'{\n  "a": 3\n}', "s2/m.json": b'{\n  "a": 2\n}'}
    assert files.listing(spark, str(tmp_path / "doc" / "*" / "*.json")).count() == 2


def to_driver(spark, run):
    """Bytes of results that the tasks of run sent to the driver."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    spark._jsc.sc().listenerBus().waitUntilEmpty()
    status, store = spark.sparkContext.statusTracker(), spark._jsc.sc().statusStore()
    return sum(store.lastStageAttempt(s).resultSize() for j in status.getJobIdsForGroup("counted") for s in status.getJobInfo(j).stageIds)


def test_files_are_listed_by_the_executors(spark, tmp_path):
    for top in ("a", "b [1]", "_jobs", ".b"):
        (tmp_path / top).mkdir()
        for i in range(1500):
            (tmp_path / top / f"f{i}.txt").write_bytes(b"%d" % i)
    for other in ("a/x.png", "a/_x.txt", "a/.x.txt", "top.txt"):
        (tmp_path / other).write_bytes(b"")
    own = files.contents(spark, str(tmp_path), ".txt")
    assert {r["name"]: bytes(r["content"]) for r in own.collect()} == {f"{top}/f{i}.txt": b"%d" % i for top in ("a", "b [1]") for i in range(1500)}
    assert to_driver(spark, lambda: files.contents(spark, str(tmp_path), ".txt").agg(F.count("*")).collect()) < 100_000
    assert files.contents(spark, str(tmp_path / "none"), ".txt").count() == 0


# --- videos ------------------------------------------------------------------------------------------------------


def shots(n, tag):
    return [b"\xff\xd8" + f"{tag}{i}".encode() + b"\xff\xd9" for i in range(n)]


@pytest.fixture
def clips(tmp_path):
    for v, n in (("a", 10), ("b", 0), ("c", 7), ("d", 30)):
        video.write_avi(str(tmp_path / "clips" / f"{v}.avi"), shots(n, v), 25, 4, 4, v != "c")
    return str(tmp_path / "clips")


def places(df):
    return sorted((r["session_id"], r["frame_index"], bytes(r["jpeg"])[2:-2].decode()) for r in df.collect())


def test_index_has_a_row_group_for_each_video(spark, clips, tmp_path):
    import pyarrow.parquet as pq

    at = video.index(spark, clips, str(tmp_path / "index"))
    groups = [(pq.ParquetFile(p).metadata.row_group(g).column(0).statistics, pq.ParquetFile(p).metadata.row_group(g).num_rows) for p in video.parts_of(at) for g in range(pq.ParquetFile(p).metadata.num_row_groups)]
    assert sorted((s.min, s.max, n) for s, n in groups) == [("a", "a", 10), ("c", "c", 7), ("d", "d", 30)]
    assert places(video.frames(spark, clips, 1, at)) == sorted((v, i, f"{v}{i}") for v, n in (("a", 10), ("c", 7), ("d", 30)) for i in range(n))


@pytest.mark.parametrize(("where", "keeps"), [
    ("session_id = 'd' and frame_index >= 5 and frame_index < 20", lambda v, i: v == "d" and 5 <= i < 20),
    ("session_id in ('a', 'c', 'x') and frame_index > 3", lambda v, i: v in "ac" and i > 3),
    ("frame_index <= 4", lambda v, i: i <= 4),
    ("frame_index in (3, 6, 29)", lambda v, i: i in (3, 6, 29)),
    ("frame_index = 6 and session_id <> 'a'", lambda v, i: i == 6 and v != "a"),
    ("session_id = 'a' and session_id = 'c'", lambda v, i: False),
    ("frame_index < 2 or session_id = 'c'", lambda v, i: i < 2 or v == "c"),
    ("frame_index >= 4 and frame_index in (2, 6)", lambda v, i: i == 6),
    ("frame_index is not null and total_frames = 7", lambda v, i: v == "c"),
])
@pytest.mark.parametrize(("stride", "indexed"), [(1, True), (3, True), (2, False)])
def test_filters_are_met(spark, clips, where, keeps, stride, indexed):
    df = video.frames(spark, clips, stride) if indexed else spark.read.format("mjpeg").option("stride", stride).load(clips)
    assert places(df.where(where)) == sorted((v, i, f"{v}{i}") for v, n in (("a", 10), ("c", 7), ("d", 30)) for i in range(0, n, stride) if keeps(v, i))


def test_only_what_is_asked_for_is_opened(spark, clips, capsys):
    at = video.index(spark, clips)
    for gone in ("a", "c"):
        os.remove(f"{clips}/{gone}.avi")
    raw = open(f"{clips}/d.avi", "rb").read()
    cut = raw.index(b"d20") - 10
    open(f"{clips}/d.avi", "wb").write(raw[:cut])  # frames from 20 on are lost, and so is the file's own index
    df = video.frames(spark, clips, 1, at).where("session_id = 'd' and frame_index >= 5 and frame_index < 20")
    assert places(df) == [("d", i, f"d{i}") for i in sorted(range(5, 20))]
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters" in plan and "frame_index" in plan.split("PushedFilters", 1)[1].split("\n")[0] and "Filter" not in plan.replace("PushedFilters", "")
    assert df.rdd.getNumPartitions() == 1
    with pytest.raises(Exception):
        video.frames(spark, clips, 1, at).where("session_id = 'a'").collect()


def test_ranges_are_tasks(spark, clips):
    at = video.index(spark, clips)
    df = spark.read.format("mjpeg").option("index", at).option("stride", 3).option("framesPerTask", 4).load()
    assert df.rdd.getNumPartitions() == 1 + 1 + 3  # rows 0-9, 0-6, and 0-11, 12-23, 24-29
    assert places(df.drop("edges"))[-1] == ("d", 27, "d27")
    assert spark.read.format("mjpeg").option("index", at).option("stride", -1).load().count() == 0


def test_videos_as_they_come(spark, clips, tmp_path):
    """A restarted stream goes on where it was; each file is taken once, so many a batch."""
    def drain():
        q = video.stream(spark, clips, 2).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "log")).start()
        q.processAllAvailable()
        n = sum(p["numInputRows"] > 0 for p in q.recentProgress)
        q.stop()
        return n

    assert drain() == 2
    video.write_avi(f"{clips}/e.avi", shots(3, "e"), 25, 4, 4)
    assert drain() == 1
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert places(rows) == sorted((v, i, f"{v}{i}") for v, n in (("a", 10), ("c", 7), ("d", 30), ("e", 3)) for i in range(n))


def test_short_videos_share_tasks(spark, clips, tmp_path):
    for i in range(60):
        video.write_avi(str(tmp_path / "short" / f"v{i}.avi"), shots(3, f"v{i}-"), 25, 4, 4)
    want = sorted((f"v{i}", k, f"v{i}-{k}") for i in range(60) for k in range(3))
    at = video.index(spark, str(tmp_path / "short"))
    own = video.frames(spark, str(tmp_path / "short"), 1, at)
    assert own.rdd.getNumPartitions() == len(video.parts_of(at)) <= 4 and places(own) == want
    few = spark.read.format("mjpeg").option("index", at).option("framesPerTask", 6).load()
    assert 30 <= few.rdd.getNumPartitions() <= 32 and places(few) == want
    plain = spark.read.format("mjpeg").load(str(tmp_path / "short"))
    assert plain.rdd.getNumPartitions() == 1 and places(plain) == want


def test_arriving_videos_share_tasks(monkeypatch, tmp_path):
    for i in range(30):
        video.write_avi(str(tmp_path / f"v{i}.avi"), shots(3, f"v{i}-"), 25, 4, 4)
    came = video.Arrivals({"path": str(tmp_path)})
    start, end = came.initialOffset(), came.latestOffset()
    (one,) = came.partitions(start, end)
    assert sorted(one.paths) == sorted(str(p) for p in tmp_path.glob("*.avi")) and len({(r[0], r[6]) for r in came.read(one)}) == 90
    monkeypatch.setattr(video, "FILES", 7)
    assert [len(p.paths) for p in came.partitions(start, end)] == [7, 7, 7, 7, 2]
    monkeypatch.setattr(video, "BYTES", 10)
    assert [len(p.paths) for p in came.partitions(start, end)] == [1] * 30
