"""Frames out of order, the memory of a session, and what comes too late."""

import random
from datetime import datetime, timedelta

import pytest
from oracle import SF
from pyspark.sql import functions as F

from framelake.operators import tracking
from framelake.plans import workloads
from framelake.streaming import ordered, tracker

SCHEMA = "user_id long, ts timestamp, event_id long, area double, cov double, marked boolean, a1 double, a2 double"
START = datetime(2024, 1, 1)


def frames(seed, users, n):
    r = random.Random(seed)
    some = lambda *x: r.choice([None, *x])
    return [(u, START + timedelta(seconds=i), u * n + i, some(10.0, 12.0, 50.0, 0.0), some(0.2, 0.7, 1.0), r.random() < 0.7, some(11.0, 30.0), some(9.0)) for u in range(users) for i in range(n)]


def plain(rows, window):
    """event_id -> frame, source, reanchor, lost, kept of each frame in order of time."""
    out = {}
    for u in {r[0] for r in rows}:
        own, on, anchor, last = tracking.State(), False, None, []
        for k, r in enumerate(sorted((r for r in rows if r[0] == u), key=lambda r: (r[1], r[2])), 1):
            source, again, lost = own.row(*r[3:])
            if own.on and not on:
                anchor, last = k, []
            if own.on and on:
                last.append(k)
            kept = sorted({anchor, *(x for x in last if x >= k - window)}) if own.on else []
            out[r[2]] = (k, source, int(again), int(lost), kept)
            on = own.on
    return out


def load(spark, rows, at):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(at)


def drain(spark, tmp_path, delay, window=3):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    return ordered.drained(spark, stream, str(tmp_path / "out"), str(tmp_path / "state"), delay, window)


def found(spark, tmp_path):
    rows = spark.read.schema(ordered.OUTPUT).parquet(str(tmp_path / "out")).collect()
    assert len({r["event_id"] for r in rows}) == len(rows)
    return {r["event_id"]: (r["frame"], r["source"], r["reanchor"], r["track_reset"], r["kept"]) for r in rows}


def test_any_order_within_the_delay(spark, tmp_path):
    rows = frames(1, 3, 80)
    r = random.Random(2)
    comes = sorted(rows, key=lambda x: x[1] + timedelta(seconds=r.random() * 20))  # up to 20 s late
    for i in range(0, len(comes), 60):
        load(spark, comes[i : i + 60], str(tmp_path / "in"))
    odd = [(0, None, -1, None, None, None, None, None), (0, datetime(9998, 1, 1), -2, None, None, None, None, None), (None, START + timedelta(seconds=5), -3, 1.0, 1.0, None, None, None)]
    load(spark, odd, str(tmp_path / "in"))
    first = drain(spark, tmp_path, "200 seconds")
    assert first["rows"] == len(rows) + 3 and first["late"] == 0 and found(spark, tmp_path) == {}
    load(spark, [(7, START + timedelta(days=1), -4, None, None, False, None, None)], str(tmp_path / "in"))
    drain(spark, tmp_path, "200 seconds")
    want = plain(rows, 3) | {-3: (1, 3, 0, 0, [])}
    assert found(spark, tmp_path) == want  # a restarted stream, in the order of time


def test_a_frame_without_user_leaves_the_others_theirs(spark, tmp_path):
    """In one batch: pandas holds its keys as floats then."""
    rows = frames(5, 3, 20)
    load(spark, [(r[0] + 2**60, *r[1:]) for r in rows] + [(None, START + timedelta(seconds=5), -3, 1.0, 1.0, None, None, None), (None, START + timedelta(days=1), -4, None, None, False, None, None)], str(tmp_path / "in"))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        drain(spark, tmp_path, "5 seconds")
        spark.read.schema(SCHEMA).parquet(str(tmp_path / "in")).where("event_id <> -4").write.parquet(str(tmp_path / "batch"))
        tracker.drained(spark, spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "batch")), str(tmp_path / "plain"), str(tmp_path / "track"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    want = plain(rows, 3) | {-3: (1, 3, 0, 0, [])}
    assert found(spark, tmp_path) == want
    users = {r[2]: r[0] + 2**60 for r in rows} | {-3: None}
    for at in ("out", "plain"):
        got = spark.read.parquet(str(tmp_path / at)).collect()
        assert {r["event_id"]: (r["user_id"], r["source"]) for r in got} == {e: (u, want[e][1]) for e, u in users.items()}


def test_frames_come_out_as_the_watermark_passes_and_late_ones_are_counted(spark, tmp_path):
    rows = frames(3, 2, 50)
    on_time = [r for r in rows if r[2] % 10 != 4]
    for lo in range(0, 50, 10):
        load(spark, [r for r in on_time if lo <= (r[1] - START).seconds < lo + 10], str(tmp_path / "in"))
        drain(spark, tmp_path, "5 seconds")
        newest = lo + 9
        assert set(found(spark, tmp_path)) == {r[2] for r in on_time if (r[1] - START).seconds < newest - 5} | {r[2] for r in on_time if (r[1] - START).seconds == newest - 5 and r[2] in found(spark, tmp_path)}
    load(spark, [r for r in rows if r[2] % 10 == 4] + [(9, START + timedelta(days=1), -1, None, None, False, None, None)], str(tmp_path / "in"))
    last = drain(spark, tmp_path, "5 seconds")
    late = [r for r in rows if r[2] % 10 == 4 and (r[1] - START).seconds <= 49 - 5]
    assert last["late"] == len(late) > 0
    kept = [r for r in rows if r not in late]
    assert found(spark, tmp_path) == plain(kept, 3)


def test_state_stays_flat_over_a_long_session(spark, tmp_path):
    listener = ordered.Progress()
    spark.streams.addListener(listener)
    n = 10_000
    for lo in range(0, n, 2000):
        load(spark, [(1, START + timedelta(seconds=i), i, 10.0, 1.0, True, 10.0, None) for i in range(lo, lo + 2000)], str(tmp_path / "in"))
    load(spark, [(2, START + timedelta(days=1), -1, None, None, False, None, None)], str(tmp_path / "in"))
    try:
        drain(spark, tmp_path, "1 second", 7)
    finally:
        spark.streams.removeListener(listener)
    got = found(spark, tmp_path)
    assert len(got) == n and got[n - 1] == (n, 0, 0, 0, [1, *range(n - 7, n + 1)])
    assert max(len(v[4]) for v in got.values()) == 9
    state = lambda name: spark.read.format("statestore").option("path", str(tmp_path / "state")).option("stateVarName", name).load()
    with ordered.rocksdb(spark):
        memory = state("memory").where("key.user_id = 1").selectExpr("user_map_key.frame").collect()
    assert sorted(r["frame"] for r in memory) == [1, *range(n - 7, n + 1)]
    assert listener.batches >= 6 and listener.rows == n + 1


@pytest.mark.parametrize("window", [0, 1, 5])
def test_memory_against_a_plain_list(window):
    r = random.Random(window)
    own, state, kept = ordered.Memory(window, {}), tracking.State(), []
    anchor = None
    for k in range(1, 400):
        was = state.on
        source, _, _ = state.row(r.choice([10.0, 40.0, 0.0]), r.choice([0.2, 0.9]), True, r.choice([None, None, 12.0]), None)
        own.add(k, source, 1.0, state.on and not was)
        anchor, kept = (k, []) if state.on and not was else (anchor, [*kept, k]) if state.on else (None, [])
        assert sorted(own.kept) == ([anchor, *(x for x in kept if x >= k - window)] if state.on else [])
        assert len(own.kept) <= window + 2


def test_the_queries_see_late_frames_and_several_waves(spark, tmp_path):
    total, out = workloads.waves(spark, SF, str(tmp_path / "w"))
    assert total["late"] > 0 and total["batches"] >= 4 and out.agg(F.max(F.size("kept"))).first()[0] > 2
