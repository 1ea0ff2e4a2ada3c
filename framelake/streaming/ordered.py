"""The tracking state machine over frames that arrive in any order, with a memory of bounded size.

A session's frames wait in a list in the state store until the watermark has passed them: no frame before them can come any
more.  One timer a session, at its first waiting frame, then lets all frames up to the watermark through the state machine
in the order of time and id.  What still arrives behind the watermark is dropped by Spark and counted: ``late``.  A task
holds the waiting frames of one session at a time, those of the delay that the caller allows.

The machine's memory of a session is a map from frame number to output: the anchor, which is the frame where the
track was started, and the outputs of the newest ``window`` frames before the current one, re-anchored ones among them.  Older
outputs are taken out as frames go by, the anchor stays, and a lost track or a new start drops all, so the state of a
session has at most window + 2 entries, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from framelake.operators.tracking import SOURCES, State
from framelake.streaming.tracker import keyed, rocksdb, session

#: Frames before the current one whose outputs the machine's tracker still reads.
WINDOW = 7
FRAME = "t long, event_id long, area double, cov double, marked boolean, a1 double, a2 double"
OUTPUT = "user_id long, event_id long, frame long, source int, reanchor int, track_reset int, kept array<long>"


def _none(x: object) -> float | None:
    return None if x is None or pd.isna(x) else float(x)


class Memory:
    """What a session keeps, held while its frames go through; only changes go back to the state store."""

    def __init__(self, window: int, kept: dict[int, tuple[int, float | None, bool]]) -> None:
        self.window, self.kept, self.before = window, kept, dict(kept)

    def add(self, frame: int, source: int, area: float | None, started: bool) -> None:
        if started or source == len(SOURCES) - 1:
            self.kept.clear()
        if source < len(SOURCES) - 1:
            self.kept[frame] = (source, area, started)
        for old in [k for k, v in self.kept.items() if k < frame - self.window and not v[2]]:
            del self.kept[old]


class Ordered(StatefulProcessor):
    def __init__(self, window: int = WINDOW) -> None:
        self.window = window

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", FRAME)
        self.track = handle.getValueState("track", "on boolean, ref double, frame long")
        self.timer = handle.getValueState("timer", "at long")
        self.memory = handle.getMapState("memory", "frame long", "source int, area double, anchor boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ARG002
        first = None
        for part in rows:
            new = [(int(r.t), int(r.event_id), _none(r.area), _none(r.cov), bool(r.marked), _none(r.a1), _none(r.a2)) for r in part.itertuples()]
            self.waiting.appendList(new)
            first = min(x[0] for x in new) if first is None else min(first, *(x[0] for x in new))
        self._wake(first // 1000)
        return iter(())

    def _wake(self, at: int) -> None:
        """Sets the session's timer if it has none as early."""
        old = self.timer.get()[0] if self.timer.exists() else None
        if old is not None and old <= at:
            return
        if old is not None:
            self.handle.deleteTimer(old)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ARG002
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        ready, rest = [], []
        for x in self.waiting.get():
            (ready if x[0] <= passed else rest).append(tuple(x))
        if rest:
            self.waiting.put(rest)
        else:
            self.waiting.clear()
        self.timer.clear()
        if rest:
            self._wake(min(x[0] for x in rest) // 1000)
        yield self._through(key, sorted(ready, key=lambda x: x[:2]))

    def _through(self, key, frames: list[tuple]) -> pd.DataFrame:
        on, ref, n = self.track.get() if self.track.exists() else (False, None, 0)
        own, memory = State(on, ref), Memory(self.window, {k[0]: tuple(v) for k, v in self.memory.iterator()})
        out = []
        for _, event_id, area, cov, marked, a1, a2 in frames:
            was, n = own.on, n + 1
            source, again, lost = own.row(area, cov, marked, a1, a2)
            memory.add(n, source, (area, a1, a2, None)[source], own.on and not was)
            out.append((session(key), event_id, n, source, int(again), int(lost), sorted(memory.kept)))
        self.track.update((own.on, own.ref, n))
        for k in memory.before.keys() - memory.kept.keys():
            self.memory.removeKey((k,))
        for k, v in memory.kept.items():
            if memory.before.get(k) != v:
                self.memory.updateValue((k,), v)
        return pd.DataFrame(out, columns=["user_id", "event_id", "frame", "source", "reanchor", "track_reset", "kept"])

    def close(self) -> None:
        pass


def tracked(frames: DataFrame, delay: str, window: int = WINDOW) -> DataFrame:
    """A row for each frame of a stream of (user_id, ts, event_id, area, cov, marked, a1, a2), once the watermark has passed it.

    delay: how far behind the newest time a frame may come.  Frames without a time are left out, as no watermark passes them, and
    so are those of times that pandas doesn't hold (before 1678, after 2261).
    """
    known = frames.where(F.year("ts").between(1678, 2261)).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return keyed(known.withColumn("t", F.unix_micros("ts"))).transformWithStateInPandas(statefulProcessor=Ordered(window), outputStructType=OUTPUT, outputMode="Append", timeMode="EventTime")


def figures(query: StreamingQuery) -> dict[str, int]:
    """rows: taken in; late: dropped behind the watermark; batches; state: most entries in the store after a batch."""
    seen = query.recentProgress
    own = [o for p in seen for o in p["stateOperators"]]
    return {"rows": sum(p["numInputRows"] for p in seen), "late": sum(o["numRowsDroppedByWatermark"] for o in own), "batches": len(seen), "state": max((o["numRowsTotal"] for o in own), default=0)}


def drained(spark: SparkSession, frames: DataFrame, out: str, checkpoint: str, delay: str, window: int = WINDOW) -> dict[str, int]:
    """Runs the stream over what is there now, to a table at out; goes on where it was. Returns this run's figures."""
    with rocksdb(spark):
        query = tracked(frames, delay, window).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    return figures(query)


class Progress(StreamingQueryListener):
    """Logs each batch of every stream of the session: rows taken in, rows behind the watermark, entries in the state store."""

    def __init__(self) -> None:
        import logging

        self.log = logging.getLogger("framelake")
        self.rows = self.late = self.batches = 0

    def onQueryStarted(self, event) -> None:
        self.log.info("%s: started", event.name or event.id)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        late = sum(o.numRowsDroppedByWatermark for o in p.stateOperators)
        self.rows, self.late, self.batches = self.rows + p.numInputRows, self.late + late, self.batches + 1
        self.log.info("%s: batch %d, %d rows, %d late, %d in state", p.name or p.id, p.batchId, p.numInputRows, late, sum(o.numRowsTotal for o in p.stateOperators))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.log.info("%s: ended%s", event.id, f", {event.exception}" if event.exception else "")


def arrival(ts: Column, key: Column, most_seconds: int) -> Column:
    """When a frame would come that is late by up to so many seconds, as its key tells."""
    return ts + F.make_dt_interval(secs=F.pmod(F.xxhash64(key), F.lit(most_seconds)))
