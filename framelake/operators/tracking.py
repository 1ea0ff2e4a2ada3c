"""The tracking state machine: one transition, State.decide, for tables, streams and sessions of images.

A session's frames run in order through one State; sessions run in parallel.  What a tracker offers for a frame is taken
one offer at a time, as an offer may cost a model call: the tracked mask while tracking, then the detector's box, then the
markers' box.  Tables bring the offers' areas as columns.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any, Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.functions.geometry import LEAST_COVERAGE, LEAST_RATIO, MOST_RATIO
from framelake.operators import raster
from framelake.settings import BOX_SCORE, TEXT_SCORE
from framelake.sources import storage

SOURCES = ("tracked", "dino", "aruco_box", "fallback_full")
STATS = (*(f"frames_{s}" for s in SOURCES), "reanchors", "track_resets")


@dataclass
class State:
    """What a session carries from frame to frame."""

    on: bool = False
    ref: float | None = None

    def decide(self, marked: bool, offers: Iterable[tuple[int, float | None, float]]) -> tuple[int, bool, bool]:
        """Takes the first offer (source, area, coverage) that is good; gives source, whether re-anchored, whether lost."""
        was = self.on
        for source, area, covered in offers:
            if not area or area < 0:
                continue
            like = self.ref is None or LEAST_RATIO <= area / self.ref <= MOST_RATIO
            if not marked or (like and covered >= LEAST_COVERAGE):
                self.on, self.ref = True, area if marked else self.ref
                return source, was and source > 0, False
        self.on, self.ref = False, None
        return len(SOURCES) - 1, False, was

    def row(self, area: float | None, cov: float | None, marked: bool, a1: float | None, a2: float | None) -> tuple[int, bool, bool]:
        """The same for a frame whose offers are known; candidates cover all markers."""
        tracked = [(0, area, cov if cov is not None else 0.0)] if self.on else []
        return self.decide(marked, [*tracked, (1, a1, 1.0), (2, a2, 1.0)])


def decisions(rows: DataFrame, session: str, order: list[str], split: bool = False) -> DataFrame:
    """session, the order columns, source, reanchor, track_reset of every frame.

    rows: session, order, area, cov, marked, a1, a2 (null: no such candidate).  A session's frames come sorted to one
    task and pass through it one by one, so memory is that of a batch whatever a session's length.  With split, for
    sessions of very many frames, they come in segments that don't depend on each other: see segmented.
    """
    own = rows.select(session, *order, *(F.col(c).cast("double") for c in ("area", "cov")), "marked", *(F.col(c).cast("double") for c in ("a1", "a2")))
    head = [f for f in own.schema.fields if f.name == session or f.name in order]
    schema = T.StructType([*head, T.StructField("source", T.IntegerType()), T.StructField("reanchor", T.IntegerType()), T.StructField("track_reset", T.IntegerType())])
    n, keys = len(head), [session, "__segment"] if split else [session]
    own = segmented(own, session, order) if split else own
    dealt = own.repartition(*keys).sortWithinPartitions(*keys, *order).select(*keys[1:], *(f.name for f in head), "area", "cov", "marked", "a1", "a2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, current = State(), None
        for b in batches:
            out: tuple[list, list, list] = ([], [], [])
            cols = [c.to_pylist() for c in b.columns]
            for *key, area, cov, marked, a1, a2 in zip(*(cols[: len(keys)]), *cols[-5:], strict=True):
                if current != key:
                    state, current = State(), key
                for own_list, x in zip(out, state.row(area, cov, bool(marked), a1, a2), strict=True):
                    own_list.append(int(x))
            yield pa.RecordBatch.from_arrays([*b.columns[len(keys) - 1 : len(keys) - 1 + n], *(pa.array(x, pa.int32()) for x in out)], schema.fieldNames())

    return dealt.mapInArrow(run, schema)


def _silent(b: pa.RecordBatch) -> np.ndarray:
    """The frames that offer nothing: whatever the state was, the machine leaves them in the state of a new session."""
    above = [pc.fill_null(pc.greater(b.column(c), 0.0), False).to_numpy(zero_copy_only=False) for c in ("area", "a1", "a2")]
    return ~(above[0] | above[1] | above[2])


def segmented(own: DataFrame, session: str, order: list[str]) -> DataFrame:
    """The frames with __segment: in order, the number of a session's segment grows by one behind each frame that offers nothing.

    Such a frame belongs to the segment that it ends, so its lost track is told there.  Frames are dealt out in ranges of
    (session, order), and each task counts within its range; what a session's earlier ranges add to the first session of a
    range comes from one row for each range, so no task sees a whole session.
    """
    spark = own.sparkSession
    ranged = own.repartitionByRange(session, *order).sortWithinPartitions(session, *order)
    schema = T.StructType([*own.schema.fields, T.StructField("__before", T.LongType()), T.StructField("__range", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, at = 0, TaskContext.get().partitionId()
        for b in batches:
            silent = _silent(b)
            upto = seen + np.cumsum(silent)
            seen = int(upto[-1]) if len(upto) else seen
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(upto - silent, pa.int64()), pa.array(np.full(b.num_rows, at, np.int32))], schema.fieldNames())

    path = storage.fresh(spark, "ranges")
    ranged.mapInArrow(run, schema).write.parquet(path)  # written, as ranges are numbered by the tasks that made them
    counted = spark.read.schema(schema).parquet(path)
    place = F.struct(*order)
    ends = counted.groupBy("__range").agg(F.min_by(session, F.struct(session, place)).alias("first"), F.max_by(session, F.struct(session, place)).alias("last"), F.max(F.col("__before") + F.when(_offers(), 0).otherwise(1)).alias("silent")).orderBy("__range").collect()  # a row for each task
    add, rows = 0, []
    for i, r in enumerate(ends):
        add = add if i and ends[i - 1]["last"] == r["first"] else 0
        rows.append((r["__range"], r["first"], add))
        # a session that fills its range goes on from what came before it, another from what its range has counted
        add = r["silent"] + (add if r["first"] == r["last"] else 0)
    offsets = spark.createDataFrame(rows, T.StructType([T.StructField("__range", T.IntegerType()), T.StructField("__first", own.schema[session].dataType), T.StructField("__add", T.LongType())]))
    joined = counted.join(F.broadcast(offsets), "__range")
    segment = F.col("__before") + F.when(F.col(session).eqNullSafe(F.col("__first")), F.col("__add")).otherwise(0)
    return joined.select(*own.columns, segment.alias("__segment"))


def _offers() -> Column:
    return F.coalesce(F.col("area") > 0, F.lit(False)) | F.coalesce(F.col("a1") > 0, F.lit(False)) | F.coalesce(F.col("a2") > 0, F.lit(False))


def counters(decided: DataFrame, session: str) -> DataFrame:
    """session, frames_* of the four sources, reanchors, track_resets."""
    n = [F.count_if(F.col("source") == i).alias(f"frames_{s}") for i, s in enumerate(SOURCES)]
    return decided.groupBy(session).agg(*n, F.sum(F.col("reanchor").cast("long")).alias("reanchors"), F.sum(F.col("track_reset").cast("long")).alias("track_resets"))


def fold(rows: DataFrame, session: str, order: list[str], split: bool = False) -> DataFrame:
    """The counters of every session."""
    return counters(decisions(rows, session, order, split), session)


class Tracker(Protocol):
    """The extension point: a detector and segmenter for one session's images."""

    info: dict[str, str]

    def detect(self, rgb: np.ndarray) -> tuple[np.ndarray, ...]:
        """Boxes, their scores, and if there is a text prompt how well each fits it."""

    def start(self, rgb: np.ndarray, box: np.ndarray) -> np.ndarray: ...

    def step(self, rgb: np.ndarray) -> np.ndarray: ...

    def correct(self, box: np.ndarray) -> np.ndarray: ...


@dataclass
class BoxTracker:
    """A tracker without a model: the segment is the last box, the detector finds what is brighter than the mean."""

    info: dict[str, str] = field(default_factory=lambda: {"text_prompt": "", "detector_model": "bright", "segmenter_model": "box", "device": "cpu"})
    memory: int = 7  # masks of the newest frames that are kept
    box: np.ndarray | None = None
    shape: tuple[int, int] = (0, 0)
    masks: list[np.ndarray] = field(default_factory=list)

    def detect(self, rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y, x = np.nonzero(rgb.mean(axis=2) > rgb.mean())
        return (np.array([[x.min(), y.min(), x.max(), y.max()]], float), np.ones(1)) if len(x) else (np.zeros((0, 4)), np.zeros(0))

    def start(self, rgb: np.ndarray, box: np.ndarray) -> np.ndarray:
        self.masks, self.shape = [], rgb.shape[:2]
        return self._mask(box)

    def step(self, rgb: np.ndarray) -> np.ndarray:
        if self.box is None:
            raise RuntimeError("step before start")
        self.shape = rgb.shape[:2]
        return self._mask(self.box)

    def correct(self, box: np.ndarray) -> np.ndarray:
        if self.box is None:
            raise RuntimeError("correct before start")
        return self._mask(box)

    def _mask(self, box: np.ndarray) -> np.ndarray:
        self.box = np.asarray(box, float)
        x0, y0, x1, y1 = np.rint(self.box).astype(int)
        mask = np.zeros(self.shape, bool)
        mask[max(0, y0) : y1 + 1, max(0, x0) : x1 + 1] = True
        self.masks = [*self.masks, mask][-self.memory :]  # bounded, whatever the session's length
        return mask


class Session:
    """Drives a tracker through one session's frames."""

    def __init__(self, tracker: Tracker) -> None:
        self.tracker, self.state = tracker, State()
        self.counts = Counter()

    def detected(self, rgb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The detector's boxes that count, and their scores."""
        boxes, scores, *text = (np.asarray(x, float) for x in self.tracker.detect(rgb))
        keep = scores > BOX_SCORE
        if text:
            keep &= text[0] > TEXT_SCORE
        return boxes.reshape(-1, 4)[keep], scores[keep]

    def frame(self, rgb: np.ndarray, corners: list[np.ndarray]) -> tuple[np.ndarray, str, bool, bool]:
        """Mask, source, whether it was a re-anchor, whether the track was lost."""
        marks, masks = raster.Marks(corners), []

        def offer(source: int, mask: np.ndarray) -> tuple[int, float, float]:
            masks.append(mask)
            return source, *marks.measured(mask)

        def offers() -> Iterator[tuple[int, float, float]]:
            on = self.state.on
            if on:
                yield offer(0, self.tracker.step(rgb))
            again = self.tracker.correct if on else lambda box: self.tracker.start(rgb, box)
            if (box := marks.choose(*self.detected(rgb))) is not None:
                yield offer(1, again(box))
            if (box := marks.prompt(rgb.shape)) is not None:
                yield offer(2, again(box))

        source, again, lost = self.state.decide(bool(len(marks)), offers())
        self.counts.update({f"frames_{SOURCES[source]}": 1, "reanchors": int(again), "track_resets": int(lost)})
        if source == len(SOURCES) - 1:
            return np.full(rgb.shape[:2], 255, np.uint8), SOURCES[source], again, lost
        return raster.finished(masks[-1], marks), SOURCES[source], again, lost

    def stats(self) -> dict[str, Any]:
        return {k: self.counts[k] for k in STATS} | dict(self.tracker.info)


#: Frames of a batch of masks.
TOGETHER = 32


def masks(frames: DataFrame, tracker: type = BoxTracker, profile: ResourceProfile | None = None) -> DataFrame:
    """session_id, frame_index, filename, source, reanchor, track_reset, png of every readable frame.

    frames: session_id, frame_index, filename, height, width, data (gray or BGR bytes; null if unreadable), corners.  A session's
    frames come sorted to one task and pass through it one by one.  profile: what a task of this stage asks for, as
    settings.tracker_profile makes it.
    """
    schema = "session_id string, frame_index int, filename string, source string, reanchor int, track_reset int, png binary"
    types = (pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session, current = Session(tracker()), None
        for b in batches:
            rows, data = [], b.column("data")
            plain = b.drop_columns(["data"]).to_pylist()
            for i, r in enumerate(plain):
                if current != (r["session_id"],):
                    session, current = Session(tracker()), (r["session_id"],)
                if data[i].is_valid and r["height"] and r["height"] > 0:
                    pixels = np.frombuffer(data[i].as_buffer(), np.uint8).reshape(r["height"], r["width"], -1)  # the batch's own bytes
                    rgb = np.repeat(pixels, 3, axis=2) if pixels.shape[2] < 3 else pixels[:, :, 2::-1]  # gray, or BGR with or without alpha
                    mask, source, again, lost = session.frame(rgb, [np.array(c, float) for c in r["corners"] or []])
                    rows.append((r["session_id"], r["frame_index"], r["filename"], source, int(again), int(lost), raster.png(mask)))
                if rows and (len(rows) == TOGETHER or i == len(plain) - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["session_id", "frame_index", "filename", "source", "reanchor", "track_reset", "png"])
                    rows = []

    own = frames.select("session_id", F.col("frame_index").cast("int").alias("frame_index"), "filename", "height", "width", "data", "corners")
    return own.repartition("session_id").sortWithinPartitions("session_id", "frame_index").mapInArrow(run, schema, profile=profile)


def mask_stats(done: DataFrame, info: dict[str, str]) -> DataFrame:
    """session_id and the record of a session's masks: counters, and the tracker's own fields, which win."""
    named = done.withColumn("source", F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source")) - 1)
    out = counters(named, "session_id").withColumns({c: F.col(c).cast("int") for c in STATS})
    return out.withColumns({k: F.lit(v) for k, v in info.items()})
