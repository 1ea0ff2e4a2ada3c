"""Video source: AVI files with motion JPEG, as a Python data source with a reader for ranges of frames.

An index table comes first: executors parse the files' heads, each file in one task, and write for every frame its number,
place and size, one row group for each video.  ``frames`` builds it where none is given.  From there on the driver reads
the footers of the index alone: a row group's statistics name its video and its rows are the video's frames, so filters on
session_id and frame_index and the stride are met by choosing row groups and ranges of their rows, and a task reads the
rows of its own ranges, of short videos several, and then those frames.  No video is opened on the driver.

The index gives session_id, source_video, fps, total_frames, width, height, frame_index, jpeg.  ``headers`` gives one row
for each video, whose edges are the bytes that can hold its camera data: the whole file, or both ends of a large one,
which are read by themselves.  A frame whose bytes are no JPEG is skipped (a gap, not a failure); a file that is no video,
or whose frame rate isn't above 0, is an error.  Files may lie wherever framelake.sources.storage reads.

``spark.read.format("mjpeg").load(path)`` without an index reads each video in one task, which parses its head itself and that of other small ones.
``stream`` takes the videos of a folder as they come: see Arrivals.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from framelake.functions import probe
from framelake.sources import storage

SCHEMA = "session_id string, source_video string, fps double, total_frames int, width int, height int, frame_index int, jpeg binary, edges binary"


@dataclass
class Header:
    fps: float
    width: int
    height: int
    frames: list[tuple[int, int]]  # offset, size


#: An entry of the index chunk.
ENTRY = np.dtype([("kind", "S4"), ("flags", "<u4"), ("offset", "<u4"), ("size", "<u4")])


def indexed(f, movi: int, size: int) -> list[tuple[int, int]] | None:
    """The frames of the list at movi from the index chunk behind it, in one read; None where there is none to go by."""
    f.seek(movi + size + (size & 1))
    head = f.read(8)
    if head[:4] != b"idx1":
        return None
    raw = f.read(struct.unpack("<I", head[4:])[0])
    entries = np.frombuffer(raw[: len(raw) // ENTRY.itemsize * ENTRY.itemsize], ENTRY)
    own = entries[np.isin([k[2:] for k in entries["kind"].tolist()], [b"dc", b"db"])]
    if not len(own):
        return None
    end, first = f.tell(), own[0]
    for base in (movi, 0):  # offsets count from the list's name or from the file's start
        f.seek(base + int(first["offset"]))
        if f.read(8) == struct.pack("<4sI", first["kind"], int(first["size"])):
            f.seek(end + (end & 1))
            return list(zip((own["offset"].astype(np.int64) + base + 8).tolist(), own["size"].tolist(), strict=True))
    return None


def header(path: str) -> Header:
    """Rate, size and the places of all frames, from the index or else from the chunk heads; pixels are skipped."""
    fps, width, height, frames = 0.0, 0, 0, []
    with storage.opened(path) as f:
        if f.read(4) != b"RIFF" or f.seek(8) != 8 or f.read(4) != b"AVI ":
            raise ValueError(f"{path}: not an AVI file; other containers need a decoder that is not here")
        end = f.size()
        while f.tell() + 8 <= end:
            kind, size = struct.unpack("<4sI", f.read(8))
            at = f.tell()
            if kind in (b"LIST", b"RIFF"):
                if f.read(4) == b"movi" and (found := indexed(f, at, size)):
                    frames += found
                    continue
                f.seek(at + 4)  # its chunks follow
                continue
            if kind == b"avih":
                h = struct.unpack("<14I", f.read(56))
                fps, width, height = 1e6 / h[0] if h[0] else 0.0, h[8], h[9]
            elif kind == b"strh":
                h = struct.unpack("<4s4sIHHIII", f.read(28))
                if h[0] == b"vids" and h[6]:
                    fps = h[7] / h[6]
            elif kind[2:] in (b"dc", b"db"):
                frames.append((at, size))
            f.seek(at + size + (size & 1))
    if fps <= 0:
        raise ValueError(f"{path}: frame rate must be above 0")
    return Header(fps, width, height, frames)


def session_of(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[0]


#: A row of the index.
INDEX = pa.schema([("session_id", pa.string()), ("source_video", pa.string()), ("fps", pa.float64()), ("total_frames", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), ("frame_index", pa.int32()), ("offset", pa.int64()), ("size", pa.int64())])
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def described(path: str) -> list[tuple[str, int, int]]:
    """Path, time of change and size of the videos below path."""
    found = storage.described(storage.joined(path, "*.avi") if storage.is_folder(path) else path)
    if not found:
        raise FileNotFoundError(path)
    return found


def listed(path: str) -> list[str]:
    return [p for p, _, _ in described(path)]


def entries(path: str) -> pa.Table:
    """A video's part of the index."""
    h = header(path)
    n = len(h.frames)
    at = np.array(h.frames, np.int64).reshape(-1, 2)
    same = [pa.repeat(pa.scalar(v, t.type), n) for v, t in zip((session_of(path), path, h.fps, n, h.width, h.height), INDEX, strict=False)]
    return pa.Table.from_arrays([*same, pa.array(np.arange(n, dtype=np.int32)), pa.array(at[:, 0]), pa.array(at[:, 1])], schema=INDEX)


def index(spark: SparkSession, path: str, at: str | None = None) -> str:
    """Writes the index of the videos below path to the folder at and returns it; the heads are parsed by the executors.

    Each attempt of a task writes a file of its own; the table ``parts`` names those of the attempts that counted.
    """
    at = at or storage.fresh(spark, "video-index")
    paths = spark.createDataFrame(pa.table({"path": pa.array(listed(path), pa.string())}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, sink, out, videos, rows = f"{at}/{uuid.uuid4().hex}.parquet", None, None, 0, 0
        for b in batches:
            for p in b.column(0).to_pylist():
                own = entries(p)
                if not own.num_rows:
                    continue
                if out is None:
                    system, where = storage.located(part)
                    system.create_dir(where.rpartition("/")[0], recursive=True)
                    sink = system.open_output_stream(where)
                    out = pq.ParquetWriter(sink, INDEX)
                out.write_table(own, row_group_size=own.num_rows)
                videos, rows = videos + 1, rows + own.num_rows
        if out is not None:
            out.close()
            sink.close()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([videos], pa.int64()), pa.array([rows], pa.int64())], ["part", "videos", "frames"])

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    paths.repartition(tasks, "path").sortWithinPartitions("path").mapInArrow(run, "part string, videos long, frames long").write.parquet(f"{at}/parts")
    return at


def parts_of(at: str) -> list[str]:
    """The files of an index, by name."""
    tables = [pq.read_table(storage.opened(p), columns=["part"]) for p in storage.listed(f"{at}/parts/*.parquet")]
    return sorted(x for t in tables for x in t.column("part").to_pylist())


@dataclass
class FrameRanges(InputPartition):
    """Every step-th of the rows lo ... hi of row groups (group, lo, hi) of a file of the index."""

    part: str
    ranges: list[tuple[int, int, int]]
    step: int


@dataclass
class Videos(InputPartition):
    paths: list[str]
    headers: bool


#: Most files of a task that parses heads itself, and the bytes beyond which it takes no more.
FILES, BYTES = 256, 32 << 20


def together(found: Iterable[tuple[str, int]], headers: bool) -> list[Videos]:
    """Files (path, size) as tasks: small ones share one, in order."""
    out: list[Videos] = []
    bytes_ = 0
    for path, n in found:
        if not out or len(out[-1].paths) == FILES or bytes_ + n > BYTES:
            out.append(Videos([], headers))
            bytes_ = 0
        out[-1].paths.append(path)
        bytes_ += n
    return out


@dataclass
class Wanted:
    """The frames that pushed filters ask for: those of some sessions (None: all), from lo to hi."""

    sessions: set[str] | None = None
    lo: int = 0
    hi: int = 2**31 - 1
    some: set[int] | None = None

    def take(self, f: Filter) -> bool:
        """Narrows to what a filter lets pass; False if it has to be left to Spark."""
        name = getattr(f, "attribute", None)
        if isinstance(f, IsNotNull) and name in (("session_id",), ("frame_index",)):
            return True
        values = set(f.value) if isinstance(f, In) else {f.value} if isinstance(f, (EqualTo, EqualNullSafe)) else None
        if name == ("session_id",) and values is not None:
            self.sessions = values if self.sessions is None else self.sessions & values
            return True
        if name != ("frame_index",):
            return False
        if values is not None:
            self.some = values if self.some is None else self.some & values
        elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.lo = max(self.lo, f.value + isinstance(f, GreaterThan))
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            self.hi = min(self.hi, f.value - isinstance(f, LessThan))
        else:
            return False
        return True

    def rows(self, frames: int) -> tuple[int, int]:
        """First and past-last row of a video of so many frames that can be asked for."""
        known = [i for i in self.some or () if i is not None]
        lo, hi = max(self.lo, min(known, default=2**31)) if self.some is not None else self.lo, min(self.hi, max(known, default=-1)) if self.some is not None else self.hi
        return max(0, lo), max(0, min(frames, hi + 1))

    def has(self, i: int) -> bool:
        return self.lo <= i <= self.hi and (self.some is None or i in self.some)


def edges(path: str) -> bytes:
    """The whole file, or its first and last EDGE bytes."""
    with storage.opened(path) as f:
        n = f.size()
        if n <= 2 * probe.EDGE:
            return f.read()
        head = f.read(probe.EDGE)
        f.seek(n - probe.EDGE)
        return head + f.read()


def shots(path: str, rows: Iterable[tuple[int, int, int]], base: tuple) -> Iterator[tuple]:
    """The frames of one video at (index, offset, size) that are JPEG."""
    with storage.opened(path) as f:
        for i, at, size in rows:
            f.seek(at)
            data = f.read(size)
            if data[:2] == b"\xff\xd8":
                yield (*base, i, data, None)


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.index, self.headers = options.get("path"), options.get("index"), options.get("headers", "false") == "true"
        self.stride = int(options.get("stride", "1"))
        self.per_task = int(options.get("framesPerTask", "512"))
        self.wanted = Wanted()
        if self.stride == 0:
            raise ValueError("stride must not be zero")

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        return [f for f in filters if self.headers or not self.wanted.take(f)]

    def partitions(self) -> list[FrameRanges] | list[Videos]:
        if self.index is None:
            return together(((p, n) for p, _, n in described(self.path) if self.wanted.sessions is None or session_of(p) in self.wanted.sessions), self.headers)
        out: list[FrameRanges] = []
        if self.stride < 0:
            return out
        step = self.per_task * self.stride
        for part in parts_of(self.index):
            with storage.opened(part) as f:
                footer = pq.ParquetFile(f).metadata
            left = 0  # of the frames that the last task may take
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                of = group.column(0).statistics if self.wanted.sessions is not None else None
                if of is not None and of.has_min_max and of.min not in self.wanted.sessions:
                    continue
                lo, hi = self.wanted.rows(group.num_rows)
                lo = -(-lo // self.stride) * self.stride
                for k in range(lo, hi, step):
                    n = -(-(min(hi, k + step) - k) // self.stride)
                    if n > left:
                        out.append(FrameRanges(part, [], self.stride))
                        left = self.per_task
                    out[-1].ranges.append((g, k, min(hi, k + step)))
                    left -= n
        return out

    def read(self, part: FrameRanges | Videos | None) -> Iterator[tuple]:
        if part is None:  # Spark's single task where there is nothing to plan
            return
        if isinstance(part, Videos):
            for path in part.paths:
                h = header(path)
                base = (session_of(path), path, h.fps, len(h.frames), h.width, h.height)
                if part.headers:
                    yield (*base, None, None, edges(path))
                elif self.stride > 0:
                    yield from shots(path, ((i, *at) for i, at in enumerate(h.frames) if i % self.stride == 0 and self.wanted.has(i)), base)
            return
        with storage.opened(part.part) as f:
            index = pq.ParquetFile(f)
            for group, lo, hi in part.ranges:
                rows = index.read_row_group(group).slice(lo, hi - lo)
                if not rows.num_rows:
                    continue
                base = tuple(rows.column(c)[0].as_py() for c in range(6))
                if self.wanted.sessions is not None and base[0] not in self.wanted.sessions:  # where statistics don't tell
                    continue
                own = rows.take(pa.array(np.arange(0, rows.num_rows, part.step)))
                places = zip(*(own.column(c).to_pylist() for c in ("frame_index", "offset", "size")), strict=True)
                yield from shots(base[1], (x for x in places if self.wanted.has(x[0])), base)


class Arrivals(DataSourceStreamReader):
    """The frames of videos as files come to a folder: an offset is the (time of change, name) of the newest file taken.

    Files have to come whole and not change (by a rename, or on a store that shows whole files).  One that shows up with
    an older time than a file that was taken is not seen; as the times are whole, files of one nanosecond are told
    apart by name.  With maxFiles, a batch takes at most so many; a file's task parses its head, and small files share one.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.most = options["path"], int(options.get("maxFiles", "0"))
        self.given = self.initialOffset()

    def initialOffset(self) -> dict:
        return {"time": -1, "name": ""}

    def _files(self, start: dict, end: dict | None = None) -> list[tuple[int, str, int]]:
        own = sorted((time, p, n) for p, time, n in storage.described(storage.joined(self.path, "*.avi")))
        return [x for x in own if (start["time"], start["name"]) < x[:2] and (end is None or x[:2] <= (end["time"], end["name"]))]

    def latestOffset(self) -> dict:
        new = self._files(self.given)
        if new:
            time, name, _ = new[: self.most or None][-1]
            self.given = {"time": time, "name": name}
        return self.given

    def partitions(self, start: dict, end: dict) -> list[Videos]:
        # a restarted query goes on from the offset of its log, not from this object's
        self.given = max(self.given, end, key=lambda o: (o["time"], o["name"]))
        return together(((p, n) for _, p, n in self._files(start, end)), False)

    def read(self, part: Videos) -> Iterator[tuple]:
        for path in part.paths:
            h = header(path)
            base = (session_of(path), path, h.fps, len(h.frames), h.width, h.height)
            yield from shots(path, ((i, *at) for i, at in enumerate(h.frames)), base)

    def commit(self, end: dict) -> None:
        pass


class MotionJpeg(DataSource):
    @classmethod
    def name(cls) -> str:
        return "mjpeg"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> Reader:  # noqa: ARG002
        return Reader(self.options)

    def streamReader(self, schema) -> Arrivals:  # noqa: ARG002
        return Arrivals(self.options)


def _registered(spark: SparkSession) -> None:
    spark.dataSource.register(MotionJpeg)
    spark.conf.set(PUSHDOWN, "true")  # else Spark refuses sources that take filters


def frames(spark: SparkSession, path: str, stride: int = 1, at: str | None = None) -> DataFrame:
    """The frames of the videos below path; at: their index, if there is one (it is written first otherwise)."""
    _registered(spark)
    return spark.read.format("mjpeg").option("stride", stride).option("index", at or index(spark, path)).load().drop("edges")


def headers(spark: SparkSession, path: str) -> DataFrame:
    """One row for each video, with its focal length where the container tells it."""
    _registered(spark)
    known = spark.read.format("mjpeg").option("headers", "true").load(path).drop("frame_index", "jpeg")
    return known.withColumn("focal_length_35mm", probe.focal_35mm(probe.as_text(F.col("edges")))).drop("edges")


def stream(spark: SparkSession, path: str, most_files: int = 0) -> DataFrame:
    """The frames of the videos that come to a folder, as a stream; most_files: of a micro-batch (0: all)."""
    _registered(spark)
    return spark.readStream.format("mjpeg").option("maxFiles", most_files).load(path).drop("edges")


def avi(jpegs: list[bytes], fps: int, width: int, height: int, with_index: bool = True) -> bytes:
    """A plain motion JPEG file's bytes."""
    chunk = lambda k, d: k + struct.pack("<I", len(d)) + d + b"\0" * (len(d) & 1)
    lst = lambda k, d: chunk(b"LIST", k + d)
    avih = struct.pack("<14I", 1000000 // fps, 0, 0, 0, len(jpegs), 0, 1, 0, width, height, 0, 0, 0, 0)
    strh = struct.pack("<4s4sIHHIIIIIIIIHHHH", b"vids", b"MJPG", 0, 0, 0, 0, 1, fps, 0, len(jpegs), 0, 0, 0, 0, 0, width, height)
    strf = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    frames = [chunk(b"00dc", j) for j in jpegs]
    offset = np.cumsum([4, *map(len, frames)])[:-1].tolist()
    index = b"".join(struct.pack("<4sIII", b"00dc", 16, o, len(j)) for o, j in zip(offset, jpegs, strict=True)) if with_index else b""
    body = lst(b"hdrl", chunk(b"avih", avih) + lst(b"strl", chunk(b"strh", strh) + chunk(b"strf", strf))) + lst(b"movi", b"".join(frames)) + (chunk(b"idx1", index) if with_index else b"")
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"AVI " + body


def write_avi(path: str, jpegs: list[bytes], fps: int, width: int, height: int, with_index: bool = True) -> None:
    """A plain motion JPEG file, for tests and exports."""
    storage.replaced(path, avi(jpegs, fps, width, height, with_index))
