"""Frame sampling and selection: stride, detections, blur rejection, whitelist, least marker count, existing files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from framelake.functions import records


def strided(frames: DataFrame, stride: int, index: str = "frame_index") -> DataFrame:
    """Every stride-th index from 0 on; a stride of 0 is an error, a negative one gives no rows."""
    if stride == 0:
        raise ValueError("stride must not be zero")
    return frames.where(F.col(index) % stride == 0) if stride > 0 else frames.where(F.lit(False))


def sample_indices(videos: DataFrame, stride: int) -> DataFrame:
    """A row with frame (index, timestamp, filename) for each sampled index of each video: session_id, fps, total_frames."""
    if stride == 0:
        raise ValueError("stride must not be zero")
    some = videos.where((F.col("total_frames") > 0) & F.lit(stride > 0))
    rows = some.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("total_frames") - 1, F.lit(abs(stride)))))
    return rows.select("session_id", records.frame(F.col("i"), F.col("fps"), F.col("total_frames")).alias("frame")).select("session_id", "frame.*")


def numbered(rows: DataFrame, session: list[str], order: list[str], name: str = "frame_index") -> DataFrame:
    """Position within the session, from 0."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*session).orderBy(*order)).cast("long") - 1)


def detections(frames: DataFrame, found: DataFrame, on: list[str]) -> DataFrame:
    """Every frame with its markers; frames that were unreadable or show none have an empty list and count 0."""
    out = frames.join(found, on, "left")
    empty = F.array().cast(found.schema["markers"].dataType)
    return out.withColumn("markers", F.coalesce("markers", empty)).withColumn("markers_detected", F.size("markers"))


def select(rows: DataFrame, min_markers: int = 1, valid_ids: list[int] | None = None, rejected: DataFrame | None = None, existing: DataFrame | None = None, on: list[str] | None = None) -> DataFrame:
    """Keeps frames that are not rejected, have enough (valid) markers and, if asked, an existing file.

    Without a whitelist the stored count decides; with one, markers are stripped first and counted anew.
    """
    on = on or ["session_id", "filename"]
    if rejected is not None:
        rows = rows.join(rejected.select(*on).distinct(), on, "left_anti")
    if valid_ids is not None:
        rows = rows.withColumn("markers", records.whitelisted(F.col("markers"), valid_ids)).withColumn("markers_detected", F.size("markers"))
    rows = rows.where(F.col("markers_detected") >= min_markers)
    return rows.join(existing.select(*on).distinct(), on, "left_semi") if existing is not None else rows
