"""Documents: one record for each session, assembled from tables and taken apart again."""

from __future__ import annotations

import platform

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.settings import Sheet


def tool_versions() -> F.Column:
    import numpy as np

    return F.struct(F.lit(platform.python_version()).alias("python"), F.lit("none").alias("opencv"), F.lit(np.__version__).alias("numpy"))


def video_metadata(videos: DataFrame, frames: DataFrame, stride: int) -> DataFrame:
    """session_id, metadata: the extraction's document; frames in order, focal length where known."""
    own = frames.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("frame_index", "timestamp_s", "filename"))).alias("frames"))
    rows = videos.join(own, "session_id", "left").withColumn("frames", F.coalesce("frames", F.array().cast("array<struct<frame_index:int,timestamp_s:double,filename:string>>")))
    doc = F.struct("source_video", "fps", "total_frames", F.struct("width", "height").alias("resolution"), F.lit(stride).alias("stride"), F.size("frames").alias("frames_extracted"), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("extracted_at"), F.lit("none").alias("opencv_version"), "frames", "focal_length_35mm")
    return rows.select("session_id", doc.alias("metadata"))


def detections_document(found: DataFrame, videos: DataFrame, dictionary: str) -> DataFrame:
    """session_id, document; total_frames is the number of frames that were extracted, not the video's."""
    entry = F.struct("frame_index", "filename", "markers_detected", F.transform("markers", lambda m: m["id"]).alias("marker_ids"), F.transform("markers", lambda m: m["corners"]).alias("corners"))
    own = found.groupBy("session_id").agg(F.count_if(F.col("markers_detected") > 0).cast("int").alias("with"), F.array_sort(F.collect_list(entry)).alias("d"))
    rows = own.join(videos.select("session_id", "frames_extracted"), "session_id", "left")
    ordered = F.transform("d", lambda e: F.struct(e["filename"].alias("filename"), e["frame_index"].alias("frame_index"), e["markers_detected"].alias("markers_detected"), e["marker_ids"].alias("marker_ids"), e["corners"].alias("corners")))
    return rows.select("session_id", F.struct(F.lit(dictionary).alias("dictionary"), F.col("frames_extracted").alias("total_frames"), F.col("with").alias("frames_with_detections"), ordered.alias("detections")).alias("document"))


def last_wins(rows: DataFrame, group: list[str], name: str, value: str, position: str) -> DataFrame:
    """group, entries: a map of name to the value with the last position; names in order."""
    each = rows.groupBy(*group, name).agg(F.max_by(value, position).alias("v"))
    return each.groupBy(*group).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(name, "v")))).alias("entries"))


def camera(sessions: DataFrame, videos: DataFrame) -> DataFrame:
    """session_id, camera of each session; null without metadata, with null fields where those lack."""
    block = F.struct("focal_length_35mm", F.col("width").alias("width_px"), F.col("height").alias("height_px"))
    known = videos.select("session_id", block.alias("camera"))
    return sessions.select("session_id").distinct().join(known, "session_id", "left")


def selection_document(kept: DataFrame, totals: DataFrame, dictionary: str, min_markers: int, sharpness: DataFrame | None = None, cameras: DataFrame | None = None) -> DataFrame:
    """session_id, manifest: kept frames in order, their markers by filename (the last of a repeated name), figures.

    totals: session_id, total_frames_input.  Sessions that lost all frames have a manifest with empty lists.
    """
    frames = kept.groupBy("session_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("frame_index", "filename"))), lambda f: f["filename"]).alias("frames"))
    marks = last_wins(kept, ["session_id"], "filename", "markers", "frame_index").withColumnRenamed("entries", "marker_detections")
    rows = totals.join(frames, "session_id", "left").join(marks, "session_id", "left")
    kind = kept.schema["markers"].dataType.simpleString()
    rows = rows.withColumn("frames", F.coalesce("frames", F.array().cast("array<string>"))).withColumn("marker_detections", F.coalesce("marker_detections", F.create_map().cast(f"map<string,{kind}>")))
    for extra, name in ((sharpness, "sharpness"), (cameras, "camera")):
        rows = rows.join(extra.select("session_id", name), "session_id", "left") if extra is not None else rows.withColumn(name, F.lit(None).cast({"sharpness": "struct<metric:string,mad_k:double,frames_scored:int,threshold:double,median:double,mad:double,frames_rejected:int>", "camera": "struct<focal_length_35mm:double,width_px:int,height_px:int>"}[name]))
    doc = F.struct(F.lit(dictionary).alias("dictionary"), F.lit(min_markers).alias("min_markers"), F.col("total_frames_input").cast("int").alias("total_frames_input"), (F.col("total_frames_input") - F.size("frames")).cast("int").alias("frames_filtered_out"), "frames", "marker_detections", "sharpness", tool_versions().alias("tool_versions"), "camera", F.lit(None).cast("string").alias("mask_dir"), F.lit(None).cast("struct<frames_tracked:int>").alias("mask_generation"))
    return rows.select("session_id", doc.alias("manifest"))


def markers_of(manifests: DataFrame) -> DataFrame:
    """Each frame of a manifest with its markers; a name that the map lacks has none."""
    rows = manifests.select("session_id", "manifest.marker_detections", F.posexplode("manifest.frames").alias("frame_index", "filename"))
    got = F.try_element_at("marker_detections", F.col("filename"))
    none = F.array().cast(manifests.schema["manifest"].dataType["marker_detections"].dataType.valueType)
    return rows.select("session_id", "frame_index", "filename", F.coalesce(got, none).alias("markers"))


def total_side(sheet: Sheet) -> F.Column:
    """Pixels of a marker's image with its margins."""
    return F.lit(sheet.side_pixels) + 2 * F.lit(sheet.margin_pixels)


def sheet_manifest(spark: SparkSession, sheet: Sheet) -> DataFrame:
    """sheet: the record of a set of marker images, one row."""
    side = total_side(sheet)
    ids = F.sequence(F.lit(0), F.lit(sheet.num_markers - 1))
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    mm = F.round(side / F.lit(sheet.dpi) * 25.4, 3)
    record = F.struct(F.lit(sheet.dictionary).alias("dictionary"), F.lit(sheet.num_markers).alias("num_markers"), ids.alias("ids"), F.lit(sheet.side_pixels).alias("side_pixels"), F.lit(sheet.margin_pixels).alias("margin_pixels"), side.alias("total_image_side_pixels"), F.lit(sheet.dpi).alias("dpi"), mm.alias("total_image_side_mm"), now.alias("generated_at"))
    return spark.range(1).select(record.alias("sheet"))


def source_counts(rows: DataFrame, by: list[str], source: str = "source") -> DataFrame:
    """How many frames each source gave; sources that gave none are there with 0."""
    names = ("tracked", "dino", "aruco_box", "fallback_full")
    return rows.groupBy(*by).agg(*[F.count_if(F.col(source) == n).alias(f"frames_{n}") for n in names])


def pages_layout(markers: DataFrame, side_mm: float, page: tuple[float, float], margin: float = 15.0, gap: float = 8.0, label: float = 6.0, index: str = "i") -> DataFrame:
    """page, col, row, x, y of the i-th marker on sheets of that size."""
    cols = max(1, int((page[0] - 2 * margin) // (side_mm + gap)))
    rows = max(1, int((page[1] - 2 * margin) // (side_mm + label + gap)))
    i = F.col(index)
    pos = i % (cols * rows)
    return markers.withColumns({"page": F.floor(i / (cols * rows)), "col": pos % cols, "row": F.floor(pos / cols)}).withColumns({"x": margin + F.col("col") * (side_mm + gap), "y": margin + F.col("row") * (side_mm + label + gap)})
