"""The five programs, from files to files, with their parameters.

Folders: ``out/<session>/`` holds a session's frames, metadata.json, detections.json, manifest.json, and below filtered/
the kept frames and filtered/masks/.  Every step reads what the step before wrote, over all sessions at once.  An
argument that is not given comes from the settings.  A broken document stops a program; with rejected, a folder, it
becomes a row of the table there and the other sessions go on.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake import settings as S
from framelake.functions import records
from framelake.operators import documents, quality, raster, selection, tracking
from framelake.sources import files, sinks, video

def extract(spark: SparkSession, path: str, out: str, stride: int | None = None, settings: S.Settings | None = None) -> DataFrame:
    """Video files to frames and metadata.json; returns the sampled frames."""
    stride = S.first_given(stride, (settings or S.Settings()).frame_extraction.stride)
    S.check_video(path)
    shots = video.frames(spark, path, stride)
    counted, seen = sinks.counted(shots, "frames")
    sinks.jpeg_frames(counted, out)
    sinks.told(seen, "frames extracted")
    rows = shots.select("session_id", records.frame(F.col("frame_index"), F.col("fps"), F.col("total_frames")).alias("f")).select("session_id", "f.*")
    docs = documents.video_metadata(video.headers(spark, path), rows, stride)
    sinks.json_documents(docs, records.encoded(F.col("metadata"), "VIDEO"), out, "metadata.json")
    return rows


def detect(spark: SparkSession, out: str, words: np.ndarray, dictionary: str | None = None, settings: S.Settings | None = None, rejected: str | None = None) -> DataFrame:
    """Frames to detections.json; words: the dictionary's code words (raster.words_from reads a table)."""
    name = S.first_given(dictionary, (settings or S.Settings()).dictionary)
    S.dictionary_code(name)
    meta = files.accepted(spark, f"{out}/*/metadata.json", "VIDEO", rejected)
    found = raster.detections(files.images(spark, f"{out}/*/*.jpg"), words)
    rows = selection.detections(files.table_of(meta, "frames").drop("timestamp_s"), found, ["session_id", "filename"])
    docs = documents.detections_document(rows, meta.select("session_id", "record.frames_extracted"), name)
    sinks.json_documents(docs, records.encoded(F.col("document"), "DETECTIONS"), out, "detections.json")
    return rows


def choose(spark: SparkSession, out: str, min_markers: int | None = None, valid_ids: list[int] | None = None, settings: S.Settings | None = None, rejected: str | None = None) -> DataFrame:
    """Blur fence over all readable frames, whitelist, least count, existing files: copies to filtered/ and manifest.json."""
    own = (settings or S.Settings()).frame_filtering
    least, valid = S.first_given(min_markers, own.min_markers), S.first_given(valid_ids, own.valid_ids)
    docs = files.accepted(spark, f"{out}/*/detections.json", "DETECTIONS", rejected)
    rows = files.table_of(docs, "detections").withColumn("markers", records.zipped(F.col("marker_ids"), F.col("corners"))).drop("marker_ids", "corners")
    images = files.readable(files.images(spark, f"{out}/*/*.jpg"))
    scores = rows.join(images.select("session_id", "filename", raster.sharpness().alias("score")), ["session_id", "filename"]).select("session_id", "filename", "score")
    figures = quality.fence(scores, ["session_id"])
    blurred = quality.rejects(scores, figures, ["session_id"])
    kept = selection.select(rows, least, valid, blurred, files.listing(spark, f"{out}/*/*.jpg"))
    counted, seen = sinks.counted(kept, "kept")
    sinks.copies(counted, out, out)
    sinks.told(seen, "frames kept")
    totals = rows.groupBy("session_id").agg(F.count("*").alias("total_frames_input"))
    meta = files.accepted(spark, f"{out}/*/metadata.json", "VIDEO", rejected).select("session_id", "record.focal_length_35mm", "record.resolution.width", "record.resolution.height")
    name = docs.select("record.dictionary").first()
    made = documents.selection_document(kept, totals, name[0] if name else "", least, quality.sharpness_block(figures, blurred, ["session_id"]), documents.camera(totals, meta))
    sinks.json_documents(made, records.encoded(F.col("manifest"), "SELECTION"), out, "manifest.json")
    return kept


def mask(spark: SparkSession, out: str, tracker: type = tracking.BoxTracker, rejected: str | None = None, device: str = "cpu", cpus: int = 1) -> DataFrame:
    """Kept frames to mask files and an updated manifest.json; returns each session's record.

    device, cpus: what a tracker's task asks for on a cluster (settings.tracker_profile).
    """
    docs = files.accepted(spark, f"{out}/*/manifest.json", "SELECTION", rejected).withColumnRenamed("record", "manifest")
    images = files.images(spark, f"{out}/*/*.jpg")
    rows = documents.markers_of(docs).join(images, ["session_id", "filename"])
    data = rows.select("session_id", "frame_index", "filename", "image.height", "image.width", F.when(F.col("image.height") >= 0, F.col("image.data")).alias("data"), F.transform("markers", lambda m: m["corners"]).alias("corners"))
    done = tracking.masks(data, tracker, S.tracker_profile(spark, device, cpus))
    counted, seen = sinks.counted(done, "masks")
    sinks.mask_files(counted, out)
    sinks.told(seen, "masks made")
    stats = tracking.mask_stats(done, tracker().info)
    made = sinks.updated_manifest(docs, stats, "masks")
    sinks.json_documents(made, records.encoded(F.col("manifest"), "SELECTION"), out, "manifest.json")
    return stats


def sheet(spark: SparkSession, out: str, words: np.ndarray, num_markers: int | None = None, side_pixels: int | None = None, margin_pixels: int | None = None, dictionary: str | None = None, dpi: int | None = None, page_format: str | None = None, settings: S.Settings | None = None) -> DataFrame:
    """Marker images, the sheet's manifest.json and sheet.pdf; returns the markers' places on the pages."""
    given = dict(num_markers=num_markers, side_pixels=side_pixels, margin_pixels=margin_pixels, dictionary=dictionary, dpi=dpi, page_format=page_format)
    own = S.overlay((settings or S.Settings()).markers, {k: v for k, v in given.items() if v is not None})
    S.dictionary_code(own.dictionary)
    if not 0 < own.num_markers <= len(words):
        raise ValueError(f"{own.num_markers} markers were asked for, the dictionary has {len(words)}")
    some = words[: own.num_markers]
    sinks.marker_files(raster.marker_images(spark, some, own.side_pixels, own.margin_pixels), out)
    record = documents.sheet_manifest(spark, own)
    sinks.json_documents(record.withColumn("session_id", F.lit("")), records.encoded(F.col("sheet"), "SHEET"), out, "manifest.json")
    side, page = own.side_pixels / own.dpi * 25.4, S.page_size(own.page_format)
    places = documents.pages_layout(spark.range(own.num_markers).withColumnRenamed("id", "i"), side, page).orderBy("i")
    cells = [(r["page"], r["x"], r["y"]) for r in places.collect()]  # a row for each marker of a dictionary
    sinks.sheet_pdf([raster.marker(w, own.side_pixels) for w in some], [str(i) for i in range(len(some))], cells, side, page, f"{out}/sheet.pdf")
    return places
