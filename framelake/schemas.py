"""The records as Spark types, and which of their keys must be there."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def record(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


CORNERS = T.ArrayType(T.ArrayType(D))
FRAME = record(frame_index=I, timestamp_s=D, filename=S)
RESOLUTION = record(width=I, height=I)
VIDEO = record(source_video=S, fps=D, total_frames=I, resolution=RESOLUTION, stride=I, frames_extracted=I, extracted_at=S, opencv_version=S, frames=T.ArrayType(FRAME), focal_length_35mm=D)
DETECTION = record(filename=S, frame_index=I, markers_detected=I, marker_ids=T.ArrayType(I), corners=T.ArrayType(CORNERS))
DETECTIONS = record(dictionary=S, total_frames=I, frames_with_detections=I, detections=T.ArrayType(DETECTION))
MARKER = record(id=I, corners=CORNERS)
SHARPNESS = record(metric=S, mad_k=D, frames_scored=I, threshold=D, median=D, mad=D, frames_rejected=I)
CAMERA = record(focal_length_35mm=D, width_px=I, height_px=I)
TOOLS = record(python=S, opencv=S, numpy=S)
MASKING = record(frames_tracked=I, frames_dino=I, frames_aruco_box=I, frames_fallback_full=I, reanchors=I, track_resets=I, text_prompt=S, detector_model=S, segmenter_model=S, device=S)
SELECTION = record(dictionary=S, min_markers=I, total_frames_input=I, frames_filtered_out=I, frames=T.ArrayType(S), marker_detections=T.MapType(S, T.ArrayType(MARKER)), sharpness=SHARPNESS, tool_versions=TOOLS, camera=CAMERA, mask_dir=S, mask_generation=MASKING)
SHEET = record(dictionary=S, num_markers=I, ids=T.ArrayType(I), side_pixels=I, margin_pixels=I, total_image_side_pixels=I, dpi=I, total_image_side_mm=D, generated_at=S)

#: Keys that may be missing; all others are required.
OPTIONAL = {"VIDEO": {"focal_length_35mm"}, "SELECTION": {"sharpness", "tool_versions", "camera", "mask_dir", "mask_generation"}}
RECORDS = {"FRAME": FRAME, "VIDEO": VIDEO, "DETECTION": DETECTION, "DETECTIONS": DETECTIONS, "MARKER": MARKER, "SELECTION": SELECTION, "SHEET": SHEET}


def required(name: str) -> list[str]:
    return [f.name for f in RECORDS[name] if f.name not in OPTIONAL.get(name, ())]
