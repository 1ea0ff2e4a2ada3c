"""Sinks: files of bytes, JSON documents, copies, a PDF of marker sheets."""

from __future__ import annotations

import json
import logging
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from framelake.sources import committed, storage


def bytes_files(rows: DataFrame, folder: str, name: str, data: str, tries: int = 1) -> str:
    """A file for each row, committed as one job, under a folder that all executors share."""
    return committed.write(rows.select(F.col(name).alias("name"), F.col(data).cast("binary").alias("data")), folder, tries)


def jpeg_frames(frames: DataFrame, folder: str) -> str:
    from framelake.functions.records import frame_filename

    name = F.concat_ws("/", "session_id", frame_filename(F.col("frame_index"), F.col("total_frames")))
    return bytes_files(frames.withColumn("name", name), folder, "name", "jpeg")


def mask_files(masks: DataFrame, folder: str) -> str:
    return bytes_files(masks.withColumn("name", F.concat("session_id", F.lit("/filtered/masks/"), "filename", F.lit(".png"))), folder, "name", "png")


def marker_files(markers: DataFrame, folder: str) -> str:
    return bytes_files(markers.withColumn("name", F.concat(F.lit("marker_"), "id", F.lit(".png"))), folder, "name", "png")


def copies(rows: DataFrame, source: str, to: str) -> str:
    """Copies the files of (session_id, filename), with their times on a mount, as one job; missing ones are skipped."""
    at = F.concat_ws("/", F.lit(source.rstrip("/")), "session_id", "filename")
    return committed.write(rows.select(F.concat_ws("/", "session_id", F.lit("filtered"), "filename").alias("name"), at.alias("source")), to)


def json_documents(docs: DataFrame, text: Column, folder: str, name: str) -> str:
    """A JSON file for each session, indented by 2, as one job; older ones are replaced once all are there, so a plan may read them."""
    path = F.when(F.col("session_id") == "", F.lit(name)).otherwise(F.concat_ws("/", "session_id", F.lit(name)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([json.dumps(json.loads(t), indent=2).encode() for t in b.column(1).to_pylist()], pa.binary())], ["name", "data"])

    return committed.write(docs.select(path.alias("name"), text.alias("text")).mapInArrow(run, "name string, data binary"), folder)


def updated_manifest(old: DataFrame, stats: DataFrame, mask_dir: str) -> DataFrame:
    """Manifests with the mask stage's results; a new table, as a plan must not overwrite what it reads."""
    rows = old.join(stats.select("session_id", F.struct(*[c for c in stats.columns if c != "session_id"]).alias("__stats")), "session_id", "left")
    done = F.col("__stats").isNotNull()
    return rows.withColumn("manifest", F.col("manifest").dropFields("mask_dir", "mask_generation")).withColumn("manifest", F.col("manifest").withField("mask_dir", F.when(done, F.lit(mask_dir))).withField("mask_generation", F.col("__stats"))).drop("__stats")


def counted(rows: DataFrame, what: str) -> tuple[DataFrame, Observation]:
    """The same rows and an observation whose get() tells their number once an action has run."""
    seen = Observation(what)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def told(seen: Observation, what: str) -> None:
    """Logs what an action has counted."""
    logging.getLogger("framelake").info("%s: %d rows", what, seen.get["rows"])


def sheet_pdf(rasters: list, labels: list[str], cells: list[tuple[int, float, float]], side_mm: float, page: tuple[float, float], path: str) -> None:
    """Marker sheets as a PDF: gray rasters at (page, x, y) in mm with a label, and a scale bar on each page."""
    pt = 72 / 25.4
    objects: list[bytes] = [b"", b"", b"<< /Type /Font /Subtype /Type1 /BaseFont /Helvetica >>"]
    pages: dict[int, list] = {}
    for raster, label, (p, x, y) in zip(rasters, labels, cells, strict=True):
        h, w = raster.shape
        data = zlib.compress(raster.tobytes())
        objects.append(b"<< /Type /XObject /Subtype /Image /Width %d /Height %d /ColorSpace /DeviceGray /BitsPerComponent 8 /Filter /FlateDecode /Length %d >>\nstream\n%s\nendstream" % (w, h, len(data), data))
        pages.setdefault(p, []).append((len(objects), label, x, y))
    kids = []
    for p in sorted(pages):
        draw = [f"0.85 w {15 * pt:.2f} {(page[1] - 8) * pt:.2f} m {25 * pt:.2f} {(page[1] - 8) * pt:.2f} l S BT /F 8 Tf {15 * pt:.2f} {(page[1] - 12) * pt:.2f} Td (10 mm) Tj ET"]
        for n, label, x, y in pages[p]:
            s = side_mm * pt
            draw.append(f"q {s:.3f} 0 0 {s:.3f} {x * pt:.3f} {(page[1] - y - side_mm) * pt:.3f} cm /I{n} Do Q BT /F 8 Tf {x * pt:.2f} {(page[1] - y - side_mm - 4) * pt:.2f} Td (ID {label}) Tj ET")
        body = "\n".join(draw).encode("latin-1")
        objects.append(b"<< /Length %d >>\nstream\n%s\nendstream" % (len(body), body))
        images = " ".join(f"/I{n} {n} 0 R" for n, *_ in pages[p])
        objects.append(f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {page[0] * pt:.2f} {page[1] * pt:.2f}] /Contents {len(objects)} 0 R /Resources << /Font << /F 3 0 R >> /XObject << {images} >> >> >>".encode())
        kids.append(len(objects))
    objects[0] = b"<< /Type /Catalog /Pages 2 0 R >>"
    objects[1] = f"<< /Type /Pages /Count {len(kids)} /Kids [{' '.join(f'{k} 0 R' for k in kids)}] >>".encode()
    out, at = b"%PDF-1.4\n", []
    for i, o in enumerate(objects, 1):
        at.append(len(out))
        out += b"%d 0 obj\n%s\nendobj\n" % (i, o)
    table = b"".join(b"%010d 00000 n \n" % a for a in at)
    out += b"xref\n0 %d\n0000000000 65535 f \n%strailer\n<< /Size %d /Root 1 0 R >>\nstartxref\n%d\n%%%%EOF\n" % (len(at) + 1, table, len(at) + 1, len(out))
    storage.replaced(path, out)
