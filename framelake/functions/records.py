"""Records as column expressions: frames, markers, JSON with and without nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from framelake import schemas


def timestamp_s(index: Column, fps: Column) -> Column:
    return F.round(index / fps, 4)


def frame_filename(index: Column, total: Column) -> Column:
    """frame_<index, as wide as the total>.jpg; an index is below the total, so padding never cuts."""
    return F.concat(F.lit("frame_"), F.lpad(index.cast("string"), F.length(total.cast("string")), F.lit("0")), F.lit(".jpg"))


def frame(index: Column, fps: Column, total: Column) -> Column:
    return F.struct(index.cast("int").alias("frame_index"), timestamp_s(index, fps).alias("timestamp_s"), frame_filename(index, total).alias("filename"))


def zipped(ids: Column, corners: Column) -> Column:
    """Markers as struct(id, corners); the shorter list decides how many."""
    n = F.least(F.size(ids), F.size(corners))
    return F.transform(F.slice(ids, 1, n), lambda i, k: F.struct(i.alias("id"), F.element_at(corners, k + 1).alias("corners")))


def whitelisted(markers: Column, valid_ids: list[int] | None) -> Column:
    """Markers with a valid id, in order, repeats kept; None keeps all, an empty list none."""
    if valid_ids is None:
        return markers
    known = F.array(*map(F.lit, sorted(set(valid_ids)))) if valid_ids else F.array().cast("array<int>")
    return F.filter(markers, lambda m: F.array_contains(known, m["id"]))


def mm(pixels: Column, dpi: Column) -> Column:
    return pixels / dpi * 25.4


def label(path: Column) -> Column:
    """The last _-part of a file's stem."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]+)$", 1), r"\.[^.]*$", "")
    return F.element_at(F.split(stem, "_"), -1)


def missing_keys(raw: Column, required: list[str]) -> Column:
    """Required keys that a JSON object lacks; a key with a null value is there."""
    return F.array_except(F.array(*map(F.lit, required)), F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>")))


def decoded(raw: Column, name: str, source: Column | str = "document") -> Column:
    """A record from JSON text; missing required keys raise an error that names them and the source."""
    source = F.lit(source) if isinstance(source, str) else source
    lack = missing_keys(raw, schemas.required(name))
    fail = F.raise_error(F.concat(source, F.lit(": missing keys "), F.array_join(lack, ", ")))
    return F.when(F.size(lack) > 0, fail.cast(schemas.RECORDS[name])).otherwise(F.from_json(raw, schemas.RECORDS[name], {"mode": "FAILFAST"}))


def encoded(record: Column, name: str) -> Column:
    """JSON text of a record: optional keys of the top level are left out when null, nested nulls are kept."""
    optional = schemas.OPTIONAL.get(name, set())
    keep = {"ignoreNullFields": "false"}
    must = F.to_json(F.struct(*[record[f].alias(f) for f in schemas.required(name)]), keep)
    blocks = [F.when(record[f.name].isNotNull(), F.substring(t := F.to_json(F.struct(record[f.name].alias(f.name)), keep), F.lit(2), F.length(t) - 2)) for f in schemas.RECORDS[name] if f.name in optional]
    return F.concat(F.substring(must, F.lit(1), F.length(must) - 1), F.array_join(F.transform(F.filter(F.array(*blocks), lambda b: b.isNotNull()), lambda b: F.concat(F.lit(","), b)), ""), F.lit("}")) if blocks else must
