"""The 35 mm focal length from a container's metadata bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes read at either end of a large file.
EDGE = 8 * 1024 * 1024
#: Patterns (fixed values).
XMP = r"(?i)FocalLengthIn35mmFilm[^0-9]{0,4}(\d+)(?:/(\d+))?"
APPLE = "com.apple.quicktime.camera.focal_length.35mm_equivalent"
NUMBER = r"(\d+(?:\.\d+)?)"
#: Plausible focal lengths in mm, bounds included.
LEAST, MOST = 10.0, 200.0


def as_text(content: Column) -> Column:
    return F.decode(content, "ISO-8859-1")


def edges(content: Column) -> Column:
    """The bytes that are searched: the whole content, or both its ends if it is larger than they are."""
    n = F.octet_length(content)
    return F.when(n <= 2 * EDGE, content).otherwise(F.concat(F.substring(content, 1, EDGE), F.substring(content, -EDGE, EDGE)))


def plausible(v: Column) -> Column:
    return v.between(LEAST, MOST)


def candidates(text: Column, pattern: str = XMP) -> Column:
    """Values of all hits in order; a fraction with a zero denominator is none."""
    whole, under = (F.regexp_extract_all(text, F.lit(pattern), F.lit(k)) for k in (1, 2))
    value = lambda a, b: F.try_divide(a.cast("double"), F.when(b == "", F.lit(1.0)).otherwise(b.cast("double")))
    return F.filter(F.zip_with(whole, under, value), lambda v: v.isNotNull())


def apple(text: Column, name: str = APPLE) -> Column:
    """The number within 64 bytes after the first place of the key."""
    at = F.instr(text, name)
    after = F.substring(text, at + len(name), F.lit(64))
    return F.when(at > 0, F.nullif(F.regexp_extract(after, NUMBER, 1), F.lit(""))).cast("double")


def focal_35mm(text: Column) -> Column:
    """The first plausible value: the XMP hits in file order, then the Apple key; else null."""
    every = F.concat(candidates(text), F.filter(F.array(apple(text)), lambda v: v.isNotNull()))
    return F.try_element_at(F.filter(every, plausible), F.lit(1))
