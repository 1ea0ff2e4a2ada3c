"""Language ID by compression.

A raw-content zstandard dictionary is made for each language from a bounded sample of labelled documents, whole texts
only.  Texts and samples are lower-cased and every run of other characters than letters becomes one space.  A text is
cut into slices, each slice is compressed with every dictionary, and the language with the smallest total wins.  The
score tells how much smaller its total is than the next one's; ``rejected`` marks narrow margins.

Bounds of the sample, all parameters: ``per_lang`` documents of each language in expectation, none of more than
``longest`` bytes, and ``lang_bytes`` bytes of them together.  Every text is read whole for its prediction.

A text that is null or has no letter gets ``und`` with score 0.  With no labelled document at all every text is
``und``.  Ties go to the smaller language name.  Rows are independent: repeated rows give equal result rows, and
columns other than doc_id and text are never read for a prediction.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framelake.llm.bpe import pieces
from framelake.llm.common import small_batches

LETTER = re.compile(r"[^\W\d_]")
OTHER = re.compile(r"[\W\d_]+")


def dictionaries(docs: DataFrame, usable: Column, per_lang: int = 320, longest: int = 16384, lang_bytes: int = 400_000) -> dict[str, bytes]:
    """The dictionary of each language: whole texts in the order of the hash of their id."""
    known = docs.where(usable & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (F.octet_length("text") <= longest))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not counts:
        return {}
    rate = F.element_at(F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, per_lang / n)))]), F.col("lang"))
    drawn = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit(10)), F.lit(1 << 30)) < rate * (1 << 30))
    rows = drawn.select("lang", "text").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * per_lang * len(counts)).collect()
    out: dict[str, list[bytes]] = {}
    for r in rows:
        own, new = out.setdefault(r["lang"], []), letters(r["text"])
        if new.strip() and sum(map(len, own)) + len(new) <= lang_bytes:
            own.append(new)
    return {k: b" ".join(v) for k, v in sorted(out.items()) if v}


def letters(text: str) -> bytes:
    return OTHER.sub(" ", text.lower()).encode("utf-8", "replace")


class Compared:
    """The totals of a text under each language's dictionary."""

    def __init__(self, dicts: dict[str, bytes], level: int, slice_bytes: int) -> None:
        import zstandard as z

        self.langs = sorted(dicts)
        self.slice = slice_bytes
        self.with_dict = [z.ZstdCompressor(level=level, dict_data=z.ZstdCompressionDict(dicts[k], dict_type=z.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False) for k in self.langs]

    def sizes(self, text: str) -> list[int]:
        raw = letters(text)
        cut = [raw[i : i + self.slice] for i in range(0, len(raw), self.slice)]
        return [sum(len(c.compress(x)) for x in cut) for c in self.with_dict]

    def best(self, text: str | None) -> tuple[str, float]:
        if not text or not self.langs or not LETTER.search(text):
            return "und", 0.0
        s = np.asarray(self.sizes(text), float)
        i = int(s.argmin())
        if len(s) == 1:
            return self.langs[0], 1.0
        rest = np.delete(s, i)
        # bytes saved against each other language, in units of what such totals vary by
        return self.langs[i], float(1 / (1 + np.exp(-(rest - s[i]) / (1 + 0.15 * np.sqrt(s[i]))).sum()))


def predict(docs: DataFrame, dicts: dict[str, bytes], level: int = 3, slice_bytes: int = 4096, margin: float = 0.6) -> DataFrame:
    """doc_id, lang_pred, score, rejected (score below margin)."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(dicts)  # a sample of bounded size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Compared(sent.value, level, slice_bytes)
        for b in pieces(batches):
            got = [by.best(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()), pa.array([g[1] < margin for g in got], pa.bool_())], ["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
