"""WARC archives: writing with revisits, and reading in parallel by chains of record boundaries.

Writing: every page is one record of type response, whose block is an HTTP response with the page as its payload; a page
whose payload another page of smaller id has, byte for byte by SHA-256, becomes a revisit of that page's record, without
the payload.  Each task writes files of its own under names that no other attempt has, and the manifest, a table in the
shared folder, names those of the attempts that counted, so a task that is tried again leaves no record twice.

Reading: an archive has no index, and the bytes that begin a record may stand in a payload too.  Files are cut into ranges,
and each range is one task's work, which emits every place where a record could begin with the place where that record's
successor would: its head is parsed and its length added.  A record is real if the chain of successors from the file's
start reaches it.  As a task sees all candidates of its range, it lets each point past the range at once; from there on
Spark jumps pointers: each round lets the candidates that are known to be reached reach on and doubles all pointers, so
ranges r of a file take log2(r) rounds.  Then every range knows the first real record in it, if there is one, and its
records are read from there; false candidates are never opened.  A chain that doesn't end with its file is an error that
names the file, or, if asked, what it reaches is kept.

Null pages have an empty payload.  Null urls and ids are left out of the head and read back as null; rows without an id are
responses that nothing refers to.  Of rows that repeat id and payload each that has the smallest id is a response.  Line
ends in urls are percent-encoded, as a head is made of lines.  An empty table gives no files and an empty result.  Further
columns are left out, whatever their names.  Pages, heads and files may be of any length.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from framelake.llm.bpe import pieces
from framelake.llm.common import fresh, small_batches, written
from framelake.sources.storage import located, opened

#: Payloads below this many bytes are never revisits; bytes of a file, and of a range that one task searches; of first pages that may be broadcast.
LEAST, FILE_BYTES, RANGE_BYTES, SMALL = 100, 256_000_000, 4_000_000, 16_000_000
#: Fixed values of the format: first line, end of a head, end of a record, the profile of revisits by digest.
MAGIC = re.compile(rb"WARC/1\.[01]\r\n")
HEAD_END, RECORD_END = b"\r\n\r\n", b"\r\n\r\n"
LONGEST_MAGIC = 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FIELD = re.compile(rb"([!#$%&'*+.^_`|~0-9A-Za-z-]+)[ \t]*:[ \t]*(.*?)[ \t]*\r\n((?:[ \t].*?\r\n)*)")
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, path string, offset long"


def record_id(page: int | None, digest: str) -> str:
    return f"<urn:page:{'' if page is None else page}:{digest}>"


def page_of(record: str | None) -> int | None:
    m = re.fullmatch(r"<urn:page:(-?\d+):[0-9a-f]*>", record or "")
    return int(m[1]) if m else None


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record: a revisit has the HTTP head alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page, digest)}", f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {record_id(refers_to, digest)}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "replace") + HEAD_END + block + RECORD_END


class Files:
    """One attempt's files, a new one after file_bytes."""

    def __init__(self, folder: str, file_bytes: int) -> None:
        self.folder, self.file_bytes = folder, file_bytes
        self.done: list[tuple[str, int, int]] = []
        self.out, self.path, self.size, self.records = None, "", 0, 0

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.path = f"{self.folder}/part-{uuid.uuid4().hex}.warc"
            system, at = located(self.path)
            self.out = system.open_output_stream(at)
        self.out.write(data)
        self.size, self.records = self.size + len(data), self.records + 1
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.size, self.records))
        self.out, self.size, self.records = None, 0, 0


def write(pages: DataFrame, folder: str | None = None, least: int = LEAST, file_bytes: int = FILE_BYTES, date: str = "2000-01-01T00:00:00Z", small: int = SMALL) -> DataFrame:
    """Writes the archives and returns the manifest: path, bytes, records."""
    spark = pages.sparkSession
    small_batches(spark)
    folder = folder or fresh(spark, "warc")
    system, at = located(folder)
    system.create_dir(at, recursive=True)
    rows = pages.select(F.col("page_id").cast("long").alias("page"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    # of each payload that several pages have: combined before the shuffle, so a payload of very many pages is one row a task
    several = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null").select("digest", "first")
    several = written(several, "first-pages")
    # 32 bytes of digest, the id and some for each row's objects: its size is known before the pages move
    named = rows.join(F.broadcast(several) if several.count() * 100 <= small else several, "digest", "left")
    refers = F.when(F.col("page") > F.col("first"), F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(folder, file_bytes)
        for b in pieces(batches):
            for page, url, payload, digest, first in zip(*(b.column(c).to_pylist() for c in range(5)), strict=True):
                files.add(record(page, url, payload, digest.hex(), first, date))
        files.close()
        if files.done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*files.done, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["path", "bytes", "records"])

    return written(named.select("page", "url", "payload", "digest", refers.alias("refers_to")).mapInArrow(run, "path string, bytes long, records long"), "manifest")


class Window:
    """A file read in pieces of some size, as most reads lie in the piece before; a store takes one request for each piece."""

    def __init__(self, f: pa.NativeFile, piece: int = 1 << 20) -> None:
        self.f, self.piece, self.lo, self.data = f, piece, 0, b""

    def read(self, at: int, n: int) -> bytes:
        if at < self.lo or at + n > self.lo + len(self.data):
            self.f.seek(at)
            self.lo, self.data = at, self.f.read(max(n, self.piece))
        return self.data[at - self.lo : at - self.lo + n]


@dataclass
class Head:
    fields: dict[str, str]
    body: int  # where the block begins
    successor: int


def head_at(f: Window, at: int, size: int, step: int = 1024) -> Head | None:
    """The head of the record that begins at a place, if what stands there is one: lines of fields with one length."""
    data, end = b"", -1
    while end < 0:
        more = f.read(at + len(data), step)
        if not more:
            return None
        data, seen = data + more, max(0, len(data) - 3)
        if not MAGIC.match(data):
            return None
        end = data.find(HEAD_END, seen)
        step *= 2
        if end < 0 and not plausible(data):
            return None
    start = data.index(b"\n") + 1
    fields: dict[str, str] = {}
    while start < end + 2:
        m = FIELD.match(data, start, end + 2)
        if not m:
            return None
        name, value = m[1].decode().lower(), re.sub(rb"\r\n[ \t]+", b" ", m[2] + (b"\r\n" + m[3] if m[3] else b"")).strip().decode("utf-8", "replace")
        if name == "content-length" and name in fields:
            return None
        fields[name] = value
        start = m.end()
    if not re.fullmatch(r"\d+", fields.get("content-length", "")):
        return None
    body = at + end + len(HEAD_END)
    successor = body + int(fields["content-length"]) + len(RECORD_END)
    return Head(fields, body, successor) if successor <= size else None


def plausible(data: bytes) -> bool:
    """Whether all whole lines of a head that has not ended are fields or go on with one."""
    lines = data.split(b"\r\n")[1:-1]
    return all(line[:1] in (b" ", b"\t") or FIELD.match(line + b"\r\n") for line in lines)


def candidates(path: str, size: int, lo: int, hi: int) -> tuple[list[int], list[int], list[int]]:
    """Places in lo ... hi where a record could begin, their successors, and the first place past hi that each leads to."""
    at, to = [], []
    with opened(path) as file:
        f = Window(file)
        data = f.read(lo, min(hi + LONGEST_MAGIC, size) - lo)
        for m in MAGIC.finditer(data):
            if lo + m.start() < hi and (h := head_at(f, lo + m.start(), size)):
                at.append(lo + m.start())
                to.append(h.successor)
    exits: dict[int, int] = {}
    for a, b in zip(reversed(at), reversed(to), strict=True):  # a successor comes after its record
        if b >= hi or b in exits:
            exits[a] = exits.get(b, b)
    # what leads to a place in the range that is no candidate leads nowhere: it is no record, or the file is broken there
    return at, to, [exits.get(a, -1) for a in at]


def ranges(manifest: DataFrame, range_bytes: int) -> DataFrame:
    """path, bytes, lo of every range, dealt evenly."""
    tasks = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = manifest.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long"))).alias("lo"))
    return cut.repartition(tasks, "path", "lo")


def pointers(manifest: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, at, successor, to of every candidate; to is where it leads past its range, -1 if nowhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, size, lo in zip(*(c.to_pylist() for c in b.columns), strict=True):
                at, successor, to = candidates(path, size, lo, min(lo + range_bytes, size))
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(at), pa.string()), *(pa.array(x, pa.int64()) for x in (at, successor, to))], ["path", "at", "successor", "to"])

    return ranges(manifest, range_bytes).mapInArrow(run, "path string, at long, successor long, to long")


def reached(manifest: DataFrame, found: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """path, at: the first real record of every range that has one, and each file's end where its chain gets there.

    found: path, at, to of the candidates.  After r rounds all records of 2^r - 1 jumps from the start are known.
    """
    most = manifest.agg(F.coalesce(F.max("bytes"), F.lit(0))).first()[0]
    known = manifest.where("bytes > 0").select("path", F.lit(0).cast("long").alias("at"))
    jumps = found.where("to >= 0").select("path", "at", "to")
    for _ in range(max(1, (-(-most // range_bytes)).bit_length())):
        known = written(known.unionByName(known.join(jumps, ["path", "at"]).select("path", F.col("to").alias("at"))).distinct(), "reached")
        on = jumps.select("path", F.col("at").alias("to"), F.col("to").alias("next"))
        jumps = written(jumps.join(on, ["path", "to"], "left").select("path", "at", F.coalesce("next", "to").alias("to")), "jumps")
    return known


def boundaries(manifest: DataFrame, range_bytes: int = RANGE_BYTES, strict: bool = True) -> DataFrame:
    """path, bytes, lo, at of the ranges that hold a real record: the first one's place."""
    found = written(pointers(manifest, range_bytes), "candidates")
    known = reached(manifest, found, range_bytes)
    if strict:
        broken = manifest.where("bytes > 0").join(known.withColumnRenamed("at", "bytes"), ["path", "bytes"], "left_anti").select("path").limit(3).collect()
        if broken:
            raise ValueError(f"no chain of records from start to end: {', '.join(r['path'] for r in broken)}")
    entry = known.withColumn("lo", (F.floor(F.col("at") / range_bytes) * range_bytes).cast("long"))
    return ranges(manifest, range_bytes).join(entry, ["path", "lo"]).where("at < bytes").select("path", "bytes", "lo", "at")


def parsed(path: str, f: Window, at: int, h: Head, with_payload: bool) -> tuple | None:
    """A page's record as a row; None for records of other types."""
    kind = h.fields.get("warc-type")
    if kind not in ("response", "revisit"):
        return None
    block = f.read(h.body, h.successor - len(RECORD_END) - h.body)
    head, _, payload = block.partition(HEAD_END)
    digest = h.fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind == "response":
        if hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{path}: the payload of the record at {at} is not that of its digest")
        n = len(payload)
    else:
        n, payload = int(re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)", head)[1]), None
    return page_of(h.fields.get("warc-record-id")), h.fields.get("warc-target-uri"), kind, page_of(h.fields.get("warc-refers-to")), n, digest, payload if with_payload else None, path, at


def read(spark: SparkSession, manifest: DataFrame, range_bytes: int = RANGE_BYTES, with_payload: bool = True, strict: bool = True) -> DataFrame:
    """The records of the archives of a manifest (path, bytes): page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload, path, offset.

    A revisit's payload is null here; resolved() brings it.  Payloads are held against their digests.
    """
    small_batches(spark)
    names = [x.strip().split(" ")[0] for x in RECORDS.split(",")]
    types = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string(), pa.int64())

    def rows(path: str, size: int, lo: int, at: int) -> Iterator[tuple]:
        hi = min(lo + range_bytes, size)
        with opened(path) as file:
            f = Window(file)
            while at < hi:
                h = head_at(f, at, size)
                if h is None:
                    if strict:
                        raise ValueError(f"{path}: no record at {at}")
                    return
                if (row := parsed(path, f, at, h, with_payload)) is not None:
                    yield row
                at = h.successor

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, n = [], 0
            for part in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for row in rows(*part):
                    held.append(row)
                    n += len(row[6] or b"")
                    if len(held) >= 1000 or n >= 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)
                        held, n = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names)

    return boundaries(manifest, range_bytes, strict).mapInArrow(run, RECORDS)


def resolved(records: DataFrame) -> DataFrame:
    """The records with the payloads that revisits refer to."""
    there = records.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.first("payload").alias("there"))
    return records.join(there, ["refers_to", "payload_digest"], "left").withColumn("payload", F.coalesce("payload", "there")).select(*records.columns)
