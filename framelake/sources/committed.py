"""Files committed as a whole: a Python data source that writes a file for each row.

A job goes through three states, and a reader of the folder sees none or all of its files whatever is lost on the way:

* staged: each attempt of a task writes its files under ``_jobs/<job>/attempts/<attempt>/`` and lists them in a table of its
  own, ``_jobs/<job>/manifest/<attempt>``.  An attempt that fails takes its files away; what a lost executor leaves
  behind is named nowhere.
* committed: the driver writes ``_jobs/<job>/_commit`` with the attempts that count, one for each task, in one step.
  From here on the job can only go forward.
* published: tasks move the committed attempts' files to their names, then ``_jobs/<job>/_done`` is written.  A move
  that was done before is passed over, so this step can be repeated; recover() does so for jobs that stopped here.

The driver holds a line for each task, never one for each file.  Spark's readers pass over folders whose
names begin with an underscore, and patterns that name an ending don't match what is in them.  A job that aborts leaves the folder as it was.

Rows: name (below the folder), data (bytes), source (path of a file that is copied where data is null, with its times on
a mount).  A row whose data is null and whose source is missing or null gives no file.  Names that a job gives twice are
an error before anything is published; a file that was there before the job is replaced.  Null names are an error.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from framelake.sources import storage

SCHEMA = "name string, data binary, source string"
#: Files after which a task logs how many it has written.
EVERY = 50
MANIFEST = "name string, staged string, bytes long"
_PARTS = pa.schema([("name", pa.string()), ("staged", pa.string()), ("bytes", pa.int64())])


@dataclass
class Attempt(WriterCommitMessage):
    id: str
    files: int
    bytes: int


def _part(folder: str, job: str, attempt: str) -> str:
    return f"{folder}/_jobs/{job}/manifest/{attempt}"


class Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]) -> None:
        self.folder, self.job = options["path"].rstrip("/"), options["job"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Attempt:
        attempt, rows, log = uuid.uuid4().hex, [], logging.getLogger("framelake")
        top = f"{self.folder}/_jobs/{self.job}/attempts/{attempt}"
        try:
            for batch in iterator:
                for name, data, source in zip(*(batch.column(c).to_pylist() for c in ("name", "data", "source")), strict=True):
                    if name is None or ".." in name.split("/") or name.startswith(("/", "_")):
                        raise ValueError(f"not a name for a file: {name!r}")
                    staged = f"{top}/{len(rows)}"  # of any name, so that equal names don't meet before they are found
                    if data is not None:
                        storage.replaced(staged, data)
                    elif source is None or not storage.copied(source, staged):
                        continue
                    rows.append((name, staged, storage.size(staged)))
                    if len(rows) % EVERY == 0:
                        log.info("%s: %d files", self.folder, len(rows))
        except BaseException:
            storage.removed(top)
            raise
        if rows:
            cols = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _PARTS.types, strict=True)]
            sink = pa.BufferOutputStream()
            pq.write_table(pa.Table.from_arrays(cols, schema=_PARTS), sink)
            storage.replaced(_part(self.folder, self.job, attempt), sink.getvalue().to_pybytes())
        return Attempt(attempt, len(rows), sum(r[2] for r in rows))

    def commit(self, messages: list[Attempt | None]) -> None:
        own = [m for m in messages if m is not None and m.files]
        record = {"attempts": [m.id for m in own], "files": sum(m.files for m in own), "bytes": sum(m.bytes for m in own)}
        storage.replaced(f"{self.folder}/_jobs/{self.job}/_commit", json.dumps(record).encode())
        logging.getLogger("framelake").info("%s: %d files, %d bytes, committed", self.folder, record["files"], record["bytes"])

    def abort(self, messages: list[Attempt | None]) -> None:  # noqa: ARG002
        storage.removed(f"{self.folder}/_jobs/{self.job}")


class CommittedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "committed_files"

    def schema(self) -> str:
        return SCHEMA

    def writer(self, schema, overwrite: bool) -> Writer:  # noqa: ARG002
        return Writer(self.options)


def jobs(folder: str) -> dict[str, bool]:
    """The committed jobs of a folder and whether each has been published."""
    having = lambda mark: {p.split("/")[-2] for p in storage.listed(f"{folder.rstrip('/')}/_jobs/*/{mark}")}
    done = having("_done")
    return {job: job in done for job in having("_commit")}


def figures(folder: str, job: str) -> dict:
    """attempts, files and bytes of a committed job."""
    with storage.opened(f"{folder.rstrip('/')}/_jobs/{job}/_commit") as f:
        return json.loads(f.read())


def manifest(spark: SparkSession, folder: str, job: str) -> DataFrame:
    """name, staged, bytes of a committed job's files, from the tables of the attempts that count."""
    parts = [_part(folder.rstrip("/"), job, a) for a in figures(folder, job)["attempts"]]
    return spark.read.schema(MANIFEST).parquet(*parts) if parts else spark.createDataFrame([], MANIFEST)


def publish(spark: SparkSession, folder: str, job: str) -> None:
    """Moves a committed job's files to their names; may be repeated."""
    folder = folder.rstrip("/")
    rows = manifest(spark, folder, job)
    twice = rows.groupBy("name").count().where("count > 1").select("name").limit(3).collect()
    if twice:
        withdraw(folder, job)
        raise ValueError(f"names given twice: {', '.join(r['name'] for r in twice)}")

    def move(part: Iterator) -> None:
        for r in part:
            storage.moved(r["staged"], storage.joined(folder, r["name"]), r["bytes"])

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows.repartition(tasks, "name").foreachPartition(move)
    storage.replaced(f"{folder}/_jobs/{job}/_done", b"")
    storage.removed(f"{folder}/_jobs/{job}/attempts")


def withdraw(folder: str, job: str) -> None:
    """Takes a job away that has not been published."""
    storage.removed_file(f"{folder}/_jobs/{job}/_commit")
    storage.removed(f"{folder}/_jobs/{job}")


def recover(spark: SparkSession, folder: str) -> list[str]:
    """Publishes what was committed and not published; returns those jobs."""
    open_ = sorted(job for job, done in jobs(folder).items() if not done)
    for job in open_:
        publish(spark, folder, job)
    return open_


def write(rows: DataFrame, folder: str, tries: int = 1) -> str:
    """Writes rows (name, data or source) as files of a folder that all executors share, as one job; returns its id.

    tries: how often the job is started when it fails, each time as a new one.
    """
    spark = rows.sparkSession
    spark.dataSource.register(CommittedFiles)
    own = [F.col(c) if c in rows.columns else F.lit(None).cast(t).alias(c) for c, t in (("name", "string"), ("data", "binary"), ("source", "string"))]
    for left in range(tries - 1, -1, -1):
        job = uuid.uuid4().hex
        try:
            rows.select(*own).write.format("committed_files").option("path", folder).option("job", job).mode("append").save()
            break
        except PySparkException:
            if not left:
                raise
    publish(spark, folder, job)
    return job
