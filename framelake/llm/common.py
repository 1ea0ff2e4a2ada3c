"""What the operators of this subpackage share: tables, the shared folder, words and keys."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of bytes or characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)
WORDS_B = re.compile(WORD.encode())
#: Stands for a null doc_id inside the operators; it sorts before every other id.
NULL_ID = -(2**63)
#: Setting that bounds the batches on their way to Python, and its value where a session sets none.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "8m"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from spark.checkpoint.dir; one is made only where none is set and there are no other machines."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="framelake-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def fresh(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """Cuts the lineage with a table in the shared folder, so that a lost executor costs no recomputation.

    checkpoint() would run the plan twice (once to count, once to save); a written table runs it once.
    """
    spark = df.sparkSession
    path = fresh(spark, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds batches for Python by bytes for the rest of the session, as rows may be of any length; a bound that is set stays."""
    if spark.conf.get(BATCH, None) is None:
        spark.conf.set(BATCH, BATCH_BYTES)


def hand_back() -> None:
    """Gives the system what the allocators of this process hold without use; Spark keeps a worker for the tasks of later stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def key(c: str | Column = "doc_id") -> Column:
    """doc_id as a long without nulls."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("long"), F.lit(NULL_ID))


def unkey(c: str) -> Column:
    return F.when(F.col(c) != NULL_ID, F.col(c))


def free_prefix(df: DataFrame) -> str:
    """Underscores that no column of df begins with, for columns that are put beside them for a while."""
    prefix = "__"
    while any(c.startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def in_order(df: DataFrame, but: tuple[str, ...] = ()) -> Column:
    """A struct of all columns but some by which any two rows that differ there have an order; maps are compared as their text."""
    plain = lambda t: not any(x in t.simpleString() for x in ("map<", "variant"))
    return F.struct(F.lit(0).alias("none"), *[F.col(f"`{f.name}`") if plain(f.dataType) else F.to_json(F.struct(F.col(f"`{f.name}`"))).alias(f.name) for f in df.schema if f.name not in but])


def remainder(c: str, m: int) -> Column:
    """crc32 of the id as text, modulo m: the folds that the contracts fix."""
    return F.pmod(F.crc32(F.col(c).cast("string").cast("binary")), F.lit(m))
