"""Token files: Arrow IPC files of fixed-size-list batches.

Each shard holds a range of the documents in ascending doc_id order: its ids, one after the other, are cut into
sequences of ``length`` ids, ``mask`` tells ids from the padding that only the shard's last sequence has.  As every
sequence has the same length, sequence i of a shard lies at a known place of a known batch, and a memory-mapped file
gives it without a copy.  A second Arrow file of each shard lists its documents: doc_id, offset within the shard,
number of ids.

Null texts are empty: only the end id.  Null ids come first; repeated ids follow each other, by text, and lie in as many
shards as their number asks for, unless their texts start alike.  An empty table gives no files and no rows.  Other input columns are left out.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from framelake.llm.bpe import encoder, pieces
from framelake.llm.common import fresh, small_batches, written
from framelake.sources.storage import local, located

#: Characters of a text that deal the rows of one id out over the shards.
HEAD = 64


def _open(uri: str) -> pa.NativeFile:
    """Memory-mapped where the file is local, else a random-access stream."""
    system, path = located(uri)
    return pa.memory_map(path) if local(uri) else system.open_input_file(path)


class Writer:
    """Writes one shard: rows of ``length`` ids, ``rows`` of them in each batch."""

    def __init__(self, base: str, length: int, dtype: pa.DataType, rows: int = 1024) -> None:
        self.path, self.length, self.dtype, self.rows = base, length, dtype, rows
        system, at = located(base)
        self.schema = pa.schema([("ids", pa.list_(dtype, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.sinks = [system.open_output_stream(f"{at}.{x}") for x in ("arrow", "index")]
        self.out = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = pa.ipc.new_file(self.sinks[1], pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("n", pa.int64())]))
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.total = 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids, pa.array(self.total + np.cumsum(counts) - counts), pa.array(counts)], ["doc_id", "offset", "n"]))
        self.total += len(ids)
        self.waiting.append(ids.astype(self.dtype.to_pandas_dtype()))
        self.n_waiting += len(ids)
        if self.n_waiting >= self.rows * self.length:
            self._write(last=False)

    def _write(self, last: bool) -> None:
        flat = np.concatenate(self.waiting) if self.waiting else np.zeros(0, self.dtype.to_pandas_dtype())
        step = self.rows * self.length
        full = len(flat) // step * step
        for i in range(0, full, step):
            self._batch(flat[i : i + step], step)
        rest = flat[full:]
        if last and len(rest):
            padded = np.zeros(-(-len(rest) // self.length) * self.length, rest.dtype)
            padded[: len(rest)] = rest
            self._batch(padded, len(rest))
            rest = rest[:0]
        self.waiting, self.n_waiting = [rest], len(rest)

    def _batch(self, flat: np.ndarray, real: int) -> None:
        mask = np.arange(len(flat)) < real
        self.out.write_batch(pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(flat), self.length), pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)], schema=self.schema))

    def close(self) -> None:
        self._write(last=True)
        self.out.close()
        self.index.close()
        for s in self.sinks:
            s.close()


class TokenFile:
    """Random access to one shard."""

    def __init__(self, base: str) -> None:
        self.file = pa.ipc.open_file(_open(f"{base}.arrow"))
        self.index = pa.ipc.open_file(_open(f"{base}.index"))
        self.rows = self.file.get_batch(0).num_rows if self.file.num_record_batches else 0
        self.length = self.file.schema.field("ids").type.list_size

    def __len__(self) -> int:
        k = self.file.num_record_batches
        return (k - 1) * self.rows + self.file.get_batch(k - 1).num_rows if k else 0

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (zero-copy) and mask of sequence i."""
        b, r = self.file.get_batch(i // self.rows), i % self.rows
        cut = [b.column(c).values.slice((b.column(c).offset + r) * self.length, self.length) for c in (0, 1)]
        return cut[0].to_numpy(zero_copy_only=True), cut[1].to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, Iterator[np.ndarray]]]:
        """For each batch of the index: doc_ids, offsets, counts, and the ids of each document in turn."""
        at, k, held = 0, 0, np.zeros(0, np.uint32)

        def take(n: int) -> np.ndarray:
            nonlocal k, held
            parts = []
            while n > len(held):
                parts.append(held)
                n -= len(held)
                held = self.file.get_batch(k).column(0).values.to_numpy(zero_copy_only=True)
                k += 1
            parts.append(held[:n])
            held = held[n:]
            return parts[0] if len(parts) == 1 else np.concatenate(parts)

        for i in range(self.index.num_record_batches):
            b = self.index.get_batch(i)
            offsets, counts = (b.column(c).to_numpy() for c in (1, 2))
            assert not len(offsets) or offsets[0] == at
            at += int(counts.sum())
            yield b.column(0), offsets, counts, (take(int(n)) for n in counts)


def write(docs: DataFrame, tokenizer: str, end_id: int, length: int = 2048, folder: str | None = None) -> DataFrame:
    """Writes the shards and returns the manifest: shard, base (path without ending), n_ids.

    Each attempt of a task writes files of its own; the manifest, a table in the shared folder, names those of the
    attempt that counted, so retries and speculative tasks do no harm.
    """
    spark = docs.sparkSession
    small_batches(spark)
    folder = folder or fresh(spark, "tokens")
    system, at = located(folder)
    system.create_dir(at, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, shard = encoder(tokenizer), None, TaskContext.get().partitionId()
        dtype = pa.uint16() if max(len(enc.bytes_of) - 1, end_id) < 2**16 else pa.uint32()
        for b in pieces(batches):
            if out is None:
                out = Writer(f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}", length, dtype)
            ids, n = enc.encode_array(b.column(1))
            out.add(b.column(0), np.insert(ids, np.cumsum(n), end_id), n + 1)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([out.path]), pa.array([out.total], pa.int64())], ["shard", "base", "n_ids"])

    # the start of a text sorts as the text does, so an id on very many rows (all null ids, say) is in many shards
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", F.substring("text", 1, HEAD)).sortWithinPartitions("doc_id", "text")
    return written(ordered.mapInArrow(run, "shard int, base string, n_ids long"), "manifest")


def read(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files; one row of the manifest is one task's work."""
    # the manifest has one row for each shard, so this window is over some thousand rows even for very large tables
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.select("base", F.coalesce(F.sum("n_ids").over(w), F.lit(0)).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for base, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                for doc_ids, offsets, counts, own in TokenFile(base).documents():
                    crc = [zlib.crc32(x.astype("<u4")) for x in own]
                    yield pa.RecordBatch.from_arrays([doc_ids, pa.array(start + offsets, pa.int64()), pa.array(counts, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return starts.repartition(tasks, "base").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
