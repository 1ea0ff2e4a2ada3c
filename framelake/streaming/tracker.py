"""The tracking state machine over a stream: the state of a session is two values, kept in the state store.

Frames of a session must arrive in order across micro-batches; within one they are sorted.  Where they may not, see
framelake.streaming.ordered.  A lost track clears the session's state, as a session that searches without a reference is
one that has just begun.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from framelake.operators.tracking import State

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT = "user_id long, event_id long, source int, reanchor int, track_reset int"


def _none(x: float) -> float | None:
    return None if pd.isna(x) else float(x)


def keyed(frames: DataFrame):
    """Frames by session.  The key holds no null: beside one in a batch, pandas makes all numbers floats, which Spark takes for null keys."""
    return frames.withColumns({"__none": F.col("user_id").isNull(), "user_id": F.coalesce("user_id", F.lit(0))}).groupBy("user_id", "__none")


def session(key: tuple) -> int | None:
    """The session of a key of keyed."""
    return None if key[1] else int(key[0])


class Machine(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("track", "on boolean, ref double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ARG002
        own = State(*self.state.get()) if self.state.exists() else State()
        frames = pd.concat(list(rows)).sort_values(["ts", "event_id"])
        out = []
        for r in frames.itertuples():
            src, again, lost = own.row(_none(r.area), _none(r.cov), bool(r.marked), _none(r.a1), _none(r.a2))
            out.append((session(key), r.event_id, src, int(again), int(lost)))
        if own.on:
            self.state.update((own.on, own.ref))
        else:
            self.state.clear()
        yield pd.DataFrame(out, columns=["user_id", "event_id", "source", "reanchor", "track_reset"])

    def close(self) -> None:
        pass


def tracked(frames: DataFrame) -> DataFrame:
    """A row for each frame of a stream of (user_id, ts, event_id, area, cov, marked, a1, a2)."""
    return keyed(frames).transformWithStateInPandas(statefulProcessor=Machine(), outputStructType=OUTPUT, outputMode="Append", timeMode="None")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State stores of streams that start within are of the kind that these processors need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name, None)
    spark.conf.set(name, PROVIDER)
    try:
        yield
    finally:
        if old:
            spark.conf.set(name, old)
        else:
            spark.conf.unset(name)


def drained(spark: SparkSession, frames: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Runs the stream over what is there now, to a table at out."""
    with rocksdb(spark):
        tracked(frames).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(OUTPUT).parquet(out)
