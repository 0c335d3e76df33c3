"""Sampling by time per key on a stream.

Two forms with the same result. ``throttle_stream`` keeps its state per key, in buckets of keys, for keys
that spread the load. ``throttle_batches`` runs each micro-batch through the distributed table form, for
keys that may hold a large share of a big micro-batch, such as in a backfill.
"""

from __future__ import annotations

import sys
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from tidemark.functions.keys import key_text
from tidemark.functions.timing import as_column
from tidemark.operators.throttle import first_after, levels_for, throttle
from tidemark.session import drop_folder
from tidemark.streaming.sinks import CHECKPOINT_INTERVAL, batch_writer

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NEVER = -(2**62)

# Buckets of the keys of a stream, and the rows of a bucket that are sorted or given back to Spark at a time.
BUCKETS = 1024
CHUNK_ROWS = 10_000

# Micro-batches after which the changes of the state are folded.
FOLD_EVERY = 50
STATE = "key string, last bigint"


class LastEmitted(StatefulProcessor):
    """Keeps the time of the last emitted row of each key, in a map per bucket of keys.

    Spark hands groups to Python one by one, each as frames of its own at a cost of milliseconds; a bucket shares it among its keys.
    """

    def __init__(self, ttl_ms: int | None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "key string", "ms bigint", self.ttl_ms)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        for name, last in zip(initialState["key"], initialState["last"]):
            self.last.updateValue((name,), (int(last),))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        before: dict[str, int] = {}
        held: list[pd.DataFrame] = []
        kept = fresh = 0
        for frame in rows:
            frame = frame[frame["throttle_ms"] - frame["throttle_wait"] > self._before(frame["key"], before)]
            held.append(frame)
            fresh += len(frame)
            # Only once the rows have doubled, so that each is sorted a few times at most.
            if fresh > max(kept, CHUNK_ROWS):
                held = [_firsts(held)]
                kept, fresh = len(held[0]), 0
        if not held:
            return
        firsts = _firsts(held)
        picks = self._emitted(firsts, before)
        for start in range(0, len(picks), CHUNK_ROWS):
            out = firsts.iloc[picks[start : start + CHUNK_ROWS]]
            yield out.drop(columns=["throttle_bucket", "throttle_ms", "throttle_wait", "throttle_id"])

    def _before(self, keys: pd.Series, before: dict[str, int]) -> np.ndarray:
        """The last emission before each row. ``before`` has those that were read, so that each key is read once."""
        codes, names = pd.factorize(keys)
        for name in names:
            if name not in before:
                stored = self.last.getValue((name,))
                before[name] = NEVER if stored is None else stored[0]
        return np.array([before[name] for name in names], dtype=np.int64)[codes]

    def _emitted(self, firsts: pd.DataFrame, before: dict[str, int]) -> list[int]:
        """The places of the emitted rows of all keys, whose last ones go to the state."""
        keys, ms = firsts["key"].to_numpy(), firsts["throttle_ms"].to_numpy()
        edges = ms - firsts["throttle_wait"].to_numpy()
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
        picks: list[int] = []
        for start, end in zip(starts, [*starts[1:], len(keys)]):
            chain = _chain(ms[start:end], edges[start:end], before[keys[start]])
            if chain:
                picks.extend(start + place for place in chain)
                self.last.updateValue((keys[start],), (int(ms[picks[-1]]),))
        return picks

    def close(self) -> None:
        pass


def _firsts(frames: list[pd.DataFrame]) -> pd.DataFrame:
    """By key and in time order, the only rows that can be emitted: the first of each millisecond and wait."""
    frame = pd.concat(frames, ignore_index=True).sort_values(["key", "throttle_ms", "throttle_id"])
    return frame.drop_duplicates(["key", "throttle_ms", "throttle_wait"], ignore_index=True)


def _chain(ms: np.ndarray, edges: np.ndarray, last: int) -> list[int]:
    """The places of the rows of one key that are emitted after ``last``."""
    edges, earliest = (found.tolist() for found in first_after(edges))
    chain = []
    while (at := bisect_right(edges, last)) < len(edges):
        chain.append(earliest[at])
        last = int(ms[earliest[at]])
    return chain


def throttle_stream(
    df: DataFrame,
    key: str | Column,
    time_ms: str | Column,
    wait_ms: int | Column,
    row_id: str | Column,
    ttl_ms: int | None = None,
    initial: DataFrame | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """The emitted rows, with their ``key``.

    Within a micro-batch rows go by (time, row id); a row that arrives in a later batch than a newer one
    is compared with what was emitted so far. Keys are dealt into ``buckets`` by hash, as many as a checkpoint was begun with.
    All rows of a bucket in a micro-batch are handled by one task, which holds one row per key and millisecond.
    ``ttl_ms`` forgets keys that were silent for so long by the clock; choose it above the wait, and
    a trigger that runs on: Spark keeps making batches to watch the clock, so available-now never ends.
    ``initial`` has the last emissions that the first run starts from, as ``key`` (text), ``last``, such as those of a
    backfill by the table form (:func:`tidemark.operators.throttle.last_emissions`); a restart goes on from its checkpoint.
    """
    wait = F.lit(wait_ms) if isinstance(wait_ms, int) else wait_ms
    kept = df.select(
        key_text(key).alias("key"),
        *[c for c in df.columns if c != "key"],
        as_column(time_ms).cast("bigint").alias("throttle_ms"),
        wait.cast("bigint").alias("throttle_wait"),
        as_column(row_id).cast("bigint").alias("throttle_id"),
    ).filter(F.col("throttle_ms").isNotNull())
    out = StructType([f for f in kept.schema.fields if not f.name.startswith("throttle_")])
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("throttle_bucket")
    known = None
    if initial is not None:
        newest = initial.groupBy(F.col("key").cast("string").alias("key")).agg(F.max("last").alias("last"))
        known = newest.select(bucket, "key", "last").groupBy("throttle_bucket")
    return kept.select(bucket, "*").groupBy("throttle_bucket").transformWithStateInPandas(
        LastEmitted(ttl_ms), out, "Append", "None" if ttl_ms is None else "ProcessingTime", known
    )


def throttle_batches(
    df: DataFrame,
    key: str | Column,
    time_ms: str | Column,
    wait_ms: int | Column,
    row_id: str,
    path: str,
    checkpoint: str,
    interval: str | None = CHECKPOINT_INTERVAL,
    expire_ms: int | None = None,
    fold_every: int = FOLD_EVERY,
    initial: DataFrame | None = None,
) -> DataStreamWriter:
    """X1 with its sink: emitted rows go to ``path/rows``, a folder per micro-batch.

    ``path/last`` is the state as a log: a micro-batch adds the last emissions of the keys that it emitted, and no
    others, and reads those of the keys that it has. The newest row of a key counts. A micro-batch that is run again reads
    the log before it and replaces its own folders. Every ``fold_every`` micro-batches the log is folded into
    one folder, where ``expire_ms`` forgets keys whose last emission is that much older than the newest of all: choose it
    above the longest wait and the disorder of the rows. Without it the state has a row per key ever seen.
    ``initial`` has the last emissions that the first run starts from, as in :func:`throttle_stream`.
    """
    wait = F.lit(wait_ms) if isinstance(wait_ms, int) else wait_ms
    timed = df.withColumns(
        {
            "throttle_key": key_text(key),
            "throttle_ms": as_column(time_ms).cast("bigint"),
            "throttle_wait": wait.cast("bigint"),
        }
    )

    def write(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        if batch_id == 0 and initial is not None:
            initial.select("key", "last").write.mode("overwrite").parquet(f"{path}/last/batch_id=-1")
        kept = rows.persist()  # read by the walk and by the selection of its rows
        begin, end = kept.agg(F.min("throttle_ms"), F.max("throttle_ms")).first()
        known = None
        if batch_id > 0 or initial is not None:
            log = _state_log(spark, path).filter(F.col("batch_id") < batch_id)
            own = kept.select(F.col("throttle_key").alias("key")).distinct()
            known = log.join(own, "key", "left_semi").groupBy("key").agg(F.max("last").alias("last")).persist()
        levels = levels_for(end - begin) if begin is not None else 0
        emitted = throttle(kept, "throttle_key", "throttle_ms", F.col("throttle_wait"), row_id, known=known, levels=levels)
        emitted.write.mode("overwrite").parquet(f"{path}/rows/batch_id={batch_id}")
        for held in (kept, known):
            if held is not None:
                held.unpersist()
        changed = spark.read.parquet(f"{path}/rows/batch_id={batch_id}").groupBy(F.col("throttle_key").alias("key"))
        changed.agg(F.max("throttle_ms").alias("last")).write.mode("overwrite").parquet(f"{path}/last/batch_id={batch_id}")
        if batch_id > 1 and batch_id % fold_every == 0:
            _fold_state(spark, path, batch_id - 1, expire_ms)

    return batch_writer(timed, checkpoint, "append", interval, write)


def _state_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"{STATE}, batch_id bigint").parquet(f"{path}/last")


def _fold_state(spark: SparkSession, path: str, last: int, expire_ms: int | None) -> None:
    """Bring the log up to micro-batch ``last``, which is never run again, into that one's folder and remove the older ones.
    At each step a reader finds the newest row of every key, as it may find older ones too."""
    log = _state_log(spark, path).filter(F.col("batch_id") <= last)
    newest = log.groupBy("key").agg(F.max("last").alias("last"), F.max_by("batch_id", "last").alias("since"))
    if expire_ms is not None:
        end = log.agg(F.max("last")).first()[0]
        newest = newest.filter(F.col("last") >= F.lit(end) - expire_ms)
    older = [row.batch_id for row in log.select("batch_id").distinct().collect() if row.batch_id < last]
    newest.filter(F.col("since") < last).select("key", "last").write.mode("append").parquet(f"{path}/last/batch_id={last}")
    for batch_id in older:
        drop_folder(spark, f"{path}/last/batch_id={batch_id}")


def emitted_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows that :func:`throttle_batches` has written."""
    rows = spark.read.parquet(f"{path}/rows")
    return rows.drop("batch_id", "throttle_key", "throttle_ms", "throttle_wait")
