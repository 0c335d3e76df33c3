"""What streaming queries have done, micro-batch by micro-batch.

A query keeps its last hundred progress records only; a listener sees them all.
"""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, batch_id bigint, at string, source int, description string, "
    "end_offset string, input_rows bigint, late_rows bigint"
)

# Progress rows that are held before they are written.
FLUSH_EVERY = 500
WAIT_SECONDS = 60


class ProgressLog(StreamingQueryListener):
    """Counts of all micro-batches of a session's queries, and the progress of their sources as a table if ``path`` is given.

    The table has a row per micro-batch and source, with the offset that the source was read to; ``late_rows`` are those
    of the whole micro-batch and stand in the row of its first source.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, flush_every: int = FLUSH_EVERY):
        self._spark, self._path, self._flush_every = spark, path, flush_every
        self._late: Counter[str] = Counter()
        self._batches: Counter[str] = Counter()
        self._ended: set[str] = set()
        self._held: list[tuple] = []
        self._changed = threading.Condition()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        run, late = str(progress.runId), sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        with self._changed:
            self._late[run] += late
            self._batches[run] += 1
            if self._path:
                head = (str(progress.id), run, progress.batchId, progress.timestamp)
                for i, source in enumerate(progress.sources):
                    self._held.append((*head, i, source.description, source.endOffset, source.numInputRows, late if i == 0 else 0))
                if len(self._held) >= self._flush_every:
                    self._write()
            self._changed.notify_all()

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def _write(self) -> None:
        if self._held:
            rows = self._spark.createDataFrame(self._held, PROGRESS)
            rows.coalesce(1).write.mode("append").parquet(self._path)
            self._held = []

    def flush(self) -> None:
        """Write what is held."""
        with self._changed:
            self._write()

    def _await(self, query) -> str:
        """Records come some time after their micro-batch; those of a query that has ended are complete once that is told."""
        run = str(query.runId)
        with self._changed:
            if not query.isActive and not self._changed.wait_for(lambda: run in self._ended, WAIT_SECONDS):
                raise TimeoutError(f"no end of run {run} was told")
        return run

    def late_rows(self, query) -> int:
        """L1: how many rows a run has dropped as late, in all its micro-batches."""
        return self._late[self._await(query)]

    def batches(self, query) -> int:
        return self._batches[self._await(query)]


@contextmanager
def progress_log(spark: SparkSession, path: str | None = None, flush_every: int = FLUSH_EVERY) -> Iterator[ProgressLog]:
    """Log the queries of ``spark`` that are started within; the table is complete when this ends after them."""
    log = ProgressLog(spark, path, flush_every)
    spark.streams.addListener(log)
    try:
        yield log
    finally:
        spark.streams.removeListener(log)
        log.flush()


def read_to(progress: DataFrame) -> DataFrame:
    """How far each source of each query was read, and how many rows in all: ``query_id, source, batch_id, end_offset, input_rows``."""
    newest = F.max_by(F.struct("batch_id", "end_offset"), "batch_id").alias("last")
    done = progress.groupBy("query_id", "source").agg(newest, F.sum("input_rows").alias("input_rows"))
    return done.select("query_id", "source", "last.batch_id", "last.end_offset", "input_rows")
