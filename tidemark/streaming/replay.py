"""Bounded replays of tables through the streaming operators (M1, M2, L1); late rows are counted by ``streaming.progress``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StringType, StructType, TimestampNTZType, TimestampType

from tidemark.session import scratch_dir
from tidemark.streaming.sinks import append_sink

END_OF_TIME = "9999-12-31 00:00:00"


def file_stream(spark: SparkSession, path: str, schema: str | StructType, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet file or folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # As a pattern, the path may also be a single file.
    path = path.rstrip("/")
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def replay_to_end(
    spark: SparkSession,
    path: str,
    schema: StructType,
    time: str,
    transform: Callable[[DataFrame], DataFrame],
    files_per_batch: int | None = None,
    end_text: str = "",
) -> DataFrame:
    """Run a windowed transform in append mode over all of ``path`` and return every window.

    Append mode holds back the windows that the watermark has not passed. So after the data a second
    run from the same checkpoint reads one row from the end of time, which lets all of them out; its own
    window stays behind. State is dropped window by window, unlike in complete mode. ``transform``
    sets the watermark and should not fail on ``end_text`` and zeros, which fill that row.
    """
    work = scratch_dir(spark, "replay")
    end_path, out, checkpoint = f"{work}/end", f"{work}/out", f"{work}/checkpoint"
    spark.createDataFrame([], schema).write.parquet(end_path)

    def run() -> None:
        data = file_stream(spark, path, schema, files_per_batch)
        source = data.unionByName(file_stream(spark, end_path, schema))
        append_sink(transform(source), out, checkpoint, interval=None).start().awaitTermination()

    run()
    _end_row(spark, schema, end_text).write.mode("append").parquet(end_path)
    run()
    return spark.read.parquet(out)


def time_slices(rows: DataFrame, time: str, count: int) -> list[DataFrame]:
    """``rows`` cut at equal steps of time; rows without a time come first."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    begin, end = rows.agg(F.min(at), F.max(at)).first()
    if begin is None:
        return [rows]
    cuts = [begin + (end - begin) * i // count for i in range(1, count)]
    number = sum((F.when(at >= cut, 1).otherwise(0) for cut in cuts), F.lit(0))
    return [rows.filter(number == i) for i in range(count)]


def replay_runs(spark: SparkSession, slices: list[DataFrame], sink: Callable[[DataFrame], DataStreamWriter]) -> None:
    """Give one slice after another to a stream. ``sink`` is started anew for each, and goes on from its checkpoint."""
    source, schema = scratch_dir(spark, "slices"), slices[0].schema
    for rows in slices:
        rows.write.mode("append").parquet(source)
        sink(file_stream(spark, source, schema)).start().awaitTermination()


def replay_batches(spark: SparkSession, slices: list[DataFrame], sink: Callable[[DataFrame], DataStreamWriter]) -> None:
    """As :func:`replay_runs`, but in one run: the query goes on while the slices come, each a micro-batch or more of its own."""
    source, schema = scratch_dir(spark, "slices"), slices[0].schema
    slices[0].write.parquet(source)
    query = sink(file_stream(spark, source, schema)).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
        for rows in slices[1:]:
            rows.write.mode("append").parquet(source)
            query.processAllAvailable()
    finally:
        query.stop()


def replay_slices(
    spark: SparkSession, slices: list[DataFrame], transform: Callable[[DataFrame], DataFrame], end_text: str = ""
) -> DataFrame:
    """As :func:`replay_to_end`, with the rows in micro-batches of their own: a row that is late for the watermark of the
    slices before its own is dropped (L1)."""
    work = scratch_dir(spark, "replay")
    end = _end_row(spark, slices[0].schema, end_text)
    sink = lambda rows: append_sink(transform(rows), f"{work}/out", f"{work}/checkpoint", interval=None)
    replay_runs(spark, [*slices, end], sink)
    return spark.read.parquet(f"{work}/out")


def _end_row(spark: SparkSession, schema: StructType, text: str) -> DataFrame:
    return spark.range(1).select(*[_end_value(f, text).alias(f.name) for f in schema.fields])


def _end_value(field, text: str):
    if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
        return F.lit(END_OF_TIME).cast(field.dataType)
    empty = text if isinstance(field.dataType, StringType) else 0
    return F.lit(empty).cast(field.dataType)
