"""The jobs J1-J8 as DataFrame -> DataFrame functions; connect them to a source and a sink.

Windowed jobs put a watermark on the stream; on a static table it has no effect.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions import json as js
from tidemark.functions.keys import hashed_salt_key, salt_key
from tidemark.functions.offset_lines import parse_offset_lines
from tidemark.functions.timing import DEVICE_DELAY, STAMPED_DELAY, event_time, now_millis
from tidemark.operators.filters import is_ahead
from tidemark.operators.offset_ranges import lowest_deltas, ranges_by_topic, report_lines, topic_stats
from tidemark.operators.throttle import throttle
from tidemark.operators.windows import last_value_windows, telemetry_report, window_counts
from tidemark.session import scratch_dir
from tidemark.sources.tables import register
from tidemark.sources.text import read_lines
from tidemark.streaming.sinks import CHECKPOINT_INTERVAL
from tidemark.streaming.throttle import throttle_batches

# The waits of the sampling sink and the field that holds the stamp.
SAMPLE_WAIT_MS = 60_000
AHEAD_WAIT_MS = 10_000
STAMP_FIELD = "timeMillis"


def device_last_values(rows: DataFrame, width: str = "1 minute", delay: str = DEVICE_DELAY) -> DataFrame:
    """J1 over ``seq, device, ts, production``."""
    return last_value_windows(rows.withWatermark("ts", delay), "device", "ts", "production", "seq", width)


def stamped(lines: DataFrame, strict: bool, now_ms: Column | None = None) -> DataFrame:
    """Parse ``value`` and stamp it: as text in ``value`` (every digit kept), as ``fields`` (name to VARIANT), with
    ``event_time`` and what else came in. What is not read of these is not worked out.

    Strict parsing fails on a bad line; otherwise the line becomes the field ``line``. The stamp is
    processing time unless ``now_ms`` is given, such as the record time of a Kafka source.
    """
    parsed = js.with_json_object(lines)
    fields = js.fields_of(js.strict_object()) if strict else js.fields_or_line()
    text = js.strict_text() if strict else js.json_or_line()
    stamp = now_millis() if now_ms is None else now_ms
    kept = [c for c in lines.columns if c != "value"]
    fielded = parsed.select(*kept, text.alias("value"), fields.alias("fields"), stamp.alias("stamp_ms"))
    return fielded.select(
        *kept,
        js.put_in_text(F.col("value"), STAMP_FIELD, F.col("stamp_ms").cast("string")).alias("value"),
        js.put_fields(F.col("fields"), **{STAMP_FIELD: F.col("stamp_ms")}).alias("fields"),
        "stamp_ms",
        event_time("stamp_ms").alias("event_time"),
    )


def sampling_waits(time_ms: Column, now_ms: Column) -> Column:
    """K5: records ahead of the clock are sampled more often than the rest."""
    return F.when(is_ahead(time_ms, now_ms), AHEAD_WAIT_MS).otherwise(SAMPLE_WAIT_MS)


def sample_table(records: DataFrame, key: str | Column, time_ms: Column, now_ms: Column, row_id: str) -> DataFrame:
    """J2 over a table: one record per key and minute, or per 10 s while records are ahead."""
    return throttle(records, key, now_ms, sampling_waits(time_ms, now_ms), row_id)


def sample_stream(
    records: DataFrame,
    key: str | Column,
    time_ms: Column,
    now_ms: Column,
    row_id: str,
    path: str,
    checkpoint: str,
    interval: str | None = CHECKPOINT_INTERVAL,
) -> DataStreamWriter:
    """J2 over a stream, with its sink; read with ``emitted_rows``. The keys are few by nature, so it takes the form that
    spreads a key."""
    waits = sampling_waits(time_ms, now_ms)
    return throttle_batches(records, key, now_ms, waits, row_id, path, checkpoint, interval)


def sampled_lines(
    lines: DataFrame,
    source: str,
    row_id: str,
    path: str,
    checkpoint: str,
    interval: str | None = CHECKPOINT_INTERVAL,
    now_ms: Column | None = None,
) -> DataStreamWriter:
    """J2 from text: parse strictly, stamp (with the clock, unless ``now_ms`` is given), sample per ``source``, write as
    JSON text in ``value`` that keeps every digit."""
    records = stamped(lines, strict=True, now_ms=now_ms).select(source, row_id, "stamp_ms", "value")
    now = F.col("stamp_ms")
    return sample_stream(records, source, now, now, row_id, path, checkpoint, interval)


def salted_counts(
    lines: DataFrame,
    width: str = "1 minute",
    strict: bool = True,
    row_id: str | None = None,
    now_ms: Column | None = None,
    delay: str = STAMPED_DELAY,
) -> DataFrame:
    """J3 (strict), J4 (not strict), J5 (``width="3 seconds"``): count records per salt key and window.

    The result has the JSON text ``{"key", "count"}`` in ``value`` next to typed columns. The salt comes
    from ``row_id`` if there is one, else from the text itself. Strict lines are checked; of the others all
    count, and ``bad`` says how many of them are no JSON object and so stand as ``{"line"}``.
    """
    salt = salt_key(row_id) if row_id else hashed_salt_key(F.col("value"))
    stamp = now_millis() if now_ms is None else now_ms
    records = lines.withColumns({"salt": salt, "event_time": event_time(stamp)}).withWatermark("event_time", delay)
    records = js.with_json_object(records)
    if strict:
        return window_counts(records.filter(js.is_checked_object()), "event_time", "salt", width)
    return window_counts(records, "event_time", "salt", width, bad=F.count_if(F.col("obj").isNull()))


def normalised(lines: DataFrame) -> DataFrame:
    """JSON text in its normal form, or the empty string for a bad line."""
    kept = [c for c in lines.columns if c != "value"]
    return js.with_json_object(lines).select(*kept, js.json_or_empty().alias("value"))


def telemetry(spark: SparkSession, rows: DataFrame, width: str = "1 minute", delay: str = DEVICE_DELAY) -> DataFrame:
    """J7."""
    view = f"telemetry_{uuid.uuid4().hex}"
    register(rows.withWatermark("rowtime", delay), view)
    return telemetry_report(spark, view, width)


def offset_report(spark: SparkSession, path: str, strict: bool = True) -> dict[str, DataFrame]:
    """The ranges of a text file, or of a folder of such files in order of their paths, and what they tell. The text is
    parsed once, into a table that all outputs read; ``write_report`` writes the report as text."""
    return describe_offsets(kept_ranges(parse_offset_lines(read_lines(spark, path), strict=strict)))


def kept_ranges(ranges: DataFrame) -> DataFrame:
    """The ranges as a written table, so that their text is parsed once."""
    folder = scratch_dir(ranges.sparkSession, "ranges")
    ranges.write.parquet(folder)
    return ranges.sparkSession.read.schema(ranges.schema).parquet(folder)


def describe_offsets(ranges: DataFrame) -> dict[str, DataFrame]:
    return {
        "ranges": ranges,
        "by_topic": ranges_by_topic(ranges),
        "stats": topic_stats(ranges),
        "lowest": lowest_deltas(ranges),
        "report": report_lines(ranges),
    }
