"""Kafka as a stream of strings."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns of a Kafka source, for replays from files.
KAFKA_SCHEMA = (
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, timestamp TIMESTAMP, timestampType INT"
)


def start_options(mode: str = "group", timestamp_ms: int | None = None, offset_reset: str = "latest") -> dict[str, str]:
    """Where a first run starts. A restart always resumes from its checkpoint.

    ``mode`` (any case) is earliest, latest or timestamp; anything else means "where we left off",
    which for a first run is ``offset_reset`` (any case): earliest or latest.
    """
    mode, offset_reset = mode.lower(), offset_reset.lower()
    if offset_reset not in ("earliest", "latest"):
        raise ValueError(f"offset_reset must be earliest or latest, not {offset_reset}")
    if mode == "timestamp":
        if timestamp_ms is None:
            raise ValueError("mode timestamp needs timestamp_ms")
        return {"startingTimestamp": str(timestamp_ms), "startingOffsetsByTimestampStrategy": "latest"}
    return {"startingOffsets": mode if mode in ("earliest", "latest") else offset_reset}


def kafka_options(
    servers: str,
    topic: str,
    group: str | None = None,
    start: dict[str, str] | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """S1. ``max_offsets`` bounds a micro-batch; set it for backfills."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, **(start or start_options())}
    if group:
        options["groupIdPrefix"] = group
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, **options) -> DataFrame:
    """Arguments as in :func:`kafka_options`."""
    return decode(spark.readStream.format("kafka").options(**kafka_options(**options)).load())


def decode(df: DataFrame) -> DataFrame:
    """Text value, record time, and a row id that is the same in every attempt."""
    return df.select(
        F.col("value").cast("string").alias("value"),
        F.col("timestamp").alias("record_time"),
        F.xxhash64("topic", "partition", "offset").alias("row_id"),
        "topic",
        "partition",
        "offset",
    )


def checkpoint_path(base: str, resume: bool = True) -> str:
    """Progress kept across runs, or a new folder per run."""
    base = base.rstrip("/")
    return f"{base}/resume" if resume else f"{base}/run-{uuid.uuid4().hex}"
