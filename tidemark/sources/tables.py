"""Bounded rows and the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

DEVICE_SCHEMA = "seq BIGINT, device STRING, ts TIMESTAMP, production INT"
TELEMETRY_SCHEMA = (
    "asset_id STRING, rowtime TIMESTAMP, seq BIGINT, gen_active_pw DOUBLE, ap_production DOUBLE, wind_speed DOUBLE"
)
EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)


def rows(spark: SparkSession, data: list, schema: str | StructType) -> DataFrame:
    """Rows given in the program."""
    return spark.createDataFrame(data, schema)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def with_zoned_time(events: DataFrame) -> DataFrame:
    """Give ``ts`` a zone: watermarks do not take TIMESTAMP_NTZ."""
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def as_telemetry(events: DataFrame) -> DataFrame:
    """The event table in the columns of the telemetry report."""
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.col("user_id").cast("string").alias("asset_id"),
        F.col("ts").cast("timestamp").alias("rowtime"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("gen_active_pw"),
        F.col("event_id").alias("ap_production"),
        k.alias("wind_speed"),
    )


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a batch or streaming table known to SQL."""
    df.createOrReplaceTempView(name)
    return df
