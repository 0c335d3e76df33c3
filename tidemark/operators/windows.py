"""Tumbling-window aggregates.

All of them aggregate with fixed-size buffers, so Spark combines rows before the shuffle and a
window that holds a large share of the input costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import key_text
from tidemark.functions.timing import arrival_order, as_column, epoch_millis, time_of_day_text


def last_value_windows(
    df: DataFrame,
    key: str | Column,
    time: str,
    value: str | Column,
    seq: str | Column | None = None,
    width: str = "1 minute",
) -> DataFrame:
    """A1: per key and window the last value, its time of day and the number of rows.

    "Last" goes by event time in milliseconds; of several rows in one millisecond the first to
    arrive (lowest ``seq``) counts. Null values count as rows but are never last; with no value at
    all the result is 0.0 at no time. Rows at or before the epoch are never last either.
    """
    value = as_column(value)
    millis = epoch_millis(time)
    order = F.when(value.isNotNull() & (millis > 0), arrival_order(millis, seq, first_wins=True))
    return (
        df.groupBy(F.window(time, width), key_text(key).alias("key"))
        .agg(
            F.max_by(F.col(time), order).alias("last_time"),
            F.max_by(value.cast("double"), order).alias("last_value"),
            F.count("*").alias("cnt"),
        )
        .select(
            F.col("window.start").alias("win_start"),
            "key",
            time_of_day_text("last_time").alias("last_local_time"),
            F.coalesce("last_value", F.lit(0.0)).alias("last_value"),
            "cnt",
        )
    )


def window_counts(df: DataFrame, time: str, key: str | Column, width: str, **more: Column) -> DataFrame:
    """A2: rows per key and window, typed and as the JSON text ``{"key", "count"}``; ``more`` adds aggregates by name."""
    return (
        df.groupBy(F.window(time, width), as_column(key).alias("key"))
        .agg(F.count("*").alias("cnt"), *[column.alias(name) for name, column in more.items()])
        .select(
            F.col("window.start").alias("win_start"),
            F.col("window.end").alias("win_end"),
            "key",
            "cnt",
            F.to_json(F.struct("key", F.col("cnt").alias("count"))).alias("value"),
            *more,
        )
    )


def window_totals(df: DataFrame, time: str, salt: str | Column, width: str) -> DataFrame:
    """A2 in two steps: count per salt key and window, then add up the salts.

    Both steps group by the window itself, so the plan also runs on a stream in append mode.
    """
    return (
        df.groupBy(F.window(time, width), as_column(salt).alias("salt"))
        .agg(F.count("*").alias("part"))
        .groupBy("window")
        .agg(F.sum("part").alias("cnt"))
        .select(F.col("window.start").alias("win_start"), F.col("window.end").alias("win_end"), "cnt")
    )


def telemetry_report(spark: SparkSession, view: str, width: str = "1 minute") -> DataFrame:
    """A3: the SQL report over a telemetry view, batch or streaming.

    Columns of the view: ``asset_id, rowtime, seq, gen_active_pw, ap_production, wind_speed``.
    First and last production go by (rowtime, seq), nulls left out, as rows have no order of their
    own after a shuffle. The order is a decimal for the reason given in ``arrival_order``.
    """
    order = (
        "CASE WHEN ap_production IS NOT NULL THEN "
        "CAST(unix_micros(rowtime) AS DECIMAL(19,0)) * 9223372036854775808BD + seq END"
    )
    return spark.sql(f"""
        SELECT asset_id,
               window.start AS win_start,
               count(*) AS cnt,
               avg(gen_active_pw) / 60.0D AS pw_1m,
               max_by(ap_production, {order}) - min_by(ap_production, {order}) AS prod_delta,
               avg(wind_speed) AS wind_avg
        FROM {view}
        GROUP BY asset_id, window(rowtime, '{width}')
    """)
