"""Event time, processing time and their text forms."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Watermark delays of the jobs, for device time and for time stamped on arrival.
DEVICE_DELAY = "1 minute"
STAMPED_DELAY = "5 seconds"


def as_column(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_millis(ts: str | Column) -> Column:
    """P8."""
    return F.unix_millis(as_column(ts))


def now_millis() -> Column:
    """Processing time, the same for all rows of one micro-batch."""
    return F.unix_millis(F.current_timestamp())


def from_millis(millis: str | Column) -> Column:
    """P10."""
    return F.timestamp_millis(as_column(millis))


def event_time(millis: str | Column) -> Column:
    """P5: time of a record from its epoch millis, or now when it has none."""
    return F.coalesce(from_millis(millis), F.current_timestamp())


def time_of_day_text(ts: str | Column) -> Column:
    """ISO time of day. Zero seconds are left out; a fraction takes three or six digits."""
    ts = as_column(ts)
    micros = F.pmod(F.unix_micros(ts), F.lit(60_000_000))
    return (
        F.when(micros == 0, F.date_format(ts, "HH:mm"))
        .when(micros % 1_000_000 == 0, F.date_format(ts, "HH:mm:ss"))
        .when(micros % 1_000 == 0, F.date_format(ts, "HH:mm:ss.SSS"))
        .otherwise(F.date_format(ts, "HH:mm:ss.SSSSSS"))
    )


def arrival_order(millis: Column, seq: str | Column | None, first_wins: bool) -> Column:
    """One sortable number for (time, sequence): ``max_by`` on it finds the latest row.

    Ties in time go to the lowest sequence number if ``first_wins``, else to the highest. A decimal,
    unlike a struct, has a fixed-size aggregation buffer, so the aggregate hashes and never sorts.
    """
    if seq is None:
        return millis
    shifted = millis.cast("decimal(19,0)") * F.lit(Decimal(2**63))
    seq = as_column(seq).cast("bigint").cast("decimal(19,0)")
    return shifted - seq if first_wins else shifted + seq


def with_partition_tag(df: DataFrame, out: str = "tid") -> DataFrame:
    """Which task handled the row. For diagnosis only: it changes from run to run."""
    return df.withColumn(out, F.spark_partition_id().cast("bigint"))
