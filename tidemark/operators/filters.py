"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from tidemark.functions.timing import as_column, now_millis

# Fixed values.
MAX_AHEAD_MS = 10 * 60 * 1000


def is_ahead(time_ms: str | Column, now_ms: str | Column | None = None, limit_ms: int = MAX_AHEAD_MS) -> Column:
    """True if the record time is more than ``limit_ms`` past ``now_ms`` (default: the clock)."""
    now = now_millis() if now_ms is None else as_column(now_ms)
    return as_column(time_ms) - now > limit_ms


def future_rows(df: DataFrame, time_ms: str | Column, now_ms: str | Column | None = None) -> DataFrame:
    """F5."""
    return df.filter(is_ahead(time_ms, now_ms))
