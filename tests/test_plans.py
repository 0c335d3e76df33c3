"""The physical plans stay as they should be."""

import re

import pytest

import __spark_entry__ as contract
from tidemark.operators.offset_ranges import lowest_deltas

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(text):
    return set(re.search(r"ReadSchema: struct<(.*?)>", text).group(1).split(",")) if "ReadSchema" in text else set()


@pytest.mark.parametrize(
    "name, columns",
    [
        ("tumble_telemetry_1m", {"event_id", "ts", "user_id", "event_type", "value", "props"}),
        ("window_last_value_1h", {"event_id", "ts", "event_type", "value"}),
        ("device_last_values_1m", {"event_id", "ts", "user_id", "event_type", "props"}),
        ("salted_window_count_3s", {"event_id", "ts"}),
        ("job_tolerant_counts_1m", {"event_id", "ts", "event_type", "props"}),
        ("job_strict_counts_1m", {"event_id", "ts", "props"}),
    ],
)
def test_window_aggregates_hash_once_and_combine_first(spark, name, columns):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert text.count("Exchange") == 1
    assert text.count("HashAggregate") == 2 and "SortAggregate" not in text
    assert "partial_count(1)" in text
    assert {c.split(":")[0] for c in read_columns(text)} == columns


def test_totals_share_no_hot_window(spark):
    text = plan(contract.queries()["salted_total_1h"](spark, FOLDER))
    assert "partial_count(1)" in text and "partial_sum" in text


def test_lowest_deltas_cut_rows_before_the_topic_shuffle(spark):
    ranges = spark.range(100).selectExpr(
        "id line_no", "concat('t', id % 2) topic", "cast(id as int) partition", "id from_offset", "2 * id until_offset", "id delta"
    )
    text = plan(lowest_deltas(ranges))
    assert "row_number(), 4, Partial" in text
    assert "SortAggregate" not in text
    assert text.index("row_number(), 4, Partial") > text.index("hashpartitioning(topic")


def test_offset_statistics_shuffle_once(spark):
    text = plan(contract.queries()["offset_topic_stats"](spark, FOLDER))
    assert text.count("Exchange") == 1 and "partial_sum" in text


@pytest.mark.parametrize("name", ["json_strict", "json_numbers_strict", "json_numbers_stamped", "json_fallback_line", "json_normalise_or_empty", "offset_parse", "future_skew_rows"])
def test_row_transforms_do_not_shuffle(spark, name):
    text = plan(contract.queries()[name](spark, FOLDER))
    assert "Exchange" not in text and "Python" not in text
