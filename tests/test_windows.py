from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.keys import SALT_COUNT, hashed_salt_key, key_by, key_text, random_salt_key, salt_key
from tidemark.functions.timing import time_of_day_text, with_partition_tag
from tidemark.operators.windows import last_value_windows, window_counts, window_totals
from tidemark.plans import jobs
from tidemark.sources.tables import DEVICE_SCHEMA, TELEMETRY_SCHEMA, rows


def day(text):
    return datetime.fromisoformat(f"2024-01-01 {text}")


DEVICE_ROWS = [
    (1, "d1", day("00:00:01"), 101010),
    (2, "d1", day("00:02:01"), 102010),
    (3, "d1", day("00:02:23"), 102020),
    (4, "d1", day("00:12:00"), 104010),
    (5, "d2", day("00:20:01"), 201010),
    (6, "d2", day("00:22:01"), 202010),
    (7, "d1", day("00:06:32"), 105010),
    (8, "d1", day("00:12:32"), 104020),
    (9, "d1", day("00:21:32"), 106010),
]


def last_values(spark, data):
    result = jobs.device_last_values(rows(spark, data, DEVICE_SCHEMA)).orderBy("win_start", "key")
    return [(r.win_start.strftime("%H:%M"), r.key, r.last_local_time, r.last_value, r.cnt) for r in result.collect()]


def test_device_rows(spark):
    assert last_values(spark, DEVICE_ROWS) == [
        ("00:00", "d1", "00:00:01", 101010.0, 1),
        ("00:02", "d1", "00:02:23", 102020.0, 2),
        ("00:06", "d1", "00:06:32", 105010.0, 1),
        ("00:12", "d1", "00:12:32", 104020.0, 2),
        ("00:20", "d2", "00:20:01", 201010.0, 1),
        ("00:21", "d1", "00:21:32", 106010.0, 1),
        ("00:22", "d2", "00:22:01", 202010.0, 1),
    ]


def test_last_value_edge_cases(spark):
    data = [
        (1, "nulls", day("01:00:10"), 5),
        (2, "nulls", day("01:00:20"), None),
        (3, "none", day("01:00:10"), None),
        (4, "tie", day("01:00:30"), 7),
        (5, "tie", day("01:00:30"), 8),
        (6, "tie_ms", day("01:00:30.000100"), 7),
        (7, "tie_ms", day("01:00:30.000900"), 8),
        (8, "whole", day("01:01:00"), 9),
        (9, "old", datetime(1969, 12, 31, 23, 59, 30), 9),
    ]
    assert last_values(spark, data) == [
        ("23:59", "old", None, 0.0, 1),
        ("01:00", "none", None, 0.0, 1),
        ("01:00", "nulls", "01:00:10", 5.0, 2),
        ("01:00", "tie", "01:00:30", 7.0, 2),
        ("01:00", "tie_ms", "01:00:30.000100", 7.0, 2),
        ("01:01", "whole", "01:01", 9.0, 1),
    ]


def test_null_key_fails(spark):
    with pytest.raises(Exception, match="null key"):
        last_values(spark, [(1, None, day("01:00:00"), 5)])


def test_last_value_without_sequence(spark):
    data = rows(spark, [(1, "d", day("01:00:10"), 5), (2, "d", day("01:00:20"), 6)], DEVICE_SCHEMA)
    assert last_value_windows(data, "device", "ts", "production").first().last_value == 6.0


def test_telemetry_report(spark):
    def at(text):
        return datetime.fromisoformat(f"2021-04-07 16:{text}")

    def rising(start, step):
        return [start + step * i for i in range(5)]

    data = [
        ("a1", at(f"00:{s:02d}"), i, p, q, w)
        for i, (s, p, q, w) in enumerate(
            zip([1, 10, 20, 30, 40], rising(400.0, 100), [100.0, 105.0, 110.0, 120.0, 130.0], rising(46.15, 0.1))
        )
    ]
    data += [
        ("a2", at("00:05"), 10, 700.0, 50.0, 60.0),
        ("a2", at("00:35"), 11, 830.0, 60.0, 72.0),
        ("a1", at("01:10"), 12, None, 130.0, None),
        ("a1", at("02:10"), 13, 500.0, 140.0, None),
    ]
    report = jobs.telemetry(spark, rows(spark, data, TELEMETRY_SCHEMA)).orderBy("win_start", "asset_id")

    def number(v):
        return None if v is None else round(v, 6)

    assert [
        (r.asset_id, r.win_start.strftime("%H:%M"), r.cnt, number(r.pw_1m), r.prod_delta, number(r.wind_avg))
        for r in report.collect()
    ] == [
        ("a1", "16:00", 5, 10.0, 30.0, 46.35),
        ("a2", "16:00", 2, 12.75, 10.0, 66.0),
        ("a1", "16:01", 1, None, 0.0, None),
        ("a1", "16:02", 1, 8.333333, 0.0, None),
    ]


def test_time_of_day_digits(spark):
    times = ["03:00:00", "03:00:07", "03:00:07.120000", "03:00:07.000120", "03:00:00.500000"]
    df = spark.createDataFrame([(t, day(t)) for t in times], "t string, ts timestamp").select(time_of_day_text("ts"))
    assert [r[0] for r in df.collect()] == ["03:00", "03:00:07", "03:00:07.120", "03:00:07.000120", "03:00:00.500"]


@pytest.mark.parametrize("salt", [lambda: salt_key("id"), lambda: hashed_salt_key("id"), random_salt_key])
def test_salts_cover_all_rows(spark, salt):
    data = spark.range(1000).withColumn("ts", F.timestamp_seconds(F.col("id")))
    counts = window_counts(data, "ts", salt(), "3 seconds").collect()
    assert sum(r.cnt for r in counts) == 1000
    assert {r.key for r in counts} <= {f"groupKey_{i}" for i in range(SALT_COUNT)}
    assert all(r.value == f'{{"key":"{r.key}","count":{r.cnt}}}' for r in counts)
    totals = window_totals(data, "ts", salt(), "1 minute").collect()
    assert sorted(r.cnt for r in totals) == sorted([60] * 16 + [40])


def test_negative_ids_have_a_salt(spark):
    keys = {r[0] for r in spark.range(-20, 0).select(salt_key("id")).collect()}
    assert keys == {f"groupKey_{i}" for i in range(SALT_COUNT)}


@pytest.fixture
def uncoalesced(spark):
    """Keep small partitions apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_key_by_spreads_a_hot_key(spark, uncoalesced):
    hot = spark.range(4000).withColumn("k", F.lit("hot"))
    tagged = with_partition_tag(key_by(hot, "k", "id"))
    assert tagged.count() == 4000
    assert tagged.select("tid").distinct().count() > 1
    assert with_partition_tag(key_by(hot, "k", "id", spread=1)).select("tid").distinct().count() == 1


def test_key_text(spark):
    assert spark.range(1).select(key_text("id")).first()[0] == "0"
