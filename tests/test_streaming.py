import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from test_windows import DEVICE_ROWS, day
from tidemark.plans import jobs
from tidemark.session import scratch_dir, shared_parent
from tidemark.sources.generator import generated_records, ticks
from tidemark.sources.kafka import KAFKA_SCHEMA, checkpoint_path, decode, kafka_options, read_kafka, start_options
from tidemark.sources.tables import DEVICE_SCHEMA, rows
from tidemark.streaming.progress import progress_log, read_to
from tidemark.streaming.replay import file_stream, replay_to_end
from tidemark.streaming.throttle import emitted_rows
from tidemark.streaming.sinks import (
    append_sink,
    bucketed_text_sink,
    changelog_sink,
    console_sink,
    fold_buckets,
    kafka_sink,
    latest_rows,
    memory_sink,
    latest_snapshot,
    read_buckets,
    snapshot_sink,
)
from tidemark.streaming.state import window_state


def write(spark, path, data, schema=DEVICE_SCHEMA):
    rows(spark, data, schema).coalesce(1).write.mode("append").parquet(str(path))


def device_stream(spark, path):
    return jobs.device_last_values(file_stream(spark, str(path), rows(spark, [], DEVICE_SCHEMA).schema))


def windows(df):
    return sorted((r.win_start.strftime("%H:%M"), r.key, r.cnt) for r in df.collect())


def test_late_rows_are_dropped_and_restarts_resume(spark, tmp_path):
    """One run per file from one checkpoint: the third sees the watermark of the second."""
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "checkpoint")
    late = 0
    source.mkdir()
    with progress_log(spark) as log:
        for batch in (DEVICE_ROWS[:6], [(10, "d2", day("00:22:30"), 1)], DEVICE_ROWS[6:]):
            write(spark, source, batch)
            query = append_sink(device_stream(spark, source), out, checkpoint, interval=None).start()
            query.awaitTermination()
            late += log.late_rows(query)
    assert windows(spark.read.parquet(out)) == [("00:00", "d1", 1), ("00:02", "d1", 2), ("00:12", "d1", 1), ("00:20", "d2", 1)]
    assert late == 2


def test_late_rows_are_counted_over_more_micro_batches_than_a_query_remembers(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i in range(106):
        # The third micro-batch and the fifth hold rows that are late for the ones before.
        late = {3: [(1000, "d1", day("00:00:10"), 1)], 5: [(1001, "d1", day("00:00:20"), 1), (1002, "d2", day("00:00:30"), 1)]}
        write(spark, source, [(i, "d1", day(f"01:{i % 60:02d}:00") if i < 60 else day(f"02:{i % 60:02d}:00"), i), *late.get(i, [])])
        os.utime(max(source.glob("*.parquet"), key=os.path.getmtime), (i, i))
    schema = rows(spark, [], DEVICE_SCHEMA).schema
    stream = jobs.device_last_values(file_stream(spark, str(source), schema, files_per_batch=1))
    with progress_log(spark, str(tmp_path / "progress"), flush_every=40) as log:
        query = append_sink(stream, str(tmp_path / "out"), str(tmp_path / "c"), interval=None).start()
        query.awaitTermination()
        assert log.late_rows(query) == 3
        assert log.batches(query) >= 106 > len(query.recentProgress)
    remembered = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert remembered < 3
    table = spark.read.parquet(str(tmp_path / "progress"))
    assert table.agg(F.sum("late_rows"), F.sum("input_rows")).first() == (3, 109)
    (end,) = read_to(table).collect()
    assert end.query_id == str(query.id) and end.input_rows == 109 and json.loads(end.end_offset)["logOffset"] == 105
    assert table.groupBy("batch_id", "source").count().where("count > 1").isEmpty()


def test_progress_goes_on_over_restarts(spark, tmp_path):
    """The progress table has all runs of a query, and no offset twice."""
    source = tmp_path / "in"
    source.mkdir()
    for part, late in ((DEVICE_ROWS[:4], 0), (DEVICE_ROWS[4:], 1)):
        write(spark, source, part)
        with progress_log(spark, str(tmp_path / "progress")) as log:
            query = append_sink(device_stream(spark, source), str(tmp_path / "out"), str(tmp_path / "c"), interval=None).start()
            query.awaitTermination()
            assert log.late_rows(query) == late
    table = spark.read.parquet(str(tmp_path / "progress"))
    (end,) = read_to(table).collect()
    assert table.select("run_id").distinct().count() == 2
    assert end.input_rows == len(DEVICE_ROWS) and json.loads(end.end_offset)["logOffset"] == 1


def test_replay_lets_every_window_out(spark, tmp_path):
    write(spark, tmp_path / "in", DEVICE_ROWS)
    schema = rows(spark, [], DEVICE_SCHEMA).schema
    result = replay_to_end(spark, str(tmp_path / "in"), schema, "ts", jobs.device_last_values)
    assert windows(result) == windows(jobs.device_last_values(rows(spark, DEVICE_ROWS, DEVICE_SCHEMA)))


def test_changelog_and_snapshot_lead_to_the_same_result(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for batch in (DEVICE_ROWS[:3], DEVICE_ROWS[3:7], DEVICE_ROWS[7:]):
        write(spark, source, batch)
        for sink, name in ((changelog_sink, "changes"), (snapshot_sink, "whole")):
            stream = file_stream(spark, str(source), rows(spark, [], DEVICE_SCHEMA).schema)
            result = jobs.last_value_windows(stream, "device", "ts", "production", "seq")
            sink(result, str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), None).start().awaitTermination()
    changes = spark.read.parquet(str(tmp_path / "changes"))
    assert changes.select("batch_id").distinct().count() == 3
    expected = windows(jobs.device_last_values(rows(spark, DEVICE_ROWS, DEVICE_SCHEMA)))
    assert windows(latest_rows(changes, "win_start", "key")) == expected
    assert windows(latest_snapshot(spark.read.parquet(str(tmp_path / "whole")))) == expected
    assert sorted(p.name for p in (tmp_path / "whole").glob("batch_id=*")) == ["batch_id=1", "batch_id=2"]


def test_memory_and_console(spark, tmp_path):
    write(spark, tmp_path / "in", DEVICE_ROWS)
    lines = file_stream(spark, str(tmp_path / "in"), rows(spark, [], DEVICE_SCHEMA).schema).select(F.col("device").alias("value"))
    memory_sink(lines, "collected", str(tmp_path / "m")).start().awaitTermination()
    assert spark.table("collected").count() == len(DEVICE_ROWS)
    query = console_sink(lines, str(tmp_path / "c"), "OutPrint: ", interval=None).start()
    query.awaitTermination()
    assert query.lastProgress["sink"]["numOutputRows"] == len(DEVICE_ROWS)


def test_bucketed_text(spark, tmp_path):
    write(spark, tmp_path / "in", [(i, f"line {i}", datetime(2024, 1, 1, i // 10, i % 10), i) for i in range(40)])
    lines = file_stream(spark, str(tmp_path / "in"), rows(spark, [], DEVICE_SCHEMA).schema).select("ts", F.col("device").alias("value"))
    sink = bucketed_text_sink(lines, str(tmp_path / "out"), str(tmp_path / "c"), "ts", files_per_bucket=2, interval=None)
    sink.start().awaitTermination()
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.name.startswith("bucket"))
    assert folders == [f"bucket=2024-01-01--0{h}" for h in range(4)]
    texts = [t for p in (tmp_path / "out").glob("bucket*/*.txt") for t in p.read_text().splitlines()]
    assert sorted(texts) == sorted(f"line {i}" for i in range(40))
    assert all(len(list((tmp_path / "out" / f).glob("*.txt"))) <= 2 for f in folders)


def test_folded_buckets_show_each_line_once(spark, tmp_path):
    """Before, between and after folds, when a fold stops half way, and with lines that come after their hour was folded."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    told = []

    def run(batch):
        told.extend(f"line {i}" for i, *_ in batch)
        write(spark, source, [(i, f"line {i}", day(t), 1) for i, t in batch])
        lines = file_stream(spark, str(source), rows(spark, [], DEVICE_SCHEMA).schema).select("ts", F.col("device").alias("value"))
        bucketed_text_sink(lines, out, str(tmp_path / "c"), "ts", 1, None, roll_records=2).start().awaitTermination()

    def seen():
        found = read_buckets(spark, out).collect()
        assert all(r.bucket.startswith("2024-01-01--0") for r in found)
        return sorted(r.value for r in found)

    def begun():
        """A reader that has listed its files."""
        reader = read_buckets(spark, out)
        reader.schema, reader._jdf.queryExecution().executedPlan()
        return reader

    run([(i, f"0{i % 2}:00:{i:02d}") for i in range(10)])
    assert len(list((tmp_path / "out").glob("bucket=*/*.txt"))) >= 5  # rolled after two lines
    early = begun()
    assert seen() == sorted(told)
    assert fold_buckets(spark, out, files_per_bucket=1) >= 3
    assert seen() == sorted(told) == sorted(r.value for r in early.collect())
    assert fold_buckets(spark, out) == 0
    run([(10, "00:59:00"), (11, "02:00:00")])  # one line for the hour that is folded
    assert seen() == sorted(told)
    # A fold that stops before its list is there leaves lines that no reader takes.
    (tmp_path / "out-folded" / "lines" / "fold=stopped" / "bucket=2024-01-01--01").mkdir(parents=True)
    (tmp_path / "out-folded" / "lines" / "fold=stopped" / "bucket=2024-01-01--01" / "part-0.txt").write_text("line 1\n")
    assert seen() == sorted(told)
    assert fold_buckets(spark, out, before="2024-01-01--09") >= 3
    assert seen() == sorted(told)
    folded = list((tmp_path / "out-folded" / "lines").glob("fold=*/bucket=*--00/*.txt"))
    assert len(folded) == 2 and fold_buckets(spark, out, before="2024-01-01--09") == 0


def test_windows_leave_the_state_when_the_watermark_has_passed(spark, tmp_path):
    source, checkpoint = tmp_path / "in", str(tmp_path / "c")
    source.mkdir()
    for batch in (DEVICE_ROWS[:6], [(10, "d2", day("00:22:30"), 1)]):
        write(spark, source, batch)
        append_sink(device_stream(spark, source), str(tmp_path / "out"), checkpoint, interval=None).start().awaitTermination()
    held = window_state(spark, checkpoint).collect()
    assert [(r[1], r.window.start) for r in held] == [("d2", day("00:22:00"))]


def test_bucket_by_clock(spark, tmp_path):
    write(spark, tmp_path / "in", DEVICE_ROWS)
    lines = file_stream(spark, str(tmp_path / "in"), rows(spark, [], DEVICE_SCHEMA).schema).select(F.col("device").alias("value"))
    bucketed_text_sink(lines, str(tmp_path / "out"), str(tmp_path / "c"), interval=None).start().awaitTermination()
    assert spark.read.schema("value string, bucket string").text(str(tmp_path / "out")).count() == len(DEVICE_ROWS)


KAFKA_VALUES = ['{"a":1}', '{"a":2}', "bad", '{"a":3}']


def kafka_rows(spark, tmp_path):
    data = [
        (None, bytearray(v.encode()), "t", i % 2, i, day(f"00:0{i // 3}:{i % 3 * 20:02d}"), 0) for i, v in enumerate(KAFKA_VALUES)
    ]
    write(spark, tmp_path / "in", data, KAFKA_SCHEMA)
    return decode(file_stream(spark, str(tmp_path / "in"), rows(spark, [], KAFKA_SCHEMA).schema))


def test_kafka_to_counts(spark, tmp_path):
    """The tolerant job on Kafka columns that come from a file."""
    lines = kafka_rows(spark, tmp_path)
    counts = jobs.salted_counts(lines, strict=False, row_id="row_id", now_ms=F.unix_millis("record_time"))
    changelog_sink(counts, str(tmp_path / "out"), str(tmp_path / "c"), None).start().awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sum(r.cnt for r in found) == len(KAFKA_VALUES)
    assert {r.win_start.minute for r in found} == {0, 1}
    assert all(json.loads(r.value) == {"key": r.key, "count": r.cnt} for r in found)


def test_strict_job_stops_at_a_bad_line(spark, tmp_path):
    counts = jobs.salted_counts(kafka_rows(spark, tmp_path), strict=True, row_id="row_id")
    with pytest.raises(Exception, match="not a JSON object"):
        changelog_sink(counts, str(tmp_path / "out"), str(tmp_path / "c"), None).start().awaitTermination()


def test_folded_changelog_leads_to_the_same_result(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, row in enumerate(DEVICE_ROWS):
        write(spark, source, [row])
        stream = file_stream(spark, str(source), rows(spark, [], DEVICE_SCHEMA).schema)
        result = jobs.last_value_windows(stream, "device", "ts", "production", "seq")
        for name, keys in (("whole", ()), ("folded", ("win_start", "key"))):
            sink = changelog_sink(result, str(tmp_path / name), str(tmp_path / f"{name}-c"), None, keys=keys, fold_every=3)
            sink.start().awaitTermination()
        if i == 6:
            break
    assert len(list((tmp_path / "whole").glob("batch_id=*"))) == 7
    assert sorted(p.name for p in (tmp_path / "folded").glob("batch_id=*")) == ["batch_id=5", "batch_id=6"]
    whole, folded = (latest_rows(spark.read.parquet(str(tmp_path / n)), "win_start", "key").collect() for n in ("whole", "folded"))
    assert whole and sorted(map(repr, whole)) == sorted(map(repr, folded))


def test_sampled_lines(spark, tmp_path):
    lines = kafka_rows(spark, tmp_path).filter("value <> 'bad'").withColumn("source", F.col("partition").cast("string"))
    jobs.sampled_lines(lines, "source", "row_id", str(tmp_path / "out"), str(tmp_path / "c"), None).start().awaitTermination()
    texts = [json.loads(r.value) for r in emitted_rows(spark, str(tmp_path / "out")).collect()]
    assert len(texts) == 2
    assert all(set(t) == {"a", "timeMillis"} for t in texts)


def test_start_options():
    assert start_options("EARLIEST") == {"startingOffsets": "earliest"}
    assert start_options("latest") == {"startingOffsets": "latest"}
    assert start_options("group") == {"startingOffsets": "latest"}
    assert start_options("group", offset_reset="earliest") == {"startingOffsets": "earliest"}
    assert start_options("Timestamp", 5)["startingTimestamp"] == "5"
    assert start_options("group", offset_reset="Earliest") == {"startingOffsets": "earliest"}
    with pytest.raises(ValueError):
        start_options("timestamp")
    for mode in ("group", "earliest"):
        with pytest.raises(ValueError, match="offset_reset"):
            start_options(mode, offset_reset="none")


def test_kafka_options(spark, tmp_path):
    assert kafka_options("host:1", "topic", "group", start_options("earliest"), 1000) == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "topic",
        "startingOffsets": "earliest",
        "groupIdPrefix": "group",
        "maxOffsetsPerTrigger": "1000",
    }
    # The connector is not part of this environment.
    with pytest.raises(Exception, match="kafka"):
        read_kafka(spark, servers="host:1", topic="topic")
    with pytest.raises(Exception, match="kafka"):
        kafka_sink(ticks(spark, 1).select(F.col("value").cast("string")), "host:1", "t", str(tmp_path)).start()


def test_checkpoint_paths():
    assert checkpoint_path("/base/") == "/base/resume"
    assert checkpoint_path("/base", resume=False) != checkpoint_path("/base", resume=False)


def test_scratch_dir(spark):
    assert shared_parent("/shared/folder", "spark://host:1") == "/shared/folder"
    assert shared_parent(None, "local[2]") == shared_parent(None, "local[4]")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_parent(None, "spark://host:1")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_generated_records(spark):
    template = {"name": ["a", "b"], "size": [1, 2.5, None, {"x": 1}], "none": [], "null": None}
    records = [json.loads(r.value) for r in generated_records(ticks(spark, 0, 200), template, seed=7).collect()]
    assert [r["batchCount"] for r in records] == [str(i) for i in range(200)]
    assert all(set(r) == {"name", "size", "@timestamp", "batchCount"} for r in records)
    assert {r["name"] for r in records} == {"a", "b"}
    assert all(r["size"] in [1, 2.5, None, {"x": 1}] for r in records)
    assert all(datetime.fromisoformat(r["@timestamp"]).utcoffset().total_seconds() == 0 for r in records)


def test_default_record(spark):
    record = json.loads(generated_records(ticks(spark, 0, 1)).first().value)
    assert set(record) == {"@message", "@tid", "@timestamp", "batchCount"}


def test_generated_stream_is_counted(spark, tmp_path):
    """The shared transform over the paced generator."""
    counts = jobs.salted_counts(generated_records(ticks(spark, 50)), "3 seconds")
    query = changelog_sink(counts, str(tmp_path / "out"), str(tmp_path / "c"), "1 second").start()
    try:
        while not any(p.numInputRows for p in query.recentProgress):
            assert query.awaitTermination(1) is False
    finally:
        query.stop()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert found and all((r.win_end - r.win_start).total_seconds() == 3 for r in found)
