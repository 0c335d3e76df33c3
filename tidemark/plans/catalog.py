"""Queries over the test tables, each with SQL for the same rows.

Event rows stand in for the inputs of the jobs: ``user_id`` or ``event_type`` is the device, ``ts`` its
time, ``event_id`` the order of arrival and ``props`` the JSON message.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import json as js
from tidemark.functions.keys import key_by, key_text, salt_key
from tidemark.functions.offset_lines import parse_offset_lines, range_text, to_offset_line
from tidemark.functions.timing import epoch_millis, from_millis, time_of_day_text
from tidemark.operators.filters import future_rows
from tidemark.operators.offset_ranges import lowest_deltas, ranges_by_topic, topic_stats, write_report
from tidemark.operators.throttle import last_emissions, throttle
from tidemark.operators.windows import last_value_windows, window_counts, window_totals
from tidemark.plans import jobs
from tidemark.session import scratch_dir
from tidemark.sources.generator import generated_records
from tidemark.sources.kafka import decode
from tidemark.sources.tables import as_telemetry, read_table, with_zoned_time
from tidemark.sources.text import numbered, read_lines, split_lines
from tidemark.streaming.replay import file_stream, replay_batches, replay_runs, replay_slices, replay_to_end, time_slices
from tidemark.streaming.sinks import (
    append_sink, bucketed_text_sink, changelog_sink, fold_buckets, latest_rows, latest_snapshot, read_buckets, snapshot_sink,
)
from tidemark.streaming.throttle import emitted_rows, throttle_batches, throttle_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TEN_MINUTES_MS = 10 * 60 * 1000
TEMPLATE = {"site": ["north", "south"], "level": [1, 2, 3], "ok": [True, False], "none": []}


def query(name: str, oracle: str | None = None):
    def add(run):
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add


def events(spark: SparkSession, folder: str) -> DataFrame:
    return with_zoned_time(read_table(spark, folder, "events"))


def event_slices(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The events in three spans of time, each a micro-batch or more of its own in a replay."""
    return time_slices(read_table(spark, folder, "events"), "ts", 3)


def zoneless(df: DataFrame) -> DataFrame:
    """Times as they compare with other engines."""
    times = [name for name, dtype in df.dtypes if dtype == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


def level() -> Column:
    """The number in ``props``."""
    return F.get_json_object("props", "$.k").cast("int")


# Milliseconds are cut, not rounded.
MS_SQL = "(epoch_us(ts) // 1000)"
LEVEL_SQL = "cast(json_extract_string(props, '$.k') as int)"

# --- Telemetry report (A3, W3, P14) -----------------------------------------------------------


def telemetry_sql(width: str) -> str:
    return f"""
        select cast(user_id as varchar) asset_id, time_bucket(interval '{width}', ts) win_start, count(*) cnt,
               round(avg(value) filter (where event_type <> 'error') / 60.0, 6) pw_1m,
               arg_max(event_id, (ts, event_id)) - arg_min(event_id, (ts, event_id)) prod_delta,
               round(avg({LEVEL_SQL}), 6) wind_avg
        from events group by 1, 2"""


def rounded_report(report: DataFrame) -> DataFrame:
    rounded = {c: F.round(c, 6) for c in ("pw_1m", "wind_avg")}
    return zoneless(report.withColumns(rounded))


@query("tumble_telemetry_1m", telemetry_sql("1 minute"))
def tumble_telemetry_1m(spark, folder):
    return rounded_report(jobs.telemetry(spark, as_telemetry(read_table(spark, folder, "events"))))


@query("tumble_telemetry_1h", telemetry_sql("1 hour"))
def tumble_telemetry_1h(spark, folder):
    return rounded_report(jobs.telemetry(spark, as_telemetry(read_table(spark, folder, "events")), "1 hour"))


def stream_telemetry(spark: SparkSession, folder: str, width: str) -> DataFrame:
    schema = read_table(spark, folder, "events").schema
    return replay_to_end(
        spark, f"{folder}/events.parquet", schema, "ts", lambda rows: jobs.telemetry(spark, as_telemetry(rows), width)
    )


@query("stream_telemetry_1m_append", telemetry_sql("1 minute"))
def stream_telemetry_1m_append(spark, folder):
    return rounded_report(stream_telemetry(spark, folder, "1 minute"))


@query("stream_telemetry_1h_changelog", telemetry_sql("1 hour"))
def stream_telemetry_1h_changelog(spark, folder):
    work = scratch_dir(spark, "changelog")

    def changes(rows):
        report = jobs.telemetry(spark, as_telemetry(rows), "1 hour")
        return changelog_sink(report, f"{work}/out", f"{work}/checkpoint", None, keys=("asset_id", "win_start"), fold_every=2)

    replay_runs(spark, event_slices(spark, folder), changes)
    return rounded_report(latest_rows(spark.read.parquet(f"{work}/out"), "asset_id", "win_start"))


# --- Last value per window (A1, F3, P15, P9) --------------------------------------------------


def last_value_sql(key: str, value: str, width: str) -> str:
    return f"""
        with r as (select {key} as key, ts, {MS_SQL} ms, event_id, {value} as v from events),
             w as (select key, time_bucket(interval '{width}', ts) win_start, count(*) cnt,
                          arg_max(v, (ms, -event_id)) filter (where v is not null) v,
                          arg_max(ts, (ms, -event_id)) filter (where v is not null) t
                   from r group by 1, 2)
        select win_start, key, coalesce(cast(v as double), 0.0) last_value, cnt,
               case when microsecond(t) = 0 and second(t) = 0 then strftime(t, '%H:%M')
                    when microsecond(t) % 1000000 = 0 then strftime(t, '%H:%M:%S')
                    when microsecond(t) % 1000 = 0 then strftime(t, '%H:%M:%S.%g')
                    else strftime(t, '%H:%M:%S.%f') end last_local_time
        from w"""


def no_error_value() -> Column:
    return F.when(F.col("event_type") != "error", F.col("value"))


NO_ERROR_SQL = "case when event_type <> 'error' then value end"


@query("window_last_value_1h", last_value_sql("event_type", "value", "1 hour"))
def window_last_value_1h(spark, folder):
    return zoneless(last_value_windows(events(spark, folder), "event_type", "ts", "value", "event_id", "1 hour"))


@query("window_last_value_nulls_1h", last_value_sql("cast(user_id as varchar)", NO_ERROR_SQL, "1 hour"))
def window_last_value_nulls_1h(spark, folder):
    rows = events(spark, folder)
    return zoneless(last_value_windows(rows, "user_id", "ts", no_error_value(), "event_id", "1 hour"))


def as_devices(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").cast("string").alias("device"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(F.col("event_type") != "error", level()).alias("production"),
    )


DEVICE_SQL = last_value_sql(
    "cast(user_id as varchar)", f"case when event_type <> 'error' then {LEVEL_SQL} end", "1 minute"
)


@query("device_last_values_1m", DEVICE_SQL)
def device_last_values_1m(spark, folder):
    return zoneless(jobs.device_last_values(as_devices(read_table(spark, folder, "events"))))


@query("stream_device_last_values_1m", DEVICE_SQL)
def stream_device_last_values_1m(spark, folder):
    slices = event_slices(spark, folder)
    return zoneless(replay_slices(spark, slices, lambda rows: jobs.device_last_values(as_devices(rows))))


LATE_DELAY = "1 day"


@query(
    "stream_late_rows",
    f"""with r as (select *, event_id % 7 = 0 late from events), w as (select max(ts) filter (where not late) top from r)
        select time_bucket(interval '1 hour', ts) win_start, count(*) cnt, count_if(late) cnt_late from r, w
        where not late or time_bucket(interval '1 hour', ts) + interval '1 hour' > date_trunc('millisecond', top) - interval '{LATE_DELAY}'
        group by 1""",
)
def stream_late_rows(spark, folder):
    """One row in seven comes after all others: it counts only if its window is still open."""
    late = F.col("event_id") % 7 == 0

    def counts(rows):
        timed = with_zoned_time(rows).withWatermark("ts", LATE_DELAY)
        hour = F.window("ts", "1 hour")
        return timed.groupBy(hour).agg(F.count("*").alias("cnt"), F.count_if(late).alias("cnt_late"))

    rows = read_table(spark, folder, "events")
    slices = [*time_slices(rows.filter(~late), "ts", 2), rows.filter(late)]
    return zoneless(replay_slices(spark, slices, counts).select(F.col("window.start").alias("win_start"), "cnt", "cnt_late"))


# --- Salted counts (G2, W1, W2, A2, P7) -------------------------------------------------------


def salted_sql(width: str) -> str:
    return f"""
        select 'groupKey_' || (event_id % 5) as key, time_bucket(interval '{width}', ts) win_start,
               time_bucket(interval '{width}', ts) + interval '{width}' win_end, count(*) cnt,
               '{{"key":"groupKey_' || (event_id % 5) || '","count":' || count(*) || '}}' as value
        from events group by event_id % 5, time_bucket(interval '{width}', ts)"""


def tolerant_sql(width: str) -> str:
    counts = salted_sql(width).replace("count(*) cnt,", f"count(*) cnt, count_if(not json_valid({MESSAGE_SQL})) bad,")
    return counts


def salted(spark: SparkSession, folder: str, width: str) -> DataFrame:
    return zoneless(window_counts(events(spark, folder), "ts", salt_key("event_id"), width))


@query("salted_window_count_1m", salted_sql("1 minute"))
def salted_window_count_1m(spark, folder):
    return salted(spark, folder, "1 minute")


@query("salted_window_count_3s", salted_sql("3 seconds"))
def salted_window_count_3s(spark, folder):
    return salted(spark, folder, "3 seconds")


TOTAL_SQL = """
    select time_bucket(interval '1 hour', ts) win_start, time_bucket(interval '1 hour', ts) + interval '1 hour' win_end,
           count(*) cnt
    from events group by 1, 2"""


@query("salted_total_1h", TOTAL_SQL)
def salted_total_1h(spark, folder):
    return zoneless(window_totals(events(spark, folder), "ts", salt_key("event_id"), "1 hour"))


@query("stream_salted_total_1h", TOTAL_SQL)
def stream_salted_total_1h(spark, folder):
    def totals(rows):
        return window_totals(with_zoned_time(rows).withWatermark("ts", "1 minute"), "ts", salt_key("event_id"), "1 hour")

    return zoneless(replay_slices(spark, event_slices(spark, folder), totals))


@query("stream_salted_snapshot_1h", salted_sql("1 hour"))
def stream_salted_snapshot_1h(spark, folder):
    work = scratch_dir(spark, "snapshot")
    schema = read_table(spark, folder, "events").schema
    rows = with_zoned_time(file_stream(spark, f"{folder}/events.parquet", schema))
    counts = window_counts(rows, "ts", salt_key("event_id"), "1 hour")
    snapshot_sink(counts, f"{work}/out", f"{work}/checkpoint", None).start().awaitTermination()
    return zoneless(latest_snapshot(spark.read.parquet(f"{work}/out")))


# --- JSON (P1-P4, P7) ------------------------------------------------------------------------


def message_rows(rows: DataFrame) -> DataFrame:
    """JSON messages, those of errors cut short."""
    cut = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    return rows.withColumn("value", cut)


MESSAGE_SQL = "case when event_type = 'error' then left(props, length(props) - 1) else props end"


@query("json_strict", "select event_id, cast(json(props) as varchar) as value from events")
def json_strict(spark, folder):
    parsed = js.with_json_object(events(spark, folder).select("event_id", F.col("props").alias("value")))
    return parsed.select("event_id", F.to_json(js.strict_object()).alias("value"))


@query(
    "json_fallback_line",
    f"""with m as (select event_id, {MESSAGE_SQL} as v from events)
        select event_id, not json_valid(v) is_bad,
               case when json_valid(v) then cast(json(v) as varchar) else cast(json_object('line', v) as varchar) end as value
        from m""",
)
def json_fallback_line(spark, folder):
    parsed = js.with_json_object(message_rows(events(spark, folder)))
    return parsed.select("event_id", F.col("obj").isNull().alias("is_bad"), js.json_or_line().alias("value"))


@query(
    "json_normalise_or_empty",
    f"""with m as (select event_id, {MESSAGE_SQL} as v from events)
        select event_id, case when json_valid(v) then cast(json(v) as varchar) else '' end as value from m""",
)
def json_normalise_or_empty(spark, folder):
    return jobs.normalised(message_rows(events(spark, folder)).select("event_id", "value"))


NUMBERS_SQL = """'{"n":' || event_id || '.10,"big":12345678901234567890123456789012345678901' || event_id
    || ',"e":1E5,"small":0.1234567890123456789012345678901234567890123,"s":"a  b \\" c","o":{"z":[1,2.0],"a":null}}'"""


def number_rows(rows: DataFrame) -> DataFrame:
    """Records whose numbers do not fit any binary type, with blanks between and inside of strings; some lines are bad."""
    bad = F.concat(F.lit("bad "), F.col("event_id").cast("string"))
    return number_texts(rows).withColumn("value", F.when(F.col("event_id") % 7 == 0, bad).otherwise(F.col("value")))


def number_texts(rows: DataFrame) -> DataFrame:
    text = F.format_string(
        '{ "n": %d.10, "big":12345678901234567890123456789012345678901%d,\t"e" : 1E5,"small":0.1234567890123456789012345678901234567890123, '
        '"s": "a  b \\" c", "o": {"z": [1, 2.0], "a": null} }\n',
        "event_id", "event_id",
    )
    return rows.withColumn("value", text)


@query(
    "json_numbers_fallback",
    f"""select event_id, case when event_id % 7 = 0 then '{{"line":"bad ' || event_id || '"}}' else {NUMBERS_SQL} end as value
        from events""",
)
def json_numbers_fallback(spark, folder):
    parsed = js.with_json_object(number_rows(events(spark, folder)))
    return parsed.select("event_id", js.json_or_line().alias("value"))


@query("json_numbers_normalise", f"select event_id, case when event_id % 7 = 0 then '' else {NUMBERS_SQL} end as value from events")
def json_numbers_normalise(spark, folder):
    return jobs.normalised(number_rows(events(spark, folder)).select("event_id", "value"))


@query("json_numbers_strict", f"select event_id, {NUMBERS_SQL} as value from events")
def json_numbers_strict(spark, folder):
    parsed = js.with_json_object(number_texts(events(spark, folder)))
    return parsed.select("event_id", js.strict_text().alias("value"))


def stamped_sql(text: str) -> str:
    """A JSON text without a stamp, stamped."""
    return f"""left({text}, length({text}) - 1) || ',"timeMillis":' || {MS_SQL} || '}}'"""


@query(
    "json_numbers_stamped",
    f"""with t as (select event_id, ts, case when event_id % 7 = 0 then '{{"line":"bad ' || event_id || '"}}'
                                              when event_id % 3 = 0 then replace({NUMBERS_SQL}, '{{"z"', '{{"timeMillis":1,"z"')
                                              else {NUMBERS_SQL} end as v from events)
        select event_id, {stamped_sql("v")} as value, {MS_SQL} stamp_ms from t""",
)
def json_numbers_stamped(spark, folder):
    """Some records are stamped already, before, after or within their other fields; some have such a field further down."""
    first, last = F.regexp_replace("value", r"^\{", '{"timeMillis": 5,'), F.regexp_replace("value", r"\}\s*$", ', "timeM\\\\u0069llis":{"a":[5,6]}}')
    inner = F.regexp_replace("value", r'"big":', '"timeMillis":"5,}", "timeMillis":6, "big":')
    rows = number_rows(events(spark, folder))
    rows = rows.withColumn("value", F.when(F.col("event_id") % 3 == 0, F.regexp_replace("value", r'\{"z"', '{"timeMillis":1, "z"')).otherwise(F.col("value")))
    by = F.when(F.col("event_id") % 4 == 1, first).when(F.col("event_id") % 4 == 2, last).when(F.col("event_id") % 4 == 3, inner).otherwise(F.col("value"))
    records = jobs.stamped(rows.select("event_id", "ts", F.when(F.col("event_id") % 7 == 0, F.col("value")).otherwise(by).alias("value")), strict=False, now_ms=epoch_millis("ts"))
    return records.select("event_id", "value", "stamp_ms")


@query(
    "json_fallback_html",
    "select page_id, cast(json_object('line', html) as varchar) as value from pages",
)
def json_fallback_html(spark, folder):
    parsed = js.with_json_object(read_table(spark, folder, "pages").select("page_id", F.col("html").alias("value")))
    return parsed.select("page_id", js.json_or_line().alias("value"))


@query(
    "json_stamped",
    f"""select event_id, '{{"k":' || {LEVEL_SQL} || ',"timeMillis":' || {MS_SQL} || '}}' as value,
               {MS_SQL} stamp_ms, make_timestamp_ms({MS_SQL}) event_time
        from events""",
)
def json_stamped(spark, folder):
    earlier = F.regexp_replace("props", "\\}$", ', "timeMillis": 5}')
    lines = events(spark, folder).select("event_id", "ts", earlier.alias("value"))
    records = jobs.stamped(lines, strict=True, now_ms=epoch_millis("ts"))
    return zoneless(records.select("event_id", F.to_json("fields").alias("value"), "stamp_ms", "event_time"))


def job_counts(spark: SparkSession, folder: str, width: str, strict: bool) -> DataFrame:
    rows = events(spark, folder)
    lines = rows.withColumn("value", F.col("props")) if strict else message_rows(rows)
    counts = jobs.salted_counts(lines, width, strict, row_id="event_id", now_ms=epoch_millis("ts"))
    return zoneless(counts)


@query("job_strict_counts_1m", salted_sql("1 minute"))
def job_strict_counts_1m(spark, folder):
    return job_counts(spark, folder, "1 minute", strict=True)


@query("job_tolerant_counts_1m", tolerant_sql("1 minute"))
def job_tolerant_counts_1m(spark, folder):
    return job_counts(spark, folder, "1 minute", strict=False)


@query("job_strict_counts_3s", salted_sql("3 seconds"))
def job_strict_counts_3s(spark, folder):
    return job_counts(spark, folder, "3 seconds", strict=True)


@query("stream_job_tolerant_counts_1m", tolerant_sql("1 minute"))
def stream_job_tolerant_counts_1m(spark, folder):
    def counts(rows):
        lines = message_rows(with_zoned_time(rows))
        return jobs.salted_counts(lines, strict=False, row_id="event_id", now_ms=epoch_millis("ts"))

    schema = read_table(spark, folder, "events").schema
    return zoneless(replay_to_end(spark, f"{folder}/events.parquet", schema, "ts", counts))


@query("stream_job_strict_counts_3s", salted_sql("3 seconds"))
def stream_job_strict_counts_3s(spark, folder):
    def counts(rows):
        lines = with_zoned_time(rows).withColumn("value", F.col("props"))
        return jobs.salted_counts(lines, "3 seconds", row_id="event_id", now_ms=epoch_millis("ts"))

    schema = read_table(spark, folder, "events").schema
    return zoneless(replay_to_end(spark, f"{folder}/events.parquet", schema, "ts", counts, end_text="{}"))


# --- Times and keys (P8-P10, P16, G1) -----------------------------------------------------------


@query(
    "epoch_millis_and_local_time",
    f"""select event_id, {MS_SQL} ms, make_timestamp_ms({MS_SQL}) from_ms,
              case when microsecond(ts) = 0 and second(ts) = 0 then strftime(ts, '%H:%M')
                   when microsecond(ts) % 1000000 = 0 then strftime(ts, '%H:%M:%S')
                   when microsecond(ts) % 1000 = 0 then strftime(ts, '%H:%M:%S.%g')
                   else strftime(ts, '%H:%M:%S.%f') end local_time,
              case when second(ts) = 0 then strftime(ts, '%H:%M') else strftime(ts, '%H:%M:%S') end second_time,
              strftime(ts, '%H:%M') minute_time
       from events""",
)
def epoch_millis_and_local_time(spark, folder):
    return zoneless(
        events(spark, folder).select(
            "event_id",
            epoch_millis("ts").alias("ms"),
            from_millis(epoch_millis("ts")).alias("from_ms"),
            time_of_day_text("ts").alias("local_time"),
            time_of_day_text(F.date_trunc("second", "ts")).alias("second_time"),
            time_of_day_text(F.date_trunc("minute", "ts")).alias("minute_time"),
        )
    )


@query("keyed_rows", "select event_id, cast(user_id as varchar) as key, value from events")
def keyed_rows(spark, folder):
    return key_by(events(spark, folder), "user_id", "event_id").select("event_id", "key", "value")


@query("key_text", "select cast(user_id as varchar) as key, count(*) cnt from events group by 1")
def key_text_counts(spark, folder):
    return events(spark, folder).groupBy(key_text("user_id").alias("key")).agg(F.count("*").alias("cnt"))


# --- Offset ranges (S7, S8, F1, F2, P11-P13, A4, A5, T1, K8) -------------------------------------

# Lines of errors lack a part; those of signups shout; those of views have a second colon.
OFFSETS_SQL = f"""
    select event_id line_no, event_type topic, cast(user_id % 64 as int) as "partition", event_id * 100 from_offset,
           event_id * 100 + user_id * 100 + {LEVEL_SQL} until_offset, user_id * 100 + {LEVEL_SQL} delta
    from events where event_type <> 'error'"""


def offset_lines(spark: SparkSession, folder: str) -> DataFrame:
    first = F.col("event_id") * 100
    topic = F.when(F.col("event_type") == "view", F.lit("view:extra")).otherwise(F.col("event_type"))
    line = to_offset_line(topic, (F.col("user_id") % 64).cast("int"), first, first + F.col("user_id") * 100 + level())
    shaped = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("note: gap    "), F.split(line, "    ")[2]))
        .when(F.col("event_type") == "signup", F.replace(F.replace(line, F.lit("topic:"), F.lit(" TOPIC:")), F.lit("offsets"), F.lit("OFFSETS")))
        .otherwise(line)
    )
    text = F.concat(shaped, F.lit("\n"))
    return events(spark, folder).select(F.col("event_id").alias("line_no"), F.explode(F.split(text, "\n")).alias("value"))


def offset_ranges(spark: SparkSession, folder: str) -> DataFrame:
    return parse_offset_lines(offset_lines(spark, folder))


@query("offset_parse", f"""select *, from_offset || ' -> ' || until_offset || ' = ' || delta range_text from ({OFFSETS_SQL}) r""")
def offset_parse(spark, folder):
    return offset_ranges(spark, folder).withColumn("range_text", range_text())


@query(
    "offset_parse_text_block",
    f"""select line_no as block, cast(0 as bigint) line_no, topic, "partition", from_offset, until_offset, delta from ({OFFSETS_SQL}) r
        union all select line_no, cast(2 as bigint), topic, "partition", from_offset, until_offset, delta from ({OFFSETS_SQL}) r""",
)
def offset_parse_text_block(spark, folder):
    """Blocks of text: the line, an empty line, the line again."""
    lines = offset_lines(spark, folder).filter(F.col("value") != "")
    text = F.concat("value", F.lit("\n\n"), "value")
    blocks = lines.select(F.col("line_no").alias("block"), text.alias("text"))
    return parse_offset_lines(split_lines(blocks, "text", "block"))


STATS_SQL = f"""
    select topic, count(*) cnt, min(delta) min_delta, max(delta) max_delta, cast(sum(delta) // count(*) as bigint) avg_delta
    from ({OFFSETS_SQL}) r group by 1"""


@query("offset_topic_stats", STATS_SQL)
def offset_topic_stats(spark, folder):
    return topic_stats(offset_ranges(spark, folder))


@query("offset_topic_stats_file", STATS_SQL)
def offset_topic_stats_file(spark, folder):
    path = f"{scratch_dir(spark, 'offset-lines')}/lines"
    offset_lines(spark, folder).select("value").write.text(path)
    return topic_stats(parse_offset_lines(read_lines(spark, path)))


LOWEST_SQL = f"""
    select topic, cast(rk as int) as rank, delta, part as "partition", from_offset, until_offset
    from (select *, row_number() over (partition by topic order by delta) rk, count(*) over (partition by topic) nd
          from (select topic, delta, arg_max("partition", line_no) part, arg_max(from_offset, line_no) from_offset,
                       arg_max(until_offset, line_no) until_offset
                from ({OFFSETS_SQL}) r group by 1, 2) d) q
    where nd > 3 and rk <= 3"""


@query("offset_bottom3", LOWEST_SQL)
def offset_bottom3(spark, folder):
    return lowest_deltas(offset_ranges(spark, folder))


@query("offset_bottom3_files", LOWEST_SQL)
def offset_bottom3_files(spark, folder):
    """The lines in several files: of equal deltas in different files the one in the last file counts."""
    path = f"{scratch_dir(spark, 'offset-files')}/lines"
    offset_lines(spark, folder).repartitionByRange(5, "line_no").sortWithinPartitions("line_no").select("value").write.text(path)
    return lowest_deltas(parse_offset_lines(read_lines(spark, path)))


@query(
    "offset_ranges_by_topic",
    f"""select topic, line_no, "partition", from_offset, until_offset, delta from ({OFFSETS_SQL}) r""",
)
def offset_ranges_by_topic(spark, folder):
    """Ranges are dealt out by a sample of them, so they are parsed once, into a table."""
    return ranges_by_topic(jobs.kept_ranges(offset_ranges(spark, folder)))


REPORT_SQL = f"""with r as ({OFFSETS_SQL}), s as ({STATS_SQL}), l as ({LOWEST_SQL})
        select topic, 0 section, cast(0 as bigint) as position, topic as line from s
        union all select topic, 1, line_no, chr(9) || "partition" || '-> ' || from_offset || ' -> ' || until_offset || ' = ' || delta from r
        union all select topic, 2, 0, topic || ' 统计: count=' || cnt || ', minDelta=' || min_delta || ', maxDelta=' || max_delta
                         || ', averageDelta=' || avg_delta from s
        union all select topic, 3, rank, chr(9) || '最小Delta ' || delta || ' : ' || from_offset || ' -> ' || until_offset || ' = ' || delta from l"""


@query("offset_report", REPORT_SQL)
def offset_report(spark, folder):
    """The ranges are parsed once, into a table that all sections read, as in J8."""
    return jobs.describe_offsets(jobs.kept_ranges(offset_ranges(spark, folder)))["report"]


@query("offset_report_text", f"select row_number() over (order by topic, section, position) - 1 as line_no, line as value from ({REPORT_SQL}) t")
def offset_report_text(spark, folder):
    """The report written as text and read back in the order of its files and lines."""
    path = f"{scratch_dir(spark, 'offset-report')}/report"
    write_report(offset_report(spark, folder), path)
    return numbered(spark, path)


# --- Clock skew and sampling (F5, X1, K5) --------------------------------------------------------

# A device clock that is 0 to 990 seconds ahead.
DEVICE_MS_SQL = f"({MS_SQL} + {LEVEL_SQL} * 10000)"


def device_ms() -> Column:
    return epoch_millis("ts") + level() * 10000


@query(
    "future_skew_rows",
    f"select event_id, {DEVICE_MS_SQL} time_ms from events where {DEVICE_MS_SQL} - {MS_SQL} > 600000",
)
def future_skew_rows(spark, folder):
    return future_rows(events(spark, folder), device_ms(), epoch_millis("ts")).select("event_id", device_ms().alias("time_ms"))


def next_sql(wait: int, rows: str) -> str:
    """The next row of the key after a wait, as (ms, event_id) in one struct."""
    return f"(select k, ms, min(event_id) event_id from e where {rows} group by k, ms)"


def sampled_sql(waits: dict[int, str], key: str = "event_type") -> str:
    joins = " ".join(
        f"asof left join {next_sql(wait, rows)} n{wait} on e.k = n{wait}.k and n{wait}.ms > e.ms + {wait}"
        for wait, rows in waits.items()
    )
    options = " union all ".join(
        f"select event_id, m{wait} ms, i{wait} id from j where i{wait} is not null" for wait in waits
    )
    picks = ", ".join(f"n{wait}.ms m{wait}, n{wait}.event_id i{wait}" for wait in waits)
    return f"""
        with recursive e as (select {key} k, {MS_SQL} ms, event_id, {LEVEL_SQL} lvl from events),
        j as (select e.event_id, {picks} from e {joins}),
        hop as materialized (select event_id, arg_min(id, (ms, id)) nxt from ({options}) o group by event_id),
        chain as (select arg_min(event_id, (ms, event_id)) event_id from e group by k
                  union all select h.nxt from chain c join hop h on h.event_id = c.event_id)
        select e.k as key, event_id from chain join e using (event_id)"""


THROTTLE_SQL = sampled_sql({TEN_MINUTES_MS: "true"})
SAMPLE_SQL = sampled_sql({jobs.AHEAD_WAIT_MS: "lvl > 60", jobs.SAMPLE_WAIT_MS: "lvl <= 60"})


@query("throttle_10m", THROTTLE_SQL)
def throttle_10m(spark, folder):
    kept = throttle(events(spark, folder), "event_type", epoch_millis("ts"), TEN_MINUTES_MS, "event_id")
    return kept.select(F.col("event_type").alias("key"), "event_id")


@query("sample_ahead", SAMPLE_SQL)
def sample_ahead(spark, folder):
    kept = jobs.sample_table(events(spark, folder), "event_type", device_ms(), epoch_millis("ts"), "event_id")
    return kept.select(F.col("event_type").alias("key"), "event_id")


@query("stream_throttle_10m", THROTTLE_SQL)
def stream_throttle_10m(spark, folder):
    """Few keys, so each micro-batch is throttled as a table."""
    work = scratch_dir(spark, "throttle")

    def kept(rows):
        rows = with_zoned_time(rows).select("event_type", "ts", "event_id")
        out, checkpoint = f"{work}/out", f"{work}/checkpoint"
        return throttle_batches(rows, "event_type", epoch_millis("ts"), TEN_MINUTES_MS, "event_id", out, checkpoint, None)

    replay_batches(spark, event_slices(spark, folder), kept)
    return emitted_rows(spark, f"{work}/out").select(F.col("event_type").alias("key"), "event_id")


@query("stream_sample_ahead", SAMPLE_SQL)
def stream_sample_ahead(spark, folder):
    work = scratch_dir(spark, "sample")

    def kept(rows):
        rows = with_zoned_time(rows).select("event_type", "ts", "event_id", "props")
        out, checkpoint = f"{work}/out", f"{work}/checkpoint"
        return jobs.sample_stream(rows, "event_type", device_ms(), epoch_millis("ts"), "event_id", out, checkpoint, None)

    replay_batches(spark, event_slices(spark, folder), kept)
    return emitted_rows(spark, f"{work}/out").select(F.col("event_type").alias("key"), "event_id")


@query(
    "stream_sampled_lines",
    f"""with s as ({sampled_sql({jobs.SAMPLE_WAIT_MS: "true"})}), t as (select event_id, ts, {NUMBERS_SQL} v from events)
        select key, event_id, {stamped_sql("v")} as value from s join t using (event_id)""",
)
def stream_sampled_lines(spark, folder):
    """J2 from text to text: parse, stamp and sample, in three micro-batches or more."""
    work = scratch_dir(spark, "sampled-lines")

    def kept(rows):
        lines = number_texts(with_zoned_time(rows)).select("event_type", "event_id", "ts", "value")
        return jobs.sampled_lines(lines, "event_type", "event_id", f"{work}/out", f"{work}/checkpoint", None, epoch_millis("ts"))

    replay_batches(spark, event_slices(spark, folder), kept)
    return emitted_rows(spark, f"{work}/out").select(F.col("event_type").alias("key"), "event_id", "value")


@query("stream_throttle_user_10m", sampled_sql({TEN_MINUTES_MS: "true"}, "cast(user_id as varchar)"))
def stream_throttle_user_10m(spark, folder):
    """Many keys, with state per key."""
    work = scratch_dir(spark, "throttle")

    def kept(rows):
        rows = with_zoned_time(rows).select("user_id", "ts", "event_id")
        first = throttle_stream(rows, "user_id", epoch_millis("ts"), TEN_MINUTES_MS, "event_id").select("key", "event_id")
        return append_sink(first, f"{work}/out", f"{work}/checkpoint", None)

    replay_batches(spark, event_slices(spark, folder), kept)
    return spark.read.parquet(f"{work}/out")


@query("stream_throttle_handover", sampled_sql({TEN_MINUTES_MS: "true"}, "cast(user_id as varchar)"))
def stream_throttle_handover(spark, folder):
    """A backfill as a table, the first third, and a stream that goes on from where it ended."""
    work = scratch_dir(spark, "handover")
    first, *rest = [with_zoned_time(rows) for rows in event_slices(spark, folder)]
    ms = epoch_millis("ts")
    throttle(first, "user_id", ms, TEN_MINUTES_MS, "event_id").select("user_id", "ts", "event_id").write.parquet(f"{work}/first")
    done = spark.read.parquet(f"{work}/first")
    last_emissions(done, "user_id", ms).write.parquet(f"{work}/last")

    def kept(rows):
        rows = rows.select("user_id", "ts", "event_id")
        live = throttle_stream(rows, "user_id", ms, TEN_MINUTES_MS, "event_id", initial=spark.read.parquet(f"{work}/last"))
        return append_sink(live.select("key", "event_id"), f"{work}/out", f"{work}/checkpoint", None)

    replay_batches(spark, rest, kept)
    return done.select(F.col("user_id").cast("string").alias("key"), "event_id").unionByName(spark.read.parquet(f"{work}/out"))


# --- Sources and sinks (S1, S6, K2) ---------------------------------------------------------------


@query(
    "kafka_decode",
    """select props as value, ts record_time, 'events' topic, cast(user_id % 16 as int) as "partition", event_id as "offset" from events""",
)
def kafka_decode(spark, folder):
    """Kafka columns as a source gives them, decoded."""
    records = events(spark, folder).select(
        F.lit(None).cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        (F.col("user_id") % 16).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return zoneless(decode(records).drop("row_id"))


@query(
    "templated_generator",
    """select cast(event_id as varchar) batch_count, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') stamp, true site_ok, true level_ok,
              true ok_ok, 5 fields
       from events""",
)
def templated_generator(spark, folder):
    """One generated record per event: the drawn values are random, so only that they fit is shown."""
    ticks = events(spark, folder).select(F.col("ts").alias("timestamp"), F.col("event_id").alias("value"))
    parsed = generated_records(ticks, TEMPLATE).select(F.parse_json("value").alias("v"), "value")
    return parsed.select(
        F.variant_get("v", "$.batchCount", "string").alias("batch_count"),
        F.variant_get("v", "$['@timestamp']", "string").alias("stamp"),
        F.variant_get("v", "$.site", "string").isin(*TEMPLATE["site"]).alias("site_ok"),
        F.variant_get("v", "$.level", "int").isin(*TEMPLATE["level"]).alias("level_ok"),
        F.variant_get("v", "$.ok", "boolean").isNotNull().alias("ok_ok"),
        F.size(F.json_object_keys("value")).alias("fields"),
    )


BUCKETS_SQL = f"""with m as (select ts, {MESSAGE_SQL} as v from events)
        select strftime(ts, '%Y-%m-%d--%H') bucket, case when json_valid(v) then cast(json(v) as varchar) else '' end as value from m"""


@query("file_sink_bucketed", BUCKETS_SQL)
def file_sink_bucketed(spark, folder):
    work = scratch_dir(spark, "buckets")
    schema = read_table(spark, folder, "events").schema
    rows = message_rows(with_zoned_time(file_stream(spark, f"{folder}/events.parquet", schema)))
    lines = jobs.normalised(rows.select("ts", "value"))
    sink = bucketed_text_sink(lines, f"{work}/out", f"{work}/checkpoint", "ts", files_per_bucket=4, interval=None)
    sink.start().awaitTermination()
    return spark.read.schema("value STRING, bucket STRING").text(f"{work}/out")


@query("file_sink_folded", BUCKETS_SQL)
def file_sink_folded(spark, folder):
    """The hours before the newest are folded between the runs; hours that go on in the next run have files of both kinds."""
    work = scratch_dir(spark, "buckets")

    runs = []

    def bucketed(rows):
        if runs:
            fold_buckets(spark, f"{work}/out")
        runs.append(rows)
        lines = jobs.normalised(message_rows(with_zoned_time(rows)).select("ts", "value"))
        return bucketed_text_sink(lines, f"{work}/out", f"{work}/checkpoint", "ts", files_per_bucket=2, interval=None)

    replay_runs(spark, event_slices(spark, folder), bucketed)
    return read_buckets(spark, f"{work}/out")
