"""Streams over the events table, run until the input is used up."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.transform import derive_events
from tarnlake.plans.registry import query
from tarnlake.scratch import fresh_path
from tarnlake.sources.readers import scan_path, table
from tarnlake.streaming import backlog, progress, trigger
from tarnlake.streaming import events as streams


FILES_AT_ONCE = 256


def event_stream(spark: SparkSession, sf: str, files_at_once: int | None = FILES_AT_ONCE) -> DataFrame:
    """The events table as a file stream; the pattern matches a file as well as a folder of files.

    A backlog of many files is taken in steps, so that no batch has to hold all of it. Steps are in the order in
    which files were written, not in the order of event time: under a watermark a second step would lose rows of
    windows closed by the first, so that ``ordered_stream`` is the one to take.
    """
    schema = table(spark, sf, "events").schema
    return streams.event_time(streams.file_stream(spark, f"{sf}/events.parquet*", schema, files_at_once), "ts")


def ordered_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events in the order of their time, in steps."""
    rows = table(spark, sf, "events")
    return streams.event_time(backlog.stream_by_time(rows, "ts", fresh_path(spark, "backlog")), "ts")


BUCKET = "make_timestamp((epoch_us(ts) // 30000000) * 30000000)"
COUNTS_SQL = f"""
SELECT {BUCKET} AS window_start, {BUCKET} + INTERVAL 30 SECOND AS window_end, event_type, count(*) AS count
FROM events GROUP BY ALL
"""


@query(COUNTS_SQL)
def stream_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Complete mode keeps all windows, so the watermark drops nothing."""
    path = fresh_path(spark, "window-counts")
    counts = streams.windowed_counts(event_stream(spark, sf), "ts", "event_type")
    done = streams.finish(streams.start_complete(counts, path, f"{path}-checkpoint", ["window_start", "event_type"]))
    return streams.wall_clock(streams.last_complete(spark, done, path), "window_start", "window_end")


@query(f"""
WITH c AS ({COUNTS_SQL}) SELECT * FROM c WHERE window_end <= (SELECT max(ts) - INTERVAL 30 SECOND FROM events)
""")
def stream_append_late(spark: SparkSession, sf: str) -> DataFrame:
    """Append mode emits a window once the watermark has passed its end; the last windows stay open. The backlog
    is taken in steps, in the order of event time."""
    path = fresh_path(spark, "append-counts")
    counts = streams.windowed_counts(ordered_stream(spark, sf), "ts", "event_type")
    streams.finish(streams.start_append(counts, path, f"{path}-checkpoint"))
    return streams.wall_clock(scan_path(spark, path), "window_start", "window_end")


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def stream_to_table(spark: SparkSession, sf: str) -> DataFrame:
    path, name = fresh_path(spark, "stream-table"), f"streamed_{uuid.uuid4().hex}"
    streams.finish(streams.start_table(event_stream(spark, sf), name, path, f"{path}-checkpoint"))
    spark.sql(f"DROP TABLE {name}")
    return streams.wall_clock(scan_path(spark, path), "ts")


@query("""
SELECT ts AS timestamp, 'user_' || CAST(event_id % 100 AS VARCHAR) AS user_id,
       CASE WHEN event_id % 3 = 0 THEN 'purchase' WHEN event_id % 3 = 1 THEN 'view' ELSE 'click' END AS event_type,
       CAST(event_id % 1000 AS DOUBLE) AS event_value
FROM events
""")
def stream_derived_events(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "derived")
    derived = derive_events(event_stream(spark, sf), "ts", "event_id")
    streams.finish(streams.start_append(derived, path, f"{path}-checkpoint"))
    return streams.wall_clock(scan_path(spark, path), "timestamp")


@query("SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS input_rows FROM events")
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """Input rows of all steps of the backlog, under the number of the first."""
    path = fresh_path(spark, "progress")
    streams.finish(streams.start_counted(event_stream(spark, sf), path, f"{path}-checkpoint"))
    return streams.written_progress(spark, path).agg(
        F.coalesce(F.min("batch_id"), F.lit(0)).cast("long").alias("batch_id"),
        F.coalesce(F.sum("input_rows"), F.lit(0)).cast("long").alias("input_rows"))


@query("""
SELECT c_mktsegment, count(*) AS events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error' GROUP BY c_mktsegment
""")
def stream_topology(spark: SparkSession, sf: str) -> DataFrame:
    path = fresh_path(spark, "topology")
    customers = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    totals = streams.joined_totals(
        event_stream(spark, sf), customers, "user_id", F.col("event_type") != "error", "c_mktsegment", "value")
    done = streams.finish(streams.start_complete(totals, path, f"{path}-checkpoint"))
    return streams.last_complete(spark, done, path).withColumn("total", F.col("total").cast("double"))


HOUR = "make_timestamp((epoch_us(ts) // 3600000000) * 3600000000)"


def _crossings_sql(condition: str) -> str:
    return f"""
WITH m AS (SELECT user_id, {HOUR} AS window_start, {HOUR} + INTERVAL 1 HOUR AS window_end, avg(value) AS mean
  FROM events WHERE {condition} GROUP BY ALL),
closed AS (SELECT * FROM m WHERE window_end <= (SELECT max(ts) - INTERVAL 30 SECOND FROM events WHERE {condition})),
l AS (SELECT *, lag(mean) OVER (PARTITION BY user_id ORDER BY window_start) AS previous_mean FROM closed)
SELECT user_id, window_start, window_end, round(mean, 6) AS mean, round(previous_mean, 6) AS previous_mean
FROM l WHERE mean > 20 AND previous_mean <= 20
"""


def _crossings(spark: SparkSession, sf: str, condition: str | None) -> DataFrame:
    path = fresh_path(spark, "crossings")
    found = trigger.becomes_greater(
        ordered_stream(spark, sf), "user_id", "ts", F.col("value"), 20.0, 3_600_000, streams.WATERMARK,
        None if condition is None else F.expr(condition))
    with trigger.rocksdb_state(spark):
        started = streams.start_append(found, path, f"{path}-checkpoint")
    streams.finish(started)
    return streams.wall_clock(scan_path(spark, path), "window_start", "window_end").withColumns(
        {"mean": F.round("mean", 6), "previous_mean": F.round("previous_mean", 6)})


@query(_crossings_sql("TRUE"))
def stream_crossings(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly means of each user, compared inside the stream as their windows close."""
    return _crossings(spark, sf, None)


TEXT_FILTER = "event_type IN ('purchase', 'click')"


@query(_crossings_sql(TEXT_FILTER))
def stream_crossings_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """The same for events of some types only."""
    return _crossings(spark, sf, TEXT_FILTER)


# Every eleventh event arrives three days late.
ARRIVAL = "CASE WHEN event_id % 11 = 0 THEN ts + INTERVAL 3 DAYS ELSE ts END"
ARRIVED_SQL = """
a AS (SELECT *, CASE WHEN event_id % 11 = 0 THEN ts + INTERVAL 3 DAY ELSE ts END AS arrival FROM events),
s AS (SELECT *, dense_rank() OVER (ORDER BY epoch_us(arrival) // {width}) - 1 AS batch FROM a),
m AS (SELECT batch, count(*) AS input_rows, max(epoch_us(max(ts)) // 1000) OVER (ORDER BY batch) - 30000 AS mark
  FROM s GROUP BY batch)
"""
DAY = 86_400_000_000


def arriving_stream(spark: SparkSession, sf: str, width: int) -> DataFrame:
    """The events in the order in which they arrive, a stretch of ``width`` microseconds a step."""
    rows = table(spark, sf, "events")
    step = F.lpad((F.unix_micros(F.expr(ARRIVAL).cast("timestamp")) / F.lit(width)).cast("long").cast("string"), 12, "0")
    return streams.event_time(backlog.stream_by_step(rows, step, fresh_path(spark, "arriving")), "ts")


@query(f"""
WITH {ARRIVED_SQL.format(width=2 * DAY)}
SELECT event_id, s.ts, event_type, s.batch FROM s JOIN m ON m.batch = s.batch - 2
WHERE (epoch_us(s.ts) // 30000000 + 1) * 30000 <= m.mark
""")
def stream_late_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that a windowed count of the arriving events would drop, as a table."""
    path = fresh_path(spark, "late-rows")
    arriving = arriving_stream(spark, sf, 2 * DAY)
    streams.finish(streams.start_split_late(arriving, "ts", streams.WINDOW, path, f"{path}-checkpoint"))
    late = streams.split_rows(spark, arriving.schema, path, late=True)
    return streams.wall_clock(late, "ts").select("event_id", "ts", "event_type", "batch")


@query(f"""
WITH {ARRIVED_SQL.format(width=DAY)},
marks AS (SELECT batch, input_rows, coalesce(lag(mark, 1) OVER w, 0) AS mark, coalesce(lag(mark, 2) OVER w, 0) AS late_mark
  FROM m WINDOW w AS (ORDER BY batch)),
judged AS (SELECT s.*, epoch_us(ts) <= late_mark * 1000 AS dropped FROM s JOIN marks USING (batch))
SELECT m.batch AS batch_id, m.input_rows, make_timestamp(m.mark * 1000) AS watermark,
       (SELECT count(*) FROM judged AS j WHERE j.batch = m.batch AND j.dropped) AS dropped_late,
       (SELECT count(*) FROM judged AS j WHERE j.batch <= m.batch AND NOT j.dropped AND epoch_us(j.ts) > m.mark * 1000) AS state_rows
FROM marks AS m
""")
def stream_progress_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events that may be delivered twice are kept once; every batch's record is read from the listener's table."""
    path, name = fresh_path(spark, "records"), f"records_{uuid.uuid4().hex}"
    once = arriving_stream(spark, sf, DAY).withWatermark("ts", streams.WATERMARK).dropDuplicates(["event_id", "ts"])
    with progress.recorded(spark, f"{path}/progress", name):
        writer = once.writeStream.queryName(name).format("noop").outputMode("append")
        streams.finish(writer.option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start())
    records = progress.progress_records(spark, f"{path}/progress").filter("input_rows > 0")
    return records.select("batch_id", "input_rows", F.col("watermark").cast("timestamp").cast("timestamp_ntz").alias("watermark"),
                          "dropped_late", "state_rows")


OFFSET_BUCKET = "make_timestamp(((epoch_us(ts) - 60000000) // 300000000) * 300000000 + 60000000)"


@query(f"""
SELECT {OFFSET_BUCKET} AS window_start, {OFFSET_BUCKET} + INTERVAL 5 MINUTE AS window_end,
       round(avg(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 6) AS mean
FROM events GROUP BY ALL
""")
def tumbling_offset(spark: SparkSession, sf: str) -> DataFrame:
    """Mean of a nested field per 5-minute window that starts one minute past."""
    path = fresh_path(spark, "offset")
    nested = F.get_json_object("props", "$.k").cast("double")
    means = streams.windowed_means(event_stream(spark, sf), "ts", nested, "5 minutes", "1 minute")
    done = streams.finish(streams.start_complete(means, path, f"{path}-checkpoint"))
    means = streams.wall_clock(streams.last_complete(spark, done, path), "window_start", "window_end")
    return means.withColumn("mean", F.round("mean", 6))
