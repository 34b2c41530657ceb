import time

import duckdb
import pytest
from pyspark.sql import functions as F

from oracle_check import compare
from tarnlake import scratch
from tarnlake.plans import ORACLES, QUERIES
from tarnlake.plans.streams import FILES_AT_ONCE
from tarnlake.streaming import backlog as backlogs
from tarnlake.streaming import events as streams
from tarnlake.streaming import progress, trigger


def batches(spark, groups):
    """One file per group, in the order given, to be read one per trigger."""
    path = scratch.fresh_path(spark, "in")
    for group in groups:
        rows = spark.createDataFrame([(t, k) for t, k in group], "t string, kind string")
        rows.select(F.to_timestamp("t").alias("t"), "kind").coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    return streams.file_stream(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)


EARLY = [("2024-01-01 00:00:05", "a"), ("2024-01-01 00:00:06", "a")]
FAR = [("2024-01-01 00:05:00", "a")]
LATE = [("2024-01-01 00:00:07", "a")]


def test_complete_mode_keeps_late_rows(spark):
    path = scratch.fresh_path(spark, "out")
    counts = streams.windowed_counts(batches(spark, [EARLY, FAR, LATE]), "t", "kind")
    done = streams.finish(streams.start_complete(counts, path, f"{path}-c", ["window_start"]))
    rows = streams.last_complete(spark, done, path).orderBy("window_start").collect()
    assert [r["count"] for r in rows] == [3, 1]


def test_last_complete_of_a_query_resumed_without_input(spark):
    path = scratch.fresh_path(spark, "out")
    source = batches(spark, [EARLY, FAR])
    for _ in range(2):
        counts = streams.windowed_counts(source, "t", "kind")
        done = streams.finish(streams.start_complete(counts, path, f"{path}-c", ["window_start"]))
        assert streams.last_complete(spark, done, path).count() == 2


def test_complete_results_of_old_batches_are_removed(spark):
    path = scratch.fresh_path(spark, "out")
    counts = streams.windowed_counts(batches(spark, [EARLY, FAR, FAR, LATE]), "t", "kind")
    done = streams.finish(streams.start_complete(counts, path, f"{path}-c"))
    kept = sorted(streams._batch_folders(spark, path)[1])
    assert len(kept) == 2 and kept[1] == kept[0] + 1 and kept[0] >= 1
    assert streams.last_complete(spark, done, path).agg(F.sum("count")).first()[0] == 5


def test_append_mode_drops_late_rows_and_keeps_open_windows_back(spark):
    path = scratch.fresh_path(spark, "out")
    # Late rows are judged by the watermark of the batch before, hence the second far batch.
    counts = streams.windowed_counts(batches(spark, [EARLY, FAR, FAR, LATE]), "t", "kind")
    done = streams.finish(streams.start_append(counts, path, f"{path}-c"))
    assert [r["count"] for r in spark.read.parquet(path).collect()] == [2]
    progress = streams.progress_frame(spark, done)
    assert progress.agg(F.sum("dropped_late"), F.sum("input_rows")).first()[:] == (1, 5)


def test_stream_resumes_from_its_checkpoint(spark):
    source = scratch.fresh_path(spark, "in")
    path = scratch.fresh_path(spark, "out")

    def run(day):
        spark.range(5).selectExpr(f"{day} AS day", "id").coalesce(1).write.mode("append").parquet(source)
        stream = streams.file_stream(spark, source, spark.read.parquet(source).schema)
        streams.finish(streams.start_table(stream, "resumed", path, f"{path}-c"))
        spark.catalog.refreshTable("resumed")
        return spark.table("resumed").count()

    assert [run(1), run(2)] == [5, 10]


def test_rate_source(spark):
    stream = streams.rate_events(spark, 100)
    assert stream.columns == ["timestamp", "user_id", "event_type", "event_value"]
    path = scratch.fresh_path(spark, "rate")
    query = streams.start_append(stream, path, f"{path}-c", once=False)
    try:
        for _ in range(60):
            if any(p["numInputRows"] for p in query.recentProgress):
                break
            time.sleep(0.5)
    finally:
        query.stop()
    rows = spark.read.parquet(path)
    assert rows.count() > 0
    assert rows.filter("user_id NOT RLIKE '^user_[0-9]+$' OR event_type NOT IN ('purchase', 'view', 'click')").count() == 0


@pytest.fixture(scope="module")
def backlog(spark):
    """Events in files of several steps, in no order of time. Late rows are dropped from the third step on."""
    folder = scratch.fresh_path(spark, "backlog")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(2 * FILES_AT_ONCE + 188).write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["stream_append_late", "stream_crossings_filtered", "stream_progress", "stream_window_counts"])
def test_a_backlog_of_many_files_gives_the_rows_of_the_sql(spark, backlog, name):
    duck = duckdb.connect()
    duck.execute("SET TimeZone = 'UTC'")
    duck.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{backlog}/events.parquet/*.parquet')")
    assert compare(QUERIES[name](spark, backlog), duck, ORACLES[name]) is None


def test_files_are_streamed_in_the_order_of_event_time(spark):
    path = scratch.fresh_path(spark, "laid-out")
    rows = spark.range(400).selectExpr("timestamp_seconds((id * 37) % 400 + IF(id % 4 = 0, 0, 100000)) AS t", "id")
    stream = backlogs.stream_by_time(rows, "t", path, files_at_once=3, rows_per_file=40)
    counts = stream.withWatermark("t", "0 seconds").groupBy(F.window("t", "10 seconds")).count()
    done = streams.finish(streams.start_append(counts, f"{path}-out", f"{path}-c"))
    progressed = streams.progress_frame(spark, done)
    assert progressed.filter("input_rows > 0").count() >= 3
    assert progressed.agg(F.sum("dropped_late")).first()[0] == 0
    newest = rows.agg(F.max("t")).first()[0]
    closed = rows.groupBy(F.window("t", "10 seconds")).count().filter(F.col("window.end") <= F.lit(newest))
    assert spark.read.parquet(f"{path}-out").agg(F.sum("count")).first()[0] == closed.agg(F.sum("count")).first()[0]


def test_one_hot_time_is_spread_over_files(spark):
    path = scratch.fresh_path(spark, "laid-out")
    rows = spark.range(800).selectExpr("timestamp_seconds(IF(id % 3 = 0, id, 5)) AS t", "id")
    assert backlogs.lay_out_by_time(rows, "t", path, rows_per_file=100) == 8
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy("_metadata.file_path").count().collect()]
    assert max(sizes) < 300


def test_late_rows_are_those_that_a_windowed_count_drops(spark):
    groups = [EARLY, FAR, FAR, LATE, [("2024-01-01 00:04:45", "b"), ("2024-01-01 00:04:25", "late")]]
    path = scratch.fresh_path(spark, "split")
    source = batches(spark, groups)
    streams.finish(streams.start_split_late(source, "t", "30 seconds", path, f"{path}-c"))
    late = streams.split_rows(spark, source.schema, path, late=True)
    assert sorted((r["kind"], r["batch"]) for r in late.collect()) == [("a", 3), ("late", 4)]
    assert streams.split_rows(spark, source.schema, path, late=False).count() == 5
    counts = streams.windowed_counts(source, "t", "kind")
    done = streams.finish(streams.start_append(counts, f"{path}-counts", f"{path}-counts-c"))
    assert streams.progress_frame(spark, done).agg(F.sum("dropped_late")).first()[0] == late.count()


def test_records_of_more_batches_than_a_query_holds(spark):
    path = scratch.fresh_path(spark, "recorded")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "3")
    try:
        stream = batches(spark, [EARLY, FAR, FAR, LATE, FAR, FAR, FAR])
        counts = streams.windowed_counts(stream, "t", "kind")
        with progress.recorded(spark, path, "recorded_query", every=2):
            writer = counts.writeStream.queryName("recorded_query").format("noop").option("checkpointLocation", f"{path}-c")
            done = streams.finish(writer.trigger(availableNow=True).start())
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    records = progress.progress_records(spark, path).orderBy("batch_id").collect()
    assert len(done.recentProgress) <= 3 < len(records)
    assert sum(r["input_rows"] for r in records) == 9 and sum(r["dropped_late"] for r in records) == 1
    assert [r["batch_id"] for r in records] == list(range(len(records)))
    assert records[2]["watermark"] == "2024-01-01T00:04:30.000Z" and records[0]["state_rows"] == 1


def test_a_recorder_says_when_no_query_ran(spark):
    with pytest.raises(TimeoutError):
        with progress.recorded(spark, scratch.fresh_path(spark, "r"), "never_started"):
            pass


@pytest.mark.parametrize("parts", [1, 2])
def test_trigger_gives_the_same_rows_after_a_restart(spark, parts):
    """State and timers come back from the checkpoint; null values and keys have no effect on others."""
    folder, path = scratch.fresh_path(spark, "in"), scratch.fresh_path(spark, "out")
    values = [1.0, 9.0, None, 9.0, 2.0, 9.0, 9.0, 3.0, 10.0, 1.0]
    rows = spark.createDataFrame(
        [(o, 60 * h + m, v) for h, v in enumerate(values) for m in (0, 30) for o in ("x", None)] + [("y", 5, 9.0), ("y", None, 9.0)],
        "object string, seconds long, value double").select("object", F.timestamp_seconds("seconds").alias("t"), "value")
    for part in range(parts):
        low, high = 600 * part / parts, 600 * (part + 1) / parts
        seconds = F.coalesce(F.col("t").cast("long"), F.lit(0))
        rows.filter((seconds >= low) & (seconds < high)).coalesce(1).write.mode("append").parquet(folder)
        found = trigger.becomes_greater(
            streams.file_stream(spark, folder, rows.schema), "object", "t", F.col("value"), 5.0, 60_000, "0 seconds")
        with trigger.rocksdb_state(spark):
            started = streams.start_append(found, path, f"{path}-c")
        streams.finish(started)
        time.sleep(1.1)
    got = spark.read.parquet(path).select("object", (F.col("window_start").cast("long") / 60).cast("int"), "mean", "previous_mean")
    wanted = [(o, h, values[h], values[h - 1]) for o in ("x", None) for h in (1, 5, 8)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, wanted))


def test_trigger_asks_the_state_once_a_batch_and_object(spark):
    """Windows are formed by Spark's aggregate, and Python gets one row for each that closed, not one an event."""
    folder, path = scratch.fresh_path(spark, "in"), scratch.fresh_path(spark, "out")
    rows = spark.range(6000).selectExpr(
        "id % 2 AS object", "timestamp_seconds(id div 10) AS t", "IF(id div 600 % 2 = 0, 1.0D, 9.0D) AS value")
    rows.coalesce(1).write.parquet(folder)
    found = trigger.becomes_greater(
        streams.file_stream(spark, folder, rows.schema), "object", "t", F.col("value"), 5.0, 60_000, "0 seconds")
    with trigger.rocksdb_state(spark):
        started = streams.start_append(found, path, f"{path}-c")
    done = streams.finish(started)
    operators = [o for p in done.recentProgress for o in p["stateOperators"]]
    assert sum(o["numRowsUpdated"] for o in operators if "transformWithState" in o["operatorName"]) <= 2
    got = spark.read.parquet(path).select("object", (F.col("window_start").cast("long") / 60).cast("int"))
    assert sorted(map(tuple, got.collect())) == [(o, h) for o in (0, 1) for h in (1, 3, 5, 7)]
