"""Structured Streaming over event tables.

Streams run until the available input is used up (``availableNow``) or on a processing-time trigger.
State and offsets live in a checkpoint under the shared folder; sinks are Parquet tables.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tarnlake.operators.transform import derive_events

# Fixed settings of the event stream.
ROWS_PER_SECOND = 10
WATERMARK = "30 seconds"
WINDOW = "30 seconds"
TRIGGER = "10 seconds"

EVENT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("user_id", T.StringType(), True),
    T.StructField("event_type", T.StringType(), True),
    T.StructField("value", T.DoubleType(), True),
])
PROGRESS_SCHEMA = "batch_id bigint, input_rows bigint, watermark string, state_rows bigint, dropped_late bigint"


def rate_events(spark: SparkSession, rows_per_second: int = ROWS_PER_SECOND) -> DataFrame:
    """Synthetic events from the rate source."""
    numbers = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return derive_events(numbers, "timestamp", "value")


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a path pattern, with a declared schema."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need a timestamp with time zone; the wall-clock time is read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def windowed_counts(df: DataFrame, time: str, kind: str, width: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Rows per tumbling window and event type; batch or stream."""
    counted = df.withWatermark(time, watermark).groupBy(F.window(time, width).alias("window"), kind).count()
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          kind, "count")


def windowed_means(df: DataFrame, time: str, value: Column, width: str, offset: str, watermark: str = WATERMARK,
                   by: Sequence[str] = ()) -> DataFrame:
    """Mean per tumbling window whose start is shifted by an offset."""
    means = df.withWatermark(time, watermark).groupBy(F.window(time, width, width, offset).alias("window"), *by) \
        .agg(F.avg(value).alias("mean"))
    return means.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                        *by, "mean")


def joined_totals(df: DataFrame, static: DataFrame, key: str, condition: Column, by: str, value: str) -> DataFrame:
    """Stream topology: filter, join a static table, total and count per group."""
    return (
        df.filter(condition).join(static, key, "inner").groupBy(by)
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.col(value).cast("decimal(18,2)")).alias("total"))
    )


def start_append(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to a folder of Parquet files."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return _triggered(writer, once).start(path)


def start_table(df: DataFrame, name: str, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream to a catalog table over a folder."""
    writer = df.writeStream.format("parquet").outputMode("append") \
        .option("checkpointLocation", checkpoint).option("path", path)
    return _triggered(writer, once).toTable(name)


def start_counted(df: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append a stream, a folder of its own per batch, and write the row count of each batch beside it.

    Batches that are run again replace their folders. The counts are a table, so that they don't end where
    the progress records that a query holds do.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        seen = Observation()
        batch.observe(seen, F.count(F.lit(1)).alias("input_rows")) \
            .write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        batch.sparkSession.range(1).select(
            F.lit(batch_id).cast("long").alias("batch_id"), F.lit(seen.get["input_rows"]).cast("long").alias("input_rows"),
        ).write.mode("overwrite").parquet(f"{path}/progress/batch={batch_id}")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save)
    return _triggered(writer, once).start()


def written_progress(spark: SparkSession, path: str) -> DataFrame:
    """Batches and their row counts, as written by ``start_counted``."""
    return spark.read.schema("batch_id bigint, input_rows bigint").parquet(f"{path}/progress/batch=*")


def start_split_late(df: DataFrame, time: str, width: str, path: str, checkpoint: str, watermark: str = WATERMARK,
                     once: bool = True) -> StreamingQuery:
    """Write a stream in two parts: the rows that a windowed count under the watermark takes, and those that it
    drops without a word, since their window has closed.

    A window has closed in a batch if its end is not after the watermark which the batch before went by: the greatest time
    of all batches ahead of that one, less the delay. Each batch writes a folder of its own, and the greatest
    time so far beside it; a batch that is run again replaces both.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, seen = batch.sparkSession, Observation()
        marks = spark.read.schema("mark timestamp")
        closed = F.lit(None).cast("timestamp")
        if batch_id >= 2:
            ahead = marks.parquet(f"{path}/marks/batch={batch_id - 2}").first()["mark"]
            # Watermarks are whole milliseconds.
            closed = F.date_trunc("millisecond", F.lit(ahead)) - F.expr(f"INTERVAL {watermark}")
        late = F.coalesce(F.window(time, width)["end"] <= closed, F.lit(False))
        batch.withColumn("is_late", late).observe(seen, F.max(time).alias("mark")) \
            .write.mode("overwrite").partitionBy("is_late").parquet(f"{path}/rows/batch={batch_id}")
        own = spark.range(1).select(F.lit(seen.get["mark"]).cast("timestamp").alias("mark"))
        if batch_id:
            own = own.unionByName(marks.parquet(f"{path}/marks/batch={batch_id - 1}"))
        own.agg(F.max("mark").alias("mark")).write.mode("overwrite").parquet(f"{path}/marks/batch={batch_id}")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(save)
    return _triggered(writer, once).start()


def split_rows(spark: SparkSession, schema: T.StructType, path: str, late: bool) -> DataFrame:
    """The late rows, or the others, of ``start_split_late``, with the ``batch`` that they came in."""
    fields = [*schema.fields, T.StructField("batch", T.LongType()), T.StructField("is_late", T.BooleanType())]
    rows = spark.read.schema(T.StructType(fields)).option("basePath", f"{path}/rows").parquet(f"{path}/rows/batch=*")
    return rows.filter(F.col("is_late") == late).drop("is_late")


def start_complete(df: DataFrame, path: str, checkpoint: str, order: Sequence[str] = (), once: bool = True) -> StreamingQuery:
    """Write the whole result after each trigger, sorted, to a folder of its own per batch.

    A batch that is run again replaces its own folder, so a failure leaves nothing twice. Only the newest two
    results stay: the last one, and the one before for those who still read it.
    """
    result = df.orderBy(*order) if order else df

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        files, folders = _batch_folders(batch.sparkSession, path)
        for number, folder in folders.items():
            if number < batch_id - 1:
                files.delete(folder, True)

    writer = result.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).foreachBatch(save)
    return _triggered(writer, once).start()


def _batch_folders(spark: SparkSession, path: str):
    """The file system of a path, and its folders ``batch=<n>`` by n."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [status.getPath() for status in files.listStatus(root)]
    return files, {int(f.getName().removeprefix("batch=")): f for f in found if f.getName().startswith("batch=")}


def _triggered(writer, once: bool):
    return writer.trigger(availableNow=True) if once else writer.trigger(processingTime=TRIGGER)


def last_complete(spark: SparkSession, query: StreamingQuery, path: str) -> DataFrame:
    """Result of the last batch of a finished query started with ``start_complete``.

    That is the newest folder: a query resumed without new input reports a batch that it never wrote.
    """
    return spark.read.parquet(f"{path}/batch={max(_batch_folders(spark, path)[1])}")


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait until the available input is used up; errors of the stream are raised here."""
    query.awaitTermination()
    return query


def _progress(query: StreamingQuery) -> list[dict]:
    return [p if isinstance(p, dict) else json.loads(p.json) for p in query.recentProgress]


def progress_frame(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """Progress records that the query still holds, one row per batch."""
    rows = [
        (
            p["batchId"],
            p["numInputRows"],
            p.get("eventTime", {}).get("watermark"),
            sum(s["numRowsTotal"] for s in p.get("stateOperators", [])),
            sum(s["numRowsDroppedByWatermark"] for s in p.get("stateOperators", [])),
        )
        for p in _progress(query)
    ]
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)
