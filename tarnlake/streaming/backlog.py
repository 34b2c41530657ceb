"""Backlogs of files taken in steps: in the order of event time, or in the order in which rows arrived.

A file stream takes files by the time they were modified, which tells nothing of the event times inside. Where a
watermark drops late rows, a backlog that is taken in steps would lose those that a step before has closed. It is therefore
laid out anew, a range of event time a file, before it is streamed: then no row is late, and no step holds more than
its files.
"""

from __future__ import annotations

import time as clock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.sources.writers import _filesystem
from tarnlake.streaming.events import file_stream

ROWS_PER_FILE = 5_000_000
LEAST_FILES = 8
FILES_AT_ONCE = 4
SECOND = 1000


def lay_out_by_time(rows: DataFrame, time: str, path: str, rows_per_file: int = ROWS_PER_FILE) -> int:
    """Write rows as files of one range of event time each, in order; the number of files.

    Rows of the same time are told apart by a hash, so that a very frequent one is spread over several files. A
    null time comes first.
    """
    files = max(LEAST_FILES, -(-rows.count() // rows_per_file))
    rows.repartitionByRange(files, time, F.xxhash64(*rows.columns)).write.parquet(path)
    return put_in_order(rows.sparkSession, f"{path}/part-*")


def lay_out_by_step(rows: DataFrame, step: Column, path: str) -> int:
    """Write one file for each step, in the order of the steps (texts, as long as each other); their number."""
    stepped = rows.withColumn("step", step)
    stepped.repartition("step").write.partitionBy("step").parquet(path)
    return put_in_order(rows.sparkSession, f"{path}/step=*/part-*")


def put_in_order(spark: SparkSession, pattern: str) -> int:
    """Let files be modified one second after another, in the order of their names, the last one now."""
    files, target = _filesystem(spark, pattern)
    paths = sorted((s.getPath() for s in files.globStatus(target)), key=lambda p: p.toString())
    begin = int(clock.time()) * SECOND - len(paths) * SECOND
    for k, path in enumerate(paths):
        files.setTimes(path, begin + k * SECOND, -1)
    seen = [files.getFileStatus(p).getModificationTime() for p in paths]
    if seen != sorted(set(seen)):
        raise RuntimeError("this file system keeps its own times of modification; write the files one after another")
    return len(paths)


def stream_by_time(rows: DataFrame, time: str, path: str, files_at_once: int = FILES_AT_ONCE,
                   rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Rows as a stream in the order of event time, a few files a step."""
    lay_out_by_time(rows, time, path, rows_per_file)
    return file_stream(rows.sparkSession, path, rows.schema, files_at_once)


def stream_by_step(rows: DataFrame, step: Column, path: str) -> DataFrame:
    """Rows as a stream that takes one step after another."""
    lay_out_by_step(rows, step, path)
    return file_stream(rows.sparkSession, f"{path}/step=*", rows.schema, 1)
