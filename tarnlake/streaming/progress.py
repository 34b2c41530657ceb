"""Progress of streams as a table: one record for each batch, however many there are."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

RECORD_SCHEMA = ("query_id string, run_id string, batch_id bigint, input_rows bigint, watermark string, "
                 "state_rows bigint, dropped_late bigint")


class ProgressRecorder(StreamingQueryListener):
    """Appends a record of each batch of one query to a folder, as the batch ends. Records come in order, in files of
    ``every`` records; what is left is written when the query ends."""

    def __init__(self, spark: SparkSession, path: str, query_name: str, every: int = 50):
        self.spark, self.path, self.query_name, self.every = spark, path, query_name, every
        self.run_id, self.held, self.ended, self.problem = None, [], threading.Event(), None

    def onQueryStarted(self, event) -> None:
        if event.name == self.query_name:
            self.run_id = str(event.runId)

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.query_name:
            return
        self.held.append((
            str(p.id), str(p.runId), p.batchId, p.numInputRows, dict(p.eventTime).get("watermark"),
            sum(s.numRowsTotal for s in p.stateOperators), sum(s.numRowsDroppedByWatermark for s in p.stateOperators)))
        if len(self.held) >= self.every:
            self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run_id:
            self._write()
            self.ended.set()

    def _write(self) -> None:
        try:
            if self.held:
                self.spark.createDataFrame(self.held, RECORD_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)
            self.held = []
        except Exception as problem:  # told to the one who waits, as a listener's own errors are only logged
            self.problem = problem


@contextmanager
def recorded(spark: SparkSession, path: str, query_name: str, every: int = 50, patience: float = 60.0) -> Iterator[None]:
    """Record the progress of the query of a name that is started, and ended, inside the block."""
    recorder = ProgressRecorder(spark, path, query_name, every)
    spark.streams.addListener(recorder)
    try:
        yield
        if recorder.run_id is None or not recorder.ended.wait(patience):
            raise TimeoutError(f"no end of a query named {query_name} was reported")
        if recorder.problem is not None:
            raise recorder.problem
    finally:
        spark.streams.removeListener(recorder)


def progress_records(spark: SparkSession, path: str) -> DataFrame:
    """One record a batch: of a batch that was run again after a restart, the one that has read most."""
    records = spark.read.schema(RECORD_SCHEMA).parquet(path)
    fields = [c for c in records.columns if c not in ("query_id", "batch_id")]
    newest = records.groupBy("query_id", "batch_id").agg(
        F.max_by(F.struct(*fields), F.struct("input_rows", "watermark")).alias("r"))
    return newest.select("query_id", "batch_id", *[F.col(f"r.{c}").alias(c) for c in fields])
