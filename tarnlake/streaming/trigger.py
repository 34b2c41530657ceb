"""A trigger inside a stream: for each object, the moment when the mean of a time window becomes greater than a bound."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class BecomesGreater(StatefulProcessor):
    """State of an object: the mean of the last window that closed.

    Windows reach it as they close, each once. Those of a later batch end later, so that they are put in order inside a
    batch only. So little is held, and asked of the state, that an object may have any number of rows and windows.
    """

    def __init__(self, key: str, bound: float):
        self.key, self.bound = key, bound

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "mean double, known boolean")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        previous = self.last.get()
        before = previous[0] if previous is not None and previous[1] else None
        for start, end, mean in sorted(((r["start_ms"], r["end_ms"], r["mean"]) for r in rows), key=lambda w: w[0]):
            if mean is not None and before is not None and mean > self.bound >= before:
                yield Row(**{self.key: key[0], "start_ms": start, "end_ms": end, "mean": mean, "previous_mean": before})
            before = mean
        self.last.update((0.0 if before is None else before, before is not None))

    def close(self) -> None:
        pass


def becomes_greater(events: DataFrame, key: str, time: str, value: Column, bound: float, width_ms: int,
                    watermark: str, condition: Column | None = None) -> DataFrame:
    """Windows whose mean is greater than the bound while that of the object's window before is not, each time.

    ``condition`` keeps the events that count, such as those with a certain text. Windows begin at whole multiples of
    their width; one without events is none, and one without values has no mean to be compared with. The result is a
    stream in append mode: a window is judged once the watermark has passed its end. Spark's own windowed aggregate
    forms the means, and only means of closed windows go through Python.
    """
    kept = events if condition is None else events.filter(condition)
    plain = kept.filter(F.col(time).isNotNull()).select(
        key, time, value.cast("double").alias("__value")).withWatermark(time, watermark)
    means = plain.groupBy(key, F.window(time, f"{width_ms} milliseconds").alias("__window")).agg(
        F.avg("__value").alias("mean"))
    closed = means.select(
        key, F.unix_millis("__window.start").alias("start_ms"), F.unix_millis("__window.end").alias("end_ms"), "mean")
    shape = T.StructType([
        T.StructField(key, events.schema[key].dataType), T.StructField("start_ms", T.LongType()),
        T.StructField("end_ms", T.LongType()), T.StructField("mean", T.DoubleType()),
        T.StructField("previous_mean", T.DoubleType())])
    found = closed.groupBy(key).transformWithState(BecomesGreater(key, bound), shape, "Append", "None")
    return found.select(
        key, F.timestamp_millis("start_ms").alias("window_start"), F.timestamp_millis("end_ms").alias("window_end"),
        "mean", "previous_mean")


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside the block keep their state in RocksDB, on disk and not on the heap; arbitrary keyed
    state asks for it."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
