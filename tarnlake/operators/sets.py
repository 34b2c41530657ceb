"""Unions of many sources, distinct rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.scratch import fresh_path

SOURCES_AT_ONCE = 8
ERROR_SCHEMA = "source string, error string"


@dataclass(frozen=True)
class Gathered:
    rows: DataFrame | None
    errors: DataFrame


def gather(spark: SparkSession, sources: Mapping[str, Callable[[], DataFrame]], tag: str = "source",
           fetch: bool = False, at_once: int = SOURCES_AT_ONCE) -> Gathered:
    """Union the listings of many sources, each row tagged with the source it came from.

    A source that cannot be opened is reported; the others go on. With ``fetch`` each source is read once
    into the shared folder, some of them at a time, so that one which fails while being read is reported too and ends
    nothing. Columns that a source lacks are null.
    """
    def open_one(name: str) -> DataFrame | tuple[str, str]:
        try:
            rows = sources[name]().withColumn(tag, F.lit(name))
            if fetch:
                path = fresh_path(spark, "fetched")
                rows.write.parquet(path)
                rows = spark.read.schema(rows.schema).parquet(path)
            return rows
        except (PySparkException, OSError, ValueError) as problem:
            return name, type(problem).__name__

    if fetch:
        with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(sources)))) as pool:
            opened = list(pool.map(open_one, sources))
    else:
        opened = [open_one(name) for name in sources]
    frames = [o for o in opened if isinstance(o, DataFrame)]
    errors = [o for o in opened if not isinstance(o, DataFrame)]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None
    return Gathered(rows, spark.createDataFrame(errors, ERROR_SCHEMA))


def source_report(gathered: Gathered, tag: str = "source") -> DataFrame:
    """Rows per source, and the sources that failed with their error."""
    failed = gathered.errors.select(
        F.col("source"), F.lit(0).cast("bigint").alias("rows"), F.col("error"))
    if gathered.rows is None:
        return failed
    counted = gathered.rows.groupBy(F.col(tag).alias("source")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(None).cast("string").alias("error"))
    return counted.unionByName(failed).orderBy("source")


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()
