"""Sorts, row caps and the newest N per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.session import MB
from tarnlake.sizing import task_count

# Preview size, range of a row cap, newest runs kept, findings shown.
PREVIEW_ROWS = 10
CAP_MIN, CAP_MAX = 1, 100_000
NEWEST_PER_GROUP = 50
RECORDS_KEPT = 100
TOP_FINDINGS = 5
# Tasks whose newest rows of a group may meet in one.
TASKS_AT_ONCE = 1000


def preview(df: DataFrame, *order: str | Column) -> DataFrame:
    return (df.orderBy(*order) if order else df).limit(PREVIEW_ROWS)


def checked_cap(rows: int, low: int = CAP_MIN, high: int = CAP_MAX) -> int:
    """The cap itself; one outside of the range raises, as a smaller result would not show it."""
    if not low <= rows <= high:
        raise ValueError(f"a cap of {rows} rows is not within {low} and {high}")
    return rows


def capped(df: DataFrame, rows: int | None = None, order: Sequence[str | Column] = ()) -> DataFrame:
    """The rows in order, at most ``rows`` of them if that is given. The sort and the cap plan as one
    top-k step."""
    out = df.orderBy(*order) if order else df
    return out if rows is None else out.limit(checked_cap(rows))


def read_columns(df: DataFrame, columns: Sequence[str] = (), rows: int | None = None,
                 order: Sequence[str | Column] = ()) -> DataFrame:
    """Chosen columns of a table, all rows unless a cap is asked for."""
    out = capped(df, rows, order)
    return out.select(*columns) if columns else out


def newest_first(df: DataFrame, time: str, *ties: str) -> DataFrame:
    """Newest first; a missing time sorts last."""
    return df.orderBy(F.desc_nulls_last(time), *ties)


def newest_per_group(df: DataFrame, group: str, time: str, tie: str, rows: int = NEWEST_PER_GROUP,
                     salts: int | None = None) -> DataFrame:
    """Newest rows of each group.

    Spark limits every group inside each input task before the shuffle, so a group that holds most of
    the table sends only ``rows`` rows per task. Where that is more than ``TASKS_AT_ONCE`` tasks, their rows
    are limited once more by (group, salt), so that those of a hot group don't all meet in one task.
    """
    newest = [F.desc_nulls_last(time), F.desc(tie)]
    if salts is None:
        salts = -(-task_count(df, 128 * MB) // TASKS_AT_ONCE)
    if salts > 1:
        salted = df.withColumn("__salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
        nth = F.row_number().over(Window.partitionBy(group, "__salt").orderBy(*newest))
        df = salted.withColumn("__n", nth).filter(F.col("__n") <= rows).drop("__n", "__salt")
    nth = F.row_number().over(Window.partitionBy(group).orderBy(*newest))
    return df.withColumn("__n", nth).filter(F.col("__n") <= rows).drop("__n")


def top_by_priority(df: DataFrame, priority: str, sequence: str, rows: int = TOP_FINDINGS) -> DataFrame:
    """Highest priority first, ties in their given sequence."""
    return df.orderBy(F.desc(priority), sequence).limit(rows)


def top_by(df: DataFrame, measure: str, tie: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    return df.orderBy(F.desc(measure), tie).limit(rows)
