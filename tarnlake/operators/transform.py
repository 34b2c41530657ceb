"""Projection, filter and derived columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.scalars import parse_date, tagged_modulo


def transform(
    df: DataFrame,
    columns: Sequence[str] = (),
    condition: str | Column | None = None,
    processed_at: Column | None = None,
) -> DataFrame:
    """Select (all columns when none are named), filter, and stamp the rows with ``processed_date``."""
    out = df if condition is None else df.filter(condition)
    out = out.select(*columns) if columns else out
    return out.withColumn("processed_date", F.current_timestamp() if processed_at is None else processed_at)


def sales_etl(df: DataFrame, date: str, quantity: str, price: str) -> DataFrame:
    """Parse the date, add revenue, year and month."""
    return (
        df.withColumn(date, parse_date(F.col(date)))
        .withColumn("revenue", F.col(quantity) * F.col(price))
        .withColumn("year", F.year(date))
        .withColumn("month", F.month(date))
    )


def event_kind(number: Column) -> Column:
    """Fixed rule: remainder by three gives purchase, view, click."""
    return F.when(number % 3 == 0, "purchase").when(number % 3 == 1, "view").otherwise("click")


def derive_events(df: DataFrame, time: str, number: str) -> DataFrame:
    """(timestamp, user_id, event_type, event_value) from a running number; batch or stream."""
    value = F.col(number)
    return df.select(
        F.col(time).alias("timestamp"),
        tagged_modulo("user_", value, 100).alias("user_id"),
        event_kind(value).alias("event_type"),
        (value % 1000).cast("double").alias("event_value"),
    )


def non_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))
