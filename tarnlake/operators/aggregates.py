"""Grouped reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.scalars import UNKNOWN

CENTS = 100


def whole_cents(column: str | Column) -> Column:
    """An amount in cents as a whole number.

    This way is several times faster than casting the double to a decimal.
    """
    value = F.col(column) if isinstance(column, str) else column
    return F.floor(value * CENTS + F.lit(0.5))


def cents(column: str | Column) -> Column:
    """Cents to be summed: exactly, in whatever order the partial sums arrive, without overflow."""
    return whole_cents(column).cast("decimal(18,0)")


def amount(total: Column, unit: int = CENTS) -> Column:
    """A sum of whole units as a double."""
    return total.cast("double") / unit


def amount_report(df: DataFrame, by: Sequence[str], value: str, date: str) -> DataFrame:
    """Count, total, mean and latest date per group, largest total first."""
    total = amount(F.sum(cents(value)))
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("count"),
            total.alias("total_amount"),
            (total / F.count(value)).alias("avg_amount"),
            F.max(date).alias("max_date"),
        )
        .orderBy(F.desc("total_amount"), *by)
    )


def revenue_report(df: DataFrame, by: str, revenue: Column, quantity: Column, count: Column,
                   revenue_unit: int = 1, quantity_unit: int = 1) -> DataFrame:
    """Total revenue, total quantity and number of transactions per group, largest revenue first.

    The columns may be sums of an earlier, finer grouping, in whole units of which ``unit`` make one.
    """
    return (
        df.groupBy(by)
        .agg(
            amount(F.sum(revenue), revenue_unit).alias("total_revenue"),
            amount(F.sum(quantity), quantity_unit).alias("total_quantity"),
            F.sum(count).alias("transaction_count"),
        )
        .orderBy(F.desc("total_revenue"), by)
    )


def revenue_average(df: DataFrame, by: str, revenue: Column, count: Column, unit: int = 1) -> DataFrame:
    """Total and mean revenue per group, largest total first; input may be pre-summed."""
    total = amount(F.sum(revenue), unit)
    return (
        df.groupBy(by)
        .agg(total.alias("total_revenue"), (total / F.sum(count)).alias("avg_revenue"))
        .orderBy(F.desc("total_revenue"), by)
    )


def state_counts(df: DataFrame, state: str) -> DataFrame:
    """Rows per state, states ascending; a missing state counts as ``Unknown``."""
    return df.groupBy(F.coalesce(F.col(state), F.lit(UNKNOWN)).alias("state")).count().orderBy("state")
