"""Profiles and quality checks; every check is one pass over the table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 10


def size_of(df: DataFrame) -> DataFrame:
    """Record count and column count."""
    return df.agg(F.count(F.lit(1)).alias("records"), F.lit(len(df.columns)).alias("columns"))


def _statistics(f: T.StructField) -> list[Column]:
    """Mean, standard deviation, least and greatest value of a column; null where they mean nothing."""
    column = F.col(f.name)
    number = column if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")
    sortable = column if isinstance(f.dataType, T.AtomicType) else F.lit(None)
    return [
        F.avg(number).cast("double").alias("mean"),
        F.stddev(number).alias("stddev"),
        F.min(sortable).cast("string").alias("min"),
        F.max(sortable).cast("string").alias("max"),
    ]


def column_statistics(df: DataFrame) -> DataFrame:
    """Count, mean, standard deviation, least and greatest value of each numeric and text column."""
    described = [f for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType))]
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.count(f.name).alias("count"), *_statistics(f))
            for f in described]
    return df.agg(F.array(*rows).alias("r")).select(F.inline("r"))


def profile(df: DataFrame, statistics: bool = True) -> DataFrame:
    """Rows, nulls, null percentage and, if wanted, statistics of every column, in one pass."""
    rows = F.count(F.lit(1))
    lines = []
    for f in df.schema.fields:
        nulls = F.count_if(F.col(f.name).isNull())
        lines.append(F.struct(
            F.lit(f.name).alias("column_name"), rows.alias("rows"), nulls.alias("null_count"),
            _percent(nulls, rows).alias("null_pct"), *(_statistics(f) if statistics else [])))
    return df.agg(F.array(*lines).alias("r")).select(F.inline("r"))


def sampled(df: DataFrame, rows: int = SAMPLE_ROWS, by: Sequence[str] = ()) -> DataFrame:
    """The values of a few rows, for each column (``column_name``) as a JSON list of texts (``sample``), rows in one
    order for all.

    The rows are those with the least digests of the ``by`` columns, or of all: each task keeps as many as are wanted,
    so that any layout of the table gives the same, and so does another run.
    """
    digest = F.md5(F.concat_ws("|", *[_spelled(df, c) for c in (by or df.columns)]))
    names = [f"__c{i}" for i in range(len(df.columns))]
    few = df.select(digest.alias("__digest"), *[_spelled(df, c).alias(n) for c, n in zip(df.columns, names)]) \
        .orderBy("__digest", *names).limit(rows)
    kept = few.agg(F.sort_array(F.collect_list(F.struct("__digest", *names))).alias("r"))
    lines = [F.struct(F.lit(c).alias("column_name"), F.to_json(F.col("r")[n]).alias("sample")) for c, n in zip(df.columns, names)]
    return kept.select(F.inline(F.array(*lines)))


def _spelled(df: DataFrame, column: str) -> Column:
    """The value as a text that no other value of the column has."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.to_json(F.col(column), {"ignoreNullFields": "false"})
    return F.hex(column) if isinstance(kind, T.BinaryType) else F.col(column).cast("string")


def _row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 over the row, each value preceded by its length, so that no two rows spell the same text."""
    parts = []
    for c in columns:
        text = _spelled(df, c)
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def duplicate_rows(df: DataFrame, columns: Sequence[str] = (), digest: bool = False) -> DataFrame:
    """Rows, distinct rows and their difference, over all columns or a key subset.

    ``digest`` groups by a 256-bit digest of the row: with long texts the shuffle then carries
    32 bytes per row instead of the text.
    """
    names = list(columns) or df.columns
    keys = [_row_digest(df, names).alias("__digest")] if digest else [F.col(c) for c in names]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    rows = F.coalesce(F.sum("__n"), F.lit(0))
    return groups.agg(
        rows.alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (rows - F.count(F.lit(1))).alias("duplicate_rows"),
    )


def _percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), 2)


def null_report(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """Nulls and their percentage per column; the percentage is null for an empty table."""
    chosen = df.select(*columns) if columns else df
    return profile(chosen, statistics=False).select("column_name", "null_count", "null_pct")


def type_validation(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Values per column that cannot be read as the wanted type; nulls are no failures."""
    lines = []
    for c, wanted in types.items():
        present = F.col(c).isNotNull()
        lines.append(F.struct(
            F.lit(c).alias("column_name"),
            F.lit(wanted).alias("expected_type"),
            F.count_if(present).alias("checked"),
            F.count_if(present & F.col(c).try_cast(wanted).isNull()).alias("invalid"),
        ))
    return df.agg(F.array(*lines).alias("r")).select(F.inline("r"))
