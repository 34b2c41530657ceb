"""Copy jobs: column mapping, incremental copies, and rows that do not fit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.functions.predicates import all_of, any_of
from tarnlake.sources import writers

MARKS = "batch int, mark string"


@dataclass(frozen=True)
class ColumnMap:
    source: str
    target: str
    type: str | None = None


def mapped(df: DataFrame, mapping: Sequence[ColumnMap]) -> DataFrame:
    """Choose, convert and rename columns; a value that cannot be converted raises."""
    return df.select(*[
        (F.col(m.source) if m.type is None else F.col(m.source).cast(m.type)).alias(m.target) for m in mapping
    ])


def split_incompatible(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the types, converted, and the rows that do not, as they came."""
    misfit = any_of([F.col(c).isNotNull() & F.col(c).try_cast(t).isNull() for c, t in types.items()])
    good = df.filter(~misfit).select(*[
        F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    return good, df.filter(misfit)


def copy_rows(
    df: DataFrame,
    path: str,
    mapping: Sequence[ColumnMap] = (),
    append: bool = False,
    partition_by: Sequence[str] = (),
) -> writers.WriteResult:
    rows = mapped(df, mapping) if mapping else df
    return writers.write_files(rows, path, mode="append" if append else "overwrite", partition_by=partition_by)


def _mark_path(root: str) -> str:
    return f"{root}/_marks"


def read_mark(spark: SparkSession, root: str, data_type: str) -> str | None:
    """Highest change-column value copied so far, as text. Marks are only ever appended."""
    if not writers.path_exists(spark, _mark_path(root)):
        return None
    marks = spark.read.schema(MARKS).parquet(_mark_path(root))
    return marks.agg(F.max(F.col("mark").cast(data_type)).cast("string")).first()[0]


def _next_batch(spark: SparkSession, root: str) -> int:
    """Number after the last batch that ended with its mark; one that failed before is written again."""
    if not writers.path_exists(spark, _mark_path(root)):
        return 0
    return spark.read.schema(MARKS).parquet(_mark_path(root)).agg(F.max("batch") + 1).first()[0]


def _not_copied(near: DataFrame, copied: DataFrame, keys: Sequence[str], change_column: str) -> DataFrame:
    """Rows near the mark that no earlier batch holds: by keys and change value, or as whole rows."""
    if not keys:
        # Rows that occur several times are copied as often.
        return near.exceptAll(copied.select(*near.columns))
    names = list(dict.fromkeys([*keys, change_column]))
    known = copied.select(*[F.col(c).alias(f"__{c}") for c in names]).distinct()
    return near.join(known, all_of([F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]), "left_anti")


def incremental_copy(df: DataFrame, change_column: str, root: str, keys: Sequence[str] = (),
                     overlap: Column | None = None) -> int:
    """Append the rows that no earlier run copied, then move the mark. Returns the number of rows copied.

    Rows past the mark are new. Rows at the mark, up to ``overlap`` before it, or without a change value may
    have come since: they are compared with what is copied of that stretch, by ``keys`` and change value, or
    as whole rows where no keys are given. Rows that come later than the overlap are not seen. With keys, a row
    whose change value moved on is copied again.

    The new mark is observed during the write. A batch is numbered by the marks before it, so that one
    repeated after a failure replaces its own files and copies nothing twice.
    """
    spark = df.sparkSession
    kind = df.schema[change_column].dataType.simpleString()
    mark, batch = read_mark(spark, root, kind), _next_batch(spark, root)
    fresh, change = df, F.col(change_column)
    if batch:
        copied = copied_rows(spark, root, df.schema, batch)
        unknown, past = change.isNull(), F.lit(False)
        if mark is not None:
            value = F.lit(mark).cast(kind)
            past = change > value
            unknown = unknown | ((change >= (value if overlap is None else value - overlap)) & (change <= value))
        else:
            past = change.isNotNull()
        fresh = df.filter(past).unionByName(
            _not_copied(df.filter(unknown), copied.filter(unknown), keys, change_column))
    seen = Observation()
    counted = fresh.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(change).cast("string").alias("mark"))
    counted.write.mode("overwrite").parquet(f"{root}/rows/batch={batch}")
    got = seen.get
    if got["rows"]:
        spark.range(1).select(F.lit(batch).cast("int").alias("batch"), F.lit(got["mark"]).cast("string").alias("mark")) \
            .coalesce(1).write.mode("append").parquet(_mark_path(root))
    return int(got["rows"])


def copied_rows(spark: SparkSession, root: str, schema: T.StructType | None = None, before: int | None = None) -> DataFrame:
    """The rows of all batches, or of those before a number."""
    reader = spark.read if schema is None else spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())]))
    rows = reader.parquet(f"{root}/rows")
    return (rows if before is None else rows.filter(F.col("batch") < before)).drop("batch")
