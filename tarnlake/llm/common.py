"""What the operators share: keys without nulls, ranks inside large groups, written intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarnlake.scratch import fresh_path

# Fixed pattern: what separates words in all contracts of this package.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

ROWS_PER_CELL = 20_000
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def named(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """The whole row as one column ``row`` beside computed columns, so that no input name can clash."""
    return df.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, inputs: Sequence[str], results: Mapping[str, Column]) -> DataFrame:
    """The input columns again, followed by results; a result replaces an input column of its name."""
    taken = {n.lower() for n in results}
    kept = [F.col("row").getField(n).alias(n) for n in inputs if n.lower() not in taken]
    return df.select(*kept, *[c.alias(n) for n, c in results.items()])


def null_free(column: Column) -> Column:
    """A text key that is null for no row and differs for null, empty and any other value."""
    return F.when(column.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), column.cast("string")))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where ``use`` names it inside a lambda."""
    return F.transform(F.array(value), use)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def cell_count(spark: SparkSession, rows: int) -> int:
    """How many cells to cut ``rows`` into: each small for a task, and several for every partition."""
    return max(1, -(-rows // ROWS_PER_CELL), 2 * shuffle_partitions(spark))


def hash_cell(draw: Column, cells: int) -> Column:
    """The cell of an evenly spread 64-bit hash; cells are in the order of the hash read as unsigned."""
    return F.floor(F.shiftrightunsigned(draw, 32) * F.lit(cells) / F.lit(2.0**32)).cast("long")


def cell_rank(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    value: str | None = None,
    cell: str = "cell",
) -> DataFrame:
    """Rank rows inside groups of any size; ``cell`` (a long) must rise along the wanted order.

    Adds ``rank`` (from 0), ``group_rows`` and, with ``value``, ``before`` (the sum over the rows ahead)
    and ``group_value``. Counts of the cells are summed before they meet, and each row is ranked among
    those of its own cell only, so that a group with most of the rows is still many tasks. The group
    columns must not be null.
    """
    total = F.sum(value) if value else F.lit(0).cast("long")
    counts = df.groupBy(*groups, cell).agg(
        F.count(F.lit(1)).alias("_rows"), *([total.alias("_value")] if value else []))
    whole = Window.partitionBy(*groups)
    ahead = whole.orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    names = {"_rows": ("_rows_ahead", "group_rows")} | ({"_value": ("_value_ahead", "group_value")} if value else {})
    offsets = counts.select(
        *groups, cell,
        *[F.coalesce(F.sum(n).over(ahead), F.lit(0)).cast("long").alias(a) for n, (a, _) in names.items()],
        *[F.sum(n).over(whole).alias(t) for n, (_, t) in names.items()])
    inside = Window.partitionBy(*groups, cell).orderBy(*order)
    joined = df.join(offsets, [*groups, cell]).withColumn(
        "rank", F.col("_rows_ahead") + F.row_number().over(inside) - 1)
    if value:
        so_far = inside.rowsBetween(Window.unboundedPreceding, -1)
        joined = joined.withColumn(
            "before", F.col("_value_ahead") + F.coalesce(F.sum(value).over(so_far), F.lit(0)))
    return joined.drop(*[a for a, _ in names.values()])


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start from files, whatever
    executor is lost. The shuffle files behind it are of no more use, and Spark is told to drop them."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
