"""Catalog listing, table profiles and a summary of the structure."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.quality import SAMPLE_ROWS, profile, sampled

LISTING_SCHEMA = "table_name string, position bigint, column_name string, data_type string, nullable boolean"
# Fixed list: type names that count as complex.
COMPLEX_TYPES = ("array", "struct", "map")


def catalog_tables(spark: SparkSession, table: str | None = None, fmt: str | None = "parquet",
                   database: str | None = None) -> dict[str, DataFrame]:
    """Readable tables of the current database or another one, or the one table named (without regard to case).

    Tables of another format than ``fmt`` and tables that cannot be opened are skipped, as is a database that
    doesn't exist; views count.
    """
    found = {}
    if database is not None and not spark.catalog.databaseExists(database):
        return found
    for entry in spark.catalog.listTables(database):
        if table is not None and entry.name.lower() != table.lower():
            continue
        name = f"`{entry.name}`" if entry.isTemporary or database is None else f"`{database}`.`{entry.name}`"
        try:
            if not entry.isTemporary and fmt is not None and entry.tableType != "VIEW":
                described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Provider'").first()
                if described is not None and described["data_type"].lower() != fmt:
                    continue
            found[entry.name] = spark.table(name)
        except AnalysisException:
            continue
    return found


def list_columns(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: table, position, name, type, nullable. Metadata only."""
    rows = [
        (name, position, f.name, f.dataType.simpleString(), f.nullable)
        for name, df in tables.items()
        for position, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, LISTING_SCHEMA)


def explore(spark: SparkSession, tables: Mapping[str, DataFrame], statistics: bool = False,
            samples: Mapping[str, Sequence[str]] | None = None, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Columns of every table with rows, nulls and, if wanted, statistics: one scan per table, one frame.

    With ``samples``, which names the columns that tell a table's rows apart (none: all), each line holds the
    column's values in a sample of ``rows`` rows.
    """
    def whole(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts)

    profiles = [profile(df, statistics).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    found = list_columns(spark, tables)
    if not tables:
        return found
    found = found.join(whole(profiles), ["table_name", "column_name"])
    if samples is None:
        return found
    taken = [sampled(df, rows, samples.get(name, ())).withColumn("table_name", F.lit(name)) for name, df in tables.items()]
    return found.join(whole(taken), ["table_name", "column_name"])


def summary(columns: DataFrame) -> DataFrame:
    """Tables, columns, mean columns per table (0 when there is none) and complex-typed columns."""
    is_complex = reduce(lambda a, b: a | b, [F.lower("data_type").contains(t) for t in COMPLEX_TYPES])
    per_table = columns.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_complex).alias("complex"))
    tables, total = F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))
    return per_table.agg(
        tables.alias("total_tables"),
        total.alias("total_columns"),
        F.coalesce(F.try_divide(total, tables), F.lit(0.0)).alias("avg_columns_per_table"),
        F.coalesce(F.sum("complex"), F.lit(0)).alias("complex_types_count"),
    )
