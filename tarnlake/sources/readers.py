"""Scans: catalog tables, paths, inline rows, SQL text, files and folders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Fixed list: the file types a load accepts.
LOADABLE = ("csv", "parquet")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def scan_path(spark: SparkSession, path: str, fmt: str = "parquet", **options: str) -> DataFrame:
    return spark.read.format(fmt).options(**options).load(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One Parquet table of a folder of tables."""
    return scan_path(spark, f"{folder}/{name}.parquet")


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: Mapping[str, str]) -> DataFrame:
    """Rows held in the program, with a declared schema; every column is nullable."""
    fields = [T.StructField(n, T.DataType.fromDDL(t), True) for n, t in schema.items()]
    return spark.createDataFrame(list(rows), T.StructType(fields))


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """SQL text over the given frames, each written as ``{name}`` in the text.

    Column types stay as they are when the result is empty.
    """
    return spark.sql(text, **frames)


def file_type(path: str) -> str:
    """Type by the extension before any ``?``, lower-cased; other types than the known are refused."""
    extension = path.split("?")[0].rsplit(".", 1)[-1].lower()
    if extension not in LOADABLE:
        raise ValueError(f"unsupported file type: {extension}; expected one of {', '.join(LOADABLE)}")
    return extension


def load_file(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A CSV (with header) or Parquet file. A declared schema saves the pass that infers CSV types."""
    kind = file_type(path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind == "csv":
        return reader.options(header=True, inferSchema=schema is None).csv(path.split("?")[0])
    return reader.parquet(path.split("?")[0])


def select_files(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    name_glob: str | None = None,
    modified_after: str | None = None,
    modified_before: str | None = None,
    recursive: bool = False,
    partition_root: str | None = None,
    **options: str,
) -> DataFrame:
    """Files of a folder by wildcard, modified time and depth.

    With ``partition_root`` the folder names ``key=value`` below it become columns; Spark does not
    discover them under a recursive listing.
    """
    chosen = {
        "pathGlobFilter": name_glob,
        "modifiedAfter": modified_after,
        "modifiedBefore": modified_before,
        "recursiveFileLookup": "true" if recursive else None,
        "basePath": partition_root,
    }
    reader = spark.read.format(fmt).options(**{k: v for k, v in chosen.items() if v is not None}, **options)
    return (reader if schema is None else reader.schema(schema)).load(path)
