"""Table writes that count what they wrote, keep a history, and then move the catalog entry.

A table is a catalog entry over a folder ``<root>/version=<n>``. Every write fills a new folder and then
points the catalog at it, so readers of the old version go on and a failed write leaves the table alone. Of a
partitioned table the partitions are moved one by one: it is there all the time, and readers who begin
meanwhile see some partitions before and some after the write. Columns may be added in place; only a write that
drops a column, changes a type or changes the partitioning has to make the entry anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from time import monotonic
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.session import MB
from tarnlake.sizing import scanned_bytes

HISTORY_SCHEMA = ("version bigint, written_at timestamp, operation string, rows_in bigint, rows_out bigint, "
                  "seconds double, path string")
ROWS_PER_FILE = 20_000_000
DDL_AT_ONCE = 500
# A task sorts the rows of the file that it writes, which take up to ten times as much memory as their file.
FILE_BYTES = 64 * MB
# Fixed name: the folder in which Spark writes rows whose partition value is null or an empty text.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class WriteResult:
    path: str
    rows: int
    seconds: float


def write_files(
    df: DataFrame,
    path: str,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    rows_per_file: int = ROWS_PER_FILE,
    **options: str,
) -> WriteResult:
    """Write files and take the row count and time from the write itself, not from a second scan.

    A partitioned write is rebalanced on the partition columns first, so that a partition value gets few
    files of good size, and a very frequent one is still written by several tasks.
    """
    laid_out = rebalance(df, *partition_by) if partition_by else df
    return write_laid_out(laid_out, path, partition_by, mode, fmt, rows_per_file, **options)


def write_laid_out(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    fmt: str = "parquet",
    rows_per_file: int = ROWS_PER_FILE,
    **options: str,
) -> WriteResult:
    """``write_files`` of rows that stay in the tasks they are in."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.format(fmt).mode(mode).option("maxRecordsPerFile", rows_per_file).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    start = monotonic()
    writer.save(path)
    return WriteResult(path, int(seen.get["rows"]), monotonic() - start)


def rebalance(df: DataFrame, *columns: str) -> DataFrame:
    """Ask AQE for right-sized output partitions; a skewed partition is split, small ones are merged."""
    return df.hint("rebalance", *columns)


def spread(df: DataFrame) -> DataFrame:
    """Repartition to twice the default parallelism."""
    return df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism)


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist a reused frame and fill it with a count. The caller unpersists it."""
    kept = df.persist()
    return kept, kept.count()


def history_path(root: str) -> str:
    return f"{root}/_changes"


def history(spark: SparkSession, root: str) -> DataFrame:
    """Change history of a table: one row per write."""
    return spark.read.schema(HISTORY_SCHEMA).parquet(history_path(root))


def _filesystem(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _filesystem(spark, path)
    return files.exists(target)


def qualified(spark: SparkSession, path: str) -> str:
    """The one full spelling of a path, so that paths can be compared."""
    files, target = _filesystem(spark, path)
    return files.makeQualified(target).toString()


def next_version(spark: SparkSession, root: str) -> int:
    """Number after the last recorded change; the folder of a write that failed is passed over."""
    version = 0
    if path_exists(spark, history_path(root)):
        version = history(spark, root).agg(F.coalesce(F.max("version") + 1, F.lit(0))).first()[0]
    while path_exists(spark, f"{root}/version={version}") or path_exists(spark, f"{root}/parts={version}"):
        version += 1
    return version


def record_change(
    spark: SparkSession, root: str, version: int, operation: str, rows_in: int, rows_out: int, seconds: float,
    path: str
) -> None:
    """Add a line to the change history; ``path`` is the folder that holds the table from now on."""
    row = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.current_timestamp().alias("written_at"),
        F.lit(operation).alias("operation"),
        F.lit(rows_in).cast("bigint").alias("rows_in"),
        F.lit(rows_out).cast("bigint").alias("rows_out"),
        F.lit(float(seconds)).alias("seconds"),
        F.lit(qualified(spark, path)).alias("path"),
    )
    row.coalesce(1).write.mode("append").parquet(history_path(root))


def literal(text: str) -> str:
    """A text as a literal of a SQL statement."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(fields: Sequence[T.StructField]) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in fields)


def publish(spark: SparkSession, name: str, path: str, schema: T.StructType | None = None,
            partition_by: Sequence[str] = ()) -> DataFrame:
    """Point the catalog entry at a folder of Parquet files, schema included.

    The entry of a table that keeps its columns, or gets more, and keeps its partition columns is there all the time.
    """
    found = spark.read.parquet(path).schema if schema is None else schema
    inside = [f for f in found.fields if f.name not in partition_by]
    folders = [found[c] for c in partition_by]
    if spark.catalog.tableExists(name):
        held = partition_columns(spark, name)
        old = [f for f in spark.table(name).schema.fields if f.name not in held]
        same = [(f.name, f.dataType) for f in inside[:len(old)]] == [(f.name, f.dataType) for f in old]
        if same and held == list(partition_by) and (not folders or _types(spark, name, held) == _kinds(folders)):
            if inside[len(old):]:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({_columns(inside[len(old):])})")
            if folders:
                move_partitions(spark, name, path, partition_by, whole=True)
            else:
                spark.sql(f"ALTER TABLE {name} SET LOCATION {literal(path)}")
                spark.catalog.refreshTable(name)
            return spark.table(name)
        spark.sql(f"DROP TABLE {name}")
    by = f" PARTITIONED BY ({', '.join(f'`{f.name}`' for f in folders)})" if folders else ""
    spark.sql(f"CREATE TABLE {name} ({_columns([*inside, *folders])}) USING parquet{by} LOCATION {literal(path)}")
    if folders:
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def _kinds(fields: Sequence[T.StructField]) -> list[T.DataType]:
    return [f.dataType for f in fields]


def _types(spark: SparkSession, name: str, columns: Sequence[str]) -> list[T.DataType]:
    schema = spark.table(name).schema
    return _kinds([schema[c] for c in columns])


def _partition(folder: str) -> str:
    """The PARTITION clause for a folder ``a=1/b=x`` of one partition."""
    pairs = []
    for part in folder.split("/"):
        column, _, value = part.partition("=")
        shown = "null" if value == NULL_FOLDER else literal(unquote(value))
        pairs.append(f"`{unquote(column)}` = {shown}")
    return f"PARTITION ({', '.join(pairs)})"


def move_partitions(spark: SparkSession, name: str, path: str, partition_by: Sequence[str], whole: bool = False) -> int:
    """Point the partitions that a folder holds at it, one by one; with ``whole`` all others are taken out of the
    table. Returns how many were moved or added. No data is touched: this reads folder names, a line a partition."""
    files, root = _filesystem(spark, path)
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, "/".join(["*=*"] * len(partition_by))))
    base = files.makeQualified(root).toString()
    new = [s.getPath().toString().removeprefix(base).strip("/") for s in found]
    old = {r["partition"] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    added = [f"{_partition(f)} LOCATION {literal(f'{base}/{f}')}" for f in new if f not in old]
    for at in range(0, len(added), DDL_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(added[at:at + DDL_AT_ONCE])}")
    for folder in new:
        if folder in old:
            spark.sql(f"ALTER TABLE {name} {_partition(folder)} SET LOCATION {literal(f'{base}/{folder}')}")
    gone = [_partition(f) for f in sorted(old - set(new))] if whole else []
    for at in range(0, len(gone), DDL_AT_ONCE):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(gone[at:at + DDL_AT_ONCE])}")
    spark.catalog.refreshTable(name)
    return len(new)


def location(spark: SparkSession, name: str) -> str:
    """Folder that the catalog entry points at."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def partition_count(spark: SparkSession, name: str) -> int:
    return spark.sql(f"SHOW PARTITIONS {name}").count()


def write_table(
    df: DataFrame,
    name: str,
    root: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    operation: str | None = None,
) -> WriteResult:
    """Write a catalog table. ``overwrite`` may change the schema; ``append`` adds files to the table."""
    spark = df.sparkSession
    version = next_version(spark, root)
    known = spark.catalog.tableExists(name)
    if mode == "append" and known:
        start = monotonic()
        seen = Observation()
        columns = spark.table(name).columns
        df.select(*columns).observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(name)
        done = WriteResult(location(spark, name), int(seen.get["rows"]), monotonic() - start)
        spark.catalog.refreshTable(name)
    elif mode in ("overwrite", "append"):
        done = write_files(df, f"{root}/version={version}", partition_by=partition_by)
        publish(spark, name, done.path, df.schema, partition_by)
    else:
        raise ValueError(f"unknown mode: {mode}")
    record_change(spark, root, version, operation or mode, done.rows, done.rows, done.seconds, done.path)
    return done


def verified_write(df: DataFrame, name: str, root: str, mode: str = "overwrite") -> tuple[DataFrame, bool]:
    """Write, re-read, and compare the count taken during the write with the table's own."""
    before = df.sparkSession.table(name).count() if mode == "append" and df.sparkSession.catalog.tableExists(name) else 0
    done = write_table(df, name, root, mode)
    back = df.sparkSession.table(name)
    return back, back.count() == before + done.rows


def _row_identity(df: DataFrame) -> list[Column]:
    """Columns that tell equal sort keys apart and are the same when a task is run again."""
    try:
        place = [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")]
        df.select(*place)
        return place
    except AnalysisException:
        return [F.xxhash64(*df.columns)]


def compact(df: DataFrame, order_by: Sequence[str], file_bytes: int = FILE_BYTES, files: int | None = None) -> DataFrame:
    """Lay rows out for a rewrite: files of about ``file_bytes``, ranges of the order columns.

    Rows with the same sort key are told apart by their place in the table, so that a very frequent key
    is spread over several files.
    """
    files = max(1, -(-scanned_bytes(df) // file_bytes)) if files is None else files
    ties = {f"__tie{i}": c for i, c in enumerate(_row_identity(df))}
    return (
        df.withColumns(ties).repartitionByRange(files, *order_by, *ties).drop(*ties)
        .sortWithinPartitions(*order_by)
    )


def expire_versions(spark: SparkSession, root: str, keep_seconds: float, as_of: str | None = None,
                    name: str | None = None) -> list[str]:
    """Delete folders that a later write replaced longer ago than the retention; the live one stays.

    Folders of writes that failed, which the change history does not name, go when a later version has
    been written and they are as old. This reads metadata of one table only: a line or folder per write.
    Folders with some partitions (``parts=<n>``) go with the version that their partitions belong to, or, if the
    table is named, once none of its rows lies in them.
    """
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    changes = history(spark, root)
    # The next recorded change, whatever its number: the folder of a failed write is passed over.
    by_version = Window.orderBy("version")
    later = changes.withColumns({
        "next_path": F.lead("path").over(by_version), "replaced_at": F.lead("written_at").over(by_version)})
    age = F.unix_micros(now) - F.unix_micros("replaced_at")
    replaced = later.filter("path <> next_path").filter(age > keep_seconds * 1_000_000)
    live = changes.agg(F.max_by("path", "version").alias("path"))
    old = replaced.select("path").distinct().join(live, "path", "left_anti")
    gone = [r["path"] for r in old.toLocalIterator()]
    parts = [f"{root}/parts={r['version']}" for r in changes.filter(F.col("path").isin(gone)).select("version").collect()]
    if name is not None:
        parts += _unused_parts(spark, root, name, changes, F.unix_micros(now) - keep_seconds * 1_000_000)
    removed = []
    for path in [*gone, *parts, *_failed_versions(spark, root, keep_seconds, as_of)]:
        files, target = _filesystem(spark, path)
        if files.exists(target):
            files.delete(target, True)
            removed.append(files.makeQualified(target).toString())
    return sorted(removed)


def _unused_parts(spark: SparkSession, root: str, name: str, changes: DataFrame, before: Column) -> list[str]:
    """Folders of partitions, written before a time, in which no row of the table lies. Reads file names only."""
    folder = F.regexp_extract("_metadata.file_path", r"/parts=(\d+)/", 1)
    used = {r[0] for r in spark.table(name).select(folder).distinct().collect()}
    old = changes.filter(F.unix_micros("written_at") < before).select("version").collect()
    return [f"{root}/parts={r['version']}" for r in old if str(r["version"]) not in used]


def _failed_versions(spark: SparkSession, root: str, keep_seconds: float, as_of: str | None) -> list[str]:
    """Version folders below the newest recorded one that no recorded change names, past the retention."""
    recorded = {r["path"]: r["version"] for r in history(spark, root).select("path", "version").collect()}
    newest = max(recorded.values(), default=-1)
    now = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    now_ms = spark.range(1).select(F.unix_millis(now)).first()[0]
    files, folder = _filesystem(spark, root)
    found = []
    for status in files.listStatus(folder):
        path, name = status.getPath().toString(), status.getPath().getName()
        number = name.removeprefix("version=")
        if number == name or not number.isdigit() or int(number) >= newest or path in recorded:
            continue
        if now_ms - status.getModificationTime() > keep_seconds * 1000:
            found.append(path)
    return found
