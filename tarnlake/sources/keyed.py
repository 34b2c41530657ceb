"""Tables in key order, for upserts that rewrite only the files that hold a key of the source.

Such a table is cut into cells along its keys, one partition of the catalog and one file or a few each. A summary table
holds the least and the greatest key of every cell, so that most cells are never opened.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.predicates import all_of
from tarnlake.scratch import fresh_path
from tarnlake.sizing import broadcast_if_small
from tarnlake.sources import upsert as upserts
from tarnlake.sources import writers

CELL = "key_cell"
CELL_ROWS = 2_000_000


@dataclass(frozen=True)
class KeyedResult:
    """Cells held before the upsert, and of those the ones written anew; cells added; rows written."""

    held: int
    rewritten: int
    added: int
    rows: int


def rows(spark: SparkSession, name: str) -> DataFrame:
    """The table without the column that tells the cells."""
    return spark.table(name).drop(CELL)


def _ranged(df: DataFrame, keys: Sequence[str], cells: int, first: int) -> DataFrame:
    """Ranges of the keys, numbered from ``first``."""
    ranged = df.repartitionByRange(cells, *keys).sortWithinPartitions(*keys)
    return ranged.withColumn(CELL, F.spark_partition_id() + F.lit(first))


def _wanted_cells(rows: int, cell_rows: int) -> int:
    return max(1, -(-rows // cell_rows))


def _summary_path(root: str) -> str:
    return f"{root}/_cells"


def _summarise(spark: SparkSession, path: str, schema, keys: Sequence[str], root: str, version: int) -> None:
    """Least and greatest key of the cells that a folder holds, from their key columns alone."""
    written = spark.read.schema(schema).parquet(path).filter(all_of([F.col(k).isNotNull() for k in keys]))
    key = F.struct(*keys)
    written.groupBy(CELL).agg(F.min(key).alias("low"), F.max(key).alias("high")) \
        .withColumn("version", F.lit(version).cast("long")).coalesce(1).write.mode("append").parquet(_summary_path(root))


def summary(spark: SparkSession, root: str) -> DataFrame:
    """The newest line of every cell: ``key_cell``, ``low``, ``high``. Cells without a complete key have none."""
    lines = spark.read.parquet(_summary_path(root))
    return lines.groupBy(CELL).agg(F.max_by(F.struct("low", "high"), "version").alias("newest")).select(CELL, "newest.*")


def create_table(df: DataFrame, name: str, root: str, keys: Sequence[str], cells: int | None = None,
                 cell_rows: int = CELL_ROWS) -> writers.WriteResult:
    """Write a table in cells of about ``cell_rows``, or in as many as are asked for."""
    spark, version = df.sparkSession, writers.next_version(df.sparkSession, root)
    laid_out = _ranged(df, keys, cells or _wanted_cells(df.count(), cell_rows), 0)
    done = writers.write_laid_out(laid_out, f"{root}/version={version}", [CELL])
    writers.publish(spark, name, done.path, laid_out.schema, [CELL])
    _summarise(spark, done.path, laid_out.schema, keys, root, version)
    writers.record_change(spark, root, version, "overwrite", done.rows, done.rows, done.seconds, done.path)
    return done


def upsert(spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], root: str,
           cell_rows: int = CELL_ROWS) -> KeyedResult:
    """Replace the rows whose keys the source holds, and add the others of the source.

    1. Cells whose range of keys meets that of the source are looked into, by their key columns alone: which of
       them hold a key of the source. Rows with a null in their keys match nothing.
    2. Those cells are written anew, with the source's rows in place of theirs. Source rows without a match
       become cells of their own, so that no other cell is written.
    3. The catalog's partitions are pointed at the new files, one by one.

    The cost follows the cells that are hit, and the source; the rest of the table is neither written nor read. A
    source in which a key occurs twice is refused. Target rows that share a key are all replaced by the one.
    """
    rows_in = upserts.check_unique(source, keys)
    version = writers.next_version(spark, root)
    target = spark.table(name)
    source = source.select(*[c for c in target.columns if c != CELL])
    complete = all_of([F.col(k).isNotNull() for k in keys])
    key = F.struct(*keys)
    ends = source.filter(complete).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    # One row beside a line for each cell.
    ranges = summary(spark, root).alias("c").join(
        F.broadcast(ends.alias("s")), (F.col("c.low") <= F.col("s.high")) & (F.col("c.high") >= F.col("s.low")), "left_semi")
    near = target.join(broadcast_if_small(ranges.select(CELL)), CELL, "left_semi")
    path = fresh_path(spark, "matched-keys")
    found = near.select(*keys, CELL).join(broadcast_if_small(source.select(*keys)), list(keys), "left_semi").groupBy(*keys).agg(
        F.min(CELL).alias(CELL), F.collect_set(CELL).alias("cells"))
    found.write.parquet(path)
    matched = spark.read.schema(found.schema).parquet(path)
    hit = matched.select(F.explode("cells").alias(CELL)).distinct()
    counts = writers.partition_count(spark, name)
    rewritten = hit.count()

    kept = target.join(F.broadcast(hit) if rewritten < 10_000 else hit, CELL, "left_semi").join(
        broadcast_if_small(source.select(*keys)), list(keys), "left_anti").select(*target.columns)
    changed = source.join(matched.select(*keys, CELL), list(keys)).select(*target.columns)
    new = source.join(matched.select(*keys), list(keys), "left_anti")
    first = spark.sql(f"SHOW PARTITIONS {name}").agg(
        F.coalesce(F.max(F.regexp_extract("partition", r"=(\d+)$", 1).cast("int")), F.lit(-1)) + 1).first()[0]
    added = _ranged(new, keys, _wanted_cells(rows_in, cell_rows), first).select(*target.columns)
    done = writers.write_files(kept.unionByName(changed).unionByName(added), f"{root}/parts={version}", partition_by=[CELL])
    moved = writers.move_partitions(spark, name, done.path, [CELL])
    if done.rows:
        _summarise(spark, done.path, target.schema, keys, root, version)
    writers.record_change(spark, root, version, "merge", rows_in, done.rows, done.seconds, writers.location(spark, name))
    return KeyedResult(counts, rewritten, moved - rewritten, done.rows)
