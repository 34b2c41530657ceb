"""Upsert by key on Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.predicates import all_of
from tarnlake.sources import writers


class DuplicateKeys(ValueError):
    """Several source rows carry the same key."""


def check_unique(source: DataFrame, keys: Sequence[str]) -> int:
    """Raise when a key occurs twice, else return the row count. Keys holding a null never match, so
    they may repeat."""
    complete = all_of([F.col(k).isNotNull() for k in keys])
    found = source.groupBy(*keys).count().agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.max(F.when(complete, F.col("count"))).alias("most")
    ).first()
    if (found["most"] or 0) > 1:
        raise DuplicateKeys(f"several source rows share a key on ({', '.join(keys)})")
    return found["rows"]


def upserted(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after the upsert: matched rows replaced, new rows added, the rest kept.

    One anti-join; when the source is small Spark broadcasts its keys and the target is not shuffled.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(source.select(*target.columns))


def storable(source: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Empty texts in partition columns as nulls, as which Spark writes them."""
    texts = [c for c in partitions if source.schema[c].dataType.simpleString() == "string"]
    return source.withColumns({c: F.expr(f"nullif(`{c}`, '')") for c in texts}) if texts else source


def upsert_table(
    spark: SparkSession, name: str, source: DataFrame, keys: Sequence[str], root: str
) -> writers.WriteResult:
    """Upsert into a catalog table.

    Where all partition columns are keys, only the partitions that the source names are written. Tables in key
    order (``keyed``) have an upsert of their own, which writes only the files that hold a key of the source. Any
    other table is written anew.
    """
    target, partitions = spark.table(name), writers.partition_columns(spark, name)
    source = storable(source, partitions)
    rows_in = check_unique(source, keys)
    version = writers.next_version(spark, root)
    if partitions and set(partitions) <= set(keys):
        return _upsert_partitions(spark, name, target, source, keys, partitions, root, version, rows_in)
    done = writers.write_files(
        upserted(target, source, keys), f"{root}/version={version}", partition_by=partitions)
    writers.publish(spark, name, done.path, target.schema, partitions)
    writers.record_change(spark, root, version, "merge", rows_in, done.rows, done.seconds, done.path)
    return done


def _upsert_partitions(spark, name, target, source, keys, partitions, root, version, rows_in):
    """Rewrite only the partitions that the source names.

    The partition columns are keys, so a row can only meet a row of its own partition. The new content goes to a
    folder of its own, at which the catalog's partitions are pointed one by one afterwards: nothing that
    readers may be reading is overwritten, and an upsert that fails half-way can be run again. Those who begin to
    read meanwhile see some partitions before and some after it.
    """
    touched = source.select(*partitions).distinct().toDF(*[f"__{p}" for p in partitions])
    # A null partition meets itself here: its rows are carried over like those of any other.
    same = all_of([F.col(p).eqNullSafe(F.col(f"__{p}")) for p in partitions])
    affected = target.join(touched, same, "left_semi")
    done = writers.write_files(upserted(affected, source, keys), f"{root}/parts={version}", partition_by=partitions)
    writers.move_partitions(spark, name, done.path, partitions)
    path = writers.location(spark, name)
    writers.record_change(spark, root, version, "merge", rows_in, done.rows, done.seconds, path)
    return writers.WriteResult(path, done.rows, done.seconds)
