"""Equi-joins. Spark picks the physical join; a broadcast is hinted only behind a size check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.scalars import NO_VALUE
from tarnlake.sizing import BROADCAST_BYTES, broadcast_if_small


def join_keeping_keys(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner join that keeps both key columns; the right one is prefixed when the names are the same."""
    if left_key == right_key:
        right = right.withColumnRenamed(right_key, f"right_{right_key}")
        right_key = f"right_{right_key}"
    return left.join(right, left[left_key] == right[right_key], "inner")


def join_small(
    large: DataFrame, small: DataFrame, key: str, how: str = "inner", limit_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Join a dimension on one key, which is kept once; broadcast below the limit, shuffled beyond it."""
    return large.join(broadcast_if_small(small, limit_bytes), key, how)


def with_names(df: DataFrame, ids: Mapping[str, str], names: DataFrame, key: str, name: str) -> DataFrame:
    """Add a display name for each id column: the id itself when unknown, ``N/A`` when it is null.

    ``ids`` maps id column to new column. ``names`` holds one row per key.
    """
    for position, (column, out) in enumerate(ids.items()):
        lookup_key, lookup_name = f"__key{position}", f"__name{position}"
        lookup = names.select(F.col(key).alias(lookup_key), F.col(name).alias(lookup_name))
        df = (
            df.join(broadcast_if_small(lookup), F.col(column) == F.col(lookup_key), "left")
            .withColumn(out, F.coalesce(lookup_name, F.col(column).cast("string"), F.lit(NO_VALUE)))
            .drop(lookup_key, lookup_name)
        )
    return df


def bundled(keys: Sequence[str]) -> Column:
    """Several key columns as one that is never null; without keys, one key for all rows."""
    return F.struct(*keys) if keys else F.lit(0)


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join on keys where null equals null; the keys are kept once, from the left.

    The keys are compared as one struct, which is never null itself, so this stays an equi-join.
    """
    key = bundled(keys).alias("__key")
    values = [c for c in right.columns if c not in keys]
    return left.select("*", key).join(right.select(key, *values), "__key", how).drop("__key")


def unique_lookup(requests: DataFrame, wanted: str, names: DataFrame, key: str, name: str) -> DataFrame:
    """Resolve names to ids without regard to case: status is ok, missing or ambiguous.

    A request that is itself an id passes through. The catalogue is reduced to one row per name first,
    so a name held by very many rows does not multiply the join.
    """
    wanted_low = F.lower(F.col(wanted))
    by_name = names.groupBy(F.lower(F.col(name)).alias("__low")).agg(
        F.count(F.lit(1)).alias("hits"), F.min(key).alias("__id"))
    ids = names.select(F.col(key).cast("string").alias("__known")).distinct()
    joined = (
        requests.join(by_name, wanted_low == F.col("__low"), "left")
        .join(ids, F.col(wanted) == F.col("__known"), "left")
    )
    is_id = F.col("__known").isNotNull()
    hits = F.coalesce(F.col("hits"), F.lit(0))
    return joined.select(
        *requests.columns,
        F.when(is_id, F.col(wanted)).when(hits == 1, F.col("__id").cast("string")).alias("id"),
        F.when(is_id | (hits == 1), "ok").when(hits == 0, "missing").otherwise("ambiguous").alias("status"),
    )
