"""Size checks taken from the optimised plan. Only a frame that may be broadcast and isn't tiny has its rows counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.scratch import fresh_path
from tarnlake.session import MB

# Parquet on disk is a few times smaller than the same rows in memory.
FILE_EXPANSION = 4
# What the driver may hold of one broadcast: it builds the hash table, and a query may need several at once.
BROADCAST_BYTES = 64 * MB
# Below this no compression of a file makes a frame too large to broadcast.
TINY_BYTES = MB
# A row's share of the hash table beside its columns: header, key, address, free slots.
ROW_OVERHEAD = 64


def _optimised(df: DataFrame):
    return df._jdf.queryExecution().optimizedPlan()


def estimated_bytes(df: DataFrame) -> int:
    """Upper-side estimate of the frame's size; a join counts as the product of its sides."""
    return int(str(_optimised(df).stats().sizeInBytes()))


def scanned_bytes(df: DataFrame) -> int:
    """Size of what the frame reads: the measure for how many tasks or files its rows call for."""
    leaves = _optimised(df).collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def row_bytes(df: DataFrame) -> int:
    """Size of a row in a hash table, by the types of its columns."""
    kinds = df._jdf.schema()
    return ROW_OVERHEAD + sum(kinds.apply(i).dataType().defaultSize() for i in range(kinds.size()))


def is_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the frame fits the limit in memory, by the plan's estimate and by the number of its rows.

    Files of keys and of few different values hold many more rows than their size tells, so that the rows
    of a frame that passes by its estimate, and isn't tiny, are counted.
    """
    estimate = estimated_bytes(df) * FILE_EXPANSION
    if estimate > limit_bytes:
        return False
    return estimate <= TINY_BYTES or df.count() * row_bytes(df) <= limit_bytes


def broadcast_if_small(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only when the checked size stays below the limit.

    Beyond it the frame is returned as it is, and Spark picks a shuffled join with AQE skew handling.
    """
    return F.broadcast(df) if is_small(df, limit_bytes) else df


def settled(df: DataFrame, limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A summary that is to be joined back to the large table it was made from.

    The plan bounds a summary only by the size of its input. When that is no small size, the summary is
    written to the shared folder first; its files then show whether it can be broadcast, and the large
    table need not be shuffled to meet it.
    """
    if is_small(df, limit_bytes):
        return F.broadcast(df)
    path = fresh_path(df.sparkSession, "summary")
    df.write.parquet(path)
    return broadcast_if_small(df.sparkSession.read.schema(df.schema).parquet(path), limit_bytes)


def spread_if_small(df: DataFrame, bytes_per_core: int = 32 * MB) -> DataFrame:
    """Deal the rows of a small table out to all cores before costly per-row work.

    A table of few row groups is read by few tasks. Larger tables have tasks enough and are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if scanned_bytes(df) < cores * bytes_per_core else df


def task_count(df: DataFrame, bytes_per_task: int = 64 * MB) -> int:
    """Tasks for a step that is slow per byte, such as Python over groups; AQE would merge them."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(cores, -(-scanned_bytes(df) // bytes_per_task))
