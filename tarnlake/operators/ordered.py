"""Windows over ordered groups that may be too large for one task.

A window puts a whole group into one task. Here the groups of a large table are counted first: those with more
rows than a chunk should have are few, and only they are cut, along the sort order, into chunks of about equal row count;
all other groups take the plain window. In a cut group windows run per (group, chunk), and small per-chunk totals
carry the running values across the cuts. Results equal those of the plain window.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.operators.joins import bundled, join_null_safe
from tarnlake.scratch import fresh_path
from tarnlake.session import MB
from tarnlake.sizing import broadcast_if_small, scanned_bytes

CHUNK_BYTES = 256 * MB
# At this many chunks of CHUNK_BYTES a table has 100 TB.
MOST_CHUNKS = 400_000
BLOCK_ROWS = 100_000
GROUP, CHUNK = "__group", "__chunk"


@dataclass(frozen=True)
class Order:
    """One sort column. Nulls come first ascending and last descending, as in Spark."""

    column: str
    descending: bool = False

    def sort(self) -> Column:
        return F.desc(self.column) if self.descending else F.asc(self.column)


def _orders(order: Sequence[Order | str]) -> list[Order]:
    return [o if isinstance(o, Order) else Order(o) for o in order]


def chunk_count(df: DataFrame) -> int:
    """Chunks for a table of this size, from file sizes; 1 means a plain window will do."""
    return max(1, min(MOST_CHUNKS, math.ceil(scanned_bytes(df) / CHUNK_BYTES)))


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_weight(
    df: DataFrame,
    keys: Sequence[str],
    chunks: int | None,
    plain: Callable[[DataFrame], DataFrame],
    cut: Callable[[DataFrame, int], DataFrame],
) -> DataFrame:
    """``plain`` for the rows of all groups but the heavy ones, ``cut`` for those, into a number of chunks.

    Heavy are groups with more rows than one of ``chunks`` even chunks of the table, so there are fewer of them than
    chunks. Groups are counted inside the tasks first; a table below ``CHUNK_BYTES`` isn't counted at all.
    """
    chunks = chunk_count(df) if chunks is None else chunks
    if chunks <= 1:
        return plain(df)
    rows = df.count()
    names = [f"__key{i}" for i in range(len(keys))]
    counts = df.groupBy(*[F.col(k).alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n"))
    heavy = _written(counts.filter(F.col("__n") * chunks > rows), "heavy-groups")
    held = heavy.agg(F.coalesce(F.sum("__n"), F.lit(0))).first()[0]
    if not held:
        return plain(df)
    pieces = max(2, math.ceil(chunks * held / rows))
    if held == rows:
        return cut(df, pieces)
    same = F.lit(True)
    for k, n in zip(keys, names):
        same = same & F.col(k).eqNullSafe(F.col(n))
    heavy = broadcast_if_small(heavy)
    return plain(df.join(heavy, same, "left_anti")).unionByName(cut(df.join(heavy, same, "left_semi"), pieces))


def with_chunks(df: DataFrame, keys: Sequence[str], order: Sequence[Order | str], chunks: int) -> DataFrame:
    """Add the group as one column and the number of the row's chunk along the sort order, as a written table.

    Chunks are ranges of sampled values of all sort columns together, whatever their types, and of the group behind
    them: a value that fills chunks by itself is cut along the columns that follow. As another run of the sampling
    would cut elsewhere, the rows are written with their chunks.
    """
    grouped = df.withColumn(GROUP, bundled(keys))
    ranged = grouped.repartitionByRange(chunks, *[o.sort() for o in _orders(order)], F.xxhash64(GROUP).asc())
    return _written(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _carry(cut: DataFrame, amount: Column) -> DataFrame:
    """Per (group, chunk): the sum over all earlier chunks of the group."""
    totals = cut.groupBy(GROUP, CHUNK).agg(amount.alias("__total"))
    earlier = Window.partitionBy(GROUP).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(GROUP, CHUNK, F.sum("__total").over(earlier).alias("__before"))


def _carried(cut: DataFrame, carry: DataFrame, local: Column, out: str) -> DataFrame:
    """Add the carried value to the chunk's own; a null is the sum of no value. A line of the carry is one group's
    in one chunk, few enough to be sent along where that is checked."""
    own, before = F.col("__local"), F.col("__before")
    return (
        cut.withColumn("__local", local)
        .join(broadcast_if_small(_written(carry, "carry")), [GROUP, CHUNK], "inner")
        .withColumn(out, F.coalesce(own + before, own, before))
        .drop("__local", "__before", GROUP, CHUNK)
    )


def _inside(order: Sequence[Order]) -> WindowSpec:
    return Window.partitionBy(GROUP, CHUNK).orderBy(*[o.sort() for o in order])


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Order | str], out: str, chunks: int | None = None
) -> DataFrame:
    """Row number per group. The order must be total, or equal rows are numbered as they come."""
    order = _orders(order)

    def plain(rows: DataFrame) -> DataFrame:
        spec = Window.partitionBy(*keys).orderBy(*[o.sort() for o in order])
        return rows.withColumn(out, F.row_number().over(spec).cast("bigint"))

    return by_weight(df, keys, chunks, plain, lambda rows, n: _numbered(rows, keys, order, out, n))


def _numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Order], out: str, chunks: int) -> DataFrame:
    cut = with_chunks(df, keys, order, chunks)
    return _carried(cut, _carry(cut, F.count(F.lit(1))), F.row_number().over(_inside(order)).cast("bigint"), out)


def _sum_type(df: DataFrame, value: str) -> T.DataType:
    """The type of a sum of the column, which all paths to it return."""
    return df.select(F.sum(value).alias("s")).schema["s"].dataType


def _prefix_sums(points: DataFrame, keys: Sequence[str], order: Order, value: str, out: str, chunks: int) -> DataFrame:
    """Running sum over rows that are unique per (keys, order): the row itself is included."""
    kind = _sum_type(points, value)
    cut = with_chunks(points, keys, [order], chunks)
    spec = _inside([order]).rowsBetween(Window.unboundedPreceding, 0)
    carried = _carried(cut, _carry(cut, F.sum(value)), F.sum(value).over(spec), out)
    return carried.withColumn(out, F.col(out).cast(kind))


def running_total(
    df: DataFrame, keys: Sequence[str], order: Order | str, value: str, out: str, chunks: int | None = None
) -> DataFrame:
    """Running total per group; rows that tie on the order column share a value (RANGE frame).

    Of a heavy group the rows of one order value are summed before anything is shuffled.
    """
    (order,) = _orders([order])
    kind = _sum_type(df, value)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(out, F.sum(value).over(Window.partitionBy(*keys).orderBy(order.sort())))

    def cut(rows: DataFrame, n: int) -> DataFrame:
        at = [*keys, order.column]
        points = rows.groupBy(*at).agg(F.sum(value).alias("__sum"))
        sums = _prefix_sums(points, keys, order, "__sum", out, n).drop("__sum")
        return join_null_safe(rows, sums.withColumn(out, F.col(out).cast(kind)), at, "inner")

    return by_weight(df, keys, chunks, plain, cut)


def rank_rows(
    df: DataFrame, keys: Sequence[str], order: Order, out: str, chunks: int | None = None
) -> DataFrame:
    """Rank with gaps: one more than the number of rows of the group that sort before."""

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(out, F.rank().over(Window.partitionBy(*keys).orderBy(order.sort())).cast("bigint"))

    def cut(rows: DataFrame, n: int) -> DataFrame:
        # The chunk's first rows may tie with the last of the chunk before, so that ranks are counted from values.
        at = [*keys, order.column]
        points = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("__n"))
        sums = _prefix_sums(points, keys, order, "__n", "__upto", n)
        ranks = sums.select(*at, (F.col("__upto") - F.col("__n") + 1).cast("bigint").alias(out))
        return join_null_safe(rows, ranks, at, "inner")

    return by_weight(df, keys, chunks, plain, cut)


def median_per_group(
    df: DataFrame, keys: Sequence[str], value: str, out: str, chunks: int | None = None
) -> DataFrame:
    """Exact median per group; of a heavy group by counting equal values and finding the middle of the running
    count."""

    def plain(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys).agg(F.median(value).cast("double").alias(out))

    def cut(rows: DataFrame, n: int) -> DataFrame:
        upto = _counted_up(rows, keys, value, n)
        low, high = F.floor((F.col("__size") + 1) / 2), F.floor(F.col("__size") / 2) + 1
        first = F.col("__upto") - F.col("__n") + 1
        middle = ((first <= low) & (low <= F.col("__upto"))) | ((first <= high) & (high <= F.col("__upto")))
        return upto.filter(middle).groupBy(*keys).agg(
            ((F.min(value).cast("double") + F.max(value).cast("double")) / 2).alias(out))

    return by_weight(df.filter(F.col(value).isNotNull()), keys, chunks, plain, cut)


def _counted_up(rows: DataFrame, keys: Sequence[str], value: str, chunks: int) -> DataFrame:
    """Per value of a group: rows up to it (``__upto``) and rows of the group (``__size``)."""
    points = rows.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    if chunks <= 1:
        group = Window.partitionBy(*keys)
        upto = F.sum("__n").over(group.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
        return points.withColumns({"__upto": upto, "__size": F.sum("__n").over(group)})
    upto = _prefix_sums(points, keys, Order(value), "__n", "__upto", chunks)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
    return join_null_safe(upto, broadcast_if_small(_written(sizes, "group-sizes")), keys, "inner")


def value_at_fraction(
    df: DataFrame, keys: Sequence[str], value: str, fraction: float, out: str, chunks: int | None = None
) -> DataFrame:
    """Exact discrete quantile: the least value with at least that share of the group at or below it."""

    def found(rows: DataFrame, n: int) -> DataFrame:
        reached = F.col("__upto") >= F.ceil(F.col("__size") * F.lit(fraction))
        return _counted_up(rows, keys, value, n).filter(reached).groupBy(*keys).agg(F.min(value).alias(out))

    return by_weight(df.filter(F.col(value).isNotNull()), keys, chunks, lambda rows: found(rows, 1), found)


Step = Callable[[WindowSpec], Column]


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Order | str],
    before: int,
    after: int,
    steps: Mapping[str, Step],
    chunks: int | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Columns computed from a bounded neighbourhood: lag, lead and sliding frames.

    ``steps`` maps a new column to a function of the ordered window; a later step may use an earlier one.
    ``before`` and ``after`` state how far they reach together. A heavy group is cut into blocks of
    ``block_rows`` rows, and each block is given copies of the rows just outside it.
    """
    order = _orders(order)

    def plain(rows: DataFrame) -> DataFrame:
        spec = Window.partitionBy(*keys).orderBy(*[o.sort() for o in order])
        for name, step in steps.items():
            rows = rows.withColumn(name, step(spec))
        return rows

    def cut(rows: DataFrame, n: int) -> DataFrame:
        size = max(block_rows, before, after)
        numbered = _numbered(rows, keys, order, "__row", n)
        block = F.floor((F.col("__row") - 1) / size).cast("bigint")
        inside = F.pmod(F.col("__row") - 1, F.lit(size))
        homes = F.array_compact(F.array(
            block,
            F.when(inside >= size - before, block + 1),
            F.when((inside < after) & (block > 0), block - 1),
        ))
        spread = numbered.withColumn("__home", block).withColumn("__block", F.explode(homes))
        spec = Window.partitionBy(*keys, "__block").orderBy("__row")
        for name, step in steps.items():
            spread = spread.withColumn(name, step(spec))
        return spread.filter(F.col("__block") == F.col("__home")).drop("__row", "__home", "__block")

    return by_weight(df, keys, chunks, plain, cut)
