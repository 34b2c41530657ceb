"""Sharding by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import cell_count, cell_rank, hash_cell, named, null_free, packed, unpacked


def interleave(
    docs: DataFrame, shards: int = 24, *, source: str = "source", key: str = "doc_id", seed: int = 17,
) -> DataFrame:
    """Put every row into one of ``shards`` shards so that each shard mirrors the mixture of sources.

    Rows are shuffled by a seeded hash of key and row and ranked within their source; row r of a source with n
    rows stands at (r + phase) / n, where the phase in [0, 1) is a hash of the source. All rows are then
    ordered by that fraction and cut into shards of equal count. The phase spreads sources of few rows,
    which would else all stand at one place.

    Returns the input columns, ``shard`` (from 0) and ``slot`` (the place in the shard, gapless from 0).
    Shard sizes differ by one row at most; a source's share of a shard by about one row.

    - A null source is a source of its own. Rows with a null key, or with the same key, are shuffled like any others.
    - Which of two equal rows comes first makes no difference. Columns of a map type can't be hashed and are
      refused by Spark.
    - Fewer rows than shards leave shards empty; an empty table gives no rows.
    - Input columns named like a result are replaced by it.
    """
    rows = docs.count()
    cells = cell_count(docs.sparkSession, rows)
    # The row is drawn with its key, so that rows without a key, or with one in common, aren't all in one cell.
    frame = packed(docs, stratum=null_free(named(source)), draw=F.xxhash64(F.lit(seed), named(key), F.struct("*")))
    frame = frame.withColumn("cell", hash_cell(F.col("draw"), cells))
    ranked = cell_rank(frame, ["stratum"], [F.col("draw")])
    # (rank + phase) / group_rows in whole numbers: the fraction's cell, and what is left of it.
    mark = F.col("rank") * cells + F.pmod(F.xxhash64(F.lit(seed), F.col("stratum")), F.lit(cells))
    placed = ranked.withColumn("mark", mark).selectExpr(
        "row", "stratum", "mark div group_rows AS cell", "(mark % group_rows) / group_rows AS rest")
    ordered = cell_rank(placed, [], [F.col("rest"), F.col("stratum")])
    shard = f"(rank * {shards}L) div group_rows"
    return unpacked(
        ordered.selectExpr("row", f"{shard} AS shard", "rank", "group_rows"), docs.columns, {
            "shard": F.col("shard").cast("int"),
            "slot": F.col("rank") - F.expr(f"(shard * group_rows + {shards - 1}) div {shards}"),
        })
