"""Mixing sources to target weights by a low-discrepancy schedule of equal blocks."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.llm.common import (
    SPACE, WORD, cell_count, cell_rank, hash_cell, named, null_free, packed, settle, unpacked,
)

REPEATS = 3
# Golden ratio less one, to more digits than a double holds, for exact fractions of large multiples.
GOLDEN = Fraction("0.61803398874989484820458683436563811772030917980576")
STEP = 2**20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shares(sizes: dict[str | None, int], repeats: int = REPEATS) -> dict[str | None, float]:
    """Target words of each source: weights 1, 2, 3 in turn, by code point with null last.

    No target exceeds ``repeats`` times its source; what that leaves over goes to the others by weight.
    """
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    left, targets = float(sum(sizes.values())), {}
    open_sources = list(order)
    while open_sources:
        unit = left / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if unit * weight[s] > repeats * sizes[s]]
        if not full:
            return targets | {s: unit * weight[s] for s in open_sources}
        for s in full:
            targets[s] = float(repeats * sizes[s])
            left -= targets[s]
        open_sources = [s for s in open_sources if s not in targets]
    return targets


def block_words(targets: dict[str | None, float]) -> int:
    """Small enough that the least target is many blocks, within 16 and 1024 words."""
    least = min((t for t in targets.values() if t > 0), default=0.0)
    return int(min(1024, max(16, least // 256)))


def golden_point(slot: Column) -> Column:
    """The fractional part of slot times the golden ratio, in two steps that lose no digits."""
    high, low = (float(GOLDEN * k % 1) for k in (STEP, 1))
    return F.pmod(F.floor(slot / STEP) * F.lit(high) + (slot % STEP) * F.lit(low), F.lit(1.0))


def schedule(spark, sources: list[tuple[str, float, int]], blocks_wanted: list[float]) -> DataFrame:
    """The slots of the mix in order: ``slot``, ``stratum``, its ``rank`` among the source's slots, ``block``
    and ``epoch``. ``sources`` holds (stratum, target, blocks); a slot's golden-ratio point picks the source
    whose stretch of the cumulative weights it falls into, and a source's slots take its blocks in turn."""
    slots = round(sum(blocks_wanted))
    names = [s for s, _, _ in sources]
    blocks = [b for _, _, b in sources]
    bounds = np.cumsum(blocks_wanted) / max(sum(blocks_wanted), 1e-9)

    def pick(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.minimum(np.searchsorted(bounds, batch["point"].to_numpy(), side="right"), len(names) - 1)
            yield pd.DataFrame({
                "slot": batch["slot"], "cell": batch["cell"], "stratum": np.array(names, dtype=object)[at],
                "blocks": np.array(blocks, dtype=np.int64)[at]})

    cells = cell_count(spark, slots)
    ids = spark.range(slots).select(
        F.col("id").alias("slot"), golden_point(F.col("id")).alias("point"),
        F.floor(F.col("id") * F.lit(cells) / F.lit(max(slots, 1))).cast("long").alias("cell"))
    picked = ids.mapInPandas(pick, "slot long, cell long, stratum string, blocks long")
    return cell_rank(picked, ["stratum"], [F.col("slot")]).selectExpr(
        "slot", "stratum", "rank", "rank % blocks AS block", "rank div blocks AS epoch")


def mix(docs: DataFrame, *, size: Column | None = None, apart: Column | None = None, text: str = "text",
        source: str = "source", key: str = "doc_id", seed: int = 23, repeats: int = REPEATS) -> DataFrame:
    """How many words of each document the mix takes.

    Documents of a source are shuffled by a seeded hash of the key and of ``apart``, which tells rows of one key apart
    (the text, or with a ``size`` the whole row), laid end to end, and cut into blocks of equal words. The schedule's slots take the blocks of their source in turn, up to ``repeats`` times each; a
    document is taken where its blocks are. Only one row a source reaches the driver.

    Returns the input columns, ``size``, ``source_size``, ``target`` (of the source), ``taken`` and
    ``taken_by_epoch`` (an array: in each epoch, how many words from the document's start).

    - A null source is a source of its own, last in order. A null text has size 0 and is taken 0 times,
      as is every row of a source without words.
    - Rows with a null key, or with the same key, are shuffled like any others; repeated rows are documents of
      their own. Columns of a map type can't be hashed and are refused by Spark. An empty table gives no rows. Input columns named like a result are replaced by it.
    """
    spark = docs.sparkSession
    # Rows without a key, or with one in common, would else all be in one cell.
    if apart is None:
        apart = named(text) if size is None else F.struct("*")
    sized = packed(
        docs, stratum=null_free(named(source)), draw=F.xxhash64(F.lit(seed), named(key), apart),
        size=word_count(named(text)) if size is None else size)
    totals = {r["stratum"]: (r["words"], r["n"]) for r in sized.groupBy("stratum").agg(
        F.sum("size").alias("words"), F.count(F.lit(1)).alias("n")).collect()}
    by_source = {(s[1:] if s else None): words for s, (words, _) in totals.items()}
    targets = shares(by_source, repeats)
    block = block_words(targets)
    strata = sorted(totals)
    blocks = {s: -(-totals[s][0] // block) for s in strata}
    target = {s: targets[s[1:] if s else None] for s in strata}
    used = [s for s in strata if target[s] > 0]
    slots = schedule(
        spark, [(s, target[s], blocks[s]) for s in used],
        [target[s] * blocks[s] / totals[s][0] for s in used]).where(F.col("epoch") < repeats)
    times = slots.groupBy("stratum", "block").agg(*[
        F.sum((F.col("epoch") == e).cast("long")).alias(f"in_{e}") for e in range(repeats)])

    cells = cell_count(spark, sum(n for _, n in totals.values()))
    sized = sized.withColumn("cell", hash_cell(F.col("draw"), cells))
    placed = settle(cell_rank(sized, ["stratum"], [F.col("draw"), F.xxhash64("row")], value="size").select(
        "row", "stratum", "rank", "size", "before"), "mix-order")
    pieces = placed.where("size > 0").select(
        "stratum", "rank", "size", "before", F.explode(F.sequence(
            F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("size") - 1) / block))).alias("block"))
    words = F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block) - F.greatest(
        F.col("before"), F.col("block") * block)
    taken = pieces.withColumn("words", words).join(times, ["stratum", "block"]).groupBy("stratum", "rank").agg(
        F.array(*[F.sum(F.col("words") * F.col(f"in_{e}")) for e in range(repeats)]).alias("by_epoch"))
    # From Arrow, as rows of Python would go through workers of their own on the executors.
    facts = spark.createDataFrame(pa.table(
        [pa.array(strata, pa.string()), pa.array([totals[s][0] for s in strata], pa.int64()),
         pa.array([target[s] for s in strata], pa.float64())], ["stratum", "source_size", "target"]))
    none = F.array(*[F.lit(0).cast("long")] * repeats)
    joined = placed.join(taken, ["stratum", "rank"], "left").join(facts, "stratum").withColumn(
        "by_epoch", F.coalesce("by_epoch", none))
    return unpacked(joined, docs.columns, {
        "size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"),
        "taken": F.aggregate("by_epoch", F.lit(0).cast("long"), lambda a, b: a + b),
        "taken_by_epoch": F.col("by_epoch")})


def mixed_documents(docs: DataFrame, *, text: str = "text", length: str | None = "n_chars",
                    **options) -> DataFrame:
    """The documents of the mix with their own columns: one row for each time a document is taken.

    A document taken in part keeps its first words, joined by single spaces; ``length`` names a column that
    holds the characters of the text, and follows it. Null and empty texts, and texts without words, are never taken.
    Null and repeated keys, repeated rows and clashing names are as in ``mix``. An empty table gives no rows.
    """
    inner = docs.select(
        F.struct("*").alias("doc"), named(options.pop("source", "source")).alias("source"),
        named(options.pop("key", "doc_id")).alias("doc_id"))
    whole = F.col("doc").getField(text)
    taken = mix(inner, size=word_count(whole), apart=whole, **options)
    taken = taken.select("doc", "size", F.explode("taken_by_epoch").alias("n")).where("n > 0")
    part = F.array_join(F.slice(F.array_remove(F.split(whole, SPACE), ""), 1, F.col("n").cast("int")), " ")
    taken = taken.withColumn("cut", F.when(F.col("n") < F.col("size"), part).otherwise(whole))
    made = {text: F.col("cut")}
    if length in docs.columns:
        made[length] = F.char_length("cut").cast("long")
    return taken.select(*[made.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])
