"""Hard negatives by exact inner products in a residue number system."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import named, settle, shuffle_partitions

ANCHORS_AT_ONCE = 1024
VECTORS_AT_ONCE = 8192
SCORES_AT_ONCE = 2048
BLOCKS_HELD = 32
POSITIVES = 5
NEGATIVES = 10
# The primes below 256, down to 128. A sum of products of residues of at most 127 is exact in a float32 while it has
# no more than TERMS terms; all these primes together reach beyond any sum of products of 64-bit numbers.
PRIMES = [p for p in range(255, 127, -2) if all(p % q for q in range(3, 16, 2))]
TERMS = 2**24 // 127**2
NONE = np.iinfo(np.int64).min

BLOCK = "block long, dim int, ids array<long>, labels array<long>, parts binary"
FOUND = "block long, nth int, slot int, anchor_id long, id long, score long"


def residues(matrix: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    """The matrix modulo each prime, as float32 between -(p - 1) / 2 and (p - 1) / 2."""
    found = []
    for p in primes:
        r = matrix % p
        found.append(np.where(r > p // 2, r - p, r).astype(np.float32))
    return found


def enough_primes(*matrices: np.ndarray) -> list[int]:
    """As few primes as tell all inner products of the matrices' rows apart, signs included."""
    bound = matrices[0].shape[1]
    for m in matrices:
        bound *= max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    product = 1
    for k, p in enumerate(PRIMES):
        product *= p
        if product > 2 * bound:
            return PRIMES[:k + 1]
    raise OverflowError("components beyond 64 bits")


def products(left: list[np.ndarray], right: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """All inner products of rows of two matrices that are given by their residues.

    Each prime's product is a float32 matrix product, exact in runs of ``TERMS`` columns. The scores are put
    together by Chinese remaindering in mixed radix with signed digits, so that no sign has to be told afterwards:
    score = d0 + p0 * (d1 + p1 * (d2 + ...)). Scores are 64-bit numbers.
    """
    dim = left[0].shape[1]
    digits: list[np.ndarray] = []
    for k, p in enumerate(primes):
        rest = np.zeros((len(left[k]), len(right[k])), np.int32)
        for at in range(0, dim, TERMS):
            cut = slice(at, at + TERMS)
            rest = (rest + (left[k][:, cut] @ right[k][:, cut].T).astype(np.int32)) % p
        for digit, q in zip(digits, primes):
            rest = (rest - digit) * pow(q, -1, p) % p
        digits.append(np.where(rest > p // 2, rest - p, rest))
    scores = digits[-1].astype(np.int64)
    for digit, p in zip(digits[-2::-1], primes[len(digits) - 2::-1]):
        scores = scores * p + digit
    return scores


def prepared(vectors: DataFrame, key: str, label: str, vector: str, scale: int) -> DataFrame:
    """``id``, ``label`` and ``parts`` (components times ``scale``, rounded down) of the rows that take part."""
    plain = vectors.select(
        named(key).cast("long").alias("id"), named(label).cast("long").alias("label"), named(vector).alias("parts"))
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return plain.where(F.col("label").isNotNull() & F.col("parts").isNotNull() & finite).select(
        "id", "label", F.transform("parts", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("parts"))


class Blocks:
    """Cuts a task's rows into blocks of at most ``most`` rows of one length, in order of id (null last)."""

    def __init__(self, most: int):
        self.most = most

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting = TaskContext.get().partitionId() << 32, {}

        def block(rows: list[tuple]) -> pa.RecordBatch:
            nonlocal number
            ids = pa.concat_arrays([r[0] for r in rows])
            labels, parts = (np.concatenate([r[k] for r in rows]) for k in (1, 2))
            order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
            number += 1
            offsets = pa.array([0, len(order)], pa.int32())
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([parts.shape[1]], pa.int32()),
                pa.ListArray.from_arrays(offsets, ids.take(pa.array(order))),
                pa.ListArray.from_arrays(offsets, pa.array(labels[order])),
                pa.array([np.ascontiguousarray(parts[order], "<i8").tobytes()], pa.binary())],
                ["block", "dim", "ids", "labels", "parts"])

        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            flat, sizes = lists.flatten().to_numpy(zero_copy_only=False), np.diff(offsets)
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                for at in range(0, len(rows), self.most):
                    some = rows[at:at + self.most]
                    parts = flat[(offsets[some] - offsets[0])[:, None] + np.arange(dim)]
                    held = waiting.setdefault(dim, [])
                    if held and sum(len(h[0]) for h in held) + len(some) > self.most:
                        yield block(waiting.pop(dim))
                        held = waiting.setdefault(dim, [])
                    ids = batch.column(0).take(pa.array(some))
                    held.append((ids, batch.column(1).take(pa.array(some)).to_numpy(), parts))
        for held in waiting.values():
            yield block(held)


def first_places(scores: np.ndarray, most: int) -> np.ndarray:
    """Where the first ``most`` entries of each row stand that aren't ``NONE``: the highest, and among equal ones
    the leftmost."""
    keep = min(most, scores.shape[1])
    bar = np.partition(scores, scores.shape[1] - keep, axis=1)[:, scores.shape[1] - keep][:, None]
    above = scores > bar
    level = scores == bar
    level &= np.cumsum(level, axis=1) <= keep - above.sum(axis=1)[:, None]
    return (above | level) & (scores != NONE)


class Pair:
    """An anchor block beside a vector block, as a row of their join."""

    def __init__(self, row: dict):
        self.block, self.dim = row["block"], row["dim"]
        self.anchor_ids = np.array(row["ids"], np.int64)
        self.anchor_labels = np.array(row["labels"], np.int64)
        self.anchors = np.frombuffer(row["parts"], "<i8").reshape(len(self.anchor_ids), self.dim)
        self.null = np.array([i is None for i in row["other_ids"]])
        self.ids = np.array([0 if i is None else i for i in row["other_ids"]], np.int64)
        self.labels = np.array(row["other_labels"], np.int64)
        self.vectors = np.frombuffer(row["other_parts"], "<i8").reshape(len(self.ids), self.dim)

    def scored(self) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        """Scores in stretches of the vectors, and where a vector's label is the anchor's."""
        primes = enough_primes(self.anchors, self.vectors)
        left = residues(self.anchors, primes)
        for at in range(0, len(self.ids), SCORES_AT_ONCE):
            some = slice(at, at + SCORES_AT_ONCE)
            scores = products(left, residues(self.vectors[some], primes), primes)
            yield some, scores, self.labels[some] == self.anchor_labels[:, None]

    def own(self, some: slice) -> np.ndarray:
        return (self.ids[some] == self.anchor_ids[:, None]) & ~self.null[some]



class Bests:
    """The first ``most`` candidates of each anchor of a block, over all vector blocks that a task has met."""

    def __init__(self, anchor_ids: np.ndarray, most: int):
        self.anchor_ids, self.most = anchor_ids, most
        self.nth, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.null = np.zeros(0, bool)

    def add(self, pair: Pair, some: slice, scores: np.ndarray) -> None:
        nth, at = np.nonzero(first_places(scores, self.most))
        found = nth, pair.ids[some][at], scores[nth, at], pair.null[some][at]
        nth, ids, scores, null = (np.concatenate(c) for c in zip((self.nth, self.ids, self.scores, self.null), found))
        order = np.lexsort((ids, null, -scores, nth))
        sizes = np.bincount(nth, minlength=len(self.anchor_ids))
        place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        kept = order[place < self.most]
        self.nth, self.ids, self.scores, self.null = nth[kept], ids[kept], scores[kept], null[kept]

    def rows(self, block: int, slot: int) -> pa.RecordBatch:
        n = len(self.nth)
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(n, block)), pa.array(self.nth.astype(np.int32)), pa.array(np.full(n, slot, np.int32)),
            pa.array(self.anchor_ids[self.nth]), pa.array(self.ids, mask=self.null), pa.array(self.scores)],
            ["block", "nth", "slot", "anchor_id", "id", "score"])


def _pairs(batches: Iterator[pa.RecordBatch], most: int, slots: int, take) -> Iterator[pa.RecordBatch]:
    """A task's candidates: ``take(pair, row)`` gives (slot, stretch, scores) of every pair of blocks."""
    held: dict[int, list[Bests]] = {}
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            pair = Pair(row)
            if pair.block not in held:
                if len(held) == BLOCKS_HELD:
                    yield from _given(held)
                    held = {}
                held[pair.block] = [Bests(pair.anchor_ids, most) for _ in range(slots)]
            for slot, some, scores in take(pair, row):
                held[pair.block][slot].add(pair, some, scores)
    yield from _given(held)


def _given(held: dict[int, list[Bests]]) -> Iterator[pa.RecordBatch]:
    for block, slots in held.items():
        for slot, bests in enumerate(slots):
            yield bests.rows(block, slot)


def find_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def take(pair: Pair, row: dict):
        for some, scores, same in pair.scored():
            scores[~same | pair.own(some)] = NONE
            yield 0, some, scores

    yield from _pairs(batches, POSITIVES, 1, take)


def find_negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def take(pair: Pair, row: dict):
        # No score lies between these.
        lows = np.full((len(pair.anchor_ids), POSITIVES), np.iinfo(np.int64).max, np.int64)
        highs = np.full(lows.shape, NONE, np.int64)
        for w in row["windows"]:
            lows[w["nth"], w["slot"]], highs[w["nth"], w["slot"]] = w["low"], w["high"]
        for some, scores, same in pair.scored():
            scores[same] = NONE
            for slot in range(POSITIVES):
                inside = (scores >= lows[:, slot, None]) & (scores <= highs[:, slot, None])
                yield slot, some, np.where(inside, scores, NONE)

    yield from _pairs(batches, NEGATIVES, POSITIVES, take)


def paired(anchors: DataFrame, blocks: DataFrame) -> DataFrame:
    """Every anchor block beside every vector block of its length, dealt out over a grid of tasks: anchor blocks
    go to all columns of their row of the grid, vector blocks to all rows of their column."""
    spark = anchors.sparkSession
    n_anchors, n_blocks = anchors.count(), blocks.count()
    tasks = max(1, min(n_anchors * n_blocks, shuffle_partitions(spark)))
    columns = max(1, min(n_blocks, round((tasks * n_blocks / max(n_anchors, 1)) ** 0.5)))
    rows = max(1, min(n_anchors, -(-tasks // columns)))
    line, column = (F.pmod(F.xxhash64("block"), F.lit(n)) for n in (rows, columns))
    left = anchors.withColumn("line", line).withColumn("column", F.explode(F.expr(f"sequence(0L, {columns - 1}L)")))
    right = blocks.select("dim", column.alias("column"), F.explode(F.expr(f"sequence(0L, {rows - 1}L)")).alias("line"),
                          *[F.col(c).alias(f"other_{c}") for c in ("ids", "labels", "parts")])
    keys = ["line", "column", "dim"]
    return left.repartition(tasks, *keys).join(right.repartition(tasks, *keys), keys)


def mine(vectors: DataFrame, anchors: DataFrame, *, key: str = "vec_id", label: str = "label", vector: str = "embedding",
         scale: int = 256) -> DataFrame:
    """For every anchor and each of its positives the first negatives within the positive's window:
    ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score`` and ``negative_score``.

    Components are multiplied by ``scale`` and rounded down; scores are inner products with the anchor, exact as
    64-bit numbers. Positives are the anchor's first ``POSITIVES`` rows of its own label, negatives the first
    ``NEGATIVES`` rows of another label with a score of 30 to 90 percent of the positive's (both included). Higher scores come
    first, ties by the smaller id.

    Tasks cut their rows into blocks, and each anchor block meets each vector block in one row of a join on a grid: a task
    holds a pair of blocks at a time, and neither vectors nor anchors pass through the driver. An anchor's few
    rows from each pair are then ranked.

    - Rows with a null label, a null vector or a component that is null or not finite take no part. Vectors meet
      those of their own length only; vectors without components score 0.
    - A null id is no anchor; as a candidate it comes last among ties. An anchor's own id is not among its positives, in no
      row that repeats it. Repeated rows are candidates of their own, and a repeated anchor is answered as often.
    - An anchor without positives, or a positive without negatives in its window, gives no rows. Other columns are
      left out, whatever their names. Empty tables give no rows.
    """
    pool = prepared(vectors, key, label, vector, scale)
    asked = prepared(anchors, key, label, vector, scale).where("id IS NOT NULL")
    blocks = settle(pool.mapInArrow(Blocks(VECTORS_AT_ONCE), BLOCK), "vector-blocks")
    # Few tasks, as a few anchors from each of many would make as many small blocks.
    few = asked.coalesce(max(1, -(-asked.count() // ANCHORS_AT_ONCE)))
    anchor_blocks = settle(few.mapInArrow(Blocks(ANCHORS_AT_ONCE), BLOCK), "anchor-blocks")

    anchor = ["block", "nth"]
    order = [F.desc("score"), F.asc_nulls_last("id")]
    place = F.row_number().over(Window.partitionBy(*anchor).orderBy(*order))
    positives = settle(
        paired(anchor_blocks, blocks).mapInArrow(find_positives, FOUND).withColumn("slot", place - 1)
        .where(F.col("slot") < POSITIVES), "positives")
    # 30 * p <= 100 * n <= 90 * p, solved for n without leaving 64 bits.
    tenths = "((score - pmod(score, 10L)) div 10)"
    low, high = f"3 * {tenths} + (3 * pmod(score, 10L) + 9) div 10", f"9 * {tenths} + (9 * pmod(score, 10L)) div 10"
    windows = positives.select("block", F.struct("nth", "slot", F.expr(low).alias("low"), F.expr(high).alias("high")).alias("w"))
    # A block's windows are at most ANCHORS_AT_ONCE times POSITIVES.
    with_windows = anchor_blocks.join(windows.groupBy("block").agg(F.collect_list("w").alias("windows")), "block")
    negatives = paired(settle(with_windows, "anchor-windows"), blocks).mapInArrow(find_negatives, FOUND)
    rank = F.row_number().over(Window.partitionBy(*anchor, "slot").orderBy(*order))
    ranked = negatives.withColumn("rank", rank).where(F.col("rank") <= NEGATIVES).select(
        *anchor, "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    known = positives.select(
        *anchor, "slot", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return ranked.join(known, [*anchor, "slot"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
