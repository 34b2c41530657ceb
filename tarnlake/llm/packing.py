"""Packing documents into training sequences by column generation over a length histogram."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.llm.common import cell_count, cell_rank, hash_cell, named, settle
from tarnlake.llm.tokens import TEXT_BYTES, text_slices, word_tokens

END_ID = 1
UNIT = 8
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text",
                 capacity: int = 2048, end_id: int = END_ID) -> DataFrame:
    """Tokenise whole documents, each with ``end_id`` behind it, and cut them into pieces.

    A document gives full pieces of ``capacity`` and one piece with the rest. Only lengths and checksums leave
    the task, no ids. A null text is empty and so is the end id alone.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        for batch in batches:
            keys = batch.column(0)
            for low, texts in text_slices(batch.column(1), TEXT_BYTES):
                counts, ids = words.encode(texts)
                whole = np.full(len(ids) + len(texts), end_id, np.uint32)
                ends = np.cumsum(counts + 1)
                inside = np.ones(len(whole), bool)
                inside[ends - 1] = False
                whole[inside] = ids
                n = counts + 1
                n_pieces = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), n_pieces)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_pieces) - n_pieces, n_pieces)
                start = nth * capacity
                length = np.minimum(capacity, n[doc] - start)
                begin = (ends - n)[doc] + start
                data = memoryview(whole.astype("<u4").view(np.uint8))
                crc = [zlib.crc32(data[4 * b:4 * (b + m)]) for b, m in zip(begin.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays([
                    keys.take(pa.array(doc + low)), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(n[doc])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    plain = docs.select(
        named(key).cast("long").alias("doc_id"), F.coalesce(named(text), F.lit("")).cast("binary").alias("text"))
    return plain.mapInArrow(cut, PIECES)


@dataclass(frozen=True)
class Pattern:
    """How many pieces of each length class make one sequence, and how many sequences are made so."""

    counts: tuple[tuple[int, int], ...]
    times: int


def best_pattern(prices: np.ndarray, room: int) -> np.ndarray:
    """Unbounded knapsack by dynamic programming: the pattern of classes 1..len(prices) with the highest
    price that fits into ``room``."""
    m = len(prices)
    value, pick = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for space in range(1, room + 1):
        top = min(m, space)
        gains = value[space - top:space][::-1] + prices[:top]
        k = int(np.argmax(gains))
        if gains[k] > value[space - 1] + 1e-12:
            value[space], pick[space] = gains[k], k + 1
        else:
            value[space] = value[space - 1]
    counts, space = np.zeros(m), room
    while space > 0:
        if pick[space]:
            counts[pick[space] - 1] += 1
            space -= pick[space]
        else:
            space -= 1
    return counts


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Gauss-Jordan elimination. Plain array steps: threads of a linear algebra library can stall beside the
    driver's gateway."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for k in range(n):
        pivot = k + int(np.argmax(np.abs(both[k:, k])))
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        factors = both[:, k].copy()
        factors[k] = 0.0
        rows = np.flatnonzero(factors)
        both[rows] -= factors[rows, None] * both[k]
    return both[:, n:]


def column_generation(demand: np.ndarray, room: int, rounds: int = 4000) -> list[tuple[np.ndarray, float]]:
    """Solve the linear program of cutting stock: the fewest patterns, in fractions, that meet the demand.

    A primal simplex over patterns that are priced in as needed; surplus columns let a pattern hold more of a
    class than is demanded. Starts from the patterns of one class each.
    """
    def times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
        return np.einsum("ij,j->i", matrix, vector)

    present = np.flatnonzero(demand)
    m = len(present)
    columns = [np.where(np.arange(m) == i, float(room // (c + 1)), 0.0) for i, c in enumerate(present)]
    costs = np.ones(m)
    basis = np.array(columns).T if m else np.zeros((0, 0))
    inverse = inverted(basis)
    need = demand[present].astype(float)
    amounts = times(inverse, need)
    for step in range(rounds if m else 0):
        if step % 200 == 199:
            inverse = inverted(basis)
            amounts = np.maximum(times(inverse, need), 0)
        duals = np.einsum("i,ij->j", costs, inverse)
        if duals.min() < -1e-9:
            entering, cost = -np.eye(m)[int(np.argmin(duals))], 0.0
        else:
            prices = np.zeros(room)
            prices[present] = duals
            entering, cost = best_pattern(prices, room)[present], 1.0
            if (duals * entering).sum() < 1 + 1e-7:
                break
        direction = times(inverse, entering)
        ratios = np.where(direction > 1e-9, amounts / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        moved = ratios[out]
        amounts = np.maximum(amounts - moved * direction, 0)
        amounts[out] = moved
        row = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, row)
        inverse[out] = row
        basis[:, out], costs[out] = entering, cost
    solution = []
    for k in range(m):
        if costs[k] and amounts[k] > 0:
            full = np.zeros(len(demand), np.int64)
            full[present] = np.round(basis[:, k]).astype(np.int64)
            solution.append((full, float(amounts[k])))
    return solution


def cutting_plan(demand: np.ndarray, room: int) -> list[Pattern]:
    """Whole numbers of patterns that use every piece exactly once: the program's amounts rounded down, and
    for what is left best-fit patterns of the largest classes first."""
    left, plan = demand.astype(np.int64).copy(), []

    def use(counts: np.ndarray, times: int) -> None:
        if times > 0 and counts.any():
            plan.append(Pattern(tuple((int(c), int(counts[c])) for c in np.flatnonzero(counts)), int(times)))
            left[:] -= counts * times

    for _ in range(2):
        for counts, amount in sorted(column_generation(left, room), key=lambda p: -p[1]):
            held = counts > 0
            use(counts, min(int(amount + 1e-6), int((left[held] // counts[held]).min())))
    while left.any():
        counts, space = np.zeros_like(left), room
        for c in range(len(left) - 1, -1, -1):
            counts[c] = min(left[c], space // (c + 1))
            space -= counts[c] * (c + 1)
        held = counts > 0
        use(counts, int((left[held] // counts[held]).min()))
    return plan


def pack(pieces: DataFrame, *, capacity: int = 2048, unit: int = UNIT, seed: int = 5) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces (with ``doc_id``, ``start`` and ``length`` from 1 to
    ``capacity``) so that no sequence exceeds ``capacity``.

    Lengths are counted in classes of ``unit`` tokens, rounded up, at most capacity / unit of them; the plan is
    made from that histogram alone. Pieces of a class are ranked in a seeded order, and ranks are dealt to the
    places which the patterns hold for the class. Repeated rows are pieces of their own; rows with a null or a common
    doc_id are shuffled like any others; an empty table gives no rows. Other columns are kept, and replaced if named
    like a result; those of a map type can't be hashed and are refused by Spark.
    """
    room = capacity // unit
    kept = [c for c in pieces.columns if c.lower() not in ("sequence_id", "offset")]
    inner = {c: f"in_{k}" for k, c in enumerate(kept)}
    plain = pieces.select(*[named(c).alias(i) for c, i in inner.items()])
    length = inner["length"]
    classed = plain.withColumn("_class", F.ceil(F.col(length) / unit).cast("long"))
    histogram = {r["_class"]: r["count"] for r in classed.groupBy("_class").count().collect()}
    demand = np.zeros(room, np.int64)
    for c, n in histogram.items():
        demand[c - 1] = n
    plan = cutting_plan(demand, room)

    # For each class: from which rank on a pattern takes its pieces, how many to a sequence, which sequences.
    places: dict[int, list[tuple[int, int, int, int]]] = {c: [] for c in histogram}
    used, first = dict.fromkeys(histogram, 0), 0
    for pattern in plan:
        slot = 0
        for c, each in pattern.counts:
            places[c + 1].append((used[c + 1], each, first, slot))
            used[c + 1] += each * pattern.times
            slot += each
        first += pattern.times
    tables = {c: np.array(rows, dtype=np.int64) for c, rows in places.items()}

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, slot = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            classes, ranks = batch["_class"].to_numpy(), batch["rank"].to_numpy()
            for c in np.unique(classes):
                mine = np.flatnonzero(classes == c)
                rows = tables[c][np.searchsorted(tables[c][:, 0], ranks[mine], side="right") - 1]
                past = ranks[mine] - rows[:, 0]
                sequence[mine], slot[mine] = rows[:, 2] + past // rows[:, 1], rows[:, 3] + past % rows[:, 1]
            yield batch.drop(columns=["_class", "rank"]).assign(sequence_id=sequence, _slot=slot)

    cells = cell_count(pieces.sparkSession, sum(histogram.values()))
    columns = plain.columns
    # Whole rows are drawn, so that pieces without a key, or with one in common, aren't all in one cell.
    drawn = classed.withColumn("_draw", F.xxhash64(F.lit(seed), *columns)).withColumn(
        "cell", hash_cell(F.col("_draw"), cells))
    ranked = cell_rank(drawn, ["_class"], [F.col("_draw")])
    shape = T.StructType([*plain.schema.fields, T.StructField("sequence_id", T.LongType()),
                          T.StructField("_slot", T.LongType())])
    dealt = ranked.select(*columns, "_class", "rank").mapInPandas(deal, shape)
    ahead = Window.partitionBy("sequence_id").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.select(
        *[F.col(i).alias(c) for c, i in inner.items()], "sequence_id",
        F.coalesce(F.sum(length).over(ahead), F.lit(0)).alias("offset"))


def pack_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Pieces of all documents with the sequence and offset they are packed at."""
    return pack(settle(token_pieces(docs, tokenizer, **options), "token-pieces"))
