"""Ranked lexical search: exact top-k inner products of impact vectors in buckets of like length."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import cell_count, cell_rank, hash_cell, named, settle
from tarnlake.llm.tokens import TEXT_BYTES, slices

# Fixed rule: terms are runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z are lowered.
SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
FOLD = bytes(0x20 if b in SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

ITEMS_AT_ONCE = 1024
TERMS_AT_ONCE = 100_000
SEEDS = 20_000
BUCKET = 4096
# Bounds are taken in doubles; so much is added that rounding never puts one below what it bounds.
SLACK = 1 + 1e-9
VECTORS = "doc_id long, n long, terms array<int>, tfs array<int>"
INDEX = "doc_id long, norm double, m long, terms array<int>, tfs array<int>"
FOUND = "item int, doc_id long, score long"


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order, repeats included."""
    return text.translate(FOLD).split()


def _utf8(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(named(key).cast("long").alias("id"), named(text).cast("binary").alias("text")).where("text IS NOT NULL")


def numbered_items(items: DataFrame, key: str, text: str) -> DataFrame:
    """The items with their distinct terms, and a block number for each: a block holds at most
    ``ITEMS_AT_ONCE`` items, and their terms exceed ``TERMS_AT_ONCE`` by one item's at most."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(terms(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(own, pa.list_(pa.binary()))], ["item_id", "terms"])

    split_items = _utf8(items, key, text).mapInArrow(split, "item_id long, terms array<binary>").where(F.size("terms") > 0)
    drawn = settle(split_items.withColumn("draw", F.xxhash64("item_id", "terms")), "search-items")
    cells = cell_count(items.sparkSession, drawn.count())
    sized = drawn.withColumn("size", F.size("terms").cast("long")).withColumn("cell", hash_cell(F.col("draw"), cells))
    ranked = cell_rank(sized, [], [F.col("draw")], value="size")
    block = F.struct(F.expr(f"rank div {ITEMS_AT_ONCE}").alias("by_items"), F.expr(f"before div {TERMS_AT_ONCE}").alias("by_terms"))
    return settle(ranked.select("item_id", "terms", block.alias("block")), "search-blocks")


class TermCounts:
    """Counts the terms of a block's vocabulary in whole texts."""

    def __init__(self, vocabulary: list[bytes]):
        self.codes = {t: c for c, t in enumerate(vocabulary)}

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, get = len(self.codes), self.codes.get
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for low, high in slices(texts, TEXT_BYTES):
                n, found = [], []
                for text in texts[low:high]:
                    own = terms(text)
                    n.append(len(own))
                    found.append(np.fromiter(map(get, own, repeat(-1)), np.int64, len(own)))
                codes, n = np.concatenate(found), np.array(n, np.int64)
                doc = np.repeat(np.arange(len(n)), n)
                known = codes >= 0
                pairs, tfs = np.unique(doc[known] * size + codes[known], return_counts=True)
                offsets = np.searchsorted(pairs, np.arange(len(n) + 1) * size).astype(np.int32)
                rows = pa.RecordBatch.from_arrays([
                    keys.slice(low, high - low), pa.array(n),
                    pa.ListArray.from_arrays(offsets, pa.array((pairs % size).astype(np.int32))),
                    pa.ListArray.from_arrays(offsets, pa.array(tfs.astype(np.int32)))], ["doc_id", "n", "terms", "tfs"])
                yield rows.filter(pa.array(n > 0))


def term_weights(found: dict[int, int], size: int, n_docs: int) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) for every term of the vocabulary."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * found.get(t, 0) + 1))) for t in range(size)], np.int64)


def impacts(weights: np.ndarray, codes: np.ndarray, tfs: np.ndarray, m: np.ndarray) -> np.ndarray:
    tfs = tfs.astype(np.int64)
    return weights[codes] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * m))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets (from 0) of a list column."""
    offsets = column.offsets.to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False), offsets - offsets[0]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])[offsets])


class Lengths:
    """Adds the length (Euclidean norm) of each impact vector; vectors without a term of the vocabulary go."""

    def __init__(self, weights: np.ndarray, n_docs: int, n_terms: int):
        self.weights, self.n_docs, self.n_terms = weights, n_docs, n_terms

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, offsets = _lists(batch.column(2))
            tfs, _ = _lists(batch.column(3))
            m = 100 - 50 + (50 * batch.column(1).to_numpy() * self.n_docs) // self.n_terms
            own = impacts(self.weights, codes, tfs, np.repeat(m, np.diff(offsets))).astype(float)
            # Summed row by row, so that a short vector behind long ones loses no digits.
            rows = np.flatnonzero(np.diff(offsets))
            norm = np.zeros(len(m))
            if len(rows):
                norm[rows] = np.sqrt(np.add.reduceat(own * own, offsets[rows]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norm), pa.array(m), batch.column(2), batch.column(3)],
                ["doc_id", "norm", "m", "terms", "tfs"]).filter(pa.array(norm > 0))


class BestLists:
    """The best rows of every item so far, and the score that a further row must reach: equal scores are kept, and
    go by doc_id (null last)."""

    def __init__(self, n_items: int, k: int, floors: np.ndarray):
        self.k, self.floors = k, floors.copy()
        empty = np.zeros(0, np.int64)
        self.lists = [(empty, empty, np.zeros(0, bool)) for _ in range(n_items)]

    def add(self, item: int, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        scores, ids, null = (np.concatenate(pair) for pair in zip(self.lists[item], (scores, ids, null)))
        order = np.lexsort((ids, null, -scores))[:self.k]
        self.lists[item] = scores[order], ids[order], null[order]
        if len(order) == self.k:
            self.floors[item] = max(self.floors[item], scores[order[-1]])

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s, _, _ in self.lists]
        scores, ids, null = (np.concatenate(column) for column in zip(*self.lists))
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)), pa.array(ids, mask=null), pa.array(scores)],
            ["item", "doc_id", "score"])


class NormBuckets:
    """Searches vectors that come in order of length, the longest first, bucket by bucket.

    An item is a vector of ones at its terms, so its length is the root of their number. For an item and a
    bucket, with the score that is to be reached:

    1. Cauchy-Schwarz: the item's length times the bucket's greatest length; below the score, the bucket is pruned.
    2. Coordinate bounds of the bucket: the sum of its greatest impacts at the item's terms prunes it too.
    3. Inside, terms go from the greatest such impact down. The last ones whose bounds together stay below
       the score can't lift a row that has none of the others: only rows with one of those, the focus, are looked at.
       Their impacts in the focus are summed, and what the rest can add is bounded by the bounds of the rest, and by
       Cauchy-Schwarz over what the focus leaves of both lengths.
    4. Rows whose bound reaches the score are scored anew, in integers.
    """

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, floors: np.ndarray, k: int):
        self.items, self.weights, self.floors, self.k = items, weights, floors, k

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = BestLists(len(self.items), self.k, self.floors)
        sizes = np.array([len(i) for i in self.items])
        flat, starts = np.concatenate(self.items), np.cumsum(sizes) - sizes
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                self._bucket(batch.slice(at, BUCKET), best, sizes, flat, starts)
        yield best.rows()

    def _bucket(self, rows: pa.RecordBatch, best: BestLists, sizes: np.ndarray, flat: np.ndarray, starts: np.ndarray) -> None:
        norms = rows.column(1).to_numpy()
        able = np.sqrt(sizes) * norms.max() * SLACK >= best.floors
        if not able.any():
            return
        codes, offsets = _lists(rows.column(3))
        lengths = np.diff(offsets)
        own = impacts(self.weights, codes, _lists(rows.column(4))[0], np.repeat(rows.column(2).to_numpy(), lengths))
        row = np.repeat(np.arange(len(norms)), lengths)
        order = np.argsort(codes, kind="stable")
        bounds = np.searchsorted(codes[order], np.arange(len(self.weights) + 1))
        most, present = np.zeros(len(self.weights)), np.flatnonzero(np.diff(bounds))
        most[present] = np.maximum.reduceat(own[order], bounds[present])
        able &= np.add.reduceat(most[flat], starts) * SLACK >= best.floors
        ids, null = rows.column(0).fill_null(0).to_numpy(), rows.column(0).is_null().to_numpy(zero_copy_only=False)
        chosen = np.zeros(len(self.weights), bool)
        for item in np.flatnonzero(able).tolist():
            floor = best.floors[item]
            wanted = self.items[item]
            wanted = wanted[np.argsort(-most[wanted], kind="stable")]
            wanted = wanted[most[wanted] > 0]
            if not len(wanted):
                continue
            # What the terms from each place on can add at most.
            rest = np.cumsum(most[wanted][::-1])[::-1] * SLACK
            n_focus = max(int((rest >= floor).sum()), 1)
            focus, others = wanted[:n_focus], len(wanted) - n_focus
            places = np.concatenate([order[bounds[t]:bounds[t + 1]] for t in focus.tolist()])
            part = np.bincount(row[places], own[places], len(norms))
            most_rest = rest[n_focus] if others else 0.0
            reach = np.flatnonzero((part > 0) & (part * SLACK + most_rest >= floor)
                                   & (np.sqrt(sizes[item]) * norms * SLACK >= floor))
            if others and len(reach):
                squares = np.bincount(row[places], own[places].astype(float) ** 2, len(norms))[reach]
                left = np.sqrt(others * np.maximum(norms[reach] ** 2 * SLACK - squares, 0))
                reach = reach[(part[reach] + left) * SLACK >= floor]
            if not len(reach):
                continue
            chosen[wanted] = True
            own_of = lengths[reach]
            ends = np.cumsum(own_of)
            at = np.repeat(offsets[reach] - ends + own_of, own_of) + np.arange(int(ends[-1]))
            scores = np.add.reduceat(np.where(chosen[codes[at]], own[at], 0), ends - own_of)
            chosen[wanted] = False
            kept = (scores >= floor) & (scores > 0)
            best.add(item, scores[kept], ids[reach[kept]], null[reach[kept]])


def _search_block(docs: DataFrame, items: list[tuple[int | None, list[bytes]]], k: int) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, own in items for t in own})
    codes = {t: c for c, t in enumerate(vocabulary)}
    queries = [np.array([codes[t] for t in own], np.int64) for _, own in items]
    vectors = settle(docs.mapInArrow(TermCounts(vocabulary), VECTORS), "term-vectors")
    totals = vectors.agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_terms")).first()
    if not totals["n_docs"]:
        return None
    n_docs, n_terms = totals["n_docs"], totals["n_terms"]
    found = dict(vectors.select(F.explode("terms").alias("term")).groupBy("term").count().toPandas().itertuples(index=False))
    weights = term_weights(found, len(vocabulary), n_docs)
    index = settle(vectors.mapInArrow(Lengths(weights, n_docs, n_terms), INDEX).sortWithinPartitions(F.desc("norm")), "norm-index")

    # The longest vectors first: their scores are the floors for all others.
    share = max(0.0, 1 - SEEDS / n_docs)
    cut = index.agg(F.percentile_approx("norm", F.lit(share), F.lit(1000))).first()[0]
    if cut is None:
        return None
    nothing = np.zeros(len(queries), np.int64)
    seeds = settle(index.where(F.col("norm") >= cut).mapInArrow(NormBuckets(queries, weights, nothing, k), FOUND), "search-seeds")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    last = seeds.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).groupBy("item").agg(
        F.count(F.lit(1)).alias("rows"), F.min("score").alias("score")).where(F.col("rows") == k).collect()
    floors = nothing.copy()
    for r in last:
        floors[r["item"]] = r["score"]
    # Cauchy-Schwarz for all items at once, which Spark hands to the scan of the index.
    least = min(f / math.sqrt(len(q)) for f, q in zip(floors.tolist(), queries)) / SLACK
    others = index.where((F.col("norm") < cut) & (F.col("norm") >= least))
    rest = others.mapInArrow(NormBuckets(queries, weights, floors, k), FOUND)
    ranked = seeds.unionByName(rest).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(n, item) for n, (item, _) in enumerate(items)], "item int, item_id long")
    return settle(ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "search-results")


def search(docs: DataFrame, items: DataFrame, k: int = 50, *, key: str = "doc_id", text: str = "text",
           item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """For every item the ``k`` documents with the highest scores above 0: ``item_id``, ``rank`` (from 1),
    ``doc_id`` and ``score``.

    A document is the vector of its terms' impacts ``w * ((10**9 * tf) div (1000 * tf + 20 * m))``, a whole number
    each, where w tells how rare the term is and m how long the document; an item is the set of its terms. The
    vectors are held in order of length. The ``SEEDS`` longest are searched first, and the scores they reach are the
    floors below which buckets and rows of all other vectors are pruned (``NormBuckets``); what is left is scored in
    integers, so that results are exact.

    - Items go in blocks of ``ITEMS_AT_ONCE`` items and about ``TERMS_AT_ONCE`` terms. Only a block, one number
      for each of its terms and one for each of its items are on the driver and sent to tasks; the texts are passed
      over once a block. Documents aren't shuffled: each task keeps the vectors it made in order.
    - Null and empty texts, and those without a term, are no documents and no items. A null doc_id comes last
      among equal scores. Repeated rows are documents, or items, of their own; items with equal or null ids are
      ranked apart. Other columns are left out, whatever their names. Empty tables give no rows.
    """
    spark = docs.sparkSession
    numbered = numbered_items(items, item_key, item_text)
    results = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    texts = _utf8(docs, key, text)
    for (block,) in numbered.select("block").distinct().orderBy("block").collect():
        here = numbered.where((F.col("block.by_items") == block["by_items"]) & (F.col("block.by_terms") == block["by_terms"]))
        rows = [(r["item_id"], [bytes(t) for t in r["terms"]]) for r in here.collect()]
        found = _search_block(texts, rows, k)
        if found is not None:
            results = results.unionByName(found)
    return results
