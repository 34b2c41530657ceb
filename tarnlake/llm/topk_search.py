"""Exact top-k inner products by a three-phase uniform threshold over blocks of dimensions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.common import named, settle

NODES = 4
QUERIES_AT_ONCE = 4096
VECTORS_AT_ONCE = 512
MERGES = 64
ENTRIES = "query long, query_id long, vec_id long, score long"


def usable(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``vec_id`` and ``parts`` (each component times ``scale``, rounded down) of the vectors that take part."""
    plain = vectors.select(named(key).cast("long").alias("vec_id"), named(vector).alias("parts"))
    finite = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return plain.where(F.col("parts").isNotNull() & finite).select(
        "vec_id", F.transform("parts", lambda x: F.floor(x.cast("double") * scale).cast("long")).alias("parts"))


def stacked(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """The rows of a list column by length: their numbers, and a matrix of their values."""
    flat, offsets = lists.flatten().to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    base, out = int(offsets[0]), {}
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        out[n] = rows, flat[(offsets[rows] - base)[:, None] + np.arange(n)]
    return out


def exact_kind(*matrices: np.ndarray) -> type:
    """The float type in which all partial inner products are whole and exact, or else int64."""
    largest = [int(np.abs(m).max(initial=0)) for m in matrices]
    bound = largest[0] * largest[1] * matrices[0].shape[1]
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


def partial_scores(queries: np.ndarray, vectors: np.ndarray, cuts: np.ndarray, kind: type) -> Iterator[np.ndarray]:
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield queries[:, low:high].astype(kind) @ vectors[:, low:high].astype(kind).T


class QueryBlock:
    """Up to ``QUERIES_AT_ONCE`` queries of one length; a bounded amount of data, sent to every task."""

    def __init__(self, ids: np.ndarray, parts: np.ndarray, first: int, k: int, nodes: int):
        self.ids, self.parts, self.first, self.k = ids, parts, first, k
        cuts = np.unique(np.linspace(0, parts.shape[1], nodes + 1).astype(int))
        # Vectors without components meet too, on one node, with a score of 0.
        self.cuts = cuts if len(cuts) > 1 else np.zeros(2, int)

    def blocks(self, batches: Iterator[pa.RecordBatch]):
        """Candidates in blocks: their ids (0 where null), where these are null, and the nodes' partial scores."""
        for batch in batches:
            rows, matrix = stacked(batch.column(1)).get(self.parts.shape[1], (None, None))
            if rows is None:
                continue
            null = batch.column(0).is_null().to_numpy(zero_copy_only=False)[rows]
            ids = batch.column(0).fill_null(0).to_numpy()[rows]
            kind = exact_kind(self.parts, matrix)
            for at in range(0, len(ids), VECTORS_AT_ONCE):
                some = slice(at, at + VECTORS_AT_ONCE)
                yield ids[some], null[some], list(partial_scores(self.parts, matrix[some], self.cuts, kind))

    def own(self, ids: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (query, candidate) at which the candidate has the query's id. A null id is no query's."""
        order = np.argsort(ids, kind="stable")
        low = np.searchsorted(ids, self.ids, side="left", sorter=order)
        high = np.searchsorted(ids, self.ids, side="right", sorter=order)
        query = np.repeat(np.arange(len(self.ids)), high - low)
        nth = np.arange(len(query)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
        at = order[np.repeat(low, high - low) + nth]
        return query[~null[at]], at[~null[at]]

    def local_lists(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phase 1: of every node the least partial score, and the totals of its k highest entries. A task's
        cut is the k-th highest of the totals it has seen, so that later entries are few."""
        n, nodes = len(self.ids), len(self.cuts) - 1
        least = np.full((nodes, n), np.iinfo(np.int64).max, np.int64)
        tops = np.full((n, self.k), np.iinfo(np.int64).min, np.int64)
        for ids, null, parts in self.blocks(batches):
            for node, scores in enumerate(parts):
                np.minimum(least[node], scores.min(axis=1).astype(np.int64), out=least[node])
            total = sum(parts)
            total = total.astype(np.int64)
            total[self.own(ids, null)] = np.iinfo(np.int64).min
            listed = np.zeros(total.shape, bool)
            keep = min(self.k, len(ids))
            for scores in parts:
                bar = np.partition(scores, len(ids) - keep, axis=1)[:, len(ids) - keep]
                listed |= scores >= bar[:, None]
            # Entries on no node's list are left out, as they would not have been gathered.
            total[~listed] = np.iinfo(np.int64).min
            best = np.partition(total, len(ids) - keep, axis=1)[:, len(ids) - keep:]
            tops = np.partition(np.concatenate([tops, best], axis=1), keep, axis=1)[:, -self.k:]
        lists = pa.ListArray.from_arrays(np.arange(0, n * self.k + 1, self.k, dtype=np.int32), pa.array(tops.ravel()))
        mins = pa.ListArray.from_arrays(np.arange(0, n * nodes + 1, nodes, dtype=np.int32), pa.array(least.T.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), lists, mins], ["query", "tops", "least"])

    def collect(self, least: np.ndarray, cutoff: np.ndarray):
        """Phases 2 and 3: entries whose partial score, counted from the node's least, reaches an equal share of
        the cutoff on some node; their totals, resolved exactly, if they reach the cutoff."""
        nodes = len(self.cuts) - 1
        span = cutoff - least.sum(axis=0)
        share = -(-span // nodes)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for ids, null, parts in self.blocks(batches):
                collected = np.zeros(parts[0].shape, bool)
                for node, scores in enumerate(parts):
                    collected |= scores >= (least[node] + share)[:, None]
                collected[self.own(ids, null)] = False
                query, at = np.nonzero(collected)
                total = sum(p[query, at].astype(np.int64) for p in parts)
                kept = total >= cutoff[query]
                yield pa.RecordBatch.from_arrays([
                    pa.array(query[kept] + self.first), pa.array(self.ids[query[kept]]),
                    pa.array(ids[at[kept]], mask=null[at[kept]]), pa.array(total[kept])], ["query", "query_id", "vec_id", "score"])

        return run


def search_block(vectors: DataFrame, block: QueryBlock) -> DataFrame:
    spark = vectors.sparkSession
    bottom = np.iinfo(np.int64).min
    gathered = vectors.mapInArrow(block.local_lists, "query int, tops array<long>, least array<long>")
    nodes = len(block.cuts) - 1
    ends = [F.col("least")[n].alias(f"least_{n}") for n in range(nodes)]
    highest = F.slice(F.sort_array(F.flatten(F.collect_list("tops")), asc=False), 1, block.k).alias("tops")
    # In two steps, so that however many tasks there are, their lists of a query don't meet all at once.
    parts = gathered.select("query", "tops", *ends, F.pmod(F.spark_partition_id(), F.lit(MERGES)).alias("part"))
    for keys in (["query", "part"], ["query"]):
        parts = parts.groupBy(*keys).agg(highest, *[F.min(f"least_{n}").alias(f"least_{n}") for n in range(nodes)])
    merged = parts.toPandas()
    if not len(merged):
        return spark.createDataFrame([], ENTRIES)
    merged = merged.sort_values("query")
    # The k-th highest total seen bounds the k-th highest of all from below; fewer than k totals bound nothing.
    cutoff = np.array([t[-1] if len(t) == block.k else bottom for t in merged["tops"]], np.int64)
    least = np.stack([merged[f"least_{n}"].to_numpy(np.int64) for n in range(nodes)])
    least = np.where(least == np.iinfo(np.int64).max, 0, least)
    cutoff = np.maximum(cutoff, least.sum(axis=0))
    return vectors.mapInArrow(block.collect(least, cutoff), ENTRIES)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, *, key: str = "vec_id", vector: str = "embedding",
          scale: int = 64, nodes: int = NODES) -> DataFrame:
    """For every query row the ``k`` rows of ``vectors`` with the highest inner products: ``query_id``, ``rank``
    (from 1), ``vec_id`` and ``score``.

    Components are multiplied by ``scale`` and rounded down; scores are whole and exact. The dimensions are
    split among ``nodes``. Phase 1 gathers each node's local list of every task and takes the k-th highest
    total as the cutoff; phase 2 collects the entries that reach an equal share of it on some node, which
    any row that reaches the cutoff does; phase 3 resolves the totals of those.

    - Queries go in blocks of ``QUERIES_AT_ONCE``: only a block and its cutoffs are on the driver and sent to
      tasks, and the vectors are passed over twice a block.
    - Ties go to the smaller vec_id. A query's own id is no candidate, in no row that repeats it; a query row
      that is repeated is answered as often. With fewer candidates than k all are returned.
    - Vectors that are null, or hold a null or a number that is not finite, take no part; nor does a null id
      as a query (as a candidate it is listed last among ties). Vectors meet those of their own length only.
    - Other columns are left out. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    pool = usable(vectors, key, vector, scale)
    asked = usable(queries, key, vector, scale).where("vec_id IS NOT NULL")
    found, first, held = spark.createDataFrame([], ENTRIES), 0, []

    def answered() -> DataFrame:
        ids = np.array([r["vec_id"] for r in held], np.int64)
        parts = np.array([r["parts"] for r in held], np.int64).reshape(len(held), len(held[0]["parts"]))
        # Written, so that a block's scores are not computed again when the next ones are.
        return settle(search_block(pool, QueryBlock(ids, parts, first, k, nodes)), "top-entries")

    for row in asked.orderBy(F.size("parts"), "vec_id").toLocalIterator():
        if held and (len(held) == QUERIES_AT_ONCE or len(held[0]["parts"]) != len(row["parts"])):
            found, first, held = found.union(answered()), first + len(held), []
        held.append(row)
    if held:
        found = found.union(answered())
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
