import math
import random

import numpy as np
import pytest

from tarnlake.llm import topk_search

SHAPE = "vec_id long, embedding array<float>"


def by_hand(rows, queries, k, scale=64):
    whole = [(i, [math.floor(scale * float(x)) for x in np.array(v, np.float32)]) for i, v in rows
             if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q is not None and queries(q):
            scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and i is not None and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def search(spark, rows, k, every=1, **options):
    frame = spark.createDataFrame(rows, SHAPE)
    return sorted(map(tuple, topk_search.top_k(frame, frame.where(f"vec_id % {every} = 0"), k, **options).collect()))


@pytest.mark.parametrize("dims, nodes, spread", [(16, 4, 1.0), (7, 4, 0.05), (1, 4, 1.0), (12, 1, 1.0), (8, 3, 1e6)])
def test_scores_and_ties_against_all_pairs(spark, dims, nodes, spread):
    rng = random.Random(dims)
    rows = [(i, [rng.choice([-1, 0, 1, rng.random()]) * spread for _ in range(dims)]) for i in range(300)]
    rows += [(300 + i, rows[i][1]) for i in range(40)]
    assert search(spark, rows, 10, 7, nodes=nodes) == by_hand(rows, lambda q: q % 7 == 0, 10)


def test_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "QUERIES_AT_ONCE", 9)
    monkeypatch.setattr(topk_search, "VECTORS_AT_ONCE", 16)
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(rng.choice([4, 6]))]) for i in range(120)]
    assert search(spark, rows, 5, 4) == by_hand(rows, lambda q: q % 4 == 0, 5)


def test_collecting_needs_few_entries():
    """Clustered vectors: the cutoff leaves little more than k entries a query to resolve and send."""
    rng = np.random.default_rng(2)
    vectors = (64 * (rng.normal(size=(20, 32))[rng.integers(0, 20, 4000)] + 0.2 * rng.normal(size=(4000, 32)))).astype(np.int64)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(4000)), pa.array(list(vectors))], ["vec_id", "parts"])
    block = topk_search.QueryBlock(np.arange(50), vectors[:50], 0, 20, 4)
    (lists,) = list(block.local_lists(iter([batch])))
    tops = np.array(lists.column(1).to_pylist())
    least = np.array(lists.column(2).to_pylist()).T
    cutoff = np.sort(tops, axis=1)[:, -20]
    sent = sum(b.num_rows for b in block.collect(least, cutoff)(iter([batch])))
    assert 50 * 20 <= sent <= 50 * 40


def test_oddities(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []),
            (7, [1.0]), (8, [0.0, 0.0]), (9, [-0.01, 0.5]), (6, []), (11, [])]
    got = search(spark, rows, 3)
    assert got == sorted(by_hand(rows, lambda q: True, 3))
    assert [r for r in got if r[0] == 7] == [] and len([r for r in got if r[0] == 1]) == 4
    assert search(spark, [], 3) == [] and search(spark, [(1, [1.0])], 3) == []
    wide = spark.createDataFrame([(1, [1.0], 5, 6), (2, [2.0], 5, 6)], SHAPE + ", score int, query int")
    assert sorted(map(tuple, topk_search.top_k(wide, wide, 1).collect())) == [(1, 1, 2, 8192), (2, 1, 1, 8192)]


def test_null_ids_are_candidates_but_no_queries(spark):
    """Ids beyond 2**53 beside them keep all their digits, and an id of 0 is not taken for a null one."""
    large = 2**60 + 1
    rows = [(0, [1.0, 1.0]), (None, [1.0, 1.0]), (large, [1.0, 1.0]), (None, [2.0, 1.0]), (large + 1, [0.5, 1.0])]
    frame = spark.createDataFrame(rows, SHAPE).coalesce(1)
    got = sorted((tuple(r) for r in topk_search.top_k(frame, frame, 4).collect()), key=lambda r: r[:2])
    unit = 64 * 64
    assert got == [
        (0, 1, None, 3 * unit), (0, 2, large, 2 * unit), (0, 3, None, 2 * unit), (0, 4, large + 1, unit * 3 // 2),
        (large, 1, None, 3 * unit), (large, 2, 0, 2 * unit), (large, 3, None, 2 * unit), (large, 4, large + 1, unit * 3 // 2),
        (large + 1, 1, None, 2 * unit), (large + 1, 2, 0, unit * 3 // 2), (large + 1, 3, large, unit * 3 // 2),
        (large + 1, 4, None, unit * 3 // 2)]
