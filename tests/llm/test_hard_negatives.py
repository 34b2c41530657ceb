"""Residue products against Python's whole numbers, and mining against a plain ranking."""

import numpy as np
import pytest

from tarnlake.llm import hard_negatives as hard


def exact(a, b):
    return [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in b] for r in a]


@pytest.mark.parametrize("low,high,dim", [
    (-3, 4, 5), (-300, 300, 64), (-2**20, 2**20, 33), (-2**29, 2**29, 7), (0, 2, 3000), (-127, 128, 2500), (5, 6, 1)])
def test_products_are_exact(low, high, dim):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(low, high, (4, dim)), rng.integers(low, high, (6, dim))
    primes = hard.enough_primes(a, b)
    assert hard.products(hard.residues(a, primes), hard.residues(b, primes), primes).tolist() == exact(a, b)


def test_extremes_are_exact():
    for a in (np.array([[-2**31, 2**31 - 1]]), np.array([[0, 0]]), np.array([[2**62, 0]]), np.array([[-2**61, 1]])):
        b = np.array([[1, 0], [0, -1], [-1, 0]])
        primes = hard.enough_primes(a, b)
        assert hard.products(hard.residues(a, primes), hard.residues(b, primes), primes).tolist() == exact(a, b)


def test_primes():
    assert len(hard.PRIMES) == 23 and hard.PRIMES[0] == 251 and hard.PRIMES[-1] == 131
    assert hard.TERMS * 127**2 <= 2**24
    # No two inner products are confused at the largest ones.
    a = np.full((1, 64), 256)
    assert np.prod([float(p) for p in hard.enough_primes(a, -a)]) > 2 * 64 * 256**2


def test_first_places():
    none = hard.NONE
    scores = np.array([[5, 7, 7, none, 7, 1], [none] * 6, [2, none, none, 2, 2, 2]])
    assert [np.flatnonzero(r).tolist() for r in hard.first_places(scores, 2)] == [[1, 2], [], [0, 3]]
    assert [np.flatnonzero(r).tolist() for r in hard.first_places(scores, 9)] == [[0, 1, 2, 4, 5], [], [0, 3, 4, 5]]


def ranked(rows, anchors, scale=256):
    def usable(row):
        return row[1] is not None and row[2] is not None and all(x is not None and np.isfinite(x) for x in row[2])

    def parts(row):
        return [int(np.floor(scale * x)) for x in row[2]]

    def by_score(pair):
        score, row = pair
        return -score, row[0] is None, row[0] or 0

    out, rows = [], [r for r in rows if usable(r)]
    for a in anchors:
        if not usable(a) or a[0] is None:
            continue
        scored = [(sum(x * y for x, y in zip(parts(a), parts(r))), r) for r in rows if len(r[2]) == len(a[2])]
        positives = sorted((p for p in scored if p[1][1] == a[1] and p[1][0] != a[0]), key=by_score)[:5]
        for score, p in positives:
            inside = sorted((n for n in scored if n[1][1] != a[1] and 30 * score <= 100 * n[0] <= 90 * score), key=by_score)[:10]
            out += [(a[0], p[0], k, n[0], score, s) for k, (s, n) in enumerate(inside, 1)]
    return out


SHAPE = "vec_id long, embedding array<float>, label int, block string, rank int, score int"


def mined(spark, rows, anchors, **options):
    frames = [spark.createDataFrame([(i, v, label, "b", 1, 2) for i, label, v in some], SHAPE) for some in (rows, anchors)]
    return sorted(map(str, map(tuple, hard.mine(frames[0].repartition(3), frames[1], **options).collect())))


def test_mining_is_the_plain_ranking(spark, monkeypatch):
    monkeypatch.setattr(hard, "ANCHORS_AT_ONCE", 7)
    monkeypatch.setattr(hard, "VECTORS_AT_ONCE", 40)
    monkeypatch.setattr(hard, "SCORES_AT_ONCE", 16)
    monkeypatch.setattr(hard, "BLOCKS_HELD", 1)
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 3)), rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    anchors = [r for r in rows if r[0] % 12 == 0]
    wanted = sorted(map(str, ranked(rows, anchors, 1)))
    assert len(wanted) > 500
    assert mined(spark, rows, anchors, scale=1) == wanted


def test_oddities(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, 1, [1.0, 0.5]) for i in range(8)]
    rows += [(3, 1, [1.0, 0.5])] * 3 + [(None, 1, [1.0, 0.5])] * 2 + [(None, 2, [0.5, 0.25]), (None, 2, [0.5, 0.25])]
    rows += [(20 + i, 2, [0.5, 0.25]) for i in range(9)] + [(40, None, [0.5, 0.25]), (41, 2, None), (42, 2, [0.5, None])]
    rows += [(43, 2, [nan, 0.25]), (44, 2, [-inf, 0.25]), (45, 1, [1.0, 0.5, 0.0]), (46, 2, [0.5, 0.25, 0.0]), (47, 1, [1.0, 0.5, 0.0])]
    rows += [(48, 1, []), (49, 1, []), (50, 2, []), (51, 1, [-1.0, -0.5]), (52, 3, [0.0, 0.0]), (53, 3, [0.0, 0.0]), (54, 1, [0.0, 0.0])]
    rows += [(60, 7, [3e9, 0.0]), (61, 7, [1e4, 0.0]), (62, 8, [5e3, 0.0]), (63, 8, [-1e4, 0.0])]
    anchors = [r for r in rows if r[0] is None or r[0] in (0, 3, 45, 48, 51, 52, 40, 41, 60)]
    assert mined(spark, rows, anchors) == sorted(map(str, ranked(rows, anchors)))
    assert mined(spark, [], anchors) == [] and mined(spark, rows, []) == [] and mined(spark, [], []) == []
