import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tarnlake.operators import series


@pytest.fixture(scope="module")
def readings(spark):
    n = F.col("id")
    return spark.range(900).select(
        n.alias("at"), F.when(n % 3 == 0, "a").otherwise("hot").alias("key"),
        ((n * 7919) % 613 / 7.0).alias("x")).cache()


def by_row(df):
    return {r["at"]: r["score"] for r in df.collect()}


def close(a, b):
    assert a.keys() == b.keys()
    for k in a:
        assert (a[k] is None) == (b[k] is None) and (a[k] is None or a[k] == pytest.approx(b[k], abs=1e-9)), k


@pytest.mark.parametrize("score", [
    lambda df, c: series.diff_rolling(df, ["key"], ["at"], "x", chunks=c),
    lambda df, c: series.median_distance(df, ["key"], "x", chunks=c),
    lambda df, c: series.median_distance_rolling(df, ["key"], ["at"], "x", chunks=c),
    lambda df, c: series.diff_diff_standard(df, ["key"], ["at"], "x", chunks=c),
    lambda df, c: series.nearest_neighbours(df, ["key"], "x", "at", chunks=c),
    lambda df, c: series.principal_component(df, ["key"], ["at"], "x", chunks=c),
    lambda df, c: series.spectral_residual(df, ["key"], ["at"], "x", rows=64, chunks=c),
])
def test_cut_series_score_the_same(readings, score):
    close(by_row(score(readings, 6)), by_row(score(readings, 1)))


def test_neighbours_against_all_pairs(readings):
    rows = readings.toPandas()
    got = by_row(series.nearest_neighbours(readings, ["key"], "x", "at", neighbours=4))
    for _, group in rows.groupby("key"):
        gaps = np.abs(group["x"].to_numpy()[:, None] - group["x"].to_numpy()[None, :])
        np.fill_diagonal(gaps, np.inf)
        for at, want in zip(group["at"], np.sort(gaps, axis=1)[:, 3]):
            assert got[at] == pytest.approx(want, abs=1e-9)


def test_too_few_neighbours(spark):
    two = spark.range(2).selectExpr("id AS at", "'k' AS key", "CAST(id AS DOUBLE) AS x")
    assert set(by_row(series.nearest_neighbours(two, ["key"], "x", "at")).values()) == {None}


def test_component_against_numpy(readings):
    rows = readings.toPandas().sort_values("at")
    got = by_row(series.principal_component(readings, ["key"], ["at"], "x"))
    for _, group in rows.groupby("key"):
        x = group["x"].to_numpy()
        lagged = np.stack([x[2:], x[1:-1], x[:-2]], axis=1)
        centred = lagged - lagged.mean(axis=0)
        axis = np.linalg.svd(centred, full_matrices=False)[2][0]
        want = np.linalg.norm(centred - np.outer(centred @ axis, axis), axis=1)
        assert [got[a] for a in group["at"].iloc[:2]] == [None, None]
        assert np.allclose([got[a] for a in group["at"].iloc[2:]], want, atol=1e-7)


def test_spectral_residual_finds_a_spike(spark):
    wave = pd.DataFrame({"at": range(256), "key": "k", "x": np.sin(np.arange(256) / 5.0)})
    wave.loc[128, "x"] += 6
    scored = by_row(series.spectral_residual(spark.createDataFrame(wave), ["key"], ["at"], "x"))
    assert max(scored, key=scored.get) == 128


def test_flat_series(spark):
    flat = spark.range(20).selectExpr("id AS at", "'k' AS key", "1.0D AS x")
    assert set(by_row(series.histogram_score(flat, ["key"], "x")).values()) == {0.0}
    flags = series.flag(series.mean_distance(flat, ["key"], "x"), ["key"], 95)
    assert flags.filter("is_anomaly").count() == 0
    with pytest.raises(ValueError):
        series.flag(flat, ["key"], 0)


def test_crossing_needs_a_window_below(spark):
    points = spark.createDataFrame(
        [("p", "2024-01-01 00:01:00", 30.0), ("p", "2024-01-01 00:11:00", 10.0), ("p", "2024-01-01 00:21:00", 25.0),
         ("p", "2024-01-01 00:31:00", 26.0)], "id string, at string, t double").withColumn("at", F.to_timestamp("at"))
    means = series.window_means(points, ["id"], "at", "t", "10 minutes", "10 minutes")
    found = series.crossings(means, ["id"], 20.0).collect()
    assert [(str(r["window_start"]), r["mean"], r["previous_mean"]) for r in found] == [("2024-01-01 00:20:00", 25.0, 10.0)]


def test_rows_without_a_value_come_back_unscored(spark):
    rows = spark.range(40).selectExpr("id", "'s' AS k", "id AS at", "CASE WHEN id % 4 <> 0 THEN id * id % 17.0D END AS v")
    near = series.nearest_neighbours(rows, ["k"], "v", "id")
    spectral = series.spectral_residual(rows, ["k"], ["at", "id"], "v")
    for scored in (near, spectral):
        assert sorted(r["id"] for r in scored.collect()) == list(range(40))
        assert scored.filter("score IS NULL").filter("id % 4 <> 0").count() == 0
        assert scored.filter("score IS NULL").count() == 10
