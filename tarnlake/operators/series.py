"""Anomaly scores and threshold crossings over time series.

A series is the rows of one instance (``keys``), ordered by time. Series may be very long, so ordered
work goes through ``ordered``, and Python tasks get blocks of a fixed number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.operators.joins import join_null_safe
from tarnlake.operators.ordered import (
    median_per_group,
    number_rows,
    value_at_fraction,
    with_neighbours,
)
from tarnlake.sizing import settled, task_count

WINDOW_ROWS = 5
HISTOGRAM_BINS = 10
NEIGHBOURS = 5
SPECTRAL_ROWS = 256
ESTIMATED = 5
EMBEDDING = 3


def diff_rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "score",
                 rows: int = WINDOW_ROWS, chunks: int | None = None) -> DataFrame:
    """Squared difference from the mean of the last ``rows`` values."""
    steps = {out: lambda w: F.pow(F.col(value) - F.avg(value).over(w.rowsBetween(1 - rows, 0)), 2)}
    return with_neighbours(df, keys, order, rows - 1, 0, steps, chunks)


def signal(df: DataFrame, value: str, out: str = "score") -> DataFrame:
    """The raw value."""
    return df.withColumn(out, F.col(value))


def median_distance(df: DataFrame, keys: Sequence[str], value: str, out: str = "score",
                    chunks: int | None = None) -> DataFrame:
    """Absolute distance from the median of the series."""
    middle = median_per_group(df, keys, value, "__median", chunks)
    joined = join_null_safe(df, settled(middle), keys)
    return joined.withColumn(out, F.abs(F.col(value) - F.col("__median"))).drop("__median")


def _middle_of(values: Column) -> Column:
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.floor((n + 1) / 2).cast("int"), (F.floor(n / 2) + 1).cast("int")
    return (F.try_element_at(ordered, low) + F.try_element_at(ordered, high)) / 2


def median_distance_rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
                            out: str = "score", rows: int = WINDOW_ROWS, chunks: int | None = None) -> DataFrame:
    """Absolute distance from the median of the last ``rows`` values."""
    steps = {
        "__last": lambda w: F.collect_list(value).over(w.rowsBetween(1 - rows, 0)),
        out: lambda w: F.abs(F.col(value) - _middle_of(F.col("__last"))),
    }
    return with_neighbours(df, keys, order, rows - 1, 0, steps, chunks).drop("__last")


def mean_distance(df: DataFrame, keys: Sequence[str], value: str, out: str = "score") -> DataFrame:
    """Absolute distance from the mean of the series."""
    middle = df.groupBy(*keys).agg(F.avg(value).alias("__mean"))
    joined = join_null_safe(df, settled(middle), keys)
    return joined.withColumn(out, F.abs(F.col(value) - F.col("__mean"))).drop("__mean")


def diff_diff_standard(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "score",
                       rows: int = WINDOW_ROWS, chunks: int | None = None) -> DataFrame:
    """Standard deviation of the last ``rows`` second differences; null while there are fewer than two."""
    steps = {
        "__bend": lambda w: F.col(value) - 2 * F.lag(value, 1).over(w) + F.lag(value, 2).over(w),
        out: lambda w: F.stddev("__bend").over(w.rowsBetween(1 - rows, 0)),
    }
    return with_neighbours(df, keys, order, rows + 1, 0, steps, chunks).drop("__bend")


def histogram_score(df: DataFrame, keys: Sequence[str], value: str, out: str = "score",
                    bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Histogram-based outlier score: log of the fullest bin's count over the value's own bin count.

    Bins are counted per series before anything is joined back; equal-width bins from least to greatest.
    """
    ends = df.groupBy(*keys).agg(F.min(value).alias("__low"), F.max(value).alias("__high"))
    width = (F.col("__high") - F.col("__low")) / bins
    bin_of = F.least(F.lit(bins - 1), F.coalesce(
        F.floor(F.try_divide(F.col(value) - F.col("__low"), width)), F.lit(0))).cast("int")
    placed = join_null_safe(df, settled(ends), keys).withColumn(
        "__bin", F.when(F.col(value).isNotNull(), bin_of)).drop("__low", "__high")
    counts = placed.filter(F.col("__bin").isNotNull()).groupBy(*keys, "__bin").agg(F.count(F.lit(1)).alias("__n"))
    fullest = F.max("__n").over(Window.partitionBy(*keys))  # at most ``bins`` rows per series
    rated = counts.select(*keys, "__bin", F.ln(fullest / F.col("__n")).alias(out))
    return join_null_safe(placed, settled(rated), [*keys, "__bin"]).drop("__bin")


def _with_unscored(scored: DataFrame, df: DataFrame, value: str, out: str) -> DataFrame:
    """The scored rows and those without a value, whose score is null."""
    kind = scored.schema[out].dataType
    rest = df.filter(F.col(value).isNull()).withColumn(out, F.lit(None).cast(kind))
    return scored.unionByName(rest.select(*scored.columns))


def nearest_neighbours(df: DataFrame, keys: Sequence[str], value: str, tie: str, out: str = "score",
                       neighbours: int = NEIGHBOURS, chunks: int | None = None) -> DataFrame:
    """Distance to the k-th nearest other value of the series, exactly.

    The k nearest of a number stand next to it in sorted order: of the k+1 runs of k+1 neighbours that
    hold it, the narrowest reach is the answer. Series of k or fewer values and rows without a value have
    no score.
    """
    k = neighbours
    reaches = [f"__r{i}" for i in range(k + 1)]

    def reach(left: int):
        def step(w):
            low = F.lag(value, left).over(w) if left else F.col(value)
            high = F.lead(value, k - left).over(w) if left < k else F.col(value)
            here = F.col(value)
            return F.when(low.isNotNull() & high.isNotNull(), F.greatest(here - low, high - here))
        return step

    present = df.filter(F.col(value).isNotNull())
    steps = {name: reach(i) for i, name in enumerate(reaches)}
    found = with_neighbours(present, keys, [value, tie], k, k, steps, chunks)
    least = F.least(*reaches) if k else F.col(reaches[0])
    return _with_unscored(found.withColumn(out, least).drop(*reaches), df, value, out)


def spectral_residual(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "score",
                      rows: int = SPECTRAL_ROWS, hop: int | None = None, estimated: int = 0, history: bool = False,
                      chunks: int | None = None) -> DataFrame:
    """Spectral residual over windows of ``rows`` consecutive values of a series.

    The transform needs a whole window in memory; the window length bounds every array. The score is
    the relative distance of the saliency map from its local mean. Rows without a value have no score.

    Windows begin every ``hop`` rows (by default they don't overlap), up to the one that reaches the series' end.
    A window may be lengthened by ``estimated`` points that go on from its last rows, so that these aren't judged at
    an edge. A row in several windows has the mean of their scores, or with ``history`` the score
    of the window that holds most rows before it.
    """
    hop = rows if hop is None else hop
    numbered = number_rows(df.filter(F.col(value).isNotNull()), keys, order, "__row", chunks)
    at = F.col("__row") - 1
    first = F.greatest(F.lit(0), F.floor((at - rows) / hop) + 1).cast("long")
    if hop == rows:
        placed = numbered.withColumn("__block", F.floor(at / rows))
    else:
        sizes = numbered.groupBy(*keys).agg(F.count(F.lit(1)).alias("__size"))
        placed = join_null_safe(numbered, settled(sizes), keys)
        last = F.least(F.floor(at / hop), F.greatest(F.lit(0), F.ceil((F.col("__size") - rows) / hop))).cast("long")
        placed = placed.withColumn("__block", F.explode(F.sequence(first, last))).drop("__size")
    block = [*keys, "__block"]
    windows = (
        placed.repartition(task_count(df), *block).groupBy(*block)
        .agg(F.sort_array(F.collect_list(F.struct("__row", *df.columns))).alias("__rows"))
    )

    @F.pandas_udf("array<double>")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        # Nested, so that it travels to the workers by value: they need not have this package.
        def lengthened(values: np.ndarray) -> np.ndarray:
            """The values and points on the mean slope of the lines from the last rows to the last one."""
            reach = min(estimated, len(values) - 1)
            if not reach:
                return np.concatenate([values, np.repeat(values[-1:], estimated)])
            back = np.arange(1, reach + 1)
            slope = ((values[-1] - values[-1 - back]) / back).mean()
            return np.concatenate([values, np.repeat(values[-reach] + slope * reach, estimated)])

        def score(values: np.ndarray) -> np.ndarray:
            n = len(values)
            spectrum = np.fft.fft(lengthened(values) if estimated else values)
            amplitude = np.abs(spectrum)
            logs = np.log(np.maximum(amplitude, 1e-8))
            residual = logs - np.convolve(np.pad(logs, (1, 1), mode="edge"), np.ones(3) / 3, mode="valid")
            phase = np.where(amplitude > 1e-8, spectrum / np.maximum(amplitude, 1e-8), 0)
            saliency = np.abs(np.fft.ifft(np.exp(residual) * phase))[:n]
            local = pd.Series(saliency).rolling(21, min_periods=1).mean().to_numpy()
            return (saliency - local) / np.maximum(local, 1e-8)

        for batch in batches:
            yield batch.map(lambda values: score(np.asarray(values, dtype="float64")))

    values = F.transform("__rows", lambda row: row[value].cast("double"))
    scored = windows.select("__block", "__rows", scores(values).alias("__scores"))
    pairs = scored.select("__block", F.inline(F.arrays_zip("__rows", "__scores")))
    scored = pairs.select("__block", F.col("__rows")["__row"].alias("__row"),
                          *[F.col("__rows")[c].alias(c) for c in df.columns], F.col("__scores").alias(out))
    if hop < rows and history:
        scored = scored.filter(F.col("__block") == first)
    elif hop < rows:
        names = [f"__c{k}" for k in range(len(df.columns))]
        whole = F.struct(*[F.col(c).alias(n) for c, n in zip(df.columns, names)])
        merged = scored.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__row").agg(
            F.first(whole).alias("__whole"), F.avg(out).alias(out))
        scored = merged.select(*[F.col("__whole")[n].alias(c) for c, n in zip(df.columns, names)], out)
    return _with_unscored(scored.select(*df.columns, out), df, value, out)


def principal_component(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str = "score",
                        lags: int = EMBEDDING, chunks: int | None = None) -> DataFrame:
    """Distance of (x, previous x, ...) from the series' first principal axis.

    Means and covariances are plain aggregates per series; Python sees one small matrix per series to
    find its axis. The first ``lags - 1`` rows of a series have no score.
    """
    axes = [f"__x{i}" for i in range(lags)]
    steps = {a: (lambda w, i=i: F.lag(value, i).over(w) if i else F.col(value)) for i, a in enumerate(axes)}
    embedded = with_neighbours(df, keys, order, lags - 1, 0, steps, chunks)
    full = embedded.dropna(subset=axes)
    pairs = [(a, b) for i, a in enumerate(axes) for b in axes[i:]]
    moments = full.groupBy(*keys).agg(
        F.array(*[F.avg(a) for a in axes]).alias("__mean"),
        F.array(*[F.covar_pop(a, b) for a, b in pairs]).alias("__cov"),
    )

    @F.pandas_udf("array<double>")
    def first_axis(covariances: Iterator[pd.Series]) -> Iterator[pd.Series]:
        upper = np.triu_indices(lags)
        for batch in covariances:
            matrices = np.zeros((len(batch), lags, lags))
            matrices[:, upper[0], upper[1]] = np.stack(batch.to_numpy()) if len(batch) else 0.0
            vectors = np.linalg.eigh(matrices, UPLO="U")[1][:, :, -1]
            yield pd.Series(list(vectors))

    axis = moments.select(*keys, "__mean", first_axis("__cov").alias("__axis"))
    joined = join_null_safe(embedded, settled(axis), keys)
    centred = [F.col(a) - F.col("__mean")[i] for i, a in enumerate(axes)]
    along = sum((c * F.col("__axis")[i] for i, c in enumerate(centred)), F.lit(0.0))
    length = sum((c * c for c in centred), F.lit(0.0))
    distance = F.sqrt(F.greatest(F.lit(0.0), length - along * along))
    complete = F.col(axes[-1]).isNotNull()
    for a in axes[:-1]:
        complete = complete & F.col(a).isNotNull()
    return joined.withColumn(out, F.when(complete, distance)).drop(*axes, "__mean", "__axis")


def flag(scored: DataFrame, keys: Sequence[str], confidence: int, score: str = "score",
         out: str = "is_anomaly", chunks: int | None = None) -> DataFrame:
    """Mark scores above the series' own ``confidence`` percent quantile (1 to 100), found exactly."""
    if not 1 <= confidence <= 100:
        raise ValueError("confidence must lie between 1 and 100")
    bound = value_at_fraction(scored, keys, score, confidence / 100, "__bound", chunks)
    joined = join_null_safe(scored, settled(bound), keys)
    return joined.withColumn(out, F.coalesce(F.col(score) > F.col("__bound"), F.lit(False))).drop("__bound")


def window_means(df: DataFrame, keys: Sequence[str], time: str, value: str | Column, width: str, hop: str,
                 offset: str | None = None) -> DataFrame:
    """Mean per series and time window; ``hop`` shorter than ``width`` lets windows overlap."""
    spans = F.window(time, width, hop, offset) if offset else F.window(time, width, hop)
    means = df.groupBy(*keys, spans.alias("__w")).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("rows"))
    return means.select(*keys, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"),
                        "mean", "rows")


def crossings(means: DataFrame, keys: Sequence[str], bound: float) -> DataFrame:
    """Windows whose mean becomes greater than the bound, each time it does.

    The input holds one row per series and window, so a series has as many rows as the time span has hops.
    """
    previous = F.lag("mean").over(Window.partitionBy(*keys).orderBy("window_start"))
    return (
        means.withColumn("previous_mean", previous)
        .filter((F.col("mean") > bound) & (F.col("previous_mean") <= bound))
    )
