"""Linear regression: assemble, scale, fit, score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.session import MB
from tarnlake.sizing import scanned_bytes, spread_if_small


def regression_pipeline(features: Sequence[str], label: str) -> Pipeline:
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features"),
        LinearRegression(featuresCol="features", labelCol=label),
    ])


def in_test_part(*keys: Column, share: float = 0.2) -> Column:
    """Whether a row belongs to the test part, by a digest of its key.

    Unlike a random split this does not depend on how the rows are partitioned, so a task that is run
    again puts its rows where they were before.
    """
    text = F.concat_ws(",", *[k.cast("string") for k in keys])
    number = F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("bigint")
    return number < F.lit(round(share * 2**32))


def random_parts(df: DataFrame, share: float = 0.8, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test


def fit(train: DataFrame, features: Sequence[str], label: str, keep_bytes: int = 8192 * MB) -> PipelineModel:
    """Fit the pipeline. Scaler and regression each pass over the rows, so that a training part below
    ``keep_bytes`` is persisted meanwhile; beyond it, it is read again."""
    rows = train.select(*features, label)
    if scanned_bytes(rows) > keep_bytes:
        return regression_pipeline(features, label).fit(rows)
    kept = spread_if_small(rows).persist()
    try:
        return regression_pipeline(features, label).fit(kept)
    finally:
        kept.unpersist()


def predictions(model: PipelineModel, test: DataFrame, *keep: str) -> DataFrame:
    return model.transform(test).select(*keep, "prediction")


def coefficients(spark: SparkSession, model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(term, scaled, unscaled): the fitted coefficients and intercept, one row per term.

    ``scaled`` belongs to the scaled features, ``unscaled`` to the features as given.
    """
    scaler, line = model.stages[-2], model.stages[-1]
    terms = [
        (name, float(c), float(c) / float(spread) if spread else 0.0)
        for name, c, spread in zip(features, line.coefficients, scaler.std)
    ]
    terms.append(("intercept", float(line.intercept), float(line.intercept)))
    return spark.createDataFrame(terms, "term string, scaled double, unscaled double")


def evaluate(scored: DataFrame, label: str) -> dict[str, float]:
    """RMSE and R2 by the evaluator."""
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction")
    return {m: evaluator.setMetricName(m).evaluate(scored) for m in ("rmse", "r2")}


def scores(scored: DataFrame, label: str) -> DataFrame:
    """RMSE and R2 in one pass, as a frame."""
    error = F.col(label) - F.col("prediction")
    squares = F.sum(error * error)
    return scored.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sqrt(squares / F.count(F.lit(1))).alias("rmse"),
        (F.lit(1.0) - F.try_divide(squares, F.var_pop(label) * F.count(F.lit(1)))).alias("r2"),
    )
