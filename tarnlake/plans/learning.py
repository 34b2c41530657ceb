"""Regression over line items: quantity, discount and tax against the extended price."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators import regression
from tarnlake.plans.registry import query
from tarnlake.sources.readers import table

FEATURES = ["l_quantity", "l_discount", "l_tax"]
LABEL = "l_extendedprice"
KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]

# Least squares by Cramer's rule on the covariances of the training part.
SOLVED_SQL = """
parts AS (SELECT l_quantity AS a, l_discount AS b, l_tax AS c, l_extendedprice AS y,
  left(md5(concat_ws(',', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 8) < '33333333' AS test FROM lineitem),
m AS (SELECT covar_pop(a, a) AS aa, covar_pop(b, b) AS bb, covar_pop(c, c) AS cc, covar_pop(a, b) AS ab,
  covar_pop(a, c) AS ac, covar_pop(b, c) AS bc, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb, covar_pop(c, y) AS cy,
  avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my, stddev_samp(a) AS sa, stddev_samp(b) AS sb,
  stddev_samp(c) AS sc FROM parts WHERE NOT test),
d AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS det FROM m),
s AS (SELECT *, (ay * (bb * cc - bc * bc) - ab * (yb * cc - bc * cy) + ac * (yb * bc - bb * cy)) / det AS wa,
  (aa * (yb * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - yb * ac)) / det AS wb,
  (aa * (bb * cy - yb * bc) - ab * (ab * cy - yb * ac) + ay * (ab * bc - bb * ac)) / det AS wc FROM d),
line AS (SELECT *, my - wa * ma - wb * mb - wc * mc AS w0 FROM s)
"""


def _parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf, "lineitem").select(*KEYS, *FEATURES, LABEL)
    test = regression.in_test_part(*[F.col(k) for k in KEYS])
    return lines.filter(~test), lines.filter(test)


@query(f"""
WITH {SOLVED_SQL}, e AS (SELECT y, y - (w0 + wa * a + wb * b + wc * c) AS err FROM parts, line WHERE test)
SELECT count(*) AS rows, round(sqrt(sum(err * err) / count(*)), 4) AS rmse,
       round(1 - sum(err * err) / (var_pop(y) * count(*)), 6) AS r2 FROM e
""")
def ml_regression_metrics(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _parts(spark, sf)
    scored = regression.predictions(regression.fit(train, FEATURES, LABEL), test, *KEYS, LABEL)
    return regression.scores(scored, LABEL).withColumns({"rmse": F.round("rmse", 4), "r2": F.round("r2", 6)})


@query(f"""
WITH {SOLVED_SQL}
SELECT 'l_quantity' AS term, round(wa * sa, 3) AS scaled, round(wa, 3) AS unscaled FROM line
UNION ALL SELECT 'l_discount', round(wb * sb, 3), round(wb, 3) FROM line
UNION ALL SELECT 'l_tax', round(wc * sc, 3), round(wc, 3) FROM line
UNION ALL SELECT 'intercept', round(w0, 3), round(w0, 3) FROM line
""")
def ml_coefficients(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _parts(spark, sf)
    terms = regression.coefficients(spark, regression.fit(train, FEATURES, LABEL), FEATURES)
    return terms.withColumns({"scaled": F.round("scaled", 3), "unscaled": F.round("unscaled", 3)})


@query(f"""
WITH {SOLVED_SQL}, p AS (SELECT l_partkey, avg(w0 + wa * l_quantity + wb * l_discount + wc * l_tax) AS mean,
  count(*) AS rows FROM lineitem, line
  WHERE left(md5(concat_ws(',', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 8) < '33333333' GROUP BY l_partkey)
SELECT l_partkey, rows, round(mean, 1) AS mean FROM p
""")
def ml_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Mean prediction per part over the test part."""
    train, test = _parts(spark, sf)
    scored = regression.predictions(regression.fit(train, FEATURES, LABEL), test, *KEYS, LABEL)
    return scored.groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg("prediction"), 1).alias("mean"))
