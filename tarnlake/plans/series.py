"""Anomaly scores and crossings over events: the event type is the instance, time the order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators import series
from tarnlake.plans.registry import query
from tarnlake.sources.readers import table

KEYS, ORDER, VALUE = ["event_type"], ["ts", "event_id"], "value"
LAST5 = "(PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"
ALL = "(PARTITION BY event_type)"
BY_TIME = "(PARTITION BY event_type ORDER BY ts, event_id)"


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", "event_type", "ts", "value")


def _shown(df: DataFrame) -> DataFrame:
    return df.select("event_id", "event_type", F.round("score", 6).alias("score"))


@query(f"SELECT event_id, event_type, round(pow(value - avg(value) OVER {LAST5}, 2), 6) AS score FROM events")
def anomaly_diff_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.diff_rolling(readings(spark, sf), KEYS, ORDER, VALUE))


@query("SELECT event_id, event_type, round(value, 6) AS score FROM events")
def anomaly_signal(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.signal(readings(spark, sf), VALUE))


@query(f"SELECT event_id, event_type, round(abs(value - median(value) OVER {ALL}), 6) AS score FROM events")
def anomaly_median_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.median_distance(readings(spark, sf), KEYS, VALUE))


@query(f"SELECT event_id, event_type, round(abs(value - median(value) OVER {LAST5}), 6) AS score FROM events")
def anomaly_median_rolling(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.median_distance_rolling(readings(spark, sf), KEYS, ORDER, VALUE))


@query(f"SELECT event_id, event_type, round(abs(value - avg(value) OVER {ALL}), 6) AS score FROM events")
def anomaly_mean_distance(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.mean_distance(readings(spark, sf), KEYS, VALUE))


@query(f"""
WITH d AS (SELECT *, value - 2 * lag(value) OVER {BY_TIME} + lag(value, 2) OVER {BY_TIME} AS bend FROM events)
SELECT event_id, event_type, round(stddev_samp(bend) OVER {LAST5}, 6) AS score FROM d
""")
def anomaly_diff_diff(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.diff_diff_standard(readings(spark, sf), KEYS, ORDER, VALUE))


@query("""
WITH e AS (SELECT *, min(value) OVER (PARTITION BY event_type) AS low, max(value) OVER (PARTITION BY event_type) AS high
  FROM events),
b AS (SELECT *, least(9, floor((value - low) / ((high - low) / 10))) AS bin FROM e),
n AS (SELECT event_type, bin, count(*) AS n FROM b GROUP BY event_type, bin)
SELECT event_id, b.event_type, round(ln(max_n / n.n), 6) AS score FROM b JOIN n ON b.event_type = n.event_type AND b.bin = n.bin
JOIN (SELECT event_type, max(n) AS max_n FROM n GROUP BY event_type) m ON b.event_type = m.event_type
""")
def anomaly_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.histogram_score(readings(spark, sf), KEYS, VALUE))


BY_VALUE = "(PARTITION BY event_type ORDER BY value, event_id)"


@query(f"""
WITH r AS (SELECT event_id, event_type, {", ".join(
    f"greatest(value - lag(value, {i}) OVER {BY_VALUE} + 0 * lead(value, {5 - i}) OVER {BY_VALUE}, "
    f"lead(value, {5 - i}) OVER {BY_VALUE} - value + 0 * lag(value, {i}) OVER {BY_VALUE}) AS r{i}" for i in range(6))}
  FROM events)
SELECT event_id, event_type, round(least(r0, r1, r2, r3, r4, r5), 6) AS score FROM r
""")
def anomaly_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.nearest_neighbours(readings(spark, sf), KEYS, VALUE, "event_id"))


# The Fourier sums of a window and their inverse, each as a join of the window with itself.
@query("""
WITH numbered AS (SELECT event_id, event_type, value AS v,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS r FROM events WHERE value IS NOT NULL),
b AS (SELECT event_id, event_type, v, r // 256 AS w, r % 256 AS n,
  count(*) OVER (PARTITION BY event_type, r // 256) AS size FROM numbered),
spectrum AS (SELECT b.event_type, b.w, b.size, k.n AS k,
  sum(b.v * cos(2 * pi() * ((k.n * b.n) % b.size) / b.size)) AS re,
  -sum(b.v * sin(2 * pi() * ((k.n * b.n) % b.size) / b.size)) AS im
  FROM b JOIN b AS k ON b.event_type = k.event_type AND b.w = k.w GROUP BY b.event_type, b.w, b.size, k.n),
amplitude AS (SELECT *, sqrt(re * re + im * im) AS a, ln(greatest(sqrt(re * re + im * im), 1e-8)) AS l FROM spectrum),
residual AS (SELECT *, exp(l - (coalesce(lag(l) OVER o, l) + l + coalesce(lead(l) OVER o, l)) / 3)
  / CASE WHEN a > 1e-8 THEN a END AS f FROM amplitude WINDOW o AS (PARTITION BY event_type, w ORDER BY k)),
back AS (SELECT b.event_id, b.event_type, b.w, b.n, b.size,
  sum(coalesce(f, 0) * (re * cos(2 * pi() * ((k * b.n) % b.size) / b.size) - im * sin(2 * pi() * ((k * b.n) % b.size) / b.size))) AS re,
  sum(coalesce(f, 0) * (re * sin(2 * pi() * ((k * b.n) % b.size) / b.size) + im * cos(2 * pi() * ((k * b.n) % b.size) / b.size))) AS im
  FROM b JOIN residual AS s ON b.event_type = s.event_type AND b.w = s.w GROUP BY ALL),
saliency AS (SELECT *, sqrt(re * re + im * im) / size AS s FROM back),
local AS (SELECT *, avg(s) OVER (PARTITION BY event_type, w ORDER BY n ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS m
  FROM saliency)
SELECT e.event_id, e.event_type, round((s - m) / greatest(m, 1e-8), 6) AS score
FROM events AS e LEFT JOIN local AS l ON e.event_id = l.event_id
""")
def anomaly_spectral(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.spectral_residual(readings(spark, sf), KEYS, ORDER, VALUE))


def _overlapping_sql(hop: int, points: int, row_score: str) -> str:
    """Windows of 256 rows that begin every ``hop`` rows, each with ``points`` estimated points behind."""
    return f"""
WITH numbered AS (SELECT event_id, event_type, value AS v,
  row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS r,
  count(*) OVER (PARTITION BY event_type) AS series FROM events WHERE value IS NOT NULL),
spread AS (SELECT *, greatest(0, CAST(floor((r - 256) / {hop}) AS BIGINT) + 1) AS first_w,
  least(r // {hop}, greatest(0, CAST(ceil((series - 256) / {hop}) AS BIGINT))) AS last_w FROM numbered),
b AS (SELECT event_id, event_type, v, first_w, w, r - w * {hop} AS n, count(*) OVER (PARTITION BY event_type, w) AS size
  FROM (SELECT *, unnest(generate_series(first_w, last_w)) AS w FROM spread)),
lines AS (SELECT b.event_type, b.w, avg((e.v - b.v) / (e.n - b.n)) AS slope, count(*) AS reach
  FROM b JOIN b AS e ON e.event_type = b.event_type AND e.w = b.w AND e.n = e.size - 1
  WHERE b.n < e.n AND b.n >= e.n - {points} GROUP BY b.event_type, b.w),
past AS (SELECT l.event_type, l.w, b.v + slope * reach AS v FROM lines AS l JOIN b ON b.event_type = l.event_type
  AND b.w = l.w AND b.n = b.size - reach
  UNION ALL SELECT event_type, w, v FROM b WHERE size = 1),
x AS (SELECT event_type, w, n, v, size + {points} AS size FROM b
  UNION ALL SELECT p.event_type, p.w, s.size + i, p.v, s.size + {points} FROM past AS p
  JOIN (SELECT DISTINCT event_type, w, size FROM b) AS s USING (event_type, w), range({points}) AS t(i)),
spectrum AS (SELECT x.event_type, x.w, x.size, k.n AS k,
  sum(x.v * cos(2 * pi() * ((k.n * x.n) % x.size) / x.size)) AS re,
  -sum(x.v * sin(2 * pi() * ((k.n * x.n) % x.size) / x.size)) AS im
  FROM x JOIN x AS k ON x.event_type = k.event_type AND x.w = k.w GROUP BY x.event_type, x.w, x.size, k.n),
amplitude AS (SELECT *, sqrt(re * re + im * im) AS a, ln(greatest(sqrt(re * re + im * im), 1e-8)) AS l FROM spectrum),
residual AS (SELECT *, exp(l - (coalesce(lag(l) OVER o, l) + l + coalesce(lead(l) OVER o, l)) / 3)
  / CASE WHEN a > 1e-8 THEN a END AS f FROM amplitude WINDOW o AS (PARTITION BY event_type, w ORDER BY k)),
back AS (SELECT b.event_id, b.event_type, b.first_w, b.w, b.n, s.size,
  sum(coalesce(f, 0) * (re * cos(2 * pi() * ((k * b.n) % s.size) / s.size) - im * sin(2 * pi() * ((k * b.n) % s.size) / s.size))) AS re,
  sum(coalesce(f, 0) * (re * sin(2 * pi() * ((k * b.n) % s.size) / s.size) + im * cos(2 * pi() * ((k * b.n) % s.size) / s.size))) AS im
  FROM b JOIN residual AS s ON b.event_type = s.event_type AND b.w = s.w
  GROUP BY b.event_id, b.event_type, b.first_w, b.w, b.n, s.size),
saliency AS (SELECT *, sqrt(re * re + im * im) / size AS s FROM back),
local AS (SELECT *, avg(s) OVER (PARTITION BY event_type, w ORDER BY n ROWS BETWEEN 20 PRECEDING AND CURRENT ROW) AS m
  FROM saliency),
scored AS (SELECT event_id, {row_score} AS score FROM local GROUP BY event_id)
SELECT e.event_id, e.event_type, round(score, 6) AS score FROM events AS e LEFT JOIN scored USING (event_id)
"""


RELATIVE = "(s - m) / greatest(m, 1e-8)"


@query(_overlapping_sql(128, 5, f"avg({RELATIVE})"))
def anomaly_spectral_whole(spark: SparkSession, sf: str) -> DataFrame:
    """Half-overlapping windows with estimated points past their ends; a row has the mean of its scores."""
    return _shown(series.spectral_residual(readings(spark, sf), KEYS, ORDER, VALUE, hop=128, estimated=series.ESTIMATED))


@query(_overlapping_sql(64, 5, f"max({RELATIVE}) FILTER (w = first_w)"))
def anomaly_spectral_advanced(spark: SparkSession, sf: str) -> DataFrame:
    """Every row is scored in the window that shows it behind most rows."""
    return _shown(series.spectral_residual(
        readings(spark, sf), KEYS, ORDER, VALUE, hop=64, estimated=series.ESTIMATED, history=True))


# The projection on the first axis is (A - b)(A - c) / (a - b)(a - c) with the eigenvalues a > b > c of the
# covariances A, which have a closed form for three lags.
@query(f"""
WITH x AS (SELECT event_id, event_type, value AS x, lag(value, 1) OVER {BY_TIME} AS y, lag(value, 2) OVER {BY_TIME} AS z
  FROM events),
m AS (SELECT event_type, avg(x) AS mx, avg(y) AS my, avg(z) AS mz, covar_pop(x, x) AS xx, covar_pop(y, y) AS yy,
  covar_pop(z, z) AS zz, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, covar_pop(y, z) AS yz
  FROM x WHERE x + y + z IS NOT NULL GROUP BY event_type),
p AS (SELECT *, (xx + yy + zz) / 3 AS q FROM m),
t AS (SELECT *, sqrt((pow(xx - q, 2) + pow(yy - q, 2) + pow(zz - q, 2) + 2 * (xy * xy + xz * xz + yz * yz)) / 6) AS p FROM p),
u AS (SELECT *, acos(greatest(-1, least(1, ((xx - q) * ((yy - q) * (zz - q) - yz * yz) - xy * (xy * (zz - q) - yz * xz)
  + xz * (xy * yz - (yy - q) * xz)) / (2 * p * p * p)))) / 3 AS angle FROM t),
e AS (SELECT *, q + 2 * p * cos(angle) AS a, q + 2 * p * cos(angle + 2 * pi() / 3) AS c FROM u),
f AS (SELECT *, 3 * q - a - c AS b FROM e),
d AS (SELECT event_id, x.event_type, x - mx AS x, y - my AS y, z - mz AS z, xx, yy, zz, xy, xz, yz, a, b, c
  FROM x LEFT JOIN f USING (event_type)),
g AS (SELECT *, (xx - c) * x + xy * y + xz * z AS gx, xy * x + (yy - c) * y + yz * z AS gy,
  xz * x + yz * y + (zz - c) * z AS gz FROM d),
h AS (SELECT *, (x * ((xx - b) * gx + xy * gy + xz * gz) + y * (xy * gx + (yy - b) * gy + yz * gz)
  + z * (xz * gx + yz * gy + (zz - b) * gz)) / ((a - b) * (a - c)) AS along FROM g)
SELECT event_id, event_type, 
  CASE WHEN along IS NOT NULL THEN round(sqrt(greatest(0, x * x + y * y + z * z - along)), 6) END AS score FROM h
""")
def anomaly_component(spark: SparkSession, sf: str) -> DataFrame:
    return _shown(series.principal_component(readings(spark, sf), KEYS, ORDER, VALUE))


@query(f"""
WITH s AS (SELECT event_id, event_type, abs(value - avg(value) OVER {ALL}) AS raw FROM events),
c AS (SELECT event_type, raw, sum(count(*)) OVER (PARTITION BY event_type ORDER BY raw) AS upto,
  sum(count(*)) OVER (PARTITION BY event_type) AS size FROM s GROUP BY event_type, raw),
b AS (SELECT event_type, min(raw) AS bound FROM c WHERE upto >= ceil(size * 0.99::DOUBLE) GROUP BY event_type)
SELECT event_id, s.event_type, round(raw, 6) AS score FROM s JOIN b ON s.event_type = b.event_type WHERE raw > bound
""")
def anomaly_flags(spark: SparkSession, sf: str) -> DataFrame:
    """Rows above the 99 percent confidence bound of their series."""
    scored = series.mean_distance(readings(spark, sf), KEYS, VALUE)
    return _shown(series.flag(scored, KEYS, 99).filter("is_anomaly"))


@query("""
WITH w AS (SELECT user_id, unnest([0, 1]) AS shift, ts, value FROM events WHERE event_type IN ('click', 'purchase')),
m AS (SELECT user_id, make_timestamp((epoch_us(ts) // 3600000000 - shift) * 3600000000) AS window_start, avg(value) AS mean,
  count(*) AS rows FROM w GROUP BY ALL),
l AS (SELECT *, lag(mean) OVER (PARTITION BY user_id ORDER BY window_start) AS previous_mean FROM m)
SELECT user_id, window_start, window_start + INTERVAL 2 HOUR AS window_end, round(mean, 6) AS mean, rows,
  round(previous_mean, 6) AS previous_mean FROM l WHERE mean > 20 AND previous_mean <= 20
""")
def threshold_crossings(spark: SparkSession, sf: str) -> DataFrame:
    """Two-hour means, hopping by one hour, that become greater than 20, per user."""
    events = table(spark, sf, "events").filter(F.col("event_type").isin("click", "purchase"))
    means = series.window_means(events, ["user_id"], "ts", "value", "2 hours", "1 hour")
    return series.crossings(means, ["user_id"], 20.0).select(
        "user_id", "window_start", "window_end", F.round("mean", 6).alias("mean"), "rows",
        F.round("previous_mean", 6).alias("previous_mean"))
