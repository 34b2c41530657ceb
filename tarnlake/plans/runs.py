"""Job-run analytics. Events stand for runs: the user is the workspace, the event type the state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.scalars import (
    duration_label,
    error_field,
    iso_timestamp,
    json_object,
    minutes_seconds,
    seconds_between,
    time_class,
)
from tarnlake.operators import aggregates, runs
from tarnlake.operators.topk import newest_per_group
from tarnlake.plans.registry import query
from tarnlake.sources.readers import table

# The same expressions serve both engines; only the JSON access and the time arithmetic differ.
STATE = """CASE event_type WHEN 'signup' THEN 'NotStarted' WHEN 'view' THEN 'InProgress' WHEN 'click' THEN 'Cancelled'
           WHEN 'error' THEN 'Failed' ELSE 'Succeeded' END"""
ITEM_TYPE = "CASE WHEN value < 60 THEN 'Notebook' ELSE 'Lakehouse' END"
DETAIL = """CASE WHEN value < 10 THEN NULL
  WHEN value < 40 THEN '{"failureReason":"","errorMessage":"lost worker ' || k || '"}'
  WHEN value < 90 THEN '{"failureReason":"limit ' || k || '","rootActivityId":"act-' || k || '"}' ELSE '{"message":"stopped"}' END"""
ERRORS = """CASE WHEN event_type = 'purchase' THEN NULL WHEN value < 5 THEN ''
  WHEN value < 30 THEN 'plain ' || k
  WHEN value < 70 THEN '{"code":"E' || k || '","errorMessage":"broken"}'
  WHEN value < 90 THEN '{"source":"store"}'
  ELSE '[{"errorCode":"A' || k || '","message":"first","source":"s1"},"second"]' END"""
REFRESH_ERROR = """CASE WHEN value < 20 THEN NULL WHEN value < 50 THEN 'raw ' || k
  WHEN value < 80 THEN '{"errorCode":"C' || k || '"}'
  ELSE '{"errorCode":"C' || k || '","errorDescription":"bad source"}' END"""
TOTAL = "CASE WHEN value < 8 THEN 'about ' || k WHEN value < 30 THEN '' END"
CAPACITY = "CASE WHEN user_id % 30 < 29 THEN CAST(user_id % 30 AS VARCHAR(10)) END"
CANCELLATION = "CASE WHEN value < 15 THEN '' WHEN value < 60 THEN 'by hand ' || k END"
AS_OF = "2024-02-01 00:00:00"
OPEN = "('signup', 'view')"

RUNS_SQL = f"""
k AS (SELECT *, json_extract_string(props, '$.k') AS k FROM events),
runs AS (SELECT event_id AS run_id, CAST(user_id AS VARCHAR) AS workspace_id, event_type || ' job ' || k AS item_name,
  {ITEM_TYPE} AS item_type, {STATE} AS state, ts AS submitted_at, value,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS submitted,
  CASE WHEN event_type NOT IN {OPEN}
       THEN strftime(ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%fZ') END AS ended,
  {DETAIL} AS detail, {ERRORS} AS errors, {REFRESH_ERROR} AS error,
  {TOTAL} AS total_duration, {CAPACITY} AS capacity_id, {CANCELLATION} AS cancellation_reason FROM k)
"""


def job_runs(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").withColumn("k", F.get_json_object("props", "$.k"))
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    ends = F.expr("ts + make_dt_interval(0, 0, 0, CAST(value AS DECIMAL(18,6)))")
    events = events.withColumns({"started": F.date_format("ts", iso), "stopped": F.date_format(ends, iso)})
    return events.selectExpr(
        "event_id AS run_id", "CAST(user_id AS STRING) AS workspace_id", "event_type || ' job ' || k AS item_name",
        f"{ITEM_TYPE} AS item_type", f"{STATE} AS state", "ts AS submitted_at", "value",
        "started AS submitted", f"CASE WHEN event_type NOT IN {OPEN} THEN stopped END AS ended",
        f"{DETAIL} AS detail", f"{ERRORS} AS errors", f"{REFRESH_ERROR} AS error", f"{TOTAL} AS total_duration",
        f"{CAPACITY} AS capacity_id", f"{CANCELLATION} AS cancellation_reason",
        """named_struct('displayName', CASE WHEN value < 50 THEN '' ELSE 'User ' || user_id END,
           'userPrincipalName', CASE WHEN value < 20 THEN NULL ELSE user_id || '@x' END, 'mail', '',
           'name', CAST(NULL AS STRING), 'id', CAST(user_id AS STRING),
           'type', CASE WHEN user_id % 4 = 0 THEN 'Service' ELSE 'User' END) AS submitter""")


@query(f"""
WITH {RUNS_SQL} SELECT coalesce(nullif(state, 'Cancelled'), 'Unknown') AS state, count(*) AS count
FROM runs GROUP BY 1 ORDER BY 1
""")
def run_state_counts(spark: SparkSession, sf: str) -> DataFrame:
    seen = job_runs(spark, sf).select(F.nullif(F.col("state"), F.lit("Cancelled")).alias("state"))
    return aggregates.state_counts(seen, "state")


@query(f"""
WITH {RUNS_SQL}, newest AS (SELECT *, row_number() OVER (PARTITION BY workspace_id ORDER BY submitted DESC, run_id DESC) AS n
  FROM runs WHERE state = 'Failed')
SELECT run_id, workspace_id, item_name, item_type, state, submitted FROM newest
WHERE n <= 50 AND item_type = 'Notebook' ORDER BY submitted DESC
""")
def run_listing(spark: SparkSession, sf: str) -> DataFrame:
    listed = runs.list_runs(job_runs(spark, sf), state="Failed", item_type="Notebook")
    return listed.select("run_id", "workspace_id", "item_name", "item_type", "state", "submitted")


@query(f"""
WITH {RUNS_SQL}, failed AS (SELECT * FROM runs WHERE state = 'Failed' ORDER BY submitted DESC, run_id LIMIT 10)
SELECT run_id, item_name, submitted,
  coalesce(nullif(json_extract_string(detail, '$.failureReason'), ''), nullif(json_extract_string(detail, '$.errorMessage'), ''),
           nullif(json_extract_string(detail, '$.error'), ''), nullif(json_extract_string(detail, '$.message'), '')) AS reason
FROM failed
""")
def failure_listing(spark: SparkSession, sf: str) -> DataFrame:
    found = job_runs(spark, sf)
    listed = runs.list_failures(
        found.select("run_id", "item_name", "state", "submitted"), found.select("run_id", "detail"))
    return listed.select("run_id", "item_name", "submitted", "reason")


@query(f"""
WITH {RUNS_SQL} SELECT run_id, item_name FROM runs
WHERE state = 'Failed' AND (contains(item_name, 'job 1') OR contains(item_name, 'ETL'))
""")
def failure_search(spark: SparkSession, sf: str) -> DataFrame:
    return runs.find_failures(job_runs(spark, sf), ["job 1", "ETL"]).select("run_id", "item_name")


@query(f"WITH {RUNS_SQL} SELECT run_id, item_name FROM runs WHERE state = 'Failed'")
def failure_search_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return runs.find_failures(job_runs(spark, sf), ["Run DAG", "ETL"]).select("run_id", "item_name")


@query("""
WITH last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS n
  FROM events) WHERE n <= 100)
SELECT event_type, count(*) AS total_executions, count(*) FILTER (value < 100) AS successful_executions,
  count(*) FILTER (value < 100) / count(*) * 100 AS success_rate, round(avg(value), 4) AS average_execution_time,
  min(value) AS fastest_execution, max(value) AS slowest_execution FROM last GROUP BY event_type
""")
def run_stats(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "event_type", "ts", "value")
    stats = runs.run_statistics(events, "event_type", "ts", "event_id", "value", F.col("value") < 100)
    return stats.withColumn("average_execution_time", F.round("average_execution_time", 4))


@query(f"""
WITH {RUNS_SQL}, s AS (SELECT run_id, epoch_us(CAST(replace(ended, 'Z', '') AS TIMESTAMP)) - epoch_us(submitted_at) AS us,
  value FROM runs), w AS (SELECT *, (us * 10) // 1000000 AS sec FROM s)
SELECT run_id, CASE WHEN sec IS NULL THEN 'N/A' WHEN sec < 60 THEN sec || 's'
    WHEN sec < 3600 THEN (sec // 60) || 'm ' || (sec % 60) || 's'
    ELSE (sec // 3600) || 'h ' || ((sec % 3600) // 60) || 'm' END AS label,
  (sec // 60) || 'm ' || (sec % 60) || 's' AS minutes,
  CASE WHEN value / 20 < 1 THEN 'fast' WHEN value / 20 < 5 THEN 'normal' ELSE 'slow' END AS time_class FROM w
""")
def duration_labels(spark: SparkSession, sf: str) -> DataFrame:
    seconds = seconds_between(iso_timestamp(F.col("submitted")), iso_timestamp(F.col("ended"))) * 10
    return job_runs(spark, sf).select(
        "run_id", duration_label(seconds).alias("label"), minutes_seconds(seconds).alias("minutes"),
        time_class(F.col("value") / 20).alias("time_class"))


@query(f"""
WITH {RUNS_SQL} SELECT run_id,
  CASE WHEN error LIKE '{{%' THEN coalesce(json_extract_string(error, '$.errorCode'), 'Unknown') END AS code,
  CASE WHEN error LIKE '{{%' THEN coalesce(json_extract_string(error, '$.errorDescription'), 'No description')
       ELSE error END AS description FROM runs
""")
def error_fields(spark: SparkSession, sf: str) -> DataFrame:
    parsed = F.col("parsed")
    return job_runs(spark, sf).withColumn("parsed", json_object(F.col("error"))).select(
        "run_id",
        error_field(parsed, "errorCode", "Unknown").alias("code"),
        F.coalesce(error_field(parsed, "errorDescription", runs.NO_DESCRIPTION), F.col("error")).alias("description"))


@query(f"""
WITH {RUNS_SQL}
SELECT run_id, NULL::VARCHAR AS code, errors AS message, '' AS source FROM runs WHERE errors LIKE 'plain%'
UNION ALL SELECT run_id, coalesce(json_extract_string(errors, '$.code'), 'Unknown'),
  coalesce(json_extract_string(errors, '$.errorMessage'), 'No message'),
  coalesce(json_extract_string(errors, '$.source'), '') FROM runs WHERE errors LIKE '{{%'
UNION ALL SELECT run_id, json_extract_string(errors, '$[0].errorCode'), 'first', 's1' FROM runs WHERE errors LIKE '[%'
UNION ALL SELECT run_id, NULL, 'second', '' FROM runs WHERE errors LIKE '[%'
""")
def error_rows(spark: SparkSession, sf: str) -> DataFrame:
    return runs.run_errors(job_runs(spark, sf).select("run_id", "errors"))


@query(f"""
WITH {RUNS_SQL}, named AS (SELECT runs.*, coalesce(c.c_name, workspace_id, 'N/A') AS workspace_name,
    coalesce(n_name, capacity_id, 'N/A') AS capacity_name, u.c_name AS user_name, u.c_custkey IS NOT NULL AS known FROM runs
  LEFT JOIN (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name FROM customer WHERE c_acctbal > 0) c ON workspace_id = c.id
  LEFT JOIN nation ON CAST(n_nationkey AS VARCHAR) = capacity_id
  LEFT JOIN customer u ON CAST(u.c_custkey AS VARCHAR) = workspace_id AND CAST(workspace_id AS BIGINT) % 4 <> 0 AND u.c_custkey % 3 = 0),
s AS (SELECT *, (CASE WHEN ended IS NOT NULL THEN epoch_us(CAST(replace(ended, 'Z', '') AS TIMESTAMP))
  WHEN state IN ('NotStarted', 'InProgress') THEN epoch_us(TIMESTAMP '{AS_OF}') END - epoch_us(submitted_at)) // 1000000
  AS sec FROM named)
SELECT run_id, workspace_id, workspace_name, capacity_name, state,
  coalesce(nullif(total_duration, ''), (sec // 60) || 'm ' || (sec % 60) || 's') AS duration,
  CASE WHEN known THEN user_name WHEN value >= 50 THEN 'User ' || workspace_id
       WHEN value >= 20 THEN workspace_id || '@x' ELSE workspace_id END AS submitted_by,
  CASE WHEN state = 'Cancelled' THEN nullif(cancellation_reason, '') END AS cancellation_reason,
  CASE WHEN state = 'Failed' THEN CASE WHEN value < 10 THEN NULL WHEN value < 40 THEN json_extract_string(detail, '$.errorMessage')
    WHEN value < 90 THEN json_extract_string(detail, '$.failureReason') ELSE 'stopped' END END AS reason,
  CASE WHEN state = 'Failed' THEN json_extract_string(detail, '$.rootActivityId') END AS root_activity_id FROM s
""")
def run_detail(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer")
    workspaces = customers.filter("c_acctbal > 0").selectExpr("CAST(c_custkey AS STRING) AS id", "c_name AS name")
    capacities = table(spark, sf, "nation").selectExpr("CAST(n_nationkey AS STRING) AS id", "n_name AS name")
    users = customers.filter("c_custkey % 3 = 0").selectExpr(
        "CAST(c_custkey AS STRING) AS id", "c_name AS displayName", "CAST(NULL AS STRING) AS userPrincipalName", "'' AS mail")
    return runs.run_details(job_runs(spark, sf), workspaces, capacities, users, F.lit(AS_OF).cast("timestamp"))


@query(f"""
WITH {RUNS_SQL}, newest AS (SELECT *, CASE WHEN ended IS NOT NULL
  THEN (epoch_us(CAST(replace(ended, 'Z', '') AS TIMESTAMP)) - epoch_us(submitted_at)) // 1000000 END AS sec
  FROM runs ORDER BY submitted DESC, run_id LIMIT 100)
SELECT run_id AS id, state AS status, item_type AS refresh_type,
  left(replace(replace(submitted, 'T', ' '), 'Z', ' UTC'), 22) AS start,
  left(replace(replace(ended, 'T', ' '), 'Z', ' UTC'), 22) AS end,
  CASE WHEN sec IS NULL THEN 'N/A' WHEN sec < 60 THEN sec || 's' ELSE (sec // 60) || 'm ' || (sec % 60) || 's' END AS duration,
  CASE WHEN state = 'Failed' AND error LIKE '{{%' THEN json_extract_string(error, '$.errorCode') END AS error_code,
  CASE WHEN state = 'Failed' THEN CASE WHEN error LIKE '{{%' THEN
    coalesce(json_extract_string(error, '$.errorDescription'), 'No description') ELSE error END END AS error_text
FROM newest
""")
def refresh_history(spark: SparkSession, sf: str) -> DataFrame:
    refreshes = job_runs(spark, sf).selectExpr(
        "run_id AS id", "state AS status", "item_type AS refresh_type", "submitted AS start", "ended AS end", "error")
    return runs.refresh_history(refreshes, 100)


@query("""
SELECT event_id, user_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 3
""")
def last_records(spark: SparkSession, sf: str) -> DataFrame:
    return newest_per_group(table(spark, sf, "events"), "user_id", "ts", "event_id", 3) \
        .select("event_id", "user_id", "value")
