"""Projections, joins, aggregates, windows and sorts over the sales tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.functions.predicates import dict_filter
from tarnlake.functions.scalars import display_number, first_non_empty, preview_text
from tarnlake.operators import aggregates, joins, ordered, quality, sets, topk, transform
from tarnlake.plans.registry import query
from tarnlake.sources.readers import inline_rows as rows_of
from tarnlake.sources.readers import run_sql, table


REVENUE_UNIT = 10_000


def revenue() -> Column:
    """Price times (1 - discount), in ten-thousandths: cents times hundredths."""
    net = aggregates.whole_cents("l_extendedprice") * (100 - aggregates.whole_cents("l_discount"))
    return net.cast("decimal(18,0)")


REVENUE_SQL = "(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))"


@query(f"""
SELECT p_type, CAST(sum({REVENUE_SQL}) AS DOUBLE) AS total_revenue,
       round(CAST(sum({REVENUE_SQL}) AS DOUBLE) / count(*), 4) AS avg_revenue
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type ORDER BY total_revenue DESC
""")
def revenue_by_part_type(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("p_partkey")).agg(
        F.sum(revenue()).alias("revenue"), F.count(F.lit(1)).alias("n"))
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    report = aggregates.revenue_average(
        joins.join_small(lines, parts, "p_partkey"), "p_type", F.col("revenue"), F.col("n"), REVENUE_UNIT)
    return report.withColumn("avg_revenue", F.round("avg_revenue", 4))


@query("""
SELECT o_orderstatus, count(*) AS count, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_amount,
       round(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(o_totalprice), 4) AS avg_amount,
       max(o_orderdate) AS max_date
FROM orders GROUP BY o_orderstatus ORDER BY total_amount DESC
""")
def agg_report(spark: SparkSession, sf: str) -> DataFrame:
    report = aggregates.amount_report(table(spark, sf, "orders"), ["o_orderstatus"], "o_totalprice", "o_orderdate")
    return report.withColumn("avg_amount", F.round("avg_amount", 4))


@query("""
SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, l_quantity * l_extendedprice AS revenue,
       CAST(year(l_shipdate) AS BIGINT) AS year, CAST(month(l_shipdate) AS BIGINT) AS month
FROM lineitem
""")
def etl_transform(spark: SparkSession, sf: str) -> DataFrame:
    raw = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
        "l_quantity", "l_extendedprice")
    out = transform.sales_etl(raw, "date", "l_quantity", "l_extendedprice")
    return out.select("l_orderkey", "l_linenumber", "date", "revenue",
                      F.col("year").cast("bigint").alias("year"), F.col("month").cast("bigint").alias("month"))


@query("""
SELECT o_orderkey, o_custkey, price, TIMESTAMP '2024-01-01 00:00:00' AS processed_date
FROM (SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'P') AS status, o_totalprice AS price FROM orders)
WHERE status IS NOT NULL AND price > 150000
""")
def transform_filter(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        F.col("o_totalprice").alias("price"))
    return transform.transform(
        transform.non_null(orders, "status"), ["o_orderkey", "o_custkey", "price"], "price > 150000",
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))


@query("""
SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name, c_acctbal
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def inner_join_keep_keys(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    return joins.join_keeping_keys(orders, customers, "o_custkey", "c_custkey")


@query("""
SELECT c_custkey, key, coalesce(n_name, CAST(key AS VARCHAR), 'N/A') AS nation_name
FROM (SELECT c_custkey, nullif(c_nationkey + 5, 8) AS key FROM customer) LEFT JOIN nation ON key = n_nationkey
""")
def lookup_enrich(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", F.expr("nullif(c_nationkey + 5, 8)").alias("key"))
    return joins.with_names(customers, {"key": "nation_name"}, table(spark, sf, "nation"), "n_nationkey", "n_name")


@query("""
SELECT c_mktsegment, o_orderpriority, count(*) AS orders_placed, max(o_totalprice) AS largest
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderpriority
""")
def sql_passthrough(spark: SparkSession, sf: str) -> DataFrame:
    return run_sql(
        spark,
        """SELECT c_mktsegment, o_orderpriority, count(*) AS orders_placed, max(o_totalprice) AS largest
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderpriority""",
        orders=table(spark, sf, "orders"), customer=table(spark, sf, "customer"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def preview_10(spark: SparkSession, sf: str) -> DataFrame:
    rows = run_sql(spark, "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders}", orders=table(spark, sf, "orders"))
    return topk.preview(rows, F.desc("o_totalprice"), "o_orderkey")


@query("""
SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total
FROM orders GROUP BY o_custkey ORDER BY total DESC, o_custkey LIMIT 10
""")
def top10_customers(spark: SparkSession, sf: str) -> DataFrame:
    totals = table(spark, sf, "orders").groupBy("o_custkey").agg(
        aggregates.amount(F.sum(aggregates.cents("o_totalprice"))).alias("total"))
    return topk.top_by(totals, "total", "o_custkey")


@query("""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2)))
       OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS DOUBLE) AS running_total
FROM orders
""")
def running_total(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", aggregates.cents("o_totalprice").alias("cents"))
    totals = ordered.running_total(orders, ["o_custkey"], "o_orderdate", "cents", "running_total")
    return totals.withColumn("running_total", aggregates.amount(F.col("running_total"))).drop("cents")


@query("""
SELECT event_id, user_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS row_number FROM events
""")
def row_number(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return ordered.number_rows(events, ["user_id"], ["ts", "event_id"], "row_number")


@query("""
SELECT o_orderkey, o_orderpriority, o_totalprice,
       rank() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS rank
FROM orders
""")
def rank_revenue(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordered.rank_rows(orders, ["o_orderpriority"], ordered.Order("o_totalprice", True), "rank")


# The same operators with the cuts that a large table gets, over columns with nulls.
CHUNKS = 8


@query("""
SELECT o_orderkey, sum(CAST(nullif(o_totalprice, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END) AS DECIMAL(18,2)))
       OVER (PARTITION BY o_orderstatus ORDER BY o_orderdate)::DOUBLE AS running_total
FROM orders
""")
def running_total_chunked(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderdate",
        "CAST(CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS DECIMAL(18,2)) AS price")
    totals = ordered.running_total(orders, ["o_orderstatus"], "o_orderdate", "price", "running_total", CHUNKS)
    return totals.select("o_orderkey", F.col("running_total").cast("double").alias("running_total"))


@query("""
SELECT c_custkey, row_number() OVER (PARTITION BY nullif(c_nationkey, 3) ORDER BY c_name, c_custkey) AS row_number
FROM customer
""")
def row_number_chunked(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").selectExpr("c_custkey", "c_name", "nullif(c_nationkey, 3) AS nation")
    # So many chunks that each nation is larger than one.
    return ordered.number_rows(customers, ["nation"], ["c_name", "c_custkey"], "row_number", 8 * CHUNKS).select(
        "c_custkey", "row_number")


@query("""
SELECT event_id, CASE WHEN user_id % 3 <> 0 THEN user_id END AS party, row_number() OVER (
       PARTITION BY CASE WHEN user_id % 3 <> 0 THEN user_id END ORDER BY event_type, value DESC, event_id) AS row_number
FROM events
""")
def row_number_hot_group(spark: SparkSession, sf: str) -> DataFrame:
    """A third of all rows in one group: it is cut along a text, a number and the key; the others are not."""
    events = table(spark, sf, "events").selectExpr(
        "event_id", "CASE WHEN user_id % 3 <> 0 THEN user_id END AS party", "event_type", "value")
    by = ["event_type", ordered.Order("value", True), "event_id"]
    return ordered.number_rows(events, ["party"], by, "row_number", CHUNKS).select("event_id", "party", "row_number")


@query("""
SELECT o_orderkey, rank() OVER (PARTITION BY o_orderpriority
       ORDER BY CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END DESC NULLS LAST) AS rank
FROM orders
""")
def rank_chunked(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_orderpriority", "CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END AS price")
    return ordered.rank_rows(orders, ["o_orderpriority"], ordered.Order("price", True), "rank", CHUNKS).select(
        "o_orderkey", "rank")


@query("""
SELECT nullif(l_returnflag, 'R') AS flag, round(CAST(median(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE), 4) AS median
FROM lineitem WHERE l_linenumber <> 4 GROUP BY 1
""")
def median_chunked(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").selectExpr(
        "nullif(l_returnflag, 'R') AS flag",
        "CAST(CASE WHEN l_linenumber <> 4 THEN l_extendedprice END AS DECIMAL(18,2)) AS price")
    return ordered.median_per_group(lines, ["flag"], "price", "median", CHUNKS).withColumn(
        "median", F.round("median", 4))


@query("""
SELECT event_id, user_id, ts, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 50
""")
def latest_n_per_group(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type")
    return topk.newest_per_group(events, "user_id", "ts", "event_id", 50)


@query("""
SELECT p_partkey, p_name, p_retailprice FROM part ORDER BY p_partkey LIMIT 1000
""")
def capped_read(spark: SparkSession, sf: str) -> DataFrame:
    """The cap is the feature: the first rows by key."""
    columns = ["p_partkey", "p_name", "p_retailprice"]
    return topk.read_columns(table(spark, sf, "part"), columns, rows=1000, order=["p_partkey"])


@query("""
SELECT event_id, user_id, submitted FROM (
  SELECT event_id, user_id, CASE WHEN event_type <> 'signup' THEN ts END AS submitted FROM events)
ORDER BY submitted DESC NULLS LAST, event_id
""")
def newest_first(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id", "user_id", F.expr("CASE WHEN event_type <> 'signup' THEN ts END").alias("submitted"))
    return topk.newest_first(events, "submitted", "event_id")


PART_COLUMNS = {"p_partkey": True, "p_name": False, "p_brand": False, "p_type": False, "p_size": True,
                "p_retailprice": True}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, "
    + (f"round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev, " if number else
       "CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, ")
    + f"CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max FROM part"
    for c, number in PART_COLUMNS.items()))
def column_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = quality.column_statistics(table(spark, sf, "part"))
    return stats.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query("""
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang, source, n_chars)
""")
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_rows(table(spark, sf, "documents").drop("doc_id"), digest=True)


@query("""
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return quality.duplicate_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


BLANKED = {"event_type": "nullif(event_type, 'view')", "value": "CASE WHEN value < 20 THEN NULL ELSE value END",
           "user_id": "user_id"}


@query(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({e}) AS null_count, "
    f"round((count(*) - count({e})) * 100.0::DOUBLE / count(*), 2) AS null_pct FROM events"
    for c, e in BLANKED.items()))
def null_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.null_report(table(spark, sf, "events").selectExpr(*[f"{e} AS {c}" for c, e in BLANKED.items()]))


@query("""
WITH t AS (SELECT json_extract_string(props, '$.k') AS k,
                  CASE WHEN value < 100 THEN CAST(CAST(ts AS DATE) AS VARCHAR) ELSE event_type END AS day,
                  nullif(event_type, 'view') AS kind FROM events)
SELECT 'k' AS column_name, 'bigint' AS expected_type, count(k) AS checked,
       count(k) - count(TRY_CAST(k AS BIGINT)) AS invalid FROM t
UNION ALL SELECT 'day', 'date', count(day), count(day) - count(TRY_CAST(day AS DATE)) FROM t
UNION ALL SELECT 'kind', 'double', count(kind), count(kind) - count(TRY_CAST(kind AS DOUBLE)) FROM t
""")
def type_validation(spark: SparkSession, sf: str) -> DataFrame:
    texts = table(spark, sf, "events").selectExpr(
        "get_json_object(props, '$.k') AS k",
        "CASE WHEN value < 100 THEN CAST(CAST(ts AS DATE) AS STRING) ELSE event_type END AS day",
        "nullif(event_type, 'view') AS kind")
    return quality.type_validation(texts, {"k": "bigint", "day": "date", "kind": "double"})


@query("SELECT count(*) AS records, CAST(6 AS BIGINT) AS columns FROM events")
def table_size(spark: SparkSession, sf: str) -> DataFrame:
    return quality.size_of(table(spark, sf, "events")).withColumn("columns", F.col("columns").cast("bigint"))


@query("SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    return sets.distinct_rows(table(spark, sf, "events"), "user_id", "event_type")


def _parties(spark: SparkSession, sf: str) -> sets.Gathered:
    def customers():
        return table(spark, sf, "customer").selectExpr("c_custkey AS id", "c_name AS name", "c_mktsegment AS segment")

    def suppliers():
        return table(spark, sf, "supplier").selectExpr("s_suppkey AS id", "s_name AS name", "s_acctbal AS balance")

    def absent():
        return table(spark, sf, "no_such_table")

    def unreadable():
        return customers().withColumn("id", F.col("name").cast("bigint"))

    return sets.gather(spark, {"customers": customers, "suppliers": suppliers, "partners": absent, "branches": unreadable},
                       fetch=True)


@query("""
SELECT 'customers' AS source, c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS DOUBLE) AS balance
FROM customer
UNION ALL SELECT 'suppliers', s_suppkey, s_name, NULL, s_acctbal FROM supplier
""")
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    return _parties(spark, sf).rows


@query("""
SELECT 'customers' AS source, count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM customer
UNION ALL SELECT 'suppliers', count(*), NULL FROM supplier
UNION ALL SELECT 'partners', 0, 'AnalysisException'
UNION ALL SELECT 'branches', 0, 'NumberFormatException'
""")
def source_report(spark: SparkSession, sf: str) -> DataFrame:
    return sets.source_report(_parties(spark, sf))


@query("""
SELECT s.label, count(*) AS customers, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer JOIN (VALUES ('BUILDING', 'works', 1), ('MACHINERY', 'works', 2), ('HOUSEHOLD', 'home', 3),
  ('FURNITURE', 'home', 4)) AS s(segment, label, id) ON c_mktsegment = s.segment GROUP BY s.label
""")
def inline_rows(spark: SparkSession, sf: str) -> DataFrame:
    labels = rows_of(
        spark,
        [(1, "BUILDING", "works"), (2, "MACHINERY", "works"), (3, "HOUSEHOLD", "home"), (4, "FURNITURE", "home")],
        {"id": "int", "c_mktsegment": "string", "label": "string"})
    return joins.join_small(table(spark, sf, "customer"), labels, "c_mktsegment").groupBy("label").agg(
        F.count(F.lit(1)).alias("customers"), aggregates.amount(F.sum(aggregates.cents("c_acctbal"))).alias("balance"))


@query("""
SELECT ts AS timestamp, 'user_' || CAST(event_id % 100 AS VARCHAR) AS user_id,
       CASE WHEN event_id % 3 = 0 THEN 'purchase' WHEN event_id % 3 = 1 THEN 'view' ELSE 'click' END AS event_type,
       CAST(event_id % 1000 AS DOUBLE) AS event_value
FROM events
""")
def case_event_type(spark: SparkSession, sf: str) -> DataFrame:
    return transform.derive_events(table(spark, sf, "events"), "ts", "event_id")


@query("SELECT doc_id, left(text, 200) AS preview FROM documents")
def prefix_200(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", preview_text(F.col("text")).alias("preview"))


@query("""
WITH names AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part
               UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR), c_name FROM customer),
requests AS (SELECT upper(p_name) AS wanted FROM part GROUP BY p_name UNION ALL SELECT upper(c_name) FROM customer
             UNION ALL SELECT n_name FROM nation UNION ALL SELECT 'c' || CAST(c_custkey AS VARCHAR) FROM customer),
hits AS (SELECT lower(name) AS low, count(*) AS n, min(id) AS id FROM names GROUP BY lower(name))
SELECT wanted,
  CASE WHEN k.id IS NOT NULL THEN wanted WHEN h.n = 1 THEN h.id END AS id,
  CASE WHEN k.id IS NOT NULL OR h.n = 1 THEN 'ok' WHEN h.n IS NULL THEN 'missing' ELSE 'ambiguous' END AS status
FROM requests LEFT JOIN hits h ON lower(wanted) = h.low LEFT JOIN (SELECT DISTINCT id FROM names) k ON wanted = k.id
""")
def unique_lookup(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").selectExpr("concat('c', c_custkey) AS id", "c_name AS name")
    parts = table(spark, sf, "part").selectExpr("CAST(p_partkey AS STRING) AS id", "p_name AS name")
    requests = (
        parts.select(F.upper("name").alias("wanted")).distinct()
        .unionByName(customers.select(F.upper("name").alias("wanted")))
        .unionByName(table(spark, sf, "nation").select(F.col("n_name").alias("wanted")))
        .unionByName(customers.select(F.col("id").alias("wanted")))
    )
    return joins.unique_lookup(requests, "wanted", parts.unionByName(customers), "id", "name")


@query("""
SELECT event_id, coalesce(nullif(a, ''), nullif(b, ''), nullif(c, '')) AS shown FROM (
  SELECT event_id, CASE WHEN value < 10 THEN '' WHEN value < 50 THEN event_type END AS a,
         CASE WHEN value > 80 THEN props ELSE '' END AS b, CASE WHEN user_id > 20 THEN 'user' END AS c FROM events)
""", name="first_non_empty")
def first_non_empty_field(spark: SparkSession, sf: str) -> DataFrame:
    fields = table(spark, sf, "events").selectExpr(
        "event_id", "CASE WHEN value < 10 THEN '' WHEN value < 50 THEN event_type END AS a",
        "CASE WHEN value > 80 THEN props ELSE '' END AS b", "CASE WHEN user_id > 20 THEN 'user' END AS c")
    return fields.select("event_id", first_non_empty(F.col("a"), F.col("b"), F.col("c")).alias("shown"))


@query("""
SELECT l_orderkey, l_linenumber, l_returnflag, l_extendedprice FROM lineitem
WHERE l_returnflag IN ('R', 'A') AND l_quantity = 7
""", name="dict_filter")
def dict_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return dict_filter(table(spark, sf, "lineitem"), {"l_returnflag": ["R", "A"], "l_quantity": ["7"]}).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")


@query("""
SELECT o_orderkey, CASE WHEN shown = floor(shown) THEN format('{:,}', CAST(shown AS BIGINT))
       ELSE format('{:,.2f}', shown) END AS shown
FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS shown FROM orders)
""")
def number_display(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", display_number(F.expr(
        "CASE WHEN o_orderstatus = 'F' THEN CAST(floor(o_totalprice) AS DOUBLE) ELSE o_totalprice END")).alias("shown"))
