"""Writes, loads, upserts and copy jobs over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.plans.registry import query
from tarnlake.scratch import fresh_path
from tarnlake.sources import copyjobs, keyed, readers, upsert, writers
from tarnlake.sources.readers import table

ORDERS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@query("""
SELECT 0::BIGINT AS version, 'overwrite' AS operation, count(*) AS rows_in, count(*) AS rows_out FROM orders
UNION ALL SELECT 1, 'append', count(*), count(*) FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT 2, 'optimise', count(*), count(*) FROM (SELECT * FROM orders UNION ALL
                                                         SELECT * FROM orders WHERE o_orderstatus = 'F')
UNION ALL SELECT 3, 'overwrite', count(*), count(*) FROM (SELECT DISTINCT o_custkey FROM orders)
""")
def write_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Create, append, rewrite in right-sized files, and overwrite with another schema."""
    name, root = _name("audited"), fresh_path(spark, "audited")
    orders = table(spark, sf, "orders")
    writers.write_table(orders, name, root)
    writers.write_table(orders.filter("o_orderstatus = 'F'"), name, root, "append")
    writers.write_table(writers.rebalance(spark.table(name)), name, root, operation="optimise")
    writers.write_table(orders.select("o_custkey").distinct(), name, root)
    spark.sql(f"DROP TABLE {name}")
    return writers.history(spark, root).select("version", "operation", "rows_in", "rows_out")


@query(f"""
SELECT {ORDERS}, TRUE AS verified FROM orders
""")
def verified_write(spark: SparkSession, sf: str) -> DataFrame:
    name, root = _name("verified"), fresh_path(spark, "verified")
    kept, rows = writers.materialise(table(spark, sf, "orders"))
    back, same = writers.verified_write(kept, name, root)
    kept.unpersist()
    back = back.withColumn("verified", F.lit(same and back.count() == rows))
    spark.sql(f"DROP TABLE {name}")
    return back


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT o_orderkey, o_custkey, 'X', o_totalprice + 1, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT -1 - o_orderkey, o_custkey, 'N', o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus = 'F'
""")
def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in state P change, new keys come in, the rest stays."""
    name, root = _name("orders_target"), fresh_path(spark, "orders_target")
    writers.write_table(table(spark, sf, "orders"), name, root)
    upsert.upsert_table(spark, name, _order_changes(spark, sf), ["o_orderkey"], root)
    return _current(spark, name, root)


def _order_changes(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    changed = orders.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("X"), "o_totalprice": F.col("o_totalprice") + 1})
    added = orders.filter("o_orderstatus = 'F'").withColumns(
        {"o_orderkey": -1 - F.col("o_orderkey"), "o_orderstatus": F.lit("N")})
    return changed.unionByName(added)


def _current(spark: SparkSession, name: str, root: str) -> DataFrame:
    """The table's newest files, read by path, so that the catalog entry need not stay."""
    newest = writers.history(spark, root).agg(F.max("version")).first()[0]
    spark.sql(f"DROP TABLE {name}")
    return readers.scan_path(spark, f"{root}/version={newest}")


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')
UNION ALL SELECT o_orderkey, 'X', o_totalprice, o_orderpriority FROM orders
WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'
""")
def upsert_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The table is partitioned by a key column: only the partitions named by the source are rewritten."""
    name, root = _name("by_priority"), fresh_path(spark, "by_priority")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    writers.write_table(orders, name, root, partition_by=["o_orderpriority"])
    changed = orders.filter("o_orderpriority = '1-URGENT' AND o_orderstatus = 'P'") \
        .withColumn("o_orderstatus", F.lit("X"))
    upsert.upsert_table(spark, name, changed, ["o_orderkey", "o_orderpriority"], root)
    return spark.table(name)


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice, nullif(nullif(o_orderpriority, '2-HIGH'), '3-MEDIUM') AS o_orderpriority
FROM orders
UNION ALL SELECT -1 - o_orderkey, 'N', o_totalprice, NULL FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED'
""")
def upsert_blank_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """Null and empty partition values share a folder: the rows there stay when rows with either come in."""
    name, root = _name("blank_priority"), fresh_path(spark, "blank_priority")
    blank = F.expr("nullif(nullif(o_orderpriority, '2-HIGH'), '3-MEDIUM')")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", blank.alias("o_orderpriority"))
    writers.write_table(orders, name, root, partition_by=["o_orderpriority"])
    added = orders.filter("o_orderpriority = '4-NOT SPECIFIED'").withColumns({
        "o_orderkey": -1 - F.col("o_orderkey"), "o_orderstatus": F.lit("N"),
        "o_orderpriority": F.when(F.col("o_orderkey") % 2 == 0, "")})
    upsert.upsert_table(spark, name, added, ["o_orderkey", "o_orderpriority"], root)
    return spark.table(name)


KEY_CELLS = 64


def _recent_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The newest 1 % of the keys change, and new ones follow them."""
    orders = table(spark, sf, "orders")
    newest = orders.agg(F.max("o_orderkey")).first()[0]
    recent = orders.filter(F.col("o_orderkey") > newest - newest // 100).withColumn("o_orderstatus", F.lit("X"))
    return recent.unionByName(recent.withColumns({
        "o_orderkey": F.col("o_orderkey") + newest + 1, "o_orderstatus": F.lit("N")}))


RECENT = "o_orderkey > (SELECT max(o_orderkey) - max(o_orderkey) // 100 FROM orders)"


@query(f"""
SELECT o_orderkey, o_custkey, CASE WHEN {RECENT} THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice,
       o_orderdate, o_orderpriority FROM orders
UNION ALL SELECT o_orderkey + (SELECT max(o_orderkey) + 1 FROM orders), o_custkey, 'N', o_totalprice, o_orderdate,
       o_orderpriority FROM orders WHERE {RECENT}
""")
def upsert_key_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """The table is cut into ranges of its key: only those that hold a key of the source are written anew."""
    name, root = _name("keyed_orders"), fresh_path(spark, "keyed_orders")
    keyed.create_table(table(spark, sf, "orders"), name, root, ["o_orderkey"], KEY_CELLS)
    keyed.upsert(spark, name, _recent_changes(spark, sf), ["o_orderkey"], root)
    return keyed.rows(spark, name).select(*table(spark, sf, "orders").columns)


@query(f"""
SELECT {KEY_CELLS}::BIGINT AS files_held, TRUE AS most_files_stayed, count(*) AS rows_in FROM (
  SELECT * FROM orders WHERE {RECENT} UNION ALL SELECT * FROM orders WHERE {RECENT})
""")
def upsert_key_ranges_report(spark: SparkSession, sf: str) -> DataFrame:
    """Of the ranges held before the upsert, a few were written anew."""
    name, root = _name("keyed_orders"), fresh_path(spark, "keyed_orders")
    keyed.create_table(table(spark, sf, "orders"), name, root, ["o_orderkey"], KEY_CELLS)
    done = keyed.upsert(spark, name, _recent_changes(spark, sf), ["o_orderkey"], root)
    few = 0 < done.rewritten <= max(2, done.held // 20) and done.added >= 1
    return writers.history(spark, root).filter("operation = 'merge'").select(
        F.lit(done.held).cast("long").alias("files_held"), F.lit(few).alias("most_files_stayed"), "rows_in")


@query(f"""
SELECT {ORDERS}, CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month
FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) IN (2, 3)
""")
def partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Written by (year, month); the read opens two folders only."""
    path = fresh_path(spark, "by_month")
    dated = table(spark, sf, "orders").withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    writers.write_files(dated, path, partition_by=["year", "month"])
    back = readers.scan_path(spark, path).filter("year = 1997 AND month IN (2, 3)")
    return back.withColumns({c: F.col(c).cast("bigint") for c in ("year", "month")})


@query(f"SELECT {ORDERS} FROM orders")
def load_csv(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    path = f"{fresh_path(spark, 'loads')}/Orders.CSV"
    writers.write_files(orders, path, fmt="csv", header="true")
    return readers.load_file(spark, f"{path}?version=1", schema=orders.schema)


@query(f"SELECT {ORDERS} FROM orders WHERE o_orderstatus IN ('F', 'O')")
def load_folder(spark: SparkSession, sf: str) -> DataFrame:
    """CSV files in nested folders, chosen by name, loaded into a table."""
    orders, path = table(spark, sf, "orders"), fresh_path(spark, "folder")
    for state, folder in (("F", "a/closed"), ("O", "b")):
        writers.write_files(orders.filter(F.col("o_orderstatus") == state), f"{path}/{folder}", fmt="csv",
                            header="true", sep=";")
    writers.write_files(orders.filter("o_orderstatus = 'P'"), f"{path}/c", fmt="json")
    found = readers.select_files(
        spark, path, "csv", orders.schema, name_glob="*.csv", recursive=True,
        modified_after="2020-01-01T00:00:00", header="true", sep=";")
    name, root = _name("loaded"), fresh_path(spark, "loaded")
    writers.write_table(found, name, root)
    return _current(spark, name, root)


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate FROM lineitem
""")
def compact_sorted(spark: SparkSession, sf: str) -> DataFrame:
    """Many small files rewritten as few, ordered by two columns; the old version is then removed."""
    name, root = _name("compacted"), fresh_path(spark, "compacted")
    writers.write_table(writers.spread(table(spark, sf, "lineitem")), name, root)
    writers.write_table(writers.compact(spark.table(name), ["l_shipdate", "l_partkey"]), name, root, operation="optimise")
    writers.expire_versions(spark, root, keep_seconds=0)
    return _current(spark, name, root)


@query("""
SELECT o_orderkey AS id, CAST(o_totalprice AS DECIMAL(12,2))::DOUBLE AS amount, CAST(o_orderdate AS DATE) AS day,
       o_orderstatus AS state FROM orders
""")
def mapped_copy(spark: SparkSession, sf: str) -> DataFrame:
    mapping = [
        copyjobs.ColumnMap("o_orderkey", "id", "bigint"),
        copyjobs.ColumnMap("o_totalprice", "amount", "decimal(12,2)"),
        copyjobs.ColumnMap("o_orderdate", "day", "date"),
        copyjobs.ColumnMap("o_orderstatus", "state"),
    ]
    path = fresh_path(spark, "mapped")
    copyjobs.copy_rows(table(spark, sf, "orders"), path, mapping, partition_by=["state"])
    return readers.scan_path(spark, path).withColumn("amount", F.col("amount").cast("double"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def incremental_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs: the first half of the month, the rest, and one that finds nothing new."""
    events, root = table(spark, sf, "events"), fresh_path(spark, "incremental")
    copyjobs.incremental_copy(events.filter("ts < TIMESTAMP_NTZ '2024-01-15 00:00:00'"), "ts", root)
    copyjobs.incremental_copy(events, "ts", root)
    copyjobs.incremental_copy(events, "ts", root)
    return copyjobs.copied_rows(spark, root)


@query("""
SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN date_trunc('hour', ts) END AS changed, event_type FROM events
""")
def incremental_copy_late(spark: SparkSession, sf: str) -> DataFrame:
    """Rows come late: with the change value of the mark, within the overlap before it, and without one. Every run
    finds what the runs before did not copy, and nothing twice."""
    root = fresh_path(spark, "incremental")
    events = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 10 != 0, F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("changed"),
        "event_type")
    half = events.filter("changed IS NULL OR changed <= TIMESTAMP_NTZ '2024-01-15 00:00:00'")
    late = "event_id % 7 = 0 AND (changed IS NULL OR changed >= TIMESTAMP_NTZ '2024-01-14 12:00:00')"
    for rows, keys in ((half.filter(f"NOT ({late})"), ["event_id"]), (half, ["event_id"]), (events, []), (events, ["event_id"])):
        copyjobs.incremental_copy(rows, "changed", root, keys, F.expr("INTERVAL 12 HOURS"))
    return copyjobs.copied_rows(spark, root)


@query("""
SELECT c_custkey, c_name, c_acctbal + 10 AS c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def copy_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Copy job with an upsert on two key columns."""
    name, root = _name("customers"), fresh_path(spark, "customers")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    writers.write_table(customers, name, root)
    changed = customers.filter("c_mktsegment = 'BUILDING'").withColumn("c_acctbal", F.col("c_acctbal") + 10)
    upsert.upsert_table(spark, name, changed, ["c_custkey", "c_name"], root)
    return _current(spark, name, root)


@query("""
WITH t AS (SELECT event_id, CASE WHEN event_type = 'error' THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS k,
  CASE WHEN value < 5 THEN 'low' ELSE CAST(user_id AS VARCHAR) END AS who FROM events)
SELECT event_id, k, who, TRY_CAST(k AS BIGINT) IS NOT NULL AND TRY_CAST(who AS BIGINT) IS NOT NULL AS accepted FROM t
""")
def bad_row_split(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that do not fit the types go to a table of their own; both tables together."""
    rows = table(spark, sf, "events").selectExpr(
        "event_id", "CASE WHEN event_type = 'error' THEN 'n/a' ELSE get_json_object(props, '$.k') END AS k",
        "CASE WHEN value < 5 THEN 'low' ELSE CAST(user_id AS STRING) END AS who")
    good, bad = copyjobs.split_incompatible(rows, {"k": "bigint", "who": "bigint"})
    path = fresh_path(spark, "rejected")
    writers.write_files(good, f"{path}/good")
    writers.write_files(bad, f"{path}/bad")
    texts = {c: F.col(c).cast("string") for c in ("k", "who")}
    return readers.scan_path(spark, f"{path}/good").withColumns(texts).withColumn("accepted", F.lit(True)).unionByName(
        readers.scan_path(spark, f"{path}/bad").withColumn("accepted", F.lit(False)))
