"""Catalog listing and profile over all given tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators import catalog
from tarnlake.plans.registry import query
from tarnlake.scratch import fresh_path
from tarnlake.sources import writers
from tarnlake.sources.readers import table

TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def _profile_sql(*names: str, statistics: bool = False, sample: bool = False) -> str:
    """The lines of all columns; a sample is that of the ten rows with the least digests of the first column."""
    lines = []
    for name in names:
        for i, column in enumerate(TABLES[name].split(", "), start=1):
            c, kind = column.split()
            number = kind in ("int", "bigint", "double")
            extra = "" if not statistics else (
                (f", round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev" if number else
                 ", CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev")
                + f", CAST(min({c}) AS VARCHAR) AS min, CAST(max({c}) AS VARCHAR) AS max")
            if sample:
                key = TABLES[name].split()[0]
                extra += (f", (SELECT CAST(to_json(list(CAST({c} AS VARCHAR) ORDER BY md5(CAST({key} AS VARCHAR)))) AS VARCHAR) "
                          f"FROM (SELECT * FROM {name} ORDER BY md5(CAST({key} AS VARCHAR)) LIMIT 10)) AS sample")
            lines.append(
                f"SELECT '{name}' AS table_name, CAST({i} AS BIGINT) AS position, '{c}' AS column_name, "
                f"'{kind}' AS data_type, TRUE AS nullable, count(*) AS rows, count(*) - count({c}) AS null_count, "
                f"round((count(*) - count({c})) * 100.0::DOUBLE / nullif(count(*), 0), 2) AS null_pct{extra} FROM {name}")
    return " UNION ALL ".join(lines)


def all_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf, name) for name in TABLES}


@query(_profile_sql(*TABLES))
def catalog_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Columns of all tables with their row counts and nulls."""
    return catalog.explore(spark, all_tables(spark, sf))


PROFILED = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"]}


@query(_profile_sql(*PROFILED, statistics=True, sample=True))
def table_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of each column, and its values in a sample of ten rows."""
    tables = {n: table(spark, sf, n) for n in PROFILED}
    found = catalog.explore(spark, tables, statistics=True, samples=PROFILED)
    return found.withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


@query(f"""
WITH listed AS ({_profile_sql("orders", "supplier")}),
named AS (SELECT c_custkey, c_name FROM customer WHERE c_acctbal > 0)
SELECT * FROM listed
UNION ALL SELECT 'named_customers', 1, 'c_custkey', 'bigint', TRUE, count(*), 0, 0.0 FROM named
UNION ALL SELECT 'named_customers', 2, 'c_name', 'string', TRUE, count(*), 0, 0.0 FROM named
""")
def catalog_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Tables and a view found in the catalog. A table of another format, a view whose table is gone and the tables
    of other databases are passed over."""
    database, path = f"listed_{uuid.uuid4().hex}", fresh_path(spark, "listed")
    spark.sql(f"CREATE DATABASE {database}")
    for name in ("orders", "supplier", "customer"):
        writers.write_table(table(spark, sf, name), f"{database}.{name}", f"{path}/{name}")
    spark.sql(f"CREATE VIEW {database}.named_customers AS SELECT c_custkey, c_name FROM {database}.customer WHERE c_acctbal > 0")
    spark.sql(f"CREATE TABLE {database}.foreign_format USING csv LOCATION {writers.literal(path + '/csv')} AS "
              f"SELECT s_suppkey FROM {database}.supplier")
    writers.write_table(table(spark, sf, "region"), f"{database}.gone", f"{path}/gone")
    spark.sql(f"CREATE VIEW {database}.broken AS SELECT * FROM {database}.gone")
    spark.sql(f"DROP TABLE {database}.gone")
    found = catalog.catalog_tables(spark, database=database)
    return catalog.explore(spark, {n: df for n, df in found.items() if n != "customer"})


@query(f"""
WITH p AS ({_profile_sql(*TABLES)}),
t AS (SELECT table_name, count(*) AS n, count(*) FILTER (data_type LIKE '%array%') AS complex, max(rows) AS rows
      FROM p GROUP BY table_name)
SELECT count(*) AS total_tables, CAST(sum(n) AS BIGINT) AS total_columns, sum(n) / count(*) AS avg_columns_per_table,
       CAST(sum(complex) AS BIGINT) AS complex_types_count, CAST(sum(rows) AS BIGINT) AS total_rows FROM t
""")
def catalog_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Structure of all tables, and the rows they hold together."""
    tables = all_tables(spark, sf)
    rows = reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("rows")) for df in tables.values()])
    structure = catalog.summary(catalog.list_columns(spark, tables))
    return structure.withColumn("total_rows", rows.agg(F.sum("rows")).scalar())
