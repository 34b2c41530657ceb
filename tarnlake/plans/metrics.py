"""Metric requests over the sales star."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators.aggregates import amount
from tarnlake.operators.metrics import Measure, Model, Ratio, Relationship, evaluate
from tarnlake.plans.registry import query
from tarnlake.sources.readers import table

PRICE = "CAST(l_extendedprice AS DECIMAL(12,2))"
CENTS = "CAST(floor(l_extendedprice * 100 + 0.5D) AS DECIMAL(18,0))"
RELATIONSHIPS = [
    Relationship("lineitem", "l_orderkey", "orders", "o_orderkey"),
    Relationship("lineitem", "l_partkey", "part", "p_partkey"),
    Relationship("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    Relationship("orders", "o_custkey", "customer", "c_custkey"),
    Relationship("customer", "c_nationkey", "nation", "n_nationkey"),
    Relationship("nation", "n_regionkey", "region", "r_regionkey"),
]
NET = "CAST(floor(l_extendedprice * 100 + 0.5D) * (100 - floor(l_discount * 100 + 0.5D)) AS DECIMAL(18,0))"
NET_SQL = "(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))))"
MEASURES = {
    "Net": Measure("sum", NET),
    "Quantity": Measure("sum", "CAST(l_quantity AS DECIMAL(18,2))"),
    "Gross": Measure("sum", CENTS),
    "Lines": Measure("count", "1"),
    "Mean Price": Measure("avg", CENTS),
    "Largest": Measure("max", "l_extendedprice"),
    "Returned": Measure("sum", f"CASE WHEN l_returnflag = 'R' THEN {CENTS} END"),
    "Return Share": Ratio("Returned", "Gross"),
    "Parts": Measure("distinct", "l_partkey"),
    "Returning Suppliers": Measure("distinct", "CASE WHEN l_returnflag = 'R' THEN l_suppkey END"),
    "Gross A Part": Ratio("[Gross]", "[Parts]"),
}


def sales_model(spark: SparkSession, sf: str, *dimensions: str) -> Model:
    """The star, or the part of it that holds the named dimensions."""
    links = [r for r in RELATIONSHIPS if not dimensions or r.parent in dimensions]
    names = ["lineitem", *[r.parent for r in links]]
    return Model("lineitem", {n: table(spark, sf, n) for n in names}, links, MEASURES)


GEOGRAPHY = ("orders", "customer", "nation", "region")


@query(f"""
SELECT r_name, CAST(sum({NET_SQL}) AS DOUBLE) AS total_revenue,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity, count(*) AS transaction_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY r_name ORDER BY total_revenue DESC
""")
def revenue_by_region(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship. Small dimensions are broadcast; before each large one the rows are summed per key."""
    model = sales_model(spark, sf, *GEOGRAPHY)
    report = evaluate(model, ["Net", "Quantity", "Lines"], ["region.r_name"])
    return report.filter("r_name IS NOT NULL").select(
        "r_name", amount(F.col("Net"), 10_000).alias("total_revenue"),
        F.col("Quantity").cast("double").alias("total_quantity"), F.col("Lines").alias("transaction_count"),
    ).orderBy(F.desc("total_revenue"))


def _plain(df: DataFrame) -> DataFrame:
    """Snake-case names; amounts as doubles, means rounded for comparison."""
    shown = {"Gross": amount(F.col("Gross")), "Mean Price": F.round(amount(F.col("Mean Price")), 4),
             "Returned": amount(F.col("Returned"))}
    return df.select(*[
        shown.get(c, F.col(f"`{c}`")).alias(c.lower().replace(" ", "_")) for c in df.columns])


@query(f"""
SELECT r_name, p_type, CAST(sum({PRICE}) AS DOUBLE) AS gross, count(*) AS lines,
       round(CAST(sum({PRICE}) AS DOUBLE) / count(*), 4) AS mean_price, max(l_extendedprice) AS largest
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
LEFT JOIN part ON l_partkey = p_partkey
GROUP BY r_name, p_type ORDER BY r_name, p_type
""")
def metric_grouped(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(evaluate(
        sales_model(spark, sf), ["Gross", "Lines", "[Mean Price]", "Largest"], ["'region'[r_name]", "part.p_type"],
        order_by=["r_name", "p_type"]))


@query(f"""
SELECT n_name, l_returnflag, CAST(sum({PRICE}) AS DOUBLE) AS gross, count(*) AS lines
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
WHERE r_name IN ('ASIA', 'EUROPE') AND o_orderstatus = 'F' AND l_linenumber IN (1, 2, 3)
GROUP BY n_name, l_returnflag ORDER BY n_name, l_returnflag
""")
def metric_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(evaluate(
        sales_model(spark, sf, *GEOGRAPHY), ["Gross", "Lines"], ["nation[n_name]", "[l_returnflag]"],
        {"'region'[r_name]": ["ASIA", "EUROPE"], "orders.o_orderstatus": ["F"], "l_linenumber": ["1", "2", "3"]},
        order_by=["n_name", "l_returnflag"]))


@query(f"""
SELECT CAST(sum({PRICE}) AS DOUBLE) AS gross, count(*) AS lines,
       round(CAST(sum({PRICE}) AS DOUBLE) / count(*), 4) AS mean_price
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE p_brand IN ('Brand#2', 'Brand#17')
""")
def metric_total(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(evaluate(
        sales_model(spark, sf), ["Gross", "Lines", "Mean Price"], filters={"part.p_brand": ["Brand#2", "Brand#17"]}))


@query(f"""
SELECT o_orderpriority, l_shipdate, CAST(sum({PRICE}) FILTER (l_returnflag = 'R') AS DOUBLE) AS returned
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderpriority, l_shipdate
HAVING count(*) FILTER (l_returnflag = 'R') > 0
ORDER BY returned DESC, l_shipdate, o_orderpriority LIMIT 250
""")
def metric_without_blanks(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(evaluate(
        sales_model(spark, sf, "orders"), ["Returned"], ["orders.o_orderpriority", "l_shipdate"], max_rows=250,
        order_by=[F.desc("Returned"), "l_shipdate", "o_orderpriority"], presum=True))


@query(f"""
SELECT c_name, CAST(sum({PRICE}) AS DOUBLE) AS gross
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
GROUP BY c_name ORDER BY gross DESC, c_name LIMIT 10
""")
def top_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _plain(evaluate(sales_model(spark, sf, "orders", "customer"), ["Gross"], ["customer.c_name"], max_rows=10,
                           order_by=[F.desc("Gross"), "c_name"], presum=True))


PRESUMS = {"always": True, "never": False, "as needed": None}


@query(f"""
SELECT presum, n_name, o_orderpriority, round(CAST(sum({PRICE}) FILTER (l_returnflag = 'R') AS DOUBLE)
  / nullif(CAST(sum({PRICE}) AS DOUBLE), 0), 9) AS return_share, count(*) AS lines
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey, (VALUES ('always'), ('never'), ('as needed')) AS p(presum)
GROUP BY presum, n_name, o_orderpriority
""")
def metric_ratio(spark: SparkSession, sf: str) -> DataFrame:
    """A ratio of measures, with sums before all joins, before none, and before large ones."""
    def shown(name: str, presum: bool | None) -> DataFrame:
        found = evaluate(sales_model(spark, sf, *GEOGRAPHY), ["[Return Share]", "Lines"],
                         ["nation.n_name", "orders.o_orderpriority"], presum=presum)
        return found.select(F.lit(name).alias("presum"), "n_name", "o_orderpriority",
                            F.round("Return Share", 9).alias("return_share"), F.col("Lines").alias("lines"))

    return reduce(DataFrame.unionByName, [shown(n, p) for n, p in PRESUMS.items()])


@query(f"""
SELECT presum, c_mktsegment, p_size, count(DISTINCT l_partkey) AS parts,
  count(DISTINCT CASE WHEN l_returnflag = 'R' THEN l_suppkey END) AS returning_suppliers,
  round(CAST(sum({PRICE}) AS DOUBLE) / count(DISTINCT l_partkey), 6) AS gross_a_part
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
LEFT JOIN part ON l_partkey = p_partkey, (VALUES ('always'), ('never'), ('as needed')) AS p(presum)
WHERE p_size < 20 GROUP BY presum, c_mktsegment, p_size
""")
def metric_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of different values, alone and within a ratio."""
    sizes = [str(n) for n in range(20)]

    def shown(name: str, presum: bool | None) -> DataFrame:
        found = evaluate(sales_model(spark, sf, "orders", "customer", "part"), ["Parts", "Returning Suppliers", "Gross A Part"],
                         ["customer.c_mktsegment", "part.p_size"], {"part.p_size": sizes}, presum=presum)
        return found.select(
            F.lit(name).alias("presum"), "c_mktsegment", "p_size", F.col("Parts").alias("parts"),
            F.col("Returning Suppliers").alias("returning_suppliers"),
            F.round(F.col("Gross A Part") / 100, 6).alias("gross_a_part"))

    return reduce(DataFrame.unionByName, [shown(n, p) for n, p in PRESUMS.items()])
