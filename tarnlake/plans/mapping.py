"""Filter trees, cohorts, entities, graphs and roles over the sales tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tarnlake.functions.predicates import tree_condition
from tarnlake.operators import entities
from tarnlake.plans.registry import query
from tarnlake.sources.readers import table

TREE = {"op": "Or", "nodes": [
    {"op": "And", "nodes": [
        {"column": "o_totalprice", "op": "Ge", "value": "200000", "type": "Double"},
        {"column": "o_orderpriority", "op": "Contains", "value": "URGENT"},
        {"column": "o_orderstatus", "op": "NotEq", "value": "P"},
    ]},
    {"op": "And", "nodes": [
        {"column": "o_orderdate", "op": "Lt", "value": "1995-06-01 00:00:00", "type": "DateTime"},
        {"column": "o_totalprice", "op": "Le", "value": "90000", "type": "BigInt"},
        {"column": "o_orderpriority", "op": "NotContains", "value": "LOW"},
        {"column": "o_custkey", "op": "IsNotNull"},
    ]},
]}


@query("""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE (o_totalprice >= 200000 AND contains(o_orderpriority, 'URGENT') AND o_orderstatus <> 'P')
   OR (o_orderdate < TIMESTAMP '1995-06-01' AND o_totalprice <= 90000 AND NOT contains(o_orderpriority, 'LOW')
       AND o_custkey IS NOT NULL)
""")
def filter_tree(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").filter(tree_condition(TREE)).select("o_orderkey", "o_orderstatus", "o_totalprice")


CRITERIA = {"node": "And", "children": [
    {"node": "Leaf", "path": "customer.c_mktsegment", "op": "ContainedIn", "value": ["BUILDING", "MACHINERY"]},
    {"node": "Or", "children": [
        {"node": "UnitAnd", "children": [
            {"node": "Leaf", "path": "orders.o_totalprice", "op": "GreaterThan", "value": "400000", "type": "double"},
            {"node": "Leaf", "path": "orders.o_orderstatus", "op": "Equal", "value": "P"},
        ]},
        {"node": "Leaf", "path": "customer.c_acctbal", "op": "LessThan", "value": "0", "type": "double"},
    ]},
    {"node": "Not", "children": [
        {"node": "Leaf", "path": "orders.o_totalprice", "op": "LessThanOrEqual", "value": "5000", "type": "double"},
    ]},
]}


@query("""
SELECT c_custkey AS entity_id FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND (c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000 AND o_orderstatus = 'P') OR c_acctbal < 0)
  AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice <= 5000)
""")
def cohort(spark: SparkSession, sf: str) -> DataFrame:
    tables = {n: table(spark, sf, n) for n in ("customer", "orders")}
    return entities.cohort(tables, {"customer": "c_custkey", "orders": "o_custkey"}, "customer", CRITERIA)


CUSTOMERS = entities.EntityMapping(
    ["c_custkey", "c_mktsegment"], {"display_name": "c_name", "balance": "c_acctbal", "nation": "c_nationkey",
                                    "number": "c_custkey"},
    {"column": "c_acctbal", "op": "Gt", "value": "1000", "type": "Double"})


@query("""
SELECT CAST(c_custkey AS VARCHAR) || '|' || c_mktsegment AS entity_id, c_name AS display_name, c_acctbal AS balance,
       c_nationkey AS nation, c_custkey AS number FROM customer WHERE c_acctbal > 1000
""")
def entity_map(spark: SparkSession, sf: str) -> DataFrame:
    return entities.map_entities(table(spark, sf, "customer"), CUSTOMERS)


@query("""
SELECT event_id, ts, value, CAST(c_custkey AS VARCHAR) || '|' || c_mktsegment AS entity_id
FROM events JOIN customer ON user_id = c_custkey WHERE c_acctbal > 1000
""")
def entity_series(spark: SparkSession, sf: str) -> DataFrame:
    """Events linked to the customer they belong to."""
    customers = entities.map_entities(table(spark, sf, "customer"), CUSTOMERS)
    events = table(spark, sf, "events").select("event_id", "ts", "value", "user_id")
    return entities.link_series(customers, events, "number", "user_id").drop("user_id")


@query("""
SELECT CAST(c_custkey AS VARCHAR) || '|' || c_mktsegment AS first_id, CAST(n_nationkey AS VARCHAR) AS second_id
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 1000
""")
def relationship_edges(spark: SparkSession, sf: str) -> DataFrame:
    nations = entities.map_entities(
        table(spark, sf, "nation"), entities.EntityMapping(["n_nationkey"], {"key": "n_nationkey", "name": "n_name"}))
    customers = entities.map_entities(table(spark, sf, "customer"), CUSTOMERS)
    return entities.relate(customers, nations, "nation", "key")


def _graph_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf, n) for n in ("customer", "orders", "nation")}


@query("""
SELECT 'customer' AS label, CAST(c_custkey AS VARCHAR) AS node_id,
       CAST(to_json({'name': c_name, 'segment': c_mktsegment}) AS VARCHAR) AS properties FROM customer WHERE c_mktsegment <> 'FURNITURE'
UNION ALL SELECT 'nation', CAST(n_nationkey AS VARCHAR), CAST(to_json({'name': n_name}) AS VARCHAR) FROM nation
UNION ALL SELECT 'order', CAST(o_orderkey AS VARCHAR), '{}' FROM orders
""")
def graph_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return entities.graph_nodes(_graph_tables(spark, sf), [
        entities.NodeTable("customer", "customer", ["c_custkey"], {"name": "c_name", "segment": "c_mktsegment"},
                           {"column": "c_mktsegment", "op": "NotEq", "value": "FURNITURE"}),
        entities.NodeTable("nation", "nation", ["n_nationkey"], {"name": "n_name"}),
        entities.NodeTable("order", "orders", ["o_orderkey"]),
    ])


@query("""
SELECT 'placed' AS label, 'customer' AS source_label, CAST(o_custkey AS VARCHAR) AS source_id, 'order' AS target_label,
       CAST(o_orderkey AS VARCHAR) AS target_id, CAST(to_json({'state': o_orderstatus}) AS VARCHAR) AS properties FROM orders
WHERE o_orderstatus <> 'P'
UNION ALL SELECT 'lives_in', 'customer', CAST(c_custkey AS VARCHAR), 'nation', CAST(c_nationkey AS VARCHAR), '{}' FROM customer
""")
def graph_edges(spark: SparkSession, sf: str) -> DataFrame:
    return entities.graph_edges(_graph_tables(spark, sf), [
        entities.EdgeTable("placed", "orders", "customer", ["o_custkey"], "order", ["o_orderkey"],
                           {"state": "o_orderstatus"}, {"column": "o_orderstatus", "op": "NotEq", "value": "P"}),
        entities.EdgeTable("lives_in", "customer", "customer", ["c_custkey"], "nation", ["c_nationkey"]),
    ])


@query("SELECT c_custkey, c_name FROM customer WHERE c_nationkey < 5 AND c_acctbal > 0")
def role_view(spark: SparkSession, sf: str) -> DataFrame:
    role = entities.Role(["c_custkey", "c_name"], "c_nationkey < 5 AND c_acctbal > 0")
    return entities.role_view(table(spark, sf, "customer"), role)
