"""Entity, graph, cohort and role mappings over tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.predicates import any_of, tree_condition

# Fixed names of cohort operators.
COHORT_LEAVES = {
    "Equal": lambda c, vs: c == vs[0],
    "GreaterThan": lambda c, vs: c > vs[0],
    "GreaterThanOrEqual": lambda c, vs: c >= vs[0],
    "LessThan": lambda c, vs: c < vs[0],
    "LessThanOrEqual": lambda c, vs: c <= vs[0],
    "ContainedIn": lambda c, vs: c.isin(vs),
}


def entity_key(*columns: str) -> Column:
    """Id from one or several columns; a null part gives a null id.

    Inside a composite id the separator is escaped, so that different parts never spell the same id.
    """
    texts = [F.col(c).cast("string") for c in columns]
    if len(texts) == 1:
        return texts[0]
    escaped = [F.replace(F.replace(t, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for t in texts]
    parts = [escaped[0]]
    for text in escaped[1:]:
        parts += [F.lit("|"), text]
    return F.concat(*parts)


@dataclass(frozen=True)
class EntityMapping:
    """``properties`` maps entity property to source column; ``ids`` are the columns of the id."""

    ids: Sequence[str]
    properties: Mapping[str, str]
    condition: Mapping | None = None


def map_entities(df: DataFrame, mapping: EntityMapping) -> DataFrame:
    """Entity rows: id and mapped properties of the rows that pass the filter tree."""
    rows = df if mapping.condition is None else df.filter(tree_condition(mapping.condition))
    return rows.select(
        entity_key(*mapping.ids).alias("entity_id"),
        *[F.col(source).alias(name) for name, source in mapping.properties.items()])


def link_series(entities: DataFrame, series: DataFrame, entity_property: str, series_column: str) -> DataFrame:
    """Time-series rows with the id of the entity they belong to."""
    ids = entities.select(F.col("entity_id"), F.col(entity_property).alias("__link"))
    return series.join(ids, F.col(series_column) == F.col("__link"), "inner").drop("__link")


def relate(first: DataFrame, second: DataFrame, first_column: str, second_column: str) -> DataFrame:
    """Edges (first_id, second_id) between entities that agree on a column each."""
    left = first.select(F.col("entity_id").alias("first_id"), F.col(first_column).alias("__a"))
    right = second.select(F.col("entity_id").alias("second_id"), F.col(second_column).alias("__b"))
    return left.join(right, F.col("__a") == F.col("__b"), "inner").select("first_id", "second_id")


@dataclass(frozen=True)
class NodeTable:
    label: str
    source: str
    keys: Sequence[str]
    properties: Mapping[str, str] = field(default_factory=dict)
    condition: Mapping | None = None


@dataclass(frozen=True)
class EdgeTable:
    label: str
    source: str
    source_label: str
    source_keys: Sequence[str]
    target_label: str
    target_keys: Sequence[str]
    properties: Mapping[str, str] = field(default_factory=dict)
    condition: Mapping | None = None


def _kept(df: DataFrame, condition: Mapping | None) -> DataFrame:
    return df if condition is None else df.filter(tree_condition(condition))


def _properties(mapping: Mapping[str, str]) -> Column:
    """Properties as one JSON text, since node types differ in their columns."""
    return F.to_json(F.struct(*[F.col(c).alias(n) for n, c in mapping.items()])) if mapping else F.lit("{}")


def graph_nodes(tables: Mapping[str, DataFrame], nodes: Sequence[NodeTable]) -> DataFrame:
    """(label, node_id, properties) of every node table."""
    parts = [
        _kept(tables[n.source], n.condition).select(
            F.lit(n.label).alias("label"), entity_key(*n.keys).alias("node_id"),
            _properties(n.properties).alias("properties"))
        for n in nodes
    ]
    return reduce(DataFrame.unionByName, parts)


def graph_edges(tables: Mapping[str, DataFrame], edges: Sequence[EdgeTable]) -> DataFrame:
    """(label, source, target, properties) of every edge table; rows with a null end are no edges."""
    parts = [
        _kept(tables[e.source], e.condition).select(
            F.lit(e.label).alias("label"),
            F.lit(e.source_label).alias("source_label"), entity_key(*e.source_keys).alias("source_id"),
            F.lit(e.target_label).alias("target_label"), entity_key(*e.target_keys).alias("target_id"),
            _properties(e.properties).alias("properties"))
        .filter("source_id IS NOT NULL AND target_id IS NOT NULL")
        for e in edges
    ]
    return reduce(DataFrame.unionByName, parts)


@dataclass(frozen=True)
class Role:
    """Permitted columns (``*`` for all) and a row predicate in SQL."""

    columns: Sequence[str] = ("*",)
    rows: str | None = None


def role_view(df: DataFrame, role: Role) -> DataFrame:
    rows = df if role.rows is None else df.filter(role.rows)
    return rows if "*" in role.columns else rows.select(*role.columns)


def _leaves(node: Mapping) -> list[Mapping]:
    """Leaves and same-row groups of a criteria tree, left to right."""
    if node["node"] in ("Leaf", "UnitAnd"):
        return [node]
    return [leaf for child in node["children"] for leaf in _leaves(child)]


def _leaf_table(leaf: Mapping) -> str:
    tables = {c["path"].split(".", 1)[0] for c in (leaf["children"] if leaf["node"] == "UnitAnd" else [leaf])}
    if len(tables) != 1:
        raise ValueError("conditions on the same row must name one table")
    return tables.pop()


def _row_condition(leaf: Mapping) -> Column:
    if leaf["node"] == "UnitAnd":
        return reduce(and_, [_row_condition(c) for c in leaf["children"]])
    values = leaf["value"] if isinstance(leaf["value"], (list, tuple)) else [leaf["value"]]
    literals = [F.lit(str(v)).cast(leaf.get("type", "string")) for v in values]
    return COHORT_LEAVES[leaf["op"]](F.col(leaf["path"].split(".", 1)[1]), literals)


def cohort(tables: Mapping[str, DataFrame], entity: Mapping[str, str], entry: str, tree: Mapping) -> DataFrame:
    """Entities that satisfy a criteria tree of And, Or, Not, UnitAnd and leaves.

    A leaf asks whether the entity has a row that meets a condition; UnitAnd asks it of one row. Every
    table is reduced to one flag per leaf and entity, so that the whole tree costs one aggregation,
    however many leaves it has. ``entity`` names the id column of each table; the entities are those of
    the ``entry`` table.
    """
    leaves = _leaves(tree)
    flags = [f"__f{i}" for i in range(len(leaves))]
    parts = []
    for name in dict.fromkeys([entry, *[_leaf_table(leaf) for leaf in leaves]]):
        own = [i for i, leaf in enumerate(leaves) if _leaf_table(leaf) == name]
        tests = [F.coalesce(_row_condition(leaves[i]), F.lit(False)) if i in own else F.lit(False)
                 for i in range(len(leaves))]
        rows = tables[name].select(
            F.col(entity[name]).alias("entity_id"), F.lit(name == entry).alias("__entry"),
            *[t.alias(f) for t, f in zip(tests, flags)])
        parts.append(rows if name == entry else rows.filter(any_of([F.col(flags[i]) for i in own])))
    found = reduce(DataFrame.unionByName, parts).groupBy("entity_id").agg(
        F.bool_or("__entry").alias("__entry"), *[F.bool_or(f).alias(f) for f in flags])
    positions = iter(range(len(leaves)))

    def fold(node: Mapping) -> Column:
        if node["node"] in ("Leaf", "UnitAnd"):
            return F.col(flags[next(positions)])
        children = [fold(c) for c in node["children"]]
        if node["node"] == "Not":
            (only,) = children
            return ~only
        return reduce({"And": and_, "Or": or_}[node["node"]], children)

    return found.filter(F.col("__entry") & fold(tree)).select("entity_id")
