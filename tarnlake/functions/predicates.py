"""Predicates built from plain Python descriptions and folded to one Column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed operator names and value types of a filter tree.
VALUE_TYPES = {
    "BigInt": "bigint",
    "Float": "float",
    "Double": "double",
    "String": "string",
    "Bool": "boolean",
    "DateTime": "timestamp",
}
COMPARISONS = {
    "Ge": lambda c, v: c >= v,
    "Gt": lambda c, v: c > v,
    "Le": lambda c, v: c <= v,
    "Lt": lambda c, v: c < v,
    "Eq": lambda c, v: c == v,
    "NotEq": lambda c, v: c != v,
    "Contains": lambda c, v: c.contains(v),
    "NotContains": lambda c, v: ~c.contains(v),
    "IsNull": lambda c, v: c.isNull(),
    "IsNotNull": lambda c, v: c.isNotNull(),
}
CONNECTIVES = {"And": and_, "Or": or_}


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(or_, conditions, F.lit(False))


def text_values_match(column: Column, values: Sequence[str], data_type: str) -> Column:
    """Equality for one value, IN for several. The literals take the column's type, so the filter
    still reaches the Parquet scan."""
    literals = [F.lit(v).cast(data_type) for v in values]
    return column == literals[0] if len(literals) == 1 else column.isin(literals)


def dict_filter(df: DataFrame, filters: Mapping[str, Sequence[str]]) -> DataFrame:
    """Keep rows whose every named column holds one of the listed text values."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.filter(all_of([text_values_match(F.col(c), vs, types[c]) for c, vs in filters.items()]))


def optional_equals(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Equality filters by column name; a value of None means no filter."""
    return df.filter(all_of([F.col(c) == F.lit(v) for c, v in wanted.items() if v is not None]))


def contains_any_case(term: str, *columns: Column) -> Column:
    """Case-insensitive "contains" over any of the columns."""
    return any_of([F.coalesce(F.lower(c).contains(term.lower()), F.lit(False)) for c in columns])


def contains_any_word(column: Column, words: Sequence[str]) -> Column:
    """Exact-case "contains" of any of the words."""
    return any_of([column.contains(w) for w in words])


def tree_condition(node: Mapping) -> Column:
    """Fold a nested filter tree to one Column.

    A leaf is ``{"column", "op", "value", "type"}``; a branch is ``{"op": "And"|"Or", "nodes": [...]}``.
    """
    if "nodes" in node:
        return reduce(CONNECTIVES[node["op"]], [tree_condition(n) for n in node["nodes"]])
    value = node.get("value")
    literal = None if value is None else F.lit(str(value)).cast(VALUE_TYPES[node.get("type", "String")])
    return COMPARISONS[node["op"]](F.col(node["column"]), literal)
