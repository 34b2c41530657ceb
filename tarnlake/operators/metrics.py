"""Metric layer: named measures over a star (or snowflake) of tables.

A model names a fact table, many-to-one relationships that lead from it to the dimensions, and measures.
A request names measures, grouping columns, filters and a row cap; the joins follow from the columns.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnlake.functions.predicates import all_of, any_of, text_values_match
from tarnlake.operators.joins import join_null_safe
from tarnlake.operators.topk import checked_cap
from tarnlake.sizing import is_small

# Fixed spellings of a column reference: 'Table'[Col], Table[Col], Table.Col, [Col], Col.
REFERENCE = re.compile(r"^(?:'(?P<quoted>[^']+)'|(?P<table>[A-Za-z_][A-Za-z0-9_ ]*))?"
                       r"(?:\[(?P<bracket>[^\]]+)\]|\.(?P<dotted>[A-Za-z_][A-Za-z0-9_ ]*))$")


@dataclass(frozen=True)
class Measure:
    """``function`` is one of sum, count, min, max, avg, distinct (the number of different values); ``expression`` is
    SQL over fact columns."""

    function: str
    expression: str


@dataclass(frozen=True)
class Ratio:
    """One named measure over another; null where the latter is 0 or null."""

    numerator: str
    denominator: str


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``table`` point at one row of ``parent``."""

    table: str
    column: str
    parent: str
    key: str


@dataclass(frozen=True)
class Model:
    fact: str
    tables: Mapping[str, DataFrame]
    relationships: Sequence[Relationship]
    measures: Mapping[str, Measure | Ratio] = field(default_factory=dict)

    def path_to(self, table: str) -> list[Relationship]:
        """Relationships that lead from the fact to a table."""
        path = []
        while table != self.fact:
            link = next((r for r in self.relationships if r.parent == table), None)
            if link is None:
                raise ValueError(f"no relationship leads to table {table}")
            path.insert(0, link)
            table = link.table
        return path

    def locate(self, reference: str) -> tuple[str, str]:
        """(table, column) of a reference; without a table name the column must be in one table only."""
        text = reference.strip()
        match = REFERENCE.match(text)
        table = (match["quoted"] or match["table"]) if match else None
        column = (match["bracket"] or match["dotted"]) if match else text
        owners = [t for t, df in self.tables.items() if column in df.columns and table in (None, t)]
        if len(owners) != 1:
            raise ValueError(f"column {reference} is in {len(owners)} tables of the model")
        return owners[0], column

    def measure(self, name: str) -> Measure | Ratio:
        if bare(name) not in self.measures:
            raise ValueError(f"unknown measure: {name}")
        return self.measures[bare(name)]

    def plain_measures(self, name: str, above: tuple[str, ...] = ()) -> list[str]:
        """Names of the measures that a measure is read off: its own, or those of the two sides of a ratio."""
        if bare(name) in above:
            raise ValueError(f"measure {name} refers to itself")
        found = self.measure(name)
        if isinstance(found, Measure):
            return [bare(name)]
        below = (*above, bare(name))
        return [m for side in (found.numerator, found.denominator) for m in self.plain_measures(side, below)]

    def read(self, name: str, values: Mapping[str, Column]) -> Column:
        """The measure from the values of its plain measures."""
        found = self.measure(name)
        if isinstance(found, Measure):
            return values[bare(name)]
        over, under = (self.read(side, values).cast("double") for side in (found.numerator, found.denominator))
        return over / F.nullif(under, F.lit(0.0))


def bare(name: str) -> str:
    return name.strip().removeprefix("[").removesuffix("]")


# How two partial values come together, and how a measure is read off its parts.
_MERGE: Mapping[str, Callable[[str], Column]] = {
    "sum": F.sum, "count": F.sum, "avg": F.sum, "min": F.min, "max": F.max, "distinct": F.count_distinct,
}


def _parts_of(measures: Sequence[Measure]) -> dict[str, Column]:
    """Per fact row: the value of each measure, and for means the number of values."""
    parts = {}
    for i, m in enumerate(measures):
        value = F.expr(m.expression)
        present = value.isNotNull().cast("bigint")
        parts[f"__v{i}"] = present if m.function == "count" else value
        if m.function == "avg":
            parts[f"__n{i}"] = present
    return parts


def _merged(measures: Sequence[Measure]) -> list[Column]:
    out = []
    for i, m in enumerate(measures):
        out.append(_MERGE[m.function](f"__v{i}").alias(f"__v{i}"))
        if m.function == "avg":
            out.append(F.sum(f"__n{i}").alias(f"__n{i}"))
    return out


def _whole(position: int, measure: Measure) -> Column:
    value = _MERGE[measure.function](f"__v{position}")
    if measure.function != "avg":
        return value
    return value.cast("double") / F.nullif(F.sum(f"__n{position}"), F.lit(0))


def _settled_type(value: Column, measure: Measure, kind: T.DataType) -> Column:
    """Sums of decimals get one type, whether or not they were summed before a join."""
    if measure.function == "sum" and isinstance(kind, T.DecimalType):
        return value.cast(T.DecimalType(38, kind.scale))
    return value


def _join_order(model: Model, links: Sequence[Relationship], small: Mapping[str, bool],
                filtered: set[str]) -> list[Relationship]:
    """Links in an order in which each table is reached before it is left, small parents first, then filtered ones."""
    waiting, reached, order = list(links), {model.fact}, []
    while waiting:
        ready = [link for link in waiting if link.table in reached]
        link = min(ready, key=lambda r: (not small[r.parent], r.parent not in filtered))
        waiting.remove(link)
        reached.add(link.parent)
        order.append(link)
    return order


def evaluate(
    model: Model,
    measures: Sequence[str],
    group_by: Sequence[str] = (),
    filters: Mapping[str, Sequence[str]] | None = None,
    max_rows: int | None = None,
    order_by: Sequence[str | Column] = (),
    presum: bool | None = None,
) -> DataFrame:
    """Measures per group; without grouping one row over the filtered fact. All groups are returned, unless
    ``max_rows`` asks for the first in ``order_by``, or in the order of the group columns.

    Small dimensions are broadcast first. Before rows are shuffled to meet a large dimension, they are
    summed per key (``presum`` None), so that the hottest key crosses the network as one row per task;
    ``presum`` True sums before every join, False before none. Groups whose measures are all null are
    dropped. A measure may be a ratio of two others. Numbers of different values can't be summed; each is found over
    rows that are made distinct before a join in place of being summed, and joined to the others by group.
    """
    groups = [model.locate(g) for g in group_by]
    wanted = {model.locate(c): list(vs) for c, vs in (filters or {}).items()}
    plain = list(dict.fromkeys(p for m in measures for p in model.plain_measures(m)))
    sets = [[p for p in plain if model.measures[p].function != "distinct"],
            *[[p] for p in plain if model.measures[p].function == "distinct"]]
    places = {p: i for i, p in enumerate(plain)}
    dims = _dimensions(model, groups, wanted)
    parts = [_totals(model, dims, names, places, groups, wanted, presum) for names in sets if names]
    columns = [c for _, c in groups]
    shown = [c if columns.count(c) == 1 else f"{t}.{c}" for t, c in groups]
    result = parts[0]
    for part in parts[1:]:
        # All parts hold the same groups, as they are made of the same rows.
        result = join_null_safe(result, part, [f"__g{i}" for i in range(len(groups))], "inner") if groups else \
            result.withColumns({c: part.select(c).scalar() for c in part.columns})
    values = {p: F.col(f"__m{places[p]}") for p in plain}
    totals = [model.read(m, values).alias(bare(m)) for m in measures]
    result = result.select(*[F.col(f"__g{i}").alias(c) for i, c in enumerate(shown)], *totals)
    if not groups:
        return result
    result = result.filter(any_of([F.col(f"`{bare(m)}`").isNotNull() for m in measures]))
    if max_rows is None:
        return result.orderBy(*order_by) if order_by else result
    first = order_by or [F.col(f"`{c}`") for c in shown]
    return result.orderBy(*first).limit(checked_cap(max_rows))


# Inside, a column carries its table's name, since two tables may use one name.
def inner(table: str, column: str) -> str:
    return f"__{table}__{column}"


def _links_to(model: Model, groups: Sequence[tuple[str, str]], wanted: Mapping[tuple[str, str], list[str]]) -> list[Relationship]:
    """The relationships that lead from the fact to the tables of a request."""
    return list(dict.fromkeys(link for t, _ in [*groups, *wanted] if t != model.fact for link in model.path_to(t)))


def _prepared(model: Model, table: str, groups: Sequence[tuple[str, str]], wanted: Mapping[tuple[str, str], list[str]],
              *extra: Column) -> DataFrame:
    """Filtered rows of a table with the columns that the request needs of it."""
    df = model.tables[table]
    conditions = [text_values_match(F.col(c), vs, df.schema[c].dataType.simpleString())
                  for (t, c), vs in wanted.items() if t == table]
    used = [c for t, c in groups if t == table] + [r.column for r in _links_to(model, groups, wanted) if r.table == table]
    return df.filter(all_of(conditions)).select(
        *[F.col(c).alias(inner(table, c)) for c in dict.fromkeys(used)], *extra)


def _dimensions(model: Model, groups: Sequence[tuple[str, str]],
                wanted: Mapping[tuple[str, str], list[str]]) -> dict[str, tuple[DataFrame, bool]]:
    """The rows of each dimension that are joined, under ``__key``, and whether they can be broadcast. Their size is
    found once a request."""
    dims = {link.parent: _prepared(model, link.parent, groups, wanted, F.col(link.key).alias("__key"))
            for link in _links_to(model, groups, wanted)}
    return {t: (df, is_small(df)) for t, df in dims.items()}


def _totals(model: Model, dims: Mapping[str, tuple[DataFrame, bool]], names: Sequence[str], places: Mapping[str, int],
            groups: Sequence[tuple[str, str]], wanted: Mapping[tuple[str, str], list[str]],
            presum: bool | None) -> DataFrame:
    """Plain measures per group, as columns ``__m<i>`` with i from ``places``; the groups are ``__g<i>``."""
    chosen = [model.measures[m] for m in names]
    small = {t: fits for t, (_, fits) in dims.items()}
    links = _join_order(model, _links_to(model, groups, wanted), small, {t for t, _ in wanted})

    def columns_after(step: int) -> list[str]:
        """Columns still of use once the first ``step`` joins are done."""
        reached = {model.fact, *[link.parent for link in links[:step]]}
        return list(dict.fromkeys(
            [inner(t, c) for t, c in groups if t in reached]
            + [inner(r.table, r.column) for r in links[step:] if r.table in reached]))

    parts = _parts_of(chosen)
    rows = _prepared(model, model.fact, groups, wanted, *[c.alias(n) for n, c in parts.items()])
    for step, link in enumerate(links):
        keys = columns_after(step)
        large_left = [r for r in links[step:] if inner(r.table, r.column) in keys and not small[r.parent]]
        if presum or (presum is None and large_left == [link]):
            rows = rows.select(*keys, "__v0").distinct() if chosen[0].function == "distinct" else \
                rows.groupBy(*keys).agg(*_merged(chosen))
        # A filtered dimension keeps only rows that match it; else unmatched rows stay, under null.
        how = "inner" if any(t == link.parent for t, _ in wanted) else "left"
        dim = F.broadcast(dims[link.parent][0]) if small[link.parent] else dims[link.parent][0]
        joined = rows.join(dim, F.col(inner(link.table, link.column)) == F.col("__key"), how)
        rows = joined.select(*columns_after(step + 1), *parts)

    totals = [_settled_type(_whole(i, m), m, rows.schema[f"__v{i}"].dataType).alias(f"__m{places[n]}")
              for i, (m, n) in enumerate(zip(chosen, names))]
    shown = [F.col(inner(t, c)).alias(f"__g{i}") for i, (t, c) in enumerate(groups)]
    return rows.groupBy(*shown).agg(*totals) if groups else rows.agg(*totals)
