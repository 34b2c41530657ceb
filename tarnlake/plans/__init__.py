"""Registered queries, each with the SQL that must give the same rows."""

from tarnlake.plans import (  # noqa: F401
    catalog,
    files,
    learning,
    mapping,
    metrics,
    relational,
    runs,
    series,
    streams,
    texts,
)
from tarnlake.plans.registry import ORACLES, QUERIES  # noqa: F401
