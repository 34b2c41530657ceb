"""Folders for written intermediate tables and stream checkpoints.

They lie under ``spark.checkpoint.dir``, the folder that all executors share, so that a lost executor
costs a re-read and nothing else.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
_own_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder the session names. Only a local session without one gets a temporary folder."""
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SETTING} to a folder that every executor can reach")
    if context.applicationId not in _own_roots:
        _own_roots[context.applicationId] = tempfile.mkdtemp(prefix="tarnlake-")
    return _own_roots[context.applicationId]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path not used before; nothing is created there yet."""
    return f"{shared_root(spark)}/tarnlake/{label}-{uuid.uuid4().hex}"
