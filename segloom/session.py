"""Shared-storage helpers.

Everything that must outlive a lost executor goes to the folder named by
``spark.checkpoint.dir``. Only a local-mode session that leaves it unset falls back to a
fresh temporary folder.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session, registered as its checkpoint directory."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="segloom-"))
    return context.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Fix ``df`` in shared storage, so that a retry re-reads it instead of recomputing it."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def observed(observation: Observation, name: str) -> int | None:
    """An observed count, or None if the query ended without reporting it."""
    try:
        found = observation._jo.getOrEmpty()  # get would wait for a report that a plan without rows may never make
    except Py4JJavaError:  # such a plan reports a row without columns
        return None
    return found.apply(name) if found.contains(name) else None
