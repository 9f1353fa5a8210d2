"""Session-level settings the pipeline relies on, read from the running session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

UTC = "UTC"


def ensure_utc(spark: SparkSession) -> None:
    """KST columns are shifted instants: they are right only under a UTC session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != UTC:
        spark.conf.set("spark.sql.session.timeZone", UTC)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder for lineage cuts and scratch tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only when
    neither is set, as in a bare local test session, a fresh local folder is used.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return _parent_of_context_dir(current, configured)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="activitykit-")
    sc.setCheckpointDir(configured)
    return configured


def _parent_of_context_dir(current: str, configured: str | None) -> str:
    # SparkContext appends a per-application uuid folder to the configured dir.
    if configured:
        return configured
    return current.rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared dir for one query's written tables."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/activitykit/{name}-{uuid.uuid4().hex}"
