"""Dated session snapshots under ``<base>/snapshot_date_kst=<date>``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from activitykit.sources import fs


def snapshot_path(base: str, snapshot_date_kst: str) -> str:
    return f"{base.rstrip('/')}/snapshot_date_kst={snapshot_date_kst}"


def load_snapshot(spark: SparkSession, base: str, snapshot_date_kst: str) -> DataFrame | None:
    """The snapshot of that date, or None when none was saved."""
    path = snapshot_path(base, snapshot_date_kst)
    if not fs.exists(spark, path):
        return None
    return spark.read.parquet(path)


def save_snapshot(snapshot: DataFrame, base: str, snapshot_date_kst: str) -> str:
    """Overwrites the one dated directory; returns its path."""
    path = snapshot_path(base, snapshot_date_kst)
    snapshot.write.mode("overwrite").parquet(path)
    return path
