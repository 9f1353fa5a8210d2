"""Day-partitioned staging, dead-letter, weekly aggregates, ordered exports.

Day-partitioned writes first rebalance on the partition column: AQE then cuts the
data into advisory-sized tasks that each hold (mostly) one day, so a day becomes
a few large files instead of one small file per upstream task, and a huge day is
split over several tasks rather than written by one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from activitykit.schema import ACTIVITY_TABLE_COLUMNS


def to_table_layout(sessionized: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Projection onto the published table's columns, ``price`` being the decimal price,
    so every declared column reads back with its declared type; ``extra`` columns come first."""
    cols = [F.col(c) for c in extra or []]
    for name, _ in ACTIVITY_TABLE_COLUMNS:
        cols.append(F.col("normalized_price").alias("price") if name == "price" else F.col(name))
    return sessionized.select(*cols)


def write_day_partitions(df: DataFrame, path: str, column: str = "event_date_kst", rebalance: bool = True) -> None:
    out = df.hint("rebalance", column) if rebalance else df
    out.write.mode("overwrite").partitionBy(column).parquet(path)


def write_staging(df: DataFrame, path: str, rebalance: bool = True) -> None:
    """Overwrite, one directory per event_date_kst."""
    write_day_partitions(df, path, "event_date_kst", rebalance)


def write_dlq(invalid: DataFrame, path: str, rebalance: bool = True) -> None:
    """Overwrite, one directory per target_date."""
    write_day_partitions(invalid, path, "target_date", rebalance)


def write_weekly(weekly: DataFrame, path: str) -> None:
    """One file per week; dynamic overwrite, so weeks not in ``weekly`` survive.

    ``weekly`` is an aggregate (a row per week), so one task writes it.
    """
    (
        weekly.coalesce(1)
        .write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy("week_start_kst")
        .parquet(path)
    )


def export_json(df: DataFrame, path: str, order_by: list[str]) -> None:
    """JSON lines sorted by ``order_by`` (range-partitioned, no collect)."""
    df.orderBy(*order_by).write.mode("overwrite").json(path)


def export_duplicate_groups(groups: DataFrame, path: str) -> None:
    export_json(groups.select("dedup_key", "duplicate_group_size", "dropped_duplicate_row_count"), path, ["dedup_key"])


def export_snapshot(snapshot: DataFrame, path: str) -> None:
    fields = [
        "snapshot_date_kst",
        "user_id",
        "last_session_id",
        "last_session_start_time_utc",
        "last_event_time_utc",
        "last_event_time_kst",
        "updated_at",
        "run_id",
    ]
    export_json(snapshot.select(*fields), path, ["user_id"])
