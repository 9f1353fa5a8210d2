"""Catalog tables over the published folders, and their partitions.

Datasource tables (``USING PARQUET``) work with the built-in catalog and with a
Hive metastore alike. Registration is idempotent; re-registering a partition
points it at the new location.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from activitykit.schema import ACTIVITY_TABLE_COLUMNS
from activitykit.sources import fs


def _create(spark: SparkSession, name: str, columns: list[tuple[str, str]], partition: str, location: str) -> None:
    cols = ",\n  ".join(f"{c} {t}" for c, t in columns)
    loc = fs.qualified(spark, location)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING PARQUET\n"
        f"PARTITIONED BY ({partition})\nLOCATION '{loc}'"
    )


def create_activity_table(spark: SparkSession, name: str, location: str) -> None:
    _create(spark, name, ACTIVITY_TABLE_COLUMNS, "event_date_kst", location)


def create_weekly_table(spark: SparkSession, name: str, metric: str, location: str) -> None:
    _create(spark, name, [(metric, "bigint"), ("week_start_kst", "date")], "week_start_kst", location)


def add_partitions(
    spark: SparkSession, table: str, base: str, values: list[str], column: str = "event_date_kst"
) -> list[str]:
    """Registers each distinct value (sorted) at ``<base>/<column>=<value>``: new
    partitions in one ADD IF NOT EXISTS statement, partitions that already exist
    re-pointed with SET LOCATION. Returns the registered values."""
    return point_partitions(spark, table, {v: f"{base.rstrip('/')}/{column}={v}" for v in values}, column)


def point_partitions(spark: SparkSession, table: str, locations: dict[str, str], column: str = "event_date_kst") -> list[str]:
    """Points each value's partition at its folder: new partitions in one statement, existing ones that
    lie elsewhere by SET LOCATION (atomic a partition). Returns the values, sorted."""
    values = sorted(locations)
    if not values:
        return values
    existing = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    paths = {v: fs.qualified(spark, locations[v]) for v in values}
    new = [v for v in values if v not in existing]
    if new:
        specs = " ".join(f"PARTITION ({column}='{v}') LOCATION '{paths[v]}'" for v in new)
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {specs}")
    for v in values:
        if v in existing:
            set_location(spark, table, f"{column}='{v}'", paths[v])
    spark.catalog.refreshTable(table)
    return values


def set_location(spark: SparkSession, table: str, partition: str, path: str) -> None:
    spark.sql(f"ALTER TABLE {table} PARTITION ({partition}) SET LOCATION '{path}'")


def add_week_partitions(spark: SparkSession, table: str, base: str, weeks: list[str]) -> list[str]:
    return add_partitions(spark, table, base, weeks, "week_start_kst")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """O3: scan of a registered table (partition filters prune by directory)."""
    return spark.table(name)
