"""Day partitions published by pointer. Data files are written once and never moved.

Layout under a table's base folder::

    _versions/version=<id>/event_date_kst=<day>/part-*.parquet   one run's days, immutable
    _manifests/<number>.json                                     the folder each day is read from

The newest whole manifest is the dataset: it names every published day. A run writes its days into
a version of its own, where no reader looks, and publishes all of them at once by creating the next
manifest; the file either comes to be whole or does not count. Readers of the manifest thus see the
old days or the new ones, at any point where a driver may stop, and a running reader keeps the files
it has listed. Two publishers may race: the manifest's number is created exclusively, the loser reads
the winner's manifest and tries again on top of it.

A catalog table follows with ``SET LOCATION``, one day a statement, each atomic in the metastore;
``point_table`` brings a table that was left behind up to the manifest and changes nothing else.

Folders whose names start with ``_`` are skipped by path readers, so reading the base folder itself
finds no rows rather than several versions mixed.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.schema import ACTIVITY_TABLE_COLUMNS, DEFAULT_PROMOTE_RETRIES
from activitykit.sources import catalog, fs

VERSIONS, MANIFESTS = "_versions", "_manifests"
DAY = "event_date_kst"


@dataclass(frozen=True)
class Manifest:
    """``days``: day → {"version", "rows", "files", "bytes"}."""

    number: int = 0
    days: dict[str, dict] = field(default_factory=dict)


def version_path(base: str, version: str) -> str:
    return f"{base.rstrip('/')}/{VERSIONS}/version={version}"


def day_path(base: str, version: str, day: str) -> str:
    return f"{version_path(base, version)}/{DAY}={day}"


def _manifest_path(base: str, number: int) -> str:
    return f"{base.rstrip('/')}/{MANIFESTS}/{number:012d}.json"


def _numbers(spark: SparkSession, base: str) -> list[int]:
    names = fs.list_files(spark, f"{base.rstrip('/')}/{MANIFESTS}")
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def read_manifest(spark: SparkSession, base: str, number: int) -> Manifest | None:
    """The manifest of that number; None if there is none, or its writer stopped half way."""
    if not fs.exists(spark, _manifest_path(base, number)):
        return None
    try:
        return Manifest(number, json.loads(fs.read_text(spark, _manifest_path(base, number)))["days"])
    except (ValueError, KeyError):
        return None


def current(spark: SparkSession, base: str) -> Manifest:
    """The newest whole manifest; an empty one before the first publication."""
    for number in reversed(_numbers(spark, base)):
        found = read_manifest(spark, base, number)
        if found is not None:
            return found
    return Manifest()


def version_days(spark: SparkSession, base: str, version: str) -> list[str]:
    """The days that a version holds, sorted."""
    return [d.split("=", 1)[1] for d in fs.list_dirs(spark, version_path(base, version)) if d.startswith(f"{DAY}=")]


def _described(spark: SparkSession, base: str, version: str, days: list[str], rows: dict[str, int] | None) -> dict[str, dict]:
    """The manifest's entries of a version's days; the rows are counted from the Parquet footers unless given."""
    missing = [d for d in days if not fs.exists(spark, day_path(base, version, d))]
    if missing:
        raise FileNotFoundError(f"version {version} does not hold {', '.join(missing)}")
    if rows is None:
        found = read_days(spark, base, {d: version for d in days}, None) if days else None
        rows = {str(r[0]): r[1] for r in found.groupBy(DAY).count().collect()} if days else {}  # a row a day
    out = {}
    for day in days:
        files = {n: size for n, size in fs.list_files(spark, day_path(base, version, day)).items() if not n.startswith(("_", "."))}
        out[day] = {"version": version, "rows": rows.get(day, 0), "files": len(files), "bytes": sum(files.values())}
    return out


def commit(
    spark: SparkSession, base: str, version: str, days: list[str], max_retries: int = DEFAULT_PROMOTE_RETRIES, rows: dict[str, int] | None = None
) -> Manifest:
    """Publishes the days of a version; days not listed stay as they are. Repeating it is harmless."""
    if max_retries < 1:
        raise ValueError(f"maxRetryCount must be at least 1: {max_retries}")
    entries = _described(spark, base, version, sorted(set(days)), rows)
    for _ in range(max_retries):
        before = current(spark, base)
        after = before.days | entries
        if after == before.days:
            return before
        number = max([before.number, *_numbers(spark, base)]) + 1
        if fs.create_new(spark, _manifest_path(base, number), json.dumps({"days": after}, sort_keys=True)):
            return Manifest(number, after)
    raise RuntimeError(f"failed to publish version {version} after {max_retries} attempt(s): other publishers were first")


def publish_version(
    spark: SparkSession,
    base: str,
    version: str,
    days: list[str] | None = None,
    table: str | None = None,
    max_retries: int = DEFAULT_PROMOTE_RETRIES,
    rows: dict[str, int] | None = None,
) -> list[str]:
    """Commits a version's days (all it holds, if none are named) and points the table at them; returns their folders."""
    days = sorted(set(version_days(spark, base, version) if days is None else days))
    manifest = commit(spark, base, version, days, max_retries, rows)
    if table:
        point_table(spark, table, base, manifest, days)
    return [day_path(base, version, d) for d in days]


def point_table(spark: SparkSession, table: str, base: str, manifest: Manifest | None = None, days: list[str] | None = None) -> list[str]:
    """Points the table's partitions at the manifest's folders (of ``days``, or all); returns the days."""
    manifest = manifest or current(spark, base)
    wanted = sorted(set(days) if days is not None else set(manifest.days))
    locations = {d: day_path(base, manifest.days[d]["version"], d) for d in wanted}
    return catalog.point_partitions(spark, table, locations, DAY)


def read_days(spark: SparkSession, base: str, versions: dict[str, str], columns: list[str] | None = None) -> DataFrame:
    """The rows of the given days, each from the version named for it."""
    paths = [day_path(base, v, d) for d, v in sorted(versions.items())]
    found = spark.read.option("basePath", f"{base.rstrip('/')}/{VERSIONS}").parquet(*paths).drop("version")
    found = found.withColumn(DAY, F.col(DAY).cast("date"))
    return found if columns is None else found.select(*columns)


def read_current(spark: SparkSession, base: str, days: list[str] | None = None, manifest: Manifest | None = None) -> DataFrame:
    """The published rows (of ``days``, or all) in the table's columns; only those days' folders are listed."""
    manifest = manifest or current(spark, base)
    chosen = {d: e["version"] for d, e in manifest.days.items() if days is None or d in days}
    names = [c for c, _ in ACTIVITY_TABLE_COLUMNS]
    if not chosen:
        return spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in ACTIVITY_TABLE_COLUMNS))
    return read_days(spark, base, chosen, names)


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Deletes all but the newest ``keep`` manifests and the day folders that only those named; returns the folders.

    A version that no manifest has named yet (a run still at work, or one to be resumed) is left alone.
    """
    numbers = _numbers(spark, base)
    old, kept = numbers[:-keep] if keep > 0 else [], numbers[-keep:] if keep > 0 else numbers
    folders = {n: {day_path(base, e["version"], d) for d, e in m.days.items()} for n in numbers if (m := read_manifest(spark, base, n))}
    live = set().union(*(folders.get(n, set()) for n in kept)) | {day_path(base, e["version"], d) for d, e in current(spark, base).days.items()}
    gone = sorted(set().union(*(folders.get(n, set()) for n in old)) - live) if old else []
    for path in gone:
        fs.delete(spark, path)
    for n in old:
        fs.delete(spark, _manifest_path(base, n))
    return gone
