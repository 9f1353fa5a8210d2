"""O56 across runs: after an old range is run again, the days after it are repaired.

A later day's sessions depend on the days before it only through each user's end state: the last
event and the start of its session. So the repair goes day by day from the end of the range. It
compares the end states before and after, keeps the users whose state changed and still reaches the
day (the gap), cuts those users' rows of the day into sessions again from their new state, and
copies the day's other rows. The states at the end of that day, before and after, are compared next.
As soon as none differs, every later day is already as one run over all days would have made it, and
the repair stops, usually after a day.

Repaired days are written as folders of the running version, so they are published by the same
manifest as the range itself. Each day costs one scan of that day, and the states that are carried
on hold only changed users. Saved snapshots of the days passed are repaired too.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from activitykit.operators.sessionize import sessionize
from activitykit.operators.snapshot import build_snapshot, latest_state_per_user, reaching
from activitykit.runtime import scratch_path
from activitykit.schema import SESSION_COLUMNS
from activitykit.sources import fs
from activitykit.sources.snapshot_store import save_snapshot, snapshot_path
from activitykit.sources.versions import Manifest, day_path, read_days

DAY_SECONDS = 86_400
STATE = ["last_event_time_utc", "last_session_start_time_utc"]


@dataclass
class Repair:
    """``days``: repaired and written, in order; ``snapshots``: snapshot dates that were saved anew."""

    days: list[str] = field(default_factory=list)
    snapshots: list[str] = field(default_factory=list)


def _next(day: str) -> str:
    return (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def boundary_state(spark: SparkSession, base: str, versions: dict[str, str], day: str, gap_seconds: int, run_id: str) -> DataFrame | None:
    """The end states of ``day`` that the gap still reaches, from the published days (None: no such day).

    ``versions``: the version each day is read from. Only the days within the gap of the boundary are read.
    """
    first = (dt.date.fromisoformat(day) - dt.timedelta(days=-(-gap_seconds // DAY_SECONDS) - 1)).isoformat()
    near = {d: v for d, v in versions.items() if first <= d <= day}
    if not near:
        return None
    return reaching(build_snapshot(read_days(spark, base, near), day, run_id), _next(day), gap_seconds)


def _changed(old: DataFrame | None, new: DataFrame | None) -> DataFrame:
    """(user_id, old and new state) of the users whose end state differs; states are one row a user."""
    columns = ["user_id", *STATE, "last_session_id", "last_event_time_kst"]
    some = old if old is not None else new
    sides = [(s if s is not None else some.limit(0)).select(*columns) for s in (old, new)]
    pairs = [F.struct(*columns[1:]).alias(name) for name in ("_old", "_new")]
    both = [s.select("user_id", p) for s, p in zip(sides, pairs)]
    same = F.lit(True)
    for c in STATE:
        same = same & F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    return both[0].join(both[1], "user_id", "full_outer").where(~same)


def _state(changed: DataFrame, side: str, day: str, run_id: str) -> DataFrame:
    return changed.where(F.col(side).isNotNull()).select(
        F.lit(day).alias("snapshot_date_kst"), "user_id", f"{side}.last_session_id", f"{side}.last_session_start_time_utc",
        f"{side}.last_event_time_utc", f"{side}.last_event_time_kst", F.current_timestamp().alias("updated_at"), F.lit(run_id).alias("run_id"),
    )


def repair_forward(
    spark: SparkSession,
    base: str,
    manifest: Manifest,
    version: str,
    new_days: list[str],
    end_date: str,
    gap_seconds: int,
    session_state_base: str | None = None,
    max_user_rows: int | None = None,
) -> Repair:
    """Repairs the published days after ``end_date`` for what ``new_days`` of ``version`` change.

    ``manifest``: what is published before the version; nothing is published here.
    """
    done = Repair()
    before = {d: e["version"] for d, e in manifest.days.items()}
    snapshots = []
    if session_state_base:
        names = fs.list_dirs(spark, session_state_base)
        snapshots = [n.split("=", 1)[1] for n in names if n.startswith("snapshot_date_kst=") and n.split("=", 1)[1] > end_date]
    last = max([*(d for d in before if d > end_date), *snapshots], default=end_date)
    old = boundary_state(spark, base, before, end_date, gap_seconds, version)
    new = boundary_state(spark, base, before | {d: version for d in new_days}, end_date, gap_seconds, version)
    if last == end_date or (old is None and new is None):
        return done
    changed = _written(_changed(old, new), "repair-changed")
    ends: DataFrame | None = None  # the last state of every user cut again so far
    day = end_date
    while day < last:
        day = _next(day)
        if changed.isEmpty():
            break
        old_state, new_state = _state(changed, "_old", day, version), _state(changed, "_new", day, version)
        if day in before:
            rows = read_days(spark, base, {day: before[day]})
            users = changed.select("user_id")
            mine = _written(rows.join(users, "user_id", "left_semi"), "repair-rows")
            if not mine.isEmpty():
                redo = sessionize(mine.drop(*SESSION_COLUMNS, "session_opened"), new_state, gap_seconds, max_user_rows, with_session_opened=True)
                redo = _written(redo.select(*rows.columns) if "session_opened" in rows.columns else redo.drop("session_opened").select(*rows.columns), "repair-sessions")
                rest = rows.join(users, "user_id", "left_anti")
                rest.unionByName(redo).drop("event_date_kst").write.mode("overwrite").parquet(day_path(base, version, day))
                done.days.append(day)
                old_state = latest_state_per_user(build_snapshot(mine, day, version), old_state)
                redone = build_snapshot(redo, day, version)
                new_state = latest_state_per_user(redone, new_state)
                ends = redone if ends is None else latest_state_per_user(redone, ends)
        after = _next(day)
        changed = _written(_changed(reaching(old_state, after, gap_seconds), reaching(new_state, after, gap_seconds)), "repair-changed")
        if day in snapshots:
            _repair_snapshot(spark, session_state_base, day, ends, _state(changed, "_new", day, version), changed.select("user_id"))
            done.snapshots.append(day)
    for day in snapshots:  # past the last repaired day: a user cut again may have no later event
        if ends is not None and day not in done.snapshots:
            _repair_snapshot(spark, session_state_base, day, ends)
            done.snapshots.append(day)
    return done


def _repair_snapshot(spark: SparkSession, base: str, day: str, ends: DataFrame | None, states: DataFrame | None = None, users: DataFrame | None = None) -> None:
    """Saves the day's snapshot anew: ``users`` get their row of ``states`` (none: no row), and those whose last event was cut again its new session."""
    saved = spark.read.parquet(snapshot_path(base, day))
    fresh = saved
    if users is not None:
        fresh = saved.join(users, "user_id", "left_anti").unionByName(states.select(*saved.columns))
    if ends is not None:
        cut = ends.select("user_id", F.struct(*STATE, "last_session_id").alias("_cut"))
        same = F.col("_cut").isNotNull() & F.col("last_event_time_utc").eqNullSafe(F.col("_cut.last_event_time_utc"))
        renewed = ("last_session_id", "last_session_start_time_utc")
        fresh = fresh.join(cut, "user_id", "left").select(*[F.when(same, F.col(f"_cut.{c}")).otherwise(F.col(c)).alias(c) if c in renewed else F.col(c) for c in saved.columns])
    save_snapshot(_written(fresh, "repair-snapshot"), base, day)
