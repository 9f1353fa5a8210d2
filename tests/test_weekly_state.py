"""Weekly counts merged from day bitmaps equal a recount over all events."""

import os

from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_batch import _cfg, _weekly

from activitykit import events_as_activity
from activitykit.operators.weekly import weekly_sessions, weekly_users
from activitykit.operators.weekly_state import SESSIONS, USERS, WeeklyState
from activitykit.plans.batch import run_batch

SCHEMA = "event_date_kst date, week_start_kst date, user_id long, session_start_week_kst date, session_id string"


def _rows(spark, seed, days=10, n=400):
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(days)).cast("int"))
    rows = spark.range(n).withColumn("event_date_kst", day)
    week = F.date_trunc("week", "event_date_kst").cast("date")
    # user 0 has a third of all rows; some ids are null
    user = F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 17 == 0, F.lit(None)).otherwise(F.pmod(F.xxhash64("id"), F.lit(40)))
    rows = rows.withColumn("week_start_kst", week).withColumn("user_id", user.cast("long"))
    rows = rows.withColumn("session_start_week_kst", F.when(F.col("id") % 5 == 0, F.date_sub("week_start_kst", 7)).otherwise(F.col("week_start_kst")))
    return rows.withColumn("session_id", F.concat(F.col("user_id").cast("string"), F.lit("-"), (F.col("id") % 4).cast("string"))).drop("id")


def _as_set(df):
    return sorted((str(r[0]), r[1]) for r in df.collect())


def _recount(rows):
    users = weekly_users(rows.where("user_id is not null"))
    return _as_set(users), _as_set(weekly_sessions(rows.where("session_id is not null")))


def test_any_order_of_days_and_reruns(spark, out_dir):
    first, again = _rows(spark, 1), _rows(spark, 2)
    early, late = F.col("event_date_kst") <= "2024-01-04", F.col("event_date_kst") > "2024-01-04"
    states = [WeeklyState(spark, out_dir, m) for m in (USERS, SESSIONS)]
    assert [s.counts().count() for s in states] == [0, 0]
    for s in states:
        s.update(first.where(late), [])
        s.update(first.where(early), [])
        s.update(first.where(early), [])
    assert [_as_set(s.counts()) for s in states] == list(_recount(first))
    for s in states:  # the early days anew, with other rows: what they held before is gone
        s.update(again.where(early), [])
    both = again.where(early).unionByName(first.where(late))
    assert [_as_set(s.counts()) for s in states] == list(_recount(both))
    assert _as_set(states[0].counts("2024-01-08")) == [r for r in _recount(both)[0] if r[0] >= "2024-01-08"]
    codes = states[0].codes()
    n = codes.count()
    assert codes.select("id").distinct().count() == codes.select("code").distinct().count() == n
    assert codes.agg(F.min("code"), F.max("code")).first() == (0, n - 1)  # dense


def test_day_without_rows_loses_its_bitmaps(spark, out_dir):
    rows, state = _rows(spark, 1), WeeklyState(spark, out_dir)
    state.update(rows, [])
    state.update(rows.where("event_date_kst = '2024-01-02'"), ["2024-01-02", "2024-01-03"])
    assert _as_set(state.counts()) == _recount(rows.where("event_date_kst <> '2024-01-03'"))[0]
    state.update(spark.createDataFrame([], SCHEMA), ["2024-01-02"])
    assert "2024-01-02" not in state.days() and "2024-01-04" in state.days()


def test_second_run_reads_only_its_own_days(spark, tmp_path):
    raw = events_as_activity(spark, SF_SMALL, dirty=True)
    plain, merged = str(tmp_path / "plain"), str(tmp_path / "merged")
    ranges = [("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20")]
    for i, (lo, hi) in enumerate(ranges):
        run_batch(spark, _cfg(plain, f"plain-{i}", lo, hi, gap_seconds=21_600), raw)
        kw = dict(gap_seconds=21_600, weekly_state_base_path=f"{merged}/weekly-state")
        seen = []
        update = WeeklyState.update

        def watched(self, rows, days):
            seen.append(sorted({f.split("event_date_kst=")[1].split("/")[0] for f in rows.inputFiles()}))
            return update(self, rows, days)

        WeeklyState.update = watched
        try:
            run_batch(spark, _cfg(merged, f"merged-{i}", lo, hi, **kw), raw)
        finally:
            WeeklyState.update = update
        assert all(lo <= d <= hi for days in seen for d in days) and len(seen) == 2
    for name, metric in [("wau-users-by-week", "wau_users"), ("weekly-active-sessions-by-week", "weekly_active_sessions")]:
        assert _weekly(spark, f"{merged}/wau/{name}", metric) == _weekly(spark, f"{plain}/wau/{name}", metric)
    assert os.path.isdir(f"{merged}/weekly-state/wau_users/days")
