"""Re-running an old range with late rows, repaired forward, equals one run over all rows."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_batch import _cfg

from activitykit import events_as_activity
from activitykit.plans.batch import run_batch
from activitykit.sources.snapshot_store import load_snapshot
from activitykit.sources.versions import current, read_current

COLS = ["raw_user_session", "user_id", "session_id", "session_start_time_utc", "price", "event_date_kst"]


def _published(spark, root):
    return sorted(map(tuple, read_current(spark, f"{root}/final").select(*COLS).collect()))


def _weekly(spark, root):
    out = []
    for name in ("wau-users-by-week", "weekly-active-sessions-by-week"):
        out.append(sorted((str(r.week_start_kst), r[0]) for r in spark.read.parquet(f"{root}/wau/{name}").collect()))
    return out


def _states(spark, root, day):
    return sorted((r.user_id, r.last_session_id, r.last_event_time_utc) for r in load_snapshot(spark, f"{root}/state", day).collect())


@pytest.mark.parametrize("gap", [43_200, 200_000])
def test_rerun_with_late_rows_equals_one_run(spark, tmp_path, gap):
    raw = events_as_activity(spark, SF_SMALL, dirty=True)
    late = F.pmod(F.xxhash64("user_session"), F.lit(3)) == 0
    some = raw.where(~(late & (F.col("event_time") < "2024-01-10 12:00:00")))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    kw = dict(gap_seconds=gap)
    ranges = [("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-01-31")]
    ranges = ranges if gap == 43_200 else [ranges[0], ("2024-01-11", "2024-01-31")]
    for i, (lo, hi) in enumerate(ranges):
        run_batch(spark, _cfg(one, f"w{gap}-{i}", lo, hi, **kw), raw)
        run_batch(spark, _cfg(two, f"l{gap}-{i}", lo, hi, **kw), some)
    assert _published(spark, two) != _published(spark, one)
    m = run_batch(spark, _cfg(two, f"l{gap}-late", "2024-01-01", "2024-01-10", **kw), raw)
    assert m["repaired_days"] and m["repaired_days"][0] == "2024-01-11"
    if gap == 43_200:
        assert len(m["repaired_days"]) <= 5  # the states agree again soon
    assert _published(spark, two) == _published(spark, one)
    assert _weekly(spark, two) == _weekly(spark, one)
    for _, day in ranges:
        assert _states(spark, two, day) == _states(spark, one, day)
    assert spark.table(f"ae_l{gap}").count() == len(_published(spark, one))


def test_rerun_without_changes_repairs_nothing(spark, tmp_path):
    raw = events_as_activity(spark, SF_SMALL, dirty=True)
    root = str(tmp_path)
    run_batch(spark, _cfg(root, "same-1", "2024-01-01", "2024-01-31", gap_seconds=21_600), raw)
    before = _published(spark, root)
    m = run_batch(spark, _cfg(root, "same-2", "2024-01-08", "2024-01-12", gap_seconds=21_600), raw)
    # no snapshot of the 7th was saved: the states come from the published days
    assert m["repaired_days"] == []
    assert _published(spark, root) == before
    days = current(spark, f"{root}/final").days
    assert {d for d, e in days.items() if e["version"] == "same-2"} == {f"2024-01-{d:02d}" for d in range(8, 13)}
