import datetime as dt

import pytest
from conftest import SF_MID, plan_text, raw_row
from pyspark.sql import functions as F

from activitykit import build_snapshot, deduplicate, normalize, sessionize, validate
from activitykit.plans.registry import deduplicated


def _sess(raw, rows, **kw):
    df = deduplicate(normalize(raw(rows), "r")).deduplicated
    return sessionize(df, **kw)


def _times(user, *times):
    return [raw_row(event_time=f"2019-10-01 {t} UTC", user_id=user, user_session=f"{user}-{t}") for t in times]


def _starts(df):
    return {
        (r.user_id, r.event_time_utc.strftime("%H:%M:%S")): r.session_start_time_utc.strftime("%H:%M:%S")
        for r in df.collect()
    }


def test_boundary_299_same_300_new(spark, raw):
    got = _starts(_sess(raw, _times(3001, "00:00:00", "00:04:59", "00:09:59")))
    assert got == {(3001, "00:00:00"): "00:00:00", (3001, "00:04:59"): "00:00:00", (3001, "00:09:59"): "00:09:59"}


def test_users_are_independent(spark, raw):
    df = _sess(raw, _times(3001, "00:00:00", "00:05:00") + _times(4001, "00:00:00", "00:04:00"))
    per_user = {r.user_id: r.n for r in df.groupBy("user_id").agg(F.count_distinct("session_id").alias("n")).collect()}
    assert per_user == {3001: 2, 4001: 1}


def test_same_instant_events_are_complete(spark, raw):
    rows = [raw_row(user_id=3001, user_session="a"), raw_row(user_id=3001, product_id=7, user_session="b")]
    for r in _sess(raw, rows).collect():
        assert r.session_id and r.session_start_time_utc and r.session_start_time_kst and r.session_start_week_kst
    assert _sess(raw, rows).select("session_id").distinct().count() == 1


def test_session_across_kst_midnight(spark, raw):
    rows = [raw_row(event_time="2019-10-01 14:58:00 UTC", user_session="a"),
            raw_row(event_time="2019-10-01 15:02:00 UTC", user_session="b")]
    out = _sess(raw, rows).orderBy("event_time_utc").collect()
    assert [r.event_date_kst for r in out] == [dt.date(2019, 10, 1), dt.date(2019, 10, 2)]
    assert len({r.session_id for r in out}) == 1
    assert out[1].session_start_time_kst == dt.datetime(2019, 10, 1, 23, 58)


def test_sub_second_gap_uses_whole_seconds(spark, raw):
    df = deduplicate(normalize(raw(_times(1, "00:00:00")), "r")).deduplicated
    a = df.withColumn("event_time_utc", F.lit(dt.datetime(2019, 10, 1, 0, 0, 0, 900000)))
    b = df.withColumn("event_time_utc", F.lit(dt.datetime(2019, 10, 1, 0, 5, 0, 100000))).withColumn(
        "dedup_key", F.lit("k2"))
    assert sessionize(a.unionByName(b)).select("session_id").distinct().count() == 2


def _snapshot(spark, start, last, user=3001):
    return spark.createDataFrame(
        [("2019-10-01", user, "prev", start, last, last + dt.timedelta(hours=9), dt.datetime.now(), "r0")],
        "snapshot_date_kst string, user_id long, last_session_id string, last_session_start_time_utc timestamp, "
        "last_event_time_utc timestamp, last_event_time_kst timestamp, updated_at timestamp, run_id string",
    )


def test_carry_over_from_snapshot(spark, raw):
    snap = _snapshot(spark, dt.datetime(2019, 10, 1, 14, 58), dt.datetime(2019, 10, 1, 15, 0))
    rows = _times(3001, "15:02:00", "15:03:00")
    out = _sess(raw, rows, previous_snapshot=snap).collect()
    assert {r.session_start_time_utc for r in out} == {dt.datetime(2019, 10, 1, 14, 58)}
    assert len({r.session_id for r in out}) == 1


@pytest.mark.parametrize(
    "last, carried",
    [("15:00:01", True), ("14:57:01", True), ("14:57:00", False), ("15:10:00", False)],
)
def test_carry_over_gap_rules(spark, raw, last, carried):
    # first event at 15:02:00: gaps 119 s, 299 s carry; 300 s and negative do not
    snap = _snapshot(spark, dt.datetime(2019, 10, 1, 14, 50),
                     dt.datetime.strptime(f"2019-10-01 {last}", "%Y-%m-%d %H:%M:%S"))
    out = _sess(raw, _times(3001, "15:02:00"), previous_snapshot=snap).first()
    assert (out.session_start_time_utc == dt.datetime(2019, 10, 1, 14, 50)) is carried


def test_carry_over_only_first_local_session(spark, raw):
    snap = _snapshot(spark, dt.datetime(2019, 10, 1, 14, 58), dt.datetime(2019, 10, 1, 15, 0))
    out = _starts(_sess(raw, _times(3001, "15:02:00", "15:20:00") + _times(4001, "15:02:00"),
                        previous_snapshot=snap))
    assert out == {(3001, "15:02:00"): "14:58:00", (3001, "15:20:00"): "15:20:00", (4001, "15:02:00"): "15:02:00"}


def test_gap_over_a_day_and_bad_gap(spark, raw):
    rows = [raw_row(event_time="2021-03-01 06:00:00 UTC", user_id=55, user_session="p"),
            raw_row(event_time="2021-03-02 18:00:00 UTC", user_id=55, user_session="q"),
            raw_row(event_time="2021-03-05 18:00:01 UTC", user_id=55, user_session="r")]
    out = {r.raw_user_session: r.session_start_time_utc.day for r in _sess(raw, rows, gap_seconds=172_800).collect()}
    assert out == {"p": 1, "q": 1, "r": 5}
    with pytest.raises(ValueError):
        _sess(raw, rows, gap_seconds=0)


def _rows(df):
    return sorted(
        (r.raw_user_session, r.session_id, r.session_start_time_utc) for r in
        df.select("raw_user_session", "session_id", "session_start_time_utc").collect()
    )


@pytest.mark.parametrize("gap", [300, 3600])
def test_hot_user_split_is_exact(spark, gap):
    dedup = deduplicated(spark, SF_MID)
    plain = sessionize(dedup, gap_seconds=gap, max_user_rows=None)
    split = sessionize(dedup, gap_seconds=gap, max_user_rows=7)
    assert _rows(plain) == _rows(split)


def test_hot_split_with_seed_is_exact(spark):
    valid = validate(normalize(
        __import__("activitykit").events_as_activity(spark, SF_MID, dirty=True), "r"), "2024-01-01").valid
    from activitykit import filter_kst_range

    def run(**kw):
        first = sessionize(deduplicate(filter_kst_range(valid, "2024-01-01", "2024-01-10")).deduplicated,
                           gap_seconds=21600, **kw)
        snap = build_snapshot(first, "2024-01-10", "r")
        second = sessionize(deduplicate(filter_kst_range(valid, "2024-01-11", "2024-01-31")).deduplicated,
                            previous_snapshot=snap, gap_seconds=21600, **kw)
        return first.unionByName(second)

    whole = sessionize(deduplicate(valid).deduplicated, gap_seconds=21600, max_user_rows=None)
    assert _rows(run(max_user_rows=None)) == _rows(whole)
    assert _rows(run(max_user_rows=9)) == _rows(whole)


def test_session_opened_counts_distinct_sessions(spark):
    dedup = deduplicated(spark, SF_MID)
    for kw in ({}, {"max_user_rows": 5}):
        s = sessionize(dedup, gap_seconds=1800, with_session_opened=True, **kw)
        assert s.where("session_opened").count() == s.select("session_id").distinct().count()


def test_single_shuffle_without_hot_users(spark):
    s = sessionize(deduplicated(spark, SF_MID), max_user_rows=None)
    plan = plan_text(s)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 2
    assert "hashpartitioning(dedup_key" in exchanges[1] and "hashpartitioning(user_id" in exchanges[0]


def test_split_exact_with_stats_from_another_source(spark):
    # stats that miss the early rows and undercount: other users go by seconds, results do not change
    dedup = deduplicated(spark, SF_MID)
    late = dedup.where(F.col("event_time_utc") > F.lit("2024-01-10").cast("timestamp"))
    plain = sessionize(dedup, max_user_rows=None)
    split = sessionize(dedup, max_user_rows=3, user_stats=__import__("activitykit").user_activity_stats(late))
    assert _rows(plain) == _rows(split)


def test_burst_is_one_window_row_a_second(spark):
    from activitykit.operators.sessionize import _by_seconds, _window_pass

    # 3,000 events of one user in three seconds of one hour, then one a month later
    rows = spark.range(3001).select(
        F.lit(9).cast("long").alias("user_id"),
        F.when(F.col("id") == 3000, F.lit("2022-07-31 10:00:00")).otherwise(
            F.concat(F.lit("2022-07-01 10:1"), (F.col("id") % 3).cast("string"), F.lit(":00"))).cast("timestamp").alias("event_time_utc"),
        (F.col("id") % 5).alias("product_id"),
        F.lit("view").alias("event_type"),
        F.sha2(F.col("id").cast("string"), 256).alias("dedup_key"),
    )
    key = ["dedup_key", "session_start_time_utc", "session_opened"]
    for gap in (30, 60, 61, 300):
        plain = {tuple(r) for r in _window_pass(rows, None, gap).select(key).collect()}
        assert {tuple(r) for r in _by_seconds(rows, None, gap).select(key).collect()} == plain
    assert rows.groupBy("event_time_utc").count().count() == 4  # what a window task holds


def test_session_opened_with_seed_and_hot_user(spark, raw):
    snap = _snapshot(spark, dt.datetime(2019, 10, 1, 14, 58), dt.datetime(2019, 10, 1, 15, 0))
    rows = _times(3001, "15:02:00", "15:02:30", "15:03:00", "15:30:00")
    for limit in (None, 2):
        out = _sess(raw, rows, previous_snapshot=snap, max_user_rows=limit, with_session_opened=True)
        assert out.where("session_opened").count() == out.select("session_id").distinct().count() == 2
