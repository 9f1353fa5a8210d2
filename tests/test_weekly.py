import datetime as dt

from conftest import plan_text

from activitykit import affected_weeks, weekly_sessions, weekly_summary, weekly_users, with_all_weeks
from activitykit.functions.time import monday_of
from activitykit.sources.sinks import write_weekly

D = dt.date


def _events(spark, rows):
    return spark.createDataFrame(
        rows,
        "user_id long, session_id string, event_date_kst date, week_start_kst date, session_start_week_kst date",
    )


def test_distinct_users_and_sessions(spark):
    df = _events(
        spark,
        [
            (1, "s1", D(2019, 10, 1), D(2019, 9, 30), D(2019, 9, 30)),
            (1, "s1", D(2019, 10, 1), D(2019, 9, 30), D(2019, 9, 30)),
            (2, "s2", D(2019, 10, 2), D(2019, 9, 30), D(2019, 9, 30)),
            (3, "s3", D(2019, 10, 8), D(2019, 10, 7), D(2019, 10, 7)),
        ],
    )
    assert [tuple(r) for r in weekly_users(df).collect()] == [(D(2019, 9, 30), 2), (D(2019, 10, 7), 1)]
    assert [tuple(r) for r in weekly_sessions(df).collect()] == [(D(2019, 9, 30), 2), (D(2019, 10, 7), 1)]


def test_week_filters(spark):
    df = _events(
        spark,
        [(i, f"s{i}", w + dt.timedelta(days=1), w, w) for i, w in
         enumerate([D(2019, 9, 30), D(2019, 10, 7), D(2019, 10, 14)])],
    )
    weeks = lambda out: [r.week_start_kst for r in out.collect()]
    assert weeks(weekly_users(df, "2019-10-07", "2019-10-14")) == [D(2019, 10, 7), D(2019, 10, 14)]
    assert weeks(weekly_sessions(df, "2019-10-07", "2019-10-14")) == [D(2019, 10, 7), D(2019, 10, 14)]
    assert weeks(weekly_users(df, week_from="2019-10-07")) == [D(2019, 10, 7), D(2019, 10, 14)]
    assert weeks(weekly_sessions(df, week_to="2019-10-07")) == [D(2019, 9, 30), D(2019, 10, 7)]


def test_session_counted_in_start_week_even_if_it_spans_weeks(spark):
    df = _events(
        spark,
        [(1, "s1", D(2019, 10, 6), D(2019, 9, 30), D(2019, 9, 30)),
         (1, "s1", D(2019, 10, 7), D(2019, 10, 7), D(2019, 9, 30))],
    )
    assert [tuple(r) for r in weekly_sessions(df, "2019-09-30", "2019-09-30").collect()] == [(D(2019, 9, 30), 1)]
    assert weekly_sessions(df, "2019-10-07", "2019-10-07").count() == 0


def test_dynamic_overwrite_keeps_other_weeks(spark, out_dir):
    path = f"{out_dir}/wau"
    first = spark.createDataFrame([(D(2019, 9, 30), 10), (D(2019, 10, 7), 20)], "week_start_kst date, wau_users long")
    write_weekly(first, path)
    write_weekly(spark.createDataFrame([(D(2019, 10, 7), 99)], "week_start_kst date, wau_users long"), path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("week_start_kst", "wau_users").collect())
    assert got == [(D(2019, 9, 30), 10), (D(2019, 10, 7), 99)]


def test_affected_weeks_and_fill(spark):
    weeks = affected_weeks(spark, "2019-11-30", "2019-12-07")
    assert [r.week_start_kst for r in weeks.collect()] == [D(2019, 11, 25), D(2019, 12, 2)]
    assert [r.week_start_kst for r in affected_weeks(spark, "2019-12-02", "2019-12-02").collect()] == [D(2019, 12, 2)]
    filled = with_all_weeks(
        spark.createDataFrame([(D(2019, 11, 25), 5)], "week_start_kst date, wau_users long"), weeks, "wau_users")
    assert sorted(tuple(r) for r in filled.collect()) == [(D(2019, 11, 25), 5), (D(2019, 12, 2), 0)]
    assert monday_of("2019-12-01") == "2019-11-25" and monday_of("2019-12-02") == "2019-12-02"


def test_summary(spark):
    w = spark.createDataFrame([(D(2019, 9, 30), 1), (D(2019, 10, 7), 2)], "week_start_kst date, wau_users long")
    r = weekly_summary(w).first()
    assert (r.week_count, r.start_week, r.end_week) == (2, D(2019, 9, 30), D(2019, 10, 7))


def test_week_filter_prunes_day_partitions(spark, out_dir):
    path = f"{out_dir}/events"
    _events(spark, [(1, "s", D(2019, 10, d), monday_of_date(D(2019, 10, d)), monday_of_date(D(2019, 10, d)))
                    for d in range(1, 29)]).write.partitionBy("event_date_kst").parquet(path)
    plan = plan_text(weekly_users(spark.read.parquet(path), "2019-10-07", "2019-10-14"), "formatted")
    # the day range implied by the weeks prunes directories; the week range reaches the parquet reader
    assert "(event_date_kst#" in plan and ">= 2019-10-07)" in plan and "<= 2019-10-20)]" in plan
    assert "PushedFilters: [IsNotNull(week_start_kst), GreaterThanOrEqual(week_start_kst,2019-10-07)" in plan
    assert "ReadSchema: struct<user_id:bigint,week_start_kst:date>" in plan


def monday_of_date(d):
    return d - dt.timedelta(days=d.weekday())


def test_sql_forms_equal_dataframe_forms(spark):
    from activitykit import weekly_sessions_sql, weekly_users_sql

    df = _events(
        spark,
        [(u, f"s{u}{d}", D(2019, 10, d), monday_of_date(D(2019, 10, d)), monday_of_date(D(2019, 10, d - (u % 2))))
         for u in range(1, 5) for d in range(2, 29, 3)],
    )
    df.createOrReplaceTempView("weekly_sql_fixture")
    for lo, hi in [(None, None), ("2019-10-07", None), (None, "2019-10-14"), ("2019-10-07", "2019-10-21")]:
        assert weekly_users_sql(spark, "weekly_sql_fixture", lo, hi).collect() == weekly_users(df, lo, hi).collect()
        assert (weekly_sessions_sql(spark, "weekly_sql_fixture", lo, hi).collect()
                == weekly_sessions(df, lo, hi).collect())
