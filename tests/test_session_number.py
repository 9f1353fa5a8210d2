"""The session number by two-level sums equals the plain running count of opened sessions."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from activitykit import build_snapshot, deduplicate, normalize, sessionize, validate, with_session_number
from activitykit.schema import SESSION_ORDER
from tests.conftest import plan_text, raw_row


def _rows(n, users=5, seed=3, base="2019-10-01 00:00:00", span=4 * 86_400):
    rnd = random.Random(seed)
    start = dt.datetime.fromisoformat(base)
    return [
        raw_row(
            event_time=(start + dt.timedelta(seconds=rnd.randrange(span))).strftime("%Y-%m-%d %H:%M:%S UTC"),
            user_id=0 if rnd.random() < 0.6 else rnd.randrange(users),
            user_session=f"s{i}",
        )
        for i in range(n)
    ]


def _dedup(raw, rows):
    return deduplicate(validate(normalize(raw(rows), "r"), "2019-10-01").valid).deduplicated


@pytest.mark.parametrize("range_seconds", [60, 7_000, 86_400])
@pytest.mark.parametrize("max_user_rows", [None, 20])
def test_equals_running_sum(spark, raw, range_seconds, max_user_rows):
    sess = sessionize(_dedup(raw, _rows(600)), gap_seconds=900, max_user_rows=max_user_rows, with_session_opened=True)
    order = Window.partitionBy("user_id").orderBy(*SESSION_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    want = sess.withColumn("session_number", F.sum(F.col("session_opened").cast("long")).over(order))
    got = with_session_number(sess, range_seconds)
    assert got.columns == want.columns
    cols = ["dedup_key", "session_id", "session_number"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


def test_a_continued_session_is_the_first(spark, raw):
    first = sessionize(_dedup(raw, [raw_row(user_session="a")]))
    later = [raw_row(event_time="2019-10-01 00:02:00 UTC", user_session="b"), raw_row(event_time="2019-10-01 01:00:00 UTC", user_session="c")]
    second = sessionize(_dedup(raw, later), build_snapshot(first, "2019-10-01", "r"))
    got = {r.raw_user_session: r.session_number for r in with_session_number(second).collect()}
    assert got == {"b": 1, "c": 2}


def test_empty_input_and_windows_hold_sessions_only(spark, raw):
    sess = sessionize(_dedup(raw, _rows(50)), max_user_rows=None)
    assert with_session_number(sess.where("false")).isEmpty()
    written = spark.createDataFrame(sess.collect(), sess.schema)
    windows = [line for line in plan_text(with_session_number(written)).split("\n") if "Window [" in line]
    assert windows and all("product_id" not in line and "dedup_key" not in line for line in windows)
    with pytest.raises(ValueError):
        with_session_number(sess, 0)
