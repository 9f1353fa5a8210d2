"""Plan properties that matter at scale (checked on the physical plan, not on data)."""

from conftest import SF_MID, plan_text

from activitykit import build_snapshot, sessionize, user_activity_stats, weekly_sessions
from activitykit.plans.registry import deduplicated, sessionized, valid_invalid


def _lines(plan, word):
    return [line for line in plan.splitlines() if word in line]


def test_hot_path_leaves_broadcasts_to_spark(spark):
    dedup = deduplicated(spark, SF_MID)
    stats = user_activity_stats(valid_invalid(spark, SF_MID).valid)
    # the hot users are a written table: Spark knows its size and broadcasts it while it is small
    small = plan_text(sessionize(dedup, user_stats=stats, max_user_rows=20))
    assert _lines(small, "BroadcastHashJoin")
    # no hint forces a broadcast
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        big = plan_text(sessionize(dedup, user_stats=stats, max_user_rows=20))
    finally:
        spark.conf.set(key, old)
    assert not _lines(big, "BroadcastExchange") and _lines(big, "SortMergeJoin")


def test_weekly_users_shuffle_only_what_they_need(spark):
    from activitykit import weekly_users

    plan = plan_text(weekly_users(sessionized(spark, SF_MID)))
    assert not _lines(plan, "SortAggregate")
    shuffled = [line for line in plan.splitlines() if "partial_first" in line]
    assert shuffled and not any("category_code" in line.split("functions=")[1] for line in shuffled)


def test_snapshot_and_weekly_aggregate_before_shuffling(spark):
    sess = sessionized(spark, SF_MID)
    snap = plan_text(build_snapshot(sess, "d", "r"))
    assert "partial_max(struct(event_time_utc" in snap
    weekly = plan_text(weekly_sessions(sess))
    # partial distinct on (session, week) before the (session, week) shuffle
    agg = [line for line in weekly.splitlines() if "HashAggregate(keys=[session_id" in line]
    assert len(agg) == 2
