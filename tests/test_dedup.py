from conftest import plan_text, raw_row

from activitykit import deduplicate, duplicate_metrics, normalize


def _five(raw):
    return normalize(
        raw(
            [
                raw_row(event_time="2019-10-01 00:00:00 UTC", user_session="session-a"),
                raw_row(event_time="2019-10-01 00:00:00 UTC", user_session="session-a"),
                raw_row(event_time="2019-10-01 00:00:00 UTC", user_session="session-b"),
                raw_row(event_time="2019-10-01 00:00:01 UTC", user_session="session-c"),
                raw_row(event_time="2019-10-01 00:00:00 UTC", event_type="purchase", user_session="session-d"),
            ]
        ),
        "r",
    )


def test_exact_duplicates_removed_session_differences_kept(spark, raw):
    result = deduplicate(_five(raw))
    rows = result.deduplicated.collect()
    assert len(rows) == 4
    keys = [r.dedup_key for r in rows]
    assert len(set(keys)) == 4 and all(len(k) == 64 for k in keys)
    assert sorted(r.raw_user_session for r in rows) == ["session-a", "session-b", "session-c", "session-d"]
    groups = result.duplicate_groups.collect()
    assert [(g.duplicate_group_size, g.dropped_duplicate_row_count) for g in groups] == [(2, 1)]
    m = duplicate_metrics(result.duplicate_groups).first()
    assert (m.duplicate_group_count, m.duplicate_rows_count, m.dropped_duplicate_rows_count) == (1, 2, 1)


def test_metrics_zero_not_null_without_duplicates(spark, raw):
    df = normalize(raw([raw_row(user_session="x")]), "r")
    m = duplicate_metrics(deduplicate(df).duplicate_groups).first()
    assert (m.duplicate_group_count, m.duplicate_rows_count, m.dropped_duplicate_rows_count) == (0, 0, 0)


def test_survivor_is_deterministic(spark, raw):
    # Same key (prices round to the same cents): the lower raw price survives.
    rows = [raw_row(price=10.554, user_session="s"), raw_row(price=10.551, user_session="s")]
    for order in (rows, rows[::-1]):
        out = deduplicate(normalize(raw(order), "r")).deduplicated.collect()
        assert len(out) == 1 and out[0].price == 10.551


def test_column_order_is_normalized_plus_key(spark, raw):
    df = _five(raw)
    assert deduplicate(df).deduplicated.columns == df.columns + ["dedup_key"]


def test_hot_key_is_partially_aggregated(spark, raw):
    df = normalize(raw([raw_row()] * 50), "r").repartition(8)
    out = deduplicate(df).deduplicated
    assert out.count() == 1
    plan = plan_text(out)
    # a map-side partial aggregate precedes the shuffle on dedup_key
    assert plan.index("partial_min") > plan.index("Exchange hashpartitioning(dedup_key")
