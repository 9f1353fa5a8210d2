from conftest import raw_row

from activitykit.streaming import StreamConfig, latest_state, process_micro_batch, read_sessions


def _rows(spark, path):
    return sorted(
        (r.raw_user_session, r.session_start_time_utc.strftime("%H:%M:%S"), r.batch_id)
        for r in read_sessions(spark, path).collect()
    )


def test_state_carries_and_retries_are_idempotent(spark, raw, out_dir):
    cfg = StreamConfig(f"{out_dir}/out", f"{out_dir}/state", f"{out_dir}/dlq", fallback_target_date="2019-10-01")
    b0 = raw([raw_row(event_time="2019-10-01 14:58:00 UTC", user_session="a"),
              raw_row(event_time="2019-10-01 14:59:00 UTC", user_id=4001, user_session="x")])
    b1 = raw([raw_row(event_time="2019-10-01 15:02:00 UTC", user_session="b"),
              raw_row(event_time="2019-10-01 15:20:00 UTC", user_session="c"),
              raw_row(event_time="bad-time", user_session="bad")])
    b2 = raw([raw_row(event_time="2019-10-01 15:03:00 UTC", user_id=4001, user_session="y")])
    process_micro_batch(b0, 0, cfg)
    process_micro_batch(b1, 1, cfg)
    process_micro_batch(b1, 1, cfg)  # a retried batch rewrites, never duplicates
    process_micro_batch(b2, 2, cfg)
    assert _rows(spark, cfg.output_path) == [
        ("a", "14:58:00", 0),
        ("b", "14:58:00", 1),  # continued from batch 0 through the state
        ("c", "15:20:00", 1),
        ("x", "14:59:00", 0),
        ("y", "14:59:00", 2),  # user 4001 was idle in batch 1 and still continues
    ]
    state = latest_state(spark, cfg.state_path, 3)
    assert state.count() == 2
    import os

    assert sorted(os.listdir(cfg.state_path)) == ["batch_id=1", "batch_id=2"]
    dlq = spark.read.parquet(cfg.dlq_path).collect()
    assert [(r.raw_user_session, r.reject_reason, str(r.target_date)) for r in dlq] == [
        ("bad", "INVALID_EVENT_TIME", "2019-10-01")]


def test_state_survives_an_empty_batch(spark, raw, out_dir):
    cfg = StreamConfig(f"{out_dir}/out", f"{out_dir}/state", f"{out_dir}/dlq", fallback_target_date="2019-10-01")
    process_micro_batch(raw([raw_row(event_time="2019-10-01 14:58:00 UTC", user_session="a")]), 0, cfg)
    process_micro_batch(raw([]), 1, cfg)  # nothing arrived: no state written
    b2 = raw([raw_row(event_time="2019-10-01 15:01:00 UTC", user_session="b")])
    process_micro_batch(b2, 2, cfg)
    process_micro_batch(b2, 2, cfg)  # retried after its state was written
    assert _rows(spark, cfg.output_path) == [("a", "14:58:00", 0), ("b", "14:58:00", 2)]


def test_batch_of_invalid_rows_alone(spark, raw, out_dir):
    cfg = StreamConfig(f"{out_dir}/out", f"{out_dir}/state", f"{out_dir}/dlq", fallback_target_date="2021-03-04")
    process_micro_batch(raw([raw_row(event_time="2021-03-04 05:00:00 UTC", user_session="p")]), 0, cfg)
    process_micro_batch(raw([raw_row(event_time="no time", user_session="q")]), 1, cfg)
    process_micro_batch(raw([raw_row(event_time="2021-03-04 05:04:00 UTC", user_session="r")]), 2, cfg)
    assert _rows(spark, cfg.output_path) == [("p", "05:00:00", 0), ("r", "05:00:00", 2)]


def test_late_rows_do_not_set_the_state_back(spark, raw, out_dir):
    cfg = StreamConfig(f"{out_dir}/out", f"{out_dir}/state", f"{out_dir}/dlq", fallback_target_date="2021-03-04")
    for k, at in enumerate(("10:00:00", "08:00:00", "10:02:00")):
        process_micro_batch(raw([raw_row(event_time=f"2021-03-04 {at} UTC", user_session=str(k))]), k, cfg)
    assert _rows(spark, cfg.output_path) == [("0", "10:00:00", 0), ("1", "08:00:00", 1), ("2", "10:00:00", 2)]


def test_idle_users_leave_the_state(spark, raw, out_dir):
    import pytest

    def run(name, retention):
        cfg = StreamConfig(f"{out_dir}/{name}/out", f"{out_dir}/{name}/state", f"{out_dir}/{name}/dlq", fallback_target_date="2021-03-04", state_retention_seconds=retention)
        for k in range(5):  # a new user every ten minutes, one who comes each time within the gap
            rows = [raw_row(event_time=f"2021-03-04 10:{10 * k:02d}:00 UTC", user_id=k, user_session=f"u{k}")]
            rows += [raw_row(event_time=f"2021-03-04 10:{10 * k + m:02d}:00 UTC", user_id=99, user_session=f"s{k}-{m}") for m in (0, 4, 8)]
            process_micro_batch(raw(rows), k, cfg)
        process_micro_batch(raw([raw_row(event_time="none", user_session="bad")]), 5, cfg)
        return _rows(spark, cfg.output_path), sorted(r.user_id for r in latest_state(spark, cfg.state_path, 6).collect())

    rows, state = run("all", None)
    kept_rows, kept = run("recent", 600)
    assert rows == kept_rows
    assert state == [0, 1, 2, 3, 4, 99] and kept == [4, 99]
    with pytest.raises(ValueError, match="must not be below gap_seconds"):
        StreamConfig("o", "s", "d", gap_seconds=300, state_retention_seconds=299)
