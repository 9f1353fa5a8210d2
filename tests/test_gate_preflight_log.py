import datetime as dt
import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from activitykit.plans.preflight import PreflightError, preflight, problems
from activitykit.plans.quality import QualityGateError, evaluate, gate_of_metrics
from activitykit.plans.run_log import RunLog, read_run_log


@pytest.mark.parametrize(
    "inp, out, ratio, expect",
    [
        (1000, 990, 0.005, "PASS"),
        (1000, 980, 0.015, "WARN"),
        (1000, 0, 0.0, "output_row_count"),
        (1000, 920, 0.07, "dlq_ratio must be"),
        (1000, 990, 0.01, "PASS"),
        (1000, 950, 0.05, "WARN"),
        (0, 0, 0.0, "input_row_count"),
    ],
)
def test_gate_cases(spark, inp, out, ratio, expect):
    if expect in ("PASS", "WARN"):
        res = evaluate(inp, out, ratio, {})
        assert bool(res.warnings) is (expect == "WARN")
        if res.warnings:
            assert res.warnings == [f"dlq_ratio warning: {ratio:.4f}"]
    else:
        with pytest.raises(QualityGateError, match=expect):
            evaluate(inp, out, ratio, {})
    # the Column form gives the same verdict
    row = gate_of_metrics(
        spark.createDataFrame([(inp, out, 0, ratio)],
                              "input_row_count long, output_row_count long, invalid_event_time_count long, dlq_ratio double")
    ).first()
    assert row.gate_status == (expect if expect in ("PASS", "WARN") else "FAIL")


def test_gate_bad_time_counts_combined_reasons():
    with pytest.raises(QualityGateError, match="event_time"):
        evaluate(10, 1, 0.0, {"INVALID_EVENT_TIME": 4, "INVALID_EVENT_TIME|NULL_USER_ID": 6})


def _cfg(tmp, **kw):
    base = dict(
        start_date="2019-10-01",
        end_date="2019-10-31",
        run_id="run-1",
        input_path=f"{tmp}/input",
        output_base_path=f"{tmp}/final",
        staging_base_path=f"{tmp}/staging",
        dlq_base_path=f"{tmp}/dlq",
        run_log_base_path=f"{tmp}/log",
    )
    base.update(kw)
    return SimpleNamespace(**base)


def test_problems_are_listed_together(spark, out_dir):
    os.makedirs(f"{out_dir}/input")
    today = dt.date(2023, 5, 4)
    span = dict(start_date="2023-05-01", end_date="2023-05-03")
    assert problems(spark, _cfg(out_dir, **span), today) == []
    bad = _cfg(out_dir, start_date="2023/05/01", end_date="2023-05-09", input_path=f"{out_dir}/none", output_base_path=" ")
    found = problems(spark, bad, today)
    assert len(found) == 4 and "start_date is not" in found[0] and "end_date lies in the future" in found[1]
    assert "ends before it starts" in problems(spark, _cfg(out_dir, start_date="2023-05-03", end_date="2023-05-02"), today)[0]
    for folder in ("staging", "dlq", "log"):
        os.makedirs(f"{out_dir}/{folder}/run_id={folder}-1")
        with pytest.raises(PreflightError, match=f"run_id {folder}-1 already has"):
            preflight(spark, _cfg(out_dir, run_id=f"{folder}-1", **span), today)
    preflight(spark, _cfg(out_dir, run_id="fresh", **span), today)


def test_run_log_history(spark, out_dir):
    log = RunLog(spark, f"{out_dir}/log", "run-1", "2019-10-01")
    log.log("RUNNING", staging_path="s", processing_start_date="2019-10-01")
    log.log("VALIDATING", input_row_count=10, invalid_reason_summary={"NULL_USER_ID": 2},
            quality_gate_warnings=["w"])
    hist = read_run_log(spark, f"{out_dir}/log", "run-1").collect()
    assert [r.status for r in hist] == ["RUNNING", "VALIDATING"]
    assert hist[0].staging_path == "s" and hist[0].input_row_count is None
    assert hist[1].input_row_count == 10 and hist[1].invalid_reason_summary == {"NULL_USER_ID": 2}
    text = spark.read.text(f"{out_dir}/log/run_id=run-1").collect()
    keys = set().union(*(json.loads(r.value).keys() for r in text))
    assert {"run_id", "target_date", "status", "started_at", "updated_at"} <= keys
    assert "output_partitions" not in keys and "valid_row_count" not in keys
    with pytest.raises(ValueError):
        log.log("X", not_a_field=1)
    assert read_run_log(spark, f"{out_dir}/log", "run-1").where(F.col("status") == "X").count() == 0


def test_failed_run_is_logged_with_its_message(spark, out_dir):
    from activitykit.plans.batch import BatchConfig, run_batch

    os.makedirs(f"{out_dir}/input")
    cfg = BatchConfig(start_date="2999-01-01", end_date="2999-01-02", run_id="future-1",
                      input_path=f"{out_dir}/input", output_base_path=f"{out_dir}/final",
                      staging_base_path=f"{out_dir}/staging", dlq_base_path=f"{out_dir}/dlq",
                      session_state_base_path=f"{out_dir}/state", wau_output_base_path=f"{out_dir}/wau",
                      run_log_base_path=f"{out_dir}/log")
    with pytest.raises(PreflightError, match="lies in the future"):
        run_batch(spark, cfg)
    rec = read_run_log(spark, f"{out_dir}/log", "future-1").collect()
    assert [r.status for r in rec] == ["FAILED"]
    assert "start_date lies in the future" in rec[0].message and "end_date lies in the future" in rec[0].message
    assert rec[0].processing_start_date == "2999-01-01" and rec[0].snapshot_seed_date == "2998-12-31"
    assert rec[0].input_row_count is None


def test_history_over_runs_and_compaction(spark, out_dir, monkeypatch):
    from activitykit.plans.run_log import compact_history, journal, read_history
    from activitykit.sources import fs

    base = f"{out_dir}/log"
    assert read_history(spark, base).count() == 0 and compact_history(spark, base) == []

    def run(run_id, *statuses):
        log = RunLog(spark, base, run_id, "2019-10-01")
        for status in statuses:
            log.log(status, input_row_count=7, invalid_reason_summary={"NULL_USER_ID": 2, "INVALID_PRICE": 1})

    def rows():
        return sorted((r.run_id, r.seq, r.status, r.invalid_reason_summary["NULL_USER_ID"]) for r in read_history(spark, base).collect())

    run("a", "RUNNING", "SUCCESS")
    run("b", "RUNNING", "FAILED")
    want = [("a", 1, "RUNNING", 2), ("a", 2, "SUCCESS", 2), ("b", 1, "RUNNING", 2), ("b", 2, "FAILED", 2)]
    assert rows() == want
    with monkeypatch.context() as patch:  # the driver stops before the first record file goes
        def stop(*args):
            raise OSError("driver lost")

        patch.setattr(fs, "delete", stop)
        with pytest.raises(OSError):
            compact_history(spark, base)
    assert rows() == want
    assert compact_history(spark, base) == ["a"] and rows() == want
    assert [n for n in os.listdir(f"{base}/run_id=a") if not n.startswith(".")] == ["compacted.json"]
    assert sorted(journal(spark, base, "b")) == ["FAILED", "RUNNING"]  # may still be resumed
    run("c", "RUNNING", "SUCCESS")
    assert compact_history(spark, base) == ["c"] and compact_history(spark, base) == []
    assert rows() == want + [("c", 1, "RUNNING", 2), ("c", 2, "SUCCESS", 2)]
    reasons = read_history(spark, base).where("status = 'SUCCESS'").select("run_id", F.explode("invalid_reason_summary").alias("reason", "n"))
    assert {(r.reason, r.n) for r in reasons.collect()} == {("NULL_USER_ID", 2), ("INVALID_PRICE", 1)}
