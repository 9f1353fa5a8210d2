import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from activitykit import events_as_activity
from activitykit.plans.batch import BatchConfig, run_batch
from activitykit.plans.preflight import PreflightError
from activitykit.plans.quality import QualityGateError
from activitykit.plans.run_log import read_run_log
from activitykit.sources.versions import current, read_current


def _cfg(root, run_id, start, end, **kw):
    return BatchConfig(
        start_date=start,
        end_date=end,
        run_id=run_id,
        output_base_path=f"{root}/final",
        staging_base_path=f"{root}/staging",
        dlq_base_path=f"{root}/dlq",
        session_state_base_path=f"{root}/state",
        run_log_base_path=f"{root}/log",
        wau_output_base_path=f"{root}/wau",
        table_name=f"ae_{run_id.split('-')[0]}",
        wau_users_table=f"wu_{run_id.split('-')[0]}",
        weekly_sessions_table=f"ws_{run_id.split('-')[0]}",
        **kw,
    )


def _published(spark, root):
    return read_current(spark, f"{root}/final")


def _weekly(spark, path, metric):
    return sorted((str(r.week_start_kst), r[metric]) for r in spark.read.parquet(path).collect())


@pytest.mark.parametrize("max_user_rows", [None, 9])
def test_two_runs_equal_one_run(spark, tmp_path, max_user_rows):
    raw = events_as_activity(spark, SF_SMALL, dirty=True)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    kw = dict(gap_seconds=21_600, max_user_rows=max_user_rows)
    tag = "n" if max_user_rows is None else "s"
    m = run_batch(spark, _cfg(one, f"one{tag}-1", "2024-01-01", "2024-01-31", **kw), raw)
    m1 = run_batch(spark, _cfg(two, f"two{tag}-1", "2024-01-01", "2024-01-15", **kw), raw)
    m2 = run_batch(spark, _cfg(two, f"two{tag}-2", "2024-01-16", "2024-01-31", **kw), raw)

    # balance equations of one run
    assert m["valid_row_count"] + m["invalid_row_count"] + m["out_of_range_row_count"] == m["input_row_count"]
    assert m["out_of_range_row_count"] == 0
    assert m["output_row_count"] == m["valid_row_count"] - m["dropped_duplicate_rows_count"]
    assert m["duplicate_rows_count"] - m["duplicate_group_count"] == m["dropped_duplicate_rows_count"]
    assert m["duplicate_group_count"] > 0 and m["invalid_row_count"] > 0
    assert m["quality_gate_warnings"]  # 2 % invalid: above the warning limit
    assert sum(m["invalid_reason_summary"].values()) == m["invalid_row_count"]
    pub = _published(spark, one)
    assert pub.count() == m["output_row_count"]
    assert pub.select("session_id").distinct().count() == m["unique_session_count"]
    assert m["output_partition_count"] == pub.select("event_date_kst").distinct().count() == 31
    assert m1["output_row_count"] + m2["output_row_count"] == m["output_row_count"]
    assert m1["input_row_count"] == m["input_row_count"]  # the input is not date-filtered
    assert m1["out_of_range_row_count"] > 0

    cols = ["raw_user_session", "session_id", "session_start_time_utc", "price", "event_date_kst"]
    a = sorted(tuple(r) for r in pub.select(*cols).collect())
    b = sorted(tuple(r) for r in _published(spark, two).select(*cols).collect())
    assert a == b

    for name, metric in [("wau-users-by-week", "wau_users"),
                         ("weekly-active-sessions-by-week", "weekly_active_sessions")]:
        assert _weekly(spark, f"{one}/wau/{name}", metric) == _weekly(spark, f"{two}/wau/{name}", metric)
    total = sum(v for _, v in _weekly(spark, f"{one}/wau/weekly-active-sessions-by-week", "weekly_active_sessions"))
    assert total == m["unique_session_count"]

    statuses = [r.status for r in read_run_log(spark, f"{one}/log", f"one{tag}-1").collect()]
    assert statuses == ["RUNNING", "NORMALIZING", "VALIDATING", "DEDUPLICATING", "SESSIONIZING", "PROMOTING",
                        "REGISTERING_HIVE", "COMPUTING_WAU", "SUCCESS"]
    assert spark.table(f"ae_one{tag}").count() == m["output_row_count"]
    assert spark.table(f"wu_one{tag}").agg(F.count(F.lit(1))).first()[0] == 5


def test_failures_are_logged_and_nothing_published(spark, tmp_path):
    root = str(tmp_path)
    raw = events_as_activity(spark, SF_SMALL, dirty=True)
    dirty = raw.withColumn("price", -F.abs("price"))  # every row invalid → gate fails
    with pytest.raises(QualityGateError):
        run_batch(spark, _cfg(root, "bad-1", "2024-01-01", "2024-01-31"), dirty)
    log = read_run_log(spark, f"{root}/log", "bad-1").collect()
    assert log[-1].status == "FAILED" and "output_row_count" in log[-1].message
    assert current(spark, f"{root}/final").days == {}
    # the run id is now used: a second attempt is refused by preflight
    with pytest.raises(PreflightError, match="already has a dead-letter folder"):
        run_batch(spark, _cfg(root, "bad-1", "2024-01-01", "2024-01-31"), raw)


def test_batch_reads_csv_input(spark, tmp_path):
    from activitykit import write_activity_csv

    root = str(tmp_path)
    raw = events_as_activity(spark, SF_SMALL, dirty=True)
    write_activity_csv(raw, f"{root}/input")
    m = run_batch(spark, _cfg(root, "csv-1", "2024-01-01", "2024-01-31", input_path=f"{root}/input"))
    expected = run_batch(spark, _cfg(str(tmp_path / "df"), "dfr-1", "2024-01-01", "2024-01-31"), raw)
    keys = ["input_row_count", "invalid_row_count", "valid_row_count", "output_row_count", "unique_session_count",
            "duplicate_group_count", "output_partition_count"]
    assert {k: m[k] for k in keys} == {k: expected[k] for k in keys}
    with pytest.raises(PreflightError, match="no input at"):
        run_batch(spark, _cfg(root, "csv-2", "2024-01-01", "2024-01-31", input_path=f"{root}/missing"))


SOME = "event_time < '2024-01-09'"
STOPS = [("write_dlq", False), ("write_staging", True), ("repair_forward", True), ("save_snapshot", False), ("_weekly", True)]


@pytest.fixture(scope="module")
def whole_run(spark, tmp_path_factory):
    whole = str(tmp_path_factory.mktemp("whole"))
    return whole, run_batch(spark, _cfg(whole, "whole-1", "2024-01-01", "2024-01-08"), events_as_activity(spark, SF_SMALL, dirty=True).where(SOME))


@pytest.mark.parametrize("step,after", STOPS)
def test_a_stopped_run_resumes_to_the_same_result(spark, tmp_path, monkeypatch, whole_run, step, after):
    import dataclasses

    from activitykit.plans import batch

    raw = events_as_activity(spark, SF_SMALL, dirty=True).where(SOME)
    root, (whole, want) = str(tmp_path), whole_run
    cfg = _cfg(root, f"stop{step.strip('_')}-1", "2024-01-01", "2024-01-08")
    act = getattr(batch, step)

    def stop(*args, **kw):
        if after:
            act(*args, **kw)
        raise OSError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(batch, step, stop)
        with pytest.raises(OSError):
            run_batch(spark, cfg, raw)
    with pytest.raises(PreflightError, match="already has"):
        run_batch(spark, cfg, raw)
    again = dataclasses.replace(cfg, resume=True)
    with pytest.raises(PreflightError, match="another range"):
        run_batch(spark, dataclasses.replace(again, end_date="2024-01-09"), raw)
    got = run_batch(spark, again, raw)
    counts = [k for k in want if k.endswith("_count") or k in ("dlq_ratio", "invalid_reason_summary", "quality_gate_warnings")]
    assert {k: got[k] for k in counts} == {k: want[k] for k in counts}
    cols = ["raw_user_session", "session_id", "price", "event_date_kst"]
    assert sorted(map(tuple, _published(spark, root).select(*cols).collect())) == sorted(map(tuple, _published(spark, whole).select(*cols).collect()))
    with pytest.raises(PreflightError, match="has succeeded"):
        run_batch(spark, again, raw)
    seqs = [r.seq for r in read_run_log(spark, f"{root}/log", cfg.run_id).collect()]
    assert seqs == list(range(1, len(seqs) + 1))


def test_counts_survive_lost_shuffle_files(spark, tmp_path, monkeypatch, whole_run):
    """A reduce task finds shuffle files gone, so the map tasks before it run a second time."""
    import glob
    import os

    from activitykit.plans import batch

    folders = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()]
    begun, mark = str(tmp_path / "begun"), str(tmp_path / "lost")
    layout = batch.to_table_layout

    def lose(user):
        if not os.path.exists(mark):
            gone = [p for d in folders for p in glob.glob(f"{d}/*/shuffle_*") if os.stat(p).st_mtime >= os.stat(begun).st_mtime]
            for path in gone:
                os.remove(path)
            with open(mark, "w") as f:
                f.write(str(len(gone)))
        return True

    monkeypatch.setattr(batch, "to_table_layout", lambda df, extra=None: layout(df.where(F.udf(lose, "boolean")("user_id")), extra))
    open(begun, "w").close()
    raw = events_as_activity(spark, SF_SMALL, dirty=True).where(SOME)
    got = run_batch(spark, _cfg(str(tmp_path / "lossy"), "lossy-1", "2024-01-01", "2024-01-08"), raw)
    assert int(open(mark).read()) > 0
    want = whole_run[1]
    counts = [k for k in want if k.endswith("_count")]
    assert {k: got[k] for k in counts} == {k: want[k] for k in counts}
