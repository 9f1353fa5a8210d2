import datetime as dt
import os

import pytest

from activitykit.sources import catalog
from activitykit.sources.publish import publish_partitions, spark_copy

DAY = "2019-10-01"


def _values(spark, path):
    return sorted(r.value for r in spark.read.parquet(path).collect())


def _setup(spark, root):
    staging, final = f"{root}/staging", f"{root}/final"
    spark.createDataFrame([("old", DAY)], "value string, event_date_kst string").write.partitionBy(
        "event_date_kst").parquet(final)
    spark.createDataFrame([("new-1", DAY), ("new-2", DAY)], "value string, event_date_kst string").write.partitionBy(
        "event_date_kst").parquet(staging)
    return staging, final


def test_replace_keeps_staging(spark, out_dir):
    staging, final = _setup(spark, out_dir)
    paths = publish_partitions(spark, staging, final, [DAY, DAY])
    assert paths == [f"{final}/event_date_kst={DAY}"]
    assert _values(spark, f"{final}/event_date_kst={DAY}") == ["new-1", "new-2"]
    assert _values(spark, f"{staging}/event_date_kst={DAY}") == ["new-1", "new-2"]
    assert not os.path.exists(f"{final}/.promote-backup/event_date_kst={DAY}")
    assert sorted(r.value for r in spark.read.parquet(final).collect()) == ["new-1", "new-2"]


def test_retry_once_then_succeed(spark, out_dir):
    staging, final = _setup(spark, out_dir)
    calls = []

    def flaky(s, src, dst):
        calls.append(dst)
        if len(calls) == 1:
            raise OSError("injected")
        spark_copy(s, src, dst)

    publish_partitions(spark, staging, final, [DAY], copy=flaky)
    assert [c.rsplit("/", 1)[1] for c in calls] == ["attempt-01", "attempt-02"]
    assert _values(spark, f"{final}/event_date_kst={DAY}") == ["new-1", "new-2"]


def test_rollback_restores_old(spark, out_dir):
    staging, final = _setup(spark, out_dir)

    def broken(s, src, dst):
        raise OSError("injected")

    with pytest.raises(RuntimeError, match=f"failed to promote partition after 2 attempt\\(s\\): {DAY}"):
        publish_partitions(spark, staging, final, [DAY], max_retries=2, copy=broken)
    assert _values(spark, f"{final}/event_date_kst={DAY}") == ["old"]
    with pytest.raises(ValueError):
        publish_partitions(spark, staging, final, [DAY], max_retries=0)
    with pytest.raises(FileNotFoundError):
        publish_partitions(spark, staging, final, ["2019-10-02"])


def test_move_mode_consumes_staging(spark, out_dir):
    staging, final = _setup(spark, out_dir)
    publish_partitions(spark, staging, final, [DAY], move=True)
    assert _values(spark, f"{final}/event_date_kst={DAY}") == ["new-1", "new-2"]
    assert not os.path.exists(f"{staging}/event_date_kst={DAY}")


def test_rename_that_fails_after_copying_loses_nothing(spark, out_dir, monkeypatch):
    """As on stores where a rename copies and then deletes: the delete breaks off half way."""
    import shutil

    from activitykit.sources import fs

    staging, final = f"{out_dir}/staging", f"{out_dir}/final"
    spark.range(100).repartition(4).selectExpr("id", f"'{DAY}' event_date_kst").write.partitionBy("event_date_kst").parquet(staging)
    whole = fs.rename

    def broken(s, src, dst):
        if "/staging/" not in src:
            return whole(s, src, dst)
        shutil.copytree(src, dst)
        os.remove(next(f"{src}/{x}" for x in sorted(os.listdir(src)) if x.startswith("part-")))
        raise OSError("injected")

    monkeypatch.setattr(fs, "rename", broken)
    publish_partitions(spark, staging, final, [DAY], move=True)
    assert spark.read.parquet(f"{final}/event_date_kst={DAY}").count() == 100


def test_activity_table_registration_and_repoint(spark, out_dir):
    name = "t_activity_events"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = ", ".join(f"CAST(NULL AS {t}) AS {c}" for c, t in catalog.ACTIVITY_TABLE_COLUMNS if c != "event_date_kst")
    one = spark.sql(f"SELECT {cols}, DATE '{DAY}' AS event_date_kst").drop("event_date_kst")
    a, b = f"{out_dir}/a", f"{out_dir}/b"
    one.write.parquet(f"{a}/event_date_kst={DAY}")
    one.unionByName(one).write.parquet(f"{b}/event_date_kst={DAY}")
    catalog.create_activity_table(spark, name, a)
    catalog.create_activity_table(spark, name, a)  # idempotent
    assert spark.table(name).count() == 0  # nothing registered yet
    assert catalog.add_partitions(spark, name, a, [DAY, DAY]) == [DAY]
    assert spark.table(name).count() == 1
    catalog.add_partitions(spark, name, b, [DAY])
    assert spark.table(name).count() == 2
    assert spark.table(name).select("price").schema.fields[0].dataType.simpleString() == "decimal(18,2)"


def test_weekly_table_registration(spark, out_dir):
    name = "t_wau"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    path = f"{out_dir}/wau"
    from activitykit.sources.sinks import write_weekly

    write_weekly(spark.createDataFrame([(dt.date(2019, 9, 30), 2)], "week_start_kst date, wau_users long"), path)
    catalog.create_weekly_table(spark, name, "wau_users", path)
    catalog.add_week_partitions(spark, name, path, ["2019-09-30"])
    assert [tuple(r) for r in spark.table(name).collect()] == [(2, dt.date(2019, 9, 30))]
    write_weekly(spark.createDataFrame([(dt.date(2019, 9, 30), 3), (dt.date(2019, 10, 7), 4)],
                                       "week_start_kst date, wau_users long"), path)
    catalog.add_week_partitions(spark, name, path, ["2019-09-30", "2019-10-07"])
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(3, dt.date(2019, 9, 30)), (4, dt.date(2019, 10, 7))]
