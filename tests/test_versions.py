"""O8 by pointer: whatever step a publication stops at, readers see the old days or the new ones."""

import os

import pytest

from activitykit.schema import ACTIVITY_TABLE_COLUMNS
from activitykit.sources import catalog, fs, versions

DAYS = ["2019-10-01", "2019-10-02", "2019-10-03"]


def _write(spark, base, version, value, days):
    cols = [f"CAST(NULL AS {t}) AS {c}" for c, t in ACTIVITY_TABLE_COLUMNS if c not in ("brand", "event_date_kst")]
    for day in days:
        one = spark.sql(f"SELECT {', '.join(cols)}, '{value}' AS brand")
        one.unionByName(one).write.parquet(versions.day_path(base, version, day))


def _by_manifest(spark, base):
    return sorted((str(r.event_date_kst), r.brand) for r in versions.read_current(spark, base).select("event_date_kst", "brand").collect())


def _by_table(spark, name):
    spark.catalog.refreshTable(name)
    return sorted((str(r.event_date_kst), r.brand) for r in spark.table(name).select("event_date_kst", "brand").collect())


def _rows(**days):
    return sorted((d.replace("_", "-").removeprefix("d"), v) for d, v in days.items() for _ in range(2))


OLD = [(d, "old") for d in DAYS[:2] for _ in range(2)]
NEW = [(d, v) for d, v in zip(DAYS, ["old", "new", "new"]) for _ in range(2)]


class Stop(Exception):
    pass


def _table(spark, base, name):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    _write(spark, base, "a", "old", DAYS[:2])
    catalog.create_activity_table(spark, name, base)
    versions.publish_version(spark, base, "a", table=name)
    _write(spark, base, "b", "new", DAYS[1:])


def _stops(monkeypatch, at, after):
    """Lets the driver stop at the ``at``-th step that changes anything, before or after it acts."""
    seen = []

    def wrap(module, name):
        whole = getattr(module, name)

        def step(*args, **kw):
            seen.append(name)
            mine = len(seen) == at
            if mine and not after:
                raise Stop
            out = whole(*args, **kw)
            if mine:
                raise Stop
            return out

        monkeypatch.setattr(module, name, step)

    wrap(fs, "create_new")
    wrap(catalog, "set_location")
    wrap(catalog, "point_partitions")
    return seen


@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("at", [1, 2, 3])
def test_stopping_at_any_step_shows_old_or_new(spark, out_dir, monkeypatch, at, after):
    base, name = f"{out_dir}/table", f"t_stop_{at}_{int(after)}"
    _table(spark, base, name)
    assert _by_manifest(spark, base) == _by_table(spark, name) == OLD
    files = {os.path.join(p, f) for p, _, fs_ in os.walk(base) for f in fs_}
    with monkeypatch.context() as patch:
        seen = _stops(patch, at, after)
        with pytest.raises(Stop):
            versions.publish_version(spark, base, "b", table=name)
        assert len(seen) >= at
    assert _by_manifest(spark, base) == (OLD if at == 1 and not after else NEW)
    shown = dict(_by_table(spark, name))
    assert all(shown[d] in ("old", "new") for d in shown) and shown[DAYS[0]] == "old" and len(_by_table(spark, name)) == 2 * len(shown)
    # nothing that was there has moved, and going on again ends at the new days
    assert files <= {os.path.join(p, f) for p, _, fs_ in os.walk(base) for f in fs_}
    versions.publish_version(spark, base, "b", table=name)
    assert _by_manifest(spark, base) == _by_table(spark, name) == NEW


def test_half_written_manifest_does_not_count(spark, out_dir):
    base = f"{out_dir}/table"
    _write(spark, base, "a", "old", DAYS[:2])
    versions.publish_version(spark, base, "a")
    with open(f"{base}/_manifests/000000000002.json", "w") as f:
        f.write('{"days": {"2019-')
    assert versions.current(spark, base).number == 1 and _by_manifest(spark, base) == OLD
    _write(spark, base, "b", "new", DAYS[1:])
    versions.publish_version(spark, base, "b")
    assert versions.current(spark, base).number == 3 and _by_manifest(spark, base) == NEW


def test_racing_publishers_lose_no_day(spark, out_dir, monkeypatch):
    base = f"{out_dir}/table"
    _write(spark, base, "a", "old", DAYS[:2])
    _write(spark, base, "b", "new", DAYS[2:])
    whole, raced = fs.create_new, []

    def late(s, path, text):
        if not raced:
            raced.append(path)
            versions.commit(s, base, "b", DAYS[2:])  # the other one is first
        return whole(s, path, text)

    monkeypatch.setattr(fs, "create_new", late)
    versions.commit(spark, base, "a", DAYS[:2])
    assert sorted(versions.current(spark, base).days) == DAYS and versions.current(spark, base).number == 2
    monkeypatch.setattr(fs, "create_new", lambda *a: False)
    _write(spark, base, "c", "new", DAYS[:1])
    with pytest.raises(RuntimeError, match="failed to publish version c after 2 attempt"):
        versions.commit(spark, base, "c", DAYS[:1], max_retries=2)


def test_contract(spark, out_dir):
    base = f"{out_dir}/table"
    _write(spark, base, "a", "old", DAYS[:2])
    with pytest.raises(ValueError):
        versions.publish_version(spark, base, "a", max_retries=0)
    with pytest.raises(FileNotFoundError):
        versions.publish_version(spark, base, "a", [DAYS[0], DAYS[2]])
    assert versions.current(spark, base) == versions.Manifest()
    assert versions.read_current(spark, base).count() == 0
    paths = versions.publish_version(spark, base, "a", [DAYS[1], DAYS[0], DAYS[1]])
    assert paths == [versions.day_path(base, "a", d) for d in DAYS[:2]]
    entry = versions.current(spark, base).days[DAYS[0]]
    assert entry["rows"] == 2 and entry["version"] == "a" and entry["files"] >= 1 and entry["bytes"] > 0
    versions.publish_version(spark, base, "a")
    assert versions.current(spark, base).number == 1  # nothing new: no new manifest
    assert versions.read_current(spark, base, [DAYS[1]]).count() == 2


def test_expired_versions_go_and_live_ones_stay(spark, out_dir):
    base = f"{out_dir}/table"
    for version, days in [("a", DAYS[:2]), ("b", DAYS[1:]), ("c", DAYS[1:2])]:
        _write(spark, base, version, version, days)
        versions.publish_version(spark, base, version)
    _write(spark, base, "working", "x", DAYS[:1])  # a run that has not published yet
    assert versions.expire(spark, base, keep=2) == [versions.day_path(base, "a", DAYS[1])]
    assert versions.expire(spark, base, keep=1) == [versions.day_path(base, "b", DAYS[1])]
    assert versions.expire(spark, base, keep=1) == []
    assert dict(_by_manifest(spark, base)) == {DAYS[0]: "a", DAYS[1]: "c", DAYS[2]: "b"}
    assert os.path.exists(versions.day_path(base, "working", DAYS[0]))
