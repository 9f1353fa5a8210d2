import datetime as dt
import json
from decimal import Decimal

from conftest import plan_text, raw_row

from activitykit import filter_kst_range, normalize, validate


def test_normalize_kst_week_price_rename(spark, raw):
    df = normalize(raw([raw_row(product_id=1001, category_id=2002, category_code="electronics.smartphone",
                                brand="apple", user_id=3003, user_session="raw-session-1")]), "run-1")
    r = df.first()
    assert r.event_time_utc == dt.datetime(2019, 10, 1, 0, 0)
    assert r.event_time_kst == dt.datetime(2019, 10, 1, 9, 0)
    assert r.event_date_kst == dt.date(2019, 10, 1)
    assert r.week_start_kst == dt.date(2019, 9, 30)
    assert r.normalized_price == Decimal("10.50")
    assert r.raw_user_session == "raw-session-1"
    assert "user_session" not in df.columns
    assert r.ingested_at is not None
    assert r.run_id == "run-1"


def test_week_start_on_monday_and_sunday(spark, raw):
    rows = [raw_row(event_time=t) for t in
            ["2019-09-30 00:00:00 UTC", "2019-10-06 14:59:59 UTC", "2019-10-06 15:00:00 UTC"]]
    got = [r.week_start_kst for r in normalize(raw(rows), "r").orderBy("event_time_utc").collect()]
    assert got == [dt.date(2019, 9, 30), dt.date(2019, 9, 30), dt.date(2019, 10, 7)]


def test_bad_inputs_become_null_not_errors(spark, raw):
    rows = [
        raw_row(event_time="bad-time", user_session="t"),
        raw_row(price=float("nan"), user_session="nan"),
        raw_row(price=1e20, user_session="big"),
        raw_row(price=10.555, user_session="round"),
    ]
    got = {r.raw_user_session: r for r in normalize(raw(rows), "r").collect()}
    assert got["t"].event_time_utc is None
    assert got["nan"].normalized_price is None
    assert got["big"].normalized_price is None
    assert got["round"].normalized_price == Decimal("10.56")


def test_validator_one_reason_each(spark, raw):
    rows = [
        raw_row(user_session="session-1"),
        raw_row(event_time="bad-time", user_session="session-2"),
        raw_row(user_id=None, user_session="session-3"),
        raw_row(event_type=None, user_session="session-4"),
        raw_row(product_id=None, user_session="session-5"),
        raw_row(price=-1.0, user_session="session-6"),
    ]
    valid, invalid = validate(normalize(raw(rows), "r"), "2019-10-01")
    assert [r.raw_user_session for r in valid.collect()] == ["session-1"]
    got = {r.raw_user_session: r for r in invalid.collect()}
    assert {k: v.reject_reason for k, v in got.items()} == {
        "session-2": "INVALID_EVENT_TIME",
        "session-3": "NULL_USER_ID",
        "session-4": "NULL_EVENT_TYPE",
        "session-5": "NULL_PRODUCT_ID",
        "session-6": "NEGATIVE_PRICE",
    }
    assert got["session-2"].target_date == "2019-10-01"
    assert got["session-3"].target_date == "2019-10-01"
    payload = json.loads(got["session-2"].raw_payload)
    assert payload["event_time"] == "bad-time"
    assert payload["raw_user_session"] == "session-2"
    assert "user_id" in payload
    assert "user_id" not in json.loads(got["session-3"].raw_payload)


def test_validator_multi_reason_and_price_edges(spark, raw):
    rows = [
        raw_row(event_time="bad-time", user_id=None, event_type=None, product_id=None, price=-0.001,
                user_session="all"),
        raw_row(price=None, user_session="null-price"),
        raw_row(price=float("nan"), user_session="nan-price"),
    ]
    valid, invalid = validate(normalize(raw(rows), "r"), "2019-10-05")
    assert sorted(r.raw_user_session for r in valid.collect()) == ["nan-price", "null-price"]
    r = invalid.first()
    assert r.reject_reason == "INVALID_EVENT_TIME|NULL_USER_ID|NULL_EVENT_TYPE|NULL_PRODUCT_ID|NEGATIVE_PRICE"
    assert r.target_date == "2019-10-05"
    assert valid.count() + invalid.count() == 3


def test_kst_range_excludes_next_kst_day(spark, raw):
    rows = [
        raw_row(event_time="2019-10-01 00:10:00 UTC", product_id=1),
        raw_row(event_time="2019-10-06 13:00:00 UTC", product_id=2),
        raw_row(event_time="2019-10-06 15:30:00 UTC", product_id=3),
    ]
    kept = filter_kst_range(normalize(raw(rows), "r"), "2019-10-01", "2019-10-06")
    assert sorted(r.product_id for r in kept.collect()) == [1, 2]


def test_range_filter_reaches_parquet_scan(spark, out_dir):
    path = f"{out_dir}/days"
    df = normalize(
        spark.createDataFrame([raw_row(event_time=f"2019-10-0{d} 00:00:00 UTC") for d in range(1, 8)],
                              "event_time string, event_type string, product_id long, category_id long, "
                              "category_code string, brand string, price double, user_id long, user_session string"),
        "r",
    )
    df.write.partitionBy("event_date_kst").parquet(path)
    plan = plan_text(filter_kst_range(spark.read.parquet(path), "2019-10-02", "2019-10-03"))
    assert "PartitionFilters" in plan and "event_date_kst" in plan


def test_csv_malformed_numbers_become_null(spark, out_dir):
    from activitykit import read_activity_csv

    path = f"{out_dir}/in.csv"
    with open(path, "w") as f:
        f.write("event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session\n")
        f.write("2019-10-01 00:00:00 UTC,view,1001,2001,electronics.audio,sony,10.5,3001,ok\n")
        f.write("2019-10-01 00:00:00 UTC,view,abc,2001,electronics.audio,sony,10.5,3001,bad-product\n")
        f.write("2019-10-01 00:00:00 UTC,view,1001,2001,electronics.audio,sony,cheap,3001,bad-price\n")
        f.write("2019-10-01 00:00:00 UTC,view,1001,2001,,,10.5,,no-user\n")
    raw = read_activity_csv(spark, path)
    valid, invalid = validate(normalize(raw, "r"), "2019-10-01")
    assert sorted(r.raw_user_session for r in valid.collect()) == ["bad-price", "ok"]
    assert {r.raw_user_session: r.reject_reason for r in invalid.collect()} == {
        "bad-product": "NULL_PRODUCT_ID",
        "no-user": "NULL_USER_ID",
    }
    # the header is not matched by name: columns are taken by position
    header_swapped = f"{out_dir}/swapped.csv"
    with open(header_swapped, "w") as f:
        f.write("a,b,c,d,e,f,g,h,i\n2019-10-01 00:00:00 UTC,view,1,2,x,y,1.0,7,s\n")
    assert read_activity_csv(spark, header_swapped).first().user_id == 7
