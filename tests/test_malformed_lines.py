"""Malformed CSV lines: kept with their place in the dead letters, and found at their exact bytes."""

from __future__ import annotations

import gzip
import json

import pytest

from activitykit import malformed_lines, normalize, read_activity_csv, validate

HEADER = "event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
GOOD = "2019-10-01 00:00:00 UTC,view,1001,2001,electronics.audio,süß,10.5,3001,s{}"
BAD = [
    "2019-10-01 00:00:00 UTC,view,abc,2001,a.b,sony,10.5,3001,bad-product",
    "2019-10-01 00:00:00 UTC,view,1,2001,a.b,sony,cheap,3001,bad-price",
    "2019-10-01 00:00:00 UTC,view",
    "2019-10-01 00:00:00 UTC,view,1,2001,a.b,sony,1.5,3001,long,one,more",
    "\x01garbage ✓ only",
]


def _write(path, name, end="\n", n=200, step=23):
    lines = [HEADER] + [BAD[i // step % len(BAD)] if i % step == 0 else GOOD.format(i) for i in range(1, n)] + [BAD[0]]
    data = (end.join(lines) + end).encode()
    with open(f"{path}/{name}", "wb") as f:
        f.write(gzip.compress(data) if name.endswith(".gz") else data)
    return data


def _places(data: bytes, broken: set[str]):
    at, out = 0, []
    for line in data.split(b"\n"):
        text = line.rstrip(b"\r").decode()
        if text in broken:
            out.append((at, text))
        at += len(line) + 1
    return sorted(out)


@pytest.mark.parametrize("block", [300, 100_000])
def test_every_malformed_line_at_its_byte(spark, tmp_path, block):
    files = {"a.csv": _write(tmp_path, "a.csv"), "b.csv": _write(tmp_path, "b.csv", "\r\n", 90, 7), "c.csv.gz": _write(tmp_path, "c.csv.gz", n=40)}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = malformed_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, data in files.items():
        mine = sorted((r.byte_offset, r.malformed_line) for r in got if r.source_file.endswith(name))
        assert mine == _places(data, set(BAD)), name


def test_dead_letters_hold_the_line_and_its_place(spark, tmp_path):
    _write(tmp_path, "a.csv")
    plain = validate(normalize(read_activity_csv(spark, str(tmp_path)), "r"), "2019-10-01")
    kept = validate(normalize(read_activity_csv(spark, str(tmp_path), keep_malformed=True), "r"), "2019-10-01")
    assert kept.valid.columns == plain.valid.columns and kept.invalid.columns == plain.invalid.columns
    assert kept.valid.drop("ingested_at").exceptAll(plain.valid.drop("ingested_at")).isEmpty()
    assert kept.valid.count() == plain.valid.count() and kept.invalid.count() == plain.invalid.count()
    payloads = [json.loads(r.raw_payload) for r in kept.invalid.select("raw_payload").collect()]
    found = {p["malformed_line"] for p in payloads}
    assert found == {BAD[0], BAD[2], BAD[4]}  # a bad price or surplus fields leave a valid row
    assert all(p["source_file"].endswith("a.csv") and p["source_block_start"] == 0 for p in payloads)
    assert "malformed_line" not in json.loads(plain.invalid.first().raw_payload)


def test_no_malformed_line_in_clean_and_empty_input(spark, tmp_path):
    (tmp_path / "clean.csv").write_text("\n".join([HEADER, GOOD.format(1), "", GOOD.format(2)]) + "\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text(HEADER + "\n")
    assert malformed_lines(spark, str(tmp_path)).isEmpty()
