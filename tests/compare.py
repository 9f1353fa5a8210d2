"""Run registered queries in Spark and their oracle SQL in DuckDB; compare results.

Usage: python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm_value(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 12))
    return str(v) if v is not None else None


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(_norm_value(r[c]) for c in cols) for r in df.collect()), key=repr)


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted((tuple(_norm_value(r[i]) for i in idx) for r in rel.fetchall()), key=repr)


def compare(spark, sf_dir: str, names: list[str] | None = None, verbose: bool = True) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs = entry.queries()
    sqls = entry.oracle_sql()
    con = duck(sf_dir)
    out = {}
    for name in names or list(qs):
        t0 = time.time()
        res: dict = {"name": name}
        try:
            cols, srows = rows_of_spark(qs[name](spark, sf_dir))
            res["rows"] = len(srows)
            if name in sqls:
                dcols, drows = rows_of_duck(con, sqls[name])
                res["cols_match"] = cols == dcols
                res["rows_match"] = len(srows) == len(drows)
                res["values_match"] = srows == drows
                if not res["values_match"]:
                    res["spark_cols"], res["duck_cols"] = cols, dcols
                    sd, dd = set(srows), set(drows)
                    res["only_spark"] = sorted(sd - dd, key=repr)[:3]
                    res["only_duck"] = sorted(dd - sd, key=repr)[:3]
            else:
                res["values_match"] = None
        except Exception as exc:  # report and go on
            res["error"] = f"{type(exc).__name__}: {str(exc)[:600]}"
        res["sec"] = round(time.time() - t0, 2)
        out[name] = res
        if verbose:
            print(res, flush=True)
    return out


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [n for n, r in res.items() if r.get("error") or r.get("values_match") is False]
    print("FAILED:", bad)
    print("OK:", len(res) - len(bad), "of", len(res))
