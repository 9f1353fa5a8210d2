"""Times the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs to completion into Spark's ``noop`` sink (every row computed,
nothing collected). A short warm-up on sf0.001 runs first so JVM start-up and
first-time code generation are not charged to the first query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("activitykit-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(2 * CPUS))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    from activitykit.plans import registry as R
    from activitykit.plans.batch import BatchConfig, run_batch
    from activitykit.sources.events import events_as_activity

    spark = session()
    # warm-up (not timed)
    warm = "/root/testdata/sf0.001"
    run(R.q_weekly_active_sessions(spark, warm if os.path.exists(f"{warm}/events.parquet") else SF_DIR))

    scratch = tempfile.mkdtemp(prefix="bench-")
    headline = {
        "sessionize_300": lambda: run(R.q_sessionize(spark, SF_DIR, 300)),
        "sessionize_hot_split": lambda: run(R.q_sessionize_hot_split(spark, SF_DIR)),
        "sessionize_seeded": lambda: run(R.q_sessionize_seeded(spark, SF_DIR)),
        "dedup_rows": lambda: run(R.q_dedup_rows(spark, SF_DIR)),
        "invalid_rows": lambda: run(R.q_invalid_rows(spark, SF_DIR)),
        "wau_users": lambda: run(R.q_wau_users(spark, SF_DIR)),
        "weekly_active_sessions": lambda: run(R.q_weekly_active_sessions(spark, SF_DIR)),
        "weekly_active_sessions_range": lambda: run(R.q_weekly_active_sessions_range(spark, SF_DIR)),
        "session_snapshot": lambda: run(R.q_session_snapshot(spark, SF_DIR)),
        "run_batch": lambda: run_batch(
            spark,
            BatchConfig(
                start_date="2024-01-01",
                end_date="2024-01-31",
                run_id="bench",
                output_base_path=f"{scratch}/final",
                staging_base_path=f"{scratch}/staging",
                dlq_base_path=f"{scratch}/dlq",
                session_state_base_path=f"{scratch}/state",
                run_log_base_path=f"{scratch}/log",
                wau_output_base_path=f"{scratch}/wau",
            ),
            events_as_activity(spark, SF_DIR, dirty=True),
        ),
    }
    times = {}
    for name, fn in headline.items():
        t0 = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - t0, 3)

    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    total = round(sum(times.values()), 3)
    sf = re.search(r"sf([0-9.]+)$", SF_DIR)
    print(
        json.dumps(
            {
                "metric": "headline_total_sec",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": float(sf.group(1)) if sf else SF_DIR,
                "cpus": CPUS,
                "events_rows": rows,
                "run_batch_rows_per_sec": round(rows / times["run_batch"], 1),
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
