"""Prints the physical-plan skeleton of the main jobs (the text of PLANS.md).

Usage: python tests/plans_report.py [sf_dir]
Only the shuffle, join, window, aggregate and scan lines are kept, with the scan's
pruning and pushdown details.
"""

from __future__ import annotations

import os
import re
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEEP = ("Exchange", "Join", "Window", "Aggregate", "Scan", "Union", "InMemoryTableScan", "CollectMetrics",
        "WriteFiles", "Sort [")
DETAIL = ("PartitionFilters", "PushedFilters", "ReadSchema")


def skeleton(spark, df) -> str:
    simple = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    formatted = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    out = []
    for line in simple.splitlines():
        if any(k in line for k in KEEP):
            line = re.sub(r"#\d+L?", "", line)
            line = re.sub(r", \[plan_id=\d+\]", "", line)
            out.append(line[:150])
    details = [re.sub(r"#\d+L?", "", line)[:200] for line in formatted.splitlines() if line.startswith(DETAIL)]
    return "\n".join(out + ([""] + details if details else []))


def main() -> None:
    from pyspark.sql import SparkSession

    from activitykit import deduplicate, sessionize, user_activity_stats
    from activitykit.operators.snapshot import build_snapshot
    from activitykit.operators.weekly import weekly_sessions_sql, weekly_users_sql
    from activitykit.plans import registry as R
    from activitykit.sources.sinks import to_table_layout

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "16")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    valid = R.valid_invalid(spark, sf).valid
    dedup = deduplicate(valid).deduplicated
    stats = user_activity_stats(valid)
    sess = sessionize(dedup, user_stats=stats)
    root = tempfile.mkdtemp(prefix="plans-")
    to_table_layout(sess).write.partitionBy("event_date_kst").parquet(f"{root}/table")
    table = spark.read.parquet(f"{root}/table")
    table.createOrReplaceTempView("activity_events_plans")
    sections = [
        ("Dedup (one partial aggregate on dedup_key)", dedup),
        ("Sessionize, no hot users (dedup shuffle + one window shuffle)", sess),
        ("Sessionize with hot users (max_user_rows=20: every user is cut)",
         sessionize(dedup, user_stats=stats, max_user_rows=20)),
        ("Snapshot from the published table (max-struct partial aggregate)", build_snapshot(table, "d", "r")),
        ("Weekly users, SQL over the day-partitioned table, weeks 2024-01-08..2024-01-15",
         weekly_users_sql(spark, "activity_events_plans", "2024-01-08", "2024-01-15")),
        ("Weekly sessions, SQL, same weeks",
         weekly_sessions_sql(spark, "activity_events_plans", "2024-01-08", "2024-01-15")),
    ]
    for title, df in sections:
        print(f"## {title}\n\n```\n{skeleton(spark, df)}\n```\n")


if __name__ == "__main__":
    main()
