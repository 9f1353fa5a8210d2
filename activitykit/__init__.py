"""activitykit: click-stream activity analytics on Spark DataFrames.

Raw events → normalize → validate (dead-letter) → exact dedup → inactivity-gap
sessions continued across runs through a per-user snapshot → day-partitioned
publish → catalog tables → weekly active users and sessions, recomputed only for
the weeks a run touches.
"""

from activitykit.operators import *  # noqa: F401,F403
from activitykit.operators import __all__ as _ops_all
from activitykit.plans import *  # noqa: F401,F403
from activitykit.plans import __all__ as _plans_all
from activitykit.runtime import ensure_utc, scratch_path, shared_dir
from activitykit.sources import *  # noqa: F401,F403
from activitykit.sources import __all__ as _src_all
from activitykit.sources.catalog import (
    add_partitions,
    add_week_partitions,
    create_activity_table,
    create_weekly_table,
    read_table,
)
from activitykit.sources.publish import publish_partitions
from activitykit.sources.sinks import (
    export_duplicate_groups,
    export_snapshot,
    to_table_layout,
    write_dlq,
    write_staging,
    write_weekly,
)

__all__ = [
    *_ops_all,
    *_plans_all,
    *_src_all,
    "add_partitions",
    "add_week_partitions",
    "create_activity_table",
    "create_weekly_table",
    "ensure_utc",
    "export_duplicate_groups",
    "export_snapshot",
    "publish_partitions",
    "read_table",
    "scratch_path",
    "shared_dir",
    "to_table_layout",
    "write_dlq",
    "write_staging",
    "write_weekly",
]
