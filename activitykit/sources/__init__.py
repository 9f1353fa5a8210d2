"""Scans and sinks: CSV, the events adapter, snapshots, staged/published tables, catalog."""

from activitykit.sources.activity_csv import malformed_lines, read_activity_csv, write_activity_csv
from activitykit.sources.events import activity_from_events, events_as_activity, read_events
from activitykit.sources.snapshot_store import load_snapshot, save_snapshot, snapshot_path

__all__ = [
    "activity_from_events",
    "events_as_activity",
    "load_snapshot",
    "malformed_lines",
    "read_activity_csv",
    "read_events",
    "save_snapshot",
    "snapshot_path",
    "write_activity_csv",
]
