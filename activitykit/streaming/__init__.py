"""Structured Streaming form of the incremental (run-to-run) sessionization."""

from activitykit.streaming.incremental import (
    StreamConfig,
    latest_state,
    process_micro_batch,
    read_sessions,
    start_incremental_sessions,
)

__all__ = ["StreamConfig", "latest_state", "process_micro_batch", "read_sessions", "start_incremental_sessions"]
