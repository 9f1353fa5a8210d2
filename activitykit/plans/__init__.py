"""Composite jobs: quality gate, preflight, run log, the batch run, registered queries."""

from activitykit.plans.batch import BatchConfig, run_batch
from activitykit.plans.preflight import PreflightError, preflight
from activitykit.plans.quality import GateResult, QualityGateError, evaluate, gate_of_metrics
from activitykit.plans.run_log import RunLog, read_run_log

__all__ = [
    "BatchConfig",
    "GateResult",
    "PreflightError",
    "QualityGateError",
    "RunLog",
    "evaluate",
    "gate_of_metrics",
    "preflight",
    "read_run_log",
    "run_batch",
]
