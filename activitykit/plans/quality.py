"""Quality gate over a run's metrics (checked before anything is published).

Fails when input or output is empty, when every row failed time parsing, or when
the dead-letter ratio is above 5 %; warns above 1 %. Both limits pass inclusive.
The same rule is offered as Column expressions for a metrics DataFrame.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from activitykit.schema import (
    DLQ_FAIL_RATIO,
    DLQ_WARN_RATIO,
    GATE_ALL_BAD_TIME,
    GATE_INPUT_EMPTY,
    GATE_OUTPUT_EMPTY,
    GATE_RATIO_FAIL_PREFIX,
    GATE_RATIO_WARN_PREFIX,
    REASON_INVALID_EVENT_TIME,
)


class QualityGateError(ValueError):
    pass


@dataclass
class GateResult:
    warnings: list[str] = field(default_factory=list)


def invalid_event_time_count(reason_summary: dict[str, int]) -> int:
    """Rows whose reason list contains INVALID_EVENT_TIME (alone or with others)."""
    return sum(n for reasons, n in reason_summary.items() if REASON_INVALID_EVENT_TIME in reasons.split("|"))


def evaluate(
    input_rows: int,
    output_rows: int,
    dlq_ratio: float,
    invalid_reason_summary: dict[str, int] | None = None,
) -> GateResult:
    if input_rows <= 0:
        raise QualityGateError(GATE_INPUT_EMPTY)
    if output_rows <= 0:
        raise QualityGateError(GATE_OUTPUT_EMPTY)
    if invalid_event_time_count(invalid_reason_summary or {}) >= input_rows:
        raise QualityGateError(GATE_ALL_BAD_TIME)
    if dlq_ratio > DLQ_FAIL_RATIO:
        raise QualityGateError(f"{GATE_RATIO_FAIL_PREFIX}{dlq_ratio:.4f}")
    warnings = [f"{GATE_RATIO_WARN_PREFIX}{dlq_ratio:.4f}"] if dlq_ratio > DLQ_WARN_RATIO else []
    return GateResult(warnings)


def gate_columns(input_rows: Column, output_rows: Column, bad_time_rows: Column, dlq_ratio: Column) -> list[Column]:
    """(gate_status PASS/WARN/FAIL, gate_message) for metric columns, same rule and order."""
    ratio_text = F.format_number(dlq_ratio, 4)
    status = (
        F.when(input_rows <= 0, "FAIL")
        .when(output_rows <= 0, "FAIL")
        .when(bad_time_rows >= input_rows, "FAIL")
        .when(dlq_ratio > F.lit(DLQ_FAIL_RATIO), "FAIL")
        .when(dlq_ratio > F.lit(DLQ_WARN_RATIO), "WARN")
        .otherwise("PASS")
    )
    message = (
        F.when(input_rows <= 0, F.lit(GATE_INPUT_EMPTY))
        .when(output_rows <= 0, F.lit(GATE_OUTPUT_EMPTY))
        .when(bad_time_rows >= input_rows, F.lit(GATE_ALL_BAD_TIME))
        .when(dlq_ratio > F.lit(DLQ_FAIL_RATIO), F.concat(F.lit(GATE_RATIO_FAIL_PREFIX), ratio_text))
        .when(dlq_ratio > F.lit(DLQ_WARN_RATIO), F.concat(F.lit(GATE_RATIO_WARN_PREFIX), ratio_text))
    )
    return [status.alias("gate_status"), message.alias("gate_message")]


def gate_of_metrics(metrics: DataFrame) -> DataFrame:
    """Adds the gate to a metrics DataFrame with input_row_count, output_row_count,
    invalid_event_time_count and dlq_ratio."""
    return metrics.select(
        "*",
        *gate_columns(
            F.col("input_row_count"),
            F.col("output_row_count"),
            F.col("invalid_event_time_count"),
            F.col("dlq_ratio"),
        ),
    )
