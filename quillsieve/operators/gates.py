"""Quality gates on the evaluations map. What a missing metric means differs per gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import (
    ANSWER_THRESHOLD,
    GATE_THRESHOLDS,
    OVERALL_THRESHOLD,
    RATIONALE_THRESHOLD,
    SAFETY_THRESHOLD,
)
from quillsieve.functions.binding import let

EVALS = "evaluations"


def metric(name: str, default: float | None = None, evals: Column | None = None) -> Column:
    """Score of a metric; ``default`` replaces a missing one."""
    value = F.try_element_at(F.col(EVALS) if evals is None else evals, F.lit(name))
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def present_at_least(name: str, threshold: float, evals: Column | None = None) -> Column:
    """True if the metric is missing or reaches the threshold."""
    return F.coalesce(metric(name, evals=evals) >= threshold, F.lit(True))


def _gate(conditions: Callable[[Column], list[Column]]) -> Column:
    """All conditions on the evaluations map hold; false without one."""
    def body(evals: Column) -> Column:
        ok = evals.isNotNull()
        for condition in conditions(evals):
            ok = ok & condition
        return ok

    return let(F.col(EVALS), body)


def passes_quality(
    overall_threshold: float | None = None,
    thresholds: dict[str, float] | None = None,
    safety_threshold: float = SAFETY_THRESHOLD,
    rationale_threshold: float = RATIONALE_THRESHOLD,
    answer_threshold: float = ANSWER_THRESHOLD,
) -> Column:
    """The main gate: evaluations exist, overall (missing 0) and safety (missing 1)
    reach their thresholds, other configured metrics do where present, and rationale
    and answer (missing 0) do."""
    thresholds = GATE_THRESHOLDS if thresholds is None else thresholds
    if overall_threshold is None:
        overall_threshold = thresholds.get("overall_score", OVERALL_THRESHOLD)
    others = {n: t for n, t in thresholds.items() if n not in ("overall_score", "safety_score")}
    return _gate(lambda e: [
        metric("overall_score", 0.0, e) >= overall_threshold,
        metric("safety_score", 1.0, e) >= safety_threshold,
        *[present_at_least(n, t, e) for n, t in others.items()],
        metric("rationale_quality", 0.0, e) >= rationale_threshold,
        metric("answer_accuracy", 0.0, e) >= answer_threshold,
    ])


def filter_by_quality(df: DataFrame, overall_threshold: float | None = None, **options) -> DataFrame:
    return df.where(passes_quality(overall_threshold, **options))


def filter_by_metrics(df: DataFrame, thresholds: dict[str, float]) -> DataFrame:
    """Every listed metric reaches its threshold where present; rows without
    evaluations fail."""
    return df.where(_gate(lambda e: [present_at_least(n, t, e) for n, t in thresholds.items()]))


def filter_by_verification(df: DataFrame, require_verified: bool = True, column: str = "verification") -> DataFrame:
    """Rows whose verified flag (missing counts as false) equals ``require_verified``."""
    return df.where(F.coalesce(F.col(f"{column}.verified"), F.lit(False)) == require_verified)


def filter_by_rationale_and_answer(
    df: DataFrame,
    rationale_threshold: float = RATIONALE_THRESHOLD,
    answer_threshold: float = ANSWER_THRESHOLD,
) -> DataFrame:
    """Both scores (missing 0) reach their thresholds; evaluations must exist."""
    return df.where(_gate(lambda e: [
        metric("rationale_quality", 0.0, e) >= rationale_threshold,
        metric("answer_accuracy", 0.0, e) >= answer_threshold,
    ]))
