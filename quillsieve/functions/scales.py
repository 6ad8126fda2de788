"""Numeric functions: difficulty buckets and bands, improvement, cost, judge scale."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.fixed_values import DIFFICULTY_BUCKETS


def difficulty_bucket(difficulty: Column, buckets: int = DIFFICULTY_BUCKETS) -> Column:
    """Bucket 0..buckets-1 of a difficulty clamped to [0, 1]; the top edge belongs
    to the last bucket."""
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), difficulty))
    raw = F.least(F.floor(clamped * buckets), F.lit(buckets - 1)).cast("int")
    return F.when(difficulty.isNotNull(), raw)


def bucket_of(difficulty: float, buckets: int = DIFFICULTY_BUCKETS) -> int:
    """The same bucket for a parameter value."""
    return min(int(max(0.0, min(1.0, difficulty)) * buckets), buckets - 1)


def difficulty_band(complexity: Column) -> Column:
    """Selection band of ``instruction_complexity``; missing counts as medium."""
    return F.when(complexity < 0.4, "easy").when(complexity > 0.7, "hard").otherwise("medium")


def report_band(difficulty: Column) -> Column:
    """Band used by the reports, on ``difficulty``; missing stays missing."""
    return (
        F.when(difficulty < 0.3, "easy")
        .when(difficulty <= 0.7, "medium")
        .when(difficulty > 0.7, "hard")
    )


def improvement_absolute(before: Column, after: Column) -> Column:
    return after - before


def improvement_percent(before: Column, after: Column) -> Column:
    """Percent change; from zero it is infinite for a gain and 0 otherwise."""
    from_zero = F.when(after > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    return F.when(before == 0, from_zero).otherwise(F.try_divide(after - before, before) * 100)


def improvement_text(before: Column, after: Column) -> Column:
    """The change as ``0.0500 (+10.00%)``; an infinite percent prints as ``+inf``. Digits
    are rounded half to even first, since ``format_string`` alone rounds half up."""
    percent = improvement_percent(before, after)
    shown = F.when(percent == F.lit(float("inf")), F.lit("+inf")).otherwise(F.format_string("%+.2f", F.bround(percent, 2)))
    return F.concat(F.format_string("%.4f", F.bround(after - before, 4)), F.lit(" ("), shown, F.lit("%)"))


def usage_cost(unit: Column, prompt_price: Column, completion_price: Column,
               prompt_units: Column, completion_units: Column) -> Column:
    """Cost of a call. Prices are per 1000 units (tokens or characters), or per
    million tokens for unit ``1m_tokens``; without a price the cost is 0."""
    scale = F.when(unit == "1m_tokens", F.lit(1_000_000.0)).otherwise(F.lit(1000.0))
    prompt = F.coalesce(prompt_units, F.lit(0)) / scale * F.coalesce(prompt_price, F.lit(0.0))
    completion = F.coalesce(completion_units, F.lit(0)) / scale * F.coalesce(completion_price, F.lit(0.0))
    return prompt + completion


def judge_score(score: Column) -> Column:
    """A 1-to-5 judge score on [0, 1]; null outside the scale."""
    return F.when(score.between(1, 5), (score - 1) / 4.0)
