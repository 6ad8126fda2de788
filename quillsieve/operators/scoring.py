"""Metric scores and their aggregation. One projection, no shuffle, unless scores
come from another table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import DEFAULT_METRICS, JUDGE_CRITERIA, OVERALL_THRESHOLD, SAFETY_THRESHOLD
from quillsieve.functions.binding import let
from quillsieve.functions.keys import uniform
from quillsieve.functions.scales import judge_score
from quillsieve.functions.text import banned, distinct_word_ratio, sentence_count, word_count
from quillsieve.model import EVALUATIONS
from quillsieve.operators.gates import EVALS, metric, present_at_least

Scorer = Callable[[], Column]


def text_scorers(blocked: tuple[str, ...] = ()) -> dict[str, Scorer]:
    """Deterministic scorers on the text of a sample."""
    def full(column: Column, at: int) -> Column:
        return F.least(F.lit(1.0), column / F.lit(float(at)))

    origin, rationale = F.col("response.origin_text"), F.col("response.rationale")
    return {
        "instruction_complexity": lambda: full(word_count(F.col("instruction")), 60),
        "response_quality": lambda: distinct_word_ratio(origin),
        "reasoning_depth": lambda: full(sentence_count(rationale), 10),
        "safety_score": lambda: F.when(banned(origin, blocked), 0.0).otherwise(1.0),
        "rationale_quality": lambda: distinct_word_ratio(rationale),
    }


def hash_scorers(metrics: tuple[str, ...] = DEFAULT_METRICS, seed: str = "0") -> dict[str, Scorer]:
    """Repeatable placeholder scores in [0.5, 1)."""
    def scorer(name: str) -> Scorer:
        return lambda: 0.5 + 0.5 * uniform(F.lit(seed), F.col("id"), F.lit(name))

    return {name: scorer(name) for name in metrics}


def answer_scorer(expected: str = "expected") -> Scorer:
    """Answer accuracy: 1 or 0 against an expected answer column, absent without one."""
    def score() -> Column:
        return F.when(
            F.col(expected).isNotNull(), (F.col("response.final_answer") == F.col(expected)).cast("double")
        )

    return score


def to_map(scores: dict[str, Column]) -> Column:
    """Map of the scores that are not null; each score expression occurs once."""
    names = F.array(*[F.lit(n) for n in scores])
    values = F.array(*[c.cast("double") for c in scores.values()])
    return F.map_filter(F.map_from_arrays(names, values), lambda _, v: v.isNotNull())


def _empty() -> Column:
    return F.from_json(F.lit("{}"), EVALUATIONS)


def score(df: DataFrame, scorers: dict[str, Scorer], metrics: tuple[str, ...] | None = None) -> DataFrame:
    """Add the scores to the evaluations map, replacing scores of the same name.

    A scorer is any function that returns a Column, so a ``pandas_udf`` call is one too.
    """
    names = list(metrics) if metrics else list(scorers)
    fresh = to_map({n: scorers[n]() for n in names})
    if EVALS not in df.columns:
        return df.withColumn(EVALS, fresh)
    kept = F.map_filter(F.coalesce(F.col(EVALS), _empty()), lambda k, _: ~k.isin(*names))
    return df.withColumn(EVALS, F.map_concat(kept, fresh))


def rationale_and_answer(df: DataFrame, answer: Column | None = None) -> DataFrame:
    """Columns ``rationale_quality`` and ``answer_accuracy``: 0 and 0 where the response
    has no struct."""
    has = F.col("response").isNotNull()
    accuracy = answer if answer is not None else F.lit(None).cast("double")
    return df.withColumn(
        "rationale_quality", F.when(has, distinct_word_ratio(F.col("response.rationale"))).otherwise(F.lit(0.0))
    ).withColumn("answer_accuracy", F.when(has, accuracy).otherwise(F.lit(0.0)))


def join_scores(df: DataFrame, scores: DataFrame, metrics: tuple[str, ...]) -> DataFrame:
    """Merge a long score table (id, metric, score) into the evaluations map. The scores
    are pivoted by one aggregate per id and joined on id; scores from the table win."""
    wide = scores.where(F.col("metric").isin(*metrics)).groupBy("id").agg(
        *[F.max(F.when(F.col("metric") == m, F.col("score"))).alias(m) for m in metrics]
    )
    added = to_map({m: F.col(m) for m in metrics})
    joined = df.join(wide, "id", "left")
    if EVALS not in df.columns:
        return joined.withColumn(EVALS, added).drop(*metrics)
    kept = F.map_filter(F.col(EVALS), lambda k, _: ~F.map_contains_key(added, k))
    merged = F.when(F.col(EVALS).isNotNull(), F.map_concat(kept, added)).otherwise(added)
    return joined.withColumn(EVALS, merged).drop(*metrics)


def judge_scores(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judge output (id and the 1-to-5 criteria) as (long score table on [0, 1],
    rows with a score outside the scale)."""
    bad = F.lit(False)
    for c in JUDGE_CRITERIA:
        bad = bad | F.coalesce(~F.col(c).between(1, 5), F.lit(False))
    entries = F.array(*[F.struct(F.lit(c).alias("metric"), judge_score(F.col(c)).alias("score")) for c in JUDGE_CRITERIA])
    good = judged.where(~bad).select("id", F.inline(entries)).where(F.col("score").isNotNull())
    return good, judged.where(bad)


def overall_score(weights: dict[str, float] | None = None, evals: Column | None = None) -> Column:
    """Weighted mean over the default metrics that are present (missing weight 1); 0 if
    none is present or the weights sum to 0."""
    weights = weights or {}
    total, weighted = F.lit(0.0), F.lit(0.0)
    for name in DEFAULT_METRICS:
        w = float(weights.get(name, 1.0))
        total = total + F.when(metric(name, evals=evals).isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
        weighted = weighted + metric(name, 0.0, evals) * w
    return F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(weighted, total))


def combined_score(rationale_weight: float = 0.5, answer_weight: float = 0.5, evals: Column | None = None) -> Column:
    rationale, answer = metric("rationale_quality", 0.0, evals), metric("answer_accuracy", 0.0, evals)
    return rationale * rationale_weight + answer * answer_weight


def passes_thresholds(thresholds: dict[str, float] | None = None) -> Column:
    """Every configured metric that is present reaches its threshold; safety and
    overall have defaults."""
    limits = {"safety_score": SAFETY_THRESHOLD, "overall_score": OVERALL_THRESHOLD, **(thresholds or {})}

    def body(evals: Column) -> Column:
        ok = F.lit(True)
        for name, threshold in limits.items():
            ok = ok & present_at_least(name, threshold, evals)
        return ok

    return let(F.col(EVALS), body)


def aggregate_scores(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    thresholds: dict[str, float] | None = None,
    rationale_weight: float = 0.5,
    answer_weight: float = 0.5,
    evaluated_at: str | None = None,
) -> DataFrame:
    """Add overall and combined score to the evaluations, and the columns
    ``passes_thresholds`` and ``evaluation_timestamp`` (a run parameter)."""
    def derived(evals: Column) -> Column:
        kept = F.map_filter(evals, lambda k, _: ~k.isin("overall_score", "combined_score"))
        return F.map_concat(kept, to_map({
            "overall_score": overall_score(weights, evals),
            "combined_score": combined_score(rationale_weight, answer_weight, evals),
        }))

    return (
        df.withColumn(EVALS, let(F.coalesce(F.col(EVALS), _empty()), derived))
        .withColumn("passes_thresholds", passes_thresholds(thresholds))
        .withColumn("evaluation_timestamp", F.lit(evaluated_at).cast("timestamp"))
    )
