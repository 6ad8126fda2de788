"""Advanced scores from loss and score tables, their ensemble and the final cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import ENSEMBLE_WEIGHTS
from quillsieve.operators.ranking import top_per_group
from quillsieve.session import lookup_join, stage


def instruction_following_difficulty(losses: DataFrame) -> DataFrame:
    """IFD per sample: loss of the answer given the instruction over its loss alone;
    null where the latter is 0. Input (id, loss_cond, loss_uncond)."""
    return losses.select("id", F.try_divide("loss_cond", "loss_uncond").alias("ifd_score"))


def learning_effect(runs: DataFrame, before: str, after: str) -> DataFrame:
    """Loss reduction and accuracy gain per sample between two runs of a table
    (run, id, loss, accuracy). Samples that miss one of the runs are left out."""
    def of(run: str, column: str):
        return F.max(F.when(F.col("run") == run, F.col(column)))

    return (
        runs.where(F.col("run").isin(before, after)).groupBy("id").agg(
            (of(before, "loss") - of(after, "loss")).alias("loss_reduction"),
            (of(after, "accuracy") - of(before, "accuracy")).alias("accuracy_improvement"),
        )
        .where(F.col("loss_reduction").isNotNull() | F.col("accuracy_improvement").isNotNull())
    )


def ensemble_scores(df: DataFrame, scores: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Join a score table (id, <method>_score ...) and add ``ensemble_score``, the weighted
    mean of the methods that are present (null without any)."""
    weights = ENSEMBLE_WEIGHTS if weights is None else weights
    joined = df.join(scores.select("id", *[f"{m}_score" for m in weights]), "id", "left")
    total, weighted = F.lit(0.0), F.lit(0.0)
    for method, w in weights.items():
        value = F.col(f"{method}_score")
        total = total + F.when(value.isNotNull(), F.lit(float(w))).otherwise(F.lit(0.0))
        weighted = weighted + F.coalesce(value, F.lit(0.0)) * float(w)
    return joined.withColumn("ensemble_score", F.when(total > 0, F.try_divide(weighted, total)))


def filter_by_ensemble(df: DataFrame, target: int = 800) -> DataFrame:
    """The ``target`` rows with the highest ensemble score; rows without one come last.
    Ids and scores are ranked apart from the wide rows."""
    narrow = stage(df.select("id", "ensemble_score"), "ensemble")
    picked = top_per_group(narrow, target, F.col("ensemble_score")).select("id")
    return lookup_join(df, picked, ["id"], "left_semi", bound=target)
