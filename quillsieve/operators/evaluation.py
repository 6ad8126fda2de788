"""Evaluation tables over predictions: accuracy, exact match, token F1, comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.scales import improvement_absolute, improvement_percent, improvement_text
from quillsieve.functions.text import normalized, strip, words


def token_overlap(prediction: Column, reference: Column) -> Column:
    """Size of the multiset intersection of two token arrays. Both are sorted together,
    prediction tokens first among equals, and one fold matches reference tokens with
    the prediction tokens still open; linear after the sort, no shuffle."""
    def tagged(tokens: Column, side: int) -> Column:
        return F.transform(tokens, lambda t: F.struct(t.alias("t"), F.lit(side).alias("side")))

    def step(acc: Column, x: Column) -> Column:
        same = acc["t"] == x["t"]
        still_open = F.when(same, acc["open"]).otherwise(F.lit(0))
        match = (x["side"] == 1) & (still_open > 0)
        return F.struct(
            x["t"].alias("t"),
            F.when(x["side"] == 0, still_open + 1).when(match, still_open - 1).otherwise(still_open).alias("open"),
            (acc["total"] + match.cast("int")).alias("total"),
        )

    both = F.array_sort(F.concat(tagged(prediction, 0), tagged(reference, 1)))
    start = F.struct(F.lit("").alias("t"), F.lit(0).alias("open"), F.lit(0).alias("total"))
    return F.aggregate(both, start, step, lambda acc: acc["total"])


def token_f1(prediction: Column, reference: Column) -> Column:
    """F1 of the token multisets of two texts; two empty texts score 1, one empty 0."""
    p, r = words(normalized(prediction)), words(normalized(reference))
    common = token_overlap(p, r)
    both_empty = (F.size(p) == 0) & (F.size(r) == 0)
    f1 = F.try_divide(2.0 * common, (F.size(p) + F.size(r)).cast("double"))
    return F.when(both_empty, F.lit(1.0)).otherwise(F.coalesce(f1, F.lit(0.0)))


def score_predictions(df: DataFrame, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Add ``accuracy`` (equal after normalisation), ``exact_match`` (equal after strip)
    and ``f1`` per row."""
    p, r = F.coalesce(F.col(prediction), F.lit("")), F.coalesce(F.col(reference), F.lit(""))
    return (
        df.withColumn("accuracy", (normalized(p) == normalized(r)).cast("double"))
        .withColumn("exact_match", (strip(p) == strip(r)).cast("double"))
        .withColumn("f1", token_f1(p, r))
    )


def evaluation_metrics(scored: DataFrame, keys: tuple[str, ...] = ("model", "dataset"), category: str = "category") -> DataFrame:
    """Means of the row scores and the number of samples per model and dataset: per
    category and, in the rows with category ``overall``, over all of them."""
    sets = scored.rollup(*keys, category).agg(
        F.grouping_id().alias("__level"), F.avg("accuracy").alias("accuracy"),
        F.avg("exact_match").alias("exact_match"), F.avg("f1").alias("f1"), F.count(F.lit(1)).alias("samples"),
    )
    named = F.when(F.col("__level") == 1, F.lit("overall")).otherwise(F.coalesce(F.col(category), F.lit("unknown")))
    return sets.where(F.col("__level") <= 1).withColumn(category, named).drop("__level")


def compare_models(metrics: DataFrame, baseline: str, candidate: str, measure: str = "accuracy") -> DataFrame:
    """Baseline against candidate per dataset and category, with the improvement. One
    aggregate over the two models instead of a join of the table with itself."""
    def of(model: str) -> Column:
        return F.max(F.when(F.col("model") == model, F.col(measure)))

    pair = metrics.where(F.col("model").isin(baseline, candidate)).groupBy("dataset", "category").agg(
        of(baseline).alias("before"), of(candidate).alias("after")
    ).where(F.col("before").isNotNull() & F.col("after").isNotNull())
    before, after = F.col("before"), F.col("after")
    return pair.select(
        "dataset", "category", "before", "after",
        improvement_absolute(before, after).alias("absolute"),
        improvement_percent(before, after).alias("percentage"),
        improvement_text(before, after).alias("formatted"),
    )
