"""Statistics: seed and index statistics, basic statistics, histograms, group metrics,
usage metrics. All are partial aggregates; exact medians go through order statistics."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import DIFFICULTY_BUCKETS
from quillsieve.functions.scales import difficulty_bucket
from quillsieve.operators.normalize import path_category
from quillsieve.operators.ranking import IN_PLACE_ROWS, bracket, exact_quantiles


def seed_statistics(df: DataFrame, file: Column | None = None) -> DataFrame:
    """One row: count, file count, and mean, min and max of the numeric difficulties."""
    files = F.count_distinct(file) if file is not None else F.lit(None).cast("bigint")
    d = F.col("metadata.difficulty")
    return df.agg(
        F.count(F.lit(1)).alias("count"), files.alias("file_count"), F.avg(d).alias("difficulty_mean"),
        F.min(d).alias("difficulty_min"), F.max(d).alias("difficulty_max"),
    )


def domain_distribution(df: DataFrame, domain: str = "metadata.domain") -> DataFrame:
    """Rows per domain; rows without one are not counted."""
    return df.where(F.col(domain).isNotNull()).groupBy(F.col(domain).alias("domain")).agg(
        F.count(F.lit(1)).alias("count")
    )


def index_statistics(df: DataFrame, buckets: int = DIFFICULTY_BUCKETS) -> DataFrame:
    """Rows (kind, key, count): total rows, distinct ids, number of domains, and the
    rows per domain and per difficulty bucket.

    One scan: each row counts for the whole, its domain, its bucket and its id, combined
    before the shuffle; the groups of ids and domains are then counted themselves.
    """
    nothing = F.lit(None).cast("string")

    def entry(kind: str, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))

    bucket = difficulty_bucket(F.col("metadata.difficulty"), buckets)
    every = df.select(F.inline(F.array(
        entry("total", nothing), entry("domain", F.col("metadata.domain")), entry("bucket", bucket), entry("id", F.nullif(F.col("id"), F.lit(""))))))
    counted = every.where((F.col("kind") == "total") | F.col("key").isNotNull()).groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))
    one = F.lit(1).cast("bigint")
    own = F.struct("kind", "key", F.col("n").alias("count"))
    is_domain, is_id = F.col("kind") == "domain", F.col("kind") == "id"
    ids = F.struct(F.lit("distinct_ids").alias("kind"), nothing.alias("key"), one.alias("count"))
    domains = F.struct(F.lit("domains").alias("kind"), nothing.alias("key"), one.alias("count"))
    told = F.when(is_id, F.array(ids)).when(is_domain, F.array(own, domains)).otherwise(F.array(own))
    seen = counted.select(F.inline(told)).groupBy("kind", "key").agg(F.sum("count").alias("count"))
    # a table without domains or ids has none of each
    none = df.sparkSession.createDataFrame([("domains", None, 0), ("distinct_ids", None, 0)], "kind string, key string, count bigint")
    return seen.unionByName(none).groupBy("kind", "key").agg(F.sum("count").alias("count"))


_MOMENTS = ("mean", "min", "max", "std", "count", "bracket")


def moment_columns(values: dict[str, Column]) -> list[Column]:
    """Aggregates of each value for :func:`statistics_of`."""
    out = []
    for i, c in enumerate(values.values()):
        v = c.cast("double")
        aggregates = (F.avg(v), F.min(v), F.max(v), F.stddev_pop(v), F.count(v), bracket(v))
        out += [a.alias(f"__{m}_{i}") for m, a in zip(_MOMENTS, aggregates, strict=True)]
    return out


def statistics_of(df: DataFrame, values: dict[str, Column], seen: dict, in_place: int = IN_PLACE_ROWS) -> DataFrame:
    """The table of :func:`basic_statistics` from a row with :func:`moment_columns` of the
    same frame; only the medians read it again."""
    names = list(values)
    rows = {n: {m: seen[f"__{m}_{i}"] for m in _MOMENTS} for i, n in enumerate(names)}
    known = {n: r for n, r in rows.items() if r["count"]}
    medians: dict = {}
    if known:
        long = df.select(F.inline(F.array(*[
            F.struct(F.lit(n).alias("metric"), values[n].cast("double").alias("value")) for n in known
        ])))
        medians = exact_quantiles(
            long, F.col("value"), F.col("metric"), in_place=in_place,
            sizes={n: (r["count"], r["min"], r["max"]) for n, r in known.items()}, sketch={n: r["bracket"] for n, r in known.items()})
    told = [(n, r["mean"], medians[n][0], r["min"], r["max"], r["std"], r["count"]) if n in known else (n, 0.0, 0.0, 0.0, 0.0, 0.0, 0)
            for n, r in rows.items()]
    return df.sparkSession.createDataFrame(
        told, "metric string, mean double, median double, min double, max double, std double, count bigint")


def basic_statistics(
    df: DataFrame, values: dict[str, Column], in_place: int = IN_PLACE_ROWS
) -> DataFrame:
    """One row per named expression: mean, median, min, max, population std, count, over
    the non-null values. Zeros for an expression without values. Two scans: moments and
    brackets of the medians, then the medians."""
    return statistics_of(df, values, df.agg(*moment_columns(values)).first().asDict(), in_place)


def histogram(df: DataFrame, value: Column, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max with their counts, empty bins included. The
    last bin is closed. A constant column gets [v - 0.5, v + 0.5]; no values, no rows."""
    rows = df.select(value.cast("double").alias("v")).where("v is not null")
    edge = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    spark = df.sparkSession
    if edge["lo"] is None:
        return spark.createDataFrame([], "bin bigint, bin_start double, bin_end double, count bigint")
    lo, hi = edge["lo"], edge["hi"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    place = F.least(F.floor((F.col("v") - lo) / F.lit(hi - lo) * bins), F.lit(bins - 1)).cast("bigint")
    counts = rows.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    step = (hi - lo) / bins
    every = spark.range(bins).select(F.col("id").alias("bin"))
    return every.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * step).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * step).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("count"),
    )


def count_by(df: DataFrame, path: str) -> DataFrame:
    """Rows per category at a dotted path; missing is ``unknown``."""
    return df.groupBy(path_category(df, path).alias("category")).agg(F.count(F.lit(1)).alias("count"))


def metric_by_group(df: DataFrame, path: str, **metrics: Column) -> DataFrame:
    """Aggregate expressions per category at a dotted path."""
    return df.groupBy(path_category(df, path).alias("category")).agg(*[c.alias(n) for n, c in metrics.items()])


def metric_by_group_pandas(
    df: DataFrame,
    path: str,
    partial: Callable[[pd.DataFrame], dict[str, float]],
    combine: dict[str, str],
    finish: Column,
    name: str = "metric",
) -> DataFrame:
    """A user metric in Python per category, computed in two steps so that no group is
    ever gathered: ``partial`` turns one Arrow batch of one category into numbers,
    ``combine`` says per number whether parts are added or the min or max is kept, and
    ``finish`` is the metric as an expression of the combined numbers."""
    keyed = df.withColumn("__category", path_category(df, path))
    fields = list(combine)

    def parts(batches):
        for batch in batches:
            rows = []
            for category, piece in batch.groupby("__category", sort=False):
                found = partial(piece.drop(columns="__category"))
                rows.append((category, *[float(found[f]) for f in fields]))
            yield pd.DataFrame(rows, columns=["category", *fields])

    schema = "category string, " + ", ".join(f"`{f}` double" for f in fields)
    folds = {"sum": F.sum, "min": F.min, "max": F.max}
    merged = keyed.mapInPandas(parts, schema).groupBy("category").agg(
        *[folds[how](f).alias(f) for f, how in combine.items()]
    )
    return merged.select("category", finish.alias(name))


def usage_metrics(calls: DataFrame, overall: str = "all") -> DataFrame:
    """Requests, successes, failures, tokens, cost and latency per provider, and over
    all of them in a row named ``overall``. Missing numbers count as 0."""
    def total(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(f"total_{name}")

    return calls.rollup("provider").agg(
        F.grouping("provider").alias("__level"),
        F.count(F.lit(1)).alias("total_requests"),
        F.count_if(F.col("error").isNull()).alias("successful_requests"),
        F.count_if(F.col("error").isNotNull()).alias("failed_requests"),
        total("prompt_tokens"), total("completion_tokens"), total("tokens"), total("cost"), total("latency"),
    ).withColumn("provider", F.when(F.col("__level") == 1, F.lit(overall)).otherwise(F.col("provider"))).drop("__level")


def final_statistics(df: DataFrame) -> DataFrame:
    """One row: rows, number of domains, mean difficulty, mean instruction and response
    length."""
    return df.agg(
        F.count(F.lit(1)).alias("count"),
        F.count_distinct("metadata.domain").alias("domains"),
        F.avg("metadata.difficulty").alias("avg_difficulty"),
        F.avg(F.length("instruction")).alias("avg_instruction_length"),
        F.avg(F.length("response.origin_text")).alias("avg_response_length"),
    )
