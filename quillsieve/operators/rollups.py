"""Statistics that are kept per run and merged, instead of scanning all rows again.

A run writes one narrow table from one scan of its rows: additive numbers per domain and
difficulty bucket (counts, sums, extremes), the distinct ids and files, and a distinct sketch of the ids.
Merging the tables of all runs gives what a scan over all rows gives; the number of ids is
exact from the narrow ids, or estimated from the sketches without reading them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.fixed_values import DIFFICULTY_BUCKETS
from quillsieve.functions.scales import difficulty_bucket

def run_partials(df: DataFrame, file: Column | None = None, buckets: int = DIFFICULTY_BUCKETS) -> DataFrame:
    """(kind, key, bucket, sums, extremes, ids) of the rows of a run, from one scan: a row of
    kind ``cell`` per domain and bucket, of kind ``id`` per id, of kind ``file`` per file."""
    d = F.col("metadata.difficulty")
    nothing, no_bucket = F.lit(None).cast("string"), F.lit(None).cast("int")

    def entry(kind: str, key: Column, bucket: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"), bucket.cast("int").alias("bucket"))

    entries = F.array(
        entry("cell", F.col("metadata.domain"), difficulty_bucket(d, buckets)),
        entry("id", F.nullif(F.col("id"), F.lit("")), no_bucket), entry("file", nothing if file is None else file, no_bucket))
    rows = df.select(
        F.inline(entries), d.alias("difficulty"), F.length("instruction").alias("instruction"), F.length("response.origin_text").alias("response"), F.col("id"))
    cell = F.col("kind") == "cell"

    def within(name: str) -> Column:
        return F.when(cell, F.col(name))

    sums = [F.count(F.lit(1)).alias("n")]
    for name in ("difficulty", "instruction", "response"):
        sums += [F.count(within(name)).alias(f"with_{name}"), F.sum(within(name).cast("double")).alias(name)]
    return rows.where(cell | F.col("key").isNotNull()).groupBy("kind", "key", "bucket").agg(
        *sums, F.min(within("difficulty")).alias("least"), F.max(within("difficulty")).alias("most"),
        F.hll_sketch_agg(F.when(cell, F.nullif(F.col("id"), F.lit("")))).alias("ids"))


def write_partials(df: DataFrame, path: str, run_id: str, file: Column | None = None, buckets: int = DIFFICULTY_BUCKETS) -> None:
    """Write the partials of a run; a repeated run replaces its own."""
    run_partials(df, file, buckets).write.mode("overwrite").partitionBy("kind").parquet(f"{path}/run_id={run_id}")


def read_partials(spark: SparkSession, path: str) -> DataFrame:
    """The partials of all runs."""
    return spark.read.parquet(path)


def _cells(partials: DataFrame) -> DataFrame:
    return partials.where("kind = 'cell'")


def _mean(name: str) -> Column:
    return F.try_divide(F.sum(name), F.sum(f"with_{name}"))


def merged_seed_statistics(partials: DataFrame) -> DataFrame:
    """As ``stats.seed_statistics`` over the rows of all runs."""
    files = partials.where("kind = 'file'").agg(F.count_distinct("key").alias("file_count"))
    return _cells(partials).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"), _mean("difficulty").alias("difficulty_mean"), F.min("least").alias("difficulty_min"), F.max("most").alias("difficulty_max"),
    ).join(F.broadcast(files)).select("count", "file_count", "difficulty_mean", "difficulty_min", "difficulty_max")


def merged_index_statistics(partials: DataFrame, exact: bool = True) -> DataFrame:
    """As ``stats.index_statistics`` over the rows of all runs; with ``exact=False`` the
    number of ids is the estimate of the merged sketches."""
    nothing = F.lit(None).cast("string")

    def entry(kind: str, key: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key"))

    cells = _cells(partials)
    told = cells.select(F.col("n"), F.inline(F.array(entry("total", nothing), entry("domain", F.col("key")), entry("bucket", F.col("bucket")))).alias("of", "what"))
    counts = told.where((F.col("of") == "total") | F.col("what").isNotNull()).groupBy(F.col("of").alias("kind"), F.col("what").alias("key")).agg(F.sum("n").alias("count"))
    domains = cells.agg(F.count_distinct("key").alias("count")).select(F.lit("domains").alias("kind"), nothing.alias("key"), "count")
    if exact:
        ids = partials.where("kind = 'id'").agg(F.count_distinct("key").alias("count"))
    else:
        ids = cells.agg(F.hll_sketch_estimate(F.hll_union_agg("ids")).alias("count"))
    return counts.unionByName(domains).unionByName(ids.select(F.lit("distinct_ids").alias("kind"), nothing.alias("key"), "count"))


def merged_final_statistics(partials: DataFrame) -> DataFrame:
    """As ``stats.final_statistics`` over the rows of all runs."""
    return _cells(partials).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"), F.count_distinct("key").alias("domains"), _mean("difficulty").alias("avg_difficulty"),
        _mean("instruction").alias("avg_instruction_length"), _mean("response").alias("avg_response_length"))


def merged_usage(tables: DataFrame) -> DataFrame:
    """The sum of usage tables (``stats.usage_metrics`` of several runs) per provider; the row
    over all is the sum of theirs."""
    numbers = [c for c in tables.columns if c.startswith("total_") or c.endswith("_requests")]
    return tables.groupBy("provider").agg(*[F.sum(c).alias(c) for c in numbers])
