"""Lookups and random samples over the seed table, and its partitioned index."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.fixed_values import DIFFICULTY_BUCKETS
from quillsieve.functions.keys import hash60
from quillsieve.functions.scales import bucket_of, difficulty_bucket
from quillsieve.operators.ranking import top_rows
from quillsieve.session import stage_counted

DOMAIN = "metadata.domain"
DIFFICULTY = "metadata.difficulty"


def random_rows(df: DataFrame, count: int, seed: str = "0", id_col: str = "id") -> DataFrame:
    """``count`` rows without replacement, all rows if there are fewer. The order is a
    hash of seed and id, so a run can be repeated."""
    return top_rows(df, count, -hash60(F.lit(seed), F.col(id_col)), id_col=id_col)


def in_bucket_range(low: float = 0.0, high: float = 1.0, buckets: int = DIFFICULTY_BUCKETS,
                    column: Column | None = None) -> Column:
    """True for rows whose difficulty bucket lies between the buckets of the bounds."""
    bucket = difficulty_bucket(F.col(DIFFICULTY) if column is None else column, buckets)
    return bucket.between(bucket_of(low, buckets), bucket_of(high, buckets))


def by_id(df: DataFrame, sample_id: str) -> DataFrame:
    """Point lookup."""
    return df.where(F.col("id") == sample_id)


def by_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is in ``ids``."""
    return df.join(ids.select("id"), "id", "left_semi")


def by_domain(df: DataFrame, domain: str, limit: int | None = None, seed: str = "0") -> DataFrame:
    found = df.where(F.col(DOMAIN) == domain)
    return found if limit is None else random_rows(found, limit, seed)


def by_difficulty(df: DataFrame, low: float = 0.0, high: float = 1.0, limit: int | None = None,
                  buckets: int = DIFFICULTY_BUCKETS, seed: str = "0") -> DataFrame:
    """Whole buckets, not the exact range."""
    found = df.where(in_bucket_range(low, high, buckets))
    return found if limit is None else random_rows(found, limit, seed)


def random_samples(df: DataFrame, count: int, domain: str | None = None, low: float | None = None,
                   high: float | None = None, buckets: int = DIFFICULTY_BUCKETS, seed: str = "0") -> DataFrame:
    """Random rows among those that meet the domain and bucket conditions."""
    if domain is not None:
        df = df.where(F.col(DOMAIN) == domain)
    if low is not None or high is not None:
        df = df.where(in_bucket_range(0.0 if low is None else low, 1.0 if high is None else high, buckets))
    return random_rows(df, count, seed)


def write_index(df: DataFrame, path: str, buckets: int = DIFFICULTY_BUCKETS) -> None:
    """Write the table partitioned by domain and difficulty bucket. Rows are spread by a
    hash of the id first, so each task writes a slice of every partition and a hot
    domain is not written by one task."""
    tagged = df.withColumn("domain", F.col(DOMAIN)).withColumn(
        "difficulty_bucket", difficulty_bucket(F.col(DIFFICULTY), buckets)
    )
    spread = tagged.repartition("domain", "difficulty_bucket", F.pmod(F.xxhash64("id"), F.lit(64)))
    spread.write.mode("overwrite").partitionBy("domain", "difficulty_bucket").parquet(path)


def read_index(spark: SparkSession, path: str, domain: str | None = None, low: float | None = None,
               high: float | None = None, buckets: int = DIFFICULTY_BUCKETS) -> DataFrame:
    """Read the index; domain and bucket conditions prune partitions. Domains come
    back as the strings they were, also those like ``007``, and bucket keys as integers."""
    kinds = {"domain": T.StringType(), "difficulty_bucket": T.IntegerType()}
    found = spark.read.option("basePath", path).parquet(path).schema
    schema = T.StructType([T.StructField(f.name, kinds.get(f.name, f.dataType)) for f in found])
    df = spark.read.schema(schema).option("basePath", path).parquet(path)
    if domain is not None:
        df = df.where(F.col("domain") == domain)
    if low is not None or high is not None:
        lo, hi = bucket_of(0.0 if low is None else low, buckets), bucket_of(1.0 if high is None else high, buckets)
        df = df.where(F.col("difficulty_bucket").between(lo, hi))
    return df


ID_BUCKETS = 256
_ID_COLUMN = "id_of_"  # and the number of buckets, so that a reader knows it
_FEW_IDS = 100_000


def _id_bucket(sample_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(sample_id), F.lit(buckets)).cast("int")


def write_id_index(df: DataFrame, path: str, buckets: int = ID_BUCKETS, row_group_bytes: int = 16 << 20) -> None:
    """Write the table bucketed by a hash of the id and sorted by it, with a Bloom filter on the
    id, so that a lookup opens one bucket's files and reads the row groups that may hold it.
    Rows without an id are in a bucket of their own and are spread by their content."""
    name = f"{_ID_COLUMN}{buckets}"
    unnamed = F.col("id").isNull()
    placed = df.withColumn(name, F.when(unnamed, F.lit(-1)).otherwise(_id_bucket(F.col("id"), buckets)))
    salt = F.when(unnamed, F.pmod(F.xxhash64("instruction"), F.lit(64)))
    writer = placed.repartition(name, salt).sortWithinPartitions(name, "id").write.mode("overwrite").partitionBy(name)
    writer.option("parquet.bloom.filter.enabled#id", "true").option("parquet.block.size", row_group_bytes).parquet(path)


def _id_index(spark: SparkSession, path: str) -> tuple[DataFrame, str, int]:
    index = spark.read.parquet(path)
    name = next((c for c in index.columns if re.fullmatch(_ID_COLUMN + r"\d+", c)), None)
    if name is None:
        raise ValueError(f"no id index at {path}")
    return index, name, int(name.removeprefix(_ID_COLUMN))


def find_id(spark: SparkSession, path: str, sample_id: str) -> DataFrame:
    """Point lookup in an id index: one bucket is listed, and in it only row groups whose
    range and Bloom filter admit the id are read."""
    index, name, buckets = _id_index(spark, path)
    return index.where((F.col(name) == _id_bucket(F.lit(sample_id), buckets)) & (F.col("id") == sample_id)).drop(name)


def find_ids(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame:
    """Rows of an id index whose id is in ``ids``. Few ids are pushed down as a list to their
    buckets; more are joined within the buckets that have any."""
    index, name, buckets = _id_index(spark, path)
    wanted, n = stage_counted(ids.select("id").dropna().distinct().withColumn(name, _id_bucket(F.col("id"), buckets)), "wanted-ids")
    used = [r[name] for r in wanted.select(name).distinct().collect()]  # at most the number of buckets
    part = index.where(F.col(name).isin(used))
    if n <= 1_000:
        return part.where(F.col("id").isin([r["id"] for r in wanted.collect()])).drop(name)
    return part.join(F.broadcast(wanted) if n <= _FEW_IDS else wanted, [name, "id"], "left_semi").drop(name)
