"""Writers: JSONL, stage tables with a latest view, seed store, run summary, usage metrics."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Buckets of a stage table that is joined by id.
BUCKETS = 64


# Rows of a CSV or TSV file. A file whose quoted fields span lines is read by one task.
FILE_ROWS = 5_000


def write_flat(df: DataFrame, path: str, sep: str = ",", part: str | None = None, file_rows: int = FILE_ROWS) -> None:
    """Flat rows as CSV (or TSV) files with a header and all fields quoted, of at most
    ``file_rows`` rows each, below a folder for each value of ``part`` if it is named."""
    writer = df.write.partitionBy(part) if part else df.write
    writer = writer.option("header", "true").option("sep", sep).option("maxRecordsPerFile", file_rows)
    writer.option("quote", '"').option("escape", '"').option("quoteAll", "true").csv(path)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, replacing what is there; parent folders are made."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def to_record(df: DataFrame) -> DataFrame:
    """The typed sample row as the nested record of the JSON files: evaluations,
    verification, filtering and advanced scores go below ``metadata``."""
    metadata = F.col("metadata")
    for name in ("evaluations", "verification", "filtering", "advanced"):
        if name in df.columns:
            metadata = metadata.withField(name, F.col(name))
    return df.select("id", "instruction", "response", metadata.alias("metadata"))


def write_stage(df: DataFrame, path: str, run_id: str) -> int:
    """Write one run of a stage table under ``run_id=...`` and return its row count. A
    repeated run with the same id replaces its own partition only."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
    return seen.get["rows"]


def _folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names right below a folder, in any file system that Spark reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return [entry.getPath().getName() for entry in system.listStatus(where)] if system.exists(where) else []


def read_stage(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """One run of a stage table, the latest (greatest run id as a string) by default. Only
    that run's folder is read; the latest is found from the names of the runs' folders, the
    files in them are not listed. A run that is not there raises."""
    if run_id is None:
        runs = [name.removeprefix("run_id=") for name in _folder_names(spark, path) if name.startswith("run_id=")]
        if not runs:
            raise FileNotFoundError(f"no run below {path}")
        run_id = max(runs)
    return spark.read.parquet(f"{path}/run_id={run_id}")


def write_bucketed(df: DataFrame, path: str, key: str = "id", buckets: int = BUCKETS, mode: str = "overwrite") -> None:
    """Write a table bucketed and sorted by a hash of the key. Tables with the same buckets
    join on the key without a shuffle; ``mode="append"`` adds files to the buckets. The
    table is entered in the session's catalog under a name made from its path."""
    where = f"{path}/by_{key}_{buckets}"
    name = _table_name(where)
    if mode == "overwrite":
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    elif not df.sparkSession.catalog.tableExists(name):
        _register(df.sparkSession, where, key, buckets)
    spread = df.repartition(buckets, key)  # each task writes whole buckets
    spread.write.format("parquet").mode(mode).bucketBy(buckets, key).sortBy(key).option("path", where).saveAsTable(name)


def read_bucketed(spark: SparkSession, path: str, key: str = "id", buckets: int = BUCKETS) -> DataFrame:
    """A table of :func:`write_bucketed`, also one that another session wrote."""
    where = f"{path}/by_{key}_{buckets}"
    if not spark.catalog.tableExists(_table_name(where)):
        _register(spark, where, key, buckets)
    return spark.table(_table_name(where))


def _table_name(where: str) -> str:
    return "bucketed_" + hashlib.md5(where.encode()).hexdigest()


def _register(spark: SparkSession, where: str, key: str, buckets: int) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(where).schema)
    spark.sql(
        f"CREATE TABLE {_table_name(where)} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{where}'")


def append_seed(valid: DataFrame, path: str) -> int:
    """Append validated rows to the seed store as JSONL; the count is taken on the way."""
    seen = Observation()
    valid.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").option(
        "ignoreNullFields", "true"
    ).json(path)
    return seen.get["rows"]


def write_summary(spark: SparkSession, path: str, stages: dict[str, tuple[int, str]], seconds: float) -> None:
    """One JSON row: count and path per stage and the run time."""
    rows = [(name, count, where) for name, (count, where) in stages.items()]
    table = spark.createDataFrame(rows, "stage string, count bigint, path string")
    entry = F.map_from_entries(F.collect_list(F.struct("stage", F.struct("count", "path"))))
    summary = table.agg(entry.alias("stages")).withColumn("execution_time", F.lit(float(seconds)))
    summary.coalesce(1).write.mode("overwrite").json(path)


def write_usage(metrics: DataFrame, path: str, saved_at: str) -> None:
    """Usage metrics with a time stamp, one JSON line per provider and one overall."""
    metrics.withColumn("timestamp", F.lit(saved_at).cast("timestamp")).coalesce(1).write.mode("overwrite").json(path)
