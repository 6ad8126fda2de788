"""Session settings, the shared work folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_CONF_KEY = "spark.checkpoint.dir"


def build_session(app: str = "quillsieve", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE, skew join)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A local master may run without it and gets a temporary folder; on a cluster
    the setting is required, because a machine-local folder is lost with its host.
    """
    configured = spark.conf.get(_CONF_KEY, None) or spark.sparkContext.getConf().get(_CONF_KEY)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_CONF_KEY} to a folder shared by the whole cluster")
    path = tempfile.mkdtemp(prefix="quillsieve-")
    spark.conf.set(_CONF_KEY, path)
    return path


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/quillsieve/{label}-{uuid.uuid4().hex}"


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once as a Parquet table in the shared folder; return the table read
    back and its row count, which is observed during the write.

    Cuts lineage, so later actions neither recompute the input nor see another
    version of it, and a lost executor costs a re-read only.
    """
    path = stage_path(df.sparkSession, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def stage(df: DataFrame, label: str) -> DataFrame:
    """The table of :func:`stage_counted` without the count."""
    return stage_counted(df, label)[0]


# Largest lookup side that is broadcast, in rows. Lookup rows are narrow (a key and
# a few numbers or short strings), so this is a few tens of MB at most.
BROADCAST_ROWS = 200_000
# A key with more than one part in this many of all rows is hot; so there are at most
# this many hot keys.
HOT_SHARE = 2000
# Bytes for each core from which an input is not small.
LARGE_BYTES = 128 << 20


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    max_rows: int = BROADCAST_ROWS,
    bound: int | None = None,
    hot_share: int = HOT_SHARE,
    counted: str | None = None,
) -> DataFrame:
    """Join a (usually large) frame to a lookup table with one or few rows per key.

    The lookup is staged and counted: up to ``max_rows`` rows it is broadcast.
    ``bound`` is a known upper limit of the lookup's rows (for instance the counted
    rows of the table it is grouped from); within ``max_rows`` it replaces the count.

    A larger lookup is joined by a shuffle, except for hot keys. Those are the keys with
    more than ``1/hot_share`` of the rows of ``df``, at most ``hot_share`` of them, so
    their lookup rows are few and are broadcast; a key that holds a third of the rows
    never meets in one task. ``counted`` is a column of the lookup that holds the number of
    rows of ``df`` with its key, which need not be counted again then. Inner, left, left_semi
    and left_anti joins only.
    """
    if bound is not None and bound <= max_rows:
        return df.join(F.broadcast(lookup), on, how)
    lookup, rows = stage_counted(lookup, "lookup")
    if rows <= max_rows:
        return df.join(F.broadcast(lookup), on, how)
    # rows without a key match nothing and need not meet in one task
    without = " OR ".join(f"`{k}` IS NULL" for k in on)
    keyed, loose = df.where(f"NOT ({without})"), df.where(without)
    if counted:
        counts, total = lookup.select(*on, F.col(counted).alias("__n")), lookup.agg(F.sum(counted)).first()[0]
        most = counts.orderBy(F.col("__n").desc()).limit(hot_share).collect()
    else:
        seen = Observation()
        counts = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).observe(seen, F.sum("__n").alias("rows"))
        most = counts.orderBy(F.col("__n").desc()).limit(hot_share).collect()
        total = seen.get["rows"]
    limit = (total or 0) / hot_share
    hot_keys = [r[:-1] for r in map(tuple, most) if r[-1] > limit]
    if hot_keys:
        hot = F.broadcast(df.sparkSession.createDataFrame(hot_keys, df.select(*on).schema))
        warm = keyed.join(hot, on, "left_semi").join(F.broadcast(lookup.join(hot, on, "left_semi")), on, how)
        joined = warm.unionByName(keyed.join(hot, on, "left_anti").join(lookup, on, how))
    else:
        joined = keyed.join(lookup, on, how)
    if how == "left":
        return joined.unionByName(loose, allowMissingColumns=True)
    return joined.unionByName(loose) if how == "left_anti" else joined


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a small input by hash of the keys, as it may be one file with one row
    group. An input of a file and more for each core, or one that the optimizer takes for large,
    is returned as it is: it has partitions enough. No job is started to find out."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return df if int(size) >= cores * LARGE_BYTES else df.repartition(cores, *keys)
