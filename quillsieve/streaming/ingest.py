"""Incremental seed ingest and resumable work."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quillsieve.functions.text import json_document, strip
from quillsieve.operators.normalize import ensure_id, last_per_id
from quillsieve.operators.rules import content_reasons, reasons, schema_reasons
from quillsieve.sources.readers import record_to_sample


# About as much of the dropped files is one micro-batch.
BATCH_BYTES = 4 << 30
STORE_BUCKETS = 64
_BUCKET = "id_bucket"


def check_lines(lines: DataFrame, rules: dict | None = None) -> DataFrame:
    """Raw lines (column ``value``; other columns are kept) to typed samples with reject
    reasons; works on batches and streams. A difficulty given as a string is not range
    checked."""
    kept = [c for c in lines.columns if c != "value"]
    parsed = lines.where(strip(F.col("value")) != "").withColumn("record", json_document(F.col("value")))
    has_metadata = F.try_variant_get("record", "$.metadata", "variant").isNotNull()
    difficulty = F.try_variant_get("record", "$.metadata.difficulty", "variant")
    is_text = F.coalesce(F.schema_of_variant(difficulty) == "STRING", F.lit(False))
    wide = parsed.select(
        "value", *kept, F.col("record").isNull().alias("__broken"), has_metadata.alias("__has_metadata"), is_text.alias("__is_text"),
        schema_reasons(F.col("record")).alias("__schema"), *record_to_sample(F.col("record")),
    )
    content = content_reasons(
        F.col("instruction"), F.col("response.origin_text"), F.col("metadata.domain"),
        F.when(~F.col("__is_text"), F.col("metadata.difficulty")), F.col("__has_metadata"), **(rules or {}),
    )
    why = F.when(F.col("__broken"), reasons(("malformed", F.lit(True)))).otherwise(
        F.when(F.size("__schema") > 0, F.col("__schema")).otherwise(content)
    )
    return wide.withColumn("reject_reasons", why).drop("__broken", "__has_metadata", "__is_text", "__schema")


def start_ingest(
    spark: SparkSession,
    source: str,
    valid_path: str,
    quarantine_path: str,
    checkpoint: str,
    pattern: str = "*.jsonl",
    rules: dict | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> StreamingQuery:
    """Take newly dropped JSONL files, write valid samples and quarantine, and stop when
    all files present have been read, in micro-batches of about ``batch_bytes``.

    Every line that is not blank ends in one of the two tables, however old its file is and
    however often it was seen; :func:`ingested` gives the last version of each id. No state
    is held but the names of the files read. Each micro-batch is written under its batch id with overwrite, so a batch
    repeated after a failure does not add rows twice.
    """
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    # by default the source passes over files a week older than the newest one it has seen
    lines = reader.option("maxFileAge", "36500d").option("maxBytesPerTrigger", batch_bytes).text(source)
    dropped = lines.select("value", F.col("_metadata.file_modification_time").alias("dropped_at"), F.col("_metadata.file_path").alias("file"))
    checked = check_lines(dropped, rules)

    def sink(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()  # bounded by batch_bytes
        good = ensure_id(rows.where(F.size("reject_reasons") == 0)).withColumn("line_hash", F.xxhash64("value"))
        good.drop("reject_reasons", "value").write.mode("overwrite").parquet(f"{valid_path}/batch={batch_id}")
        bad = rows.where(F.size("reject_reasons") > 0).select("value", "reject_reasons", "dropped_at", "file")
        bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        rows.unpersist()

    return (
        checked.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


_ORDER = ["batch", "dropped_at", "file", "line_hash"]


def ingested(spark: SparkSession, valid_path: str, store_path: str | None = None, buckets: int = STORE_BUCKETS) -> DataFrame:
    """The valid samples, one per id. Of several versions the last wins: that of the latest
    micro-batch, in it that of the file modified last, then of the greatest file name; lines
    of one file that share an id are settled by a hash of the line.

    With a store (:func:`compact`) its rows are read as they are; only ids in buckets that
    batches after it have touched are settled again.
    """
    valid = spark.read.parquet(valid_path)
    if store_path is None:
        return last_per_id(valid, _ORDER).drop(*_ORDER)
    upto, held = _generations(spark, store_path)
    fresh = valid.where(F.col("batch") > upto).withColumn(_BUCKET, _bucket(buckets))
    touched = {r[_BUCKET] for r in fresh.select(_BUCKET).distinct().collect()}
    parts = []
    if touched:
        parts.append(_settled(spark, store_path, held, fresh, touched))
    if kept := {b: g for b, g in held.items() if b not in touched}:
        parts.append(_stored(spark, store_path, kept))
    out = parts[0] if parts else fresh
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out.drop(*_ORDER, _BUCKET)


def compact(spark: SparkSession, valid_path: str, store_path: str, buckets: int = STORE_BUCKETS) -> list[int]:
    """Settle the batches that came after the last run into the store, and return the buckets
    that were written anew. The store is bucketed by a hash of the id; a bucket without new
    rows is not read. A generation counts once its commit is there, so a run that breaks
    off leaves the one before in force and can be repeated."""
    upto, held = _generations(spark, store_path)
    fresh = spark.read.parquet(valid_path).where(F.col("batch") > upto).withColumn(_BUCKET, _bucket(buckets))
    seen = fresh.groupBy(_BUCKET).agg(F.max("batch").alias("batch")).collect()
    if not seen:
        return []
    touched, generation = {r[_BUCKET] for r in seen}, max(r["batch"] for r in seen)
    rows = _settled(spark, store_path, held, fresh, touched).repartition(_BUCKET, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)))
    rows.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{store_path}/rows/generation={generation}")
    commit = spark.createDataFrame([(b, buckets) for b in sorted(touched)], f"{_BUCKET} int, buckets int")
    commit.coalesce(1).write.mode("overwrite").parquet(f"{store_path}/commits/generation={generation}")
    return sorted(touched)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")


def _generations(spark: SparkSession, store_path: str) -> tuple[int, dict[int, int]]:
    """The last batch in the store, and the generation in force of each bucket."""
    try:
        commits = spark.read.parquet(f"{store_path}/commits")
    except AnalysisException:  # nothing is there yet
        return -1, {}
    held = {r[_BUCKET]: r["g"] for r in commits.groupBy(_BUCKET).agg(F.max("generation").alias("g")).collect()}
    return max(held.values()), held


def _stored(spark: SparkSession, store_path: str, held: dict[int, int]) -> DataFrame:
    """The rows of some buckets in their generations; at most one folder for each bucket."""
    base = f"{store_path}/rows"
    paths = [f"{base}/generation={g}/{_BUCKET}={b}" for b, g in sorted(held.items())]
    return spark.read.option("basePath", base).parquet(*paths).drop("generation")


def _settled(spark: SparkSession, store_path: str, held: dict[int, int], fresh: DataFrame, touched: set[int]) -> DataFrame:
    """The last version of each id among the stored and the fresh rows of some buckets."""
    rows = fresh
    if old := {b: g for b, g in held.items() if b in touched}:
        rows = rows.unionByName(_stored(spark, store_path, old), allowMissingColumns=True)
    return last_per_id(rows, _ORDER)


def pending(df: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows not yet in the sink: resume of a batch job after a break."""
    return df.join(done.select(key), key, "left_anti")
