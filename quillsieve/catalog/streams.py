"""Streaming queries, run until everything present has been read."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.views import CALLS, CONVS, conversation_samples, table, call_log
from quillsieve.session import stage_path
from quillsieve.sources.writers import read_bucketed, to_record, write_bucketed
from quillsieve.streaming import ingest, usage


def _calls_from(events):
    """The call log columns of an events stream."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        "ts", F.col("event_type").alias("provider"), F.when(F.col("event_type") == "error", "error").alias("error"),
        k.alias("prompt_tokens"), F.floor("value").cast("bigint").alias("completion_tokens"),
        (k * 0.5).alias("cost"), F.col("value").alias("latency"),
    )


_HOURLY = """SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M') AS window_start, provider, count(*) AS total_requests,
  count(*) FILTER (WHERE error IS NULL) AS successful_requests, count(error) AS failed_requests, sum(prompt_tokens)::BIGINT AS total_prompt_tokens,
  sum(completion_tokens)::BIGINT AS total_completion_tokens, round(sum(cost), 4) AS total_cost, round(sum(latency), 3) AS total_latency FROM calls"""


def _hourly(df):
    return df.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "provider", "total_requests", "successful_requests",
        "failed_requests", "total_prompt_tokens", "total_completion_tokens", F.round("total_cost", 4).alias("total_cost"),
        F.round("total_latency", 3).alias("total_latency"),
    )


@query("s2_hourly_usage_stream", f"""WITH {CALLS} {_HOURLY}
WHERE time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM calls) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def _(spark, sf):
    schema = table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    out, checkpoint = stage_path(spark, "usage-stream"), stage_path(spark, "usage-checkpoint")
    usage.write_hourly_usage(_calls_from(events), out, checkpoint).awaitTermination()
    return _hourly(spark.read.parquet(out))


@query("s2_hourly_usage_batch", f"WITH {CALLS} {_HOURLY} GROUP BY 1, 2")
def _(spark, sf):
    return _hourly(usage.hourly_usage(_calls_from(table(spark, sf, "events"))))


@query("s1_stream_ingest", f"""WITH {CONVS} SELECT domain AS side, count(*) AS rows, sum(length(origin_text))::BIGINT AS chars FROM convs WHERE length(instruction) >= 100 GROUP BY domain
UNION ALL SELECT 'short_instruction', 2 * count(*), 0 FROM convs WHERE length(instruction) < 100""")
def _(spark, sf):
    source, valid, bad, checkpoint = (stage_path(spark, f"ingest-{x}") for x in ("source", "valid", "bad", "checkpoint"))
    records = to_record(conversation_samples(spark, sf)).select(F.to_json(F.struct("id", "instruction", "response", "metadata")).alias("value"))
    for _drop in range(2):  # the same records are dropped twice: a sample counts once, each reject is kept
        records.write.mode("append").text(source)
    rules = {"min_instruction": 100}
    ingest.start_ingest(spark, source, valid, bad, checkpoint, pattern="*.txt", rules=rules).awaitTermination()
    kept = ingest.ingested(spark, valid).groupBy(F.col("metadata.domain").alias("side")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.length("response.origin_text")).alias("chars")
    )
    rejected = spark.read.parquet(bad).groupBy(F.array_join("reject_reasons", ",").alias("side")).agg(F.count(F.lit(1)).alias("rows"))
    return kept.unionByName(rejected.withColumn("chars", F.lit(0).cast("bigint")))


@query("s1_stream_store", f"""WITH {CONVS} SELECT id, domain, CASE WHEN domain = 'opening' THEN 'twice' ELSE 'once' END AS version, length(origin_text)::BIGINT AS chars FROM convs""")
def _(spark, sf):
    source, valid, bad, checkpoint, store = (stage_path(spark, f"store-{x}") for x in ("source", "valid", "bad", "checkpoint", "rows"))
    record = F.to_json(F.struct("id", "instruction", "response", "metadata"))
    samples = to_record(conversation_samples(spark, sf))

    def drop(rows, version):
        tagged = rows.withColumn("metadata", F.col("metadata").withField("source", F.lit(version)))
        tagged.select(record.alias("value")).repartition(4, "value").write.mode("append").text(source)
        # small enough for several micro-batches
        ingest.start_ingest(spark, source, valid, bad, checkpoint, pattern="*.txt", batch_bytes=256 << 10).awaitTermination()

    drop(samples, "once")
    ingest.compact(spark, valid, store, buckets=8)
    drop(samples.where("metadata.domain = 'opening'"), "twice")
    found = ingest.ingested(spark, valid, store, buckets=8)
    return found.select("id", F.col("metadata.domain").alias("domain"), F.col("metadata.source").alias("version"), F.length("response.origin_text").cast("bigint").alias("chars"))


@query("s3_resume", f"WITH {CALLS} SELECT id, provider FROM calls WHERE provider <> 'click'")
def _(spark, sf):
    calls = call_log(spark, sf).select("id", "provider")
    done = stage_path(spark, "done")
    calls.where("provider = 'click'").write.parquet(done)
    return ingest.pending(calls, spark.read.parquet(done))


@query("s3_resume_bucketed", f"WITH {CALLS} SELECT id, provider FROM calls WHERE provider NOT IN ('click', 'view')")
def _(spark, sf):
    calls = call_log(spark, sf).select("id", "provider")
    work, done = stage_path(spark, "work"), stage_path(spark, "done")
    write_bucketed(calls, work, buckets=8)
    write_bucketed(calls.where("provider = 'click'").select("id"), done, buckets=8)
    write_bucketed(calls.where("provider = 'view'").select("id"), done, buckets=8, mode="append")
    return ingest.pending(read_bucketed(spark, work, buckets=8), read_bucketed(spark, done, buckets=8))
