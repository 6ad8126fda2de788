"""Queries on statistics, histograms, groups and usage metrics."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.views import ASSESSED, CALLS, CONVS, DOCS, assessed_documents, call_log, conversation_samples, document_samples, table
from quillsieve.operators import reports, rollups, rules, stats, verify
from quillsieve.operators.gates import metric
from quillsieve.session import stage, stage_path


@query("f1_seed_statistics", f"""WITH {DOCS}
SELECT count(*) AS count, count(DISTINCT source) AS file_count, round(avg(difficulty), 9) AS difficulty_mean,
       min(difficulty) AS difficulty_min, max(difficulty) AS difficulty_max FROM docs""")
def _(spark, sf):
    df = stats.seed_statistics(document_samples(spark, sf), F.col("metadata.source"))
    return df.withColumn("difficulty_mean", F.round("difficulty_mean", 9))


@query("f1_domain_distribution", f"WITH {DOCS} SELECT domain, count(*) AS count FROM docs WHERE domain <> 'es' GROUP BY domain")
def _(spark, sf):
    df = document_samples(spark, sf)
    known = F.when(F.col("metadata.domain") != "es", F.col("metadata.domain"))
    return stats.domain_distribution(df.withColumn("metadata", F.col("metadata").withField("domain", known)))


@query("f2_index_statistics", f"""WITH {DOCS}, b AS (SELECT *, least(floor(difficulty * 5), 4)::INT AS bucket FROM docs)
SELECT 'total' AS kind, NULL AS key, count(*) AS count FROM b UNION ALL SELECT 'distinct_ids', NULL, count(DISTINCT id) FROM b
UNION ALL SELECT 'domains', NULL, count(DISTINCT domain) FROM b UNION ALL SELECT 'domain', domain, count(*) FROM b GROUP BY domain
UNION ALL SELECT 'bucket', bucket::VARCHAR, count(*) FROM b GROUP BY bucket""")
def _(spark, sf):
    return stats.index_statistics(document_samples(spark, sf))


def _stats_sql(name: str, expr: str, source: str) -> str:
    return (f"SELECT '{name}' AS metric, round(avg({expr}), 6) AS mean, round(median({expr}), 6) AS median, min({expr})::DOUBLE AS min, "
            f"max({expr})::DOUBLE AS max, round(stddev_pop({expr}), 6) AS std, count({expr}) AS count FROM {source}")


@query("f3_basic_statistics", " UNION ALL ".join([
    _stats_sql("quantity", "l_quantity::DOUBLE", "lineitem"), _stats_sql("price", "l_extendedprice::DOUBLE", "lineitem"),
    "SELECT 'nothing', 0.0, 0.0, 0.0, 0.0, 0.0, 0"]))
def _(spark, sf):
    df = stats.basic_statistics(table(spark, sf, "lineitem"), {
        "quantity": F.col("l_quantity"), "price": F.col("l_extendedprice"), "nothing": F.lit(None).cast("double"),
    })
    return df.select("metric", *[F.round(c, 6).alias(c) for c in ("mean", "median")], "min", "max", F.round("std", 6).alias("std"), "count")


@query("f3a_histogram", """WITH v AS (SELECT l_extendedprice::DOUBLE AS v FROM lineitem), e AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
c AS (SELECT least(floor((v - lo) / (hi - lo) * 10), 9)::BIGINT AS bin, count(*) AS n FROM v, e GROUP BY 1)
SELECT r.bin, round(lo + r.bin * (hi - lo) / 10, 4) AS bin_start, round(lo + (r.bin + 1) * (hi - lo) / 10, 4) AS bin_end, coalesce(n, 0) AS count
FROM (SELECT unnest(range(10)) AS bin) r LEFT JOIN c USING (bin), e""")
def _(spark, sf):
    df = stats.histogram(table(spark, sf, "lineitem"), F.col("l_extendedprice"))
    return df.select("bin", F.round("bin_start", 4).alias("bin_start"), F.round("bin_end", 4).alias("bin_end"), "count")


@query("f3b_count_by_category", f"WITH {DOCS} SELECT coalesce(source, 'unknown') AS category, count(*) AS count FROM docs GROUP BY 1")
def _(spark, sf):
    return stats.count_by(document_samples(spark, sf), "metadata.source")


@query("f3c_metric_by_group", """
SELECT l_returnflag AS category, round(sum(l_quantity)::DOUBLE, 2) AS quantity, round(avg(l_extendedprice::DOUBLE), 6) AS price, max(l_discount)::DOUBLE AS discount
FROM lineitem GROUP BY 1""")
def _(spark, sf):
    return stats.metric_by_group(
        table(spark, sf, "lineitem"), "l_returnflag", quantity=F.round(F.sum("l_quantity").cast("double"), 2),
        price=F.round(F.avg(F.col("l_extendedprice").cast("double")), 6), discount=F.max("l_discount").cast("double"),
    )


@query("u4_pandas_group_metric", """
SELECT l_returnflag AS category, round(sum(l_extendedprice::DOUBLE * l_quantity::DOUBLE) / sum(l_quantity::DOUBLE), 4) AS metric FROM lineitem GROUP BY 1""")
def _(spark, sf):
    def weighted(rows: pd.DataFrame) -> dict[str, float]:
        return {"top": (rows["l_extendedprice"] * rows["l_quantity"]).sum(), "bottom": rows["l_quantity"].sum()}

    lines = table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_extendedprice").cast("double").alias("l_extendedprice"), F.col("l_quantity").cast("double").alias("l_quantity")
    )
    return stats.metric_by_group_pandas(
        lines, "l_returnflag", weighted, {"top": "sum", "bottom": "sum"}, F.round(F.col("top") / F.col("bottom"), 4)
    )


@query("f6_usage_metrics", f"""WITH {CALLS}
SELECT CASE WHEN grouping(provider) = 1 THEN 'all' ELSE provider END AS provider, count(*) AS total_requests,
  count(*) FILTER (WHERE error IS NULL) AS successful_requests, count(error) AS failed_requests,
  sum(prompt_tokens)::BIGINT AS total_prompt_tokens, sum(completion_tokens)::BIGINT AS total_completion_tokens, sum(tokens)::BIGINT AS total_tokens,
  round(sum(cost), 4) AS total_cost, round(sum(latency), 3) AS total_latency FROM calls GROUP BY ROLLUP (provider)""")
def _(spark, sf):
    df = stats.usage_metrics(call_log(spark, sf))
    return df.withColumn("total_cost", F.round("total_cost", 4)).withColumn("total_latency", F.round("total_latency", 3))


@query("f8_final_statistics", f"""WITH {DOCS}
SELECT count(*) AS count, count(DISTINCT domain) AS domains, round(avg(difficulty), 9) AS avg_difficulty,
       round(avg(length(instruction)), 6) AS avg_instruction_length, round(avg(length(origin_text)), 6) AS avg_response_length FROM docs""")
def _(spark, sf):
    df = stats.final_statistics(document_samples(spark, sf))
    return df.select("count", "domains", F.round("avg_difficulty", 9).alias("avg_difficulty"),
                     *[F.round(c, 6).alias(c) for c in ("avg_instruction_length", "avg_response_length")])


def _rounded(report):
    return report.withColumn("value", F.round("value", 6))


@query("f7_generation_report", f"""WITH {CONVS}, k AS (SELECT *, length(instruction) BETWEEN 50 AND 200 AND length(origin_text) BETWEEN 50 AND 200 AS ok FROM convs)
SELECT 'totals' AS section, 'all' AS key, 'total_generated' AS measure, count(*)::DOUBLE AS value FROM k
UNION ALL SELECT 'totals', 'all', 'passed_initial_filter', count(*) FILTER (WHERE ok) FROM k
UNION ALL SELECT 'totals', 'all', 'rejected', count(*) FILTER (WHERE NOT ok) FROM k
UNION ALL SELECT 'domain', domain, 'count', count(*) FROM k WHERE ok GROUP BY domain
UNION ALL SELECT 'difficulty', CASE WHEN difficulty < 0.3 THEN 'easy' WHEN difficulty <= 0.7 THEN 'medium' ELSE 'hard' END, 'count', count(*) FROM k WHERE ok GROUP BY 2""")
def _(spark, sf):
    df = conversation_samples(spark, sf)
    found = rules.filter_reasons(F.col("instruction"), F.col("response.origin_text"), max_length=200)
    return _rounded(reports.generation_report(df.withColumn("reject_reasons", found)))


_METRICS = (("instruction_complexity", "ic"), ("response_quality", "rq"), ("reasoning_depth", "rd"), ("safety_score", "ss"), ("overall_score", "overall"))


@query("f7_assessment_report", f"""WITH {ASSESSED}, v AS (SELECT *, NOT regexp_matches(lower(instruction), 'code|function|program|implement')
  AND NOT regexp_matches(lower(instruction), 'calculate|compute|solve|equation|math') AS verified FROM assessed)
SELECT 'totals' AS section, 'all' AS key, 'total_assessed' AS measure, count(*)::DOUBLE AS value FROM v
UNION ALL SELECT 'totals', 'all', 'passed_verification', count(*) FILTER (WHERE verified) FROM v
UNION ALL SELECT 'totals', 'all', 'failed_verification', count(*) FILTER (WHERE NOT verified) FROM v
UNION ALL SELECT 'domain', domain, 'mean_score', round(avg(overall), 6) FROM v GROUP BY domain
UNION ALL SELECT 'domain', domain, 'verification_success_rate', round(avg(verified::INT), 6) FROM v GROUP BY domain
""" + "".join(f"UNION ALL SELECT 'score', '{n}', unnest(['mean', 'median', 'std']), unnest([round(avg({c}), 6), round(median({c}), 6), round(stddev_pop({c}), 6)]) FROM v\n" for n, c in _METRICS))
def _(spark, sf):
    assessed = verify.verify(assessed_documents(spark, sf)).select("metadata", "evaluations", "verification")
    return _rounded(reports.assessment_report(stage(assessed, "assessed")))


@query("f12_rationale_answer_relation", f"""WITH {ASSESSED}
SELECT domain, round(avg(raq), 6) AS rationale_mean, round(avg(aa), 6) AS answer_mean, round(corr(raq, aa), 6) AS correlation FROM assessed GROUP BY domain""")
def _(spark, sf):
    df = assessed_documents(spark, sf).select(
        F.col("metadata.domain").alias("domain"), metric("rationale_quality").alias("rationale_quality"), metric("answer_accuracy").alias("answer_accuracy")
    )
    out = reports.rationale_answer_relation(df, ["domain"])
    return out.select("domain", *[F.round(c, 6).alias(c) for c in ("rationale_mean", "answer_mean", "correlation")])


# --- merged runs -----------------------------------------------------------------

def _runs(spark, sf):
    """The partials of the documents in three runs, each written from its own rows."""
    path = stage_path(spark, "partials")
    docs = document_samples(spark, sf)
    for k in range(3):
        rollups.write_partials(docs.where(F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(3)) == k), path, f"run{k}", F.col("metadata.source"))
    return rollups.read_partials(spark, path)


@query("f1_merged_statistics", f"""WITH {DOCS}
SELECT count(*) AS count, count(DISTINCT source) AS file_count, round(avg(difficulty), 9) AS difficulty_mean,
       min(difficulty) AS difficulty_min, max(difficulty) AS difficulty_max FROM docs""")
def _(spark, sf):
    return rollups.merged_seed_statistics(_runs(spark, sf)).withColumn("difficulty_mean", F.round("difficulty_mean", 9))


@query("f2_merged_statistics", f"""WITH {DOCS}, b AS (SELECT *, least(floor(difficulty * 5), 4)::INT AS bucket FROM docs)
SELECT 'total' AS kind, NULL AS key, count(*) AS count FROM b UNION ALL SELECT 'distinct_ids', NULL, count(DISTINCT id) FROM b
UNION ALL SELECT 'domains', NULL, count(DISTINCT domain) FROM b UNION ALL SELECT 'domain', domain, count(*) FROM b GROUP BY domain
UNION ALL SELECT 'bucket', bucket::VARCHAR, count(*) FROM b GROUP BY bucket""")
def _(spark, sf):
    return rollups.merged_index_statistics(_runs(spark, sf))


@query("f6_merged_usage", f"""WITH {CALLS} SELECT coalesce(provider, 'all') AS provider, count(*) AS total_requests, count(*) FILTER (WHERE error IS NULL) AS successful_requests,
  count(error) AS failed_requests, sum(tokens)::BIGINT AS total_tokens, round(sum(cost), 4) AS total_cost FROM calls GROUP BY ROLLUP (provider)""")
def _(spark, sf):
    path, calls = stage_path(spark, "usage-runs"), call_log(spark, sf)
    for k in range(3):
        part = calls.where(F.pmod(F.crc32(F.col("id").cast("binary")), F.lit(3)) == k)
        stats.usage_metrics(part).write.parquet(f"{path}/run_id=run{k}")
    return rollups.merged_usage(spark.read.parquet(path)).select(
        "provider", "total_requests", "successful_requests", "failed_requests", "total_tokens", F.round("total_cost", 4).alias("total_cost"))


@query("f8_merged_statistics", f"""WITH {DOCS}
SELECT count(*) AS count, count(DISTINCT domain) AS domains, round(avg(difficulty), 9) AS avg_difficulty,
  round(avg(length(instruction)), 6) AS avg_instruction_length, round(avg(length(origin_text)), 6) AS avg_response_length FROM docs""")
def _(spark, sf):
    merged = rollups.merged_final_statistics(_runs(spark, sf))
    return merged.select("count", "domains", F.round("avg_difficulty", 9).alias("avg_difficulty"), F.round("avg_instruction_length", 6).alias("avg_instruction_length"),
                         F.round("avg_response_length", 6).alias("avg_response_length"))
