"""Queries on scores: scorers, aggregation, gates, verification."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.views import (
    ASSESSED, CONVS, DOCS, SCORED, assessed_documents, conversation_samples, distinct_ratio_sql, document_samples,
    label_scores, scored_documents, strip_sql, table, uniform_sql, words_sql,
)
from quillsieve.operators import gates, scoring, verify
from quillsieve.operators.gates import metric


def _r(column, digits: int = 9):
    return F.round(column, digits)


@query("e1_text_scorers", f"""WITH {CONVS}
SELECT id, round(least(1.0::DOUBLE, len({words_sql('instruction')}) / 60.0::DOUBLE), 9) AS complexity,
       round({distinct_ratio_sql('origin_text')}, 9) AS quality,
       round(least(1.0::DOUBLE, len(regexp_extract_all(rationale, '[.!?]+')) / 10.0::DOUBLE), 9) AS depth,
       CASE WHEN regexp_matches(origin_text, '(?i)(la|en) ') THEN 0.0 ELSE 1.0 END::DOUBLE AS safety,
       round({distinct_ratio_sql('rationale')}, 9) AS rationale FROM convs""")
def _(spark, sf):
    df = scoring.score(conversation_samples(spark, sf), scoring.text_scorers(blocked=("(la|en) ",)))
    return df.select(
        "id", _r(metric("instruction_complexity")).alias("complexity"), _r(metric("response_quality")).alias("quality"),
        _r(metric("reasoning_depth")).alias("depth"), metric("safety_score").alias("safety"),
        _r(metric("rationale_quality")).alias("rationale"),
    )


@query("e1_hash_scorers", f"""WITH {DOCS}
SELECT id, round(0.5 + 0.5 * {uniform_sql("'s1:' || id || ':response_quality'")}, 12) AS quality,
       round(0.5 + 0.5 * {uniform_sql("'s1:' || id || ':safety_score'")}, 12) AS safety FROM docs""")
def _(spark, sf):
    df = scoring.score(document_samples(spark, sf), scoring.hash_scorers(seed="s1"))
    return df.select("id", _r(metric("response_quality"), 12).alias("quality"), _r(metric("safety_score"), 12).alias("safety"))


@query("e1_table_scorer", f"""WITH {DOCS}
SELECT id, quality::DOUBLE AS response_quality, (1 - toxic)::DOUBLE AS safety_score,
       round({distinct_ratio_sql('rationale')}, 9) AS rationale FROM docs""")
def _(spark, sf):
    scored = scoring.score(document_samples(spark, sf), scoring.text_scorers(), metrics=("rationale_quality",))
    df = scoring.join_scores(scored, label_scores(spark, sf), ("response_quality", "safety_score"))
    return df.select(
        "id", metric("response_quality").alias("response_quality"), metric("safety_score").alias("safety_score"),
        _r(metric("rationale_quality")).alias("rationale"),
    )


@query("e2_rationale_and_answer", f"""WITH {DOCS}
SELECT id, CASE WHEN domain = 'es' THEN 0.0 ELSE round({distinct_ratio_sql('rationale')}, 9) END AS rationale_quality,
       CASE WHEN domain = 'es' THEN 0.0 ELSE (final_answer = {strip_sql('instruction')})::INT::DOUBLE END AS answer_accuracy FROM docs""")
def _(spark, sf):
    from quillsieve.functions.text import strip

    df = document_samples(spark, sf).withColumn("expected", strip(F.col("instruction")))
    df = df.withColumn("response", F.when(F.col("metadata.domain") != "es", F.col("response")))
    df = scoring.rationale_and_answer(df, scoring.answer_scorer()())
    return df.select("id", _r(F.col("rationale_quality")).alias("rationale_quality"), "answer_accuracy")


@query("e3_overall_score", f"""WITH {SCORED}
SELECT id, round((ic * 0.2::DOUBLE + coalesce(rq, 0) * 0.3::DOUBLE + rd * 0.3::DOUBLE + coalesce(ss, 0) * 1.0)
  / (0.2 + 0.3 + CASE WHEN rq IS NULL THEN 0 ELSE 0.3 END + CASE WHEN ss IS NULL THEN 0 ELSE 1.0 END)::DOUBLE, 9) AS overall,
  CASE WHEN ss IS NULL THEN 0.0 ELSE ss END AS only_safety FROM scored""")
def _(spark, sf):
    weights = {"instruction_complexity": 0.2, "response_quality": 0.3, "reasoning_depth": 0.3}
    zero = {"instruction_complexity": 0.0, "response_quality": 0.0, "reasoning_depth": 0.0}
    return scored_documents(spark, sf).select(
        "id", _r(scoring.overall_score(weights)).alias("overall"), scoring.overall_score(zero).alias("only_safety")
    )


@query("e4_combined_score", f"""WITH {SCORED}
SELECT id, round(coalesce(raq, 0) * 0.4::DOUBLE + coalesce(aa, 0) * 0.6::DOUBLE, 9) AS combined FROM scored""")
def _(spark, sf):
    return scored_documents(spark, sf).select("id", _r(scoring.combined_score(0.4, 0.6)).alias("combined"))


@query("e5_passes_thresholds", f"""WITH {ASSESSED}
SELECT id, coalesce(ss >= 0.9, true) AND overall >= 0.3 AND rd >= 0.2 AND coalesce(aa >= 0.6, true) AS passes FROM assessed""")
def _(spark, sf):
    limits = {"overall_score": 0.3, "reasoning_depth": 0.2, "answer_accuracy": 0.6, "unheard_of": 0.5}
    return assessed_documents(spark, sf).select("id", scoring.passes_thresholds(limits).alias("passes"))


@query("e6_judge_scores", """
WITH j AS (SELECT doc_id, quality * 4 + 1 AS clarity, toxic * 5 + 1 AS coherence, 3 AS accuracy, quality + toxic AS relevance FROM labels),
g AS (SELECT * FROM j WHERE clarity BETWEEN 1 AND 5 AND coherence BETWEEN 1 AND 5 AND relevance BETWEEN 1 AND 5)
SELECT doc_id::VARCHAR AS id, unnest(['clarity', 'coherence', 'accuracy', 'relevance']) AS metric,
       unnest([(clarity - 1) / 4.0::DOUBLE, (coherence - 1) / 4.0::DOUBLE, 0.5::DOUBLE, (relevance - 1) / 4.0::DOUBLE]) AS score FROM g
UNION ALL SELECT doc_id::VARCHAR, 'quarantined', NULL FROM j WHERE doc_id NOT IN (SELECT doc_id FROM g)""")
def _(spark, sf):
    judged = table(spark, sf, "labels").select(
        F.col("doc_id").cast("string").alias("id"), (F.col("quality") * 4 + 1).alias("clarity"),
        (F.col("toxic") * 5 + 1).alias("coherence"), F.lit(3).alias("accuracy"), (F.col("quality") + F.col("toxic")).alias("relevance"),
    )
    good, bad = scoring.judge_scores(judged)
    return good.unionByName(bad.select("id", F.lit("quarantined").alias("metric"), F.lit(None).cast("double").alias("score")))


@query("p3_assessment", f"""WITH {ASSESSED}
SELECT id, round(ic, 9) AS ic, rq, round(rd, 9) AS rd, ss, round(raq, 9) AS raq, round(overall, 9) AS overall, round(combined, 9) AS combined,
       coalesce(ss >= 0.9, true) AND overall >= 0.7 AS passes, '2024-05-01 12:30:15' AS stamped FROM assessed""")
def _(spark, sf):
    df = verify.verify(assessed_documents(spark, sf))
    return df.select(
        "id", _r(metric("instruction_complexity")).alias("ic"), metric("response_quality").alias("rq"),
        _r(metric("reasoning_depth")).alias("rd"), metric("safety_score").alias("ss"), _r(metric("rationale_quality")).alias("raq"),
        _r(metric("overall_score")).alias("overall"), _r(metric("combined_score")).alias("combined"),
        F.col("passes_thresholds").alias("passes"), F.date_format("evaluation_timestamp", "yyyy-MM-dd HH:mm:ss").alias("stamped"),
    )


# The gates, on documents that carry no evaluations at all when they are Spanish.
def _gated(spark, sf):
    df = assessed_documents(spark, sf)
    return df.withColumn("evaluations", F.when(F.col("metadata.domain") != "es", F.col("evaluations")))


_GATE = f"WITH {ASSESSED}, e AS (SELECT * FROM assessed WHERE domain <> 'es')"


@query("c8_quality_gate", f"""{_GATE}
SELECT id, round(overall, 9) AS overall FROM e
WHERE overall >= 0.4 AND coalesce(ss, 1) >= 0.9 AND rd >= 0.1 AND coalesce(raq, 0) >= 0.3 AND coalesce(aa, 0) >= 0.55""")
def _(spark, sf):
    kept = gates.filter_by_quality(
        _gated(spark, sf), 0.4, thresholds={"overall_score": 0.9, "reasoning_depth": 0.1, "safety_score": 0.1},
        rationale_threshold=0.3, answer_threshold=0.55,
    )
    return kept.select("id", _r(metric("overall_score")).alias("overall"))


@query("c9_metric_filter", f"{_GATE} SELECT id FROM e WHERE coalesce(aa >= 0.7, true) AND coalesce(rq >= 1, true)")
def _(spark, sf):
    return gates.filter_by_metrics(_gated(spark, sf), {"answer_accuracy": 0.7, "response_quality": 1.0, "absent": 0.9}).select("id")


_CODE_TASK = "regexp_matches(lower(instruction), 'code|function|program|implement')"
_MATH_TASK = "regexp_matches(lower(instruction), 'calculate|compute|solve|equation|math')"
_TASK = f"""WITH {CONVS}, tasked AS (SELECT * REPLACE (
    CASE WHEN domain = 'opening' THEN 'Solve it: ' || instruction WHEN difficulty > 0.5 THEN 'Write code. ' || instruction ELSE instruction END AS instruction,
    CASE WHEN domain = 'opening' THEN final_answer || ' ' || length(final_answer) || '.5' WHEN contains(final_answer, 'e') THEN final_answer || '```' || chr(10) || 'x```' ELSE final_answer END AS final_answer),
    CASE WHEN length(final_answer) > 50 THEN length(final_answer) + 0.5 ELSE 1.0 END::DOUBLE AS expected FROM convs),
v AS (SELECT id, domain, {_CODE_TASK} AS code_task, {_MATH_TASK} AS math_task, contains(final_answer, '```') AS has_code, expected,
  try_cast(regexp_extract_all(final_answer, '[0-9]+\\.?[0-9]*')[-1] AS DOUBLE) AS actual FROM tasked),
w AS (SELECT *, NOT code_task OR has_code AS code_ok, NOT math_task OR coalesce(abs(expected - actual) < 1e-6, false) AS math_ok FROM v)"""


def _tasks(spark, sf):
    df = conversation_samples(spark, sf)
    opening, answer = F.col("metadata.domain") == "opening", F.col("response.final_answer")
    numbered = F.concat(answer, F.lit(" "), F.length(answer).cast("string"), F.lit(".5"))
    fenced = F.when(answer.contains("e"), F.concat(answer, F.lit("```\nx```"))).otherwise(answer)
    return df.withColumn("expected", F.when(F.length(answer) > 50, F.length(answer) + 0.5).otherwise(F.lit(1.0))).withColumn(
        "instruction",
        F.when(opening, F.concat(F.lit("Solve it: "), F.col("instruction")))
        .when(F.col("metadata.difficulty") > 0.5, F.concat(F.lit("Write code. "), F.col("instruction"))).otherwise(F.col("instruction")),
    ).withColumn("response", F.col("response").withField("final_answer", F.when(opening, numbered).otherwise(fenced)))


def _verified(spark, sf):
    return verify.verify(_tasks(spark, sf), expected=F.col("expected"))


@query("e7_verification", f"{_TASK} SELECT id, code_ok AND math_ok AS verified, 'code_execution,math_validation' AS methods FROM w")
def _(spark, sf):
    return _verified(spark, sf).select(
        "id", F.col("verification.verified").alias("verified"), F.array_join("verification.methods", ",").alias("methods")
    )


@query("e7a_verify_code", f"""{_TASK} SELECT id, code_task AS applicable, code_ok AS correct,
  CASE WHEN NOT code_task THEN 'Not a code task' WHEN has_code THEN 'Code execution successful' ELSE 'No code found in response' END AS message FROM w""")
def _(spark, sf):
    result = F.try_element_at("verification.results", F.lit("code_execution"))
    return _verified(spark, sf).select(
        "id", result["is_applicable"].alias("applicable"), result["is_correct"].alias("correct"), result["message"].alias("message")
    )


@query("e7b_verify_math", f"""{_TASK} SELECT id, math_task AS applicable, math_ok AS correct,
  CASE WHEN NOT math_task THEN 'Not a math task' WHEN actual IS NULL THEN 'Could not extract answer' WHEN math_ok THEN 'Math validation successful' ELSE 'Math validation failed' END AS message,
  CASE WHEN math_task THEN actual END AS actual FROM w""")
def _(spark, sf):
    result = F.try_element_at("verification.results", F.lit("math_validation"))
    return _verified(spark, sf).select(
        "id", result["is_applicable"].alias("applicable"), result["is_correct"].alias("correct"),
        result["message"].alias("message"), result["actual_answer"].alias("actual"),
    )


@query("c10_verified_only", f"{_TASK} SELECT id, domain FROM w WHERE code_ok AND math_ok")
def _(spark, sf):
    return gates.filter_by_verification(_verified(spark, sf)).select("id", F.col("metadata.domain").alias("domain"))


@query("c10_unverified_only", f"{_TASK} SELECT id, domain FROM w WHERE NOT (code_ok AND math_ok)")
def _(spark, sf):
    return gates.filter_by_verification(_verified(spark, sf), False).select("id", F.col("metadata.domain").alias("domain"))


@query("c11_rationale_answer_gate", f"{_GATE} SELECT id FROM e WHERE coalesce(raq, 0) >= 0.4 AND coalesce(aa, 0) >= 0.6")
def _(spark, sf):
    return gates.filter_by_rationale_and_answer(_gated(spark, sf), 0.4, 0.6).select("id")


@query("u2_pandas_scorer", f"""WITH {CONVS}
SELECT id, round(least(1.0::DOUBLE, length(instruction) / 300.0::DOUBLE), 9) AS brevity FROM convs""")
def _(spark, sf):
    @F.pandas_udf("double")
    def length_share(texts: pd.Series) -> pd.Series:
        return (texts.str.len() / 300.0).clip(upper=1.0)

    df = scoring.score(conversation_samples(spark, sf), {"brevity": lambda: length_share(F.col("instruction"))})
    return df.select("id", _r(metric("brevity")).alias("brevity"))


