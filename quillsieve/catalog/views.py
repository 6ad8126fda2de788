"""Sample views over the given tables, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.fixed_values import WHITESPACE
from quillsieve.functions.keys import uniform
from quillsieve.functions.text import distinct_word_ratio
from quillsieve.operators.gates import metric
from quillsieve.operators.normalize import response_from_text
from quillsieve.operators.scoring import aggregate_scores, score, text_scorers
from quillsieve.session import lookup_join, spread

RUN_TIME = "2024-05-01T12:30:15Z"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text_table(spark: SparkSession, sf: str, name: str, *keys: str) -> DataFrame:
    """A table of long texts, spread over the cores if it has too few splits for them."""
    return spread(table(spark, sf, name), *keys)


def _doc_id():
    return F.concat(F.lit("d"), F.col("doc_id").cast("string"))


def document_samples(spark: SparkSession, sf: str, split: str = "last_line") -> DataFrame:
    """One sample per document: instruction is the first line, response the whole text."""
    docs = text_table(spark, sf, "documents", "doc_id")
    metadata = F.struct(
        F.col("lang").alias("domain"),
        F.least(F.lit(1.0), F.col("n_chars") / 10000.0).alias("difficulty"),
        F.col("source").alias("source"),
        F.lit(None).cast("timestamp").alias("creation_timestamp"),
        F.lit(None).cast("string").alias("seed_id"),
        F.lit(None).cast("double").alias("initial_quality"),
        F.lit(None).cast("map<string,string>").alias("extra"),
    )
    return docs.select(
        _doc_id().alias("id"),
        F.substring_index("text", "\n", 1).alias("instruction"),
        response_from_text(F.col("text"), split).alias("response"), metadata.alias("metadata"),
    )


def conversation_samples(spark: SparkSession, sf: str) -> DataFrame:
    """One sample per user turn that an assistant turn follows directly. The next turn is
    found by an equi-join on (conversation, turn), which spreads a very long
    conversation over many tasks; a window per conversation would not."""
    turns = text_table(spark, sf, "conversations", "conv_id", "turn")
    following = turns.where("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text")
    )
    pairs = turns.where("role = 'user'").join(following, ["conv_id", "turn"])
    metadata = F.struct(
        F.when(F.col("turn") == 0, "opening").otherwise("follow_up").alias("domain"),
        F.least(F.lit(1.0), F.length("text") / 400.0).alias("difficulty"),
        F.lit("conversations").alias("source"), F.lit(None).cast("timestamp").alias("creation_timestamp"),
        F.lit(None).cast("string").alias("seed_id"), F.lit(None).cast("double").alias("initial_quality"),
        F.lit(None).cast("map<string,string>").alias("extra"),
    )
    return pairs.select(
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("instruction"), response_from_text(F.col("next_text"), "last_line").alias("response"),
        metadata.alias("metadata"),
    )


def label_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Score table (id, metric, score) from the labels."""
    labels = table(spark, sf, "labels").withColumn("id", _doc_id())
    entries = F.array(
        F.struct(F.lit("response_quality").alias("metric"), F.col("quality").cast("double").alias("score")),
        F.struct(F.lit("safety_score").alias("metric"), (1 - F.col("toxic")).cast("double").alias("score")),
    )
    return labels.select("id", F.inline(entries))


def scored_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with evaluations: text scorers, label scores where there are labels,
    and an answer score for English ones. Some metrics are thus absent in some rows."""
    labels = table(spark, sf, "labels").select(
        _doc_id().alias("id"),
        F.col("quality").cast("double").alias("__quality"), (1 - F.col("toxic")).cast("double").alias("__safe"),
    )
    text = text_scorers()
    english = F.col("metadata.domain") == "en"
    scorers = {
        "instruction_complexity": text["instruction_complexity"],
        "response_quality": lambda: F.col("__quality"),
        "reasoning_depth": text["reasoning_depth"],
        "safety_score": lambda: F.col("__safe"),
        "rationale_quality": lambda: distinct_word_ratio(F.col("response.rationale")),
        "answer_accuracy": lambda: F.when(english, 0.5 + 0.5 * uniform(F.lit("0"), F.col("id"), F.lit("answer_accuracy"))),
    }
    return score(lookup_join(document_samples(spark, sf), labels, ["id"]), scorers).drop("__quality", "__safe")


def assessed_documents(spark: SparkSession, sf: str) -> DataFrame:
    return aggregate_scores(scored_documents(spark, sf), evaluated_at=RUN_TIME)


def metric_columns(df: DataFrame, *keep: str) -> DataFrame:
    """Id, kept columns and the metrics as plain columns."""
    return df.select(
        "id", *keep, F.col("metadata.domain").alias("domain"),
        metric("instruction_complexity").alias("ic"), metric("response_quality").alias("rq"),
        metric("reasoning_depth").alias("rd"), metric("safety_score").alias("ss"),
        metric("rationale_quality").alias("raq"), metric("answer_accuracy").alias("aa"),
    )


def call_log(spark: SparkSession, sf: str) -> DataFrame:
    """Model call records made from the events."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    completion = F.floor("value").cast("bigint")
    models = F.array(*[F.lit(m) for m in ("gpt-4", "deepseek-chat", "gemini-1.0-pro", "unpriced")])
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("id"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("provider"),
        F.get(models, F.pmod("user_id", F.lit(4)).cast("int")).alias("model"),
        F.when(F.col("event_type") == "error", "error").alias("error"),
        k.alias("prompt_tokens"), completion.alias("completion_tokens"), (k + completion).alias("tokens"),
        (k * 0.5).alias("cost"), F.col("value").alias("latency"),
    )


# --- the same views in SQL -------------------------------------------------------

WS = "||".join(f"chr({ord(c)})" for c in WHITESPACE)


def strip_sql(x: str) -> str:
    return f"trim({x}, {WS})"


def words_sql(x: str) -> str:
    return f"regexp_extract_all({x}, '\\S+')"


def normalized_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[ \\t\\n\\x0b\\f\\r]+', ' ', 'g'), ' ')"


def distinct_ratio_sql(x: str) -> str:
    w = words_sql(x)
    return f"(CASE WHEN len({w}) > 0 THEN len(list_distinct({w}))::DOUBLE / len({w}) ELSE 0.0 END)"


def hash60_sql(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 15))::BIGINT"


def uniform_sql(x: str) -> str:
    return f"(('0x' || substr(md5({x}), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def split_sql(text: str) -> str:
    body = f"rtrim({text}, {WS})"
    last = f"string_split({body}, chr(10))[-1]"
    return (
        f"rtrim(left({body}, length({body}) - length({last})), {WS}) AS rationale, {strip_sql(last)} AS final_answer"
    )


DOCS = f"""docs AS (
  SELECT 'd' || d.doc_id AS id, split_part(d.text, chr(10), 1) AS instruction, d.text AS origin_text,
         {split_sql('d.text')}, d.lang AS domain,
         least(1.0::DOUBLE, d.n_chars / 10000.0::DOUBLE) AS difficulty, d.source, l.quality, l.toxic
  FROM documents d LEFT JOIN labels l USING (doc_id))"""

CONVS = f"""turns AS (
  SELECT conv_id, turn, role, text,
         lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role,
         lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text FROM conversations),
convs AS (
  SELECT 'c' || conv_id || '_' || turn AS id, text AS instruction, next_text AS origin_text,
         {split_sql('next_text')}, CASE WHEN turn = 0 THEN 'opening' ELSE 'follow_up' END AS domain,
         least(1.0::DOUBLE, length(text) / 400.0::DOUBLE) AS difficulty, 'conversations' AS source
  FROM turns WHERE role = 'user' AND next_role = 'assistant')"""

SCORED = f"""{DOCS},
scored AS (
  SELECT *, least(1.0::DOUBLE, len({words_sql('instruction')}) / 60.0::DOUBLE) AS ic, quality::DOUBLE AS rq,
         least(1.0::DOUBLE, len(regexp_extract_all(rationale, '[.!?]+')) / 10.0::DOUBLE) AS rd,
         (1 - toxic)::DOUBLE AS ss, {distinct_ratio_sql('rationale')} AS raq,
         CASE WHEN domain = 'en' THEN 0.5::DOUBLE + 0.5::DOUBLE * {uniform_sql("'0:' || id || ':answer_accuracy'")} END AS aa
  FROM docs)"""

ASSESSED = f"""{SCORED},
assessed AS (
  SELECT *, (ic + coalesce(rq, 0) + rd + coalesce(ss, 0)) / (2 + (rq IS NOT NULL)::INT + (ss IS NOT NULL)::INT) AS overall,
         coalesce(raq, 0) * 0.5::DOUBLE + coalesce(aa, 0) * 0.5::DOUBLE AS combined FROM scored)"""

CALLS = """calls AS (
  SELECT event_id::VARCHAR AS id, ts, event_type AS provider,
         CASE user_id % 4 WHEN 0 THEN 'gpt-4' WHEN 1 THEN 'deepseek-chat' WHEN 2 THEN 'gemini-1.0-pro' ELSE 'unpriced' END AS model,
         CASE WHEN event_type = 'error' THEN 'error' END AS error,
         json_extract_string(props, '$.k')::BIGINT AS prompt_tokens, floor(value)::BIGINT AS completion_tokens,
         json_extract_string(props, '$.k')::BIGINT + floor(value)::BIGINT AS tokens,
         json_extract_string(props, '$.k')::BIGINT * 0.5::DOUBLE AS cost, value AS latency FROM events)"""
