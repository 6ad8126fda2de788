"""Row-level queries: normalisation, rules and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.views import (
    CALLS, CONVS, DOCS, call_log, conversation_samples, document_samples, normalized_sql, strip_sql, table, words_sql,
)
from quillsieve.fixed_values import TEMPLATES
from quillsieve.functions import chat, keys, scales, text
from quillsieve.operators import costs, normalize, rules


def _head(column: str):
    """Key of a long text in the results."""
    return F.md5(F.col(column))


# --- normalisation ---------------------------------------------------------------

@query("b1_response_struct", f"""WITH {DOCS}
SELECT id, md5(origin_text) AS origin, md5(rationale) AS rationale, md5(final_answer) AS answer FROM docs""")
def _(spark, sf):
    plain = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("text").alias("response"))
    df = normalize.ensure_response(plain, split="last_line")
    return df.select(
        "id", F.md5("response.origin_text").alias("origin"), F.md5("response.rationale").alias("rationale"),
        F.md5("response.final_answer").alias("answer"),
    )


@query("b2_nest_flat", """
SELECT 'd' || doc_id AS id, lang AS domain, CASE WHEN lang <> 'fr' THEN least(1.0::DOUBLE, n_chars / 10000.0::DOUBLE) END AS difficulty,
       source, n_chars::VARCHAR AS extra_chars, CASE WHEN lang = 'en' THEN lang ELSE md5(text) END AS answer
FROM documents""")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    as_json = F.to_json(F.struct(F.col("text").alias("origin_text"), F.col("text").alias("rationale"), F.col("lang").alias("final_answer")))
    flat = docs.select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"),
        F.substring_index("text", "\n", 1).alias("instruction"),
        F.when(F.col("lang") == "en", as_json).otherwise(F.col("text")).alias("response"),
        F.col("lang").alias("domain"),
        F.when(F.col("lang") == "fr", "hard").otherwise(F.least(F.lit(1.0), F.col("n_chars") / 10000.0).cast("string")).alias("difficulty"),
        "source", F.col("n_chars").cast("string").alias("chars"),
    )
    df = normalize.nest_flat(flat)
    answer = F.col("response.final_answer")
    return df.select(
        "id", F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty"),
        F.col("metadata.source").alias("source"), F.try_element_at("metadata.extra", F.lit("chars")).alias("extra_chars"),
        F.when(F.col("metadata.domain") == "en", answer).otherwise(F.md5(answer)).alias("answer"),
    )


@query("b3_merge_metadata", f"""WITH {DOCS}
SELECT id, 'merged' AS source, domain, CASE WHEN domain = 'en' THEN 'new' ELSE 'old' END AS tag,
       source AS origin, CASE WHEN domain = 'en' THEN source END AS added FROM docs""")
def _(spark, sf):
    df = document_samples(spark, sf)
    old = F.create_map(F.lit("tag"), F.lit("old"), F.lit("origin"), F.col("metadata.source"))
    new = F.when(F.col("metadata.domain") == "en", F.create_map(F.lit("tag"), F.lit("new"), F.lit("added"), F.col("metadata.source")))
    df = df.withColumn("metadata", F.col("metadata").withField("extra", old))
    df = df.withColumn("metadata", normalize.merge_metadata(F.col("metadata"), {"source": F.lit("merged")}, new))
    extra = F.col("metadata.extra")
    return df.select(
        "id", F.col("metadata.source").alias("source"), F.col("metadata.domain").alias("domain"),
        *[F.try_element_at(extra, F.lit(k)).alias(k) for k in ("tag", "origin", "added")],
    )


@query("b4_content_id", f"""WITH {DOCS}
SELECT CASE WHEN domain = 'en' THEN id ELSE 'seed_' || substr(sha256(instruction || chr(31) || origin_text), 1, 16) END AS id,
       count(*) AS n FROM docs GROUP BY 1""")
def _(spark, sf):
    df = document_samples(spark, sf).withColumn(
        "id", F.when(F.col("metadata.domain") == "en", F.col("id")).when(F.col("metadata.domain") == "fr", F.lit(""))
    )
    return normalize.ensure_id(df, "seed").groupBy("id").agg(F.count(F.lit(1)).alias("n"))


@query("b5_last_per_id", """
SELECT conv_id::VARCHAR AS id, arg_max(turn, turn) AS turn, arg_max(role, turn) AS role, md5(arg_max(text, turn)) AS body
FROM conversations GROUP BY 1""")
def _(spark, sf):
    turns = table(spark, sf, "conversations").select(F.col("conv_id").cast("string").alias("id"), "turn", "role", "text")
    return normalize.last_per_id(turns, ["turn"]).select("id", "turn", "role", _head("text").alias("body"))


@query("b6_path_category", f"""WITH {DOCS}
SELECT coalesce(source, 'unknown') AS source, difficulty::DOUBLE AS difficulty, 'unknown' AS absent, count(*) AS n
FROM docs GROUP BY ALL""")
def _(spark, sf):
    df = document_samples(spark, sf)
    # the engines print doubles differently, so the category is read as a number again
    return df.groupBy(
        normalize.path_category(df, "metadata.source").alias("source"),
        normalize.path_category(df, "metadata.difficulty").try_cast("double").alias("difficulty"),
        normalize.path_category(df, "metadata.topic.name").alias("absent"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query("b7_seed_lineage", f"""WITH {CONVS},
gen AS (SELECT t.conv_id || ':' || t.turn AS id, 'c' || conv_id || '_' || (turn - 1) AS seed_id FROM conversations t WHERE role = 'assistant')
SELECT gen.id, seed_id, coalesce(convs.domain, 'unknown') AS domain, coalesce(convs.difficulty, 0.5) AS difficulty, 'm1 generated' AS source
FROM gen LEFT JOIN convs ON convs.id = seed_id""")
def _(spark, sf):
    seeds = conversation_samples(spark, sf)
    answers = table(spark, sf, "conversations").where("role = 'assistant'").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string")).alias("seed_id"),
    )
    df = normalize.with_seed_lineage(answers, seeds, "m1", "2024-05-01T10:15:30Z")
    return df.select("id", *[F.col(f"metadata.{c}").alias(c) for c in ("seed_id", "domain", "difficulty", "source")])


# --- rules -----------------------------------------------------------------------

def _records(spark, sf):
    """Documents as JSON records with a fault per language: complete (en), difficulty as
    a string and a struct response (fr), no response (de), a number as id and a string
    as metadata (es)."""
    lang = F.col("lang")
    body = F.col("text")
    meta = F.struct(lang.alias("domain"), F.least(F.lit(1.0), F.col("n_chars") / 10000.0).alias("difficulty"))
    meta_text = F.struct(lang.alias("domain"), F.col("n_chars").cast("string").alias("difficulty"))
    ident = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    line = (
        F.when(lang == "en", F.to_json(F.struct(ident.alias("id"), body.alias("instruction"), body.alias("response"), meta.alias("metadata"))))
        .when(lang == "fr", F.to_json(F.struct(
            ident.alias("id"), body.alias("instruction"), F.struct(body.alias("origin_text")).alias("response"), meta_text.alias("metadata"))))
        .when(lang == "de", F.to_json(F.struct(ident.alias("id"), body.alias("instruction"), meta.alias("metadata"))))
        .otherwise(F.to_json(F.struct(F.col("doc_id").alias("id"), body.alias("instruction"), body.alias("response"), lang.alias("metadata"))))
    )
    return table(spark, sf, "documents").select("doc_id", "lang", F.try_parse_json(line).alias("record"))


@query("c1_required_fields", """
SELECT doc_id, lang NOT IN ('de', 'es') AS valid FROM documents""")
def _(spark, sf):
    return _records(spark, sf).select("doc_id", rules.has_required_fields(F.col("record")).alias("valid"))


@query("c2_schema_check", """
SELECT doc_id, CASE lang WHEN 'de' THEN 'missing:response' WHEN 'es' THEN 'type:id,type:metadata' ELSE '' END AS reasons FROM documents""")
def _(spark, sf):
    return _records(spark, sf).select("doc_id", F.array_join(rules.schema_reasons(F.col("record")), ",").alias("reasons"))


_C3 = f"""WITH {CONVS},
checked AS (SELECT id, domain, concat_ws(',',
  CASE WHEN length({strip_sql('instruction')}) < 60 THEN 'short_instruction' END,
  CASE WHEN length({strip_sql('final_answer')}) < 40 THEN 'short_response' END,
  CASE WHEN {strip_sql('instruction')} = {strip_sql('final_answer')} THEN 'identical' END,
  CASE WHEN difficulty * 1.5 > 1 THEN 'difficulty_range' END,
  CASE WHEN domain = 'opening' THEN 'no_domain' END) AS reasons FROM convs)"""


def _content(spark, sf):
    domain = F.when(F.col("metadata.domain") != "opening", F.col("metadata.domain"))
    return conversation_samples(spark, sf).withColumn("reject_reasons", rules.content_reasons(
        F.col("instruction"), F.col("response.final_answer"), domain, F.col("metadata.difficulty") * 1.5,
        F.lit(True), min_instruction=60, min_response=40, require_domain=True,
    ))


@query("c3_content_check", f"{_C3} SELECT id, reasons FROM checked")
def _(spark, sf):
    return _content(spark, sf).select("id", F.array_join("reject_reasons", ",").alias("reasons"))


@query("c4_batch_validate", f"""{_C3}
SELECT 'valid' AS side, '' AS reason, count(*) AS n FROM checked WHERE reasons = ''
UNION ALL SELECT 'quarantine', reason, count(*) FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM checked WHERE reasons <> '') GROUP BY reason""")
def _(spark, sf):
    valid, quarantine = rules.split_valid(_content(spark, sf))
    ok = valid.agg(F.count(F.lit(1)).alias("n")).select(F.lit("valid").alias("side"), F.lit("").alias("reason"), "n")
    bad = quarantine.select(F.explode("reject_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return ok.unionByName(bad.select(F.lit("quarantine").alias("side"), "reason", "n"))


_BANNED = ("credit card", "password", r"\bssn\b")


@query("c5_initial_filter", f"""WITH {CONVS}
SELECT id, length(instruction) AS instruction_chars FROM convs
WHERE length(instruction) BETWEEN 50 AND 2000 AND length(origin_text) BETWEEN 50 AND 2000
  AND {strip_sql('instruction')} <> {strip_sql('origin_text')}
  AND NOT regexp_matches(instruction || chr(10) || origin_text, '(?i)(credit card|password|\\bssn\\b)')
  AND NOT (regexp_matches(lower(instruction), 'code|function|program') AND NOT contains(origin_text, '```')
           AND len(list_filter(string_split(origin_text, chr(10)), lambda x: starts_with(x, '    ') OR starts_with(x, chr(9)))) < 3)
  AND NOT (contains(lower(instruction), 'json') AND starts_with({strip_sql('origin_text')}, '{{') AND NOT json_valid(origin_text))""")
def _(spark, sf):
    kept = rules.initial_filter(conversation_samples(spark, sf), banned_patterns=_BANNED)
    return kept.select("id", F.length("instruction").cast("bigint").alias("instruction_chars"))


@query("c5_filter_reasons", f"""WITH {DOCS}
SELECT id, concat_ws(',',
  CASE WHEN length(instruction) NOT BETWEEN 50 AND 2000 THEN 'instruction_length' END,
  CASE WHEN length(origin_text) NOT BETWEEN 50 AND 2000 THEN 'response_length' END,
  CASE WHEN {strip_sql('instruction')} = {strip_sql('origin_text')} THEN 'identical' END,
  CASE WHEN regexp_matches(lower(instruction), 'code|function|program') AND NOT contains(origin_text, '```')
       AND len(list_filter(string_split(origin_text, chr(10)), lambda x: starts_with(x, '    ') OR starts_with(x, chr(9)))) < 3 THEN 'no_code' END,
  CASE WHEN regexp_matches(instruction || chr(10) || origin_text, '(?i)(credit card|password|\\bssn\\b)') THEN 'banned' END) AS reasons FROM docs""")
def _(spark, sf):
    found = rules.filter_reasons(F.col("instruction"), F.col("response.origin_text"), banned_patterns=_BANNED)
    return document_samples(spark, sf).select("id", F.array_join(found, ",").alias("reasons"))


@query("c6_json_claim", """
SELECT event_id, event_type IN ('click', 'view') AS ok FROM events""")
def _(spark, sf):
    kind = F.col("event_type")
    body = F.when(kind == "click", F.col("props")).when(kind == "view", F.concat(F.lit("["), F.col("props"), F.lit("]"))).when(
        kind == "purchase", F.concat(F.col("props"), F.lit(" tail"))
    ).otherwise(F.expr("left(props, length(props) - 1)"))
    return table(spark, sf, "events").select("event_id", text.is_json_document(body).alias("ok"))


@query("c7_code_indent", """
SELECT doc_id, contains(text, '```') OR len(list_filter(string_split(text, chr(10)), lambda x: starts_with(x, '    ') OR starts_with(x, chr(9)))) >= 3 AS shows_code,
       len(list_filter(string_split(replace(text, ' a', chr(10) || chr(9)), chr(10)), lambda x: starts_with(x, '    ') OR starts_with(x, chr(9)))) AS indented
FROM documents""")
def _(spark, sf):
    t = F.col("text")
    widened = F.replace(t, F.lit(" a"), F.lit("\n\t"))
    return table(spark, sf, "documents").select(
        "doc_id", (t.contains("```") | (text.indented_lines(t) >= 3)).alias("shows_code"),
        text.indented_lines(widened).cast("bigint").alias("indented"),
    )


# --- scalar functions ------------------------------------------------------------

@query("d1_difficulty_bucket", """
SELECT event_id, least(floor(greatest(0.0, least(1.0, value / 40.0 - 0.5)) * 5), 4)::BIGINT AS bucket FROM events""")
def _(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", scales.difficulty_bucket(F.col("value") / 40.0 - 0.5).cast("bigint").alias("bucket")
    )


@query("d2_difficulty_band", f"""WITH {DOCS}
SELECT id, CASE WHEN toxic IS NULL THEN 'medium' WHEN difficulty < 0.4 THEN 'easy' WHEN difficulty > 0.7 THEN 'hard' ELSE 'medium' END AS band,
  CASE WHEN difficulty < 0.3 THEN 'easy' WHEN difficulty <= 0.7 THEN 'medium' ELSE 'hard' END AS report_band FROM docs""")
def _(spark, sf):
    labels = table(spark, sf, "labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "toxic")
    d = F.col("metadata.difficulty")
    return document_samples(spark, sf).join(labels, "id", "left").select(
        "id", scales.difficulty_band(F.when(F.col("toxic").isNotNull(), d)).alias("band"), scales.report_band(d).alias("report_band")
    )


@query("d3_task_keywords", """
SELECT doc_id, regexp_matches(lower(text), 'code|function|program|implement') AS code_task,
       regexp_matches(lower(text), 'calculate|compute|solve|equation|math') AS math_task FROM documents""")
def _(spark, sf):
    from quillsieve.fixed_values import CODE_TASK_WORDS, MATH_TASK_WORDS

    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", text.has_any(t, CODE_TASK_WORDS).alias("code_task"), text.has_any(t, MATH_TASK_WORDS).alias("math_task")
    )


@query("d4_fenced_block", f"""
WITH f AS (SELECT doc_id, CASE WHEN lang = 'en' THEN replace(text, '. ', '```') ELSE text END AS t FROM documents),
b AS (SELECT doc_id, string_split(t, '```') AS p FROM f)
SELECT doc_id, md5(CASE WHEN len(p) < 2 THEN '' WHEN contains(p[2], chr(10)) AND {strip_sql('p[2]')} <> ''
  THEN substr(p[2], instr(p[2], chr(10)) + 1) ELSE p[2] END) AS block FROM b""")
def _(spark, sf):
    t = F.when(F.col("lang") == "en", F.replace(F.col("text"), F.lit(". "), F.lit("```"))).otherwise(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.md5(text.fenced_block(t)).alias("block"))


@query("d5_last_number", """
SELECT doc_id, try_cast(regexp_extract_all(text, '[0-9]+\\.?[0-9]*')[-1] AS DOUBLE) AS number FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.last_number(F.col("text")).alias("number"))


_MODEL_TEXT = """CASE event_type WHEN 'click' THEN 'Result:' || chr(10) || '```json' || chr(10) || props || chr(10) || '```' || ' done'
  WHEN 'view' THEN '```' || props || '```' WHEN 'purchase' THEN props ELSE 'no json ' || props END"""


@query("d6_structured_json", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN json_extract_string(props, '$.k')::BIGINT END AS k,
       CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'Failed to parse JSON from response' END AS error FROM events""")
def _(spark, sf):
    kind, props = F.col("event_type"), F.col("props")
    raw = (
        F.when(kind == "click", F.concat(F.lit("Result:\n```json\n"), props, F.lit("\n``` done")))
        .when(kind == "view", F.concat(F.lit("```"), props, F.lit("```")))
        .when(kind == "purchase", props).otherwise(F.concat(F.lit("no json "), props))
    )
    parsed = table(spark, sf, "events").select("event_id", chat.structured_json(raw).alias("doc"))
    return parsed.select(
        "event_id", F.from_json("doc", "k bigint")["k"].alias("k"),
        F.when(F.col("doc").isNull(), "Failed to parse JSON from response").alias("error"),
    )


def _choice(message):
    return F.to_json(F.struct(F.array(F.struct(message.alias("message"))).alias("choices")))


@query("d7_function_arguments", """
SELECT event_id, CASE WHEN event_type <> 'error' THEN json_extract_string(props, '$.k')::BIGINT END AS k FROM events""")
def _(spark, sf):
    kind, props = F.col("event_type"), F.col("props")
    call = F.struct(F.struct(F.lit("f").alias("name"), props.alias("arguments")).alias("function_call"))
    as_object = F.struct(F.struct(F.from_json(props, "k bigint").alias("arguments")).alias("function_call"))
    raw = (
        F.when(kind == "click", _choice(call)).when(kind == "view", _choice(as_object))
        .when(kind == "error", _choice(F.struct(F.lit("plain text").alias("content"))))
        .otherwise(_choice(F.struct(props.alias("content"))))
    )
    return table(spark, sf, "events").select(
        "event_id", F.from_json(chat.function_arguments(raw), "k bigint")["k"].alias("k")
    )


@query("d8_response_text", """
SELECT doc_id, CASE lang WHEN 'en' THEN md5(text) WHEN 'fr' THEN md5(lang || text) ELSE md5('') END AS body FROM documents""")
def _(spark, sf):
    lang, body = F.col("lang"), F.col("text")
    def block(kind, value):
        return F.struct(F.lit(kind).alias("type"), value.alias("text"))
    blocks = F.to_json(F.struct(F.array(block("text", lang), block("tool", body), block("text", body)).alias("content")))
    raw = F.when(lang == "en", _choice(F.struct(body.alias("content")))).when(lang == "fr", blocks).otherwise(F.lit('{"choices":[]}'))
    return table(spark, sf, "documents").select("doc_id", F.md5(chat.response_text(raw)).alias("body"))


@query("d9_parse_pair", f"""WITH {CONVS}
SELECT id, md5(CASE WHEN domain = 'opening' THEN {strip_sql('instruction')} ELSE '' END) AS instruction,
       md5(CASE WHEN domain = 'opening' THEN {strip_sql('origin_text')} ELSE '' END) AS response FROM convs""")
def _(spark, sf):
    body = F.concat(F.lit("Instruction: "), F.col("instruction"), F.lit("\n"),
                    F.when(F.col("metadata.domain") == "opening", "Response: ").otherwise(""), F.col("response.origin_text"))
    pair = chat.parse_pair(body)
    return conversation_samples(spark, sf).select(
        "id", F.md5(pair["instruction"]).alias("instruction"), F.md5(pair["response"]).alias("response")
    )


def _template_sql(name: str) -> str:
    sql = "'" + TEMPLATES[name].replace("'", "''") + "'"
    for key, column in (("domain", "domain"), ("difficulty", "difficulty::VARCHAR"), ("instruction", "instruction"), ("response", "origin_text")):
        sql = sql.replace("{" + key + "}", f"' || {column} || '")
    return sql


_TEMPLATE_NAME = "CASE WHEN difficulty > 0.7 THEN 'complex_reasoning' WHEN domain <> 'opening' THEN 'domain_specific' ELSE 'basic_generation' END"


@query("d10_template_choice", f"""WITH {CONVS} SELECT {_TEMPLATE_NAME} AS template, count(*) AS n FROM convs GROUP BY 1""")
def _(spark, sf):
    domain = F.when(F.col("metadata.domain") != "opening", F.col("metadata.domain"))
    name = chat.choose_template(domain, F.col("metadata.difficulty"))
    return conversation_samples(spark, sf).groupBy(name.alias("template")).agg(F.count(F.lit(1)).alias("n"))


@query("d11_render_prompt", f"""WITH {CONVS}
SELECT id, template, md5(CASE template WHEN 'complex_reasoning' THEN {_template_sql('complex_reasoning')}
  WHEN 'domain_specific' THEN {_template_sql('domain_specific')} ELSE {_template_sql('basic_generation')} END) AS prompt
FROM (SELECT *, {_TEMPLATE_NAME} AS template FROM convs)""")
def _(spark, sf):
    difficulty = F.col("metadata.difficulty")
    domain = F.when(F.col("metadata.domain") != "opening", F.col("metadata.domain"))
    name = chat.choose_template(domain, difficulty)
    prompt = chat.render_prompt(name, {
        "instruction": F.col("instruction"), "response": F.col("response.origin_text"),
        "domain": F.coalesce(domain, F.lit("general")), "difficulty": difficulty,
    })
    return conversation_samples(spark, sf).select("id", name.alias("template"), F.md5(prompt).alias("prompt"))


@query("d12_build_messages", f"""WITH {CONVS}
SELECT id, CASE WHEN domain = 'opening' THEN 'system,user' ELSE 'user' END AS roles,
       md5(CASE WHEN domain = 'opening' THEN 'Be brief.|' ELSE '' END || instruction) AS contents FROM convs""")
def _(spark, sf):
    messages = chat.build_messages(F.col("instruction"), F.when(F.col("metadata.domain") == "opening", "Be brief."))
    df = conversation_samples(spark, sf).withColumn("m", messages)
    return df.select(
        "id", F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("m", lambda x: x["content"]), "|")).alias("contents"),
    )


@query("d12_named_system_prompt", f"""WITH {CONVS}, p AS (SELECT id, instruction, CASE WHEN length(instruction) % 5 = 0 THEN '' WHEN length(instruction) % 5 = 1 THEN 'Own.'
  WHEN length(instruction) % 5 = 2 THEN 'Be brief.' WHEN length(instruction) % 5 = 3 THEN 'Be exact.' END AS s FROM convs)
SELECT id, CASE WHEN s <> '' THEN 'system,user' ELSE 'user' END AS roles, md5(CASE WHEN s <> '' THEN s || '|' ELSE '' END || instruction) AS contents FROM p""")
def _(spark, sf):
    form = F.length("instruction") % 5
    override = F.when(form == 0, "").when(form == 1, "Own.")
    name = F.when(form < 3, "short").when(form == 3, "exact").otherwise("unknown")
    system = chat.system_prompt(override, name, {"short": "Be brief.", "exact": "Be exact."})
    df = conversation_samples(spark, sf).withColumn("m", chat.build_messages(F.col("instruction"), system))
    return df.select(
        "id", F.array_join(F.transform("m", lambda x: x["role"]), ",").alias("roles"),
        F.md5(F.array_join(F.transform("m", lambda x: x["content"]), "|")).alias("contents"),
    )


@query("d13_two_role_history", """
WITH m AS (SELECT conv_id, turn, role, text FROM conversations)
SELECT conv_id, turn, CASE WHEN role = 'system' THEN md5(text) END AS system_prompt,
       CASE role WHEN 'system' THEN 'user' WHEN 'assistant' THEN 'user,model,model' ELSE 'user,model' END AS roles FROM m""")
def _(spark, sf):
    def turn(role, content):
        return F.struct(role.alias("role"), content.alias("content"))
    role, body = F.col("role"), F.col("text")
    reply = F.when(role != "system", turn(F.lit("assistant"), F.lit("ok")))
    other = F.when(role != "system", turn(F.lit("narrator"), F.lit("x")))
    messages = F.array_compact(F.array(turn(role, body), reply, other))
    history = chat.two_role_history(messages)
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.md5(chat.leading_system(messages)).alias("system_prompt"),
        F.array_join(F.transform(history, lambda m: m["role"]), ",").alias("roles"),
    )


@query("d14_flatten_prompt", f"""WITH {CONVS}
SELECT id, md5('Be brief.' || chr(10) || instruction) AS joined,
       md5(CASE WHEN domain = 'opening' THEN '<s>[INST] ' || instruction || ' [/INST]' ELSE 'User: ' || instruction || chr(10) || 'Assistant:' END) AS prompt FROM convs""")
def _(spark, sf):
    model = F.when(F.col("metadata.domain") == "opening", "models/Llama-3-8b").otherwise("llama-dir/falcon-7b")
    messages = chat.build_messages(F.col("instruction"), F.lit("Be brief."))
    return conversation_samples(spark, sf).select(
        "id", F.md5(chat.flatten_messages(messages)).alias("joined"),
        F.md5(chat.prompt_for_model(model, F.col("instruction"))).alias("prompt"),
    )


@query("d15_usage_cost", f"""WITH {CALLS}, prices(model, scale, p, c) AS (
  VALUES ('gpt-4', 1000.0::DOUBLE, 0.03::DOUBLE, 0.06::DOUBLE), ('deepseek-chat', 1000000.0, 0.14, 0.28), ('gemini-1.0-pro', 1000.0, 0.125, 0.375))
SELECT id, calls.model, round(coalesce(prompt_tokens / scale * p + completion_tokens / scale * c, 0), 9) AS call_cost
FROM calls LEFT JOIN prices USING (model)""")
def _(spark, sf):
    priced = costs.with_cost(call_log(spark, sf), costs.price_table(spark))
    return priced.select("id", "model", F.round("call_cost", 9).alias("call_cost"))


@query("d15_default_model", f"""WITH {CALLS}, prices(model, p, c) AS (VALUES ('gemini-1.0-pro', 0.125::DOUBLE, 0.375::DOUBLE), ('gemini-1.5-flash-latest', 0.00125, 0.0025))
SELECT id, calls.model, round(prompt_tokens / 1000.0::DOUBLE * coalesce(p, 0.00125) + completion_tokens / 1000.0::DOUBLE * coalesce(c, 0.0025), 9) AS call_cost
FROM calls LEFT JOIN prices USING (model)""")
def _(spark, sf):
    prices = costs.price_table(spark).where("model LIKE 'gemini%' AND model <> 'gemini-1.5-pro-latest'")
    priced = costs.with_cost(call_log(spark, sf), prices, default_model="gemini-1.5-flash-latest")
    return priced.select("id", "model", F.round("call_cost", 9).alias("call_cost"))


@query("d16_improvement", f"""WITH {CALLS}, v AS (SELECT id, CASE WHEN provider = 'view' THEN 0.0 ELSE prompt_tokens::DOUBLE END AS b, completion_tokens::DOUBLE AS a FROM calls)
SELECT id, round(a - b, 6) AS absolute, CASE WHEN b = 0 AND a > 0 THEN 'inf' ELSE round(CASE WHEN b = 0 THEN 0 ELSE (a - b) / b * 100 END, 6)::VARCHAR END AS percentage,
  printf('%.4f', a - b) || ' (' || CASE WHEN b = 0 AND a > 0 THEN '+inf' ELSE printf('%+.2f', CASE WHEN b = 0 THEN 0.0 ELSE (a - b) / b * 100 END) END || '%)' AS formatted
FROM v""")
def _(spark, sf):
    before = F.when(F.col("provider") == "view", F.lit(0.0)).otherwise(F.col("prompt_tokens").cast("double"))
    after = F.col("completion_tokens").cast("double")
    percent = scales.improvement_percent(before, after)
    shown = F.when(percent == float("inf"), "inf").otherwise(F.round(percent, 6).cast("string"))
    return call_log(spark, sf).select(
        "id", F.round(scales.improvement_absolute(before, after), 6).alias("absolute"), shown.alias("percentage"),
        scales.improvement_text(before, after).alias("formatted"),
    )


@query("d18_text_features", f"""
SELECT doc_id, length(text) AS chars, len({words_sql('text')}) AS words, len(regexp_extract_all(text, '[.!?]+')) AS sentences,
       md5({normalized_sql('text')}) AS text_key FROM documents""")
def _(spark, sf):
    t = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", text.char_length(t).cast("bigint").alias("chars"), text.word_count(t).cast("bigint").alias("words"),
        text.sentence_count(t).cast("bigint").alias("sentences"), F.md5(text.normalized(t)).alias("text_key"),
    )


@query("d17_run_stamp", """
SELECT doc_id, '2024-05-01 12:30:15' AS stamped, substr(md5('7:' || doc_id), 1, 15) AS key FROM documents""")
def _(spark, sf):
    stamp = F.lit("2024-05-01T12:30:15Z").cast("timestamp")
    return table(spark, sf, "documents").select(
        "doc_id", F.date_format(stamp, "yyyy-MM-dd HH:mm:ss").alias("stamped"),
        F.lower(F.lpad(F.hex(keys.hash60(F.lit("7"), F.col("doc_id").cast("string"))), 15, "0")).alias("key"),
    )
