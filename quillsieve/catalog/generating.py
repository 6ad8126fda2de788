"""Queries on generation plans, prompts and responses, and the full flow."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.selecting import _kde_sql, _quota_sql
from quillsieve.catalog.views import CONVS, DOCS, conversation_samples, distinct_ratio_sql, document_samples, hash60_sql, strip_sql, table, uniform_sql, words_sql
from quillsieve.fixed_values import TEMPLATES
from quillsieve.operators import generation, ranking
from quillsieve.plans import stages
from quillsieve.plans.stages import Curation
from quillsieve.session import stage_path

_ORDERED = "ordered AS (SELECT *, row_number() OVER (ORDER BY md5(id), id) - 1 AS ordinal, count(*) OVER () AS size FROM convs)"


@query("h6_round_robin_plan", f"""WITH {CONVS}, {_ORDERED}
SELECT slot, id AS seed_id, domain FROM (SELECT unnest(range(700)) AS slot) s JOIN ordered ON ordinal = slot % size""")
def _(spark, sf):
    plan = generation.round_robin_plan(conversation_samples(spark, sf), 700)
    return plan.select("slot", "seed_id", F.col("metadata.domain").alias("domain"))


@query("h5_random_plan", f"""WITH {CONVS}, {_ORDERED}, p AS (SELECT unnest(range(500)) AS slot, (SELECT any_value(size) FROM ordered) AS size)
SELECT slot, slot // 10 AS batch, id AS seed_id FROM p JOIN ordered ON ordinal = ({hash60_sql("'4:' || (slot // 10)")} % p.size + slot % 10) % p.size""")
def _(spark, sf):
    plan = generation.random_plan(conversation_samples(spark, sf), 500, 10, seed="4")
    return plan.select("slot", F.col("batch").cast("bigint").alias("batch"), "seed_id")


@query("h5_ordinals", "SELECT event_id::VARCHAR AS id, row_number() OVER (ORDER BY md5(event_id::VARCHAR)) - 1 AS ordinal FROM events")
def _(spark, sf):
    return ranking.with_ordinal(table(spark, sf, "events").select(F.col("event_id").cast("string").alias("id")))


def _fixed_length(name: str) -> int:
    """Characters of a template without its placeholders."""
    text = TEMPLATES[name]
    for field in ("instruction", "response", "domain", "difficulty"):
        text = text.replace("{" + field + "}", "")
    return len(text)


@query("p4_generation", f"""WITH {CONVS}, {_ORDERED}, r AS (
  SELECT 'request_' || slot AS id, id AS seed_id, domain, difficulty, {strip_sql('instruction')} AS instruction, {strip_sql('origin_text')} AS response,
    length(CASE WHEN difficulty > 0.7 THEN instruction || origin_text ELSE instruction || origin_text || domain || domain || difficulty::VARCHAR END)
      + CASE WHEN difficulty > 0.7 THEN {_fixed_length('complex_reasoning')} ELSE {_fixed_length('domain_specific')} END AS prompt_length
  FROM (SELECT unnest(range(300)) AS slot) s JOIN ordered ON ordinal = slot % size)
SELECT id, seed_id, domain, difficulty, md5(instruction) AS instruction, md5(response) AS response FROM r
WHERE prompt_length <= 1300 AND length(instruction) BETWEEN 50 AND 2000 AND length(response) BETWEEN 50 AND 2000 AND instruction <> response""")
def _(spark, sf):
    def echo(prompt: str) -> str:
        """A stand-in generator that repeats the example of the prompt. It is local, so
        it travels to the workers by value and they need no package installed."""
        if len(prompt) > 1300:
            raise ValueError("prompt too long")
        return prompt[prompt.index("Instruction: "):prompt.rindex("\n\nGenerate")]

    made = stages.generation_stage(conversation_samples(spark, sf), echo, 300, model="echo", plan="round_robin")
    return made.select(
        "id", F.col("metadata.seed_id").alias("seed_id"), F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty"),
        F.md5("instruction").alias("instruction"), F.md5("response.origin_text").alias("response"),
    )


@query("u5_generator_errors", f"""WITH {CONVS}, {_ORDERED}
SELECT 'request_' || slot AS request_id, id AS seed_id, CASE WHEN length(instruction) > 120 THEN 'too long' END AS error,
  CASE WHEN length(instruction) <= 120 THEN length(instruction) END AS answer FROM (SELECT unnest(range(400)) AS slot) s JOIN ordered ON ordinal = slot % size""")
def _(spark, sf):
    def measure(prompt: str) -> str:
        if len(prompt) > 120:
            raise ValueError("too long")
        return str(len(prompt))

    plan = generation.round_robin_plan(conversation_samples(spark, sf), 400)
    table_ = generation.requests(plan).drop("prompt").join(
        plan.select(F.concat(F.lit("request_"), F.col("slot").cast("string")).alias("request_id"), F.col("instruction").alias("prompt")), "request_id"
    )
    out = generation.run_generator(table_, measure)
    return out.select("request_id", "seed_id", "error", F.col("raw").cast("bigint").alias("answer"))


@query("p2_seed_stage", f"""WITH {DOCS} SELECT id, domain FROM docs WHERE length({strip_sql('instruction')}) >= 40 AND length({strip_sql('origin_text')}) >= 60
  AND {strip_sql('instruction')} <> {strip_sql('origin_text')}""")
def _(spark, sf):
    seed = stages.seed_stage(document_samples(spark, sf), min_instruction=40, min_response=60)
    return seed.select("id", F.col("metadata.domain").alias("domain"))


# The flagship: conversations through ingest rules, scores, gate, diversity and quotas.
_TARGET = 60
_CURATED = f"""WITH {CONVS},
base AS (SELECT *, least(1.0::DOUBLE, len({words_sql('instruction')}) / 60.0::DOUBLE) AS ic, {distinct_ratio_sql('origin_text')} AS rq,
  least(1.0::DOUBLE, len(regexp_extract_all(rationale, '[.!?]+')) / 10.0::DOUBLE) AS rd, {distinct_ratio_sql('rationale')} AS raq FROM convs
  WHERE length({strip_sql('instruction')}) >= 10 AND length({strip_sql('origin_text')}) >= 10 AND {strip_sql('instruction')} <> {strip_sql('origin_text')}),
gated AS (SELECT *, (ic + rq + rd + 1.0) / 4 AS overall FROM base WHERE (ic + rq + rd + 1.0) / 4 >= 0.5 AND raq >= 0.3),
{_kde_sql('p', 'ic', 'gated')}, {_kde_sql('q', 'length(instruction)', 'gated')},
cat AS (SELECT domain, 1 - count(*) / (SELECT count(*) FROM gated)::DOUBLE AS d FROM gated GROUP BY domain),
divs AS (SELECT g.*, 0.4 * cat.d + 0.3 * pd.d + 0.3 * qd.d AS diversity FROM gated g JOIN cat USING (domain) JOIN pd ON pd.v = ic JOIN qd ON qd.v = length(instruction)::DOUBLE),
banded AS (SELECT id, domain, overall * 0.7::DOUBLE + diversity * 0.3::DOUBLE AS score, CASE WHEN ic < 0.4 THEN 'easy' WHEN ic > 0.7 THEN 'hard' ELSE 'medium' END AS band FROM divs),
{_quota_sql('banded', _TARGET, {'easy': 0.3, 'medium': 0.5, 'hard': 0.2})}
SELECT id, domain, band, round(score, 6) AS score FROM picked
UNION ALL SELECT id, domain, band, round(score, 6) FROM banded WHERE (SELECT count(*) FROM banded) <= {_TARGET}"""
_CURATED = _CURATED.replace(f"FROM picked\nUNION", f"FROM picked WHERE (SELECT count(*) FROM banded) > {_TARGET}\nUNION")


def _assess(df):
    return stages.assessment_stage(df, methods=(), evaluated_at="2024-05-01T12:30:15Z")


def _select(df):
    return stages.filtering_stage(
        df, target=_TARGET, quality_threshold=0.5, gate={"thresholds": {}, "rationale_threshold": 0.3, "answer_threshold": 0.0}
    )


@query("p1_curated_conversations", _CURATED)
def _(spark, sf):
    from quillsieve.functions.scales import difficulty_band
    from quillsieve.operators.gates import metric

    picked = _select(_assess(stages.seed_stage(conversation_samples(spark, sf))))
    return picked.select(
        "id", F.col("metadata.domain").alias("domain"), difficulty_band(metric("instruction_complexity")).alias("band"),
        F.round("selection_score", 6).alias("score"),
    )


def _drawn(spark, samples):
    from quillsieve.functions.keys import uniform

    return samples.select("id", *[uniform(F.lit(m), F.col("id")).alias(f"{m}_score") for m in ("ifd", "limr", "less")])


_FULL = _CURATED.replace("SELECT id, domain, band, round(score, 6) AS score FROM picked", "final AS (SELECT id, domain, band, round(score, 6) AS score FROM picked") + f"""),
drawn AS (SELECT *, {uniform_sql("'ifd:' || id")} * 0.4 + {uniform_sql("'limr:' || id")} * 0.3 + {uniform_sql("'less:' || id")} * 0.3 AS ensemble FROM final)
SELECT id, domain, band, score, round(ensemble, 9) AS ensemble FROM drawn ORDER BY ensemble DESC, {hash60_sql('id')}, id LIMIT 30"""


@query("p1_full_run_rows", _FULL.replace("\nfinal AS", ",\nfinal AS"))
def _(spark, sf):
    from quillsieve.functions.scales import difficulty_band
    from quillsieve.operators.gates import metric

    samples = conversation_samples(spark, sf)
    scores = _drawn(spark, samples)
    run = Curation(
        spark, stage_path(spark, "full-run"), "20240501T123015", seed=stages.seed_stage, assess=_assess, select=_select,
        advanced=lambda df: stages.advanced_stage(df, scores, 30),
    )
    return run.run(samples).select(
        "id", F.col("metadata.domain").alias("domain"), difficulty_band(metric("instruction_complexity")).alias("band"),
        F.round("selection_score", 6).alias("score"), F.round("ensemble_score", 9).alias("ensemble"),
    )


@query("p1_full_run", f"""WITH {CONVS}, ok AS (SELECT * FROM convs WHERE length({strip_sql('instruction')}) >= 10 AND length({strip_sql('origin_text')}) >= 10 AND {strip_sql('instruction')} <> {strip_sql('origin_text')})
SELECT 'seed' AS stage, count(*) AS count FROM ok UNION ALL SELECT 'assessed', count(*) FROM ok
UNION ALL SELECT 'filtered', least(50, count(*)) FROM ok UNION ALL SELECT 'advanced', least(30, count(*)) FROM ok""")
def _(spark, sf):
    samples = conversation_samples(spark, sf)
    scores = _drawn(spark, samples)
    run = Curation(
        spark, stage_path(spark, "full-run"), "20240501T123015", seed=stages.seed_stage, assess=_assess,
        select=lambda df: stages.filtering_stage(df, target=50, quality_threshold=0.0, gate={"thresholds": {}, "rationale_threshold": 0.0, "answer_threshold": 0.0}),
        advanced=lambda df: stages.advanced_stage(df, scores, 30),
    )
    run.run(samples)
    summary = spark.read.json(f"{run.output}/summary")
    stages_ = summary.select(F.explode(F.from_json(F.to_json("stages"), "map<string,struct<count:bigint,path:string>>")).alias("stage", "v"))
    return stages_.select("stage", F.col("v.count").alias("count"))

