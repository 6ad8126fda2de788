"""Queries on training rows, advanced scores and evaluation tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.views import ASSESSED, CONVS, DOCS, assessed_documents, conversation_samples, document_samples, hash60_sql, normalized_sql, strip_sql, table, uniform_sql
from quillsieve.functions.keys import uniform
from quillsieve.operators import advanced, evaluation, reports, training
from quillsieve.session import stage


@query("b9_training_rows", f"""WITH {CONVS}
SELECT id, md5(instruction) AS instruction, '' AS input, 'full' AS strategy, md5(origin_text) AS output FROM convs
UNION ALL SELECT id, md5(instruction), '', 'rationale', md5(rationale) FROM convs
UNION ALL SELECT id, md5(instruction), '', 'answer', md5(final_answer) FROM convs
UNION ALL SELECT id, md5(instruction), '', 'mixed', md5(rationale || chr(10) || chr(10) || final_answer) FROM convs""")
def _(spark, sf):
    samples = conversation_samples(spark, sf)
    parts = [training.training_rows(samples, s).select(
        "id", F.md5("instruction").alias("instruction"), "input", F.lit(s).alias("strategy"), F.md5("output").alias("output")
    ) for s in training.STRATEGIES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("h9_train_validation_split", f"WITH {DOCS} SELECT id, CASE WHEN {uniform_sql(chr(39) + '7:' + chr(39) + ' || id')} < 0.1 THEN 'validation' ELSE 'train' END AS split FROM docs")
def _(spark, sf):
    return training.with_split(document_samples(spark, sf), 0.1, "7").select("id", "split")


# A loss table per document and two runs, made from the labels and text lengths.
_LOSSES = """losses AS (SELECT 'd' || l.doc_id AS id, (1 + quality) / (n_chars + 1.0::DOUBLE) AS cond, toxic * n_chars / 1000.0::DOUBLE AS uncond,
  quality, toxic, n_chars FROM labels l JOIN documents d USING (doc_id))"""


def _labelled(spark, sf):
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars", "lang"), "doc_id").withColumn(
        "id", F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    )


@query("e11_ifd", f"WITH {_LOSSES} SELECT id, round(CASE WHEN uncond <> 0 THEN cond / uncond END, 12) AS ifd FROM losses")
def _(spark, sf):
    losses = _labelled(spark, sf).select(
        "id", ((1 + F.col("quality")) / (F.col("n_chars") + 1.0)).alias("loss_cond"), (F.col("toxic") * F.col("n_chars") / 1000.0).alias("loss_uncond")
    )
    return advanced.instruction_following_difficulty(losses).select("id", F.round("ifd_score", 12).alias("ifd"))


@query("e12_learning_effect", f"""WITH {_LOSSES} SELECT id, round(n_chars / 1000.0::DOUBLE - (1 + toxic) / 3.0::DOUBLE, 9) AS loss_reduction,
  (quality - toxic)::DOUBLE AS accuracy_improvement FROM losses WHERE toxic = 0 OR quality = 1""")
def _(spark, sf):
    rows = _labelled(spark, sf)
    before = rows.select(F.lit("base").alias("run"), "id", (F.col("n_chars") / 1000.0).alias("loss"), F.col("toxic").cast("double").alias("accuracy"))
    after = rows.where("toxic = 0 OR quality = 1").select(F.lit("tuned").alias("run"), "id", ((1 + F.col("toxic")) / 3.0).alias("loss"), F.col("quality").cast("double").alias("accuracy"))
    out = advanced.learning_effect(before.unionByName(after), "base", "tuned")
    return out.select("id", F.round("loss_reduction", 9).alias("loss_reduction"), "accuracy_improvement")


def _u(name: str) -> str:
    return uniform_sql(f"'{name}:' || id")


_ADVANCED = f"""{DOCS}, adv AS (SELECT id, domain, CASE WHEN domain <> 'es' THEN {_u('ifd')} END AS ifd, CASE WHEN quality IS NOT NULL THEN {_u('limr')} END AS limr,
  CASE WHEN domain <> 'es' THEN {_u('less')} END AS less FROM docs),
ens AS (SELECT *, CASE WHEN coalesce(ifd, limr, less) IS NOT NULL THEN (coalesce(ifd, 0) * 0.4 + coalesce(limr, 0) * 0.3 + coalesce(less, 0) * 0.3)
  / ((ifd IS NOT NULL)::INT * 0.4 + (limr IS NOT NULL)::INT * 0.3 + (less IS NOT NULL)::INT * 0.3)::DOUBLE END AS ensemble FROM adv)"""


def _advanced_scores(spark, sf):
    samples = document_samples(spark, sf)
    labelled = table(spark, sf, "labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.lit(True).alias("labelled"))
    joined = samples.join(labelled, "id", "left")
    spoken = F.col("metadata.domain") != "es"
    return joined.select(
        "id", F.when(spoken, uniform(F.lit("ifd"), F.col("id"))).alias("ifd_score"),
        F.when(F.col("labelled"), uniform(F.lit("limr"), F.col("id"))).alias("limr_score"),
        F.when(spoken, uniform(F.lit("less"), F.col("id"))).alias("less_score"),
    )


@query("e10_ensemble", f"""WITH {_ADVANCED} SELECT id, round(ensemble, 9) AS ensemble FROM ens
ORDER BY ensemble DESC NULLS LAST, {hash60_sql('id')}, id LIMIT 800""")
def _(spark, sf):
    scored = advanced.ensemble_scores(document_samples(spark, sf), _advanced_scores(spark, sf))
    return advanced.filter_by_ensemble(scored, 800).select("id", F.round("ensemble_score", 9).alias("ensemble"))


@query("f9_advanced_report", f"""WITH {ASSESSED}, {_ADVANCED[len(DOCS) + 2:]},
a AS (SELECT e.*, raq, aa, n_chars / 1000.0::DOUBLE AS lr, overall AS gain, coalesce(ensemble > 0.5, false) AS chosen
      FROM ens e JOIN assessed s USING (id) JOIN documents d ON 'd' || d.doc_id = e.id)
SELECT 'totals' AS section, 'all' AS key, 'assessed_samples' AS measure, count(*)::DOUBLE AS value FROM a
UNION ALL SELECT 'totals', 'all', 'final_selected', count(*) FILTER (WHERE chosen) FROM a
UNION ALL SELECT 'learning_effect', 'all', unnest(['mean_loss_reduction', 'mean_accuracy_improvement']), unnest([round(avg(lr), 6), round(avg(gain), 6)]) FROM a
UNION ALL SELECT 'rationale_vs_answer', 'all', unnest(['rationale_mean', 'answer_mean', 'correlation']), unnest([round(avg(raq), 6), round(avg(aa), 6), round(corr(raq, aa), 6)]) FROM a
UNION ALL SELECT 'domain', domain, unnest(['mean_score', 'selected_ratio']), unnest([round(avg(ensemble), 6), round(avg(chosen::INT), 6)]) FROM a GROUP BY domain
""" + "".join(f"UNION ALL SELECT 'method', '{m}', unnest(['mean', 'median', 'std']), unnest([round(avg({m}), 6), round(median({m}), 6), round(stddev_pop({m}), 6)]) FROM a\n" for m in ("ifd", "limr", "less", "ensemble")))
def _(spark, sf):
    from quillsieve.operators.gates import metric

    base = assessed_documents(spark, sf).withColumn("__chars", F.length("response.origin_text"))
    docs = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "n_chars")
    scored = advanced.ensemble_scores(base, _advanced_scores(spark, sf)).join(docs, "id")
    struct = F.struct(
        "ifd_score", "limr_score", "less_score", "ensemble_score", (F.col("ensemble_score") > 0.5).alias("final_selected"),
        (F.col("n_chars") / 1000.0).alias("loss_reduction"), metric("overall_score").alias("accuracy_improvement"),
    )
    narrow = stage(scored.select("id", "metadata", "evaluations", struct.alias("advanced")), "advanced")
    return reports.advanced_report(narrow).withColumn("value", F.round("value", 6))


# Predictions: the next turn as reference, the turn itself or the next turn as prediction.
_PREDICTIONS = f"""{CONVS}, pred AS (SELECT id, 'm_a' AS model, domain AS dataset, CASE WHEN difficulty > 0.5 THEN 'long' ELSE 'short' END AS category,
    CASE WHEN contains(final_answer, 'e') THEN replace(origin_text, ' ', '  ') || ' ' ELSE origin_text END AS prediction, origin_text AS reference FROM convs
  UNION ALL SELECT id, 'm_b', domain, CASE WHEN difficulty > 0.5 THEN 'long' ELSE 'short' END, instruction, origin_text FROM convs),
tok AS (SELECT *, list_filter(string_split({normalized_sql('prediction')}, ' '), lambda x: x <> '') AS p,
  list_filter(string_split({normalized_sql('reference')}, ' '), lambda x: x <> '') AS r FROM pred),
pc AS (SELECT id, model, t, count(*) AS n FROM (SELECT id, model, unnest(p) AS t FROM tok) GROUP BY ALL),
rc AS (SELECT id, model, t, count(*) AS n FROM (SELECT id, model, unnest(r) AS t FROM tok) GROUP BY ALL),
ov AS (SELECT id, model, sum(least(pc.n, rc.n)) AS c FROM pc JOIN rc USING (id, model, t) GROUP BY ALL),
rows AS (SELECT tok.*, ({normalized_sql('prediction')} = {normalized_sql('reference')})::INT AS accuracy, ({strip_sql('prediction')} = {strip_sql('reference')})::INT AS exact_match,
  coalesce(2.0 * c / (len(p) + len(r)), CASE WHEN len(p) + len(r) = 0 THEN 1 ELSE 0 END)::DOUBLE AS f1 FROM tok LEFT JOIN ov USING (id, model))"""


def _predictions(spark, sf):
    samples = conversation_samples(spark, sf)
    body = F.col("response.origin_text")
    category = F.when(F.col("metadata.difficulty") > 0.5, "long").otherwise("short")
    def rows(model, prediction):
        return samples.select("id", F.lit(model).alias("model"), F.col("metadata.domain").alias("dataset"),
                              category.alias("category"), prediction.alias("prediction"), body.alias("reference"))
    spaced = F.when(F.col("response.final_answer").contains("e"), F.concat(F.replace(body, F.lit(" "), F.lit("  ")), F.lit(" "))).otherwise(body)
    return evaluation.score_predictions(rows("m_a", spaced).unionByName(rows("m_b", F.col("instruction"))))


@query("f10_token_scores", f"WITH {_PREDICTIONS} SELECT id, model, accuracy::DOUBLE AS accuracy, exact_match::DOUBLE AS exact_match, round(f1, 9) AS f1 FROM rows")
def _(spark, sf):
    return _predictions(spark, sf).select("id", "model", "accuracy", "exact_match", F.round("f1", 9).alias("f1"))


_EVAL = f"""{_PREDICTIONS}, ev AS (SELECT model, dataset, CASE WHEN grouping(category) = 1 THEN 'overall' ELSE category END AS category, avg(accuracy) AS accuracy,
  avg(exact_match) AS exact_match, avg(f1) AS f1, count(*) AS samples FROM rows GROUP BY GROUPING SETS ((model, dataset, category), (model, dataset)))"""


@query("f10_evaluation_metrics", f"""WITH {_EVAL} SELECT model, dataset, category, round(accuracy, 6) AS accuracy, round(exact_match, 6) AS exact_match, round(f1, 6) AS f1, samples FROM ev""")
def _(spark, sf):
    out = evaluation.evaluation_metrics(_predictions(spark, sf))
    return out.select("model", "dataset", "category", *[F.round(c, 6).alias(c) for c in ("accuracy", "exact_match", "f1")], "samples")


@query("f11_compare_models", f"""WITH {_EVAL}, p AS (SELECT dataset, category, max(f1) FILTER (WHERE model = 'm_b') AS b, max(f1) FILTER (WHERE model = 'm_a') AS a FROM ev GROUP BY ALL)
SELECT dataset, category, round(b, 6) AS before, round(a, 6) AS after, round(a - b, 6) AS absolute, round((a - b) / b * 100, 4) AS percentage,
  printf('%.4f', a - b) || ' (' || printf('%+.2f', (a - b) / b * 100) || '%)' AS formatted FROM p""")
def _(spark, sf):
    out = evaluation.compare_models(evaluation.evaluation_metrics(_predictions(spark, sf)), "m_b", "m_a", "f1")
    return out.select("dataset", "category", *[F.round(c, 6).alias(c) for c in ("before", "after", "absolute")], F.round("percentage", 4).alias("percentage"), "formatted")
