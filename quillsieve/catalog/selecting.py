"""Queries on lookups, sampling, diversity, selection, duplicates and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.views import (
    ASSESSED, CALLS, CONVS, DOCS, assessed_documents, call_log, conversation_samples, document_samples, hash60_sql,
    normalized_sql, table,
)
from quillsieve.operators import dedup, diversity, lookup, normalize, ranking, reports, selection
from quillsieve.operators.gates import metric
from quillsieve.session import stage, stage_path
from quillsieve.sources import writers


def _r(column, digits: int = 6):
    return F.round(column, digits)


# --- lookups and samples ---------------------------------------------------------

@query("c14_by_domain", f"WITH {DOCS} SELECT id, difficulty FROM docs WHERE domain = 'fr'")
def _(spark, sf):
    return lookup.by_domain(document_samples(spark, sf), "fr").select("id", F.col("metadata.difficulty").alias("difficulty"))


@query("c14_by_domain_limit", f"WITH {DOCS} SELECT id FROM docs WHERE domain = 'fr' ORDER BY {hash60_sql(chr(39) + '5:' + chr(39) + ' || id')}, id LIMIT 40")
def _(spark, sf):
    return lookup.by_domain(document_samples(spark, sf), "fr", 40, seed="5").select("id")


@query("c15_by_difficulty", f"WITH {DOCS} SELECT id FROM docs WHERE least(floor(difficulty * 5), 4) BETWEEN 1 AND 2")
def _(spark, sf):
    return lookup.by_difficulty(document_samples(spark, sf), 0.25, 0.5).select("id")


@query("c16_by_id", f"WITH {DOCS} SELECT id, domain, difficulty FROM docs WHERE id = 'd42'")
def _(spark, sf):
    return lookup.by_id(document_samples(spark, sf), "d42").select("id", F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty"))


@query("g2_id_join", f"WITH {DOCS} SELECT id, domain FROM docs WHERE id IN (SELECT 'd' || doc_id FROM labels WHERE quality = 1)")
def _(spark, sf):
    wanted = table(spark, sf, "labels").where("quality = 1").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"))
    return lookup.by_ids(document_samples(spark, sf), wanted).select("id", F.col("metadata.domain").alias("domain"))


@query("g6_bucket_intersection", f"""WITH {DOCS} SELECT id FROM docs WHERE domain = 'en' AND least(floor(difficulty * 5), 4) BETWEEN 0 AND 1
ORDER BY {hash60_sql(chr(39) + '9:' + chr(39) + ' || id')}, id LIMIT 100""")
def _(spark, sf):
    return lookup.random_samples(document_samples(spark, sf), 100, domain="en", high=0.3, seed="9").select("id")


@query("h3_random_samples", f"WITH {DOCS} SELECT id FROM docs ORDER BY {hash60_sql(chr(39) + '3:' + chr(39) + ' || id')}, id LIMIT 250")
def _(spark, sf):
    return lookup.random_samples(document_samples(spark, sf), 250, seed="3").select("id")


@query("h2_top_n", f"SELECT o_orderkey::VARCHAR AS id, o_totalprice::DOUBLE AS price FROM orders ORDER BY o_totalprice DESC, {hash60_sql('o_orderkey::VARCHAR')} LIMIT 100")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_totalprice").cast("double").alias("price"))
    return ranking.top_rows(orders, 100, F.col("price"))


@query("h2_top_n_narrowed", f"SELECT o_orderkey::VARCHAR AS id, o_totalprice::DOUBLE AS price FROM orders ORDER BY o_totalprice DESC, {hash60_sql('o_orderkey::VARCHAR')} LIMIT 3000")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.col("o_totalprice").cast("double").alias("price"))
    return ranking.top_per_group(orders, 3000, F.col("price"), in_place=500)


@query("h4_truncate", f"WITH {CONVS} SELECT id FROM convs ORDER BY {hash60_sql('id')}, id LIMIT 120")
def _(spark, sf):
    from quillsieve.functions.keys import hash60

    return ranking.top_rows(conversation_samples(spark, sf), 120, -hash60(F.col("id"))).select("id")


@query("h7_request_history", f"""WITH {CALLS} SELECT id, provider, ts::VARCHAR AS ts FROM calls
QUALIFY row_number() OVER (PARTITION BY provider ORDER BY calls.ts DESC, {hash60_sql('id')}) <= 100""")
def _(spark, sf):
    from quillsieve.functions.keys import hash60

    calls = call_log(spark, sf).select("id", "provider", "ts", hash60(F.col("id")).alias("h"))
    latest = ranking.latest_per_group(calls, 100, "provider", [F.col("ts").desc(), F.col("h")])
    return latest.select("id", "provider", F.regexp_replace(F.col("ts").cast("string"), r"\.0+$", "").alias("ts"))


# --- diversity -------------------------------------------------------------------

@query("f4_categorical_diversity", f"WITH {DOCS} SELECT id, round(1 - count(*) OVER (PARTITION BY source) / (count(*) OVER ())::DOUBLE, 9) AS diversity FROM docs")
def _(spark, sf):
    df = diversity.categorical_diversity(document_samples(spark, sf), F.col("metadata.source"), "diversity")
    return df.select("id", _r(F.col("diversity"), 9).alias("diversity"))


def _kde_sql(prefix: str, value: str, source: str) -> str:
    """Brute-force kernel sum over the distinct values."""
    return f"""{prefix}s AS (SELECT count(*) AS n, stddev_samp(({value})::DOUBLE) * pow(count(*), -0.2) AS h FROM {source}),
{prefix}v AS (SELECT ({value})::DOUBLE AS v, count(*) AS c FROM {source} GROUP BY 1),
{prefix}k AS (SELECT a.v, sum(b.c * exp(-pow((a.v - b.v) / h, 2) / 2)) AS k FROM {prefix}v a, {prefix}v b, {prefix}s GROUP BY a.v),
{prefix}d AS (SELECT v, greatest(0, 1 - k / (SELECT max(k) FROM {prefix}k)) AS d FROM {prefix}k)"""


@query("f5_numeric_diversity", f"""WITH {_kde_sql('x', 'length(text)', 'documents')}
SELECT doc_id, round(d, 6) AS diversity FROM documents JOIN xd ON v = length(text)""")
def _(spark, sf):
    df = diversity.numeric_diversity(table(spark, sf, "documents"), {"diversity": F.length("text")})
    return df.select("doc_id", _r(F.col("diversity")).alias("diversity"))


@query("g7_kernel_cells", f"""WITH {_kde_sql('x', 'o_totalprice', 'orders')}
SELECT o_totalprice::DOUBLE AS price, count(*) AS n, round(any_value(d), 6) AS diversity FROM orders JOIN xd ON v = o_totalprice::DOUBLE GROUP BY 1""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_totalprice").cast("double").alias("price"))
    df = diversity.numeric_diversity(orders, {"diversity": F.col("price")})
    return df.groupBy("price").agg(F.count(F.lit(1)).alias("n"), _r(F.max("diversity")).alias("diversity"))


_DIVERSE = f"""{ASSESSED}, {{source}},
{_kde_sql('p', 'ic', '{name}')}, {_kde_sql('q', 'length(instruction)', '{name}')},
cat AS (SELECT domain, 1 - count(*) / (SELECT count(*) FROM {{name}})::DOUBLE AS d FROM {{name}} GROUP BY domain),
divs AS (SELECT s.*, 0.4 * cat.d + 0.3 * pd.d + 0.3 * qd.d AS diversity FROM {{name}} s JOIN cat USING (domain)
  JOIN pd ON pd.v = ic JOIN qd ON qd.v = length(instruction)::DOUBLE)"""


def _diverse_sql(name: str, source: str) -> str:
    return _DIVERSE.replace("{source}", source).replace("{name}", name)


@query("e8_diversity_score", f"WITH {_diverse_sql('allrows', 'allrows AS (SELECT * FROM assessed)')} SELECT id, round(diversity, 6) AS diversity FROM divs")
def _(spark, sf):
    features = diversity.sample_features()
    narrow = assessed_documents(spark, sf).select("id", *[c.alias(n) for n, c in features.items()])
    df = diversity.diversity_scores(stage(narrow, "features"), {n: F.col(n) for n in features})
    return df.select("id", _r(F.col("diversity_score")).alias("diversity"))


@query("e8a_diversity_features", f"WITH {ASSESSED} SELECT id, domain, round(ic, 9) AS difficulty, length(instruction) AS content FROM assessed")
def _(spark, sf):
    features = diversity.sample_features()
    return assessed_documents(spark, sf).select(
        "id", features["domain"].alias("domain"), _r(features["difficulty"], 9).alias("difficulty"), features["content"].cast("bigint").alias("content")
    )


@query("e9_selection_score", f"WITH {ASSESSED} SELECT id, round(overall * 0.7 + coalesce(rq, 0) * 0.3, 6) AS score FROM assessed")
def _(spark, sf):
    df = assessed_documents(spark, sf).withColumn("diversity_score", metric("response_quality"))
    return df.select("id", _r(selection.selection_score()).alias("score"))


# --- near duplicates in SQL ------------------------------------------------------

def _near_sql(threshold: float) -> str:
    """Clusters of near duplicates of ``base`` (id, score, t) by comparing all pairs."""
    return f"""ex AS (SELECT t, arg_min(id, {{'a': -score, 'b': id}}) AS keeper, count(*) AS copies FROM base GROUP BY t),
toks AS (SELECT keeper AS id, string_split(t, ' ') AS w FROM ex),
sh AS (SELECT DISTINCT id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM toks, range(1, len(w) - 1) r(i) WHERE len(w) >= 3),
sz AS (SELECT id, count(*) AS m FROM sh GROUP BY id),
common AS (SELECT a.id AS a, b.id AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.id < b.id GROUP BY 1, 2),
pairs AS (SELECT a, b FROM common JOIN sz x ON x.id = a JOIN sz y ON y.id = b WHERE c >= {threshold} * (x.m + y.m - c) - 1e-9),
sym AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach(n, l) AS (SELECT DISTINCT a, a FROM sym UNION SELECT s.b, r.l FROM reach r JOIN sym s ON s.a = r.n),
comp AS (SELECT n AS keeper, min(l) AS component FROM reach GROUP BY n),
mem AS (SELECT base.id, base.score, coalesce(component, ex.keeper) AS cluster FROM base JOIN ex USING (t) LEFT JOIN comp USING (keeper) WHERE copies > 1 OR component IS NOT NULL),
best AS (SELECT cluster, arg_min(id, {{'a': -score, 'b': id}}) AS keeper FROM mem GROUP BY cluster)"""


_NEAR = f"WITH RECURSIVE base AS (SELECT 'd' || doc_id AS id, n_chars::DOUBLE AS score, {normalized_sql('text')} AS t FROM documents), {_near_sql(0.85)}"


# --- selection -------------------------------------------------------------------

def _takes_sql(name: str, target: int, shares: dict[str, float]) -> str:
    """The band quotas as SQL: own share, then loans from medium, easy and hard."""
    q = {b: int(target * s) for b, s in shares.items()}
    q["medium"] += target - sum(q.values())
    return f"""n AS (SELECT count(*) FILTER (WHERE band = 'easy') AS e, count(*) FILTER (WHERE band = 'medium') AS m, count(*) FILTER (WHERE band = 'hard') AS h FROM {name}),
o AS (SELECT *, least({q['easy']}, e) AS te, least({q['medium']}, m) AS tm, least({q['hard']}, h) AS th FROM n),
e1 AS (SELECT *, least({q['easy']} - te, m - tm) AS em FROM o), e2 AS (SELECT *, least({q['easy']} - te - em, h - th) AS eh FROM e1),
f AS (SELECT e, m, h, te, tm + em AS tm, th + eh AS th, tm AS om, th AS oh FROM e2),
m1 AS (SELECT *, least({q['medium']} - om, e - te) AS me FROM f), m2 AS (SELECT *, least({q['medium']} - om - me, h - th) AS mh FROM m1),
g AS (SELECT e, m, h, te + me AS te, tm, th + mh AS th, oh FROM m2),
h1 AS (SELECT *, least({q['hard']} - oh, m - tm) AS hm FROM g), h2 AS (SELECT *, least({q['hard']} - oh - hm, e - te) AS he FROM h1),
k AS (SELECT te + he AS easy, tm + hm AS medium, th AS hard FROM h2)"""


def _quota_sql(name: str, target: int, shares: dict[str, float]) -> str:
    """The best rows of each band within its quota."""
    return f"""{_takes_sql(name, target, shares)},
picked AS (SELECT s.* FROM {name} s, k QUALIFY row_number() OVER (PARTITION BY band ORDER BY score DESC, {hash60_sql('id')}, id)
  <= CASE band WHEN 'easy' THEN k.easy WHEN 'medium' THEN k.medium ELSE k.hard END)"""


_BAND = "CASE WHEN ic < 0.4 THEN 'easy' WHEN ic > 0.7 THEN 'hard' ELSE 'medium' END AS band"
_SHARES = {"easy": 0.3, "medium": 0.5, "hard": 0.2}


def _balanced(spark, sf, target, shares=None, in_place=ranking.IN_PLACE_ROWS):
    narrow = assessed_documents(spark, sf).select("id", "metadata", "evaluations", _r(metric("overall_score"), 9).alias("score"))
    picked = selection.balanced_selection(stage(narrow, "scored"), target, shares, score=F.col("score"), in_place=in_place)
    return picked.select("id", selection.difficulty_band(metric("instruction_complexity")).alias("band"), "score")


_BANDED = f"{ASSESSED}, banded AS (SELECT id, round(overall, 9) AS score, {_BAND} FROM assessed)"


@query("h1_balanced_selection", f"WITH {_BANDED}, {_quota_sql('banded', 300, _SHARES)} SELECT id, band, score FROM picked")
def _(spark, sf):
    return _balanced(spark, sf, 300)


@query("h1_balanced_borrowing", f"WITH {_BANDED}, {_quota_sql('banded', 120, {'easy': 0.05, 'medium': 0.05, 'hard': 0.9})} SELECT id, band, score FROM picked")
def _(spark, sf):
    return _balanced(spark, sf, 120, {"easy": 0.05, "medium": 0.05, "hard": 0.9}, in_place=20)


@query("c12_multi_dimension_filter", f"""WITH {_diverse_sql('gated', "gated AS (SELECT * FROM assessed WHERE overall >= 0.3 AND coalesce(ss, 1) >= 0.9 AND raq >= 0.2)")},
banded AS (SELECT id, overall * (1 - 0.3::DOUBLE) + diversity * 0.3::DOUBLE AS score, {_BAND} FROM divs),
{_quota_sql('banded', 300, _SHARES)} SELECT id, round(score, 6) AS score FROM picked""")
def _(spark, sf):
    picked = selection.multi_dimension_filter(
        assessed_documents(spark, sf), target=300, quality_threshold=0.3,
        gate={"thresholds": {}, "rationale_threshold": 0.2, "answer_threshold": 0.0},
    )
    return picked.select("id", _r(F.col("selection_score")).alias("score"))


_CELL_SQL = """cells AS (SELECT *, row_number() OVER (PARTITION BY band, domain ORDER BY score DESC, {hash}, id) AS place, count(*) OVER (PARTITION BY band, domain) AS size,
  CASE band WHEN 'easy' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END AS b FROM banded),
sured AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY (2 * place - 1)::DOUBLE / size, b)
  <= least({floor}, (SELECT {target} // count(DISTINCT domain) FROM banded)) AS sure FROM cells),
lined AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY sure DESC, {rest}) AS r,
  CASE band WHEN 'easy' THEN k.easy WHEN 'medium' THEN k.medium ELSE k.hard END AS quota FROM sured, k),
first_ones AS (SELECT *, row_number() OVER (ORDER BY sure, r::DOUBLE / nullif(quota, 0) DESC, b DESC) AS away FROM lined WHERE sure OR r <= quota),
picked AS (SELECT * FROM first_ones WHERE sure OR away > (SELECT count(*) - least({target}, (SELECT count(*) FROM banded)) FROM first_ones))"""


def _cells_sql(target: int, floor: int, balance: bool) -> str:
    """Selection row by row: what each domain is sure of, then the rest of each band."""
    h = hash60_sql("id")
    return _CELL_SQL.format(hash=h, floor=floor, target=target, rest="place, domain" if balance else f"score DESC, {h}, id")


_GATE = "overall >= 0.3 AND coalesce(ss, 1) >= 0.9 AND raq >= 0.2"


@query("c12_filter_dedup_domains", f"""WITH RECURSIVE {ASSESSED}, passed AS (SELECT * FROM assessed WHERE {_GATE}),
base AS (SELECT id, round(overall, 9) AS score, {normalized_sql('text')} AS t FROM passed JOIN documents ON id = 'd' || doc_id), {_near_sql(0.85)},
{_diverse_sql('gated', 'gated AS (SELECT * FROM passed WHERE id NOT IN (SELECT mem.id FROM mem JOIN best USING (cluster) WHERE mem.id <> best.keeper))').removeprefix(ASSESSED + ', ')},
banded AS (SELECT id, domain, overall * (1 - 0.3::DOUBLE) + diversity * 0.3::DOUBLE AS score, {_BAND} FROM divs),
{_takes_sql('banded', 250, _SHARES)}, {_cells_sql(250, 70, True)}
SELECT id, domain, band, round(score, 6) AS score FROM picked""")
def _(spark, sf):
    picked = selection.multi_dimension_filter(
        assessed_documents(spark, sf), target=250, quality_threshold=0.3,
        gate={"thresholds": {}, "rationale_threshold": 0.2, "answer_threshold": 0.0},
        similarity_threshold=0.85, text=F.col("response.origin_text"), min_domain_samples=70, domain_balance=True,
    )
    band = selection.difficulty_band(metric("instruction_complexity", 0.5))
    return picked.select("id", F.col("metadata.domain").alias("domain"), band.alias("band"), _r(F.col("selection_score")).alias("score"))


@query("c13_domain_floors", f"WITH {_BANDED.replace('SELECT id,', 'SELECT id, domain,')}, {_takes_sql('banded', 160, _SHARES)}, {_cells_sql(160, 45, False)} SELECT id, domain, band, score FROM picked")
def _(spark, sf):
    rows = assessed_documents(spark, sf).select("id", "metadata", "evaluations", _r(metric("overall_score"), 9).alias("score"))
    picked = selection.cell_selection(stage(rows, "scored"), 160, min_per_domain=45, score=F.col("score"))
    band = selection.difficulty_band(metric("instruction_complexity", 0.5))
    return picked.select("id", F.col("metadata.domain").alias("domain"), band.alias("band"), "score")


@query("c13_domain_quotas", f"""WITH {ASSESSED}, r AS (SELECT id, domain, round(overall, 9) AS score, row_number() OVER (PARTITION BY domain ORDER BY round(overall, 9) DESC, {hash60_sql('id')}, id) AS rn,
  count(*) OVER (PARTITION BY domain) AS n FROM assessed)
SELECT id, domain, score FROM r WHERE rn <= least(n, greatest(10, 15))""")
def _(spark, sf):
    narrow = stage(assessed_documents(spark, sf).select("id", "metadata", _r(metric("overall_score"), 9).alias("score")), "scored")
    picked = selection.domain_selection(narrow, 40, min_per_domain=15, score=F.col("score"))
    return picked.select("id", F.col("metadata.domain").alias("domain"), "score")


_FILTERING = f"""WITH {_BANDED}, passed AS (SELECT * FROM banded WHERE score >= 0.4), {_quota_sql('passed', 200, _SHARES)},
rec AS (SELECT b.id, domain, difficulty, overall, p.id IS NOT NULL AS selected, CASE WHEN p.id IS NOT NULL THEN 'selected' WHEN b.score < 0.4 THEN 'below_quality_threshold' ELSE 'outside_quota' END AS reason,
  p.score AS selection_score FROM banded b LEFT JOIN picked p USING (id) JOIN assessed USING (id))"""


def _filtering(spark, sf):
    rows = stage(assessed_documents(spark, sf).select("id", "metadata", "evaluations", _r(metric("overall_score"), 9).alias("selection_score")), "scored")
    good = F.col("selection_score") >= 0.4
    picked = selection.balanced_selection(rows.where(good), 200, score=F.col("selection_score")).withColumn("diversity_score", F.lit(0.5))
    return selection.filtering_record(rows, picked, good, "2024-05-01T13:45:20Z")


@query("b8_filtering_record", f"""{_FILTERING} SELECT id, selected, reason, selection_score, round(overall * 0.7, 6) AS quality_contribution,
  CASE WHEN selected THEN 0.15::DOUBLE END AS diversity_contribution FROM rec""")
def _(spark, sf):
    f = F.col("filtering")
    return _filtering(spark, sf).select(
        "id", f["selected"].alias("selected"), f["reason"].alias("reason"), f["selection_score"].alias("selection_score"),
        _r(f["quality_contribution"]).alias("quality_contribution"), _r(f["diversity_contribution"]).alias("diversity_contribution"),
    )


@query("f7_filtering_report", f"""{_FILTERING}
SELECT 'totals' AS section, 'all' AS key, unnest(['input_samples', 'selected_samples', 'rejected_samples']) AS measure,
  unnest([count(*)::DOUBLE, count(*) FILTER (WHERE selected), count(*) FILTER (WHERE NOT selected)]) AS value FROM rec
UNION ALL SELECT 'quality', 'overall_score', unnest(['mean', 'median', 'min', 'max']), unnest([round(avg(overall), 6), round(median(overall), 6), round(min(overall), 6), round(max(overall), 6)]) FROM rec WHERE selected
UNION ALL SELECT 'domain', domain, 'count', count(*) FROM rec WHERE selected GROUP BY domain
UNION ALL SELECT 'difficulty', CASE WHEN difficulty < 0.3 THEN 'easy' WHEN difficulty <= 0.7 THEN 'medium' ELSE 'hard' END, 'count', count(*) FROM rec WHERE selected GROUP BY 2
UNION ALL SELECT 'deduplication', 'all', unnest(['duplicate_clusters_found', 'duplicates_removed']), unnest([count(*)::DOUBLE, sum(n - 1)]) FROM (SELECT count(*) AS n FROM documents GROUP BY {normalized_sql('text')} HAVING n > 1)""")
def _(spark, sf):
    keepers = dedup.exact_keepers(document_samples(spark, sf), F.col("response.origin_text"), F.lit(0.0)).where("copies > 1")
    counts = keepers.agg(F.count(F.lit(1)).alias("clusters"), F.sum(F.col("copies") - 1).alias("removed"))
    return reports.filtering_report(stage(_filtering(spark, sf), "filtered"), counts).withColumn("value", F.round("value", 6))


# --- joins and set operations ----------------------------------------------------

@query("g1_score_lookup", f"WITH {DOCS} SELECT id, coalesce(quality, 0)::DOUBLE AS score FROM docs")
def _(spark, sf):
    scores = table(spark, sf, "labels").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("quality").cast("double").alias("score"))
    return document_samples(spark, sf).select("id").join(scores, "id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


@query("g3_lineage_orphans", f"""WITH {CONVS} SELECT t.conv_id || ':' || t.turn AS id FROM conversations t
WHERE role = 'assistant' AND 'c' || conv_id || '_' || (turn - 1) NOT IN (SELECT id FROM convs WHERE domain = 'opening')""")
def _(spark, sf):
    seeds = conversation_samples(spark, sf).where("metadata.domain = 'opening'").select(F.col("id").alias("seed_id"))
    made = table(spark, sf, "conversations").where("role = 'assistant'").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string")).alias("seed_id"),
    )
    return made.join(seeds, "seed_id", "left_anti").select("id")


@query("g3_lineage_bucketed", f"""WITH {CONVS} SELECT t.conv_id || ':' || t.turn AS id FROM conversations t
WHERE role = 'assistant' AND 'c' || conv_id || '_' || (turn - 1) NOT IN (SELECT id FROM convs WHERE domain = 'opening')""")
def _(spark, sf):
    seed_path, made_path = stage_path(spark, "seeds"), stage_path(spark, "made")
    writers.write_bucketed(conversation_samples(spark, sf).where("metadata.domain = 'opening'").select(F.col("id").alias("seed_id")), seed_path, "seed_id", 8)
    writers.write_bucketed(table(spark, sf, "conversations").where("role = 'assistant'").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.concat(F.lit("c"), F.col("conv_id").cast("string"), F.lit("_"), (F.col("turn") - 1).cast("string")).alias("seed_id"),
    ), made_path, "seed_id", 8)
    made, seeds = (writers.read_bucketed(spark, p, "seed_id", 8) for p in (made_path, seed_path))
    return made.join(seeds, "seed_id", "left_anti").select("id")


@query("i1_concat_samples", f"""WITH {DOCS}, {CONVS}
SELECT id, domain, NULL::DOUBLE AS score FROM docs UNION ALL SELECT id, domain, 1.0::DOUBLE FROM convs""")
def _(spark, sf):
    made = conversation_samples(spark, sf).withColumn("score", F.lit(1.0))
    return normalize.concat_samples(document_samples(spark, sf), made).select("id", F.col("metadata.domain").alias("domain"), "score")


@query("i3_exact_duplicates", f"""WITH t AS (SELECT 'd' || doc_id AS id, n_chars::DOUBLE AS score, {normalized_sql('text')} AS k FROM documents)
SELECT arg_min(id, {{'a': -score, 'b': id}}) AS id FROM t GROUP BY k""")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text", F.col("n_chars").cast("double").alias("score"))
    return dedup.drop_exact_duplicates(docs, F.col("text"), F.col("score")).select("id")


@query("g8_near_duplicates", f"{_NEAR} SELECT id, cluster, best.keeper FROM mem JOIN best USING (cluster)")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text", "n_chars")
    return dedup.duplicate_clusters(docs, F.col("text"), F.col("n_chars"))


@query("g8_kept_rows", f"{_NEAR} SELECT base.id FROM base LEFT JOIN (SELECT mem.id FROM mem JOIN best USING (cluster) WHERE mem.id <> best.keeper) d USING (id) WHERE d.id IS NULL")
def _(spark, sf):
    docs = table(spark, sf, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text", "n_chars")
    clusters = dedup.duplicate_clusters(docs, F.col("text"), F.col("n_chars"), bucket_rows=4)
    return dedup.drop_near_duplicates(docs, clusters).select("id")


