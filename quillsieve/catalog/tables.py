"""Queries that write the given tables in a sample format and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.catalog.registry import query
from quillsieve.catalog.views import CALLS, CONVS, DOCS, call_log, conversation_samples, document_samples, table
from quillsieve.operators import lookup, rules, stats
from quillsieve.operators.normalize import nest_flat
from quillsieve.session import stage_path
from quillsieve.sources import readers, writers


def _shown(df):
    return df.select(
        "id", F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty"),
        F.md5("instruction").alias("instruction"), F.md5("response.origin_text").alias("origin"), F.md5("response.final_answer").alias("answer"),
    )


_SHOWN = "SELECT id, domain, difficulty, md5(instruction) AS instruction, md5(origin_text) AS origin, md5(final_answer) AS answer"


@query("a1_jsonl_scan", f"""WITH {DOCS} SELECT domain, count(*) AS records, sum(length(origin_text))::BIGINT AS chars, 0 AS malformed FROM docs WHERE domain <> 'de' GROUP BY domain
UNION ALL SELECT 'broken', 0, 0, count(*) FROM docs WHERE domain = 'de'""")
def _(spark, sf):
    path = stage_path(spark, "jsonl")
    lines = writers.to_record(document_samples(spark, sf)).select("metadata.domain", F.to_json(F.struct("id", "instruction", "response", "metadata")).alias("line"))
    cut = F.when(F.col("domain") == "de", F.expr("left(line, length(line) - 1)")).otherwise(F.col("line"))
    lines.select(cut.alias("value")).write.option("compression", "none").text(path)
    good, bad = readers.read_jsonl(spark, path, pattern="*.txt")
    typed = good.select(*readers.record_to_sample(F.col("record")))
    counted = typed.groupBy(F.col("metadata.domain").alias("domain")).agg(
        F.count(F.lit(1)).alias("records"), F.sum(F.length("response.origin_text")).alias("chars"), F.lit(0).cast("bigint").alias("malformed"),
    )
    broken = bad.agg(F.count(F.lit(1)).alias("malformed")).select(
        F.lit("broken").alias("domain"), F.lit(0).cast("bigint").alias("records"), F.lit(0).cast("bigint").alias("chars"), "malformed"
    )
    return counted.unionByName(broken)


@query("a2_json_documents", """
SELECT lang AS shape, count(*) AS records, sum(length(line))::BIGINT AS chars FROM (
  SELECT lang, unnest(CASE WHEN lang IN ('en', 'fr') THEN string_split(text, chr(10)) ELSE [text] END) AS line FROM documents WHERE lang <> 'es') GROUP BY lang
UNION ALL SELECT 'unusable', count(*), 0 FROM documents WHERE lang = 'es'""")
def _(spark, sf):
    lang, body = F.col("lang"), F.col("text")
    items = F.transform(F.split(body, "\n"), lambda x: F.struct(x.alias("line")))
    doc = (
        F.when(lang == "en", F.to_json(items)).when(lang == "fr", F.to_json(F.struct(items.alias("data"))))
        .when(lang == "de", F.to_json(F.struct(body.alias("line")))).otherwise(F.lit('"just a string"'))
    )
    docs = table(spark, sf, "documents").select("lang", F.try_parse_json(doc).alias("doc"))
    good, bad = readers.explode_documents(docs)
    lines = good.select("lang", F.try_variant_get("record", "$.line", "string").alias("line"))
    counted = lines.groupBy(F.col("lang").alias("shape")).agg(F.count(F.lit(1)).alias("records"), F.sum(F.length("line")).alias("chars"))
    return counted.unionByName(bad.agg(F.count(F.lit(1)).alias("records")).select(F.lit("unusable").alias("shape"), "records", F.lit(0).cast("bigint").alias("chars")))


@query("a3_csv_scan", f"WITH {DOCS} {_SHOWN} FROM docs")
def _(spark, sf):
    path = stage_path(spark, "csv")
    flat = document_samples(spark, sf).select(
        "id", "instruction", F.to_json("response").alias("response"), F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty"),
    )
    writers.write_flat(flat, path)
    return _shown(nest_flat(readers.read_csv(spark, path, multiline=True)))


@query("a4_tsv_scan", f"WITH {CONVS} {_SHOWN} FROM convs")
def _(spark, sf):
    path = stage_path(spark, "tsv")
    flat = conversation_samples(spark, sf).select(
        "id", "instruction", F.to_json("response").alias("response"), F.col("metadata.domain").alias("domain"), F.col("metadata.difficulty").alias("difficulty"),
    )
    writers.write_flat(flat.withColumn("part", F.col("domain")), path, "\t", "part")
    return _shown(nest_flat(readers.read_csv(spark, path, fmt="tsv", pattern="*.csv", multiline=True)))


@query("a5_jsonl_sink", f"WITH {CONVS} {_SHOWN} FROM convs")
def _(spark, sf):
    path = stage_path(spark, "jsonl-sink")
    writers.write_jsonl(writers.to_record(conversation_samples(spark, sf)), path)
    good, _bad = readers.read_jsonl(spark, path, pattern="*.json")
    return _shown(good.select(*readers.record_to_sample(F.col("record"))))


@query("a6_stage_latest", f"WITH {DOCS} SELECT id, domain FROM docs WHERE domain = 'fr'")
def _(spark, sf):
    path = stage_path(spark, "runs")
    docs = document_samples(spark, sf).select("id", F.col("metadata.domain").alias("domain"))
    for other in ("007", "1e3", "20240501T100000"):
        writers.write_stage(docs.where("domain <> 'fr'"), path, other)
    writers.write_stage(docs.where("domain = 'fr'"), path, "20240502T100000")
    return writers.read_stage(spark, path)


@query("a7_append_seed", f"WITH {CONVS} SELECT 2 * count(*) FILTER (WHERE length(origin_text) >= 120) AS stored, count(*) FILTER (WHERE length(origin_text) >= 120) AS added FROM convs")
def _(spark, sf):
    path = stage_path(spark, "seed")
    short = rules.reasons(("short", F.length("response.origin_text") < 120))
    checked = conversation_samples(spark, sf).withColumn("why", short)
    valid, _ = rules.split_valid(checked, "why")
    writers.append_seed(writers.to_record(valid), path)
    added = writers.append_seed(writers.to_record(valid), path)
    stored, _bad = readers.read_jsonl(spark, path, pattern="*.json")
    return stored.agg(F.count(F.lit(1)).alias("stored")).withColumn("added", F.lit(added).cast("bigint"))


@query("a10_index_scan", f"WITH {DOCS} SELECT id, domain, least(floor(difficulty * 5), 4)::BIGINT AS bucket FROM docs WHERE domain = 'en' AND least(floor(difficulty * 5), 4) BETWEEN 1 AND 3")
def _(spark, sf):
    path = stage_path(spark, "index")
    lookup.write_index(document_samples(spark, sf), path)
    found = lookup.read_index(spark, path, domain="en", low=0.2, high=0.7)
    return found.select("id", "domain", F.col("difficulty_bucket").cast("bigint").alias("bucket"))


@query("a3_csv_split", """SELECT doc_id::VARCHAR AS id, lang AS domain, n_chars::VARCHAR AS chars, md5(coalesce(source, '')) AS source FROM documents""")
def _(spark, sf):
    path = stage_path(spark, "csv-lines")
    flat = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("domain"), F.col("n_chars").alias("chars"), "source")
    flat.write.option("header", "true").csv(path)
    return readers.read_csv(spark, path).select("id", "domain", "chars", F.md5(F.coalesce("source", F.lit(""))).alias("source"))


@query("a8_latest_file", f"WITH {DOCS} SELECT metadata_source AS source, count(*) AS records FROM (SELECT source AS metadata_source, domain FROM docs) WHERE domain = 'fr' GROUP BY 1")
def _(spark, sf):
    path = stage_path(spark, "drops")
    docs = document_samples(spark, sf)
    for domain in ("en", "de", "fr"):  # one small file of counts per drop
        counts = docs.where(F.col("metadata.domain") == domain).groupBy(F.col("metadata.source").alias("source")).agg(F.count(F.lit(1)).alias("records"))
        counts.coalesce(1).write.mode("append").option("ignoreNullFields", "false").json(path)
    newest = readers.latest_file(spark, path, "*.json")
    return spark.read.schema("source string, records bigint").json(newest)


_FORMS = """CASE n_nationkey % 6 WHEN 0 THEN 'Say {instruction} in ' || n_name WHEN 1 THEN 'Answer "' || n_name || '": {response}'
  WHEN 2 THEN 'First ' || n_name || chr(10) || '  deeper {domain}' || chr(10) || 'last' || chr(10)
  WHEN 3 THEN 'folded ' || n_name || ' {difficulty} line' || chr(10) || 'next' WHEN 4 THEN 'it''s ' || n_name || ': {instruction}' END"""


@query("a12_templates", f"SELECT 'n' || n_nationkey AS name, {_FORMS} AS template FROM nation WHERE n_nationkey % 6 < 5")
def _(spark, sf):
    form, n = F.col("n_nationkey") % 6, F.col("n_name")
    value = (
        F.when(form == 0, F.concat(F.lit("Say {instruction} in "), n))
        .when(form == 1, F.to_json(F.struct(F.concat(F.lit('Answer "'), n, F.lit('": {response}')).alias("template"))))
        .when(form == 2, F.concat(F.lit("name: x\ntemplate: |\n    First "), n, F.lit("\n      deeper {domain}\n    last\nother: 1\n")))
        .when(form == 3, F.concat(F.lit("template: >-\n  folded "), n, F.lit("\n  {difficulty} line\n\n  next\n")))
        .when(form == 4, F.concat(F.lit("template: 'it''s "), n, F.lit(": {instruction}'  # quoted\n")))
        .otherwise(F.lit("template: [broken\n"))
    )
    kind = F.when(form == 0, "txt").when(form == 1, "json").otherwise("yaml")
    files = table(spark, sf, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("name"), kind.alias("kind"), value.alias("value"))
    found = readers.parse_templates(files)
    return spark.createDataFrame(list(found.items()), "name string, template string")


@query("a10_id_lookup", f"WITH {DOCS} SELECT id, domain, md5(origin_text) AS origin FROM docs WHERE id IN ('d17', 'd42', 'd99') OR id IN (SELECT 'd' || doc_id FROM labels WHERE toxic = 1)")
def _(spark, sf):
    path = stage_path(spark, "id-index")
    lookup.write_id_index(document_samples(spark, sf), path, buckets=16)
    toxic = table(spark, sf, "labels").where("toxic = 1").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"))
    found = lookup.find_ids(spark, path, toxic)
    for one in ("d17", "d42", "d99"):
        found = found.unionByName(lookup.find_id(spark, path, one))
    return found.select("id", F.col("metadata.domain").alias("domain"), F.md5("response.origin_text").alias("origin")).distinct()


@query("a14_usage_sink", f"""WITH {CALLS} SELECT CASE WHEN grouping(provider) = 1 THEN 'all' ELSE provider END AS provider, count(*) AS total_requests, '2024-05-01' AS day FROM calls GROUP BY ROLLUP (provider)""")
def _(spark, sf):
    path = stage_path(spark, "usage")
    writers.write_usage(stats.usage_metrics(call_log(spark, sf)), path, "2024-05-01T12:00:00Z")
    saved = spark.read.schema("provider string, total_requests bigint, timestamp timestamp").json(path)
    return saved.select("provider", "total_requests", F.date_format("timestamp", "yyyy-MM-dd").alias("day"))

