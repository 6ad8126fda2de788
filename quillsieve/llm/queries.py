"""A query for each operator, with the settings of production and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm import (
    alignment, decontaminate, mixing, records, repeats, sharding, simhash_dedup, simhash_tables, spelling, substrings, toxicity, url_filter, warc,
)
from quillsieve.llm.common import table

TOKENIZER = "word_bpe_49k.json"
SHARDS = 24
REVISIT_BYTES = 0
# (host, path, verdict)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_components(table(spark, sf_dir, "documents"), size=4, distance=4)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def op2_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_table(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2).withColumnRenamed("id", "doc_id")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.with_digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_epochs=3)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3).withColumnRenamed("id", "doc_id")


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tables.compare_neighbours(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"), shards=SHARDS).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES).withColumnRenamed("id", "page_id")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_table(table(spark, sf_dir, "pages"), minimum=REVISIT_BYTES).withColumnRenamed("id", "page_id")


def op10_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_spans(table(spark, sf_dir, "documents"), length=200).drop("spans").withColumnRenamed("id", "doc_id")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.later_passages(table(spark, sf_dir, "documents"), length=20).drop("spans").withColumnRenamed("id", "doc_id")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = spelling.word_counts(table(spark, sf_dir, "documents"), min_length=6, min_count=5, every=199)
    return spelling.variants(counts, ratio=5)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_simhash_dedup, op2_token_records, op3_decontaminate, op4_mix_sources, op5_toxicity, op6_fingerprints,
              op7_shards, op8_url_filter, op9_warc, op10_repeated_bytes, op11_substring_dedup, op12_spelling_variants, op13_token_alignment)
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_OP3_WORDS = rf"regexp_extract_all({_LOWER.format('coalesce(text, chr(32))')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP3_SQL = f"""
WITH items AS (SELECT item_id, {_OP3_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
docs AS (SELECT doc_id, {_OP3_WORDS} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
grams AS (
  SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
  FROM places CROSS JOIN (SELECT DISTINCT n FROM windows) s WHERE i + n - 1 <= len(w)),
found AS (SELECT doc_id, i, n, item_id FROM grams JOIN windows USING (n, win)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(joined, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN named USING (doc_id)"""

OP4_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix:' || doc_id), 1, 8))::BIGINT AS draw FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM sources),
summed AS (
  SELECT *, sum(source_size) OVER () AS total,
    coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
    sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free,
    row_number() OVER (ORDER BY cap / weight, source IS NULL, encode(source)) AS place FROM ranked),
start AS (SELECT min(place) AS place FROM summed WHERE weight * (total - capped) <= cap * free),
targets AS (
  SELECT s.source, s.source_size, CASE WHEN f.place IS NULL OR s.place < f.place THEN s.cap::DOUBLE
    ELSE s.weight::DOUBLE * (f.total - f.capped)::DOUBLE / f.free::DOUBLE END AS target
  FROM summed s LEFT JOIN (SELECT x.place, x.total, x.capped, x.free FROM summed x JOIN start USING (place)) f ON true),
placed AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole,
    sum(size) OVER (PARTITION BY s.source ORDER BY draw, doc_id ROWS UNBOUNDED PRECEDING) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (whole + CASE WHEN (2 * upto - size)::DOUBLE <= 2 * (target - (whole * source_size)::DOUBLE) THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed"""

OP8_SQL = r"""
WITH cut AS (SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM cut),
rules(rule_host, rule_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT page_id, rule_host || rule_path AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS n
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (page_id)"""

OP9_SQL = """
WITH hashed AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
grouped AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(hex, (k // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (k % 4))) & 31)::INT + 1, 1) FOR k IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM grouped"""

OP11_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM docs WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM later),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS joined FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(joined, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

ORACLES = {"op3_decontaminate": OP3_SQL, "op4_mix_sources": OP4_SQL, "op8_url_filter": OP8_SQL, "op9_warc": OP9_SQL, "op11_substring_dedup": OP11_SQL}
