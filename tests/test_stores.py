"""The id index, the compacted store, lookups with null keys, prompts and prices."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from quillsieve.functions import chat
from quillsieve.operators import costs, generation, lookup, rollups, stats
from quillsieve.session import lookup_join
from quillsieve.sources import readers, writers
from quillsieve.streaming import ingest


def _scan_rows(df):
    """Rows that the scan of a plan without exchanges has handed on, after running it."""
    execution = df._jdf.queryExecution()
    execution.toRdd().count()
    return execution.executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()


def test_id_lookup_reads_few_row_groups(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.concat(F.lit("s"), F.col("id").cast("string")).alias("id"), F.sha2(F.col("id").cast("string"), 512).alias("instruction"))
    rows = rows.unionByName(spark.createDataFrame([(None, "x"), (None, "y")], "id string, instruction string"))
    lookup.write_id_index(rows, str(tmp_path), buckets=4, row_group_bytes=64 << 10)
    assert spark.read.parquet(str(tmp_path)).count() == 40_002
    found = lookup.find_id(spark, str(tmp_path), "s123")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(id_of_4" in plan and "EqualTo(id,s123)" in plan
    assert [r["id"] for r in found.collect()] == ["s123"] and found.columns == ["id", "instruction"]
    assert _scan_rows(found) < 3_000  # of 10,000 rows in the bucket
    assert _scan_rows(lookup.find_id(spark, str(tmp_path), "s123x")) == 0  # between two ids, but not in the Bloom filter
    for n in (20, 3_000):
        wanted = spark.range(n).select(F.concat(F.lit("s"), (F.col("id") * 7).cast("string")).alias("id"))
        wanted = wanted.unionByName(wanted.limit(3)).unionByName(spark.createDataFrame([(None,), ("none",)], "id string"))
        assert sorted(r["id"] for r in lookup.find_ids(spark, str(tmp_path), wanted).collect()) == sorted(f"s{7 * i}" for i in range(n))
    with pytest.raises(ValueError):
        rows.write.parquet(f"{tmp_path}/plain")
        lookup.find_id(spark, f"{tmp_path}/plain", "s1")


def test_store_touches_changed_buckets_only(spark, tmp_path):
    source, valid, bad, checkpoint, store = (str(tmp_path / x) for x in ("source", "valid", "bad", "checkpoint", "store"))
    (tmp_path / "source").mkdir()

    def drop(name, ids, text):
        lines = [json.dumps({"id": i, "instruction": "Do it", "response": text, "metadata": {"domain": "d", "difficulty": 0.5}}) for i in ids]
        (tmp_path / "source" / name).write_text("\n".join(lines))
        ingest.start_ingest(spark, source, valid, bad, checkpoint, rules={"min_instruction": 1}, batch_bytes=1_000).awaitTermination()

    def now(**settings):
        return {r["id"]: r["response"]["origin_text"] for r in ingest.ingested(spark, valid, **settings).collect()}

    drop("a.jsonl", ["a", "b", "c"], "first text")
    drop("b.jsonl", [f"x{i}" for i in range(30)], "first text")
    assert len(ingest.compact(spark, valid, store, buckets=8)) > 1
    assert ingest.compact(spark, valid, store, buckets=8) == []
    drop("c.jsonl", ["b"], "second text")
    expected = dict.fromkeys(["a", "c", *[f"x{i}" for i in range(30)]], "first text") | {"b": "second text"}
    assert now() == expected
    assert now(store_path=store, buckets=8) == expected
    assert len(ingest.compact(spark, valid, store, buckets=8)) == 1
    assert now(store_path=store, buckets=8) == expected
    drop("d.jsonl", ["b", "new"], "third text")
    expected |= {"b": "third text", "new": "third text"}
    assert now(store_path=store, buckets=8) == expected == now()
    assert spark.read.parquet(valid).select("batch").distinct().count() == 4


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_with_null_keys(spark, how):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (3, "e")], "k int, v string")
    other = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, w int")
    plain = sorted(map(str, df.join(other, ["k"], how).collect()))
    for share in (2000, 4):
        assert sorted(map(str, lookup_join(df, other, ["k"], how, max_rows=0, hot_share=share).collect())) == plain


def test_system_prompts(spark):
    rows = [("own", "a"), ("", "a"), (None, "a"), (None, "b"), (None, "none"), (None, None)]
    df = spark.createDataFrame(rows, "o string, t string")
    found = [r[0] for r in df.select(chat.system_prompt(F.col("o"), F.col("t"), {"a": "A", "b": "B"})).collect()]
    assert found == ["own", "", "A", "B", None, None]


def test_costs(spark):
    calls = spark.createDataFrame([("m", 1000, 500), ("other", 1000, 500), (None, 1000, 0), ("m", None, None)], "model string, prompt_tokens int, completion_tokens int")
    prices = spark.createDataFrame([("m", "1k_tokens", 1.0, 2.0), ("big", "1m_tokens", 1.0, 2.0)], "model string, unit string, prompt_price double, completion_price double")

    def told(**settings):
        return sorted(r["call_cost"] for r in costs.with_cost(calls, prices, **settings).collect())

    assert told() == [0.0, 0.0, 0.0, 2.0]
    assert told(default_model="big") == pytest.approx([0.0, 0.001, 0.002, 2.0])
    assert told(default_model="absent") == [0.0, 0.0, 0.0, 2.0]


def test_yaml_forms(spark):
    values = {
        "literal": ("template: |\n      a\n        b\n      c\n", "a\n  b\nc\n"), "folded": ("template: >\n  a\n  b\n\n  c\n", "a b\nc\n"),
        "plain": ("x: 1\ntemplate: just {instruction}\n", "just {instruction}"), "quoted": ('template: "a\\nb"\n', "a\nb"),
        "list": ("- template\n", None), "number": ("template: 3\n", None), "broken": ("template: [\n", None),
    }
    files = spark.createDataFrame([(n, "yaml", v) for n, (v, _) in values.items()], "name string, kind string, value string")
    assert readers.parse_templates(files) == {n: t for n, (_, t) in values.items() if t is not None}


def test_three_seeds_and_many_slots(spark):
    seeds = spark.createDataFrame([(f"s{i}", "text") for i in range(3)], "id string, instruction string")
    plan = generation.round_robin_plan(seeds, 3_000, slots_per_task=100)
    assert {r["seed_id"]: r["count"] for r in plan.groupBy("seed_id").count().collect()} == {"s0": 1000, "s1": 1000, "s2": 1000}
    assert sorted(r["slot"] for r in plan.collect()) == list(range(3_000))


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    rows = spark.range(1_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("id"), F.col("id").alias("v"))
    writers.write_bucketed(rows, f"{tmp_path}/work", buckets=8)
    writers.write_bucketed(rows.where("v % 2 = 0").select("id"), f"{tmp_path}/done", buckets=8)
    spark.sql(f"DROP TABLE {writers._table_name(f'{tmp_path}/done/by_id_8')}")  # as in another session
    writers.write_bucketed(rows.where("v % 3 = 0").select("id"), f"{tmp_path}/done", buckets=8, mode="append")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = ingest.pending(*(writers.read_bucketed(spark, f"{tmp_path}/{n}", buckets=8) for n in ("work", "done")))
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert sorted(r["v"] for r in left.collect()) == [v for v in range(1_000) if v % 2 and v % 3]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_merged_runs_equal_one_scan(spark, tmp_path):
    rows = spark.range(900).select(
        F.concat(F.lit("s"), (F.col("id") % 700).cast("string")).alias("id"), F.repeat(F.lit("x"), (F.col("id") % 7).cast("int")).alias("instruction"),
        F.struct(F.when(F.col("id") % 5 > 0, F.lit("text")).alias("origin_text")).alias("response"),
        F.struct(F.when(F.col("id") % 4 > 0, F.concat(F.lit("d"), (F.col("id") % 4).cast("string"))).alias("domain"),
                 F.when(F.col("id") % 9 > 0, (F.col("id") % 11) / 10.0).alias("difficulty"), (F.col("id") % 13).cast("string").alias("file")).alias("metadata"))
    for k in range(3):
        rollups.write_partials(rows.where((F.crc32(F.col("id").cast("binary")) % 3) == k), str(tmp_path), f"r{k}", F.col("metadata.file"))
    rollups.write_partials(rows.where((F.crc32(F.col("id").cast("binary")) % 3) == 2), str(tmp_path), "r2", F.col("metadata.file"))  # repeated
    partials = rollups.read_partials(spark, str(tmp_path))

    def same(found, expected):
        a, b = (sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str) for df in (found, expected))
        for x, y in zip(a, b, strict=True):
            assert [pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for v in x] == list(y)

    same(rollups.merged_seed_statistics(partials), stats.seed_statistics(rows, F.col("metadata.file")))
    same(rollups.merged_index_statistics(partials), stats.index_statistics(rows))
    same(rollups.merged_final_statistics(partials), stats.final_statistics(rows))
    estimate = {r["kind"]: r["count"] for r in rollups.merged_index_statistics(partials, exact=False).collect() if r["key"] is None}
    assert abs(estimate["distinct_ids"] - 700) < 40 and estimate["total"] == 900


def test_flat_files_are_bounded(spark, tmp_path):
    from quillsieve.sources import readers, writers

    rows = [(str(i), f'line {i}\n"two"') for i in range(12)]
    path = str(tmp_path / "flat")
    writers.write_flat(spark.createDataFrame(rows, "id string, text string").coalesce(1), path, file_rows=5)
    assert readers.list_files(spark, path, "*.csv").count() == 3
    assert sorted(map(tuple, readers.read_csv(spark, path, multiline=True).collect())) == sorted(rows)
