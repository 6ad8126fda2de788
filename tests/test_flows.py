"""Sources, sinks, streams and the full run on small files."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from quillsieve.operators import generation, lookup
from quillsieve.plans import stages
from quillsieve.session import shared_dir
from quillsieve.sources import readers, writers
from quillsieve.streaming import ingest, usage

GOOD = {"id": "1", "instruction": "Add two numbers", "response": "The sum is four", "metadata": {"domain": "math", "difficulty": 0.3, "lang": "en"}}


def _write(folder, name, text):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return path


def test_jsonl_modes(spark, tmp_path):
    _write(tmp_path, "a.jsonl", json.dumps(GOOD) + "\n\n" + json.dumps({**GOOD, "id": "2"}) + "\n")
    _write(tmp_path, "deep/b.jsonl", json.dumps({**GOOD, "id": "3"}) + '\n{"id": "4"\n')
    _write(tmp_path, "c.txt", "not read")
    good, bad = readers.read_jsonl(spark, str(tmp_path))
    assert sorted(r["id"] for r in good.select(*readers.record_to_sample(F.col("record"))).collect()) == ["1", "2", "3"]
    assert bad.count() == 1
    good, _ = readers.read_jsonl(spark, str(tmp_path), mode="file")
    assert good.count() == 2


def test_record_fields(spark):
    df = spark.createDataFrame([(json.dumps(GOOD),), ('{"id": 5, "metadata": {"difficulty": "0.8"}}',), ('{"metadata": {"difficulty": "hard"}}',)], "l string")
    rows = df.select(*readers.record_to_sample(F.try_parse_json("l"))).collect()
    assert rows[0]["metadata"]["extra"] == {"lang": "en"} and rows[0]["response"]["final_answer"] == "The sum is four"
    assert (rows[1]["id"], rows[1]["metadata"]["difficulty"], rows[2]["metadata"]["difficulty"]) == (None, 0.8, None)


def test_json_shapes(spark, tmp_path):
    _write(tmp_path, "list.json", json.dumps([GOOD, GOOD], indent=1))
    _write(tmp_path, "data.json", json.dumps({"data": [GOOD]}))
    _write(tmp_path, "single.json", json.dumps({**GOOD, "data": 3}))
    _write(tmp_path, "number.json", "3")
    _write(tmp_path, "broken.json", "[1,")
    good, bad = readers.read_json(spark, str(tmp_path))
    assert good.count() == 4 and bad.count() == 2


def test_files_and_templates(spark, tmp_path):
    _write(tmp_path, "a.txt", "Say {instruction}")
    _write(tmp_path, "b.json", json.dumps({"template": "J {response}"}))
    _write(tmp_path, "c.yaml", "name: x\ntemplate: |\n  Y {domain}\n  end\n")
    _write(tmp_path, "d.json", json.dumps({"other": 1}))
    found = readers.read_templates(spark, str(tmp_path))
    assert {k: v for k, v in found.items() if len(k) == 1} == {"a": "Say {instruction}", "b": "J {response}", "c": "Y {domain}\nend\n"}
    assert len(readers.read_templates(spark)) == 3
    assert readers.list_files(spark, str(tmp_path), "*.json").count() == 2
    import os
    os.utime(tmp_path / "a.txt", (2_000_000_000, 2_000_000_000))
    assert readers.latest_file(spark, str(tmp_path)).endswith("a.txt")
    assert readers.latest_file(spark, str(tmp_path), "*.csv") is None


def test_pattern_for_unknown_format():
    assert readers.pattern_for("parquet") == "*.jsonl" and readers.pattern_for("tsv") == "*.tsv"


def test_stage_table_keeps_runs(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.write_stage(spark.range(5), path, "r1") == 5
    assert writers.write_stage(spark.range(3), path, "r2") == 3
    assert writers.write_stage(spark.range(2), path, "r2") == 2
    assert writers.read_stage(spark, path).count() == 2
    assert writers.read_stage(spark, path, "r1").count() == 5


def test_index_prunes_partitions(spark, tmp_path):
    df = spark.createDataFrame([(f"{i}", ("a" if i % 2 else "b", i / 20)) for i in range(21)], "id string, metadata struct<domain:string,difficulty:double>")
    lookup.write_index(df, str(tmp_path / "i"))
    found = lookup.read_index(spark, str(tmp_path / "i"), domain="a", low=0.5, high=0.7)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(domain" in plan
    assert sorted(int(r["id"]) for r in found.collect()) == [9, 11, 13, 15]


def test_stream_ingest_over_two_drops(spark, tmp_path):
    source, valid, bad, checkpoint = (str(tmp_path / x) for x in ("in", "valid", "bad", "cp"))
    _write(tmp_path / "in", "one.jsonl", json.dumps(GOOD) + "\n" + json.dumps({**GOOD, "id": "2", "response": "short"}) + "\nnot json\n")
    ingest.start_ingest(spark, source, valid, bad, checkpoint).awaitTermination()
    _write(tmp_path / "in", "two.jsonl", json.dumps(GOOD) + "\n" + json.dumps({k: v for k, v in GOOD.items() if k != "id"}) + "\n" + json.dumps({**GOOD, "id": "6"}) + "\n")
    ingest.start_ingest(spark, source, valid, bad, checkpoint).awaitTermination()
    assert sorted(r["id"] for r in ingest.ingested(spark, valid).collect()) == ["1", "6"]
    reasons = sorted(r["reject_reasons"][0] for r in spark.read.parquet(bad).collect())
    assert reasons == ["malformed", "missing:id", "short_response"]


def test_stream_ingest_loses_no_line(spark, tmp_path):
    source, valid, bad, checkpoint = (str(tmp_path / x) for x in ("in", "valid", "bad", "cp"))
    text = {**GOOD, "id": "7", "metadata": {"difficulty": "5"}}
    _write(tmp_path / "in", "one.jsonl", json.dumps(GOOD) + "\nbroken\nbroken\n" + json.dumps(text) + "\n")
    ingest.start_ingest(spark, source, valid, bad, checkpoint).awaitTermination()
    old = _write(tmp_path / "in", "old.jsonl", json.dumps({**GOOD, "id": "8"}) + "\nbroken\n" + json.dumps({**GOOD, "response": "A later answer"}) + "\n"
                 + json.dumps({**GOOD, "id": "9", "metadata": {"difficulty": 5}}) + "\n")
    os.utime(old, (1e9, 1e9))
    ingest.start_ingest(spark, source, valid, bad, checkpoint).awaitTermination()
    assert spark.read.parquet(valid).count() + spark.read.parquet(bad).count() == 8
    assert sorted(r["reject_reasons"][0] for r in spark.read.parquet(bad).collect()) == ["difficulty_range", *["malformed"] * 3]
    last = {r["id"]: r["response"]["origin_text"] for r in ingest.ingested(spark, valid).collect()}
    assert last == {"1": "A later answer", "7": GOOD["response"], "8": GOOD["response"]}


def test_run_ids_and_domains_stay_strings(spark, tmp_path):
    for run in ("007", "1e3"):
        assert writers.write_stage(spark.range(5), str(tmp_path / "t"), run) == 5
        assert writers.read_stage(spark, str(tmp_path / "t"), run).count() == 5
    assert writers.read_stage(spark, str(tmp_path / "t")).columns == ["id"]
    df = spark.createDataFrame([("a", ("007", 0.1)), ("b", ("2024", 0.9)), ("c", (None, 0.5))], "id string, metadata struct<domain:string,difficulty:double>")
    lookup.write_index(df, str(tmp_path / "i"))
    found = {r["id"]: r["domain"] for r in lookup.read_index(spark, str(tmp_path / "i")).collect()}
    assert found == {"a": "007", "b": "2024", "c": None}
    assert lookup.read_index(spark, str(tmp_path / "i"), domain="law").count() == 0


def test_stream_usage_drops_late_rows(spark, tmp_path):
    calls = "ts timestamp, provider string, error string, prompt_tokens bigint, completion_tokens bigint, cost double, latency double"
    def drop(n, *times):
        rows = [(t, "p", None, 1, 2, 0.5, 1.0) for t in times]
        spark.createDataFrame(rows, calls.replace("ts timestamp", "ts string")).withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.parquet(str(tmp_path / "in" / str(n)))
    def run():
        stream = spark.readStream.schema(calls).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        usage.write_hourly_usage(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    drop(1, "2024-01-01 10:05:00", "2024-01-01 10:55:00", "2024-01-01 11:30:00")
    run()
    drop(2, "2024-01-01 10:06:00", "2024-01-01 13:00:00")
    run()
    rows = sorted((str(r["window_start"]), r["total_requests"], r["total_cost"]) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert rows == [("2024-01-01 10:00:00", 2, 1.0), ("2024-01-01 11:00:00", 1, 0.5)]


def _samples(spark, n=12):
    rows = [(f"s{i}", f"Explain topic number {i} " * 3, (f"Because of {i}. " * 5, "r", "f"), ("a" if i % 2 else "b", i / n)) for i in range(n)]
    return spark.createDataFrame(rows, "id string, instruction string, response struct<origin_text:string,rationale:string,final_answer:string>, metadata struct<domain:string,difficulty:double>")


def test_plans(spark):
    seeds = _samples(spark)
    plan = generation.random_plan(seeds, 25, 10).collect()
    assert len(plan) == 30
    for b in range(3):
        assert len({r["seed_id"] for r in plan if r["batch"] == b}) == 10
    assert generation.random_plan(seeds.limit(4), 25, 10).count() == 12
    assert generation.random_plan(seeds.where("id = 'none'"), 25, 10).count() == 0
    assert generation.round_robin_plan(seeds.where("id = 'none'"), 5).count() == 0
    counts = [r["count"] for r in generation.round_robin_plan(seeds, 30).groupBy("seed_id").count().collect()]
    assert sorted(counts) == [2] * 6 + [3] * 6


def test_full_run_with_generation(spark, tmp_path):
    def copy(prompt: str) -> str:
        if "number 3" in prompt:
            raise RuntimeError("no")
        return prompt[prompt.index("Instruction:"):prompt.rindex("\n\nGenerate")]

    run = stages.Curation(
        spark, str(tmp_path / "out"), "r1", seed=stages.seed_stage,
        assess=lambda df: stages.assessment_stage(df, methods=("code_execution",)),
        select=lambda df: stages.filtering_stage(df, 8, 0.0, gate={"thresholds": {}, "rationale_threshold": 0.0, "answer_threshold": 0.0}),
        generate=lambda df: stages.generation_stage(df, copy, 20, plan="round_robin"), include_seed=True,
    )
    final = run.run(_samples(spark).selectExpr("id", "instruction", "response", """named_struct('domain', metadata.domain, 'difficulty', metadata.difficulty, 'source', 'x',
        'creation_timestamp', cast(null as timestamp), 'seed_id', cast(null as string), 'initial_quality', cast(null as double), 'extra', cast(null as map<string,string>)) as metadata"""))
    assert final.count() == 8
    assert run.counts["seed"][0] == 12 and run.counts["generated"][0] == 19 and run.counts["assessed"][0] == 31
    lines = spark.read.text(str(tmp_path / "out" / "final")).collect()
    assert len(lines) == 8 and "overall_score" in lines[0][0]
    summary = spark.read.json(str(tmp_path / "out" / "summary")).first()
    assert summary["stages"]["filtered"]["count"] == 8
    with pytest.raises(ValueError):
        run.run_stage("advanced_assessment", final)
    with pytest.raises(ValueError):
        run.run_stage("nothing", final)
    with pytest.raises(ValueError):
        run.run_stage("quality_assessment", None)


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
