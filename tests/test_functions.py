"""Edge cases of the column functions."""

from __future__ import annotations

import json
import math

from pyspark.sql import functions as F

from quillsieve.functions import chat, keys, scales, text


def test_strip_removes_unicode_white_space(one):
    assert one(text.strip, ["　 a b\x1c\n", "\t", "x\xa0"]) == ["a b", "", "x"]


def test_json_document_is_strict(one):
    cases = ['{"a":1}', '{"a":1} x', '{"a":', '[1,2]', "3", '{"a":1},{"b":2}', "", None]
    assert one(text.is_json_document, cases) == [True, False, False, True, True, False, False, False]


def test_indented_lines(one):
    cases = ["    a\n\tb\n    c", "    a\n   b\nc", "x\n    \n    \n    "]
    assert one(text.indented_lines, cases) == [3, 1, 3]


def test_fenced_block(one):
    cases = ["a ```python\nx = 1\n``` b", "```x```", "none", "``` \n ```", "``````"]
    assert one(text.fenced_block, cases) == ["x = 1\n", "x", "", " \n ", ""]


def test_last_number(one):
    assert one(text.last_number, ["is 12.5 or 3", "", "-4", "7.", "v1.2.3"]) == [3.0, None, 4.0, 7.0, 3.0]


def test_fenced_json(one):
    cases = ['x ```json\n{"a": 1}\n``` y', '```{"a": 2}```', '{"a": 3}', '```json {"a": 4}']
    assert [json.loads(x) if x.startswith("{") else x for x in one(text.fenced_json, cases)] == [
        {"a": 1}, {"a": 2}, {"a": 3}, '```json {"a": 4}'
    ]


def test_distinct_word_ratio(one):
    assert one(text.distinct_word_ratio, ["a b a b", "", "  a\tb\n"]) == [0.5, 0.0, 1.0]


def test_difficulty_bucket_edges(one):
    values = [-0.1, 0.0, 0.2, 0.4, 0.7, 1.0, 1.5, None]
    found = one(scales.difficulty_bucket, values, "double")
    assert found == [0, 0, 1, 2, 3, 4, 4, None]
    assert [scales.bucket_of(v) for v in values[:-1]] == found[:-1]


def test_difficulty_bands(one):
    assert one(scales.difficulty_band, [0.39, 0.4, 0.7, 0.71, None], "double") == ["easy", "medium", "medium", "hard", "medium"]
    assert one(scales.report_band, [0.29, 0.3, 0.7, 0.71, None], "double") == ["easy", "medium", "medium", "hard", None]


def test_improvement(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 0.0), (0.0, -1.0), (0.5, 0.55), (32.0, 19.0)], "b double, a double")
    b, a = F.col("b"), F.col("a")
    rows = df.select(scales.improvement_percent(b, a).alias("p"), scales.improvement_text(b, a).alias("t")).collect()
    assert [round(r["p"], 6) for r in rows] == [math.inf, 0.0, 0.0, 10.0, -40.625]
    assert [r["t"] for r in rows] == ["1.0000 (+inf%)", "0.0000 (+0.00%)", "-1.0000 (+0.00%)", "0.0500 (+10.00%)", "-13.0000 (-40.62%)"]


def test_judge_scale(one):
    assert one(scales.judge_score, [1.0, 3.0, 5.0, 0.0, 6.0, None], "double") == [0.0, 0.5, 1.0, None, None, None]


def test_content_ids_are_repeatable(spark):
    df = spark.createDataFrame([("a", "b"), ("a", "b"), ("ab", "")], "i string, r string")
    ids = [r[0] for r in df.select(keys.content_id("s", F.col("i"), F.col("r"))).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_template_values_are_not_expanded_again(spark):
    df = spark.createDataFrame([("{response}", "R")], "i string, r string")
    prompt = chat.render("I: {instruction} R: {response} {other}", {"instruction": F.col("i"), "response": F.col("r")})
    assert df.select(prompt).first()[0] == "I: {response} R: R {other}"


def test_two_role_history(spark):
    def roles(*turns):
        df = spark.createDataFrame([([{"role": r, "content": c} for r, c in turns],)], "m array<struct<role:string,content:string>>")
        row = df.select(chat.two_role_history(F.col("m")).alias("h"), chat.leading_system(F.col("m")).alias("s")).first()
        return [(m["role"], m["content"]) for m in row["h"]], row["s"]

    assert roles(("system", "s"), ("user", "u"), ("assistant", "a")) == ([("user", "u"), ("model", "a")], "s")
    assert roles(("assistant", "a")) == ([("user", ""), ("model", "a")], None)
    assert roles(("system", "s")) == ([("user", "")], "s")
    assert roles(("user", "u"), ("system", "late"), ("critic", "x"), ("tool", "t")) == (
        [("user", "u"), ("user", "late"), ("function", "t")], None)


def test_function_arguments_and_text(one):
    call = json.dumps({"choices": [{"message": {"function_call": {"name": "f", "arguments": '{"a": 1}'}}}]})
    objects = json.dumps({"choices": [{"message": {"function_call": {"arguments": {"a": 2}}}}]})
    broken = json.dumps({"choices": [{"message": {"function_call": {"arguments": '{"a": '}, "content": '{"a": 3}'}}]})
    content = json.dumps({"choices": [{"message": {"content": '{"a": 4}'}}]})
    plain = json.dumps({"choices": [{"message": {"content": "hello"}}]})
    found = one(chat.function_arguments, [call, objects, broken, content, plain])
    assert [json.loads(x) if x else None for x in found] == [{"a": 1}, {"a": 2}, None, {"a": 4}, None]
    blocks = json.dumps({"content": [{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "b"}]})
    assert one(chat.response_text, [plain, blocks, "{}"]) == ["hello", "ab", ""]


def test_parse_pair_needs_both_markers(one):
    cases = ["Instruction: do it\nResponse: done Response: x", "Response: only", "Instruction: only", None]
    found = one(chat.parse_pair, cases)
    assert [(r["instruction"], r["response"]) for r in found] == [("do it", "done Response: x"), ("", ""), ("", ""), ("", "")]


def test_prompt_for_model(one):
    assert one(lambda m: chat.prompt_for_model(m, F.lit("p")), ["a/Llama-2", "Mistral", "llama/falcon", "x"]) == [
        "<s>[INST] p [/INST]", "<s>[INST] p [/INST]", "User: p\nAssistant:", "User: p\nAssistant:"]
