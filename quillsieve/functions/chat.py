"""Prompts, message arrays and parsing of model responses."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.fixed_values import ROLE_NAMES, TEMPLATES
from quillsieve.functions.text import fenced_json, is_json_document, strip

_FIELD = re.compile(r"\{(instruction|response|domain|difficulty)\}")


def choose_template(domain: Column, difficulty: Column) -> Column:
    """Template name for a seed; missing domain is general, missing difficulty 0.5."""
    domain = F.coalesce(domain, F.lit("general"))
    difficulty = F.coalesce(difficulty, F.lit(0.5))
    return (
        F.when(difficulty > 0.7, "complex_reasoning")
        .when(domain != "general", "domain_specific")
        .otherwise("basic_generation")
    )


def render(template: str, values: dict[str, Column]) -> Column:
    """One template as a concatenation of literals and columns. The template is cut
    up front, so braces inside the values are never expanded again."""
    parts = []
    for i, piece in enumerate(_FIELD.split(template)):
        if i % 2:
            parts.append(F.coalesce(values[piece].cast("string"), F.lit("")))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def render_prompt(name: Column, values: dict[str, Column], templates: dict[str, str] | None = None) -> Column:
    """Render the template called ``name``; an unknown name uses the basic template."""
    templates = templates or TEMPLATES
    prompt = None
    for key, text in templates.items():
        branch = name == key
        prompt = F.when(branch, render(text, values)) if prompt is None else prompt.when(branch, render(text, values))
    return prompt.otherwise(render(templates["basic_generation"], values))


def build_messages(user: Column, system: Column) -> Column:
    """System message (if not null or empty) and then the user message."""
    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array_compact(F.array(F.when(system != "", message("system", system)), message("user", user)))


def system_prompt(override: Column, template: Column, templates: dict[str, str]) -> Column:
    """The system prompt of a request: the override unless it is null (an empty one means none),
    else the template of that name; an unknown name gives none."""
    named = F.lit(None).cast("string")
    for name, text in templates.items():
        named = F.when(template == name, F.lit(text)).otherwise(named)
    return F.coalesce(override, named)


def leading_system(messages: Column) -> Column:
    """Content of the first message when it is a system message, else null."""
    first = F.get(messages, 0)
    return F.when(first["role"] == "system", first["content"])


def two_role_history(messages: Column) -> Column:
    """History in the two-role format: leading system message removed, roles mapped,
    unknown roles dropped, and an empty user turn put in front when the history is
    empty or starts with the model."""
    is_system = F.coalesce(F.get(messages, 0)["role"] == "system", F.lit(False))
    rest = F.when(is_system, F.slice(messages, 2, F.greatest(F.size(messages), F.lit(1)))).otherwise(messages)
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    known = F.filter(rest, lambda m: m["role"].isin(*ROLE_NAMES))
    mapped = F.transform(known, lambda m: F.struct(names[m["role"]].alias("role"), m["content"].alias("content")))
    empty_turn = F.array(F.struct(F.lit("user").alias("role"), F.lit("").alias("content")))
    starts_with_model = F.coalesce(F.get(mapped, 0)["role"] == "model", F.lit(True))
    return F.when(starts_with_model, F.concat(empty_turn, mapped)).otherwise(mapped)


def flatten_messages(messages: Column) -> Column:
    """Message contents joined by newlines."""
    return F.array_join(F.transform(messages, lambda m: m["content"]), "\n")


def prompt_for_model(model: Column, prompt: Column) -> Column:
    """Single prompt in the form the model family expects."""
    name = F.lower(F.substring_index(model, "/", -1))
    return F.when(
        name.contains("llama") | name.contains("mistral"),
        F.concat(F.lit("<s>[INST] "), prompt, F.lit(" [/INST]")),
    ).otherwise(F.concat(F.lit("User: "), prompt, F.lit("\nAssistant:")))


def response_text(raw: Column) -> Column:
    """Text of a raw response document: content of the first choice, else the joined
    text blocks, else empty."""
    choice = F.get_json_object(raw, "$.choices[0].message.content")
    blocks = F.from_json(F.get_json_object(raw, "$.content"), "array<struct<type:string,text:string>>")
    texts = F.transform(F.filter(blocks, lambda b: b["type"] == "text"), lambda b: F.coalesce(b["text"], F.lit("")))
    return F.coalesce(choice, F.array_join(texts, ""), F.lit(""))


def structured_json(text: Column) -> Column:
    """JSON text in model output (fenced or plain), null if it does not parse."""
    body = fenced_json(text)
    return F.when(is_json_document(body), body)


def function_arguments(raw: Column) -> Column:
    """Function-call arguments of a raw response as JSON text: the arguments string
    or object, else a message content that is itself a JSON object. Null if none
    parses."""
    arguments = F.get_json_object(raw, "$.choices[0].message.function_call.arguments")
    content = F.get_json_object(raw, "$.choices[0].message.content")
    as_object = F.when(is_json_document(content) & strip(content).startswith("{"), content)
    return F.when(arguments.isNotNull(), F.when(is_json_document(arguments), arguments)).otherwise(as_object)


def parse_pair(text: Column) -> Column:
    """Struct (instruction, response) of a text with both markers, else empty strings."""
    both = F.coalesce((F.instr(text, "Instruction:") > 0) & (F.instr(text, "Response:") > 0), F.lit(False))
    parts = F.split(text, "Response:", 2)
    instruction = strip(F.replace(F.get(parts, 0), F.lit("Instruction:"), F.lit("")))
    return F.struct(
        F.when(both, instruction).otherwise("").alias("instruction"),
        F.when(both, strip(F.get(parts, 1))).otherwise("").alias("response"),
    )
