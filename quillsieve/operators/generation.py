"""Generation as tables: a request plan, prompts, responses, parsed samples.

No model is called here. The request table goes to a user function or an outside
batch system; its response table comes back and is parsed and filtered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.chat import build_messages, choose_template, parse_pair, render_prompt
from quillsieve.functions.keys import hash60
from quillsieve.operators.normalize import with_seed_lineage
from quillsieve.operators.ranking import top_rows, with_ordinal
from quillsieve.operators.rules import initial_filter
from quillsieve.session import stage_counted


# Slots of one seed that are joined under one key.
SLOTS_PER_TASK = 100_000


def _by_ordinal(slots: DataFrame, ordered: DataFrame, size: int, count: int, slots_per_task: int) -> DataFrame:
    """Join slots to seeds on the ordinal. Slots per seed are even by construction; where few
    seeds have very many slots each, a seed is repeated under several keys, so that its
    slots are spread over as many tasks."""
    salts = max(1, -(-count // max(size * slots_per_task, 1)))
    salted = slots.withColumn("__salt", F.pmod(F.floor(F.col("slot") / max(size, 1)), F.lit(salts)))
    repeated = ordered.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return salted.join(repeated, ["ordinal", "__salt"]).drop("ordinal", "__salt")


def round_robin_plan(seeds: DataFrame, count: int, slots_per_task: int = SLOTS_PER_TASK) -> DataFrame:
    """Slot i uses seed ``i mod S``, with the seeds in the order of :func:`with_ordinal`."""
    ordered, size = stage_counted(with_ordinal(seeds), "seed-order")
    slots = seeds.sparkSession.range(count if size else 0).select(
        F.col("id").alias("slot"), F.pmod(F.col("id"), F.lit(max(size, 1))).alias("ordinal")
    )
    return _by_ordinal(slots, ordered.withColumnRenamed("id", "seed_id"), size, count, slots_per_task)


def random_plan(seeds: DataFrame, target: int, batch_size: int = 10, seed: str = "0", slots_per_task: int = SLOTS_PER_TASK) -> DataFrame:
    """Batches of ``batch_size`` different seeds (all seeds if there are fewer) until the
    target is reached.

    A random offset per batch selects a run of consecutive seeds in hash order, so a
    batch never repeats a seed and the plan is one equi-join, not batches times seeds.
    """
    ordered, size = stage_counted(with_ordinal(seeds), "seed-order")
    batches = -(-target // batch_size) if size else 0
    per_batch = max(min(batch_size, size), 1)
    start = F.pmod(hash60(F.lit(seed), F.col("batch")), F.lit(max(size, 1)))
    slots = seeds.sparkSession.range(batches * per_batch).select(
        F.col("id").alias("slot"),
        F.floor(F.col("id") / per_batch).alias("batch"), F.pmod(F.col("id"), F.lit(per_batch)).alias("place"),
    ).withColumn("ordinal", F.pmod(start + F.col("place"), F.lit(max(size, 1))))
    return _by_ordinal(slots.drop("place"), ordered.withColumnRenamed("id", "seed_id"), size, batches * per_batch, slots_per_task)


def requests(
    plan: DataFrame,
    templates: dict[str, str] | None = None,
    system: str | None = None,
    prefix: str = "request",
) -> DataFrame:
    """Request table (request_id, seed_id, template, prompt, messages) of a plan that
    carries the seed's instruction, response and metadata."""
    domain = F.coalesce(F.col("metadata.domain"), F.lit("general"))
    difficulty = F.coalesce(F.col("metadata.difficulty"), F.lit(0.5))
    name = choose_template(domain, difficulty)
    prompt = render_prompt(name, {
        "instruction": F.col("instruction"), "response": F.col("response.origin_text"),
        "domain": domain, "difficulty": difficulty,
    }, templates)
    return plan.select(
        F.concat(F.lit(prefix + "_"), F.col("slot").cast("string")).alias("request_id"), "seed_id",
        name.alias("template"), prompt.alias("prompt"),
    ).withColumn("messages", build_messages(F.col("prompt"), F.lit(system).cast("string")))


Generate = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]

RESPONSE_SCHEMA = (
    "request_id string, seed_id string, raw string, error string, model string, latency double, "
    "prompt_tokens bigint, completion_tokens bigint"
)


def run_generator(request_table: DataFrame, generate: Callable[[str], str], model: str = "user") -> DataFrame:
    """Run a user function prompt -> text over the request table, partition by
    partition. An exception becomes the row's ``error``; the job goes on."""
    def respond(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw, errors = [], []
            for prompt in batch["prompt"]:
                try:
                    raw.append(generate(prompt))
                    errors.append(None)
                except Exception as problem:  # the row records it
                    raw.append(None)
                    errors.append(str(problem))
            yield pd.DataFrame({
                "request_id": batch["request_id"], "seed_id": batch["seed_id"], "raw": raw, "error": errors,
                "model": model, "latency": float("nan"), "prompt_tokens": pd.NA, "completion_tokens": pd.NA,
            }).astype({"prompt_tokens": "Int64", "completion_tokens": "Int64"})

    return request_table.select("request_id", "seed_id", "prompt").mapInPandas(respond, RESPONSE_SCHEMA)


def parse_responses(responses: DataFrame, seeds: DataFrame, model: str, created: str, text: Column | None = None) -> DataFrame:
    """Samples from the text of a response table, with lineage. Rows with an error are
    left out; a text without both markers gives empty strings and fails the filter."""
    pair = parse_pair(F.col("raw") if text is None else text)
    parsed = responses.where(F.col("error").isNull()).withColumn("__pair", pair).select(
        F.col("request_id").alias("id"), "seed_id", F.col("__pair.instruction").alias("instruction"),
        F.struct(*[F.col("__pair.response").alias(f) for f in ("origin_text", "rationale", "final_answer")]).alias("response"),
    )
    return with_seed_lineage(parsed, seeds, model, created)


def ingest_responses(
    responses: DataFrame,
    seeds: DataFrame,
    model: str,
    created: str,
    target: int | None = None,
    limits: dict | None = None,
) -> DataFrame:
    """Parse, filter and, with a target, keep that many rows in hash order."""
    kept = initial_filter(parse_responses(responses, seeds, model, created), **(limits or {}))
    return kept if target is None else top_rows(kept, target, -hash60(F.col("id")))
