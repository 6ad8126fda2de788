"""The curation stages and the full run. A stage is a function DataFrame -> DataFrame."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.fixed_values import DIVERSITY_WEIGHT, TARGET_SIZE
from quillsieve.operators.advanced import ensemble_scores, filter_by_ensemble
from quillsieve.operators.generation import ingest_responses, random_plan, requests, round_robin_plan, run_generator
from quillsieve.operators.normalize import concat_samples, ensure_id, ensure_response
from quillsieve.operators.rules import content_reasons, split_valid
from quillsieve.operators.scoring import Scorer, aggregate_scores, score, text_scorers
from quillsieve.operators.selection import multi_dimension_filter
from quillsieve.operators.verify import METHODS, verify
from quillsieve.session import stage
from quillsieve.sources.writers import read_stage, to_record, write_jsonl, write_stage, write_summary

Stage = Callable[[DataFrame], DataFrame]


def seed_stage(df: DataFrame, **rules) -> DataFrame:
    """Canonical response, content rules, ids."""
    canonical = ensure_response(df)
    checked = canonical.withColumn("reject_reasons", content_reasons(
        F.col("instruction"), F.col("response.origin_text"), F.col("metadata.domain"),
        F.col("metadata.difficulty"), F.col("metadata").isNotNull(), **rules,
    ))
    return ensure_id(split_valid(checked)[0])


def generation_stage(
    seeds: DataFrame,
    generate: Callable[[str], str],
    target: int,
    model: str = "user",
    created: str = "1970-01-01T00:00:00Z",
    batch_size: int = 10,
    plan: str = "random",
    limits: dict | None = None,
    templates: dict[str, str] | None = None,
) -> DataFrame:
    """Plan, prompts, user generator, parse, filter, cut to the target. A model call is
    expensive, so its responses are staged before anything reads them twice."""
    slots = random_plan(seeds, target, batch_size) if plan == "random" else round_robin_plan(seeds, target)
    responses = stage(run_generator(requests(slots, templates), generate, model), "responses")
    return ingest_responses(responses, seeds, model, created, target, limits)


def assessment_stage(
    df: DataFrame,
    scorers: dict[str, Scorer] | None = None,
    methods: tuple[str, ...] = METHODS,
    weights: dict[str, float] | None = None,
    thresholds: dict[str, float] | None = None,
    evaluated_at: str | None = None,
) -> DataFrame:
    """Metric scores, verification, aggregation: one projection without a shuffle."""
    scored = score(df, scorers or text_scorers())
    return aggregate_scores(verify(scored, methods), weights, thresholds, evaluated_at=evaluated_at)


def filtering_stage(df: DataFrame, target: int = TARGET_SIZE, quality_threshold: float = 0.7,
                    diversity_weight: float = DIVERSITY_WEIGHT, **options) -> DataFrame:
    return multi_dimension_filter(df, target, quality_threshold, diversity_weight, **options)


def advanced_stage(df: DataFrame, scores: DataFrame, target: int = 800, weights: dict[str, float] | None = None) -> DataFrame:
    return filter_by_ensemble(ensemble_scores(df, scores, weights), target)


@dataclass
class Curation:
    """A full run. Stages set to None are disabled; each result is written as a stage
    table of the run and the next stage reads that table."""

    spark: SparkSession
    output: str
    run_id: str
    seed: Stage
    assess: Stage
    select: Stage
    generate: Stage | None = None
    advanced: Stage | None = None
    include_seed: bool = False
    counts: dict[str, tuple[int, str]] = field(default_factory=dict)

    def stages(self) -> dict[str, Stage | None]:
        return {
            "seed_db": self.seed, "data_generation": self.generate, "quality_assessment": self.assess,
            "data_filtering": self.select, "advanced_assessment": self.advanced,
        }

    def run_stage(self, name: str, data: DataFrame | None) -> DataFrame:
        """Run one stage by name; an unknown or disabled stage or missing input is an error."""
        known = self.stages()
        if name not in known:
            raise ValueError(f"unknown stage: {name}")
        if known[name] is None:
            raise ValueError(f"stage {name} is disabled")
        if data is None:
            raise ValueError(f"stage {name} needs input data")
        return known[name](data)

    def _keep(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.output}/{name}"
        self.counts[name] = (write_stage(df, path, self.run_id), path)
        return read_stage(self.spark, path, self.run_id)

    def run(self, raw: DataFrame) -> DataFrame:
        started = time.monotonic()
        data = self._keep("seed", self.run_stage("seed_db", raw))
        if self.generate:
            made = self._keep("generated", self.run_stage("data_generation", data))
            data = concat_samples(data, made) if self.include_seed else made
        data = self._keep("assessed", self.run_stage("quality_assessment", data))
        data = self._keep("filtered", self.run_stage("data_filtering", data))
        if self.advanced:
            data = self._keep("advanced", self.run_stage("advanced_assessment", data))
        write_jsonl(to_record(data), f"{self.output}/final")
        write_summary(self.spark, f"{self.output}/summary", self.counts, time.monotonic() - started)
        return data
