"""Training rows and the train/validation split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.functions.keys import uniform

STRATEGIES = ("full", "rationale", "answer", "mixed")


def training_output(strategy: str = "full") -> Column:
    r = F.col("response")
    outputs = {
        "full": r["origin_text"], "rationale": r["rationale"], "answer": r["final_answer"],
        "mixed": F.concat_ws("\n\n", r["rationale"], r["final_answer"]),
    }
    if strategy not in outputs:
        raise ValueError(f"unknown strategy: {strategy}")
    return outputs[strategy]


def training_rows(df: DataFrame, strategy: str = "full") -> DataFrame:
    """Columns id, instruction, input (empty) and output."""
    return df.select("id", "instruction", F.lit("").alias("input"), training_output(strategy).alias("output"))


def with_split(df: DataFrame, validation_share: float = 0.1, seed: str = "0") -> DataFrame:
    """Add ``split``: validation or train by a hash of the id, so a row keeps its side."""
    return df.withColumn(
        "split", F.when(uniform(F.lit(seed), F.col("id")) < validation_share, "validation").otherwise("train")
    )
