"""Costs of model calls from a price table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.fixed_values import PRICES
from quillsieve.functions.scales import usage_cost
from quillsieve.session import lookup_join


def price_table(spark: SparkSession) -> DataFrame:
    """The built-in prices (model, unit, prompt_price, completion_price)."""
    return spark.createDataFrame(list(PRICES), "model string, unit string, prompt_price double, completion_price double")


def with_cost(calls: DataFrame, prices: DataFrame, default_model: str | None = None, name: str = "call_cost") -> DataFrame:
    """Add the cost of each call from ``model``, ``prompt_tokens`` and ``completion_tokens``
    (units of the price: tokens, or characters). A model without a price costs what
    ``default_model`` does, or nothing if there is no default or it has no price either.
    Prices have one row per model; they are broadcast as far as their count allows."""
    kept = calls.columns
    told = lookup_join(calls.withColumnRenamed("model", "__model"), prices.select(F.col("model").alias("__model"), F.struct("unit", "prompt_price", "completion_price").alias("__price")), ["__model"])
    price = F.col("__price")
    other = None if default_model is None else prices.where(F.col("model") == default_model).first()
    if other is not None:
        price = F.coalesce(price, F.struct(
            F.lit(other["unit"]).alias("unit"), F.lit(other["prompt_price"]).alias("prompt_price"), F.lit(other["completion_price"]).alias("completion_price")))
    cost = usage_cost(price["unit"], price["prompt_price"], price["completion_price"], F.col("prompt_tokens"), F.col("completion_tokens"))
    return told.withColumn(name, cost).withColumnRenamed("__model", "model").select(*kept, name)
