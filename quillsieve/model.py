"""Schemas of the sample table.

One row is one sample. ``evaluations`` holds the metric scores; an absent key is
not the same as zero, so it is a map rather than a struct of doubles.
"""

from __future__ import annotations

from pyspark.sql import types as T

RESPONSE = T.StructType([
    T.StructField("origin_text", T.StringType()),
    T.StructField("rationale", T.StringType()),
    T.StructField("final_answer", T.StringType()),
])

METADATA = T.StructType([
    T.StructField("domain", T.StringType()),
    T.StructField("difficulty", T.DoubleType()),
    T.StructField("source", T.StringType()),
    T.StructField("creation_timestamp", T.TimestampType()),
    T.StructField("seed_id", T.StringType()),
    T.StructField("initial_quality", T.DoubleType()),
    T.StructField("extra", T.MapType(T.StringType(), T.StringType())),
])

SAMPLE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("instruction", T.StringType()),
    T.StructField("response", RESPONSE),
    T.StructField("metadata", METADATA),
])

EVALUATIONS = T.MapType(T.StringType(), T.DoubleType())

MESSAGES = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
]))
