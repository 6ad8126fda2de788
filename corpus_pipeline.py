"""Documents to training records: stages that each call one of the corpus operators.

The stages, in their order: documents that score as toxic go; of near-duplicates one stays;
documents with a passage of the benchmark go; each source's documents are repeated or left
out to meet its target weight (a document that is taken twice is two rows); what is left
is tokenized, written as binary records and reported from them.

Every stage reads what its predecessor kept, written as Parquet below the shared folder. A
stage fails on nothing that its operator takes: nulls, empty and long texts, repeated rows,
an empty table and further columns are as its docstring says.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillsieve.llm import decontaminate, mixing, records, simhash_dedup, toxicity
from quillsieve.llm.common import table
from quillsieve.llm.queries import tokenizer_path
from quillsieve.session import stage_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject; learnt from the labels of the
    documents at hand."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_dedup.drop_near_duplicates(docs, size=4, distance=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs, weights=(1, 2, 3), max_epochs=3)


def write_token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return records.token_table(docs, tokenizer_path(), end_id=2).withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", keep_one_of_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_records", write_token_records),
]

# Tokenizing and learnt scores are beyond SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        path = stage_path(spark, f"pipeline-{name}")
        out = function(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
