"""Readers of sample files: JSONL, JSON, CSV/TSV, templates, latest file.

The raw zone keeps each record as a VARIANT with its file; rules run on it before it
becomes the typed sample row.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.fixed_values import TEMPLATES
from quillsieve.functions.binding import let
from quillsieve.functions.text import json_document, strip
from quillsieve.model import RESPONSE
from quillsieve.operators.normalize import response_from_text
from quillsieve.session import lookup_join

EXTENSIONS = {"jsonl": "*.jsonl", "json": "*.json", "csv": "*.csv", "tsv": "*.tsv"}


def pattern_for(fmt: str) -> str:
    """File pattern of a format; an unknown format means JSONL."""
    return EXTENSIONS.get(fmt, EXTENSIONS["jsonl"])


def _finder(spark: SparkSession, pattern: str):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below a folder (path, bytes, modified); contents are not read."""
    return _finder(spark, pattern).format("binaryFile").load(path).select(
        "path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")
    )


def latest_file(spark: SparkSession, path: str, pattern: str = "*") -> str | None:
    """Path of the most recently modified file, None without files."""
    newest = list_files(spark, path, pattern).agg(F.max(F.struct("modified", "path")).alias("f")).first()["f"]
    return newest["path"] if newest else None


def read_jsonl(spark: SparkSession, path: str, pattern: str = "*.jsonl", mode: str = "row") -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines). Records are (record VARIANT, line, file).

    ``mode="row"`` drops malformed lines only; ``mode="file"`` drops every record of a
    file with a malformed line. Blank lines are skipped.
    """
    lines = _finder(spark, pattern).text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file")
    ).where(strip(F.col("line")) != "")
    parsed = lines.withColumn("record", json_document(F.col("line")))
    bad = parsed.where(F.col("record").isNull()).select("line", "file")
    good = parsed.where(F.col("record").isNotNull()).select("record", "line", "file")
    if mode == "file":
        good = lookup_join(good, bad.select("file").distinct(), ["file"], "left_anti")
    elif mode != "row":
        raise ValueError(f"unknown mode: {mode}")
    return good, bad


def read_json(spark: SparkSession, path: str, pattern: str = "*.json") -> tuple[DataFrame, DataFrame]:
    """(records, files that are not usable). A list gives one record per element, an
    object with a list under ``data`` the elements of that list, any other object one
    record; other documents are not usable. A document is read by one task, so this
    is for many files of moderate size; large data belongs in JSONL."""
    docs = _finder(spark, pattern).text(path, wholetext=True).select(
        json_document(F.col("value")).alias("doc"), F.col("_metadata.file_path").alias("file")
    )
    return explode_documents(docs)


def explode_documents(docs: DataFrame, column: str = "doc") -> tuple[DataFrame, DataFrame]:
    """(records, rows that are not usable) of a column of VARIANT documents; the other
    columns are kept."""
    kept = [c for c in docs.columns if c != column]

    def elements(doc: Column) -> Column:
        kind = F.coalesce(F.schema_of_variant(doc), F.lit("VOID"))
        data = F.try_variant_get(doc, "$.data", "variant")
        data_kind = F.coalesce(F.schema_of_variant(data), F.lit("VOID"))
        return (
            F.when(kind.startswith("ARRAY"), F.try_variant_get(doc, "$", "array<variant>"))
            .when(kind.startswith("OBJECT") & data_kind.startswith("ARRAY"), F.try_variant_get(doc, "$.data", "array<variant>"))
            .when(kind.startswith("OBJECT"), F.array(doc))
        )

    split = docs.select(*kept, let(F.col(column), elements).alias("__elements"))
    # explode_outer and a filter behind it: a plain explode, or a filter in front of it,
    # would parse each document again
    good = split.select(F.explode_outer("__elements").alias("record"), *kept).where(F.col("record").isNotNull())
    return good, split.where(F.col("__elements").isNull()).select(*kept)


def read_csv(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None,
    pattern: str | None = None, multiline: bool = False,
) -> DataFrame:
    """Flat rows of CSV or TSV files with a header. Without a schema the columns are
    named by the header and read as strings (typed later with ``try_cast``), which
    needs no inference pass over the data. Files are split; where quoted fields span lines,
    pass ``multiline=True``, which keeps a file in one task (``writers.write_flat`` bounds its rows)."""
    reader = _finder(spark, pattern or pattern_for(fmt)).option("header", "true").option("sep", "\t" if fmt == "tsv" else ",")
    reader = reader.option("quote", '"').option("escape", '"').option("multiLine", str(multiline).lower())
    return reader.schema(schema).csv(path) if schema else reader.csv(path)


def read_samples(spark: SparkSession, path: str, fmt: str = "jsonl") -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of JSONL or JSON by format name."""
    if fmt in ("csv", "tsv"):
        raise ValueError("CSV and TSV rows are flat: use read_csv with nest_flat")
    if fmt == "json":
        return read_json(spark, path)
    return read_jsonl(spark, path, pattern_for(fmt))


def record_to_sample(record: Column) -> list[Column]:
    """Columns id, instruction, response and metadata of a VARIANT record. Fields of an
    unexpected type become null; unknown metadata keys go to ``extra``."""
    def text(path: str) -> Column:
        value = F.try_variant_get(record, path, "variant")
        return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(record, path, "string"))

    def number(path: str) -> Column:
        return F.try_variant_get(record, path, "string").try_cast("double")

    response = F.try_variant_get(record, "$.response", "variant")
    struct = F.from_json(F.to_json(response), RESPONSE)
    typed = ["domain", "difficulty", "source", "creation_timestamp", "seed_id", "initial_quality"]
    every = F.from_json(F.to_json(F.try_variant_get(record, "$.metadata", "variant")), "map<string,string>")
    metadata = F.struct(
        text("$.metadata.domain").alias("domain"), number("$.metadata.difficulty").alias("difficulty"),
        text("$.metadata.source").alias("source"),
        text("$.metadata.creation_timestamp").try_cast("timestamp").alias("creation_timestamp"),
        text("$.metadata.seed_id").alias("seed_id"), number("$.metadata.initial_quality").alias("initial_quality"),
        F.map_filter(every, lambda k, _: ~k.isin(typed)).alias("extra"),
    )
    is_object = F.schema_of_variant(response).startswith("OBJECT")
    return [
        text("$.id").alias("id"), text("$.instruction").alias("instruction"),
        F.when(is_object, struct).otherwise(response_from_text(text("$.response"))).alias("response"),
        metadata.alias("metadata"),
    ]


def read_templates(spark: SparkSession, path: str | None = None) -> dict[str, str]:
    """Prompt templates by file name: the ``template`` key of JSON and YAML files, the whole
    text of txt files. Without any, the built-in ones. Templates are configuration (a handful of files), so they are returned to
    the driver, which compiles them into the prompt expression."""
    if path is None:
        return dict(TEMPLATES)
    files = _finder(spark, "*.{json,yaml,yml,txt}").text(path, wholetext=True).select(
        F.regexp_extract("_metadata.file_path", r"([^/]+)\.([A-Za-z]+)$", 1).alias("name"),
        F.lower(F.regexp_extract("_metadata.file_path", r"([^/]+)\.([A-Za-z]+)$", 2)).alias("kind"), "value",
    )
    found = parse_templates(files)
    return {"basic_generation": TEMPLATES["basic_generation"], **found} if found else dict(TEMPLATES)


def parse_templates(files: DataFrame) -> dict[str, str]:
    """Templates of files given as (name, kind, value). A file that cannot be parsed, is no
    object or has no text under ``template`` is left out."""
    found = {}
    for name, kind, value in files.select("name", "kind", "value").collect():
        if kind == "txt":
            found[name] = value
            continue
        try:
            parsed = json.loads(value) if kind == "json" else _yaml(value)
        except ValueError:
            continue
        if isinstance(parsed, dict) and isinstance(parsed.get("template"), str):
            found[name] = parsed["template"]
    return found


def _yaml(value: str):
    """A YAML document; the parser is only needed for such files."""
    try:
        import yaml
    except ImportError as missing:
        raise RuntimeError("reading YAML templates needs PyYAML") from missing
    try:
        return yaml.safe_load(value)
    except yaml.YAMLError as broken:
        raise ValueError(str(broken)) from broken
