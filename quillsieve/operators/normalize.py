"""Bring raw samples into the typed sample table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import WHITESPACE
from quillsieve.functions.keys import content_id
from quillsieve.functions.text import is_json_document, strip
from quillsieve.model import RESPONSE
from quillsieve.session import lookup_join

_TYPED = ("domain", "difficulty", "source", "creation_timestamp", "seed_id", "initial_quality")


def response_from_text(text: Column, split: str = "copy") -> Column:
    """Response struct of a plain string. ``copy`` repeats the text in all three
    fields; ``last_line`` takes the last non-empty line as the final answer and the
    text before it as the rationale."""
    if split == "copy":
        rationale = answer = text
    elif split == "last_line":
        body = F.rtrim(text, F.lit(WHITESPACE))
        last = F.substring_index(body, "\n", -1)
        answer = strip(last)
        rationale = F.rtrim(F.left(body, F.length(body) - F.length(last)), F.lit(WHITESPACE))
    else:
        raise ValueError(f"unknown split: {split}")
    return F.when(
        text.isNotNull(),
        F.struct(text.alias("origin_text"), rationale.alias("rationale"), answer.alias("final_answer")),
    )


def response_from_any(text: Column, split: str = "copy") -> Column:
    """Response struct of a string that may itself be a JSON object with the three
    fields; any other string is treated as plain text."""
    is_object = strip(text).startswith("{") & is_json_document(text)
    parsed = F.from_json(F.when(is_object, text), RESPONSE)
    has_fields = F.coalesce(
        parsed["origin_text"], parsed["rationale"], parsed["final_answer"]
    ).isNotNull()
    return F.when(has_fields, parsed).otherwise(response_from_text(text, split))


def ensure_response(df: DataFrame, column: str = "response", split: str = "copy") -> DataFrame:
    """Canonical response struct whether the column is a string or already a struct."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "string":
        return df.withColumn(column, response_from_any(F.col(column), split))
    if kind.startswith("variant"):
        as_text = F.try_variant_get(F.col(column), "$", "string")
        from_object = F.from_json(F.to_json(F.col(column)), RESPONSE)
        is_object = F.schema_of_variant(F.col(column)).startswith("OBJECT")
        return df.withColumn(column, F.when(is_object, from_object).otherwise(response_from_text(as_text, split)))
    return df


def nest_flat(df: DataFrame, split: str = "copy") -> DataFrame:
    """Flat columns (as from CSV) to the sample shape. Missing typed columns become
    null, other columns go to ``metadata.extra``; a difficulty that is not a number
    becomes null."""
    fixed = {"id", "instruction", "response", *_TYPED}
    null = F.lit(None).cast("string")
    have = set(df.columns)

    def typed(name: str, kind: str) -> Column:
        source = F.col(name) if name in have else null
        return source.try_cast(kind).alias(name)

    others = [c for c in df.columns if c not in fixed]
    pairs = [x for c in others for x in (F.lit(c), F.col(c).cast("string"))]
    extra = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.lit(None).cast(
        "map<string,string>"
    )
    metadata = F.struct(
        typed("domain", "string"), typed("difficulty", "double"), typed("source", "string"),
        typed("creation_timestamp", "timestamp"), typed("seed_id", "string"),
        typed("initial_quality", "double"), extra.alias("extra"),
    )
    flat = df.select(
        typed("id", "string"), typed("instruction", "string"),
        (F.col("response") if "response" in have else null).alias("response"), metadata.alias("metadata"),
    )
    return ensure_response(flat, split=split)


def merge_maps(old: Column, new: Column) -> Column:
    """Shallow merge of two maps; keys of ``new`` win. Null counts as empty."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    old, new = F.coalesce(old, empty), F.coalesce(new, empty)
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def merge_metadata(metadata: Column, updates: dict[str, Column], extra: Column | None = None) -> Column:
    """Metadata with typed fields replaced and open keys merged, the new values winning."""
    for name, value in updates.items():
        metadata = metadata.withField(name, value)
    if extra is not None:
        metadata = metadata.withField("extra", merge_maps(metadata["extra"], extra))
    return metadata


def ensure_id(df: DataFrame, prefix: str = "sample") -> DataFrame:
    """Fill a missing or empty id from the content, the same on every run."""
    made = content_id(prefix, F.col("instruction"), F.col("response.origin_text"))
    return df.withColumn("id", F.coalesce(F.nullif(F.col("id"), F.lit("")), made))


def last_per_id(df: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """One row per id, the last in ``order``. An aggregate, so copies of one id are
    reduced before the shuffle and a heavily repeated id does not fill one task."""
    rest = [c for c in df.columns if c != id_col]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(id_col).agg(newest).select(id_col, "__row.*").select(df.columns)


def path_category(df: DataFrame, path: str) -> Column:
    """Value at a dotted path as a string; null, or a path the schema does not have,
    is ``unknown``."""
    node = df.schema
    for part in path.split("."):
        if node.typeName() == "map":
            break
        if node.typeName() != "struct" or part not in node.fieldNames():
            return F.lit("unknown")
        node = node[part].dataType
    return F.coalesce(F.col(path).cast("string"), F.lit("unknown"))


def with_seed_lineage(responses: DataFrame, seeds: DataFrame, model: str, created: str) -> DataFrame:
    """Metadata of generated rows: seed id, the seed's domain and difficulty (defaults
    ``unknown`` and 0.5), source and the run's time stamp. ``responses`` has ``seed_id``."""
    origin = seeds.select(
        F.col("id").alias("seed_id"), F.col("metadata.domain").alias("__domain"),
        F.col("metadata.difficulty").alias("__difficulty"),
    )
    metadata = F.struct(
        F.coalesce("__domain", F.lit("unknown")).alias("domain"),
        F.coalesce("__difficulty", F.lit(0.5)).alias("difficulty"),
        F.lit(f"{model} generated").alias("source"),
        F.lit(created).cast("timestamp").alias("creation_timestamp"),
        F.coalesce(F.col("seed_id"), F.lit("unknown")).alias("seed_id"),
        F.lit(None).cast("double").alias("initial_quality"),
        F.lit(None).cast("map<string,string>").alias("extra"),
    )
    joined = lookup_join(responses, origin, ["seed_id"])
    return joined.select(*[c for c in responses.columns if c != "seed_id"], metadata.alias("metadata"))


def concat_samples(seed: DataFrame, generated: DataFrame) -> DataFrame:
    """Bag union by column name; columns one side lacks become null."""
    return seed.unionByName(generated, allowMissingColumns=True)
