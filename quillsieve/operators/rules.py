"""Validation of ingested records and the rule filter on generated samples.

Both add an array of reject reasons, so one pass gives the valid rows, the
quarantine and the counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.fixed_values import (
    CODE_CLAIM_WORDS,
    FILTER_MAX_LENGTH,
    FILTER_MIN_LENGTH,
    MIN_INSTRUCTION_LENGTH,
    MIN_RESPONSE_LENGTH,
)
from quillsieve.functions.text import (
    FENCE,
    banned,
    has_any,
    indented_lines,
    is_json_document,
    strip,
)

STRING = ("STRING",)
NUMBER = ("BIGINT", "DOUBLE", "DECIMAL", "FLOAT")
OBJECT = ("OBJECT",)

# (path, accepted types, required). A response may be a string or an object.
RECORD_RULES = (
    ("id", STRING, True),
    ("instruction", STRING, True),
    ("response", STRING + OBJECT, True),
    ("metadata", OBJECT, False),
    ("metadata.domain", STRING, False),
    ("metadata.difficulty", NUMBER + STRING, False),
    ("metadata.source", STRING, False),
    ("metadata.creation_timestamp", STRING, False),
)


def reasons(*pairs: tuple[str, Column]) -> Column:
    """Array with the names of the conditions that hold."""
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in pairs]))


def _kind(record: Column, path: str) -> Column:
    """Type name at a path of a VARIANT, without the parameters; null if absent."""
    full = F.schema_of_variant(F.try_variant_get(record, "$." + path, "variant"))
    return F.regexp_extract(full, "^([A-Z]+)", 1)


def schema_reasons(record: Column, rules: tuple = RECORD_RULES) -> Column:
    """Reasons against a VARIANT record: ``missing:path`` or ``type:path``. An explicit
    JSON null has the type VOID and so fails its type rule."""
    found = []
    for path, kinds, required in rules:
        kind = _kind(record, path)
        if required:
            found.append((f"missing:{path}", kind.isNull()))
        found.append((f"type:{path}", kind.isNotNull() & ~kind.isin(*kinds)))
    return reasons(*found)


def has_required_fields(record: Column) -> Column:
    """Id, instruction and response present; metadata, if present, an object."""
    present = [_kind(record, p).isNotNull() for p in ("id", "instruction", "response")]
    return present[0] & present[1] & present[2] & F.coalesce(_kind(record, "metadata") == "OBJECT", F.lit(True))


def content_reasons(
    instruction: Column,
    response: Column,
    domain: Column,
    difficulty: Column,
    has_metadata: Column,
    min_instruction: int = MIN_INSTRUCTION_LENGTH,
    min_response: int = MIN_RESPONSE_LENGTH,
    require_domain: bool = False,
) -> Column:
    """Reasons against the content: short texts after strip, instruction equal to
    response, missing domain (only where there is metadata), numeric difficulty
    outside [0, 1]."""
    instruction = strip(F.coalesce(instruction, F.lit("")))
    response = strip(F.coalesce(response, F.lit("")))
    checks = [
        ("short_instruction", F.length(instruction) < min_instruction),
        ("short_response", F.length(response) < min_response),
        ("identical", instruction == response),
        ("difficulty_range", (difficulty < 0) | (difficulty > 1)),
    ]
    if require_domain:
        checks.append(("no_domain", has_metadata & domain.isNull()))
    return reasons(*checks)


def split_valid(df: DataFrame, reason_column: str = "reject_reasons") -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine with reasons)."""
    valid = df.where(F.size(reason_column) == 0).drop(reason_column)
    return valid, df.where(F.size(reason_column) > 0)


def filter_reasons(
    instruction: Column,
    response: Column,
    min_length: int = FILTER_MIN_LENGTH,
    max_length: int = FILTER_MAX_LENGTH,
    banned_patterns: tuple[str, ...] = (),
) -> Column:
    """Reasons against a generated sample. Lengths are of the unstripped text."""
    missing = instruction.isNull() | response.isNull()
    claims_json = F.lower(instruction).contains("json") & strip(response).startswith("{")
    claims_code = has_any(instruction, CODE_CLAIM_WORDS)
    shows_code = response.contains(FENCE) | (indented_lines(response) >= 3)
    checks = [
        ("missing", missing),
        ("instruction_length", ~F.length(instruction).between(min_length, max_length)),
        ("response_length", ~F.length(response).between(min_length, max_length)),
        ("identical", strip(instruction) == strip(response)),
        ("bad_json", claims_json & ~is_json_document(response)),
        ("no_code", claims_code & ~shows_code),
    ]
    if banned_patterns:
        checks.append(("banned", banned(instruction, banned_patterns) | banned(response, banned_patterns)))
    return reasons(*checks)


def initial_filter(df: DataFrame, enabled: bool = True, **limits) -> DataFrame:
    """Keep the generated samples without a reject reason."""
    if not enabled:
        return df
    return df.where(F.size(filter_reasons(F.col("instruction"), F.col("response.origin_text"), **limits)) == 0)
