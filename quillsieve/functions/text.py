"""Text functions: strip, words, keyword flags, fenced blocks, numbers, JSON checks."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillsieve.fixed_values import WHITESPACE
from quillsieve.functions.binding import let

FENCE = "```"


def strip(text: Column) -> Column:
    """Remove Unicode white space at both ends (plain ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def words(text: Column) -> Column:
    """Words of the whole text, split at ASCII white space, as an array."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def char_length(text: Column) -> Column:
    """Length in code points; missing text has length 0."""
    return F.coalesce(F.length(text), F.lit(0))


def sentence_count(text: Column) -> Column:
    """Number of runs of sentence-ending punctuation."""
    return F.regexp_count(text, F.lit(r"[.!?]+"))


def distinct_word_ratio(text: Column) -> Column:
    """Distinct words over words; 0 for text without words."""
    return let(
        words(text),
        lambda w: F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w)).otherwise(F.lit(0.0)),
    )


def has_any(text: Column, keywords: Iterable[str]) -> Column:
    """True if the lower-cased text contains one of the keywords as a substring."""
    return F.lower(text).rlike("|".join(re.escape(k) for k in keywords))


def normalized(text: Column) -> Column:
    """Lower-cased text with white-space runs collapsed, for duplicate checks."""
    return F.btrim(F.regexp_replace(F.lower(text), r"\s+", " "), F.lit(" "))


def fenced_block(text: Column) -> Column:
    """Text between the first two fences; a first line (language tag) is dropped
    when the block has a newline and is not blank. Empty if there is no fence."""
    body = F.get(F.split(text, FENCE, -1), 1)
    tagged = (F.instr(body, "\n") > 0) & (strip(body) != "")
    untagged = F.when(tagged, F.substring(body, F.instr(body, "\n") + 1, F.length(body))).otherwise(body)
    return F.coalesce(untagged, F.lit(""))


def last_number(text: Column) -> Column:
    """Last unsigned decimal number of the text, null if there is none."""
    numbers = F.regexp_extract_all(text, F.lit(r"([0-9]+\.?[0-9]*)"), F.lit(1))
    return F.try_element_at(numbers, F.lit(-1)).try_cast("double")


def json_document(text: Column) -> Column:
    """The whole text as one JSON value (VARIANT), null if it is anything else.

    ``try_parse_json`` stops after the first value and accepts trailing text, so the
    text is wrapped in an array with a sentinel behind it, which must parse as the
    second and last element. The text is parsed once.
    """
    def whole(v: Column) -> Column:
        sentinel = F.try_variant_get(v, "$[1]", "bigint")
        beyond = F.try_variant_get(v, "$[2]", "variant")
        return F.when((sentinel == 7331) & beyond.isNull(), F.try_variant_get(v, "$[0]", "variant"))

    return let(F.try_parse_json(F.concat(F.lit("["), text, F.lit(",7331]"))), whole)


def is_json_document(text: Column) -> Column:
    """True if the whole text is one JSON value."""
    return json_document(text).isNotNull()


def indented_lines(text: Column) -> Column:
    """Number of lines that start with four spaces or a tab."""
    return F.regexp_count(text, F.lit(r"(?:^|\n)(?:    |\t)"))


def fenced_json(text: Column) -> Column:
    """The JSON part of model output: the body of a json fence, else of the first
    fence, else the whole text."""
    after_json = F.get(F.split(text, "```json", 2), 1)
    after_any = F.get(F.split(text, FENCE, 2), 1)
    body = (
        F.when(F.instr(after_json, FENCE) > 0, strip(F.substring_index(after_json, FENCE, 1)))
        .when(F.instr(after_any, FENCE) > 0, strip(F.substring_index(after_any, FENCE, 1)))
    )
    return F.coalesce(F.when(body != "", body), text)


def banned(text: Column, patterns: Iterable[str]) -> Column:
    """True if any pattern is found, ignoring case."""
    hit = F.lit(False)
    for pattern in patterns:
        hit = hit | text.rlike(f"(?i){pattern}")
    return hit
