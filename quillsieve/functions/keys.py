"""Deterministic ids, hashes and pseudo-random numbers.

All are hashes of row content, so a retried task or a second read gives the same
value; nothing depends on partition order or on a random seed of the session.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPAN = float(2**32)


def hash60(*parts: Column) -> Column:
    """The first 15 hex digits of the md5 of the ``:``-joined parts, as a bigint."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("bigint")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 8 hex digits of the md5 of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("double") / F.lit(_SPAN)


def content_id(prefix: str, instruction: Column, response: Column) -> Column:
    """``prefix_`` and 16 hex digits of the content hash."""
    digest = F.sha2(F.concat_ws("\x1f", instruction, response), 256)
    return F.concat(F.lit(prefix + "_"), F.substring(digest, 1, 16))
