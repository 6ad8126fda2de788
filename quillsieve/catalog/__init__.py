"""Queries over the given tables, each with its SQL twin."""

from __future__ import annotations

import importlib

from quillsieve.catalog.registry import ORACLES, QUERIES

_MODULES = ("tables", "rows", "gating", "aggregates", "selecting", "generating", "judging", "streams")


def load() -> tuple[dict, dict]:
    """(queries, SQL) of all catalog modules."""
    for module in _MODULES:
        importlib.import_module(f"quillsieve.catalog.{module}")
    return dict(QUERIES), dict(ORACLES)
