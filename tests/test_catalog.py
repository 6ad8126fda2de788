"""Every registered query equals its SQL twin on the smallest tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from quillsieve.catalog import load

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def _key(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    found = sorted(tuple(_key(r[c]) for c in columns) for r in df.collect())
    answer = duck.execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    expected = sorted(tuple(_key(r[names.index(c)]) for c in columns) for r in answer.fetchall())
    assert found == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
