"""Diversity scores: rarity of a category, and rarity of a number under a kernel density.

The density at every row is a sum over all other rows. Rows are reduced to cells of a
quarter bandwidth, each holding the first 13 moments of its values; a cell receives
the combined Taylor expansion of the 36 cells on either side (a kernel at nine
bandwidths is 2.6e-18), and a row evaluates the polynomial of its own cell. This is the
fast Gauss transform: one map-side combined aggregate over the rows, a fixed 73-fold
expansion of the cells, no pairs of values. It agrees with the direct sum to about
1e-10 of the number of rows.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillsieve.fixed_values import DIVERSITY_WEIGHTS
from quillsieve.operators.gates import metric
from quillsieve.session import lookup_join, stage_counted

_ORDER = 12
_WIDTH = 0.25
_REACH = 36


def categorical_diversity(df: DataFrame, category: Column, name: str) -> DataFrame:
    """Add ``1 - count(category)/rows``. Counts are combined before the shuffle; the
    table of counts is joined back as a checked lookup, so a dominant category does
    not gather its rows in one task."""
    key = "__category"
    rows = df.withColumn(key, F.coalesce(category.cast("string"), F.lit("unknown")))
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = rows.count()
    joined = lookup_join(rows, counts, [key])
    return joined.withColumn(name, 1.0 - F.col("__n") / F.lit(float(max(total, 1)))).drop(key, "__n")


def _hermite_table() -> Column:
    """Array of 73 structs: cell offset q and He_k(d) exp(-d^2/2) for d = q/4."""
    table = []
    for q in range(-_REACH, _REACH + 1):
        d = q * _WIDTH
        h = [1.0, d]
        for k in range(1, _ORDER):
            h.append(d * h[k] - k * h[k - 1])
        table.append({"q": q, "a": [x * math.exp(-d * d / 2) for x in h]})
    return F.from_json(F.lit(json.dumps(table)), "array<struct<q:bigint,a:array<double>>>")


def _cell(value: Column, bandwidth: float) -> Column:
    return F.floor(value / F.lit(bandwidth * _WIDTH)).cast("bigint")


def _offset(value: Column, cell: Column, bandwidth: float) -> Column:
    """Distance of the value from its cell's centre, in bandwidths."""
    return value / F.lit(bandwidth) - (cell + F.lit(0.5)) * F.lit(_WIDTH)


def kernel_cells(values: DataFrame, bandwidths: dict[str, float]) -> DataFrame:
    """Expansion coefficients ``l0..l12`` per column and occupied cell, for all numeric
    columns in one pass: rows (name, cell, l0..l12)."""
    entries = []
    for name, h in bandwidths.items():
        cell = _cell(F.col(name), h)
        entries.append(F.struct(F.lit(name).alias("name"), cell.alias("cell"), _offset(F.col(name), cell, h).alias("u")))
    cells = values.select(F.inline(F.array(*entries)))
    power, moments = F.lit(1.0), []
    for i in range(_ORDER + 1):
        moments.append((F.sum(power) / math.factorial(i)).alias(f"m{i}"))
        power = power * F.col("u")
    sources = cells.groupBy("name", "cell").agg(*moments).select(
        "name", "cell", F.array(*[f"m{i}" for i in range(_ORDER + 1)]).alias("m")
    )
    spread = sources.withColumn("k", F.explode(_hermite_table())).withColumn("target", F.col("cell") + F.col("k.q"))
    signs = F.array(*[F.lit((-1.0) ** j / math.factorial(j)) for j in range(_ORDER + 1)])

    def coefficient(sign: Column, j: Column) -> Column:
        length = F.lit(_ORDER + 1) - j
        products = F.zip_with(F.slice("k.a", j + 1, length), F.slice("m", F.lit(1), length), lambda x, y: x * y)
        return sign * F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    terms = spread.select("name", "target", (F.col("k.q") == 0).alias("own"), F.transform(signs, coefficient).alias("t"))
    sums = [F.sum(F.get("t", j)).alias(f"l{j}") for j in range(_ORDER + 1)]
    grouped = terms.groupBy("name", F.col("target").alias("cell")).agg(*sums, F.max("own").alias("occupied"))
    return grouped.where("occupied").drop("occupied")


def _density(value: Column, cell: Column, bandwidth: float, prefix: str = "") -> Column:
    u = _offset(value, cell, bandwidth)
    total = F.col(f"{prefix}l{_ORDER}")
    for j in range(_ORDER - 1, -1, -1):
        total = total * u + F.col(f"{prefix}l{j}")
    return total


def numeric_diversity(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add ``1 - density/max density`` for each named numeric expression: a Gaussian
    kernel with bandwidth ``n^(-1/5) * sample std``. One row gives 0.5, equal values
    give 0. The expressions must not be null."""
    if not columns:
        return df
    names = list(columns)
    for i, name in enumerate(names):
        df = df.withColumn(f"__v{i}", columns[name].cast("double"))
    facts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.stddev_samp(f"__v{i}").alias(f"s{i}") for i in range(len(names))]
    ).first()
    n = facts["n"]
    widths = {}
    for i in range(len(names)):
        s = facts[f"s{i}"] if n > 1 else None
        if s and s > 0:
            widths[i] = s * n ** (-0.2)
    if widths:
        table, rows = stage_counted(kernel_cells(df, {f"__v{i}": h for i, h in widths.items()}), "cells")
    for i, h in widths.items():
        cells = table.where(F.col("name") == f"__v{i}").select(
            F.col("cell").alias(f"__c{i}"), *[F.col(f"l{j}").alias(f"__{i}l{j}") for j in range(_ORDER + 1)]
        )
        df = lookup_join(df.withColumn(f"__c{i}", _cell(F.col(f"__v{i}"), h)), cells, [f"__c{i}"], bound=rows)
    density = {i: _density(F.col(f"__v{i}"), F.col(f"__c{i}"), h, f"__{i}") for i, h in widths.items()}
    peaks = df.agg(*[F.max(d).alias(f"p{i}") for i, d in density.items()]).first() if density else None
    for i, name in enumerate(names):
        if i in density:
            score = F.greatest(F.lit(0.0), 1.0 - density[i] / F.lit(peaks[f"p{i}"]))
        else:
            score = F.lit(0.5 if n <= 1 else 0.0)
        df = df.withColumn(name, score)
    return df.drop(*[c for c in df.columns if c.startswith("__") and c[2:3].isdigit() or c[:3] in ("__v", "__c")])


def sample_features() -> dict[str, Column]:
    """Feature expressions of the default dimensions."""
    return {
        "domain": F.coalesce(F.col("metadata.domain"), F.lit("unknown")),
        "difficulty": metric("instruction_complexity", 0.5),
        "content": F.coalesce(F.length("instruction"), F.lit(0)),
    }


def diversity_scores(
    df: DataFrame,
    features: dict[str, Column] | None = None,
    weights: dict[str, float] | None = None,
) -> DataFrame:
    """Add one ``diversity_<dimension>`` column per feature and their weighted mean
    ``diversity_score``. Strings are categories, numbers use the density. Rows with an
    empty id are left out. Only dimensions with a weight count; without any it is 0."""
    features = sample_features() if features is None else features
    weights = DIVERSITY_WEIGHTS if weights is None else weights
    df = df.where(F.coalesce(F.col("id"), F.lit("")) != "")
    numeric = {}
    for name, feature in features.items():
        kind = df.select(feature.alias("x")).schema["x"].dataType
        if isinstance(kind, T.NumericType):
            numeric[f"diversity_{name}"] = feature
        else:
            df = categorical_diversity(df, feature, f"diversity_{name}")
    df = numeric_diversity(df, numeric)
    used = {n: w for n, w in weights.items() if n in features}
    total = sum(used.values())
    score = F.lit(0.0)
    if total > 0:
        for name, w in used.items():
            score = score + F.col(f"diversity_{name}") * F.lit(w / total)
    return df.withColumn("diversity_score", score)
