"""Quotas by band and domain, ranking cuts and reports: brute force, and what the plans hold."""

from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from quillsieve.operators import ranking, selection, stats


def _plain_quotas(cells, target, shares, floor, balance):
    """Unit by unit: every cell has a unit for each of its rows."""
    bands = {b: sum(n for (c, _), n in cells.items() if c == b) for b in selection.BANDS}
    names = {d for (_, d), n in cells.items() if n}
    quota = selection.band_quotas(bands, target, shares)
    units = [(b, d, k, n) for (b, d), n in cells.items() for k in range(1, n + 1)]
    sure = set()
    for d in names:
        own = sorted((u for u in units if u[1] == d), key=lambda u: ((2 * u[2] - 1) / u[3], selection.BANDS.index(u[0])))
        sure.update(own[: min(floor, target // len(names))])
    held = {b: sum(u[0] == b for u in sure) for b in selection.BANDS}
    line = []
    for i, b in enumerate(selection.BANDS):
        rest = sorted((u for u in units if u[0] == b and u not in sure), key=lambda u: (u[2], u[1]))
        line += [(-(held[b] + r) / quota[b], -i, u) for r, u in enumerate(rest, 1) if held[b] + r <= quota[b]]
    line.sort(key=lambda x: x[:2])
    line = line[len(line) + len(sure) - min(target, len(units)):]
    taken = sure | {u for *_, u in line}
    count = {}
    for b, d, _, _ in taken if balance else sure:
        count[b, d] = count.get((b, d), 0) + 1
    rest = {} if balance else {b: n for b in selection.BANDS if (n := sum(u[0] == b for u in taken - sure))}
    return count, rest


@pytest.mark.parametrize("balance", [True, False])
def test_cell_quotas_equal_unit_by_unit(balance):
    draw = random.Random(5)
    shares = {"easy": 0.3, "medium": 0.5, "hard": 0.2}
    for _ in range(400):
        cells = {(b, d): draw.choice([0, 0, 1, 2, 5, 17, 40]) for b, d in itertools.product(selection.BANDS, "vwxyz"[: draw.randint(1, 5)])}
        total = sum(cells.values())
        if not total:
            continue
        target, floor = draw.randint(1, total), draw.choice([0, 1, 3, 9, 100])
        found = selection.cell_quotas(cells, target, shares, floor, balance)
        if target == total:
            assert found == ({c: n for c, n in cells.items() if n}, {})
            continue
        assert found == _plain_quotas(cells, target, shares, floor, balance)
        take, rest = found
        assert sum(take.values()) + sum(rest.values()) == target
        for d in {d for _, d in cells}:
            own = sum(n for (_, x), n in cells.items() if x == d)
            domains = len({x for (_, x), n in cells.items() if n})
            assert sum(n for (_, x), n in take.items() if x == d) >= min(own, floor, target // domains)


def test_quotas_of_a_large_table_are_quick():
    cells = {(b, f"d{i}"): 10**9 + i for b in selection.BANDS for i in range(50)}
    take, rest = selection.cell_quotas(cells, 10**7, None, 1_000, True)
    assert sum(take.values()) == 10**7 and not rest


@pytest.fixture(scope="module")
def wide(spark):
    draw = random.Random(9)
    rows = [(f"r{i % 2500}", draw.choice("abc"), draw.choice([0.5, draw.random(), None]), f"long text {i}") for i in range(3000)]
    return spark.createDataFrame(rows, "id string, grp string, score double, text string").repartition(4)


def _order(r):
    import hashlib

    score = r["score"]
    return (score is None, -(score or 0.0), int(hashlib.md5(r["id"].encode()).hexdigest()[:15], 16), r["id"])


@pytest.mark.parametrize("n", [1, 2, 50, 499, 2999, 5000])
@pytest.mark.parametrize("report_rows", [10_000, 0])
def test_top_rows_with_ids_that_repeat(wide, n, report_rows):
    found = ranking.top_rows(wide, n, F.col("score"), report_rows=report_rows).collect()
    best = sorted(wide.collect(), key=_order)[:n]
    assert sorted(map(_order, found)) == [_order(r) for r in best]


@pytest.mark.parametrize("in_place", [1_000_000, 7])
def test_top_per_group_with_ids_that_repeat(wide, in_place):
    wanted = {"a": 10, "b": 10_000}
    found = ranking.top_per_group(wide, wanted, F.col("score"), F.col("grp"), in_place=in_place).collect()
    every = wide.collect()
    for g in "abc":
        best = sorted((r for r in every if r["grp"] == g), key=_order)[: wanted.get(g, 0)]
        assert sorted(_order(r) for r in found if r["grp"] == g) == [_order(r) for r in best]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [100, 1_500])
def test_wide_rows_are_only_filtered(wide, n):
    """The plan over the texts has no top-k, no window and no shuffle."""
    for found in (ranking.top_rows(wide.dropDuplicates(["id"]), n, F.col("score"), report_rows=1_000), ):
        for word in ("TakeOrdered", "Window"):
            assert word not in _plan(found)
    unique = wide.where("text < 'long text 2'")
    found = ranking.top_per_group(unique, n, F.col("score"), F.col("grp"))
    assert "TakeOrdered" not in _plan(found) and "Window" not in _plan(found)


@pytest.mark.parametrize("small, values", [(2_000, 200_000), (0, 200_000), (0, 0)])
def test_quantiles_by_brackets(wide, monkeypatch, small, values):
    monkeypatch.setattr(ranking, "_SMALL_ROWS", small)
    monkeypatch.setattr(ranking, "_BRACKET_VALUES", values)
    if not values:
        monkeypatch.setattr(ranking, "_BRACKET_ACCURACY", 10)
    found = ranking.exact_quantiles(wide, F.col("score"), F.col("grp"), (0.0, 0.25, 0.5, 1.0), in_place=1_000_000 if values else 10)
    for g in "abc":
        own = sorted(r["score"] for r in wide.collect() if r["grp"] == g and r["score"] is not None)
        for p, q in zip((0.0, 0.25, 0.5, 1.0), found[g], strict=True):
            place = p * (len(own) - 1)
            low, high = own[int(place)], own[min(int(place) + 1, len(own) - 1)]
            assert q == pytest.approx(low + (high - low) * (place - int(place)), abs=1e-12)


def _reads(spark, folder, run):
    """Rows that a function has read from a table, as a multiple of the table."""
    table = spark.read.parquet(str(folder))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    run(table.mapInArrow(count, table.schema))
    return seen.value / table.count()


def test_statistics_take_two_scans(spark, wide, tmp_path):
    wide.write.parquet(f"{tmp_path}/t")
    values = {"score": F.col("score"), "size": F.length("text")}
    assert _reads(spark, f"{tmp_path}/t", lambda df: stats.basic_statistics(df, values).collect()) == 2
    metadata = F.struct(F.col("grp").alias("domain"), F.col("score").alias("difficulty"))
    assert _reads(spark, f"{tmp_path}/t", lambda df: stats.index_statistics(df.withColumn("metadata", metadata)).collect()) == 1


def test_reports_take_two_scans(spark, wide, tmp_path):
    from quillsieve.operators import reports

    wide.write.parquet(f"{tmp_path}/t")

    def row(df):
        return df.select(
            "id", F.struct(F.col("grp").alias("domain"), F.col("score").alias("difficulty")).alias("metadata"),
            F.create_map(F.lit("overall_score"), F.col("score")).alias("evaluations"), F.struct((F.col("score") > 0.5).alias("verified")).alias("verification"),
            F.struct((F.col("score") > 0.5).alias("selected")).alias("filtering"),
            F.struct(*[F.col("score").alias(n) for n in ("ifd_score", "limr_score", "less_score", "ensemble_score", "loss_reduction", "accuracy_improvement")],
                     (F.col("score") > 0.9).alias("final_selected")).alias("advanced"),
            F.when(F.col("score") > 0.5, F.array()).otherwise(F.array(F.lit("x"))).alias("reject_reasons"))

    for report, scans in ((reports.generation_report, 1), (reports.assessment_report, 2), (reports.filtering_report, 2), (reports.advanced_report, 2)):
        assert _reads(spark, f"{tmp_path}/t", lambda df, report=report: report(row(df)).collect()) == scans, report.__name__
