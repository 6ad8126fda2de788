"""Exact top-k, order statistics and ordinals that never sort a whole table in one task.

A plain window over a few groups puts each group into one task, ``limit`` pulls its rows
through one task, and both carry every column along. Here only narrow rows (group, key,
id) are looked at, to find each group's cut, the last row that belongs to its top; the wide
rows are then filtered by the cuts, without a shuffle. All rows count and the result is exact.

A group of more than ``in_place`` rows is not ranked whole. A mergeable quantile sketch, one
pass over the narrow rows, brackets the cut between two of its values; if too many rows lie
between them, they are narrowed by counting 1024 equal cells of the key (map-side
combined). Ties on the key are narrowed the same way on a hash of the id.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.functions.keys import hash60
from quillsieve.session import stage, stage_counted

IN_PLACE_ROWS = 1_000_000
_CELLS = 1024
# Quantiles in the sketch of a large group, and its accuracy (ranks are right to one in this many rows).
_GRID = 256
_ACCURACY = 20_000
_LAST = 1e300  # key of a missing score; finite, so that cell widths stay finite
_G, _K, _T = "__group", "__key", "__tie"


@dataclass(frozen=True)
class _Span:
    """Rows of one group whose key lies in [lo, hi]; ``rank`` is 1-based inside it."""

    group: object
    slot: int
    rank: int
    rows: int
    lo: float
    hi: float


def _narrow(rows: DataFrame, key: str, kind: str, spans: list[_Span], stop_rows: int) -> list[_Span]:
    """Shrink each span around its rank until it has at most ``stop_rows`` rows or a
    single key value."""
    spark = rows.sparkSession
    group_type = rows.schema[_G].dataType.simpleString()
    done = [s for s in spans if s.rows <= stop_rows or s.lo == s.hi]
    open_ = [s for s in spans if s.rows > stop_rows and s.lo != s.hi]
    while open_:
        table = spark.createDataFrame(
            [(s.group, s.slot, s.lo, s.hi) for s in open_],
            f"{_G} {group_type}, slot int, lo {kind}, hi {kind}",
        )
        offset = (F.col(key) - F.col("lo")).cast("double") / (F.col("hi") - F.col("lo")).cast("double")
        cells = (
            rows.join(F.broadcast(table), _G)
            .where(F.col(key).between(F.col("lo"), F.col("hi")))
            .withColumn("cell", F.least(F.floor(offset * _CELLS), F.lit(_CELLS - 1)))
            .groupBy(_G, "slot", "cell")
            .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
            .collect()
        )
        by_span: dict = {}
        for c in cells:
            by_span.setdefault((c[_G], c["slot"]), []).append(c)
        still = []
        for s in open_:
            before = 0
            for c in sorted(by_span[(s.group, s.slot)], key=lambda c: c["cell"]):
                if before + c["n"] >= s.rank:
                    s = replace(s, rank=s.rank - before, rows=c["n"], lo=c["lo"], hi=c["hi"])
                    break
                before += c["n"]
            (done if s.rows <= stop_rows or s.lo == s.hi else still).append(s)
        open_ = still
    return done


def _bracketed(rows: DataFrame, key: str, spans: list[_Span], share_of: dict, grid: list[float]) -> list[_Span]:
    """Shrink spans of whole groups to what lies between two quantiles of a sketch around
    the wanted share. One pass makes the sketch, one counts; a span whose rank is not between
    its quantiles after all stays as it is."""
    spark = rows.sparkSession
    group_type = rows.schema[_G].dataType.simpleString()
    wanted = {s.group for s in spans}
    table = spark.createDataFrame([(g,) for g in wanted], f"{_G} {group_type}")
    own = rows.join(F.broadcast(table), _G)
    sketch = {
        r[_G]: r["q"]
        for r in own.groupBy(_G).agg(F.percentile_approx(key, F.array(*map(F.lit, grid)), F.lit(_ACCURACY)).alias("q")).collect()
    }
    edges = []
    for s in spans:
        at = min(range(len(grid)), key=lambda i: abs(grid[i] - share_of[s]))
        edges.append((s.group, s.slot, float(sketch[s.group][max(at - 2, 0)]), float(sketch[s.group][min(at + 2, len(grid) - 1)])))
    kind = rows.schema[key].dataType.simpleString()
    bounds = spark.createDataFrame(edges, f"{_G} {group_type}, slot int, lo {kind}, hi {kind}")
    counted = own.join(F.broadcast(bounds), _G).groupBy(_G, "slot", "lo", "hi").agg(
        F.count_if(F.col(key) < F.col("lo")).alias("below"), F.count_if(F.col(key) <= F.col("hi")).alias("upto"))
    found = {(r[_G], r["slot"]): r for r in counted.collect()}
    out = []
    for s in spans:
        r = found[(s.group, s.slot)]
        inside = r["below"] < s.rank <= r["upto"]
        out.append(replace(s, rank=s.rank - r["below"], rows=r["upto"] - r["below"], lo=r["lo"], hi=r["hi"]) if inside else s)
    return out


@dataclass(frozen=True)
class _Cut:
    """The last row of a group's top, and how many of the rows equal to it belong to the top;
    no key means that all rows do."""

    group: object
    key: float | None = None
    tie: int | None = None
    id: object = None
    equal: int = 0
    wanted: int = 0


def _cuts(rows: DataFrame, id_col: str, k: int | dict, in_place: int) -> list[_Cut]:
    """The cut of each group of narrow rows (group, key, id)."""
    spark = rows.sparkSession
    group_type = rows.schema[_G].dataType.simpleString()
    sizes = rows.groupBy(_G).agg(F.count(F.lit(1)).alias("n"), F.min(_K).alias("lo"), F.max(_K).alias("hi")).collect()
    wanted = {r[_G]: (k.get(r[_G], 0) if isinstance(k, dict) else k) for r in sizes}
    cuts = [_Cut(r[_G]) for r in sizes if wanted[r[_G]] >= r["n"]]
    spans = [_Span(r[_G], 0, wanted[r[_G]], r["n"], r["lo"], r["hi"]) for r in sizes if 0 < wanted[r[_G]] < r["n"]]
    if not spans:
        return cuts
    large = [s for s in spans if s.rows > in_place and s.lo != s.hi]
    if large:
        share_of = {s: s.rank / s.rows for s in large}
        bracketed = _bracketed(rows, _K, large, share_of, [i / _GRID for i in range(_GRID + 1)])
        spans = _narrow(rows, _K, "double", [s for s in spans if s not in share_of] + bracketed, in_place)
    tied = [s for s in spans if s.rows > in_place]
    ties: dict = {}
    tie = hash60(F.col(id_col)).alias(_T)
    if tied:
        table = spark.createDataFrame([(s.group, s.lo) for s in tied], f"{_G} {group_type}, lo double")
        tie_rows = rows.join(F.broadcast(table), _G).where(F.col(_K) == F.col("lo")).select(_G, tie)
        ranges = tie_rows.groupBy(_G).agg(F.min(_T).alias("lo"), F.max(_T).alias("hi")).collect()
        edge = {r[_G]: (r["lo"], r["hi"]) for r in ranges}
        ties = {t.group: t for t in _narrow(
            tie_rows, _T, "bigint", [_Span(s.group, 0, s.rank, s.rows, *edge[s.group]) for s in tied], in_place)}
    low, high = -(2**63), 2**63 - 1
    plan = [(s.group, s.lo, s.hi, *((t.lo, t.hi, t.rank) if (t := ties.get(s.group)) else (low, high, s.rank))) for s in spans]
    bounds = spark.createDataFrame(plan, f"{_G} {group_type}, __lo double, __hi double, __tlo bigint, __thi bigint, __r bigint")
    near = rows.join(F.broadcast(bounds), _G).where(F.col(_K).between(F.col("__lo"), F.col("__hi"))).withColumn(_T, tie).where(
        F.col(_T).between(F.col("__tlo"), F.col("__thi")))
    # equal rows are one, so that ids that repeat are counted and not ranked one by one
    alike = near.groupBy(_G, "__r", _K, _T, id_col).agg(F.count(F.lit(1)).alias("__n"))
    order = Window.partitionBy(_G).orderBy(_K, _T, id_col)
    upto = alike.withColumn("__upto", F.sum("__n").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = upto.where((F.col("__upto") >= F.col("__r")) & (F.col("__upto") - F.col("__n") < F.col("__r"))).collect()
    return cuts + [_Cut(r[_G], r[_K], r[_T], r[id_col], r["__n"], r["__r"] - (r["__upto"] - r["__n"])) for r in last]


def _key(score: Column) -> Column:
    """Smallest first: highest score, missing ones last."""
    return F.coalesce(F.nullif(-score.cast("double"), F.lit(float("nan"))), F.lit(_LAST))


def _above(df: DataFrame, cuts: list[_Cut], group: Column, key: Column, id_col: str) -> DataFrame:
    """The rows up to the cuts of their groups."""
    spark = df.sparkSession
    rows = df.withColumn(_G, group).withColumn(_K, key).withColumn(_T, hash60(F.col(id_col)))
    schema = f"{_G} {rows.schema[_G].dataType.simpleString()}, __key_cut double, __tie_cut bigint, __id_cut {rows.schema[id_col].dataType.simpleString()}"
    table = spark.createDataFrame([(c.group, c.key, c.tie, c.id) for c in cuts], schema)
    place = F.struct(F.col(_K).alias("k"), F.col(_T).alias("t"), F.col(id_col).alias("i"))
    cut = F.struct(F.col("__key_cut").alias("k"), F.col("__tie_cut").alias("t"), F.col("__id_cut").alias("i"))
    work = rows.join(F.broadcast(table), _G)
    whole = F.col("__key_cut").isNull()
    split = [c for c in cuts if c.key is not None and c.wanted < c.equal]
    if not split:
        return work.where(whole | (place <= cut)).select(df.columns)
    # some of the rows equal to a cut, which only ids that repeat can be
    part = F.broadcast(spark.createDataFrame([(c.group, c.wanted) for c in split], f"{_G} {rows.schema[_G].dataType.simpleString()}, __wanted bigint"))
    marked = work.join(part, _G, "left")
    at_cut = ~whole & (place == cut) & F.col("__wanted").isNotNull()
    some = marked.where(at_cut).withColumn("__rank", F.row_number().over(Window.partitionBy(_G).orderBy(F.lit(0)))).where("__rank <= __wanted")
    return marked.where((whole | (place <= cut)) & ~at_cut).select(df.columns).unionByName(some.select(df.columns))


def top_per_group(
    df: DataFrame,
    k: int | dict,
    score: Column,
    group: Column | None = None,
    id_col: str = "id",
    in_place: int = IN_PLACE_ROWS,
) -> DataFrame:
    """The ``k`` rows with the highest score of each group (all rows are one group if
    ``group`` is None). ``k`` may map group values to counts; a group without an entry
    gets none. Order: score descending (nulls last), then hash of the id, then id.
    Group values come to the driver, so the group column must be a category.

    ``df`` is read twice: for the narrow rows, which are staged, and for the filter.
    """
    group = F.lit(0) if group is None else group
    rows = stage(df.select(group.alias(_G), _key(score).alias(_K), F.col(id_col)), "rank-keys")
    cuts = _cuts(rows, id_col, k, in_place)
    return _above(df, cuts, group, _key(score), id_col) if cuts else df.limit(0)


def top_rows(df: DataFrame, n: int, score: Column, id_col: str = "id", report_rows: int = 10_000) -> DataFrame:
    """The ``n`` rows with the highest score. The cut of a short report comes from the best
    n narrow rows of each task; that of a longer one as in :func:`top_per_group`."""
    if n > report_rows:
        return top_per_group(df, n, score, id_col=id_col)
    if n < 1:
        return df.limit(0)
    best = df.select(F.lit(0).alias(_G), _key(score).alias(_K), hash60(F.col(id_col)).alias(_T), F.col(id_col)).orderBy(_K, _T, id_col).limit(n)
    names = best.groupBy(_K, _T, id_col).agg(F.count(F.lit(1)).alias("n"))
    last = names.orderBy(F.col(_K).desc(), F.col(_T).desc(), F.col(id_col).desc()).first()
    if last is None:
        return df.limit(0)
    # how many rows equal the last one is only asked for ids that repeat, by a count
    same = (_key(score) == F.lit(last[_K])) & F.col(id_col).eqNullSafe(F.lit(last[id_col]))
    equal = df.where(same).count()
    return _above(df, [_Cut(0, last[_K], last[_T], last[id_col], equal, last["n"])], F.lit(0), _key(score), id_col)


# Distinct values that come to the driver to find an order statistic among them.
_BRACKET_VALUES = 200_000


def exact_quantiles(
    df: DataFrame,
    value: Column,
    group: Column,
    probabilities: tuple[float, ...] = (0.5,),
    in_place: int = IN_PLACE_ROWS,
    sizes: dict | None = None,
    sketch: dict | None = None,
) -> dict:
    """Exact quantiles, linearly interpolated, as {group: [value, ...]}.

    One pass makes sizes and a sketch that brackets each order statistic (as
    :func:`bracket`), one counts the values in the brackets; a caller that has the
    sizes {group: (rows, min, max)} and brackets {group: [lo, hi, ...]} from an aggregate of its own
    leaves out the first. Where more than ``in_place`` rows lie in a bracket it is narrowed
    first. Nulls are ignored.
    """
    rows = df.select(group.alias(_G), value.cast("double").alias(_K)).where(F.col(_K).isNotNull())
    if sizes is None or sketch is None:
        seen = rows.groupBy(_G).agg(
            F.count(F.lit(1)).alias("n"), F.min(_K).alias("lo"), F.max(_K).alias("hi"), bracket(F.col(_K), probabilities).alias("q")
        ).collect()
        sizes, sketch = {r[_G]: (r["n"], r["lo"], r["hi"]) for r in seen}, {r[_G]: r["q"] for r in seen}
    if not sizes:
        return {}
    spark = df.sparkSession
    group_type = rows.schema[_G].dataType.simpleString()
    limits, spots = [], {}
    for g, (n, low, high) in sizes.items():
        for i, p in enumerate(probabilities):
            lo, hi = (low, high) if n <= _SMALL_ROWS else (sketch[g][2 * i], sketch[g][2 * i + 1])
            below = int(p * (n - 1))
            spots[(g, i)] = (below, p * (n - 1) - below, min(below + 1, n - 1))
            limits.append((g, i, float(lo), float(hi)))
    bounds = spark.createDataFrame(limits, f"{_G} {group_type}, slot int, lo double, hi double")
    placed = rows.join(F.broadcast(bounds), _G)
    inside = F.when(F.col(_K).between(F.col("lo"), F.col("hi")), F.col(_K))
    # one row for all values below a bracket, and one for each value in it
    counted = placed.where(F.col(_K) <= F.col("hi")).groupBy(_G, "slot", inside.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    if max(n for n, _, _ in sizes.values()) * 4 > _BRACKET_ACCURACY * in_place:
        counted, distinct = stage_counted(counted, "quantile-brackets")
        wide = distinct > _BRACKET_VALUES
    else:
        wide = False
    values: dict = {}
    if not wide:
        for r in counted.collect():
            values.setdefault((r[_G], r["slot"]), []).append((r["v"], r["n"]))
    spans, out = [], {g: [None] * len(probabilities) for g in sizes}
    for (g, i), (below, share, above) in spots.items():
        found = values.get((g, i), [])
        before = sum(n for v, n in found if v is None)
        ordered = sorted((v, n) for v, n in found if v is not None)
        pair = [_value_at(ordered, rank - before) for rank in (below, above)]
        if None in pair:  # too many values, or the sketch was too far off
            n, low, high = sizes[g]
            spans += [_Span(g, 2 * i, below + 1, n, low, high), _Span(g, 2 * i + 1, above + 1, n, low, high)]
        else:
            out[g][i] = pair[0] + (pair[1] - pair[0]) * share
    if spans:
        # stop_rows=0: go on until each span is a single value
        found = {(s.group, s.slot): s.lo for s in _narrow(rows, _K, "double", spans, 0)}
        for g, slot in found:
            if slot % 2 == 0:
                lo, hi = found[(g, slot)], found[(g, slot + 1)]
                out[g][slot // 2] = lo + (hi - lo) * spots[(g, slot // 2)][1]
    return out


# A group of so few rows needs no bracket; a bracket is right to one in this many rows.
_SMALL_ROWS = 2_000
_BRACKET_ACCURACY = 10_000


def bracket(value: Column, probabilities: tuple[float, ...] = (0.5,)) -> Column:
    """An aggregate: two values between which each quantile lies, from a mergeable sketch."""
    slack = 2 / _BRACKET_ACCURACY
    edges = [min(max(p + d, 0.0), 1.0) for p in probabilities for d in (-slack, slack)]
    return F.percentile_approx(value, F.array(*map(F.lit, edges)), F.lit(_BRACKET_ACCURACY))


def _value_at(ordered: list[tuple[float, int]], rank: int) -> float | None:
    """The value at a 0-based rank among counted values."""
    if rank < 0:
        return None
    for v, n in ordered:
        if rank < n:
            return v
        rank -= n
    return None


_ORDINAL_DIGITS = 4


def with_ordinal(df: DataFrame, id_col: str = "id", name: str = "ordinal") -> DataFrame:
    """Add the 0-based position of each row in the order (md5 of id, id).

    Rows are ranked inside 65,536 slices of the md5 (even by construction, for unique
    ids) and shifted by the number of rows in the slices before, so no task holds more
    than one slice and a repeated read gives the same ordinals.
    """
    digest, slice_ = "__md5", "__slice"
    rows = df.withColumn(digest, F.md5(F.col(id_col))).withColumn(
        slice_, F.substring(F.col(digest), 1, _ORDINAL_DIGITS)
    )
    counts = sorted((r[slice_], r["count"]) for r in rows.groupBy(slice_).count().collect())
    offsets, total = [], 0
    for key, n in counts:
        offsets.append((key, total))
        total += n
    shift = df.sparkSession.createDataFrame(offsets, f"{slice_} string, __before bigint")
    order = Window.partitionBy(slice_).orderBy(digest, id_col)
    return (
        rows.join(F.broadcast(shift), slice_)
        .withColumn(name, (F.col("__before") + F.row_number().over(order) - 1).cast("bigint"))
        .drop(digest, slice_, "__before")
    )


def latest_per_group(df: DataFrame, n: int, group: str, order: list[Column], salts: int = 64) -> DataFrame:
    """The first ``n`` rows of each group in ``order``, for a small fixed ``n``.

    Ranks inside salted parts of the group first (a hot group is spread over many
    tasks, and the rank limit is applied before the shuffle), then over at most
    ``n * salts`` survivors per group.
    """
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c != group]), F.lit(salts))
    first = Window.partitionBy(group, "__salt").orderBy(*order)
    last = Window.partitionBy(group).orderBy(*order)
    return (
        df.withColumn("__salt", salt)
        .withColumn("__r", F.row_number().over(first)).where(F.col("__r") <= n)
        .withColumn("__r", F.row_number().over(last)).where(F.col("__r") <= n)
        .drop("__salt", "__r")
    )
