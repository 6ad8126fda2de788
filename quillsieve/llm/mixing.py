"""Mix sources to target weights by capped water-filling; DataFrame operations only.

Sources are ranked by code point, null last, and weigh 1, 2, 3, repeating (or as given).
The total is shared by weight; a source stops at ``max_epochs`` times its size and its
excess is shared again until none is above. In closed form: with the sources in order of
size / weight, those up to some rank stand at their cap and the rest share what is left.

A source's repetitions are a whole number for every document and one more for some: a
seeded order of its documents is followed until the words still wanted are reached, to
within half a document. The order is found in two steps, sizes of 4,096 hash cells and
then the documents of one cell, so a source with a third of all rows stays spread out.

Null and empty texts have size 0. Rows of a source that are equal in id and size have one
place in the order and are taken alike; no row is taken more than ``max_epochs`` times. An
empty table gives an empty mix; a source of size 0 has target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.session import lookup_join, stage, stage_counted

MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
CELLS = 4_096
SEED = "mix"
_WORD = r"[^\x20\x09-\x0D]+"
_KEYS = ("key", "none")


def words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("bigint")


def draw(seed: str, *parts: Column) -> Column:
    """A whole number below 2**32 from a hash of the parts."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), *parts)), 1, 8), 16, 10).cast("bigint")


def _named(source: str | Column) -> list[Column]:
    """The source as a key that is never null, and whether it was."""
    column = F.col(source) if isinstance(source, str) else source
    return [F.coalesce(column, F.lit("")).alias(_KEYS[0]), column.isNull().alias(_KEYS[1])]


def _working(doc_id: Column, text: Column, source: Column, seed: str) -> list[Column]:
    return [*_named(source), doc_id.alias("id"), source.alias("source"), words(text).alias("size"), draw(seed, doc_id.cast("string")).alias("draw")]


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    return docs.select(*_working(F.col(id_col), F.col(text_col), F.col(source_col), seed))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, target) of each source, from (source, source_size), one row
    per source."""
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weight.cast("bigint")).withColumn("cap", F.col("source_size") * max_epochs)
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy(F.lit(0))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    summed = ranked.select(
        "*", F.sum("source_size").over(every).alias("total"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("capped"),
        (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("open"),
        F.row_number().over(by_cap).alias("place"),
    )
    # a source is free if its share of what the smaller ones leave is no more than its cap
    free = F.col("weight") * (F.col("total") - F.col("capped")) <= F.col("cap") * F.col("open")
    first = F.min(F.when(free, F.struct("place", "total", "capped", "open"))).over(every)
    shared = summed.withColumn("first", first)
    at_cap = F.col("first.place").isNull() | (F.col("place") < F.col("first.place"))
    share = F.col("weight").cast("double") * (F.col("first.total") - F.col("first.capped")).cast("double") / F.col("first.open").cast("double")
    return shared.select("source", "source_size", F.when(at_cap, F.col("cap").cast("double")).otherwise(share).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """(id, source, size, source_size, target, copies, taken) of every row."""
    return plan(stage(_sized(docs, id_col, text_col, source_col, seed).drop(*_KEYS), "mix-sizes"), weights, max_epochs)


def cuts(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """A row for each source of a staged (id, source, size, draw): its size and target, the
    repetitions that all its documents get, and the last document in the seeded order that
    gets one more (``cut``, as draw, id and size)."""
    shift = 32 - CELLS.bit_length() + 1
    cell = F.shiftright("draw", shift).alias("cell")
    cells = stage(sized.groupBy(*_KEYS, "source", cell).agg(F.sum("size").alias("cell_size")), "mix-cells")
    sources = targets(cells.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    wanted, n = stage_counted(sources.withColumn("whole", whole).select(
        *_named("source"), "source_size", "target", "whole",
        (F.col("target") - (F.col("whole") * F.col("source_size")).cast("double")).alias("room")), "mix-sources")
    # the cell in which the room of a source is used up
    run = Window.partitionBy(*_KEYS).orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lookup_join(cells.withColumn("upto", F.sum("cell_size").over(run)), wanted, list(_KEYS), "inner", bound=n)
    used_up = placed.where(F.col("upto").cast("double") > F.col("room")).groupBy(*_KEYS).agg(
        F.min(F.struct("cell", (F.col("upto") - F.col("cell_size")).alias("before"))).alias("there")).select(*_KEYS, "there.*")
    bounded = stage(lookup_join(wanted, used_up, list(_KEYS), "left", bound=n).withColumn("cell", F.coalesce("cell", F.lit(CELLS))), "mix-cells-cut")
    # inside that cell documents are taken one by one while their middle lies within the room
    inside = Window.partitionBy(*_KEYS).orderBy("draw", "id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = lookup_join(sized.withColumn("cell", cell), bounded.select(*_KEYS, "cell", "before", "room"), [*_KEYS, "cell"], "inner", bound=n)
    taken = inner.withColumn("upto", F.col("before") + F.sum("size").over(inside)).where((2 * F.col("upto") - F.col("size")).cast("double") <= 2 * F.col("room"))
    last = taken.groupBy(*_KEYS).agg(F.max(F.struct("draw", "id", "size")).alias("last"))
    kind = sized.schema["id"].dataType
    below = F.struct(
        (F.shiftleft(F.col("cell").cast("bigint"), shift) - 1).alias("draw"), F.lit(None).cast(kind).alias("id"), F.lit(None).cast("bigint").alias("size"))
    # documents of a source at its limit get no more
    nothing = F.struct(F.lit(-1).cast("bigint").alias("draw"), F.lit(None).cast(kind).alias("id"), F.lit(None).cast("bigint").alias("size"))
    cut = F.when(F.col("whole") >= max_epochs, nothing).otherwise(F.coalesce("last", below))
    return stage(lookup_join(bounded, last, list(_KEYS), "left", bound=n).select(*_KEYS, "source_size", "target", "whole", cut.alias("cut")), "mix-cuts")


def _copies() -> Column:
    return F.col("whole") + (F.struct("draw", "id", "size") <= F.col("cut")).cast("bigint")


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix of a staged table (id, source, size, draw)."""
    named = sized.select(*_named("source"), "*")
    joined = lookup_join(named, cuts(named, weights, max_epochs), list(_KEYS), "inner")
    return joined.withColumn("copies", _copies()).select("id", "source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mix itself: each row as many times as :func:`mix` takes it. A row's repetitions
    follow from its own id and size and from its source's cut, so texts are neither shuffled
    nor joined by id. Rows with the same id and size in one source are taken alike."""
    narrow = _sized(docs, id_col, text_col, source_col, seed)
    per_source = cuts(stage(narrow, "mix-sizes"), weights, max_epochs)
    row = docs.select(F.struct("*").alias("row"))  # no working column meets the caller's
    own = row.select("row", *_working(F.col("row")[id_col], F.col("row")[text_col], F.col("row")[source_col], seed))
    joined = lookup_join(own, per_source, list(_KEYS), "inner")
    times = joined.select("row", _copies().alias("copies")).where("copies > 0")
    return times.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("time")).select("row.*")
