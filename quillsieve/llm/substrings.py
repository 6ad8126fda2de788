"""Remove passages of ``length`` words that also start earlier, with an FM-index per shard.

Each window of ``length`` words is dealt to a shard by the smallest hash of its grams, strings
of fewer words; equal windows have the same, and neighbouring windows mostly share it, so
runs of windows move together. Runs whose gram occurs once leave. Of runs that are equal as
a whole the first stays and the others are passages that start earlier; where all runs of a
gram are equal that is all.

The runs that are left are streamed past the index of their shard: the backward search gives
each place the longest string that ends there and stands in the shard twice (matching
statistics, up to ``length``). Windows at the full length form an interval of the index with
their equals; all but the first of them are reported. A gram with more than ``group_rows`` different
runs is not gathered: its windows are grouped by an aggregation over two hashes of their words.

Words are told apart by 64-bit hashes, whole runs by the hash of their gram and another.

Rows are ordered by id, null first, then by a hash of the text. Rows that are equal in id and
text are one document and its copies: the copies start later, so all words of theirs in
windows go. Null, empty and short texts have no windows. A long text is hashed in pieces.
Ids of any orderable type are passed through, other columns are not read, and an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from quillsieve.llm.common import ranges, signed, slices, starts_of
from quillsieve.llm.fm_index import FMIndex
from quillsieve.session import stage, stage_counted

LENGTH = 20
GROUP_ROWS = 4_096
# Words of one index, and bytes or words of a text that are hashed at a time.
SHARD_WORDS = 400_000
PIECE = 1 << 19
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLACE_BITS = np.uint64(21)


@lru_cache(maxsize=4)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base modulo 2**64, and those of its inverse."""
    up, down = np.full(n, base, np.uint64), np.full(n, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(bytes([b]), 11) for b in range(256)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _span_hashes(values: np.ndarray, first: np.ndarray, end: np.ndarray, base: int = _BASES[0]) -> np.ndarray:
    """Hash of values[first:end] for each pair of places, equal for equal values wherever they stand."""
    up, down = _powers(base, max(2 * PIECE, 1 << len(values).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * down[: len(values)])))
    return _mixed((sums[end] - sums[first]) * up[first])


def word_places(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than ASCII white space."""
    inside = np.concatenate(([False], ~_SPACE[data], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word."""
    data = np.frombuffer(raw, np.uint8)
    start, end = word_places(data)
    out = []
    at = 0
    while at < len(start):
        stop = max(at + 1, int(np.searchsorted(end, start[at] + PIECE, "right")))
        origin = start[at]
        out.append(_span_hashes(_byte_values()[data[origin : end[stop - 1]]], start[at:stop] - origin, end[at:stop] - origin))
        at = stop
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def first_least(x: np.ndarray, width: int) -> np.ndarray:
    """Place of the least of each ``width`` values, the first of equals (by their upper bits)."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = (x >> _PLACE_BITS << _PLACE_BITS) | np.arange(len(x), dtype=np.uint64)
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[:n], ahead[width - 1 : width - 1 + n])
    return (least & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))).astype(np.int64)


def gram_words(length: int) -> int:
    return max(1, 2 * length // 5)


def runs(words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(digit, hash of all words, first window, windows) of the runs of windows with the same
    least gram. No window occurs twice in a run, as the gram would then stand elsewhere."""
    size = gram_words(length)
    place = np.arange(len(words) - size + 1)
    grams = _span_hashes(words, place, place + size)
    least = first_least(grams, length - size + 1)
    begin = starts_of(least)
    count = np.diff(np.append(begin, len(least)))
    return grams[least[begin]], _span_hashes(words, begin, begin + count + length - 1, _BASES[1]), begin, count


def _scan(batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """A row for each text (no digit; ``at`` is its number of words) and one for each run."""
    for whole in batches:
        for batch in slices(whole):
            place, columns, sha = [], [[], [], [], []], []
            for i, raw in enumerate(batch.column(1).to_pylist()):
                words = word_hashes(raw)
                sha.append((hashlib.sha256(b" ".join(raw.split())).hexdigest(), len(words)))
                for first in range(0, max(len(words) - length + 1, 0), PIECE):
                    digit, same, at, count = runs(words[first : first + PIECE + length - 1], length)
                    for column, own in zip(columns, (digit, same, at + first, count), strict=True):
                        column.append(own)
                    place.append(np.full(len(digit), i))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array([x[1] for x in sha], pa.int64()),
                 pa.nulls(n, pa.int32()), pa.array([x[0] for x in sha], pa.string())], schema=schema)
            if place:
                rows = pa.array(np.concatenate(place))
                digit, same, at, count = (np.concatenate(c) for c in columns)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(signed(digit)), pa.array(signed(same)), pa.array(at),
                     pa.array(count.astype(np.int32)), pa.nulls(len(rows), pa.string())], schema=schema)


def _cut(batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The word hashes of the runs asked for of each text."""
    for whole in batches:
        for batch in slices(whole):
            for i, asked in enumerate(batch.column(3).to_pylist()):
                words = word_hashes(batch.column(1)[i].as_py())
                rows = pa.array([i] * len(asked), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["digit"] for r in asked], pa.int64()), batch.column(0).take(rows), batch.column(2).take(rows),
                     pa.array([r["at"] for r in asked], pa.int64()),
                     pa.array([words[r["at"] : r["at"] + r["windows"] + length - 1].tobytes() for r in asked], pa.binary())], schema=schema)


def _text_order(table: pa.Table) -> np.ndarray:
    """Rank of each row by id, null first, mark and place."""
    keys = [(k, "ascending") for k in ("id", "mark", "at")]
    order = np.asarray(pc.sort_indices(table.select(["id", "mark", "at"]), sort_keys=keys, null_placement="at_start"))
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank


def later_windows(spans: list[np.ndarray], rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(span, window) of the windows that also stand in a span of lower rank, by the matching
    statistics of the spans over an index of all of them. No window is twice in a span."""
    sizes = np.array([len(s) for s in spans], np.int64)
    known, numbered = np.unique(np.concatenate(spans), return_inverse=True)
    # zero ends each span and is in no window
    starts = np.cumsum(sizes + 1) - sizes - 1
    text = np.zeros(int(sizes.sum()) + len(spans), np.int64)
    inside = ranges(starts, sizes)
    text[inside] = numbered + 1
    index = FMIndex(text, len(known) + 1, length)
    count = np.maximum(sizes - length + 1, 0)
    begin, owner = ranges(starts, count), np.repeat(np.arange(len(spans)), count)
    matched, low, _ = index.matching_statistics(text, begin + length - 1, length, times=2)
    full = matched == length
    begin, owner, low = begin[full], owner[full], low[full]
    order = np.lexsort((rank[owner], low))
    later = order[np.concatenate(([False], low[order][1:] == low[order][:-1]))] if len(order) else order
    later.sort()
    return owner[later], begin[later] - starts[owner[later]]


def _search(batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(id, mark, begin, end) of the words of later windows; rows are sorted by digit, and an
    index holds whole digits."""
    def search(table: pa.Table) -> Iterator[pa.RecordBatch]:
        table = table.combine_chunks()
        spans = [np.frombuffer(s, np.uint64) for s in table.column("span").to_pylist()]
        owner, window = later_windows(spans, _text_order(table), length)
        if not len(owner):
            return
        begin = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (window[1:] > window[:-1] + 1))))
        last = np.append(begin[1:], len(window)) - 1
        rows = pa.array(owner[begin])
        at = np.asarray(table.column("at"))[owner[begin]]
        own = table.select(["id", "mark"]).take(rows).combine_chunks().to_batches()[0]
        yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(at + window[begin]), pa.array(at + window[last] + length)], schema=schema)

    held: list[pa.RecordBatch] = []
    words = 0
    for batch in chain(batches, [None]):
        if batch is not None and batch.num_rows:
            held.append(batch)
            words += batch.column("span").nbytes // 8
        if not held or (batch is not None and words < SHARD_WORDS):
            continue
        table = pa.Table.from_batches(held)
        digit = np.asarray(table.column("digit"))
        edge = starts_of(digit)
        if batch is not None:  # the last digit may go on
            held = table.slice(int(edge[-1])).combine_chunks().to_batches()
            words = sum(b.column("span").nbytes // 8 for b in held)
            edge, table = edge[:-1], table.slice(0, int(edge[-1]))
        else:
            held, words = [], 0
        if not table.num_rows:
            continue
        sizes = np.cumsum([len(s) // 8 for s in table.column("span").to_pylist()])
        ends = np.append(edge[1:], table.num_rows)
        lo = 0
        while lo < len(edge):
            done = sizes[edge[lo] - 1] if edge[lo] else 0
            hi = max(lo + 1, int(np.searchsorted(sizes[ends - 1], done + SHARD_WORDS, "right")))
            yield from search(table.slice(int(edge[lo]), int(ends[hi - 1] - edge[lo])))
            lo = hi


def _windows(batches: Iterator[pa.RecordBatch], length: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(0, batch.num_rows, 1_000):
            part = batch.slice(row, 1_000)
            spans = [np.frombuffer(s, np.uint64) for s in part.column("span").to_pylist()]
            sizes = np.array([len(s) for s in spans], np.int64)
            starts, count = np.cumsum(sizes) - sizes, np.maximum(sizes - length + 1, 0)
            begin, owner = ranges(starts, count), np.repeat(np.arange(len(spans)), count)
            words, rows = np.concatenate(spans), pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(signed(_span_hashes(words, begin, begin + length, base))) for base in _BASES],
                 part.column("id").take(rows), part.column("mark").take(rows), pa.array(np.asarray(part.column("at"))[owner] + begin - starts[owner])], schema=schema)


def _finish(batches: Iterator[pa.RecordBatch], schema: pa.Schema, keep: bool) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole):
            out = []
            for raw, removed in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                words, spans = raw.split(), []
                for begin, end in sorted((r["begin"], r["end"]) for r in removed):
                    if spans and begin <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([begin, end])
                edges = [0, *chain.from_iterable(spans), len(words)]
                kept = b" ".join(chain.from_iterable(words[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                out.append((sum(b - a for a, b in spans), hashlib.sha256(kept).hexdigest(), [{"begin": a, "end": b} for a, b in spans], kept if keep else None))
            columns = list(zip(*out, strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *[pa.array(c, schema.field(k + 2).type) for k, c in enumerate(columns)]], schema=schema)


def _same(a: str, b: str) -> F.Column:
    return (F.col(f"{a}.mark") == F.col(f"{b}.mark")) & F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id"))


def _mapped(df: DataFrame, function, fields: list[tuple], **settings) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([StructField(*f) for f in fields])
    return df.mapInArrow(partial(function, schema=to_arrow_schema(schema), **settings), schema)


def _removed(texts: DataFrame, every: DataFrame, length: int, group_rows: int) -> DataFrame:
    """(id, mark, begin, end) of words covered by windows that start earlier; may overlap."""
    kind = texts.schema["id"].dataType
    name = [("id", kind), ("mark", LongType())]
    windows = every.where("digit IS NOT NULL")
    several = stage(windows.groupBy("digit").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "mark", "at")).alias("first"), (F.min("same") == F.max("same")).alias("alike")
    ).where("n > 1").select("digit", "first", "alike"), "passage-digits")
    live = stage(windows.join(several, "digit").where(~F.col("alike") | (F.struct("id", "mark", "at") != F.col("first"))).select(
        "digit", "same", "id", "mark", "at", "windows", "alike"), "passage-live")
    mixed = live.where(~F.col("alike"))
    runs_ = stage(mixed.groupBy("digit", "same").agg(F.min(F.struct("id", "mark", "at", "windows")).alias("one")), "passage-runs")
    copies = mixed.join(runs_, ["digit", "same"]).where(F.struct("id", "mark", "at", "windows") != F.col("one"))
    ends = (F.col("at") + F.col("windows") + (length - 1)).alias("end")
    whole = live.where("alike").unionByName(copies.drop("one")).select("id", "mark", F.col("at").alias("begin"), ends)
    asked = runs_.select("digit", "one.*").groupBy("id", "mark").agg(F.collect_list(F.struct("digit", "at", "windows")).alias("runs"))
    span = [("digit", LongType()), *name, ("at", LongType()), ("span", BinaryType())]
    spans = stage(_mapped(texts.alias("t").join(asked.alias("r"), _same("t", "r")).select("t.id", "t.text", "t.mark", "r.runs"), _cut, span, length=length), "passage-spans")
    crowded, n = stage_counted(runs_.groupBy("digit").count().where(F.col("count") > group_rows).select("digit"), "passage-crowded")
    gathered = spans if not n else spans.join(crowded, "digit", "left_anti")
    interval = [*name, ("begin", LongType()), ("end", LongType())]
    found = _mapped(gathered.repartition("digit").sortWithinPartitions("digit"), _search, interval, length=length)
    if n:
        window = [("h1", LongType()), ("h2", LongType()), *name, ("at", LongType())]
        single = stage(_mapped(spans.join(crowded, "digit", "left_semi"), _windows, window, length=length), "passage-windows")
        # staged, so that the rows of a window that stands in very many texts can be split in the join
        firsts = stage(single.groupBy("h1", "h2").agg(F.min(F.struct("id", "mark", "at")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1"), "passage-firsts")
        later = single.join(firsts.drop("n"), ["h1", "h2"]).where(F.struct("id", "mark", "at") != F.col("first"))
        found = found.unionByName(later.select("id", "mark", F.col("at").alias("begin"), (F.col("at") + length).alias("end")))
    return whole.unionByName(found)


def _copies(base: DataFrame, length: int) -> DataFrame:
    """All but one of the rows with the same id and text: every word of a window goes. They
    are told by their number, in steps, so that a large group is not one task's."""
    step = 10_000
    parts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("rows") - 2) / step))).alias("part")
    left = F.least(F.col("rows") - 1 - F.col("part") * step, F.lit(step))
    each = base.where("rows > 1").select("*", parts).repartition("id", "mark", "part").select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), left)).alias("one"))
    gone = F.when(F.col("n_words") >= length, F.col("n_words")).otherwise(0).cast("bigint")
    spans = F.when(gone > 0, F.array(F.struct(F.lit(0).cast("bigint").alias("begin"), F.col("n_words").alias("end")))).otherwise(F.array())
    sha = F.when(gone > 0, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("sha"))
    kept = F.when(gone == 0, F.col("kept")).otherwise(F.lit("").cast("binary"))
    return each.select("id", "n_words", gone.alias("n_removed"), sha.alias("kept_sha256"), spans.alias("spans"), kept.alias("kept"))


def later_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   group_rows: int = GROUP_ROWS, keep: bool = False) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256, spans) of every row: spans are the maximal runs of
    removed words, the digest is that of the words left, joined by spaces. With ``keep``
    also ``kept``, those words as UTF-8."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text, F.col(id_col).isNull()).alias("mark"))
    repeated, n = stage_counted(texts.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "passage-repeated")
    if n:
        texts = texts.dropDuplicates(["id", "mark"])
    kind = texts.schema["id"].dataType
    run = [("id", kind), ("mark", LongType()), ("digit", LongType()), ("same", LongType()), ("at", LongType()), ("windows", IntegerType()), ("sha", StringType())]
    every = stage(_mapped(texts, _scan, run, length=length), "passage-every")
    removed = _removed(texts, every, length, group_rows).groupBy("id", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("removed"))
    between = ArrayType(StructType([StructField("begin", LongType()), StructField("end", LongType())]))
    changed = _mapped(
        texts.alias("t").join(removed.alias("r"), _same("t", "r")).select("t.id", "t.text", "t.mark", "r.removed"), _finish,
        [("id", kind), ("mark", LongType()), ("n_removed", LongType()), ("kept_sha256", StringType()), ("spans", between), ("kept", BinaryType())], keep=keep)
    base = every.where("digit IS NULL").select("id", "mark", F.col("at").alias("n_words"), "sha")
    if keep:
        base = base.alias("b").join(texts.alias("t"), _same("b", "t")).select("b.*", F.col("t.text").alias("kept"))
    else:
        base = base.withColumn("kept", F.lit(None).cast("binary"))
    if n:
        base = base.alias("b").join(repeated.alias("r"), _same("b", "r"), "left").select("b.*", F.coalesce("r.rows", F.lit(1).cast("bigint")).alias("rows"))
    out = base.alias("b").join(changed.alias("c"), _same("b", "c"), "left").select(
        "b.id", "b.n_words", F.coalesce("c.n_removed", F.lit(0).cast("bigint")).alias("n_removed"), F.coalesce("c.kept_sha256", "b.sha").alias("kept_sha256"),
        F.coalesce("c.spans", F.array()).alias("spans"), F.when(F.col("c.n_removed").isNull(), F.col("b.kept")).otherwise(F.col("c.kept")).alias("kept"))
    if n:
        out = out.unionByName(_copies(base, length))
    return out if keep else out.drop("kept")
