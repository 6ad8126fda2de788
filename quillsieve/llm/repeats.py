"""Remove every byte covered by a ``length``-byte string that starts anywhere else too.

The suffixes of all texts are sorted by most-significant-digit passes to the depth of
``length`` bytes and no further; suffixes in a group of two or more are the repeats, and a
suffix that is alone leaves the sort at the pass that shows it.

The first digit of the window at a suffix is the smallest hash of its 50-byte strings. It
depends on the window's bytes only, and neighbouring windows mostly share it, so the first
pass deals out runs of windows (a row for about 75 suffixes). Runs whose digit occurs once
leave. Runs that are equal as a whole are repeats as a whole, and one of them stands for
all. The windows of the others are sorted by four digits of a quarter of the bytes each,
in a task for each digit of the first pass. Runs are counted by digit before they are
dealt out: a digit with more than ``group_rows`` or ``GROUP_BYTES`` is not gathered; its windows are
grouped by an aggregation over all their digits.

Digits are 64-bit hashes of the bytes, so the order within a pass is that of the hashes;
groups of equal windows do not depend on it. Two windows are taken for equal when five digits
agree. Null, empty and short texts have no windows; a long text is hashed in pieces. Rows with
equal ids are told apart by their texts. Rows that are equal in id and text are looked at
once, and as they repeat each other, all their bytes go if they have a window. Ids are
longs, null among them; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.common import ranges, signed, slices, starts_of
from quillsieve.session import stage, stage_counted

LENGTH = 200
DIGITS = 4
GROUP_ROWS = 2_000
GROUP_BYTES = 16 << 20
# Bytes of one text that are hashed at a time, and bytes of runs that are sorted at a time.
PIECE = 1 << 20
SPAN_BYTES = 2 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A value for each byte, and the powers of the base and of its inverse modulo 2**64."""
    values = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], np.uint64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    up[0] = down[0] = 1
    return values, np.multiply.accumulate(up), np.multiply.accumulate(down)


def slice_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at every place, equal for equal bytes wherever they stand."""
    values, up, down = _powers(max(2 * PIECE, 1 << len(data).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * down[: len(data)])))
    h = (sums[size:] - sums[:-size]) * up[: len(data) - size + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def sliding_minimum(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values, from minima that run forwards and backwards in blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def runs(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, digit) of the runs of one text, and digits that occur again
    within a run."""
    size = length // DIGITS
    h = slice_hashes(data, size)
    width = length - size + 1
    least = sliding_minimum(h, width)
    begin = starts_of(least)
    count = np.diff(np.append(begin, len(least)))
    # places where a window's digit stands at its left or right edge; equal windows of one run
    # have two such places with the same hash and no other between them
    edge = np.zeros(len(h), bool)
    edge[: len(least)] |= h[: len(least)] == least
    edge[width - 1 :] |= h[width - 1 :] == least
    at_edge = h[edge]
    again = at_edge[1:][at_edge[1:] == at_edge[:-1]]
    return begin, count, least[begin], np.unique(again)


def _scan(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (id, mark, digit, whole, at, windows) of all texts; ``windows`` is 0 for digits that
    occur again within a run."""
    for batch_ in batches:
        for batch in slices(batch_):
            out: list[list[np.ndarray]] = [[], [], [], []]
            place = []
            for i, raw in enumerate(batch.column(1).to_pylist()):
                for first in range(0, max(len(raw) - length + 1, 0), PIECE):
                    piece = raw[first : first + PIECE + length - 1]
                    begin, count, digit, again = runs(np.frombuffer(piece, np.uint8), length)
                    spans = zip(begin.tolist(), (begin + count + length - 1).tolist(), strict=True)
                    whole = np.fromiter((xxhash.xxh3_64_intdigest(piece[a:b]) for a, b in spans), np.uint64, len(begin))
                    none = np.zeros(len(again), np.int64)
                    for column, own in zip(out, ((digit, again), (whole, none.view(np.uint64)), (begin + first, none), (count, none)), strict=True):
                        column += own
                    place.append(np.full(len(begin) + len(again), i))
            if place:
                rows = pa.array(np.concatenate(place))
                digit, whole, at, windows = (np.concatenate(c) for c in out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(rows), batch.column(2).take(rows), pa.array(signed(digit)), pa.array(signed(whole)),
                     pa.array(at.astype(np.int64)), pa.array(windows.astype(np.int32))], ["id", "mark", "digit", "whole", "at", "windows"])


_RUN = "id bigint, mark bigint, digit bigint, whole bigint, at bigint, windows int"


def _cut(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the open runs of each text."""
    for batch in batches:
        for part in slices(batch):
            for row in part.to_pylist():
                todo = [r for r in row["runs"] if r["state"] != 0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["digit"] for r in todo], pa.int64()), pa.array([row["id"]] * len(todo), pa.int64()),
                     pa.array([row["mark"]] * len(todo), pa.int64()), pa.array([r["at"] for r in todo], pa.int64()),
                     pa.array([r["state"] for r in todo], pa.int32()),
                     pa.array([row["text"][r["at"] : r["at"] + r["windows"] + length - 1] for r in todo], pa.binary())],
                    ["digit", "id", "mark", "at", "state", "span"])


_SPAN = "digit bigint, id bigint, mark bigint, at bigint, state int, span binary"


def window_digits(spans: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(digits, span, window in the span) of all windows of the spans; a row of digits per pass."""
    size = length // DIGITS
    sizes = np.array([len(s) for s in spans], np.int64)
    starts = np.cumsum(sizes) - sizes
    h = slice_hashes(np.frombuffer(b"".join(spans), np.uint8), size)
    count = sizes - length + 1
    place = ranges(starts, count)
    owner = np.repeat(np.arange(len(spans)), count)
    return np.stack([h[place + size * k] for k in range(DIGITS)]), owner, place - starts[owner]


def repeated_windows(digits: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Which windows occur more than once, by passes over the digits from the first on. A
    window that is alone after a pass has left; a weight of 2 stands for more than one."""
    live, group = np.arange(digits.shape[1]), np.zeros(digits.shape[1], np.int64)
    for digit in digits:
        order = np.lexsort((digit[live], group))
        live, key, upper = live[order], digit[live][order], group[order]
        begin = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (upper[1:] != upper[:-1])))) if len(live) else starts_of(key)
        size = np.diff(np.append(begin, len(live)))
        several = np.repeat(np.add.reduceat(weight[live], begin) > 1, size) if len(live) else np.zeros(0, bool)
        group = np.repeat(np.arange(len(begin)), size)[several]
        live = live[several]
    found = np.zeros(digits.shape[1], bool)
    found[live] = True
    return found


def _intervals(owner: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, begin, end) of the bytes covered by windows, given in order of owner and place."""
    if not len(owner):
        return owner, at, at
    begin = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (at[1:] > at[:-1] + 1))))
    last = np.append(begin[1:], len(at)) - 1
    return owner[begin], at[begin], at[last] + length


def _sort_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """(id, mark, begin, end) of the repeats of whole groups, rows sorted by the first digit.
    Groups are sorted together up to about ``SPAN_BYTES``."""
    def sort(table: pa.Table) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        state = np.asarray(table.column("state"))
        digits, owner, window = window_digits(table.column("span").to_pylist(), length)
        found = repeated_windows(digits, np.where(state[owner] == 2, 2, 1)) & (state[owner] == 1)
        owner, window = owner[found], window[found]
        span, begin, end = _intervals(owner, window, length)
        at = np.asarray(table.column("at"))[span]
        rows_ = pa.array(span)
        column = lambda name: table.column(name).combine_chunks().take(rows_)
        yield pa.RecordBatch.from_arrays([column("id"), column("mark"), pa.array(at + begin), pa.array(at + end)], ["id", "mark", "begin", "end"])

    held: list[pa.RecordBatch] = []
    size = 0
    for batch in chain(batches, [None]):
        if batch is not None:
            held.append(batch)
            size += batch.column(5).nbytes
            if size < SPAN_BYTES:
                continue
        table = pa.Table.from_batches(held) if held else None
        if table is None or not table.num_rows:
            continue
        begin = starts_of(np.asarray(table.column(0)))
        held, size, whole = [], 0, table.num_rows
        if batch is not None:  # the last group may go on
            whole = int(begin[-1])
            held = table.slice(whole).combine_chunks().to_batches()
            size = sum(b.column(5).nbytes for b in held)
        yield from sort(table.slice(0, whole).combine_chunks())


def _explode(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1 << 18, 5):
            digits, owner, window = window_digits(part.column("span").to_pylist(), length)
            rows = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(signed(d)) for d in digits], part.column("id").take(rows), part.column("mark").take(rows),
                 pa.array(np.asarray(part.column("at"))[owner] + window), part.column("state").take(rows)],
                [*[f"d{k}" for k in range(DIGITS)], "id", "mark", "at", "state"])


def _large_groups(spans: DataFrame, length: int) -> DataFrame:
    """Repeats of groups that are not gathered, as (id, mark, begin, end) of windows."""
    digits = [f"d{k}" for k in range(DIGITS)]
    windows = stage(spans.mapInArrow(partial(_explode, length=length), ", ".join(f"{d} bigint" for d in digits) + ", id bigint, mark bigint, at bigint, state int"), "repeat-windows")
    again = stage(windows.groupBy(*digits).agg(F.sum("state").alias("n")).where("n > 1").select(*digits), "repeat-digits")
    return windows.where("state = 1").join(again, digits, "left_semi").select("id", "mark", F.col("at").alias("begin"), (F.col("at") + length).alias("end"))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            out = []
            for row in part.to_pylist():
                text, spans = row["text"], []
                for begin, end in sorted((r["begin"], r["end"]) for r in row["removed"] or []):
                    if spans and begin <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([begin, end])
                edges = [0, *[x for s in spans for x in s], len(text)]
                kept = hashlib.sha256()
                for a, b in zip(edges[::2], edges[1::2], strict=True):
                    kept.update(text[a:b])
                out.append((row["id"], row["mark"], sum(b - a for a, b in spans), len(spans), kept.hexdigest(), [{"begin": a, "end": b} for a, b in spans]))
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "mark", "n_removed", "n_spans", "kept_sha256", "spans"])


_CHANGED = "id bigint, mark bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<begin: bigint, end: bigint>>"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts as bytes; the mark tells rows of one id apart and is part of a row's name."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    return docs.select(F.col(id_col).cast("bigint").alias("id"), text.alias("text"), F.xxhash64(text, F.col(id_col).isNull()).alias("mark"))


def _same(a: str, b: str) -> F.Column:
    return (F.col(f"{a}.mark") == F.col(f"{b}.mark")) & F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id"))


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row; spans are the maximal
    removed runs of bytes."""
    if length % DIGITS:
        raise ValueError(f"the length must be a multiple of {DIGITS}")
    rows = _texts(docs, id_col, text_col)
    repeated, n = stage_counted(rows.groupBy("id", "mark").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "repeat-rows")
    texts = rows.dropDuplicates(["id", "mark"]) if n else rows
    every = stage(texts.mapInArrow(partial(_scan, length=length), _RUN), "repeat-runs")
    several = stage(every.groupBy("digit").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digit"), "repeat-first-digits")
    live = stage(every.where("windows > 0").join(several, "digit", "left_semi"), "repeat-live")
    equal = stage(live.groupBy("digit", "whole").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "mark", "at")).alias("one")).where("n > 1").select("digit", "whole", "one"), "repeat-wholes")
    # 0: repeated as a whole; 1: open; 2: repeated as a whole and stands for its equals among the open ones
    tagged = live.join(equal, ["digit", "whole"], "left").withColumn(
        "state", F.when(F.col("one").isNull(), 1).when(F.struct("id", "mark", "at") == F.col("one"), 2).otherwise(0))
    per_text = tagged.groupBy("id", "mark").agg(F.collect_list(F.struct("digit", "at", "windows", "state")).alias("runs"))
    touched = stage(texts.alias("t").join(per_text.alias("r"), _same("t", "r")).select("t.id", "t.text", "t.mark", "r.runs"), "repeat-texts")
    spans = stage(touched.where(F.exists("runs", lambda r: r["state"] != 0)).mapInArrow(partial(_cut, length=length), _SPAN), "repeat-spans")
    # only digits with open runs need the run that stands for its equals
    opened = stage(spans.where("state = 1").select("digit").distinct(), "repeat-open")
    needed = spans.join(opened, "digit", "left_semi")
    crowded, many = stage_counted(needed.groupBy("digit").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("span")).alias("bytes")).where((F.col("n") > group_rows) | (F.col("bytes") > GROUP_BYTES)).select("digit"), "repeat-crowded")
    gathered = needed.join(crowded, "digit", "left_anti") if many else needed
    parts = gathered.repartition("digit").sortWithinPartitions("digit").mapInArrow(
        partial(_sort_groups, length=length), "id bigint, mark bigint, begin bigint, end bigint")
    if many:
        parts = parts.unionByName(_large_groups(needed.join(crowded, "digit", "left_semi"), length))
    whole = touched.select("id", "mark", F.explode("runs").alias("r")).where("r.state <> 1").select(
        "id", "mark", F.col("r.at").alias("begin"), (F.col("r.at") + F.col("r.windows") + (length - 1)).alias("end"))
    removed = whole.unionByName(parts).groupBy("id", "mark").agg(F.collect_list(F.struct("begin", "end")).alias("removed"))
    cut = touched.drop("runs").alias("t").join(removed.alias("r"), _same("t", "r")).select("t.id", "t.text", "t.mark", "r.removed")
    changed = cut.mapInArrow(_finish, _CHANGED)
    # most texts keep every byte, so only what is known of them is joined
    base = rows.select("id", "mark", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("sha"))
    zero = F.lit(0).cast("bigint")
    out = base.alias("b").join(changed.alias("c"), _same("b", "c"), "left").select(
        "b.id", "b.mark", "b.n_bytes", F.coalesce("c.n_removed", zero).alias("n_removed"), F.coalesce("c.n_spans", zero).alias("n_spans"),
        F.coalesce("c.kept_sha256", "b.sha").alias("kept_sha256"), F.coalesce("c.spans", F.array()).alias("spans"))
    if n:
        gone = F.col("r.rows").isNotNull() & (F.col("o.n_bytes") >= length)
        every_byte = F.array(F.struct(zero.alias("begin"), F.col("o.n_bytes").alias("end")))
        out = out.alias("o").join(repeated.alias("r"), _same("o", "r"), "left").select(
            "o.id", "o.n_bytes", F.when(gone, F.col("o.n_bytes")).otherwise(F.col("o.n_removed")).alias("n_removed"),
            F.when(gone, F.lit(1).cast("bigint")).otherwise(F.col("o.n_spans")).alias("n_spans"),
            F.when(gone, F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("o.kept_sha256")).alias("kept_sha256"),
            F.when(gone, every_byte).otherwise(F.col("o.spans")).alias("spans"))
    return out.drop("mark")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """(id, kept) with the bytes that are left of every row, in order."""
    spans = repeated_spans(docs, id_col, text_col, length).select("id", "kept_sha256", "spans", "n_bytes")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, removed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                edges = [0, *[x for s in removed for x in (s["begin"], s["end"])], len(raw)]
                out.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "kept"])

    texts = _texts(docs, id_col, text_col).select("id", "text")
    return texts.join(spans, "id").select("id", "text", "spans").mapInArrow(cut, "id bigint, kept binary")
