"""Benchmark decontamination with suffix arrays of the training texts.

Every shard (an Arrow batch of documents) gets a word-level suffix array, sorted through
the depth of a window. Every suffix of the benchmark items is looked up in it by binary
search, so one search gives all places of a window in the shard. Matches of consecutive
windows on one diagonal join to longest verbatim matches.

Words are what is left between ASCII characters other than letters and digits, A-Z
lower-cased. A window is ``window`` consecutive words of an item; an item with fewer
words is one window, an item without words has none. A word that no item has cannot lie
in a match, so suffixes that begin within fewer known words than the shortest window
are left out of the array.

The benchmark is cut into blocks of about ``block_words`` words, so what a task holds of it
is bounded: a shard of texts meets one block after another, and its words hit are joined
over the blocks. Several blocks lie as files in the shared folder. The documents are passed
over once, each row is judged by its own text, and no rows are matched by id, so rows that
repeat an id or have none are as good as others. Null and empty texts have no words and are
clean; a long text is a shard of its own; an empty table gives an empty result, an empty
benchmark hits nothing. Items that share an id are one item. Ids of documents are longs.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.common import SharedFile, binary_text, open_fs, ranges, slices, starts_of
from quillsieve.session import stage_path

WINDOW = 10
# Words of benchmark text that one pass takes along: about 50 MB in a task.
BLOCK_WORDS = 1_000_000
# Text of one suffix array.
SHARD_BYTES = 8 << 20
_EXPAND = 2_000_000
_FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def words_of(raw: bytes | None) -> list[bytes]:
    return raw.translate(_FOLD).split() if raw else []


class Windows:
    """The distinct windows of some items, with the items of each."""

    def __init__(self, items: list[tuple[str, list[bytes]]], size: int = WINDOW):
        self.size = size
        self.names = sorted({name for name, words in items if words}, key=lambda x: x.encode())
        number = {name: i for i, name in enumerate(self.names)}
        self.words: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[int]] = {}
        for name, words in items:
            ids = [self.words.setdefault(w, len(self.words) + 1) for w in words]
            for at in range(max(1, len(ids) - size + 1) if ids else 0):
                owners.setdefault(tuple(ids[at : at + size]), set()).add(number[name])
        self.lengths = np.array([len(w) for w in owners], np.int64)
        self.shortest = int(self.lengths.min()) if owners else size
        self.low = self._keys(owners, 0)
        self.high = self._keys(owners, 0xFFFFFFFF)
        self.count = np.array([len(x) for x in owners.values()], np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.owners = np.array([i for x in owners.values() for i in sorted(x)], np.int64)

    def _keys(self, windows, pad: int) -> np.ndarray:
        full = np.full((len(windows), self.size), pad, np.uint32)
        for row, words in zip(full, windows, strict=True):
            row[: len(words)] = words
        return packed(full)


def packed(rows: np.ndarray) -> np.ndarray:
    """Rows of word numbers as byte strings that sort in the same order."""
    return np.ascontiguousarray(rows.astype(">u4")).view(f"S{4 * rows.shape[1]}").reshape(-1)


def suffix_array(ids: np.ndarray, depth: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, keys) of the suffixes in order of their first ``depth`` words. A suffix
    ends at a 0; those with fewer than ``shortest`` words are left out."""
    known = ids != 0
    stop = np.where(known, np.iinfo(np.int64).max, np.arange(len(ids)))
    run = np.minimum(np.minimum.accumulate(stop[::-1])[::-1], len(ids)) - np.arange(len(ids))
    position = np.flatnonzero(run >= shortest)
    padded = np.concatenate((ids, np.zeros(depth, ids.dtype)))
    rows = np.lib.stride_tricks.sliding_window_view(padded, depth)[position].copy()
    rows[np.arange(depth)[None, :] >= run[position][:, None]] = 0
    keys = packed(rows)
    order = np.argsort(keys, kind="stable")
    return position[order], keys[order]


def shard_matches(texts: list[list[bytes]], windows: Windows) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word position in the shard, window) of every occurrence, in parts. Documents follow
    one another with one separator behind each."""
    get = windows.words.get
    total = sum(len(t) + 1 for t in texts)
    ids = np.fromiter((n for t in texts for n in (*map(get, t, repeat(0)), 0)), np.uint32, total)
    position, keys = suffix_array(ids, windows.size, windows.shortest)
    first = np.searchsorted(keys, windows.low, "left")
    found = np.searchsorted(keys, windows.high, "right") - first
    hit = np.flatnonzero(found > 0)
    steps = np.searchsorted(np.cumsum(found[hit]), np.arange(0, found[hit].sum() + 1, _EXPAND), "left")
    for lo, hi in zip(steps, np.append(steps[1:], len(hit)), strict=True):
        w = hit[lo:hi]
        if len(w):
            yield position[ranges(first[w], found[w])], np.repeat(w, found[w])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes | None]]]:
    for batch in batches:
        for part in slices(batch, SHARD_BYTES):
            yield part.column(0).to_pylist(), part.column(1).to_pylist()


class Blocks:
    """The windows of a benchmark: one block that goes along, or files that are read in turn."""

    def __init__(self, held: Windows | None, paths: list[str]):
        self._held, self._paths = held, paths

    def __iter__(self) -> Iterator[Windows]:
        if self._held is not None:
            yield self._held
        for path in self._paths:
            system, place = open_fs(path)
            with system.open_input_file(place) as file:
                yield pickle.loads(file.read())


def judged(raws: list[bytes | None], blocks: Blocks) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """(words, words hit, items sorted as strings) of each text of a shard."""
    texts = [words_of(r) for r in raws]
    n_words = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(n_words + 1) - n_words - 1
    change = np.zeros(int((n_words + 1).sum()) + 1, np.int32)
    items: list[list[str]] = [[] for _ in raws]
    for windows in blocks:
        pairs = [np.zeros(0, np.int64)]
        for position, window in shard_matches(texts, windows):
            np.add.at(change, position, 1)
            np.add.at(change, position + windows.lengths[window], -1)
            doc = np.searchsorted(starts, position, "right") - 1
            seen = np.unique(doc * len(windows.lengths) + window)
            doc, window = np.divmod(seen, len(windows.lengths))
            item = windows.owners[ranges(windows.first[window], windows.count[window])]
            pairs.append(np.unique(np.repeat(doc, windows.count[window]) * len(windows.names) + item))
        for code in np.unique(np.concatenate(pairs)).tolist():
            items[code // len(windows.names)].append(windows.names[code % len(windows.names)])
    hits = np.add.reduceat(np.cumsum(change[:-1]) > 0, starts).astype(np.int64) if len(raws) else np.zeros(0, np.int64)
    return n_words, hits, [sorted(set(own)) for own in items]


def _judge(batches: Iterator[pa.RecordBatch], blocks: Blocks) -> Iterator[pa.RecordBatch]:
    for ids, raws in _shards(batches):
        n_words, hits, items = judged(raws, blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n_words), pa.array(hits), pa.array(items, pa.list_(pa.string()))],
            ["id", "n_words", "n_hit", "items"])


def _spans(batches: Iterator[pa.RecordBatch], blocks: Blocks) -> Iterator[pa.RecordBatch]:
    for ids, raws in _shards(batches):
        texts = [words_of(r) for r in raws]
        starts = np.cumsum([len(t) + 1 for t in texts]) - [len(t) + 1 for t in texts]
        for windows in blocks:
            place, window = (np.concatenate(x) for x in zip(*[(np.zeros(0, np.int64),) * 2, *shard_matches(texts, windows)], strict=True))
            item = windows.owners[ranges(windows.first[window], windows.count[window])]
            place, length = np.repeat(place, windows.count[window]), np.repeat(windows.lengths[window], windows.count[window])
            order = np.lexsort((place, item))
            place, item, end = place[order], item[order], (place + length)[order]
            begins = np.flatnonzero(np.concatenate(([True], (item[1:] != item[:-1]) | (place[1:] != place[:-1] + 1)))) if len(item) else starts_of(item)
            doc = np.searchsorted(starts, place[begins], "right") - 1
            last = np.append(begins[1:], len(item))[: len(begins)] - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids[d] for d in doc], pa.int64()), pa.array([windows.names[i] for i in item[begins]], pa.string()),
                 pa.array(place[begins] - starts[doc]), pa.array(end[last] - place[begins])], ["id", "item", "word", "words"])


def _windows(benchmark: DataFrame, item_col: str, text_col: str, size: int, block_words: int) -> Iterator[Windows]:
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), binary_text(text_col))
    items, n, some = [], 0, False
    # blocks keep whole ids together, so that an id with several texts stays one item
    for row in rows.orderBy("item", "text").toLocalIterator():
        words = words_of(bytes(row["text"]))
        if n + len(words) > block_words and items and items[-1][0] != row["item"]:
            yield Windows(items, size)
            items, n, some = [], 0, True
        items.append((row["item"], words))
        n += len(words)
    if items or not some:
        yield Windows(items, size)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, size: int, block_words: int) -> Blocks:
    """Block by block through the driver; a single one is handed on, others become files."""
    folder, held, paths = None, None, []
    for number, windows in enumerate(_windows(benchmark, item_col, text_col, size, block_words)):
        if number == 0:
            held = windows
            continue
        if held is not None:
            folder, first, held = stage_path(benchmark.sparkSession, "benchmark"), held, None
            paths.append(_written(f"{folder}/block-0", first))
        paths.append(_written(f"{folder}/block-{number}", windows))
    return Blocks(held, paths)


def _written(path: str, windows: Windows) -> str:
    file = SharedFile(path)
    file.write(pickle.dumps(windows))
    file.close()
    return path


def _searched(docs, benchmark, step, schema, id_col, text_col, item_col, item_text_col, window, block_words) -> DataFrame:
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(_blocks(benchmark, item_col, item_text_col, window, block_words))
    return narrow.mapInArrow(lambda batches: step(batches, sent.value), schema)


def matches(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
            window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, item, word, words): longest verbatim matches as first word and length. Windows
    of an item that follow one another word by word make one match."""
    return _searched(docs, benchmark, _spans, "id bigint, item string, word bigint, words bigint",
                     id_col, text_col, item_col, item_text_col, window, block_words)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
                  window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, n_words, n_hit, items) of every document: words inside occurrences of windows,
    and the ids of the items, sorted as strings."""
    return _searched(docs, benchmark, _judge, "id bigint, n_words bigint, n_hit bigint, items array<string>",
                     id_col, text_col, item_col, item_text_col, window, block_words)


def with_digest(judged: DataFrame) -> DataFrame:
    """The items as a count and a digest of their ids, joined by commas."""
    return judged.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text",
                      window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Rows without any occurrence of a window, each judged by its own text in passing; ids
    and other columns are not looked at."""
    sent = docs.sparkSession.sparkContext.broadcast(_blocks(benchmark, item_col, item_text_col, window, block_words))
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, SHARD_BYTES, place):
                _, hits, _ = judged(part.column(place).cast(pa.binary()).to_pylist(), sent.value)
                yield part.filter(pa.array(hits == 0))

    return docs.mapInArrow(run, docs.schema)
