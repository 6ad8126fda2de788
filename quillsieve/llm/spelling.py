"""Spelling variants: words one edit apart, found with Gram matrices of letter counts.

One inserted, deleted or replaced letter moves a word's vector of letter counts by a squared
distance of one or two. The products of a block of such vectors give all squared distances
of the block at once; pairs at most two apart, of equal or adjacent lengths, are verified on
the letters themselves.

Blocks keep the products small. The letters are dealt into ``parts`` sets; an edit touches at
most two of them, so two near words agree in their counts of all but some two sets. A word
stands in a block for each choice of the sets that agree, once under its own length and once
as the longer word under the length below. A pair counts in the first block that holds it.
More than ``block_rows`` words with the same counts (anagrams of a few letters) are not
multiplied: they meet by their letters with one place left out, in groups no larger than the
alphabet allows.

A word's form is its most frequent near word, if that is ``ratio`` times as frequent; its
root is where the chain of forms ends. Counts grow by the ratio at each step, so a chain is
short and has no cycle.

Null texts have no words. Rows that repeat each count; the id only enters the choice of the
letters that ``word_counts`` leaves out, null as an empty string. A long text is worked off
whole, its distinct words are held once. Ties go to the smaller word in code-point order. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.common import slices
from quillsieve.session import lookup_join, stage, stage_counted

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
# Words of one block that are multiplied; a block of more is grouped by left-out places.
BLOCK_ROWS = 8_192
# Distinct words that a task counts before it hands them on.
_COUNTED = 200_000
_PACKED = 256
_TILE = 512
# Letters of pairs that are verified at once.
_CHECKED = 1 << 19
_ALPHABET = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_RUN = "[A-Za-zÀ-ÿ]{%d,}"  # whole runs of so many letters
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))  # of UTF-8, other letters stay
# column of each code point below 256
_COLUMN = np.zeros(256, np.int64)
_COLUMN[[ord(c) for c in _ALPHABET]] = np.arange(len(_ALPHABET))


def misspelled(word: str, prefix: int, every: int) -> str:
    """The word, or the word without one letter if its checksum, begun with ``prefix``, says so."""
    h = zlib.crc32(word.encode(), prefix)
    if h % every:
        return word
    k = h % len(word)
    return word[:k] + word[k + 1 :]


def _count(batches: Iterator[pa.RecordBatch], min_length: int, every: int | None) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()
    runs = re.compile(_RUN % min_length)

    def ripe() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        total.clear()
        return out

    for whole in batches:
        for batch in slices(whole):
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = Counter(runs.findall((text or "").encode().translate(_LOWER).decode()))
                prefix = zlib.crc32(f"{name}:".encode())
                for word, n in own.items():
                    if every:
                        word = misspelled(word, prefix, every)
                        if len(word) < min_length:
                            continue
                    total[word] += n
                if len(total) > _COUNTED:
                    yield ripe()
    if total:
        yield ripe()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, every: int | None = None) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` letters that occur ``min_count`` times.

    With ``every``, one letter is left out of a document's word where that number divides the
    CRC-32 of ``<id>:<word>``, so that a corpus without misspellings has some.
    """
    narrow = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).alias("text"))
    counted = narrow.mapInArrow(partial(_count, min_length=min_length, every=every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words, zeros behind, and their lengths."""
    codes = np.array(words, f"U{max(map(len, words))}").view(np.uint32).reshape(len(words), -1)
    return codes, (codes > 0).sum(axis=1)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter of the alphabet stands in each word."""
    row, at = np.nonzero(codes)
    cell = row * len(_ALPHABET) + _COLUMN[codes[row, at]]
    return np.bincount(cell, minlength=len(codes) * len(_ALPHABET)).reshape(len(codes), -1)


def _choices(parts: int) -> list[tuple[int, ...]]:
    """The sets of letters that agree: all but two."""
    return list(combinations(range(parts), parts - 2))


def _set_of_letter(parts: int) -> np.ndarray:
    return np.arange(len(_ALPHABET)) % parts


def _blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Rows (block, choice, low, word, n): a word's blocks under its own length and as the longer."""
    sets = _set_of_letter(parts)
    for whole in batches:
        for batch in slices(whole, 1 << 20, 0):
            words, n = batch.column(0).to_pylist(), batch.column(1)
            codes, length = _letters(words)
            counts = np.ascontiguousarray(letter_counts(codes).astype(np.uint32))
            for number, chosen in enumerate(_choices(parts)):
                own = np.ascontiguousarray(counts[:, np.isin(sets, chosen)])
                agreed = np.fromiter((xxhash.xxh64_intdigest(row.tobytes(), number) for row in own), np.uint64, len(words))
                for low in (length, length - 1):
                    block = agreed ^ low.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(block.view(np.int64)), pa.array(np.full(len(words), number, np.int32)), pa.array(low.astype(np.int32)), batch.column(0), n],
                        ["block", "choice", "low", "word", "n"])


_BLOCK = "block bigint, choice int, low int, word string, n bigint"


def one_edit(codes: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which words b are one edit from the words a, which are as long or one letter shorter."""
    x, y = codes[a], codes[b]
    differs = x != y
    same = length[a] == length[b]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), codes.shape[1])
    # the rest of a has to be the rest of b behind the letter that b has more
    behind = (x[:, :-1] != y[:, 1:]) & (np.arange(codes.shape[1] - 1)[None, :] >= first[:, None])
    fits = ~(behind & (x[:, :-1] > 0)).any(axis=1) & (length[b] == length[a] + 1)
    return np.where(same, differs.sum(axis=1) == 1, fits)


def _first_choice(difference: np.ndarray, parts: int) -> np.ndarray:
    """Number of the first choice of sets in which the pair agrees, by its rows of differences."""
    sets = _set_of_letter(parts)
    touched = np.stack([(difference[:, sets == s] != 0).any(axis=1) for s in range(parts)], axis=1)
    found = np.full(len(difference), -1)
    for number, chosen in reversed(list(enumerate(_choices(parts)))):
        found[~touched[:, list(chosen)].any(axis=1)] = number
    return found


def _best(words: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(word, near, best_n, best) of the words in pairs: near words and the best of them."""
    own, other = np.concatenate([a, b]), np.concatenate([b, a])
    by_word = np.empty(len(words), np.int64)
    by_word[np.argsort(np.array(words, object), kind="stable")] = np.arange(len(words))
    order = np.lexsort((by_word[other], -n[other], own))
    own, other = own[order], other[order]
    begin = np.flatnonzero(np.append(True, own[1:] != own[:-1])) if len(own) else np.zeros(0, np.int64)
    near = np.diff(np.append(begin, len(own)))
    pick = lambda rows: pa.array([words[i] for i in rows.tolist()], pa.string())
    return pa.RecordBatch.from_arrays(
        [pick(own[begin]), pa.array(near.astype(np.int64)), pa.array(n[other[begin]]), pick(other[begin])], ["word", "near", "best_n", "best"])


_NEAR = "word string, near bigint, best_n bigint, best string"


def _gram_pairs(codes: np.ndarray, length: np.ndarray, low: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (a, b) within the blocks at a squared distance of at most two, and the letter counts
    of all words; a stands under its own length. Products of ``_TILE`` rows at a time."""
    counts = letter_counts(codes).astype(np.int32)
    kind = np.float32 if length.max(initial=0) < 2_000 else np.float64  # sums are exact
    x = counts.astype(kind)
    square = (x * x).sum(axis=1)
    base = length == low
    left, right = [], []
    for at in range(0, len(x), _TILE):
        rows = slice(at, at + _TILE)
        distance = square[rows, None] + square[None, :] - 2 * (x[rows] @ x.T)
        i, j = np.nonzero((distance <= 2) & base[rows, None] & (block[rows, None] == block[None, :]))
        i += at
        ours = (i < j) | ~base[j]
        left.append(i[ours])
        right.append(j[ours])
    a, b = np.concatenate(left), np.concatenate(right)
    return a, b, counts


def _near_in_blocks(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    """Near words of whole blocks; rows are sorted by block, choice and low."""
    def near(table: pa.Table, block: np.ndarray) -> pa.RecordBatch:
        words = table.column("word").to_pylist()
        codes, length = _letters(words)
        choice, low = np.asarray(table.column("choice")), np.asarray(table.column("low"))
        a, b, counts = _gram_pairs(codes, length, low, block)
        found = np.zeros(len(a), bool)
        step = max(1, _CHECKED // codes.shape[1])
        for lo in range(0, len(a), step):
            x, y = a[lo : lo + step], b[lo : lo + step]
            found[lo : lo + step] = one_edit(codes, length, x, y) & (_first_choice(counts[x] - counts[y], parts) == choice[x])
        return _best(words, np.asarray(table.column("n")), a[found], b[found])

    held: pa.Table | None = None
    for batch in batches:
        fresh = pa.Table.from_batches([batch])
        held = fresh if held is None else pa.concat_tables([held, fresh])
        yield from _ripe(held, near)
        edges = _edges(held)
        held = held.slice(int(edges[-1])).combine_chunks()
    if held is not None:
        yield from _packs(held, np.append(_edges(held), held.num_rows), near)


def _edges(table: pa.Table) -> np.ndarray:
    """Where a block begins."""
    if not table.num_rows:
        return np.zeros(1, np.int64)
    key = np.stack([np.asarray(table.column(k)).astype(np.int64) for k in ("block", "choice", "low")])
    return np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)))


def _ripe(table: pa.Table, near) -> Iterator[pa.RecordBatch]:
    """All blocks but the last, which may go on."""
    yield from _packs(table, _edges(table), near)


def _packs(table: pa.Table, edges: np.ndarray, near) -> Iterator[pa.RecordBatch]:
    """Blocks of two words and more, small ones several at a time."""
    size = np.diff(edges)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(edges, edges[lo] + _PACKED, "right")) - 1)
        block = np.repeat(np.arange(hi - lo), size[lo:hi])
        several = np.repeat(size[lo:hi] > 1, size[lo:hi])
        if several.any():
            part = table.slice(int(edges[lo]), int(edges[hi] - edges[lo])).filter(pa.array(several))
            yield near(part, block[several])
        lo = hi


def _left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of crowded blocks by their letters with one place left out: the place counts for
    words under their own length, and a longer word also meets the word it then equals."""
    for whole in batches:
        for batch in slices(whole, 1 << 16, 3):
            keys, rows = [], []
            for i, (block, choice, low, word) in enumerate(zip(*[batch.column(k).to_pylist() for k in ("block", "choice", "low", "word")], strict=True)):
                if len(word) == low:
                    forms = {f"{k} {word[:k]}{word[k + 1:]}" for k in range(len(word))} | {word}
                else:
                    forms = {word[:k] + word[k + 1 :] for k in range(len(word))}
                keys += [xxhash.xxh64_intdigest(f"{block} {choice} {low} {form}") for form in forms]
                rows += [i] * len(forms)
            at = pa.array(rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(keys, np.uint64).view(np.int64)), *[batch.column(k).take(at) for k in ("choice", "low", "word", "n")]],
                ["block", "choice", "low", "word", "n"])


def near_words(vocabulary: DataFrame, parts: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(word, n_near, best, best_n) of the words with near words, from a staged (word, n)."""
    if parts is None:
        rows = vocabulary.count()
        parts = 4 if rows <= 1_000_000 else 5 if rows <= 10_000_000 else 6
    blocks = vocabulary.mapInArrow(partial(_blocks, parts=parts), _BLOCK)
    keys = ["block", "choice", "low"]
    sizes = blocks.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    crowded, n = stage_counted(sizes.where(F.col("size") > block_rows).select(*keys), "spelling-crowded")
    small = blocks if not n else lookup_join(blocks, crowded, keys, "left_anti", bound=n)
    near = partial(_near_in_blocks, parts=parts)
    found = small.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(near, _NEAR)
    if n:
        left = lookup_join(blocks, crowded, keys, "left_semi", bound=n).select("block", "choice", "low", "word", "n").mapInArrow(_left_out, _BLOCK)
        found = found.unionByName(left.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(near, _NEAR))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))


def variants(counts: DataFrame, ratio: int = RATIO, parts: int | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of (word, n), one row per word."""
    vocabulary = stage(counts.select("word", "n"), "spelling-words")
    near = near_words(vocabulary, parts, block_rows)
    named = F.col("best_n") >= ratio * F.col("n")
    formed = stage(vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(named, F.col("best")).alias("form"), F.when(named, F.col("best_n")).alias("form_n")), "spelling-forms")
    steps, rows = stage_counted(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-steps")
    largest = vocabulary.agg(F.max("n")).first()[0] or 1
    longest = int(math.log(max(largest, ratio), ratio)) + 1
    for _ in range(max(0, math.ceil(math.log2(longest))) if rows else 0):  # each round doubles the steps taken
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        steps = stage(lookup_join(steps, further, ["root"], "left", bound=rows).select("word", F.coalesce("next", "root").alias("root")), "spelling-steps")
    rooted = lookup_join(formed, steps, ["word"], "left", bound=rows)
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
