"""URL filter: sorted arrays of 64-bit hashes, memory-mapped and searched in bulk.

A rule is a host and a path. It fits its host and all subdomains if the path of the URL
starts with the rule's; the longest rule (host and path) that fits wins, of equally long
ones that with the longer host. Without one the verdict is ``DEFAULT``.

The rules are hashed (XXH64 of host, a zero byte and path) and split by the hash into
shards; each is a file with the sorted hashes, the lengths, and the strings in the order
of the hashes, written to the shared folder. A task maps the files and searches all keys
that a batch of URLs can have at once: every suffix of the host at a dot, with every
prefix of the path of a length that some rule has. A hash that is found counts only if
the stored strings are equal; equal hashes stand side by side and are all compared.

Null URLs and those without ``://`` have an empty host and path and fit no rule. A rule that
is given twice counts once; of contradicting ones the block holds.
"""

from __future__ import annotations

import struct
import tempfile
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillsieve.llm.common import SharedFile, open_fs, ranges
from quillsieve.session import stage_path

DEFAULT = "allow"
SHARDS = 4
_MAGIC = b"urlrules"
_HEAD = struct.Struct("<8sqqq")


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path) by the first ``://``; A-Z of the host are lower-cased."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[cut:]
    end = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:cut].translate(_LOWER), tail[:end]


_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


def _key(host: bytes, path: bytes) -> bytes:
    return host + b"\0" + path


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """One file per shard: head, hashes, verdicts and host lengths, offsets, strings. Rows come
    sorted by shard and by signed hash."""
    def save(shard: int, rows: list[tuple[int, bytes, bytes, bool]]) -> int:
        rows.sort()
        keys = [_key(h, p) for _, h, p, _ in rows]
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype("<i8")
        out = SharedFile(f"{folder}/shard-{shard:04d}.rules")
        out.write(_HEAD.pack(_MAGIC, len(rows), int(offsets[-1]), len({len(p) for _, _, p, _ in rows})))
        out.write(np.array([r[0] for r in rows], "<u8").tobytes())
        out.write(offsets.tobytes())
        out.write(np.array([r[3] for r in rows], np.uint8).tobytes())
        out.write(b"".join(keys))
        out.close()
        return len(rows)

    held: dict[int, list] = {}
    for batch in batches:
        for r in batch.to_pylist():
            host, path = r["host"].encode(), r["path"].encode()
            held.setdefault(r["shard"], []).append((xxhash.xxh64_intdigest(_key(host, path)), host, path, r["block"]))
    rows = [(s, save(s, x), sorted({len(r[2]) for r in x})) for s, x in held.items()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.list_(pa.int32()))],
        ["shard", "n", "path_lengths"])


def write_rules(rules: DataFrame, folder: str, shards: int = SHARDS) -> list[int]:
    """Write rules (host, path, verdict) as mapped arrays; returns the path lengths (bytes)
    that occur. The number of shards bounds the rules of one task."""
    lower = F.translate(F.coalesce("host", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    clean = rules.select(lower.alias("host"), F.coalesce("path", F.lit("")).alias("path"), (F.col("verdict") == "block").alias("block"))
    unique = clean.groupBy("host", "path").agg(F.max("block").alias("block")).withColumn(
        "shard", F.pmod(F.xxhash64("host", "path"), F.lit(shards)).cast("int"))
    written = unique.repartition(shards, "shard").mapInArrow(partial(_write, folder=folder), "shard int, n bigint, path_lengths array<int>")
    lengths = written.select(F.explode("path_lengths").alias("n")).distinct()
    return sorted(r["n"] for r in lengths.collect())


class MappedRules:
    """The mapped arrays of one shard."""

    def __init__(self, system: fs.FileSystem, path: str):
        if isinstance(system, fs.LocalFileSystem):
            self._map = np.memmap(path, np.uint8, "r")
        else:  # not mountable: fetched once per worker into a file that is gone when it is closed
            with tempfile.NamedTemporaryFile() as copy, system.open_input_stream(path, compression=None) as source:
                while part := source.read(1 << 20):
                    copy.write(part)
                copy.flush()
                self._map = np.memmap(copy.name, np.uint8, "r")
        magic, n, size, _ = _HEAD.unpack(self._map[: _HEAD.size].tobytes())
        if magic != _MAGIC:
            raise ValueError(f"{path} is not a file of rules")
        at = _HEAD.size
        self.digests = self._map[at : at + 8 * n].view("<u8")
        self._offsets = self._map[at + 8 * n : at + 16 * n + 8].view("<i8")
        self._block = self._map[at + 16 * n + 8 : at + 17 * n + 8]
        self._text = self._map[at + 17 * n + 8 : at + 17 * n + 8 + size]

    def find(self, digests: np.ndarray, keys: list[bytes]) -> Iterator[tuple[int, bool]]:
        """(place among the keys, whether it blocks) of each key that is a rule."""
        first = np.searchsorted(self.digests, digests, "left")
        found = np.searchsorted(self.digests, digests, "right") - first
        hit = np.flatnonzero(found)
        for place, row in zip(np.repeat(hit, found[hit]).tolist(), ranges(first[hit], found[hit]).tolist(), strict=True):
            if self._text[self._offsets[row] : self._offsets[row + 1]].tobytes() == keys[place]:
                yield place, bool(self._block[row])


class RuleSet:
    """All shards of a folder of rules."""

    def __init__(self, folder: str, path_lengths: list[int]):
        system, path = open_fs(folder)
        files = [x.path for x in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if x.path.endswith(".rules")]
        self._shards = [MappedRules(system, p) for p in sorted(files)]
        self._lengths = path_lengths

    def judge(self, urls: list[str | None]) -> list[tuple[str, str, str | None, str]]:
        """(host, path, rule, verdict) of each URL."""
        parts = [split_url(u) for u in urls]
        owner, keys = [], []
        for i, (host, path) in enumerate(parts):
            h, p = host.encode(), path.encode()
            prefixes = [p[:n] for n in self._lengths if n <= len(p)]
            while h:
                keys += [_key(h, x) for x in prefixes]
                owner += [i] * len(prefixes)
                h = h.partition(b".")[2]
        digests = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
        best: dict[int, tuple[int, int, str, bool]] = {}
        for shard in self._shards:
            for place, block in shard.find(digests, keys):
                host, _, path = keys[place].partition(b"\0")
                rule = (len(host) + len(path), len(host), (host + path).decode("utf-8", "replace"), block)
                best[owner[place]] = max(best.get(owner[place], rule), rule)
        verdicts = [best.get(i) for i in range(len(parts))]
        return [(h, p, v and v[2], DEFAULT if v is None else "block" if v[3] else "allow") for (h, p), v in zip(parts, verdicts, strict=True)]


def judge(pages: DataFrame, folder: str, path_lengths: list[int], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(id, host, path, rule, verdict) of every row; only ids and URLs are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = None
        for batch in batches:
            rules = rules or RuleSet(folder, path_lengths)
            columns = list(zip(*rules.judge(batch.column(1).to_pylist()), strict=True)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.string()) for c in columns]], ["id", "host", "path", "rule", "verdict"])

    return pages.select(F.col(id_col).cast("bigint").alias("id"), F.col(url_col).alias("url")).mapInArrow(
        run, "id bigint, host string, path string, rule string, verdict string")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str, str]] | DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Write the rules to the shared folder and judge every row by them."""
    spark: SparkSession = pages.sparkSession
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    folder = stage_path(spark, "url-rules")
    return judge(pages, folder, write_rules(rules, folder), id_col, url_col)
