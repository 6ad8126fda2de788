"""Document fingerprints: SimHash over weighted terms, and permuted block tables.

A term is a pair of neighbouring words (a single word if the text has one only), lower-cased; its
weight is 1 + log of its count. Each bit of a term's hash votes with the weight for 1
or against it, and the sign of the sum is the bit of the fingerprint. The likeness of
two fingerprints is the share of equal bits.

To find the fingerprints within ``radius`` bits, the bits are cut into ``blocks`` blocks.
Two such fingerprints agree in at least ``blocks - radius`` of them, so there is a table
for every choice of that many blocks, keyed by their bits (permuted to the front), and
what meets in a table is verified on all bits.

Null and empty texts have no terms and the fingerprint zero. Equal texts have equal
fingerprints. The document after another is the next by ascending id; null ids come first
and equal ids follow the order of their texts; the first follows the last.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import slices
from quillsieve.session import stage

BITS = 128
BLOCKS = 8
RADIUS = 6
SHARD_BYTES = 32 << 20
_CACHE_WORDS = 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TERMS = 1 << 13


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64 (multiply and shift twice)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (x ^ (x >> np.uint64(29))) * _ODD ^ (x >> np.uint64(32))


class Fingerprinter:
    """Fingerprints of texts; the hashes of words are remembered."""

    def __init__(self):
        self._known: dict[str, int] = {}

    def _word_hashes(self, text: str) -> np.ndarray:
        words = text.lower().split()
        known = self._known
        if len(known) > _CACHE_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    def bits(self, text: str) -> np.ndarray:
        """The fingerprint as bytes, most significant bit first."""
        words = self._word_hashes(text)
        if not len(words):
            return np.zeros(BITS // 8, np.uint8)
        terms = words[:-1] * _ODD + ((words[1:] << np.uint64(27)) | (words[1:] >> np.uint64(37))) if len(words) > 1 else words
        terms, count = np.unique(terms, return_counts=True)
        weight = (1 + np.log(count)).astype(np.float32)
        votes = np.zeros(BITS)
        for at in range(0, len(terms), _TERMS):
            part = terms[at : at + _TERMS]
            both = np.stack([_mixed(part), _mixed(part + _ODD)], axis=1)
            signs = np.unpackbits(both.view(np.uint8).reshape(len(part), -1), axis=1).astype(np.float32)
            own = weight[at : at + _TERMS]
            votes += 2 * (own @ signs) - own.sum()
        return np.packbits(votes > 0)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return 1 - int(np.bitwise_count(a ^ b).sum()) / BITS


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_RESULT = "id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_PLACED = "shard bigint, edge string, text string, " + _RESULT


def _compare(make: Fingerprinter, doc_id, text: str, print_: np.ndarray, following: str, next_print: np.ndarray) -> tuple:
    changed = edited(text, following)
    changed_print = make.bits(changed)
    return (doc_id, len(text), sha256(changed.encode()).hexdigest(), print_.tobytes().hex(), changed_print.tobytes().hex(),
            likeness(print_, changed_print), likeness(print_, next_print))


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_ARROW_RESULT = [("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                 ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_ARROW_PLACED = pa.schema([("shard", pa.int64()), ("edge", pa.string()), ("text", pa.string()), *_ARROW_RESULT])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted shard against the next one. The shard's first and last rows also
    come out with their texts, for the neighbours beyond the shard."""
    make, shard, before = Fingerprinter(), TaskContext.get().partitionId(), None
    for whole in batches:
        for batch in slices(whole):
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                now = (doc_id, text, make.bits(text))
                if before is None:
                    out.append((shard, "first", text, doc_id, *[None] * 6))
                else:
                    out.append((shard, None, None, *_compare(make, *before, *now[1:])))
                before = now
            yield _rows(out, _ARROW_PLACED)
    if before is not None:
        yield _rows([(shard, "last", before[1], before[0], *[None] * 6)], _ARROW_PLACED)


def _over_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make = Fingerprinter()
    for batch in batches:
        yield _rows([_compare(make, r["id"], r["text"], make.bits(r["text"]), r["following"], make.bits(r["following"])) for r in batch.to_pylist()],
                    pa.schema(_ARROW_RESULT))


def compare_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = None) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text and their likeness. The
    texts are sorted by id in one shuffle; only the first and last text of a shard move
    once more."""
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if shards is None:
        size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(docs.sparkSession.sparkContext.defaultParallelism, -(-size // SHARD_BYTES))
    placed = narrow.repartitionByRange(shards, "id").sortWithinPartitions("id", "text").mapInArrow(_neighbours, _PLACED)
    out = stage(placed, "simhash-neighbours")
    # one number per shard: the rank of the shards that have rows
    rank = Window.orderBy("shard")
    ranked = out.where("edge = 'last'").select("shard").withColumn("rank", F.row_number().over(rank)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    edges = out.where("edge IS NOT NULL").select("shard", "edge", "id", "text").join(ranked, "shard")
    heads = edges.where("edge = 'first'").select(F.col("text").alias("following"), F.when(F.col("rank") == 1, F.col("n")).otherwise(F.col("rank") - 1).alias("rank"))
    tails = edges.where("edge = 'last'").select("id", "text", "rank").join(heads, "rank").select("id", "text", "following")
    return out.where("edge IS NULL").drop("shard", "edge", "text").unionByName(tails.mapInArrow(_over_edges, _RESULT))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row, in hex."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Fingerprinter()
        for whole in batches:
            for batch in slices(whole):
                prints = [make.bits(t).tobytes().hex() for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["id", "fingerprint"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return narrow.mapInArrow(run, "id bigint, fingerprint string")


def _table_keys(fingerprint: np.ndarray, blocks: int, radius: int) -> np.ndarray:
    """Key of each fingerprint (rows of bytes) in each table."""
    bits = np.unpackbits(fingerprint, axis=1)
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        front = np.packbits(np.concatenate([bits[:, edges[b] : edges[b + 1]] for b in chosen], axis=1), axis=1)
        keys.append([xxhash.xxh3_64_intdigest(row.tobytes(), number) for row in front])
    return np.array(keys, np.uint64).T.view(np.int64)


def within_radius(fingerprints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(query, fingerprint, differing) for all distinct fingerprints (column ``fingerprint``)
    within the radius of each distinct query fingerprint; rows with the same fingerprint are
    found through it. The tables are joined by a shuffle and equal fingerprints stand once."""
    if radius >= blocks:
        raise ValueError("the radius must be smaller than the number of blocks")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.frombuffer(bytes.fromhex("".join(batch.column(0).to_pylist())), np.uint8).reshape(-1, BITS // 8)
            keys = _table_keys(raw, blocks, radius)
            rows = np.repeat(np.arange(len(raw)), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pc.take(batch.column(0), pa.array(rows)), pa.array(keys.reshape(-1))], ["fingerprint", "key"])

    def tables(df: DataFrame) -> DataFrame:
        return df.select("fingerprint").where("fingerprint IS NOT NULL").distinct().mapInArrow(placed, "fingerprint string, key bigint")

    def half(name: str, at: int):
        return F.conv(F.substring(name, at, 16), 16, -10).cast("bigint")

    met = tables(queries).withColumnRenamed("fingerprint", "query").join(tables(fingerprints), "key")
    differ = sum((F.bit_count(half("query", at).bitwiseXOR(half("fingerprint", at))) for at in range(1, BITS // 4, 16)), F.lit(0))
    return met.withColumn("differing", differ).where(F.col("differing") <= radius).select("query", "fingerprint", "differing").distinct()
