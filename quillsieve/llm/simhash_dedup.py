"""Near-duplicates by SimHash, found with a multi-index of Hamming balls.

The fingerprint's bits are cut into ``segments`` parts. Of two fingerprints within
``distance`` bits, at least one part differs by no more than ``distance // segments``
bits. So each fingerprint stands in the table of a part under its own value (home) and
is looked up under every value of a small Hamming ball around it (visits); whatever
meets there is verified on all 64 bits. Equal fingerprints are one entry of the tables.

A bucket of the tables with more than ``bucket_rows`` rows is not gathered in a task: its
fingerprints are linked through midpoints. Two fingerprints are within 2r bits exactly if
some value lies within r bits of both, so grouping by all values of the ball of radius r
finds the links in a number of rows that is linear in the bucket.

Null and empty texts, and texts of white space, have fingerprint zero and are linked like
any other. Equal rows get equal results; a null id has the component of its fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.common import binary_text, ranges, signed, starts_of
from quillsieve.operators.dedup import connected_components
from quillsieve.session import BROADCAST_ROWS, lookup_join, stage, stage_counted

BITS = 64
HASH_SEED = 42
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEGMENTS = 3
# Largest bucket compared inside a task: its pairs are compared in blocks of numpy rows.
BUCKET_ROWS = 16_384
_CHUNK_ROWS = 200_000
_PAIRS = 4_000_000


def shingle_hashes(raw: bytes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """XXH64 of each shingle of ``size`` words (of all words if there are fewer), after
    lower-casing A-Z and splitting at ASCII white space."""
    words = raw.lower().split()
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, HASH_SEED)] if words else [], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    spans = zip(starts[: 1 - size].tolist() if size > 1 else starts.tolist(), ends[size - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], HASH_SEED) for a, b in spans), np.uint64, len(words) - size + 1)


def fingerprint(raw: bytes | None, size: int = SHINGLE_WORDS) -> int:
    """Bit i is set if it is set in more than half of the shingle hashes."""
    hashes = shingle_hashes(raw or b"", size)
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS, *more: str) -> DataFrame:
    """(id, fp) of every row, fp as a long; ``more`` names columns of longs that go along."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(x, size) for x in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed(found)), *batch.columns[2:]], ["id", "fp", *more])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), binary_text(text_col), *more)
    return narrow.mapInArrow(run, ", ".join(f"{c} bigint" for c in ("id", "fp", *more)))


def ball(bits: int, radius: int) -> np.ndarray:
    """All masks of up to ``radius`` set bits among the lowest ``bits``; zero comes first."""
    masks = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]
    return np.array(masks, np.uint64)


def _parts(segments: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of each part."""
    edges = [BITS * i // segments for i in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _table_rows(batches: Iterator[pa.RecordBatch], distance: int, segments: int) -> Iterator[pa.RecordBatch]:
    """A row for each bucket of a fingerprint. The bucket is hashed from part and value; the
    lowest bit of the key is 0 at home and 1 on a visit."""
    balls = [(low, bits, ball(bits, min(distance // segments, bits))) for low, bits in _parts(segments)]
    for batch in batches:
        fps = np.asarray(batch.column(0)).view(np.uint64)
        for number, (low, bits, masks) in enumerate(balls):
            value = (fps >> np.uint64(low)) & np.uint64((1 << bits) - 1)
            near = value[:, None] ^ masks[None, :]
            key = (near * np.uint64(segments) + np.uint64(number)) << np.uint64(1)
            key[:, 1:] |= np.uint64(1)
            whole = np.repeat(fps, len(masks))
            for at in range(0, key.size, _CHUNK_ROWS):
                part = key.reshape(-1)[at : at + _CHUNK_ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(signed(part)), pa.array(signed(whole[at : at + _CHUNK_ROWS]))], ["key", "fp"])


def _forest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Labels after joining a[i] with b[i]; the smallest index names its tree."""
    while len(a):
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label != label[label]).any():
            label = label[label]
    return label


def _bucket_tree(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect one bucket as all its pairs within the distance do."""
    n, label = len(fps), np.arange(len(fps))
    rows = max(1, _PAIRS // n)
    for at in range(0, n, rows):
        near = np.bitwise_count(fps[at : at + rows, None] ^ fps[None, :]) <= distance
        a, b = np.nonzero(near)
        label = _forest(n, a + at, b, label)
    child = np.flatnonzero(label != np.arange(n))
    return fps[child], fps[label[child]]


def _bucket_links(key: np.ndarray, fp: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links within whole buckets, rows sorted by key so that those at home come first."""
    begin = starts_of(key >> np.uint64(1))
    size = np.diff(np.append(begin, len(key)))
    home = np.add.reduceat((key & np.uint64(1)) == 0, begin).astype(np.int64)
    work = home * size
    for g in np.flatnonzero(work > _PAIRS // 64):
        yield _bucket_tree(np.unique(fp[begin[g] : begin[g] + size[g]]), distance)
    small = np.flatnonzero((home > 0) & (size > 1) & (work <= _PAIRS // 64))
    steps = np.searchsorted(np.cumsum(work[small]), np.arange(0, work[small].sum() + 1, _PAIRS), side="left")
    for lo, hi in zip(steps, np.append(steps[1:], len(small)), strict=True):
        groups = small[lo:hi]
        left = ranges(begin[groups], home[groups])
        rest = np.repeat(begin[groups] + size[groups], home[groups]) - left - 1
        a, b = np.repeat(left, rest), ranges(left + 1, rest)
        near = np.bitwise_count(fp[a] ^ fp[b]) <= distance
        yield fp[a[near]], fp[b[near]]


def _links(batches: Iterator[pa.RecordBatch], distance: int, bucket_rows: int) -> Iterator[pa.RecordBatch]:
    """(a, b, full): verified links; a bucket that is too large gives one row with its
    number as ``full`` and is passed over."""
    def links(keys: list, fps: list) -> Iterator[pa.RecordBatch]:
        if keys:
            for a, b in _bucket_links(np.concatenate(keys), np.concatenate(fps), distance):
                differ = a != b
                yield pa.RecordBatch.from_arrays(
                    [pa.array(signed(a[differ])), pa.array(signed(b[differ])), pa.nulls(int(differ.sum()), pa.int64())], ["a", "b", "full"])

    keys: list[np.ndarray] = []
    fps: list[np.ndarray] = []
    rows, passed = 0, None
    for batch in batches:
        key, fp = np.asarray(batch.column(0)).view(np.uint64), np.asarray(batch.column(1)).view(np.uint64)
        if passed is not None:
            fresh = key >> np.uint64(1) != passed
            key, fp = key[fresh], fp[fresh]
        if not len(key):
            continue
        keys.append(key)
        fps.append(fp)
        rows += len(key)
        if rows < max(_CHUNK_ROWS, 2 * bucket_rows):
            continue
        key, fp = np.concatenate(keys), np.concatenate(fps)
        bucket = key >> np.uint64(1)
        begin = starts_of(bucket)
        size = np.diff(np.append(begin, len(key)))
        full = size > bucket_rows
        for at in begin[full]:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array(signed(bucket[at : at + 1]))], ["a", "b", "full"])
        passed = bucket[-1] if full[-1] else None
        ripe = np.repeat(~full, size)
        ripe[begin[-1] :] = False
        yield from links([key[ripe]], [fp[ripe]])
        last = slice(begin[-1] if passed is None else len(key), None)
        keys, fps = [key[last]], [fp[last]]
        rows = len(keys[0])
    if rows:
        key, fp = np.concatenate(keys), np.concatenate(fps)
        bucket = key >> np.uint64(1)
        begin = starts_of(bucket)
        size = np.diff(np.append(begin, len(key)))
        full = size > bucket_rows
        for at in begin[full]:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array(signed(bucket[at : at + 1]))], ["a", "b", "full"])
        ripe = np.repeat(~full, size)
        yield from links([key[ripe]], [fp[ripe]])


def _midpoint_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links among fingerprints through the values within half the distance of both; for an
    odd distance the half is rounded up and the links are verified."""
    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = ball(BITS, (distance + 1) // 2)
        for batch in batches:
            own = np.asarray(batch.column(0)).view(np.uint64)
            for at in range(0, len(own), 64):
                part = own[at : at + 64]
                near = (part[:, None] ^ masks[None, :]).reshape(-1)
                yield pa.RecordBatch.from_arrays([pa.array(signed(near)), pa.array(signed(np.repeat(part, len(masks))))], ["mid", "fp"])

    mids = fps.mapInArrow(around, "mid bigint, fp bigint")
    if distance % 2:  # two fingerprints around a value may be one bit too far apart
        other = mids.withColumnRenamed("fp", "b")
        return mids.withColumnRenamed("fp", "a").join(other, "mid").where(
            (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        ).select("a", "b").distinct()
    first = stage(mids.groupBy("mid").agg(F.min("fp").alias("b"), F.max("fp").alias("top")).where("b < top").select("mid", "b"), "midpoints")
    return mids.join(first, "mid").where("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def links(fps: DataFrame, distance: int = MAX_DISTANCE, segments: int = SEGMENTS, bucket_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """(a, b) links that connect distinct fingerprints (column ``fp``) exactly as all pairs
    within the distance do, and their number."""
    rows = fps.select("fp").mapInArrow(partial(_table_rows, distance=distance, segments=segments), "key bigint, fp bigint")
    placed = rows.repartition(F.shiftrightunsigned("key", 1)).sortWithinPartitions("key")
    found, n = stage_counted(placed.mapInArrow(
        partial(_links, distance=distance, bucket_rows=bucket_rows), "a bigint, b bigint, full bigint"), "simhash-links")
    pairs = found.where("full IS NULL").select("a", "b")
    full = found.where("full IS NOT NULL").select(F.col("full").alias("bucket")).distinct()
    if not full.isEmpty():
        crowded = lookup_join(rows.withColumn("bucket", F.shiftrightunsigned("key", 1)), full, ["bucket"], "left_semi").select("fp").distinct()
        pairs, n = stage_counted(pairs.unionByName(_midpoint_links(stage(crowded, "simhash-crowded"), distance)), "simhash-all-links")
    return pairs, n


def _rooted(own: DataFrame, distance: int, segments: int, bucket_rows: int) -> tuple[DataFrame, int]:
    """(fp, root, component) of each fingerprint of a staged (id, fp): a fingerprint that names
    the component, and the smallest id in it; and their number."""
    distinct, n = stage_counted(own.groupBy("fp").agg(F.min("id").alias("first")), "simhash-distinct")
    pairs, found = links(distinct, distance, segments, bucket_rows)
    if not found:
        return distinct.select("fp", F.col("fp").alias("root"), F.col("first").alias("component")), n
    trees = connected_components(pairs, found).select(F.col("id").alias("fp"), F.col("component").alias("root"))
    rooted = stage(lookup_join(distinct, trees, ["fp"], "left", bound=2 * found).select(
        "fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-trees")
    least = rooted.groupBy("root").agg(F.min("first").alias("component"))
    return lookup_join(rooted, least, ["root"], "inner", bound=n).select("fp", "root", "component"), n


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
    segments: int = SEGMENTS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(id, fp, component) of every row: the component is the smallest id reachable over
    links of at most ``distance`` bits, its own included."""
    own = stage(fingerprints(docs, id_col, text_col, size), "simhash")
    named, n = _rooted(own, distance, segments, bucket_rows)
    return lookup_join(own, named.select("fp", "component"), ["fp"], "inner", bound=n).select("id", "fp", "component")


def drop_near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    distance: int = MAX_DISTANCE,
    segments: int = SEGMENTS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row of each component: that with the smallest id, of several the one with the least
    hash of its columns. Rows are told apart by id and that hash, so a row with another text
    is not taken for its namesake. A row with a null id cannot be named and stays."""
    hashed = [F.col(f"row.`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row")[id_col].cast("bigint").alias("id"), F.col("row")[text_col].alias("text"), F.xxhash64(*hashed).alias("mark"))
    own = stage(fingerprints(rows, "id", "text", size, "mark"), "simhash")
    named, n = _rooted(own, distance, segments, bucket_rows)
    members = stage(lookup_join(own.where("id IS NOT NULL"), named.select("fp", "root"), ["fp"], "inner", bound=n).select("id", "mark", "root"), "simhash-members")
    first = members.groupBy("root").agg(F.min(F.struct("id", "mark")).alias("first")).select("root", "first.*")
    several = members.groupBy("root", "id", "mark").agg(F.count(F.lit(1)).alias("rows"))
    kept, alike = stage_counted(several.join(first, ["root", "id", "mark"]).where("rows > 1").select("id", "mark"), "simhash-alike")
    # what goes is the smaller part; rows that do not stay are told by id and hash
    gone = members.select("id", "mark").distinct().join(first.select("id", "mark"), ["id", "mark"], "left_anti")
    left = rows.join(gone, ["id", "mark"], "left_anti")
    if alike:  # rows that are equal in all columns
        left = left.join(F.broadcast(kept) if alike <= BROADCAST_ROWS else kept, ["id", "mark"], "left_anti").unionByName(
            left.join(F.broadcast(kept) if alike <= BROADCAST_ROWS else kept, ["id", "mark"], "left_semi").dropDuplicates(["id", "mark"]))
    return left.select("row.*")
