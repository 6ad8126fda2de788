"""Shards of near equal size by best-fit-decreasing bin packing of indivisible groups.

Equal texts are a group and stay together. Items are packed in order of falling size: each
enters the open bin with the least room in which it fits, found in a balanced search tree of
the rooms, and opens a bin when it fits nowhere.

A given number of shards (:func:`balance`) searches the smallest capacity at which so many
bins suffice, on the driver: groups of more than ``1/large_share`` of all bytes are items of
their own, so there are fewer than ``large_share`` of them; the others are bundled by a
hash of the group into at most ``bundles`` items, which are small beside a shard.

A fixed capacity (:func:`pack`) is met by as few shards as the packing gives, however many
those are: items are dealt to hash ranges of some ``RANGE_BINS`` bins, which are packed side
by side in tasks. Groups below ``1/256`` of the capacity are bundled to about a 64th of it; a
bundle that got larger than a 16th is packed by its groups. The bins that a range leaves
less than half full, one at most, are packed together on the driver.

Null texts are empty and form one group with the empty ones. Repeated rows are rows of
their own. An empty table gives no shards. A group larger than the capacity has a bin to
itself.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.session import lookup_join, stage, stage_counted

LARGE_SHARE = 2_000
BUNDLES = 16_384
# Bins of one hash range, and parts of a capacity: of a group that is bundled, of a bundle.
RANGE_BINS = 256
_TINY = 256
_BUNDLE = 64
ROW_BYTES = 8
# Parts of a shard in which rows are numbered side by side.
SLOT_CELLS = 4_096


class RoomTree:
    """Rooms of open bins in a search tree that a heap order of hashes keeps balanced (treap).
    Entries are (room, bin)."""

    def __init__(self):
        self._root = None

    @staticmethod
    def _rank(entry: tuple[int, int]) -> int:
        return (entry[1] * 0x9E3779B97F4A7C15 + entry[0] * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF

    def _split(self, node, entry):
        """(entries below, others)."""
        if node is None:
            return None, None
        own, left, right = node
        if own < entry:
            low, high = self._split(right, entry)
            return (own, left, low), high
        low, high = self._split(left, entry)
        return low, (own, high, right)

    def _merge(self, low, high):
        if low is None or high is None:
            return low or high
        if self._rank(low[0]) > self._rank(high[0]):
            return low[0], low[1], self._merge(low[2], high)
        return high[0], self._merge(low, high[1]), high[2]

    def add(self, room: int, number: int) -> None:
        low, high = self._split(self._root, (room, number))
        self._root = self._merge(self._merge(low, ((room, number), None, None)), high)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return the tightest (room, bin) with room for ``size``."""
        low, high = self._split(self._root, (size, -1))
        best, node = None, high
        while node is not None:
            best, node = node[0], node[1]
        if best is None:
            return None
        _, rest = self._split(high, (best[0], best[1] + 1))
        self._root = self._merge(low, rest)
        return best


def pack(sizes: list[int], capacity: int, limit: int | None = None) -> list[int] | None:
    """Bin of each size; None if more than ``limit`` bins would be opened."""
    rooms, bins, out = RoomTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = rooms.take(sizes[i])
        if found is None:
            if limit is not None and bins == limit:
                return None
            found = (max(capacity, sizes[i]), bins)
            bins += 1
        out[i] = found[1]
        rooms.add(found[0] - sizes[i], found[1])
    return out


def balance(sizes: list[int], shards: int) -> list[int]:
    """Bin of each size with about the smallest capacity at which ``shards`` bins suffice."""
    if not sizes:
        return []
    low, high = max(max(sizes), -(-sum(sizes) // shards)), max(sizes) + 2 * (-(-sum(sizes) // shards))
    best = pack(sizes, high, shards)
    if found := pack(sizes, low, shards):
        return found
    while best is None:
        high *= 2
        best = pack(sizes, high, shards)
    while high - low > max(1, low // 10_000):
        middle = (low + high) // 2
        found = pack(sizes, middle, shards)
        if found is None:
            low = middle
        else:
            best, high = found, middle
    return best


def _packed_ranges(groups: DataFrame, capacity: int, total: int) -> DataFrame:
    """(digest, shard) of the groups (digest, bytes) by shards of a fixed capacity."""
    spark = groups.sparkSession
    tiny = F.col("bytes") <= capacity // _TINY
    small_total = groups.where(tiny).agg(F.sum("bytes")).first()[0] or 0
    bundles = max(1, -(-small_total * _BUNDLE // capacity))
    # the item of a group: its bundle, or itself
    bundle = F.when(tiny, F.pmod(F.xxhash64("digest"), F.lit(bundles)))
    named = stage(groups.withColumn("bundle", bundle), "shard-items")
    sizes = named.where("bundle IS NOT NULL").groupBy("bundle").agg(F.sum("bytes").alias("size"))
    too_large, n = stage_counted(sizes.where(F.col("size") > capacity // 16).select("bundle", F.lit(True).alias("split")), "shard-split")
    if n:
        named = named.join(too_large, "bundle", "left").withColumn("bundle", F.when(F.col("split").isNull(), F.col("bundle"))).drop("split")
    item = F.coalesce(F.concat(F.lit("b"), F.col("bundle").cast("string")), F.concat(F.lit("g"), F.hex("digest")))
    named = stage(named.withColumn("item", item), "shard-named")
    ranges = max(1, -(-total // (capacity * RANGE_BINS)))
    items = named.groupBy("item").agg(F.sum("bytes").alias("bytes")).withColumn("range", F.pmod(F.xxhash64("item"), F.lit(ranges)))

    def one_range(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["bytes", "item"], ascending=[False, True])
        bins = pack(own["bytes"].tolist(), capacity)
        return pd.DataFrame({"item": own["item"], "range": own["range"], "bin": bins, "bytes": own["bytes"]})

    packed = stage(items.groupBy("range").applyInPandas(one_range, "item string, range bigint, bin int, bytes bigint"), "shard-bins")
    bins = packed.groupBy("range", "bin").agg(F.sum("bytes").alias("bytes"))
    # a number per range of bins: how many there are, and the one at most that is half empty
    loose = F.col("bytes") <= capacity // 2
    per_range = bins.groupBy("range").agg(F.count_if(~loose).alias("full"), F.max(F.when(loose, F.struct("bin", "bytes"))).alias("loose")).orderBy("range").collect()
    left = [(r["range"], r["loose"]["bin"], r["loose"]["bytes"]) for r in per_range if r["loose"] is not None]
    joined = pack([x[2] for x in left], capacity)
    full = sum(r["full"] for r in per_range)
    first, before = {}, 0
    for r in per_range:
        first[r["range"]] = before
        before += r["full"]
    shared = {x[0]: (x[1], full + j) for x, j in zip(left, joined, strict=True)}
    table = spark.createDataFrame([(g, f, *shared.get(g, (None, None))) for g, f in first.items()], "range bigint, first bigint, loose int, shared bigint")
    # bins are numbered in their range without the half empty one
    own = F.col("bin") - F.coalesce((F.col("bin") > F.col("loose")).cast("int"), F.lit(0))
    shard = F.when(F.col("bin") == F.col("loose"), F.col("shared")).otherwise(F.col("first") + own).cast("int")
    placed = packed.join(F.broadcast(table), "range").select("item", shard.alias("shard"))
    return named.join(placed, "item").select("digest", "shard")


def assign(docs: DataFrame, shards: int | None = None, capacity: int | None = None, id_col: str = "doc_id", text_col: str = "text",
           large_share: int = LARGE_SHARE, bundles: int = BUNDLES) -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row, for a number of shards of near equal
    size or for as few shards as possible of a fixed capacity."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stage(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("digest"),
    ), "shard-rows")
    groups = stage(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    if capacity is not None:
        placed = lookup_join(rows, _packed_ranges(groups, capacity, total), ["digest"], "inner")
        return with_slots(placed.select("id", "size", "text_crc32", "shard"))
    large = groups.where(F.col("bytes") > total / large_share)
    bundle = F.pmod(F.xxhash64("digest"), F.lit(bundles))
    small = groups.where(F.col("bytes") <= total / large_share).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes"))
    items = [(bytes(r["digest"]), None, r["bytes"]) for r in large.collect()] + [(None, r["bundle"], r["bytes"]) for r in small.collect()]
    items.sort(key=lambda r: (-r[2], r[0] or b"", r[1] or 0))
    sizes = [r[2] for r in items]
    bins = balance(sizes, shards)
    own = spark.createDataFrame([(r[0], b) for r, b in zip(items, bins, strict=True) if r[0] is not None], "digest binary, own int")
    shared = spark.createDataFrame([(r[1], b) for r, b in zip(items, bins, strict=True) if r[0] is None], "bundle bigint, shared int")
    # at most large_share and bundles rows
    placed = rows.join(F.broadcast(own), "digest", "left").withColumn("bundle", bundle).join(F.broadcast(shared), "bundle", "left")
    return with_slots(placed.withColumn("shard", F.coalesce("own", "shared")).select("id", "size", "text_crc32", "shard"))


def with_slots(placed: DataFrame, cells: int = SLOT_CELLS) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in order of a cell of their id and
    of the id in it, so that no task numbers a whole shard."""
    celled = stage(placed.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(cells))), "shard-cells")
    counts = celled.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("shard", "cell").orderBy("id", "text_crc32", "size")
    return celled.join(first, ["shard", "cell"]).withColumn("slot", (F.col("first") + F.row_number().over(inside) - 1).cast("bigint")).drop("cell", "first")
