"""Exact and near duplicates.

Near duplicates are rows whose texts have a Jaccard similarity of at least a threshold
on word 3-shingles; clusters are the connected components of that relation, and the
best row of a cluster stays. The result equals comparing every pair, but pairs are
only formed where needed:

1. Exact duplicates are folded first, so a group of identical copies is one node.
2. A text with so many shingles of its own that the rest is no sufficient overlap is similar to
   none. Shingles of a band of the hash space are counted over all texts, and texts that
   have enough of their own in the band go. Most texts of a corpus do, so whole sets, which take
   several times the room of the texts, are made and kept for the others only.
   Their shingles are counted again, among themselves, and put in a common order, rare
   ones before frequent ones. Two similar sets share a shingle in their prefixes
   (prefix filter). A shingle of one set only takes a place in its prefix but is never
   looked up, so texts of their own that share boilerplate have prefixes without partners.
3. Rows that share a prefix shingle form a bucket. Buckets are compared pairwise from the
   smallest on, as long as the pairs are at most a fixed multiple of the rows; pairs whose sizes or places in
   the order leave too little room for the rest of the overlap go before any sets move.
4. A large bucket, such as many near copies of one text, is compared with a few
   pivots instead. Jaccard distance is a metric: a row within the limit of a pivot
   and closer to it than any row outside by more than the limit cannot be linked
   to anything but rows that are linked to the pivot too, so it leaves the bucket with that one
   edge. Only edges that the components do not need are left out.
5. What pivots do not settle, such as unlike texts with a frequent shingle in common, is
   dealt out again by a further shingle: two similar sets also share a second one in
   prefixes that are longer by one, a third one, and so on. Where that does not make fewer pairs, as
   among many near copies at all distances, the buckets stay and are allowed more pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.fixed_values import SIMILARITY_THRESHOLD
from quillsieve.functions.keys import hash60
from quillsieve.functions.text import normalized
from quillsieve.session import BROADCAST_ROWS, lookup_join, spread, stage, stage_counted

SHINGLE_WORDS = 3
BUCKET_ROWS = 32
_PIVOTS = 4
_PAIRED_ROWS = 2048  # largest bucket that is compared pairwise, as one task does it
# Shingles that a bucket can have in common before it is worked off by pivots alone.
_DEPTH = 6
# The band, as a multiple of the share of a set that is its prefix. Up to so many rows all whole
# sets are kept.
_BAND, _WHOLE_ROWS = 1.6, 20_000
_ID_ROWS = 1_000_000  # ids of texts that are broadcast, so that the texts stay where they are
_SET_ROWS = 500  # sets are wide (up to one shingle per word), so few are broadcast
_COLD_PAIRS = 1_000_000  # with fewer pairs no key can be hot enough to matter
_EPS = 1e-9


def text_key(text: Column) -> Column:
    """128-bit key of the normalised whole text."""
    return F.md5(normalized(text))


def _best(score: Column, id_col: str = "id") -> Column:
    """Smallest is best: highest score, then smallest id. A missing score is worst."""
    return F.min(F.struct(F.coalesce(-score, F.lit(float("inf"))).alias("s"), F.col(id_col).alias("id")))


def exact_keepers(df: DataFrame, text: Column, score: Column) -> DataFrame:
    """One row per distinct text: (text_key, keeper, copies). Only key, score and id are
    shuffled, combined first, so a text that fills a third of the table is cheap."""
    return _keepers(df.select(text_key(text).alias("text_key"), score.cast("double").alias("score"), "id"))


def _keepers(rows: DataFrame) -> DataFrame:
    grouped = rows.groupBy("text_key").agg(_best(F.col("score")).alias("b"), F.count(F.lit(1)).alias("copies"))
    return grouped.select("text_key", F.col("b.id").alias("keeper"), "copies")


def drop_exact_duplicates(df: DataFrame, text: Column, score: Column) -> DataFrame:
    """Keep the best row of each distinct text. Only keys, scores and ids are shuffled to
    find the copies that go; as long as those are few, the wide rows meet them in a
    broadcast and stay where they are. Rows that share id and text are one row's copies
    and stay or go together."""
    narrow = stage(df.select(text_key(text).alias("text_key"), score.cast("double").alias("score"), "id"), "text-keys")
    copies = lookup_join(narrow, _keepers(narrow).where("copies > 1"), ["text_key"], "inner").where("id <> keeper").select("id").distinct()
    return lookup_join(df, copies, ["id"], "left_anti")


def shingle_sets(df: DataFrame, text: Column) -> DataFrame:
    """(id, shingles, size): distinct 64-bit hashes of the word 3-shingles of the whole
    text. Texts with fewer than three words have no row."""
    tokens = df.select("id", F.split(normalized(text), " ").alias("w"))
    w = F.col("w")
    grams = F.transform(
        F.sequence(F.lit(0), F.size(w) - SHINGLE_WORDS),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
    )
    long_ones = tokens.where(F.size(w) >= SHINGLE_WORDS)
    return long_ones.select("id", F.array_distinct(grams).alias("shingles")).withColumn("size", F.size("shingles"))


def band_share(threshold: float, rows: int) -> float:
    """Share of the hash space whose shingles are counted over all texts; 1 if that spares nothing."""
    return 1.0 if rows <= _WHOLE_ROWS else min(1.0, _BAND * (1 - threshold))


def texts_with_company(texts: DataFrame, threshold: float, share: float) -> DataFrame:
    """The ``texts`` (id, text) without those that are similar to no other, as far as a band of the
    hash space shows it: a set with as many shingles of its own as its prefix has places shares too
    few with any other. Rows are told apart by a hash of id and text, as ids may repeat."""
    row = F.xxhash64("id", "text")
    sets = shingle_sets(texts.select(row.alias("id"), "text"), F.col("text"))
    # outer, because a filter on the size of what is exploded would be moved in front of the sets
    shingles = sets.select("id", _prefix(F.col("size"), threshold).alias("needed"), F.explode_outer("shingles").alias("shingle"))
    band = shingles.where(F.shiftrightunsigned("shingle", 40) < int(share * 2**24))
    own = band.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("row"), F.min("needed").alias("needed")).where("n = 1")
    alone = own.groupBy("row").agg(F.count(F.lit(1)).alias("own"), F.min("needed").alias("needed")).where("own >= needed").select("row")
    return lookup_join(texts.withColumn("row", row), alone, ["row"], "left_anti", max_rows=_ID_ROWS).drop("row")


def ordered_shingles(sets: DataFrame, threshold: float) -> DataFrame:
    """(id, size, shingle, place) of the shingles that the prefixes of up to ``_DEPTH`` more places
    have and that other sets have too, as a staged table. The places of a set go from 1, by the
    number of sets with the shingle. Those that no other set has come first and have no row."""
    every = sets.select("id", F.explode("shingles").alias("shingle"))
    # counted where they meet: a count that is joined back would move all shingles twice
    shared = every.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("shingle"))).where("n > 1")
    shared = shared.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("n", "shingle"))).alias("shared"))
    lines = sets.groupBy("id").agg(F.max("size").alias("size")).join(shared, "id")
    own = F.col("size") - F.size("shared")
    placed = F.transform("shared", lambda h, i: F.struct(h["shingle"].alias("shingle"), (own + i + 1).alias("place")))
    reach = _prefix(F.col("size"), threshold) + _DEPTH
    return stage(lines.select("id", "size", F.inline(placed)).where(F.col("place") <= reach), "ordered-shingles")


def _least_overlap(size: Column, threshold: float) -> Column:
    return F.ceil(size * threshold - _EPS).cast("int")


def _prefix(size: Column, threshold: float) -> Column:
    """Places of a prefix: two similar sets share a shingle in theirs."""
    return size - _least_overlap(size, threshold) + 1


def prefix_postings(ordered: DataFrame, threshold: float) -> DataFrame:
    """(token, id, size, place) of the prefix shingles of each set."""
    return ordered.where(F.col("place") <= _prefix(F.col("size"), threshold)).select(
        F.col("shingle").alias("token"), "id", "size", "place")


def _deeper(left: DataFrame, ordered: DataFrame, depth: int, threshold: float) -> DataFrame:
    """Rows of a bucket dealt out by a further shingle behind the last one: the pairs of a
    bucket of ``depth`` common shingles share one more in prefixes of ``depth`` places more.
    Two sets so small that they may have no more in common also meet again as they are."""
    again = left.where(_least_overlap(F.col("size"), threshold) <= depth).withColumn("token", F.xxhash64("token", F.lit("again")))
    further = ordered.where(F.col("place") <= _prefix(F.col("size"), threshold) + depth).select(
        "id", "shingle", F.col("place").alias("next"))
    return left.join(further, "id").where(F.col("next") > F.col("place")).select(
        F.xxhash64("token", "shingle").alias("token"), "id", "size", F.col("next").alias("place")).unionByName(again)


def similarities(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Add the Jaccard similarity ``jaccard`` to distinct pairs (a, b) of the ``sets`` (id,
    shingles, size). Only sets that some pair needs are moved. A pivot can be the b
    side of very many pairs, so large pair tables take the join that treats hot keys
    apart."""
    pairs, n = stage_counted(pairs, "pairs")

    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = stage(lookup_join(sets, ids, ["id"], "left_semi", max_rows=_ID_ROWS, bound=2 * n), "pair-sets")
    left, right = (sets.select(F.col("id").alias(x), F.col("shingles").alias(f"s{x}"), F.col("size").alias(f"n{x}")) for x in "ab")
    both = pairs.join(left, "a")
    if n <= _COLD_PAIRS:
        both = both.join(right, "b")
    else:
        both = lookup_join(both, right, ["b"], "inner", max_rows=_SET_ROWS, hot_share=_SET_ROWS)
    common = F.size(F.array_intersect("sa", "sb"))
    return both.withColumn("jaccard", common / (F.col("na") + F.col("nb") - common)).drop("sa", "sb", "na", "nb")


def _sized_alike(a: Column, b: Column, limit: float) -> Column:
    return F.least(a, b) >= F.greatest(a, b) * limit - _EPS


def _bucket_pairs(postings: DataFrame, threshold: float) -> DataFrame:
    """Distinct pairs of small buckets that pass the size and the place filter. If the shingles of
    the bucket are the first that a pair shares, all others lie behind their places."""
    a = postings.select("token", F.col("id").alias("a"), F.col("size").alias("na"), F.col("place").alias("pa"), "depth")
    b = postings.select("token", F.col("id").alias("b"), F.col("size").alias("nb"), F.col("place").alias("pb"), F.col("depth").alias("db"))
    joined = a.join(b, "token").where((F.col("a") < F.col("b")) & (F.col("depth") == F.col("db")) & _sized_alike(F.col("na"), F.col("nb"), threshold))
    most = F.col("depth") + F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    needed = (F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - _EPS
    return joined.where(most >= needed).select("a", "b").distinct()


def _with_bucket_size(postings: DataFrame) -> tuple[DataFrame, int]:
    """Buckets of two and more rows with their size and smallest id, and the number of
    rows in buckets, as a staged table."""
    buckets = postings.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1")
    return stage_counted(lookup_join(postings, buckets, ["token"], "inner", counted="n"), "postings")


def _pairs_by_size(postings: DataFrame) -> list[tuple[int, int]]:
    """Bucket sizes and the pairs that the buckets of that size have in all, smallest first."""
    return sorted((r["n"], r["count"] * (r["n"] - 1) // 2) for r in postings.groupBy("n").count().collect())


def _paired_size(pairs: list[tuple[int, int]], bucket_rows: int, allowed: int) -> int:
    """Size up to which buckets are compared pairwise: ``bucket_rows``, and more as long as there
    are at most ``allowed`` pairs."""
    most, total = bucket_rows, 0
    for n, more in pairs:
        total += more
        if total > allowed or n > _PAIRED_ROWS:
            break
        most = max(most, n)
    return most


def similar_edges(
    texts: DataFrame, threshold: float = SIMILARITY_THRESHOLD, bucket_rows: int = BUCKET_ROWS, share: float = 1.0
) -> tuple[DataFrame, int]:
    """Edges (a, b) of true pairs of ``texts`` (id, text) whose components are those of all true
    pairs, as a staged table, and their number."""
    limit = 1.0 - threshold
    if share < 1:
        texts = texts_with_company(texts, threshold, share)
    sets = stage(shingle_sets(texts, F.col("text")), "sets")
    ordered = ordered_shingles(sets, threshold)
    active, rows = _with_bucket_size(prefix_postings(ordered, threshold))
    depth, rounds, edges, small, allowed = 1, 0, [], [], bucket_rows * rows // 2

    def parted(table: DataFrame, pairs: list[tuple[int, int]]) -> DataFrame:
        most = _paired_size(pairs, bucket_rows, allowed << rounds)
        small.append(table.where(F.col("n") <= most).select("token", "id", "size", "place", F.lit(depth).alias("depth")))
        return table.where(F.col("n") > most)

    active = parted(active, _pairs_by_size(active))
    while rows and not active.isEmpty():
        # the same hash in every bucket: rows that share many buckets share their pivots
        wanted = _PIVOTS * 2 ** max(0, rounds - 2 * _DEPTH)
        drawn = hash60(F.lit(str(rounds)), F.col("id")) / F.lit(2.0**60) * F.col("n") < wanted
        pivots = active.where(drawn | (F.col("id") == F.col("first"))).select(
            "token", F.col("id").alias("b"), F.col("size").alias("nb")
        )
        others = active.select("token", F.col("id").alias("a"), F.col("size").alias("na"))
        met = lookup_join(others, pivots, ["token"], "inner", bound=rows).where(
            F.col("a") != F.col("b")
        )
        # sizes too different for a distance of twice the limit: too far to matter
        met = met.where(_sized_alike(F.col("na"), F.col("nb"), 1.0 - 2 * limit))
        known, pairs = stage_counted(similarities(met.select("a", "b").distinct(), sets), "pivot-similarity")
        edges.append(known.where(F.col("jaccard") >= threshold - _EPS).select("a", "b"))
        distance = met.select("token", "a", "b").join(known, ["a", "b"]).withColumn("d", 1.0 - F.col("jaccard"))
        ring = distance.where((F.col("d") > limit + _EPS) & (F.col("d") <= 2 * limit + _EPS)).groupBy("token", "b").agg(
            F.min("d").alias("nearest_outside")
        )
        near = lookup_join(
            distance.where(F.col("d") <= limit + _EPS), ring, ["token", "b"], bound=rows
        )
        settled = near.where(
            F.col("nearest_outside").isNull() | (F.col("d") < F.col("nearest_outside") - limit - _EPS)
        ).select("token", F.col("a").alias("id"))
        gone = settled.unionByName(pivots.select("token", F.col("b").alias("id")))
        left = active.select("token", "id", "size", "place").join(gone, ["token", "id"], "left_anti")
        active, rows = _with_bucket_size(stage(left, "bucket-rows"))
        pairs = _pairs_by_size(active)
        if rounds % 2 and depth < _DEPTH and sum(more for _, more in pairs) > allowed << rounds + 1:
            further, n = _with_bucket_size(_deeper(active.drop("n", "first"), ordered, depth, threshold))
            fewer = _pairs_by_size(further)
            if sum(more for _, more in fewer) < sum(more for _, more in pairs):
                active, rows, pairs, depth = further, n, fewer, depth + 1
        rounds += 1
        active = parted(active, pairs)
    postings = small[0]
    for more in small[1:]:
        postings = postings.unionByName(more)
    pairs = similarities(_bucket_pairs(postings, threshold), sets)
    found = pairs.where(F.col("jaccard") >= threshold - _EPS).select("a", "b")
    for e in edges:
        found = found.unionByName(e)
    return stage_counted(found, "edges")


def connected_components(edges: DataFrame, rows: int) -> DataFrame:
    """(id, component) with the smallest id as component, for every node of the edges,
    of which there are at most ``rows``.

    Alternates two steps until only stars are left: every node links its larger
    neighbours to its smallest one, then its smaller neighbours. Minima are combined
    aggregates; nodes with very many neighbours are joined apart as hot keys.
    """
    def smallest(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))

    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    while rows:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = lookup_join(both, smallest(both), ["u"], "inner", bound=2 * rows).where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")
        ).distinct()
        if rows > BROADCAST_ROWS:
            large = stage(large, "components")
        joined = lookup_join(large, smallest(large), ["u"], "inner", bound=rows)
        links, rows = stage_counted(joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            joined.select("u", F.col("m").alias("v"))
        ).where("u <> v").distinct(), "components")
        ends = links.select(F.inline(F.array(
            F.struct(F.col("u").alias("id"), F.lit(1).alias("up"), F.lit(0).alias("down")),
            F.struct(F.col("v").alias("id"), F.lit(0).alias("up"), F.lit(1).alias("down")),
        ))).groupBy("id").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.where("up > 1 OR (up = 1 AND down = 1)").isEmpty():
            break
    members = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return members.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def duplicate_clusters(
    df: DataFrame,
    text: Column,
    score: Column,
    threshold: float = SIMILARITY_THRESHOLD,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """(id, cluster, keeper) for every row that has an exact or near duplicate; the
    cluster is named by the smallest id among its distinct texts' keepers."""
    df = df.select("id", text.alias("text"), score.cast("double").alias("score"))
    dealt = spread(df, "id")
    df = df if dealt is df else stage(dealt, "texts")  # the texts are read several times
    narrow, n = stage_counted(df.select("id", text_key(F.col("text")).alias("text_key"), "score"), "text-keys")
    keepers = stage(_keepers(narrow), "exact-keepers")
    # leave out the extra copies; the whole texts are shuffled only if those are many
    copies = lookup_join(narrow, keepers.where("copies > 1"), ["text_key"], "inner").where("id <> keeper").select("id")
    copies, extra = stage_counted(copies, "copies")
    unique = lookup_join(df.select("id", "text"), copies, ["id"], "left_anti", max_rows=_ID_ROWS, bound=extra)
    if extra > _ID_ROWS:
        unique = stage(unique, "unique-texts")
    edges, found = similar_edges(unique, threshold, bucket_rows, band_share(threshold, n))
    component = connected_components(edges, found)
    tagged = lookup_join(narrow, keepers, ["text_key"], "inner", bound=n)
    tagged = lookup_join(tagged, component.withColumnRenamed("id", "keeper"), ["keeper"], "left", bound=2 * found)
    tagged = tagged.where((F.col("copies") > 1) | F.col("component").isNotNull())
    members = tagged.select("id", "score", F.coalesce("component", "keeper").alias("cluster"))
    best = members.groupBy("cluster").agg(_best(F.col("score")).alias("b")).select(
        "cluster", F.col("b.id").alias("keeper")
    )
    return lookup_join(members.select("id", "cluster"), best, ["cluster"], "inner", bound=n).select(
        "id", "cluster", "keeper"
    )


def drop_near_duplicates(df: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows without those that another row of their cluster replaces."""
    removed = clusters.where(F.col("id") != F.col("keeper")).select("id")
    return df.join(removed, "id", "left_anti")


def duplicate_counts(clusters: DataFrame) -> DataFrame:
    """One row: clusters found and rows removed."""
    return clusters.agg(
        F.count_distinct("cluster").alias("clusters"), F.count_if(F.col("id") != F.col("keeper")).alias("removed")
    )
