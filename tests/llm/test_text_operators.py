"""SimHash near-dedup, fingerprints, decontamination, repeats: against plain versions."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from quillsieve.llm import decontaminate, repeats, simhash_dedup, simhash_tables

FOLDER = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")


def rows(df):
    return [tuple(r) for r in df.collect()]


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def same(found, expected):
    assert sorted(found, key=key) == sorted(expected, key=key)


def expected_components(docs, distance=4):
    prints = [(i, plain.fingerprint(t)) for i, t in docs]
    return [(i, fp, c) for (i, fp), c in zip(prints, plain.components(prints, distance), strict=True)]


def found_components(df, **settings):
    return [(i, fp % (1 << 64), c) for i, fp, c in rows(simhash_dedup.simhash_components(df, **settings))]


@there
@pytest.mark.parametrize("settings", [{}, {"segments": 2}, {"bucket_rows": 3}, {"distance": 3, "bucket_rows": 3}])
def test_components_equal_all_pairs(spark, settings):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    same(found_components(docs, **settings), expected_components(rows(docs.select("doc_id", "text")), settings.get("distance", 4)))


def test_components_of_crowded_fingerprints(spark):
    """Hundreds of near copies around one fingerprint, in the gathered and in the midpoint way."""
    draw = random.Random(3)
    fps = {draw.getrandbits(64) for _ in range(50)}
    centre = draw.getrandbits(64)
    for _ in range(400):
        fps.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 7))))
    fps = sorted(fps)
    expected = plain.components(list(enumerate(fps)))
    classes = sorted(sorted(fps[i] for i in range(len(fps)) if expected[i] == c) for c in set(expected))
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp bigint").repartition(4)
    for limit in (16_384, 40):
        pairs, _ = simhash_dedup.links(frame, bucket_rows=limit)
        label = {f: f for f in fps}

        def find(x, label=label):
            while label[x] != x:
                x = label[x]
            return x

        for a, b in rows(pairs):
            a, b = a % (1 << 64), b % (1 << 64)
            assert limit == 16_384 or (a ^ b).bit_count() <= 4
            label[max(find(a), find(b))] = min(find(a), find(b))
        got = sorted(sorted(f for f in fps if find(f) == r) for r in {find(f) for f in fps})
        assert got == classes


def test_components_of_tricky_rows(spark, tricky, empty, clashing):
    expected = expected_components(rows(tricky.select("doc_id", "text")))
    same(found_components(tricky), expected)
    same(found_components(clashing), expected)
    assert found_components(empty) == []


def test_one_of_each_component_stays(spark, tricky, empty):
    kept = simhash_dedup.drop_near_duplicates(tricky)
    assert kept.columns == tricky.columns
    # 0, 1 and 2 have no words; 3, 4, 5 are equal after folding
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, _, c in expected_components(rows(tricky.select("doc_id", "text")))})
    nameless = tricky.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert simhash_dedup.drop_near_duplicates(nameless).count() == tricky.count()
    assert simhash_dedup.drop_near_duplicates(empty).count() == 0


@there
def test_neighbours(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = {r["id"]: r for r in simhash_tables.compare_neighbours(docs, shards=7).collect()}
    ordered = rows(docs.select("doc_id", F.coalesce("text", F.lit(""))).orderBy("doc_id"))
    make = simhash_tables.Fingerprinter()
    assert len(found) == len(ordered)
    for (doc_id, _), (text, changed, following) in zip(ordered, plain.edited([t for _, t in ordered]), strict=True):
        r = found[doc_id]
        prints = [make.bits(t) for t in (text, changed, following)]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (prints[0].tobytes().hex(), prints[1].tobytes().hex())
        assert r["near_edited"] == simhash_tables.likeness(prints[0], prints[1])
        assert r["near_next"] == simhash_tables.likeness(prints[0], prints[2])
    longer = [r for r in found.values() if r["n_chars"] > 500]
    nearer = sum(r["near_edited"] > r["near_next"] for r in longer)
    assert nearer > 0.9 * len(longer)


def test_neighbours_of_tricky_rows(spark, tricky, empty, clashing):
    for frame in (tricky, clashing):
        found = rows(simhash_tables.compare_neighbours(frame, shards=5).select("id", "n_chars", "edited_sha256"))
        texts = sorted(((r["doc_id"], r["text"] or "") for r in tricky.collect()), key=lambda r: r[0])
        same(found, [(i, len(t), hashlib.sha256(c.encode()).hexdigest()) for (i, _), (t, c, _) in zip(texts, plain.edited([t for _, t in texts]), strict=True)])
    assert simhash_tables.compare_neighbours(empty).count() == 0
    assert simhash_tables.compare_neighbours(tricky.limit(1)).count() == 1


def test_within_radius(spark):
    draw = np.random.default_rng(5)
    centres = draw.integers(0, 256, (20, 16), np.uint8)
    prints = [c.tobytes() for c in centres]
    for c in centres:
        for n in (1, 3, 6, 7, 9):
            bits = np.unpackbits(c)
            bits[draw.choice(128, n, replace=False)] ^= 1
            prints.append(np.packbits(bits).tobytes())
    frame = spark.createDataFrame([(p.hex(),) for p in [*prints, *prints[:5]]], "fingerprint string")
    queries = frame.limit(30)
    asked = {r[0] for r in queries.collect()}
    found = rows(simhash_tables.within_radius(frame, queries, radius=6))

    def apart(a, b):
        return (int(a, 16) ^ int(b, 16)).bit_count()

    every = {p.hex() for p in prints}
    same(found, [(q, f, apart(q, f)) for q in asked for f in every if apart(q, f) <= 6])


ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (10, "x"), (2, "W5 w6, w7"), (3, None), (4, "..."), (5, "one two three four five six seven eight nine ten"),
         (1, "漢字 übergrößé"), (11, " ".join(f"w{i}" for i in range(20, 40)))]


def digests(df):
    return rows(decontaminate.with_digest(df))


@there
def test_contamination(spark):
    docs, items = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "benchmark"))
    expected = plain.contamination(rows(docs.select("doc_id", "text")), rows(items.select("item_id", "text")))
    assert any(r[-1] for r in expected)
    same(digests(decontaminate.contamination(docs, items)), expected)


def test_contamination_of_tricky_rows(spark, tricky, empty, clashing):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    distinct = tricky.dropDuplicates(["doc_id"])
    expected = plain.contamination(rows(tricky.select("doc_id", "text")), ITEMS)
    same(digests(decontaminate.contamination(tricky, items)), expected)
    same(digests(decontaminate.contamination(clashing, items)), expected)
    same(digests(decontaminate.contamination(distinct, items, block_words=12)), plain.contamination(rows(distinct.select("doc_id", "text")), ITEMS))
    assert digests(decontaminate.contamination(empty, items)) == []
    nothing = spark.createDataFrame([], "item_id int, text string")
    assert {r[2] for r in digests(decontaminate.contamination(tricky, nothing))} == {0}


def test_longest_matches(spark):
    docs = spark.createDataFrame([(7, "zero one two three four five six seven eight nine ten eleven zwölf one two"), (8, "none")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEMS[0][1])], "item_id int, text string")
    assert rows(decontaminate.matches(docs, items)) == [(7, "1", 1, 11)]


def test_contaminated_rows_go(spark, tricky, empty):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    bad = {r[0] for r in plain.contamination(rows(tricky.select("doc_id", "text")), ITEMS) if r[-1]}
    kept = decontaminate.drop_contaminated(tricky, items)
    assert kept.columns == tricky.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for (i,) in rows(tricky.select("doc_id")) if i not in bad)
    nameless = tricky.withColumn("doc_id", F.lit(None).cast("bigint"))
    assert decontaminate.drop_contaminated(nameless, items).count() == kept.count()
    assert decontaminate.drop_contaminated(empty, items).count() == 0


def spans(df, **settings):
    return rows(repeats.repeated_spans(df, **settings).drop("spans"))


@there
@pytest.mark.parametrize("group_rows", [20_000, 1])
def test_repeats(spark, group_rows):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    expected = plain.repeats(rows(docs.select("doc_id", "text")))
    assert sum(r[2] > 0 for r in expected) > 5
    same(spans(docs, group_rows=group_rows), expected)


@pytest.mark.parametrize("length", [200, 40])
def test_repeats_of_tricky_rows(spark, tricky, empty, clashing, length):
    expected = plain.repeats(rows(tricky.select("doc_id", "text")), length)
    same(spans(tricky, length=length), expected)
    same(spans(clashing, length=length), expected)
    assert spans(empty) == []


def test_repeats_in_random_strings(spark, monkeypatch):
    """Short alphabets and shared pieces at every offset, also across the pieces of long texts."""
    draw = random.Random(11)
    pieces = ["".join(draw.choice("ab") for _ in range(draw.randint(5, 60))) for _ in range(80)] + ["ab" * 8, "b"]
    docs = [(i, "".join(draw.choice(pieces) for _ in range(draw.randint(0, 12)))) for i in range(40)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    expected = plain.repeats(docs, 40)
    assert any(0 < r[2] < r[1] for r in expected)
    for group_rows in (20_000, 2):
        same(spans(frame, length=40, group_rows=group_rows), expected)
    monkeypatch.setattr(repeats, "PIECE", 100)
    batches = [b for b in repeats._scan(iter([_arrow(docs)]), 40)]
    starts = sorted((r["id"], r["at"], r["windows"]) for b in batches for r in b.to_pylist() if r["windows"])
    for doc_id, text in docs:
        own = [(a, n) for i, a, n in starts if i == doc_id]
        assert sum(n for _, n in own) == max(0, len(text) - 39)
        assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:], strict=False))


def _arrow(docs):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in docs]), pa.array([t.encode() for _, t in docs]), pa.array([0] * len(docs))], ["id", "text", "mark"])


def test_dropped_repeats(spark):
    shared = "shared " * 30
    frame = spark.createDataFrame([(1, "first " + shared), (2, shared + "second")], "doc_id bigint, text string")
    kept = dict(rows(repeats.drop_repeats(frame)))
    expected = {r[0]: r[4] for r in plain.repeats([(1, "first " + shared), (2, shared + "second")])}
    assert {i: hashlib.sha256(k).hexdigest() for i, k in kept.items()} == expected


def test_many_equal_rows_are_looked_at_once(spark):
    """Rows that are equal in id and text, also without an id: one of them is worked off."""
    text = " ".join(f"w{k}" for k in range(800))
    some = [(1, text)] * 1_500 + [(None, text)] * 500 + [(2, text[:300] + "x"), (3, "short")] + [(4, "short")] * 3
    found = spans(spark.createDataFrame(some, "doc_id bigint, text string").repartition(4))
    once = plain.repeats([(1, text), (None, text), (2, text[:300] + "x"), (3, "short"), (4, "short")])
    same(set(found), set(once))
    assert {r[1:] for r in found if r[0] in (1, None)} == {(len(text), len(text), 1, hashlib.sha256(b"").hexdigest())}
    assert len(found) == len(some)
