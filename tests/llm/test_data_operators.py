"""Records, mixing, toxicity, shards, URL filter, archives: round trips and plain versions."""

from __future__ import annotations

import base64
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import plain
import pytest
import zstandard
from pyspark.sql import functions as F

from quillsieve.llm import mixing, records, sharding, toxicity, url_filter, warc
from quillsieve.llm.queries import URL_RULES, tokenizer_path
from quillsieve.session import stage_path

FOLDER = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")


def rows(df):
    return [tuple(r) for r in df.collect()]


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def same(found, expected):
    assert sorted(found, key=key) == sorted(expected, key=key)


def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


# records


def test_checksum_of_known_values():
    assert records.crc32c([b"123456789", b"", b"a", bytes(32), b"\xff" * 32]).tolist() == [0xE3069283, 0, 0xC1D04330, 0x8A9136AA, 0x62A8AB43]


def test_checksum_equals_one_byte_at_a_time():
    step, _ = records._crc_tables()
    draw = random.Random(1)
    data = [draw.randbytes(draw.choice([0, 1, 3, 4, 5, 255, 256, 257, 700, 5000])) for _ in range(60)]

    def slow(payload):
        register = 0xFFFFFFFF
        for byte in payload:
            register = int(step[(register ^ byte) & 0xFF]) ^ (register >> 8)
        return register ^ 0xFFFFFFFF

    assert records.crc32c(data).tolist() == [slow(p) for p in data]


def test_frames_and_broken_ones():
    payloads = [b"", b"xy", b"z" * 1000]
    framed = records.frame(payloads)
    data, offsets = b"".join(framed), [0, len(framed[0]), len(framed[0]) + len(framed[1])]
    assert records.unframe(data, offsets) == payloads
    assert struct.unpack("<Q", framed[2][:8])[0] == 1000
    with pytest.raises(ValueError):
        records.unframe(data[:-6] + b"?" + data[-5:], offsets)


def expected_tokens(docs):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer_path())
    start, out = 0, []
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


@there
def test_tokens_from_the_files(spark):
    docs = documents(spark)
    same(rows(records.token_table(docs, tokenizer_path())), expected_tokens(rows(docs.select("doc_id", "text"))))


def test_tokens_of_tricky_rows(spark, tricky, empty, clashing):
    expected = expected_tokens(rows(tricky.select("doc_id", "text")))
    same(rows(records.token_table(tricky, tokenizer_path())), expected)
    same(rows(records.token_table(clashing, tokenizer_path())), expected)
    assert rows(records.token_table(empty, tokenizer_path())) == []


def test_pieces_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(records, "_CACHE_WORDS", 50)
    draw = random.Random(4)
    marks = ["a", "b", "S", "I", "\u0130", "'", "'s", "'S", "'re", "!", "_", "-", "^", "=", "<", ">", "|", "\u00c9", "\u00df", "\u00ff",
             "\u0301", "\u030c", "\u0307", "\u0338", "J", "<|endoftext|>", "1", "\u00bd", " ", "\n", "\t", "\u00a0", "\u2028", "\u03a3",
             "\u4e2d", "\u1100", "\u1161", "\u2026", "\U0001f600", "\x00", "\u00aa", "\ufb01"]
    texts = ["".join(draw.choices(marks, k=draw.randint(0, 14))) for _ in range(5_000)]
    encoder = records.Encoder(tokenizer_path())
    found = [ids for at in range(0, len(texts), 250) for ids in encoder.encode(texts[at : at + 250], 2)]
    whole = encoder._tokenizer.encode_batch(texts, add_special_tokens=False)
    assert found == [struct.pack(f"<{len(e.ids) + 1}H", *e.ids, 2) for e in whole]


def test_records_in_any_order(spark, tricky):
    folder = stage_path(spark, "records-test")
    index = records.write_records(tricky, folder, tokenizer_path(), shards=3)
    some = index.where("id IN (10, 13, 3)").orderBy(F.desc("id"))
    whole = {r["id"]: r["ids"] for r in records.read_records(index, folder).collect()}
    assert {r["id"]: r["ids"] for r in records.read_records(some, folder).collect()} == {i: whole[i] for i in (10, 13, 3)}


# mixing


def check_mix(found, docs):
    by_source, taken = Counter(), Counter()
    for (doc_id, text, source) in docs:
        by_source[source] += len(plain.re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    target = plain.water_fill(by_source)
    largest = defaultdict(int)
    for r in found:
        assert r["source_size"] == by_source[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]], rel=1e-12)
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    assert len(found) == len(docs)
    for source in by_source:
        assert abs(taken[source] - target[source]) <= largest[source] / 2 + 1e-6


@there
def test_mix(spark):
    docs = documents(spark)
    found = mixing.mix(docs).collect()
    check_mix(found, rows(docs.select("doc_id", "text", "source")))
    same([tuple(r) for r in mixing.mix(docs.repartition(5)).collect()], [tuple(r) for r in found])


def test_mix_of_tricky_rows(spark, tricky, empty, clashing):
    check_mix(mixing.mix(tricky).collect(), rows(tricky.select("doc_id", "text", "source")))
    check_mix(mixing.mix(clashing).collect(), rows(tricky.select("doc_id", "text", "source")))
    assert mixing.mix(empty).count() == 0
    assert mixing.mixed(empty).count() == 0


@pytest.mark.parametrize("sizes", [{"a": 1, "b": 1000}, {"a": 5, "b": 5, "c": 5}, {"a": 0, "b": 7}, {"a": 0}, {"z": 10, "é": 1000, None: 3, "": 5, "Z": 2}])
def test_targets(spark, sizes):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    found = {r["source"]: r["target"] for r in mixing.targets(frame).collect()}
    assert found == pytest.approx(plain.water_fill(sizes))


@there
def test_mixed_rows_are_repeated(spark):
    docs = documents(spark)
    copies = {r["id"]: r["copies"] for r in mixing.mix(docs).collect()}
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    assert Counter(r[0] for r in rows(mixed.select("doc_id"))) == Counter({i: n for i, n in copies.items() if n})


# toxicity


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="test tables are not there")
def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = {r["id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(found) == docs.count()
    for i, r in found.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(found[i]["predicted"], y) for i, y in rows(labels.select("doc_id", "toxic")) if found[i]["held_out"]]
    right = sum(p == y for p, y in held)
    assert right >= 0.94 * len(held)
    assert sum(p and y for p, y in held) >= 0.8 * sum(y for _, y in held)


def sentence_docs():
    draw = random.Random(2)
    plainly = ["the day is fine", "we read a book", "rain falls on the town", "she sings a song"]
    docs = []
    for i in range(300):
        parts = [draw.choice(plainly) for _ in range(draw.randint(1, 8))]
        if i % 3 == 0:
            parts.insert(draw.randrange(len(parts) + 1), "you vile fool")
        docs.append((int(i % 3 == 0), ". ".join(parts) + "."))
    return docs


def test_sentences_are_found(spark):
    model = toxicity.fit(sentence_docs())
    text = "The day is fine. You vile fool! We read a book."
    assert [s >= 0.3 for s in model.sentence_scores(text)] == [False, True, False]
    assert model.score(text) > 0.5 > model.score("The day is fine. We read a book.")
    assert model.score(None) == model.score("") == 0
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id bigint, text string")
    assert [(r["id"], r["sentence"], r["text"]) for r in toxicity.offending_sentences(docs, model).collect()] == [(1, 1, "You vile fool")]


def test_toxicity_of_tricky_rows(spark, tricky, empty, clashing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (3, 1, None), (3, 1, 0), (99, 0, 1), (4, 0, 0), (4, 0, 1), (8, 1, 0)], none.schema)
    for labels in (none, odd):
        assert toxicity.toxicity(tricky, labels).count() == tricky.count()
        assert toxicity.toxicity(clashing, labels).count() == tricky.count()
        assert toxicity.toxicity(empty, labels).count() == 0
        assert toxicity.drop_toxic(empty, labels).count() == 0
    kept = toxicity.drop_toxic(tricky, none)
    assert kept.columns == tricky.columns and kept.count() == tricky.count()


def test_toxic_rows_go(spark, clashing):
    train = [(i, t) for i, (_, t) in enumerate(sentence_docs())]
    docs = spark.createDataFrame([(i, t, 1) for i, t in train], "doc_id bigint, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, (y, _) in enumerate(sentence_docs())], "doc_id bigint, toxic int")
    assert {r["doc_id"] % 3 for r in toxicity.drop_toxic(docs, labels).collect()} == {1, 2}


# shards


def check_shards(found, docs, shards):
    sizes, slots, of_text = Counter(), defaultdict(list), defaultdict(set)
    texts = {i: t for i, t in docs}
    for r in found:
        raw = (texts[r["id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert 0 <= r["shard"] < shards
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        of_text[raw].add(r["shard"])
    assert len(found) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_text.values())
    return sizes


@pytest.mark.skipif(not Path("/root/testdata/sf0.01").exists(), reason="test tables are not there")
def test_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sizes = check_shards(sharding.assign(docs, shards=24).collect(), rows(docs.select("doc_id", "text")), 24)
    assert max(sizes.values()) <= 1.01 * min(sizes.values())


def test_shards_of_tricky_rows(spark, tricky, empty, clashing):
    check_shards(sharding.assign(tricky, shards=4).collect(), rows(tricky.select("doc_id", "text")), 4)
    check_shards(sharding.assign(clashing, shards=4, large_share=3, bundles=2).collect(), rows(tricky.select("doc_id", "text")), 4)
    assert sharding.assign(empty, shards=4).count() == 0


def test_best_fit_decreasing():
    draw = random.Random(4)
    sizes = [draw.randint(1, 60) for _ in range(500)] + [130]

    def plainly(capacity):
        rooms, out = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(room, b) for b, room in enumerate(rooms) if room >= sizes[i]]
            if fits:
                out[i] = min(fits)[1]
            else:
                rooms.append(max(capacity, sizes[i]))
                out[i] = len(rooms) - 1
            rooms[out[i]] -= sizes[i]
        return out

    assert sharding.pack(sizes, 100) == plainly(100)
    assert sharding.pack(sizes, 100, limit=3) is None
    assert sharding.pack([], 10) == [] == sharding.balance([], 3)


@pytest.mark.parametrize(("capacity", "range_bins"), [(200, 256), (1_000, 8), (20_000, 2), (150_000, 256)])
def test_shards_of_a_fixed_capacity(spark, monkeypatch, capacity, range_bins):
    """Thousands of groups, one of them larger than any shard, in several ranges."""
    monkeypatch.setattr(sharding, "RANGE_BINS", range_bins)
    draw = random.Random(capacity)
    docs = [(i, f"{i} " + "x" * draw.randint(0, 90)) for i in range(6_000)] + [(10_000 + i, "copy " * 10) for i in range(40)] + [(None, None), (20_000, "")]
    found = sharding.assign(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3), capacity=capacity).collect()
    assert len(found) == len(docs)
    sizes, groups, slots = Counter(), defaultdict(set), defaultdict(list)
    for r in found:
        sizes[r["shard"]] += r["size"]
        groups[r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in groups.values())
    assert sorted(sizes) == list(range(len(sizes)))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    over = [s for s, n in sizes.items() if n > capacity]
    copies = 40 * (50 + 8)
    assert len(over) == (copies > capacity)
    total = sum(sizes.values())
    assert len(sizes) <= 1.25 * -(-total // capacity) + 2


# URL filter


@there
def test_verdicts(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    expected = [(i, *plain.url_verdict(u, URL_RULES)) for i, u in rows(pages.select("page_id", "url"))]
    assert {r[-1] for r in expected} == {"allow", "block"}
    same(rows(url_filter.judge_urls(pages, URL_RULES)), expected)


def test_verdicts_of_tricky_urls(spark):
    urls = [None, "", "no mark", "http://", "http://NET/", "http://net", "http://a.net?x=/", "http://xnet/", "x://Example.NET/en/1#y", "http://m.example.net/en?/en/", "http://org/fr/",
            "http://a.b.org/fr/x?z#q", "http://É.Org/fr/é", "http://a..net//", "http://net:80/", "a://b://c.net/", "http://u@net/", "http://x.net/\n/q"]
    rules = [*URL_RULES, ("NET", "/", "block"), ("deep.a.org", "/", "block"), ("a.org", "/deep", "allow"), ("", "/", "block"), (None, None, "block"), ("x.net", "", "allow"), ("x.net", "", "block")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string").withColumn("rule", F.lit(1))
    same(rows(url_filter.judge_urls(pages, URL_RULES)), [(i, *plain.url_verdict(u, URL_RULES)) for i, u in enumerate(urls)])
    lowered = [((h or "").lower(), p or "", v) for h, p, v in rules if h]
    same(rows(url_filter.judge_urls(pages, rules)), [(i, *plain.url_verdict(u, lowered)) for i, u in enumerate(urls)])
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r[-1] for r in rows(url_filter.judge_urls(pages, []))} == {"allow"}


def test_equal_hashes_are_told_apart_by_their_strings(spark, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda key: 7)
    folder = stage_path(spark, "rules-test")
    batch = spark.createDataFrame([(0, "net", "/", True), (0, "org", "/a", True)], "shard int, host string, path string, block boolean").toArrow().to_batches()
    list(url_filter._write(iter(batch), folder))
    judged = url_filter.RuleSet(folder, [1, 2]).judge(["http://net/", "http://org/a", "http://org/b", "http://com/"])
    assert [r[2] for r in judged] == ["net/", "org/a", None, None]


# archives


def expected_archive(pages, minimum=0):
    first = {}
    for i, html in sorted(((i, h) for i, h, *_ in pages if i is not None), key=lambda r: r[0]):
        first.setdefault(html or "", i)
    out, used = [], set()
    for i, html, *_ in pages:
        raw = (html or "").encode()
        repeat = i is not None and len(raw) >= minimum and (first[html or ""] != i or (i, html or "") in used)
        used.add((i, html or ""))
        out.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if repeat else "response", first[html or ""] if repeat else None))
    return out


@there
def test_archives(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    same(rows(warc.archive_table(pages)), expected_archive(rows(pages.select("page_id", "html"))))


def test_archives_of_tricky_pages(spark):
    html = "<p>equal</p>" * 50
    pages = [(1, "a://b", None), (2, "a://c", ""), (3, "x\r\ny: z", html), (4, None, html), (5, "u", "é" * 70_000), (6, "u", html + "\r\n\r\n"), (None, "n", html), (7, "v", html)]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("id", F.lit(1)).withColumn("digest", F.lit("x"))
    for minimum in (0, 5):
        same(rows(warc.archive_table(frame, minimum=minimum)), expected_archive([(i, h) for i, _, h in pages], minimum))
    twice = frame.unionByName(frame).repartition(3)
    same(rows(warc.archive_table(twice)), expected_archive([(i, h) for i, _, h in pages] * 2))
    assert warc.archive_table(frame.limit(0)).count() == 0


def test_archive_is_a_dictionary_and_frames(spark, tmp_path):
    draw = random.Random(6)
    words = ["".join(draw.choice("abcdefgh") for _ in range(7)) for _ in range(300)]
    data = [warc.record(i, f"http://x/{i}", " ".join(draw.choice(words) for _ in range(200)).encode(), None) for i in range(400)]
    path = str(tmp_path / "a.warc.zst")
    writer = warc.Writer(path)
    index = [x for i, d in enumerate(data) for x in writer.add(i, d)] + list(writer.close())
    assert list(warc.read_archive(path)) == data
    raw = Path(path).read_bytes()
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D
    engine = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw[8 : 8 + size]))
    for i, at, length in index:
        assert engine.decompress(raw[at : at + length], max_output_size=len(data[i])) == data[i]
    alone = sum(len(zstandard.ZstdCompressor(3).compress(d)) for d in data)
    assert sum(n for _, _, n in index) < 0.8 * alone


def test_revisits_name_the_record_of_their_response(spark, tmp_path):
    pages = [(1, "http://a/1", "same"), (2, "http://a/2", "same"), (3, None, "other"), (4, "http://a/4", "other"), (5, "http://a/5", "own")]
    index = warc.write_archives(spark.createDataFrame(pages, "page_id bigint, url string, html string").coalesce(1), str(tmp_path))
    names = {r["archive"] for r in index.collect()}
    told = [warc.parse(data)[0] for name in names for data in warc.read_archive(f"{tmp_path}/{name}")]
    assert sum(f["WARC-Type"] == "warcinfo" for f in told) == len(names) and len(told) == 5 + len(names)
    by_id = {f["WARC-Record-ID"]: f for f in told}
    again = {f["X-Page-ID"]: by_id[f["WARC-Refers-To"]] for f in told if f["WARC-Type"] == "revisit"}
    assert {k: v["X-Page-ID"] for k, v in again.items()} == {"2": "1", "4": "3"}
    for f in told:
        if f["WARC-Type"] == "revisit":
            target = by_id[f["WARC-Refers-To"]]
            assert (f["WARC-Refers-To-Target-URI"], f["WARC-Payload-Digest"]) == (target["WARC-Target-URI"], target["WARC-Payload-Digest"])
        assert f["WARC-Block-Digest"].startswith("sha1:")
