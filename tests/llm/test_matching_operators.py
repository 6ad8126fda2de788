"""Substring dedup, spelling variants, token alignment: against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillsieve.llm import alignment, spelling, substrings
from quillsieve.llm.fm_index import FMIndex, WaveletTree, suffix_order
from quillsieve.llm.queries import tokenizer_path

FOLDER = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not there")


def rows(df):
    return [tuple(r) for r in df.collect()]


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def same(found, expected):
    assert sorted(found, key=key) == sorted(expected, key=key)


# --- index -------------------------------------------------------------------------------


@pytest.mark.parametrize("symbols", [1, 2, 5, 300])
def test_rank_in_the_wavelet_tree(symbols):
    draw = np.random.default_rng(symbols)
    text = (draw.pareto(1.0, 2_000) % symbols).astype(np.int64)
    tree = WaveletTree(text, symbols)
    symbol, place = draw.integers(0, symbols, 500), draw.integers(0, len(text) + 1, 500)
    assert tree.rank(symbol, place).tolist() == [int((text[:p] == s).sum()) for s, p in zip(symbol, place, strict=True)]


def test_suffixes_in_order():
    text = np.random.default_rng(1).integers(0, 3, 400)
    order = suffix_order(text, 400)
    assert order.tolist() == sorted(range(400), key=lambda i: text[i:].tolist())
    assert suffix_order(np.zeros(0, np.int64), 5).tolist() == []


@pytest.mark.parametrize("times", [1, 2])
def test_matching_statistics(times):
    draw = random.Random(5)
    text = [draw.randint(1, 3) for _ in range(300)] + [0]
    stream = [draw.randint(1, 4) for _ in range(200)]
    index = FMIndex(np.array(text), 5, 8)
    length, low, high = index.matching_statistics(np.array(stream), np.arange(200), 8, times)
    for end in range(200):
        count = {n: sum(text[i : i + n] == stream[end + 1 - n : end + 1] for i in range(301 - n)) for n in range(1, min(8, end + 1) + 1)}
        longest = max((n for n, c in count.items() if c >= times), default=0)
        assert length[end] == longest
        if longest:
            assert high[end] - low[end] == count[longest]


# --- substring dedup ---------------------------------------------------------------------


def plain_passages(docs, length):
    """Rows with equal ids have equal texts or too short ones here, so their order is no matter."""
    seen, out = set(), []
    for i, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        words, gone = re.findall(r"[^\x20\x09-\x0D]+", text or ""), set()
        for k in range(len(words) - length + 1):
            window = tuple(words[k : k + length])
            if window in seen:
                gone.update(range(k, k + length))
            seen.add(window)
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def found_passages(df, **settings):
    return rows(substrings.later_passages(df, **settings).drop("spans"))


def shuffled_passages():
    draw = random.Random(3)
    some = [f"w{k}" for k in range(12)]

    def text(n):
        return " ".join(draw.choice(some) for _ in range(n))

    passages = [text(draw.randint(3, 30)) for _ in range(8)]
    parts = [lambda: text(draw.randint(0, 12)), lambda: draw.choice(passages), lambda: "a " * draw.randint(0, 9)]
    out = [(k, " ".join(draw.choice(parts)() for _ in range(draw.randint(0, 6)))) for k in range(120)]
    return [*out, (200, out[5][1]), (201, None), (202, ""), (203, "x " * 60), (204, "x " * 60), (None, out[7][1]), *[(300, out[9][1])] * 3]


@pytest.mark.parametrize(("length", "group_rows"), [(5, 4_096), (5, 2), (20, 4_096), (20, 1), (1, 4_096)])
def test_later_passages(spark, length, group_rows):
    docs = shuffled_passages()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    same(found_passages(frame, length=length, group_rows=group_rows), plain_passages(docs, length))


def test_later_passages_across_small_shards_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 100)
    monkeypatch.setattr(substrings, "PIECE", 16)
    docs = shuffled_passages()
    for words in (docs[9][1], "q " * 50):
        raw = words.encode()
        assert len(substrings.word_hashes(raw)) == len(raw.split())
    text = np.array([len(w) for w in docs[9][1].split()], np.uint64)
    found = [substrings.runs(text[at : at + 16 + 4], 5) for at in range(0, max(len(text) - 4, 0), 16)]
    assert sum(int(count.sum()) for *_, count in found) == max(len(text) - 4, 0)


def test_one_index_of_many_spans():
    draw = np.random.default_rng(2)
    spans = [draw.integers(0, 2, n).astype(np.uint64) for n in (4, 9, 30, 12)]
    owner, window = substrings.later_windows(spans, np.array([2, 0, 3, 1]), 4)
    expected, seen = set(), set()
    for i in (1, 3, 0, 2):
        for k in range(len(spans[i]) - 3):
            w = tuple(spans[i][k : k + 4].tolist())
            if w in seen:
                expected.add((i, k))
            seen.add(w)
    found = set(zip(owner.tolist(), window.tolist(), strict=True))
    assert {(i, tuple(spans[i][k : k + 4].tolist())) for i, k in found} == {(i, tuple(spans[i][k : k + 4].tolist())) for i, k in expected}


def test_passages_of_tricky_rows(spark, tricky, empty, clashing):
    docs = rows(tricky.select("doc_id", "text"))
    same(found_passages(tricky), plain_passages(docs, 20))
    same(found_passages(clashing), plain_passages(docs, 20))
    assert found_passages(empty) == []
    strings = tricky.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 4, "0")))
    same([r[1:] for r in found_passages(strings)], [r[1:] for r in plain_passages(docs, 20)])


def test_many_equal_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    frame = spark.range(25_000).select(F.lit(1).cast("bigint").alias("doc_id"), F.lit(text).alias("text"))
    found = substrings.later_passages(frame).groupBy("n_removed").count().collect()
    assert {(r["n_removed"], r["count"]) for r in found} == {(0, 1), (30, 24_999)}


def test_kept_words(spark):
    docs = shuffled_passages()
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = substrings.later_passages(frame, length=5, keep=True).collect()
    assert len(found) == len(docs)
    for r in found:
        kept = bytes(r["kept"])
        if r["n_removed"]:
            assert hashlib.sha256(kept).hexdigest() == r["kept_sha256"]
            assert sum(s["end"] - s["begin"] for s in r["spans"]) == r["n_removed"]
        else:
            assert hashlib.sha256(b" ".join(kept.split())).hexdigest() == r["kept_sha256"]


# --- spelling ----------------------------------------------------------------------------


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain_variants(counts, ratio=5):
    near = {w: [o for o in counts if abs(len(o) - len(w)) <= 1 and is_near(o, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return [(w, f, root(w), counts[w], len(near[w]), counts[f] if f else None) for w, f in form.items()]


def plain_counts(docs, every, least_length=6, least=5):
    total = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if every:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % every == 0:
                    k = h % len(run)
                    run = run[:k] + run[k + 1 :]
            if len(run) >= least_length:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= least}


@pytest.mark.parametrize(("letters", "parts", "block_rows"), [("ab", 3, 8_192), ("ab", 3, 20), ("abcdeé", 4, 8_192), ("abcdeé", 5, 5)])
def test_variants_equal_all_pairs(spark, letters, parts, block_rows):
    draw = random.Random(letters + str(parts))
    counts = {"".join(draw.choice(letters) for _ in range(draw.randint(6, 9))): 5 * draw.choice([1, 1, 2, 5, 7, 30, 200, 1000]) for _ in range(300)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    same(rows(spelling.variants(frame, parts=parts, block_rows=block_rows)), plain_variants(counts))


def test_a_long_chain_of_forms(spark):
    counts = {"abcdef" + "x" * k: 5 * 6 ** (9 - k) for k in range(10)}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    found = {r[0]: r[2] for r in rows(spelling.variants(frame))}
    assert set(found.values()) == {"abcdef"}


def test_long_words(spark):
    counts = {"a" * 3_000: 100, "a" * 2_999: 5, "a" * 2_998 + "b": 7, "b" * 2_999: 9, "ab" * 1_500: 8}
    frame = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    same(rows(spelling.variants(frame)), plain_variants(counts))


@there
@pytest.mark.parametrize("every", [None, 199, 3])
def test_variants_of_documents(spark, every):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = plain_counts(rows(docs.select("doc_id", "text")), every)
    found = spelling.word_counts(docs, every=every)
    same(rows(found), list(counts.items()))
    least = dict(sorted(counts.items(), key=lambda r: (-r[1], r[0]))[:1_500])
    same(rows(spelling.variants(spark.createDataFrame(list(least.items()), "word string, n bigint"))), plain_variants(least))


def test_words_of_tricky_rows(spark, tricky, empty, clashing, monkeypatch):
    docs = rows(tricky.select("doc_id", "text"))
    for every in (None, 2):
        expected = list(plain_counts(docs, every, 1, 1).items())
        same(rows(spelling.word_counts(tricky, min_length=1, min_count=1, every=every)), expected)
        same(rows(spelling.word_counts(clashing, min_length=1, min_count=1, every=every)), expected)
    assert rows(spelling.word_counts(empty)) == []
    assert rows(spelling.variants(spelling.word_counts(empty))) == []
    monkeypatch.setattr(spelling, "_COUNTED", 3)
    batch = [spelling.pa.RecordBatch.from_arrays([spelling.pa.array(["1", "2"]), spelling.pa.array(["aa bb cc dd", "aa"])], ["id", "text"])]
    parts = list(spelling._count(iter(batch), 1, None))
    assert len(parts) == 2 and sum(sum(p.column(1).to_pylist()) for p in parts) == 5


# --- alignment ---------------------------------------------------------------------------

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def coders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path(A))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(B))
    alphabet = alignment._byte_alphabet()

    def piece(i):
        own = b.id_to_piece(i)
        return bytes([int(own[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", own) else own.replace("▁", " ").encode()

    def cut(text):
        """Groups of (A ids, B ids)."""
        if not text:
            return []
        x = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        y = [(i, piece(i)) for i in b.encode(text)]
        raw = (" " + text).encode()
        if b"".join(s for _, s in x) != raw or b"".join(s for _, s in y) != raw:
            return []
        ends = []
        for tokens in (x, y):
            at, own = 0, []
            for _, s in tokens:
                at += len(s)
                own.append(at)
            ends.append(own)
        both = set(ends[0]) & set(ends[1])
        sides = []
        for tokens, own in ((x, ends[0]), (y, ends[1])):
            split, here = [], []
            for (i, _), e in zip(tokens, own, strict=True):
                here.append(i)
                if e in both:
                    split.append(here)
                    here = []
            sides.append(split)
        return list(zip(*sides, strict=True))

    return cut


def plain_alignment(docs, cut):
    found = [(i, cut(text)) for i, text in docs]
    counts = Counter()
    for _, groups in found:
        counts.update({(p, q) for xs, ys in groups for p in xs for q in ys})
    top = Counter()
    for (p, _), n in counts.items():
        top[p] = max(top[p], n)
    out = []
    for i, groups in found:
        links = [(p, q) for xs, ys in groups for p in xs for q in ys]
        told = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(counts[link] == top[link[0]] for link in links),
                    sum(counts[link] for link in links), hashlib.sha256(told.encode()).hexdigest() if groups else ""))
    return out


def found_alignment(df, **settings):
    return rows(alignment.alignment(df, tokenizer_path(A), tokenizer_path(B), **settings))


@there
@pytest.mark.parametrize("slice_bytes", [8 << 20, 20_000])
def test_alignment(spark, coders, slice_bytes):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(3)
    same(found_alignment(docs, slice_bytes=slice_bytes), plain_alignment(rows(docs.select("doc_id", "text")), coders))


def test_alignment_of_tricky_rows(spark, tricky, empty, clashing, coders):
    docs = rows(tricky.select("doc_id", "text"))
    expected = plain_alignment(docs, coders)
    same(found_alignment(tricky, slice_bytes=100), expected)
    same(found_alignment(clashing), expected)
    assert found_alignment(empty) == []
    strings = tricky.withColumn("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string")))
    same([r[1:] for r in found_alignment(strings)], [r[1:] for r in expected])


def test_awkward_texts(spark, coders):
    texts = ["a" * 20_000, " " * 5_000 + "x", "\n" * 3_000, "<|endoftext|> <s> </s> <0x41> <unk>", "a\u0000b \x7f", "ﬁ ① Ａ é", "  two  spaces ", "▁x", "�", "x"]
    docs = list(enumerate(texts))
    same(found_alignment(spark.createDataFrame(docs, "doc_id bigint, text string")), plain_alignment(docs, coders))


def test_pair_counts_and_links(spark, coders):
    docs = [(0, "one two"), (1, "one three"), (2, "one two two")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    counts = Counter()
    for _, text in docs:
        counts.update({(p, q) for xs, ys in coders(text) for p in xs for q in ys})
    found = rows(alignment.pair_counts(frame, tokenizer_path(A), tokenizer_path(B)))
    assert {(a, b): n for a, b, n, _ in found} == dict(counts)
    for r in alignment.token_links(frame, tokenizer_path(A), tokenizer_path(B)).collect():
        groups = coders(dict(docs)[r["id"]])
        assert [[i for i, g in zip(r["a_ids"], r["a_group"], strict=True) if g == k] for k in range(len(groups))] == [x for x, _ in groups]
        assert [[i for i, g in zip(r["b_ids"], r["b_group"], strict=True) if g == k] for k in range(len(groups))] == [y for _, y in groups]
        assert sum(link["bytes"] for link in r["overlaps"]) == len(dict(docs)[r["id"]]) + 1


def test_products_equal_dense_ones():
    draw = np.random.default_rng(4)
    x, y = draw.integers(0, 3, (7, 5)), draw.integers(0, 3, (6, 5))

    def csr(m):
        row, column = np.nonzero(m)
        return alignment.Csr(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(m))))), column, m[row, column], m.shape[1])

    product = csr(x).times(csr(y).transposed())
    dense = np.zeros((7, 6), int)
    dense[product.rows(), product.indices] = product.data
    assert (dense == x @ y.T).all()


def test_other_vocabularies_are_left_to_their_library(tmp_path):
    import json

    form = json.loads(Path(tokenizer_path(A)).read_text())
    assert alignment.ByteLevel(tokenizer_path(A))._fast is not None
    form["model"]["merges"][10], form["model"]["merges"][11] = form["model"]["merges"][11], form["model"]["merges"][10]
    path = tmp_path / "other.json"
    path.write_text(json.dumps(form))
    assert alignment.ByteLevel(str(path))._fast is None
