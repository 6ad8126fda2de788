"""The pipeline and the forms of its operators that drop or repeat rows, against plain versions."""

from __future__ import annotations

import random
import struct
import sys
import zlib
from collections import Counter
from pathlib import Path

import plain
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from quillsieve.llm import decontaminate, mixing, records, simhash_dedup, toxicity  # noqa: E402
from quillsieve.llm.queries import tokenizer_path  # noqa: E402

ITEMS = [(1, "one two three four five six seven eight nine ten eleven twelve"), (10, "x"), (2, "W5 w6, w7"), (3, None), (4, "..."),
         (5, "one two three four five six seven eight nine ten"), (1, "漢字 übergrößé"), (11, " ".join(f"w{i}" for i in range(20, 40)))]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows(df):
    return [tuple(r) for r in df.collect()]


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def same(found, expected):
    assert sorted(found, key=key) == sorted(expected, key=key)


def awkward():
    """Null ids, ids that rows of other texts and sources share, equal rows, empty texts."""
    draw = random.Random(8)
    some = [f"w{k}" for k in range(60)]
    texts = [" ".join(draw.choices(some, k=draw.randint(0, 30))) for _ in range(60)]
    out = [(k % 40 if k % 7 else None, t, "en", draw.choice(["a", "b", None]), len(t)) for k, t in enumerate(texts)]
    return [*out, out[3], out[3], (99, None, "en", "a", 0), (98, "", "en", "a", 0), (98, "", "en", "b", 0), (97, ITEMS[0][1], "en", "b", 1), (97, "clean words", "en", "b", 1)]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(awkward(), SCHEMA).repartition(3)


def plain_mix(docs, max_epochs=3):
    """Rows with their copies: in each source by (draw, id, size) until the target is met."""
    def size(text):
        return len(plain.re.findall(r"[^\x20\x09-\x0D]+", text or ""))

    def order(row):
        import hashlib

        told = "mix" if row[0] is None else f"mix:{row[0]}"
        return int(hashlib.md5(told.encode()).hexdigest()[:8], 16), row[0] is not None, row[0] or 0, size(row[1])

    sizes = Counter()
    for r in docs:
        sizes[r[3]] += size(r[1])
    target, out = plain.water_fill(sizes), []
    for source, total in sizes.items():
        whole = int(target[source] // total) if total else 0
        room, upto, last = target[source] - whole * total, 0, None
        own = sorted((r for r in docs if r[3] == source), key=order)
        for r in own:
            upto += size(r[1])
            if 2 * upto - size(r[1]) <= 2 * room:
                last = order(r)
        for r in own:
            out += [r] * (whole + (whole < max_epochs and last is not None and order(r) <= last))
    return out


def test_mixed_rows(spark, docs, tricky, empty, clashing):
    same(rows(mixing.mixed(docs)), plain_mix(awkward()))
    same(rows(mixing.mixed(tricky)), plain_mix(rows(tricky)))
    wide = mixing.mixed(clashing)
    assert wide.columns == clashing.columns
    same([r[:5] for r in rows(wide)], plain_mix(rows(tricky)))
    assert rows(mixing.mixed(empty)) == []


def test_no_row_is_repeated_too_often(spark):
    some = [(k, "" if k % 2 else "one", "en", "small", 0) for k in range(20)] + [(100 + k, "many words here " * 50, "en", "large", 0) for k in range(40)]
    frame = spark.createDataFrame(some, SCHEMA)
    copies = Counter(r["doc_id"] for r in mixing.mixed(frame, weights=(1, 100)).collect())
    assert max(copies.values()) <= 3


def test_ids_that_sources_share(spark):
    some = [(k, "a b c", "en", s, 0) for k in range(30) for s in ("a", "b", "c")]
    frame = spark.createDataFrame(some, SCHEMA)
    planned = {(r["source"], r["id"]): r["copies"] for r in mixing.mix(frame).collect()}
    found = Counter((r["source"], r["doc_id"]) for r in mixing.mixed(frame).collect())
    assert found == Counter({k: n for k, n in planned.items() if n})


@pytest.mark.parametrize("block_words", [1_000_000, 12, 1])
def test_contamination_of_rows_that_share_ids(spark, docs, tricky, clashing, block_words):
    items = spark.createDataFrame(ITEMS, "item_id int, text string")
    for frame in (docs, tricky, clashing):
        own = rows(frame.select("doc_id", "text"))
        expected = plain.contamination(own, ITEMS)
        same(rows(decontaminate.with_digest(decontaminate.contamination(frame, items, block_words=block_words))), expected)
        kept = decontaminate.drop_contaminated(frame, items, block_words=block_words)
        assert kept.schema == frame.schema
        same(rows(kept.select("doc_id", "text")), [r for r, e in zip(own, expected, strict=True) if not e[-1]])
        assert rows(kept.select(*frame.columns[5:]).distinct()) in ([()], [("x",) * (len(frame.columns) - 5)])


def plain_dedup(docs, distance=4):
    """(doc_id, text) that stay."""
    prints = [plain.fingerprint(r[1]) for r in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = label[i], label[j]
                label = [min(a, b) if x in (a, b) else x for x in label]
    least = {}
    for r, c in zip(docs, label, strict=True):
        if r[0] is not None:
            least[c] = min(r[0], least.get(c, r[0]))
    return [(r[0], c) for r, c in zip(docs, label, strict=True) if r[0] is None], Counter(least.values())


def test_one_of_each_component_stays(spark, docs, tricky, clashing, empty):
    for frame in (docs, tricky, clashing):
        own = rows(frame)
        nameless, least = plain_dedup(own)
        kept = simhash_dedup.drop_near_duplicates(frame)
        assert kept.columns == frame.columns
        found = rows(kept)
        assert Counter(r[0] for r in found if r[0] is not None) == least
        assert sum(r[0] is None for r in found) == len(nameless)
        assert set(found) <= set(own)
        same(rows(simhash_dedup.drop_near_duplicates(frame.repartition(5))), found)
    assert rows(simhash_dedup.drop_near_duplicates(empty)) == []


def test_a_namesake_with_another_text_stays(spark):
    far = " ".join(f"w{k}" for k in range(50))
    some = [(1, "one two three four five", "en", "a", 0), (1, far, "en", "a", 0), (2, far, "en", "a", 0), (2, "seven eight nine ten", "en", "a", 0)]
    kept = rows(simhash_dedup.drop_near_duplicates(spark.createDataFrame(some, SCHEMA)).select("doc_id", "text"))
    same(kept, [(1, some[0][1]), (1, far), (2, some[3][1])])


def test_a_long_clean_text_is_not_toxic(spark):
    folder = "/root/testdata/sf0.01"
    if not Path(folder).exists():
        pytest.skip("test tables are not there")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    neutral = "The river runs to the sea. It was a plain day. "
    scores = [model.score(neutral * n) for n in (1, 100, 50_000)]
    assert max(scores) < 0.3
    worst = max(model.weights, key=model.weights.get).rstrip("*")
    assert model.score(neutral * 50_000 + worst + " " + worst) >= model.score(neutral)


def test_tokenizers_of_another_form_encode_whole_texts():
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    texts = ["Hello World, it's  odd", "", "é ü\n\nx", "WORD word"]
    own = Tokenizer.from_file(path)
    found = records.Encoder(path).encode(texts, 7)
    assert found == [struct.pack(f"<{len(ids) + 1}H", *ids, 7) for ids in (own.encode(t, add_special_tokens=False).ids for t in texts)]
    assert records.Encoder(tokenizer_path())._words


def test_pipeline(spark, monkeypatch, docs, tmp_path):
    """Every stage against its plain version on what the stage before has kept."""
    monkeypatch.setattr(toxicity, "MIN_DOCS", 1)
    labels = [(r[0], 1, int(k % 3 == 0)) for k, r in enumerate(awkward())]
    spark.createDataFrame(awkward(), SCHEMA).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}
    stages = []
    for name, function in corpus_pipeline.STAGES:
        def kept_too(spark, docs, sf_dir, name=name, function=function):
            kept[name] = rows(docs)
            return function(spark, docs, sf_dir)

        stages.append((name, kept_too))
    monkeypatch.setattr(corpus_pipeline, "STAGES", stages)
    out = rows(corpus_pipeline.run(spark, str(tmp_path)))
    assert [n for n, _ in stages] == list(kept)
    first, toxic_free, unique, clean, mixed = kept["toxicity"], kept["simhash_near_dedup"], kept["decontamination"], kept["mixing"], kept["token_records"]
    same(first, awkward())
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    same(toxic_free, [r for r in first if model.score(r[1]) < 0.3])
    nameless, least = plain_dedup(toxic_free)
    assert Counter(r[0] for r in unique if r[0] is not None) == least and sum(r[0] is None for r in unique) == len(nameless)
    hit = plain.contamination([r[:2] for r in unique], ITEMS)
    same(clean, [r for r, e in zip(unique, hit, strict=True) if not e[-1]])
    same(mixed, plain_mix(clean))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    expected, start = [], 0
    tokens = sorted(((r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""), tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in mixed)
    for (named, doc_id, *_), ids in tokens:
        expected.append((doc_id if named else None, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    same(out, expected)


def test_pipeline_of_an_empty_table(spark, empty):
    for name, function in corpus_pipeline.STAGES:
        folder = "/root/testdata/sf0.001"
        if not Path(folder).exists():
            pytest.skip("test tables are not there")
        assert rows(function(spark, empty, folder)) == [], name


def test_pipeline_keeps_clashing_columns(spark, clashing):
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("test tables are not there")
    docs = clashing
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, folder)
        assert out.columns == clashing.columns, name
        assert rows(out.select(*clashing.columns[5:]).distinct()) in ([], [("x",) * (len(clashing.columns) - 5)]), name
        docs = spark.createDataFrame(rows(out), clashing.schema)
