"""Edge cases of the table operators."""

from __future__ import annotations

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from quillsieve.operators import dedup, diversity, gates, normalize, ranking, rules, scoring, selection, stats, verify
from quillsieve.operators.gates import metric
from quillsieve.session import lookup_join


def _evals(spark, rows):
    return spark.createDataFrame([(str(i), e) for i, e in enumerate(rows)], "id string, evaluations map<string,double>")


def _ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


# --- normalisation and rules -----------------------------------------------------

def test_response_forms(spark):
    df = spark.createDataFrame([("plain",), ('{"origin_text":"o","rationale":"r","final_answer":"f"}',), ('{"other": 1}',), (None,)], "response string")
    rows = [r["response"] for r in normalize.ensure_response(df).collect()]
    assert tuple(rows[0]) == ("plain",) * 3
    assert tuple(rows[1]) == ("o", "r", "f")
    assert tuple(rows[2]) == ('{"other": 1}',) * 3
    assert rows[3] is None


def test_last_line_split(one):
    found = one(lambda c: normalize.response_from_text(c, "last_line"), ["a\n\nb\n 42 \n\n", "single", ""])
    assert [(r["rationale"], r["final_answer"]) for r in found] == [("a\n\nb", "42"), ("", "single"), ("", "")]


def test_last_per_id_takes_the_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "w")], "id string, ord int, v string")
    assert sorted(map(tuple, normalize.last_per_id(df, ["ord"]).collect())) == [("a", 3, "z"), ("b", 1, "w")]


def test_schema_rules(spark):
    lines = [
        '{"id":"1","instruction":"i","response":"r"}',
        '{"id":"2","instruction":"i","response":{"origin_text":"o"},"metadata":{"difficulty":0.5}}',
        '{"id":3,"instruction":"i","response":"r"}',
        '{"id":"4","instruction":null,"response":"r","metadata":{"difficulty":true}}',
        '{"id":"5","response":"r","metadata":[1]}',
    ]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, l string").withColumn("v", F.try_parse_json("l"))
    rows = df.select("i", rules.schema_reasons(F.col("v")).alias("w"), rules.has_required_fields(F.col("v")).alias("ok")).orderBy("i").collect()
    assert [r["w"] for r in rows] == [
        [], [], ["type:id"], ["type:instruction", "type:metadata.difficulty"], ["missing:instruction", "type:metadata"]]
    assert [r["ok"] for r in rows] == [True, True, True, True, False]


def test_filter_reasons(spark):
    long = "x" * 60
    cases = [
        ("i" * 50, long, []), ("i" * 49, long, ["instruction_length"]), ("i" * 50, "r" * 2001, ["response_length"]),
        (f"\n{long}", f"{long}\t", ["identical"]), (None, long, ["missing"]),
        ("give me JSON " + long, '{"a": ' + '"' + long + '"' + "}", []), ("give me JSON " + long, '{"a": ' + long, ["bad_json"]),
        ("write code " + long, long, ["no_code"]), ("write code " + long, long + "```", []),
        ("write code " + long, long + "\n    a\n\tb\n    c", []), ("write code " + long, long + "\n    a\n\tb", ["no_code"]),
        ("i" * 50, long + " SECRET", ["banned"]),
    ]
    df = spark.createDataFrame([(n, a, b) for n, (a, b, _) in enumerate(cases)], "n int, a string, b string")
    found = df.select("n", rules.filter_reasons(F.col("a"), F.col("b"), banned_patterns=("secret",)).alias("w")).orderBy("n").collect()
    assert [r["w"] for r in found] == [w for _, _, w in cases]


# --- gates and scores ------------------------------------------------------------

def test_quality_gate_defaults(spark):
    ok = {"overall_score": 0.8, "rationale_quality": 0.7, "answer_accuracy": 0.7}
    df = _evals(spark, [ok, {**ok, "safety_score": 0.8}, {**ok, "reasoning_depth": 0.5}, {"overall_score": 0.9}, {}, None,
                        {**ok, "safety_score": 0.9, "reasoning_depth": 0.6}, {**ok, "overall_score": 0.69}])
    assert _ids(gates.filter_by_quality(df)) == ["0", "6"]
    assert _ids(gates.filter_by_quality(df, 0.6)) == ["0", "6", "7"]
    assert _ids(gates.filter_by_metrics(df, {"safety_score": 0.85})) == ["0", "2", "3", "4", "6", "7"]
    assert _ids(gates.filter_by_rationale_and_answer(df)) == ["0", "1", "2", "6", "7"]


def test_overall_and_thresholds(spark):
    df = _evals(spark, [{"safety_score": 1.0, "response_quality": 0.5}, {"rationale_quality": 0.4}, None])
    out = scoring.aggregate_scores(df, thresholds={"rationale_quality": 0.5}, evaluated_at="2024-05-01T00:00:00Z").orderBy("id")
    rows = out.select(metric("overall_score").alias("o"), metric("combined_score").alias("c"), "passes_thresholds").collect()
    assert [tuple(r) for r in rows] == [(0.75, 0.0, True), (0.0, 0.2, False), (0.0, 0.0, False)]
    zero = dict.fromkeys(("safety_score", "response_quality"), 0.0)
    assert df.select(scoring.overall_score(zero)).collect()[0][0] == 0.0


def test_rescoring_replaces_only_named_metrics(spark):
    df = _evals(spark, [{"a": 0.1, "b": 0.2}, None])
    rows = scoring.score(df, {"b": lambda: F.lit(0.9)}).orderBy("id").collect()
    assert [r["evaluations"] for r in rows] == [{"a": 0.1, "b": 0.9}, {"b": 0.9}]


def test_verification(spark):
    df = spark.createDataFrame(
        [("Solve it", "it is 4", 4.0), ("Solve it", "it is 4", None), ("Write code", "```py\nx\n```", None), ("Write code", "none", None), ("Hi", "", None)],
        "instruction string, answer string, expected double",
    ).withColumn("response", F.struct(F.col("answer").alias("final_answer")))
    rows = verify.verify(df, expected=F.col("expected")).select("verification.*").collect()
    assert [r["verified"] for r in rows] == [True, False, True, False, True]
    assert rows[1]["results"]["math_validation"]["message"] == "Could not extract answer"
    assert verify.verify(df, methods=("spell_check",)).select("verification.verified").first()[0] is True
    assert verify.verify(df, methods=()).select("verification.verified").first()[0] is True


# --- ranking ---------------------------------------------------------------------

@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = [(f"r{i}", "hot" if i % 3 else f"g{i % 5}", rng.choice([0.5, 0.5, rng.random(), None])) for i in range(3000)]
    return spark.createDataFrame(rows, "id string, grp string, score double").cache()


@pytest.mark.parametrize("k", [1, 7, 700, 5000])
def test_narrowed_top_equals_plain_ranking(scored, k):
    plain = _ids(ranking.top_per_group(scored, k, F.col("score"), F.col("grp")))
    assert _ids(ranking.top_per_group(scored, k, F.col("score"), F.col("grp"), in_place=3)) == plain
    sizes = {r["grp"]: r["count"] for r in scored.groupBy("grp").count().collect()}
    assert len(plain) == sum(min(k, n) for n in sizes.values())


def test_top_with_all_scores_equal(scored):
    same = scored.withColumn("score", F.lit(1.0))
    assert _ids(ranking.top_per_group(same, 50, F.col("score"), in_place=5)) == _ids(ranking.top_per_group(same, 50, F.col("score")))


def test_exact_quantiles(scored):
    values = sorted(r["score"] for r in scored.where("grp = 'hot' and score is not null").collect())
    found = ranking.exact_quantiles(scored, F.col("score"), F.col("grp"), (0.1, 0.5), in_place=4)
    built_in = ranking.exact_quantiles(scored, F.col("score"), F.col("grp"), (0.1, 0.5))
    for g, q in built_in.items():
        assert found[g] == pytest.approx(q, abs=1e-12)
    assert found["hot"][1] == pytest.approx((values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2)


def test_ordinals_are_dense(scored):
    rows = ranking.with_ordinal(scored.select("id")).collect()
    assert sorted(r["ordinal"] for r in rows) == list(range(3000))


def test_latest_per_group(scored):
    out = ranking.latest_per_group(scored, 4, "grp", [F.col("score").desc_nulls_last(), F.col("id")], salts=3)
    plain = {}
    for r in scored.collect():
        plain.setdefault(r["grp"], []).append((-(r["score"] if r["score"] is not None else -1), r["id"]))
    expected = sorted(i for rows in plain.values() for _, i in sorted(rows)[:4])
    assert _ids(out) == expected


def test_lookup_join_with_hot_keys(scored):
    lookup = scored.groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    plain = sorted(map(tuple, lookup_join(scored, lookup, ["grp"]).select("id", "n").collect()))
    assert sorted(map(tuple, lookup_join(scored, lookup, ["grp"], max_rows=1).select("id", "n").collect())) == plain


# --- selection -------------------------------------------------------------------

def _simulate(sizes, target, shares):
    """Row by row: every band takes its quota, then borrows what others have left."""
    quota = {b: int(target * s) for b, s in shares.items()}
    quota["medium"] += max(target - sum(quota.values()), 0)
    left = {b: sizes.get(b, 0) for b in selection.BANDS}
    take = dict.fromkeys(selection.BANDS, 0)
    for b in quota:
        own = min(quota[b], left[b])
        left[b] -= own
        take[b] += own
    for b in quota:
        missing = quota[b] - min(quota[b], sizes.get(b, 0))
        for other in ("medium", "easy", "hard"):
            while other != b and missing and left[other]:
                left[other] -= 1
                take[other] += 1
                missing -= 1
    return take


@pytest.mark.parametrize("sizes", [dict(easy=e, medium=m, hard=h) for e, m, h in itertools.product((0, 3, 50), repeat=3)])
def test_band_quotas(sizes):
    shares = {"easy": 0.3, "medium": 0.5, "hard": 0.2}
    target = 21
    found = selection.band_quotas(sizes, target, shares)
    assert found == _simulate(sizes, target, shares)
    assert sum(found.values()) == min(target, sum(sizes.values()))


def test_band_quotas_cut_surplus_and_reject_unknown():
    assert selection.band_quotas(dict(easy=9, medium=9, hard=9), 10, {"easy": 0.5, "medium": 0.5, "hard": 0.5}) == dict(easy=5, medium=5, hard=0)
    with pytest.raises(ValueError):
        selection.band_quotas({}, 10, {"brutal": 1.0})


def test_balanced_selection_returns_everything_when_small(spark):
    df = _evals(spark, [{"instruction_complexity": 0.1}, None]).withColumn("id", F.when(F.col("id") == "0", "x"))
    assert selection.balanced_selection(df, 2, score=F.lit(1.0)).count() == 2


def test_domain_quotas():
    assert selection.domain_quotas({"a": 100, "b": 100, "c": 2}, 30) == {"a": 18, "b": 10, "c": 2}
    assert selection.domain_quotas({"a": 100, "b": 100}, 30, 20) == {"a": 20, "b": 20}
    assert selection.domain_quotas({"a": 100, "b": 100}, 30, 5, {"a": 1.0}) == {"a": 30, "b": 5}
    assert selection.domain_quotas({}, 5) == {}


# --- diversity and statistics ----------------------------------------------------

@pytest.mark.parametrize("values", [[1.0], [2.0] * 6, [0.0, 1.0, 1.0, 5.0], [random.Random(3).gauss(0, 1) ** 3 for _ in range(300)]])
def test_numeric_diversity(spark, values):
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "id string, v double")
    found = [r["d"] for r in diversity.numeric_diversity(df, {"d": F.col("v")}).orderBy(F.col("id").cast("int")).collect()]
    n = len(values)
    if n == 1:
        assert found == [0.5]
        return
    mean = sum(values) / n
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / (n - 1)) * n ** -0.2
    if h == 0:
        assert found == [0.0] * n
        return
    k = [sum(math.exp(-(((x - v) / h) ** 2) / 2) for v in values) for x in values]
    assert found == pytest.approx([1 - x / max(k) for x in k], abs=1e-9)


def test_diversity_of_nothing(spark):
    df = spark.createDataFrame([], "id string, domain string, v double")
    assert diversity.diversity_scores(df, {"domain": F.col("domain"), "content": F.col("v")}).count() == 0


def test_histogram_edges(spark):
    same = spark.createDataFrame([(3.0,)] * 4, "v double")
    rows = stats.histogram(same, F.col("v"), 4).orderBy("bin").collect()
    assert (rows[0]["bin_start"], rows[-1]["bin_end"]) == (2.5, 3.5)
    assert [r["count"] for r in rows] == [0, 0, 4, 0]
    assert stats.histogram(same.where("v > 9"), F.col("v")).count() == 0
    spread = spark.createDataFrame([(float(v),) for v in (0, 1, 1, 10)], "v double")
    assert [r["count"] for r in stats.histogram(spread, F.col("v"), 5).orderBy("bin").collect()] == [3, 0, 0, 0, 1]


def test_statistics_narrowed(scored):
    plain = stats.basic_statistics(scored, {"s": F.col("score"), "none": F.lit(None).cast("double")}).orderBy("metric").collect()
    narrow = stats.basic_statistics(scored, {"s": F.col("score"), "none": F.lit(None).cast("double")}, in_place=5).orderBy("metric").collect()
    assert [tuple(r) for r in plain] == [tuple(r) for r in narrow]
    assert tuple(plain[0]) == ("none", 0.0, 0.0, 0.0, 0.0, 0.0, 0)


# --- duplicates ------------------------------------------------------------------

def _variants():
    """A hot group of near copies, a drifting chain away from it, and loners."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 6))):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10_000)}"
        texts.append(" ".join(copy))
    drift = list(base)
    for i in range(60):
        drift[(7 * i) % len(drift)] = f"d{i}"
        texts.append(" ".join(drift))
    for i in range(60):
        texts.append(" ".join(f"w{rng.randrange(120)}" for _ in range(rng.randrange(1, 90))))
    texts += texts[:5] + [t.upper().replace(" ", "\n ") for t in texts[5:9]]
    return texts


def _brute(texts, threshold):
    sets = []
    for t in texts:
        w = t.lower().split()
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)})
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        same = texts[a].lower().split() == texts[b].lower().split()
        union = len(sets[a] | sets[b])
        if same or (union and len(sets[a] & sets[b]) >= threshold * union - 1e-9):
            parent[root(a)] = root(b)
    groups = {}
    for i in range(len(texts)):
        groups.setdefault(root(i), []).append(i)
    return sorted(sorted(g) for g in groups.values() if len(g) > 1)


@pytest.mark.parametrize("threshold, bucket_rows", [(0.85, 1000), (0.85, 6), (0.7, 6)])
def test_near_duplicates_equal_brute_force(spark, threshold, bucket_rows):
    texts = _variants()
    df = spark.createDataFrame([(f"{i:04d}", t, float(i % 7)) for i, t in enumerate(texts)], "id string, text string, score double")
    rows = dedup.duplicate_clusters(df, F.col("text"), F.col("score"), threshold, bucket_rows).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["cluster"], []).append(r)
    assert sorted(sorted(int(r["id"]) for r in g) for g in groups.values()) == _brute(texts, threshold)
    for g in groups.values():
        best = min(g, key=lambda r: (-(int(r["id"]) % 7), r["id"]))["id"]
        assert {r["keeper"] for r in g} == {best}


def test_no_duplicates(spark):
    df = spark.createDataFrame([("a", "one two three four", 1.0), ("b", "five", 1.0)], "id string, text string, score double")
    clusters = dedup.duplicate_clusters(df, F.col("text"), F.col("score"))
    assert clusters.count() == 0
    assert dedup.drop_near_duplicates(df, clusters).count() == 2


def test_components_of_a_long_chain(spark):
    pairs = [(f"{i:03d}", f"{i + 1:03d}") for i in range(100) if i != 50]
    df = spark.createDataFrame(pairs, "a string, b string")
    found = {r["id"]: r["component"] for r in dedup.connected_components(df, len(pairs)).collect()}
    assert set(found.values()) == {"000", "051"} and len(found) == 101
    assert all(found[f"{i:03d}"] == ("000" if i <= 50 else "051") for i in range(101))


def test_unlike_rows_with_boilerplate_are_not_compared(spark, monkeypatch):
    """Texts of their own around one frequent passage: pairs stay linear in the rows."""
    rng = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(8))
    rows = [(f"{i:04d}", " ".join(f"x{rng.randrange(10**6)}" for _ in range(20)) + " " + passage, 1.0) for i in range(600)]
    rows += [(f"c{i:03d}", rows[i][1] + " tail", 1.0) for i in range(30)]
    df = spark.createDataFrame(rows, "id string, text string, score double")
    seen = []
    similarities = dedup.similarities
    monkeypatch.setattr(dedup, "similarities", lambda pairs, sets: seen.append(pairs.count()) or similarities(pairs, sets))
    assert dedup.duplicate_clusters(df, F.col("text"), F.col("score"), 0.85).count() == 60
    assert sum(seen) <= 60


@pytest.mark.parametrize("bucket_rows", [4, 1000])
def test_short_rows_of_frequent_shingles(spark, bucket_rows):
    """Buckets of unlike rows that pivots cannot settle are dealt out by further shingles."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(3, 14))) for _ in range(250)]
    df = spark.createDataFrame([(f"{i:04d}", t, 1.0) for i, t in enumerate(texts)], "id string, text string, score double")
    rows = dedup.duplicate_clusters(df, F.col("text"), F.col("score"), 0.7, bucket_rows).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["cluster"], []).append(int(r["id"]))
    assert sorted(sorted(g) for g in groups.values()) == _brute(texts, 0.7)


def test_near_duplicates_with_a_band_of_the_shingles(spark, monkeypatch):
    """Counting only a band of the shingles, and no whole sets kept but those of candidate pairs."""
    staged, stage = {}, dedup.stage
    monkeypatch.setattr(dedup, "_WHOLE_ROWS", 0)
    monkeypatch.setattr(dedup, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    texts = _variants()
    texts += [" ".join(f"own{i}w{j}" for j in range(60)) for i in range(40)]
    df = spark.createDataFrame([(f"{i:04d}", t, 1.0) for i, t in enumerate(texts)], "id string, text string, score double")
    groups = {}
    for r in dedup.duplicate_clusters(df, F.col("text"), F.col("score"), 0.85, 1000).collect():
        groups.setdefault(r["cluster"], []).append(int(r["id"]))
    assert sorted(sorted(g) for g in groups.values()) == _brute(texts, 0.85)
    assert "shingles" not in staged
    assert staged["pair-sets"].where(f"id >= '{len(texts) - 40:04d}'").count() == 0


@pytest.mark.parametrize("bucket_rows", [4, 32])
def test_near_copies_at_all_distances(spark, monkeypatch, bucket_rows):
    """Copies with few and many changed words: pivots settle few, and no further shingle parts them."""
    rng = random.Random(7)
    base, texts = [f"w{i}" for i in range(150)], []
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randrange(12)):
            words[rng.randrange(150)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(words))
    df = spark.createDataFrame([(f"{i:04d}", t, 1.0) for i, t in enumerate(texts)], "id string, text string, score double")
    staged, stage_counted = [], dedup.stage_counted
    monkeypatch.setattr(dedup, "stage_counted", lambda df, label: staged.append((label, *stage_counted(df, label))) or staged[-1][1:])
    groups = {}
    for r in dedup.duplicate_clusters(df, F.col("text"), F.col("score"), 0.85, bucket_rows).collect():
        groups.setdefault(r["cluster"], []).append(int(r["id"]))
    assert sorted(sorted(g) for g in groups.values()) == _brute(texts, 0.85)
    rows = [n for label, _, n in staged if label == "postings"]
    assert max(rows) == rows[0]


def test_texts_of_their_own_go_before_sets_are_kept(spark, monkeypatch):
    """Of texts that a band of the shingles shows to be unlike all others no shingles are kept; rows with one id are told apart."""
    rng = random.Random(8)
    long = lambda: " ".join(f"x{rng.randrange(10**9)}" for _ in range(300))
    alike, other = long(), long()
    rows = [(f"o{i:02d}", long(), 1.0) for i in range(30)] + [("a", alike, 1.0), ("b", alike + " tail", 1.0), ("a", other, 1.0), ("n", None, 1.0), ("s", "two words", 1.0)]
    df = spark.createDataFrame(rows, "id string, text string, score double")
    kept = dedup.texts_with_company(df.select("id", "text"), 0.85, 0.5)
    assert sorted((r["id"], r["text"]) for r in kept.where("size(split(text, ' ')) > 2").collect()) == [("a", alike), ("b", alike + " tail")]
    monkeypatch.setattr(dedup, "_WHOLE_ROWS", 0)
    staged, stage = {}, dedup.stage
    monkeypatch.setattr(dedup, "stage", lambda df, label: staged.setdefault(label, stage(df, label)))
    found = dedup.duplicate_clusters(df, F.col("text"), F.col("score"), 0.85).collect()
    assert {(r["id"], r["cluster"], r["keeper"]) for r in found} == {("a", "a", "a"), ("b", "a", "a")}
    assert {r["id"] for label in ("bands", "sets") if label in staged for r in staged[label].collect()} == {"a", "b"}
