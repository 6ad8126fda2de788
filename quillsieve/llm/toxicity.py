"""Toxicity by multiple-instance learning: document labels train a sentence model.

A document is a bag of sentences. A sentence is toxic with the probability of a logistic
model over its distinct words, each by itself and by its beginnings of four to six letters (for
endings and compounds); a document is toxic unless none of its sentences is (noisy-or).
The likelihood of the document labels trains the sentence weights, so scores point to the
offending sentences without any sentence label. In a score, all sentences below a probability
of ``EVIDENCE`` together count for less than ``NEUTRAL``: a text does not become toxic by the
mere number of its neutral sentences, however long it is.

The model is fitted on at most ``sample_docs`` labelled documents, those with the smallest
hash of their id, with their whole texts and up to ``sample_bytes`` of them; scoring covers every sentence of every document.
What occurs in fewer than ``min_docs`` sampled documents, or one in 400 of them, has no weight.

Null and empty texts have no sentence and score 0. Labels that are null or belong to no
document are not used; an id with several labels counts as toxic if one of them is.
Without a toxic and a clean document in the sample every score is the share of toxic ones.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillsieve.llm.common import slices

THRESHOLD = 0.3
SAMPLE_DOCS = 4_000
SAMPLE_BYTES = 64 << 20
MIN_DOCS = 3
HELD_OUT = 2
FOLDS = 4
_SENTENCE = re.compile(r"[.!?\n。！？]+")
_WORD = re.compile(r"\w+")
_BEGINNINGS = (4, 5, 6)
_ROUNDS = 150
_STEP = 0.15
_L1 = 2e-4
_BIAS = -6.0
# Least probability of a sentence that counts by itself.
EVIDENCE = 0.02
# Most that the others can add to a score.
NEUTRAL = 0.1


def sentences(text: str) -> list[str]:
    return [s for s in map(str.strip, _SENTENCE.split(text)) if s]


def words(sentence: str) -> set[str]:
    return set(_WORD.findall(sentence.lower()))


def features(word: str) -> list[str]:
    """The word and its beginnings."""
    return [word, *[word[:n] + "*" for n in _BEGINNINGS if len(word) > n]]


def _probability(z: float) -> float:
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS))


@dataclass
class SentenceModel:
    bias: float = _BIAS
    weights: dict[str, float] = field(default_factory=dict)
    constant: float | None = None

    def __post_init__(self):
        # the first letters of all that has a weight: a text without them needs no closer look
        self._starts = {f.rstrip("*")[: min(_BEGINNINGS)] for f in self.weights}

    def _weighted(self, text: str) -> dict[str, float]:
        """The weights of a text's words, for those that may have one."""
        first, starts, get = min(_BEGINNINGS), self._starts, self.weights.get
        return {w: sum(get(f, 0.0) for f in features(w)) for w in words(text) if w[:first] in starts}

    def sentence_scores(self, text: str) -> list[float]:
        """Probability of each sentence. A sentence without any weighted word has that of the
        bias alone."""
        parts, weighted = sentences(text), self._weighted(text)
        if not weighted:
            return [_probability(self.bias)] * len(parts)
        return [_probability(self.bias + sum(weighted.get(w, 0.0) for w in sorted(words(s)))) for s in parts]

    def score(self, text: str | None) -> float:
        if self.constant is not None:
            return self.constant
        scores = self.sentence_scores(text or "")
        clean = math.fsum(math.log1p(-min(p, 1 - 1e-12)) for p in scores if p >= EVIDENCE)
        neutral = math.fsum(p for p in scores if p < EVIDENCE)
        return -math.expm1(clean + math.log1p(NEUTRAL * math.expm1(-neutral / NEUTRAL)))


def fit(docs: list[tuple[int, str]], min_docs: int = MIN_DOCS) -> SentenceModel:
    """Model of (label, text) pairs: Adam on the noisy-or likelihood with a proximal L1 step."""
    labels = np.array([y for y, _ in docs], float)
    if not len(docs) or labels.min() == labels.max():
        return SentenceModel(constant=float(labels.mean()) if len(docs) else 0.0)
    seen: Counter[str] = Counter()
    for _, text in docs:
        seen.update({f for w in words(text) for f in features(w)})
    least = max(min_docs, len(docs) // 400)
    number = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= least))}
    known: dict[str, list[int]] = {}

    def numbers(word: str) -> list[int]:
        if word not in known:
            known[word] = [number[f] for f in features(word) if f in number]
        return known[word]

    bags = [[[n for w in sorted(words(s)) for n in numbers(w)] for s in sentences(t)] for _, t in docs]
    doc_of = np.repeat(np.arange(len(docs)), [len(b) for b in bags])
    flat = [np.array(s, np.int32) for bag in bags for s in bag]
    sentence_of = np.repeat(np.arange(len(flat)), [len(s) for s in flat])
    word = np.concatenate([np.zeros(0, np.int32), *flat])
    n_docs, n_words = len(docs), len(number)
    weights, bias = np.zeros(n_words + 1), np.array(_BIAS)
    first, second = np.zeros(n_words + 1), np.zeros(n_words + 1)
    weights[-1] = bias
    for step in range(1, _ROUNDS + 1):
        z = weights[-1] + np.bincount(sentence_of, weights[word], len(flat))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        clean = np.exp(np.bincount(doc_of, -np.logaddexp(0, z), n_docs))
        pull = np.where(labels > 0, -clean / np.maximum(1 - clean, 1e-9), 1.0)
        slope = pull[doc_of] * p / n_docs
        gradient = np.append(np.bincount(word, slope[sentence_of], n_words), slope.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        rate = _STEP / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        weights -= rate * first / (1 - 0.9**step)
        weights[:-1] = np.sign(weights[:-1]) * np.maximum(np.abs(weights[:-1]) - rate[:-1] * _L1, 0)
    kept = {w: float(weights[i]) for w, i in number.items() if abs(weights[i]) > 1e-3}
    return SentenceModel(float(weights[-1]), kept)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> SentenceModel:
    """Fit on labelled documents outside the held-out fold."""
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col)) != HELD_OUT))
    per_id = usable.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).cast("int").alias("y"))
    ids = per_id.orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(ids), "id").orderBy(F.xxhash64("id"), "id", "text").limit(sample_docs)
    kept, size = [], 0
    for row in sample.toLocalIterator():
        size += len(row["text"])
        if kept and size > sample_bytes:
            break
        kept.append((row["y"], row["text"]))
    return fit(kept)


def score(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                scores = [sent.value.score(t) for t in batch.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["id", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id bigint, score double")


def offending_sentences(docs: DataFrame, model: SentenceModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, sentence, score, text) of the sentences that score ``threshold`` or more, counted
    from 0."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                rows = [(i, k, p, s) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                        for k, (p, s) in enumerate(zip(sent.value.sentence_scores(t or ""), sentences(t or ""), strict=True)) if p >= threshold]
                columns = list(zip(*rows, strict=True)) or [[], [], [], []]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["id", "sentence", "score", "text"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, "id bigint, sentence bigint, score double, text string")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    scored = score(docs, train(docs, labels, id_col=id_col, text_col=text_col, sample_docs=sample_docs), id_col, text_col)
    return scored.select("id", (fold(F.col("id")) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
               sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Rows whose text scores below the threshold; each row is judged by its own text."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, sample_docs=sample_docs)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, column=place):
                keep = [sent.value.score(t) < threshold for t in batch.column(place).to_pylist()]
                yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
