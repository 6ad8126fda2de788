"""Links between the tokens of two tokenizers, by products of sparse incidence matrices.

Both tokenizers cut the same bytes, a space and the text. A matrix of tokens by bytes has a
one where a token covers a byte; the row-wise (Gustavson) product of one tokenizer's matrix
with the transpose of the other's gives, for each pair of tokens, the number of bytes that
they share (overlap links). Where the last partner of a token is not the first partner of
the next, both tokenizers end a token: such places cut the tokens into groups, and the
product of the two matrices of tokens by groups links all tokens of a group.

The number of documents that hold a pair of ids linked is counted over the whole corpus.
Texts are worked off in slices; a slice keeps a matrix of its documents by its distinct
pairs, and only the distinct pairs of a slice meet the counts. The matrix and the counts
come together again by the number of the slice, so nothing is as long as the corpus but
rows of bounded size.

Null and empty texts, and texts that either tokenizer does not give back byte for byte, have
no tokens: their figures are zero and their digest is empty. Every row is a document, also
if it repeats another or its id is null; ids of any type are passed through. A long text is
a slice of its own. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StringType, StructField, StructType

from quillsieve.llm.common import ranges, slices, starts_of
from quillsieve.session import stage

# Bytes of text whose products are formed at once, and bytes of text of one slice.
BLOCK_BYTES = 1 << 20
SLICE_BYTES = 8 << 20
_SPACE = "▁"
# GPT-2's cut into words, as the byte-level vocabulary was made for (a fixed value).
_WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_LONG_RUN = re.compile(r"\s{1000}")


@dataclass
class Csr:
    """A sparse matrix by rows: the columns of row i are indices[indptr[i]:indptr[i+1]]."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    width: int

    @classmethod
    def of_ranges(cls, lengths: np.ndarray) -> Csr:
        """Rows that cover consecutive columns, ``lengths[i]`` in row i."""
        indptr = np.concatenate(([0], np.cumsum(lengths)))
        total = int(indptr[-1])
        return cls(indptr, np.arange(total), np.ones(total, np.int64), total)

    @classmethod
    def of_labels(cls, labels: np.ndarray, width: int) -> Csr:
        """One column in each row."""
        return cls(np.arange(len(labels) + 1), labels, np.ones(len(labels), np.int64), width)

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        """Entries are dealt to their columns in order of the rows."""
        order = np.argsort(self.indices, kind="stable")
        indptr = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.width))))
        return Csr(indptr, self.rows()[order], self.data[order], len(self.indptr) - 1)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: row i is the sum of other's rows at the columns of row i."""
        first = other.indptr[self.indices]
        length = other.indptr[self.indices + 1] - first
        at = ranges(first, length)
        row, column = np.repeat(self.rows(), length), other.indices[at]
        value = np.repeat(self.data, length) * other.data[at]
        key = row * other.width + column
        if (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
        begin = starts_of(key)
        row, column = np.divmod(key[begin], max(other.width, 1))
        total = np.add.reduceat(value, begin) if len(begin) else value
        counts = np.bincount(row, minlength=len(self.indptr) - 1)
        return Csr(np.concatenate(([0], np.cumsum(counts))), column, total, other.width)


def overlaps(a_lengths: np.ndarray, b_lengths: np.ndarray) -> Csr:
    """Tokens by tokens: the bytes that a token of A shares with one of B. Lengths are bytes of
    the tokens, none zero, with equal sums."""
    return Csr.of_ranges(a_lengths).times(Csr.of_ranges(b_lengths).transposed())


def groups(shared: Csr) -> tuple[np.ndarray, np.ndarray]:
    """Group of each token of A and of B: a new one begins where the last partner of a token
    is not the first of the next."""
    if not len(shared.indices):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = shared.indices[shared.indptr[:-1]], shared.indices[shared.indptr[1:] - 1]
    a_group = np.concatenate(([0], np.cumsum(last[:-1] != first[1:])))
    b_group = np.zeros(shared.width, np.int64)
    b_group[shared.indices] = a_group[shared.rows()]
    return a_group, b_group


def group_links(a_group: np.ndarray, b_group: np.ndarray) -> Csr:
    """Tokens by tokens: one where both are in the same group."""
    n = int(a_group[-1]) + 1 if len(a_group) else 0
    return Csr.of_labels(a_group, n).times(Csr.of_labels(b_group, n).transposed())


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable
    characters stand for themselves, the other bytes follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Ids and token bytes of a byte-level BPE file; special tokens in a text are plain text.

    If the file's merges are in the order of their ids and its words are cut as usual, the
    same merges are done by a faster library from the same vocabulary; else, and for a text with
    a run of white space that its pattern cannot take, by the library that the file is made for.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as file:
            form = json.load(file)
        alphabet = _byte_alphabet()
        special = {t["content"] for t in form.get("added_tokens", [])}
        vocabulary = {t: i for t, i in form["model"]["vocab"].items() if t not in special}
        spelled = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items()}
        self.bytes = [b""] * (max(self._tokenizer.get_vocab().values()) + 1)
        for raw, i in spelled.items():
            self.bytes[i] = raw
        merges = [m.split(" ") if isinstance(m, str) else m for m in form["model"]["merges"]]
        ids = [vocabulary.get("".join(m), -1) for m in merges]
        letters = {i for t, i in vocabulary.items() if len(t) == 1}
        # any other normal form, cut or option is left to the file's own library
        plain = form.get("normalizer") is None and form["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": form["pre_tokenizer"].get("trim_offsets"),
            **({"use_regex": True} if "use_regex" in form["pre_tokenizer"] else {})}
        options = (form["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        self._fast = None
        if plain and not any(options) and ids == sorted(set(ids)) and letters == set(range(256)) and len(ids) + 256 == len(vocabulary):
            import tiktoken

            self._fast = tiktoken.Encoding("own", pat_str=_WORDS, mergeable_ranks=spelled, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[int]:
        if self._fast is not None and not _LONG_RUN.search(text):
            return self._fast.encode_ordinary(text)
        return self._tokenizer.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids and token bytes of a sentencepiece model, which puts a space in front itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = [self._spelled(i) for i in range(self._model.get_piece_size())]

    def _spelled(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        if self._model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if self._model.is_control(i) or self._model.is_unknown(i):
            return b""
        return piece.replace(_SPACE, " ").encode()

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


@lru_cache(maxsize=2)
def _coders(a_path: str, b_path: str) -> tuple[ByteLevel, Pieces, np.ndarray, np.ndarray, list[str]]:
    """Both tokenizers, the byte lengths of their tokens, and how an id is written in a digest:
    within a run of A, at its end, within a run of B, at its end."""
    a, b = ByteLevel(a_path), Pieces(b_path)
    written = [f"{i}{mark}" for n, mark in ((len(a.bytes), ","), (len(a.bytes), "|"), (len(b.bytes), ","), (len(b.bytes), ";")) for i in range(n)]
    return a, b, np.array([len(x) for x in a.bytes]), np.array([len(x) for x in b.bytes]), written


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers one after another, and the edges of the lists."""
    edges = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
    return np.fromiter((i for x in lists for i in x), np.int64, int(edges[-1])), edges


@dataclass
class Block:
    """Tokens, groups and links of some texts that follow one another."""

    a: np.ndarray
    b: np.ndarray
    a_edge: np.ndarray  # tokens of A before each text, and in all
    b_edge: np.ndarray
    shared: Csr
    a_group: np.ndarray
    b_group: np.ndarray
    links: Csr


def align(texts: list[str | None], a_path: str, b_path: str) -> Block:
    """Align some texts; the end of each is an end of tokens of both, so no group goes past it."""
    a, b, a_bytes, b_bytes, _ = _coders(a_path, b_path)
    used = [t or "" for t in texts]
    a_ids = a.encode([" " + t if t else "" for t in used])
    b_ids = b.encode(used)
    for k, text in enumerate(used):
        raw = (" " + text).encode()
        if not text or b"".join(map(a.bytes.__getitem__, a_ids[k])) != raw or b"".join(map(b.bytes.__getitem__, b_ids[k])) != raw:
            a_ids[k] = b_ids[k] = []
    (a_all, a_edge), (b_all, b_edge) = _flat(a_ids), _flat(b_ids)
    shared = overlaps(a_bytes[a_all], b_bytes[b_all])
    a_group, b_group = groups(shared)
    return Block(a_all, b_all, a_edge, b_edge, shared, a_group, b_group, group_links(a_group, b_group))


def _between(edges: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the values between the edges."""
    sums = np.concatenate(([0], np.cumsum(values)))
    return sums[edges[1:]] - sums[edges[:-1]]


def _digests(block: Block, a_path: str, b_path: str) -> list[str]:
    """SHA-256 of each text's groups, empty without tokens."""
    a_coder, b_coder, *_, written = _coders(a_path, b_path)
    na, nb = len(a_coder.bytes), len(b_coder.bytes)
    if not len(block.a):
        return [""] * (len(block.a_edge) - 1)
    a_last = np.append(block.a_group[1:] != block.a_group[:-1], True)
    b_last = np.append(block.b_group[1:] != block.b_group[:-1], True)
    order = np.empty(len(block.a) + len(block.b), np.int64)
    a_before = np.concatenate(([0], np.cumsum(np.bincount(block.a_group))))
    b_before = np.concatenate(([0], np.cumsum(np.bincount(block.b_group))))
    # the tokens of A stand behind those of B of all groups before, those of B behind A's of their own group too
    order[np.arange(len(block.a)) + b_before[block.a_group]] = block.a + na * a_last
    order[np.arange(len(block.b)) + a_before[block.b_group + 1]] = block.b + 2 * na + nb * b_last
    edges = (block.a_edge + block.b_edge).tolist()
    told = [written[i] for i in order.tolist()]
    return [hashlib.sha256("".join(told[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in zip(edges, edges[1:], strict=False)]


def _document_pairs(block: Block, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair of ids, links) of the distinct pairs of each text."""
    a = block.links.rows()
    pair = block.a[a] * width + block.b[block.links.indices]
    text = np.searchsorted(block.a_edge, a, "right") - 1
    key = np.sort((text << 40) | pair)
    begin = starts_of(key)
    return key[begin] >> 40, key[begin] & ((1 << 40) - 1), np.diff(np.append(begin, len(key)))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from slices(batch, BLOCK_BYTES)


def _scan(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, slice_bytes: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each slice a row with its documents and its matrix (``pos`` -1), and a row for each
    of its distinct pairs, numbered from 0, with the number of its documents that hold it."""
    width = len(_coders(a_path, b_path)[1].bytes)
    number = TaskContext.get().partitionId() << 32
    ids, stats, digests, counts, pairs, links, size = [], [], [], [], [], [], 0

    def ended() -> Iterator[pa.RecordBatch]:
        pair, entry, at = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
        indptr = np.concatenate(([0], np.cumsum(np.concatenate(counts))))
        blob = lambda array: pa.array([array.tobytes()], pa.binary())
        own = pa.chunked_array(ids).combine_chunks()
        nothing = [pa.nulls(1, pa.int32())] * 3
        yield pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([-1], pa.int32()), *nothing,
             pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), pa.array([sum(digests, [])], pa.list_(pa.string())),
             blob(np.concatenate(stats)), blob(indptr), blob(entry.astype(np.uint32)), blob(np.concatenate(links).astype(np.uint32))], schema=schema)
        a, b = np.divmod(pair, width)
        for lo in range(0, len(pair), 50_000):
            part = slice(lo, lo + 50_000)
            n = len(pair[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, number)), pa.array(np.arange(lo, lo + n, dtype=np.int32)), pa.array(a[part].astype(np.int32)),
                 pa.array(b[part].astype(np.int32)), pa.array(at[part].astype(np.int32)), *[pa.nulls(n, f.type) for f in list(schema)[5:]]], schema=schema)

    for batch in _parts(batches):
        block = align(batch.column(1).to_pylist(), a_path, b_path)
        text, pair, times = _document_pairs(block, width)
        rows = batch.num_rows
        last = np.append(block.a_group[1:] != block.a_group[:-1], True)[: len(block.a)]
        stats.append(np.stack([np.diff(block.a_edge), np.diff(block.b_edge), _between(block.a_edge, last), _between(block.a_edge, np.diff(block.links.indptr))], axis=1).astype(np.int64))
        ids.append(batch.column(0))
        digests.append(_digests(block, a_path, b_path))
        counts.append(np.bincount(text, minlength=rows))
        pairs.append(pair)
        links.append(times)
        size += batch.column(1).nbytes
        if size >= slice_bytes:
            yield from ended()
            number += 1
            ids, stats, digests, counts, pairs, links, size = [], [], [], [], [], [], 0
    if ids:
        yield from ended()


def _finish(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The documents of each slice with the sums over their links; rows are sorted by slice and
    position, so a slice's matrix comes before the counts of its pairs."""
    held, n, best = None, [], []

    def summed() -> pa.RecordBatch:
        indptr, entry, times = (np.frombuffer(held[k][0].as_py(), d) for k, d in (("indptr", np.int64), ("entry", np.uint32), ("times", np.uint32)))
        stats = np.frombuffer(held["stats"][0].as_py(), np.int64).reshape(-1, 4)
        every, top = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (n, best))
        times = times.astype(np.int64)
        sums = [_between(indptr, times * weight[entry]) for weight in (top, every)]
        return pa.RecordBatch.from_arrays(
            [held["ids"].flatten(), *[pa.array(stats[:, k]) for k in range(4)], *[pa.array(x.astype(np.int64)) for x in sums], held["digests"].flatten()], schema=schema)

    for batch in batches:
        position = np.asarray(batch.column("pos"))
        edges = np.append(np.flatnonzero(position < 0), batch.num_rows)
        for part, matrix in [(slice(0, edges[0]), None), *((slice(x + 1, y), x) for x, y in zip(edges, edges[1:], strict=False))]:
            if matrix is not None:
                if held is not None:
                    yield summed()
                held = {k: batch.column(k).slice(int(matrix), 1) for k in ("ids", "digests", "stats", "indptr", "entry", "times")}
                n, best = [], []
            n.append(np.asarray(batch.column("n").slice(part.start, part.stop - part.start).fill_null(0)))
            best.append(np.asarray(batch.column("best").slice(part.start, part.stop - part.start).fill_null(0)).astype(np.int64))
    if held is not None:
        yield summed()


def _sliced(docs: DataFrame, a_path: str, b_path: str, id_col: str, text_col: str, slice_bytes: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[id_col].dataType
    schema = StructType([
        StructField("slice", LongType()), *[StructField(k, IntegerType()) for k in ("pos", "a", "b", "docs")],
        StructField("ids", ArrayType(kind)), StructField("digests", ArrayType(StringType())),
        *[StructField(k, BinaryType()) for k in ("stats", "indptr", "entry", "times")]])
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scan = partial(_scan, a_path=a_path, b_path=b_path, slice_bytes=slice_bytes, schema=to_arrow_schema(schema))
    return stage(narrow.mapInArrow(scan, schema), "alignment-slices")


def _counted(sliced: DataFrame) -> DataFrame:
    """(a, b, n, best): documents that hold the pair linked, and whether no pair of ``a`` has more."""
    held = stage(sliced.where("pos >= 0").groupBy("a", "b").agg(F.sum("docs").alias("n")), "alignment-counts")
    top = held.groupBy("a").agg(F.max("n").alias("top"))  # at most a row for each id of A
    return held.join(F.broadcast(top), "a").select("a", "b", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))


def pair_counts(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(a, b, n, best) of all pairs of ids that some document holds linked."""
    return _counted(_sliced(docs, a_path, b_path, id_col, text_col, slice_bytes))


def alignment(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row:
    tokens of both, groups, links within groups, links whose count is the highest of their
    id of A, sum of the counts of the links, and the digest of the groups."""
    from pyspark.sql.pandas.types import to_arrow_schema

    sliced = _sliced(docs, a_path, b_path, id_col, text_col, slice_bytes)
    pairs = sliced.where("pos >= 0").select("slice", "pos", "a", "b")
    blobs = ("ids", "digests", "stats", "indptr", "entry", "times")
    matrices = sliced.where("pos < 0").select("slice", "pos", F.lit(None).cast("bigint").alias("n"), F.lit(None).cast("int").alias("best"), *blobs)
    known = pairs.join(_counted(sliced), ["a", "b"]).select("slice", "pos", "n", "best", *[F.lit(None).cast(sliced.schema[k].dataType).alias(k) for k in blobs])
    schema = StructType([
        StructField("id", docs.schema[id_col].dataType), *[StructField(k, LongType()) for k in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        StructField("groups_sha256", StringType())])
    placed = matrices.unionByName(known).repartition("slice").sortWithinPartitions("slice", "pos")
    return placed.mapInArrow(partial(_finish, schema=to_arrow_schema(schema)), schema)


def token_links(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a_ids, b_ids, a_group, b_group, overlaps) of every row: the tokens of both, the group
    of each, and the overlap links as (a, b, bytes), places of tokens and bytes shared."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = docs.schema[id_col].dataType
    link = StructType([StructField("a", LongType()), StructField("b", LongType()), StructField("bytes", LongType())])
    schema = StructType([StructField("id", kind), *[StructField(k, ArrayType(LongType())) for k in ("a_ids", "b_ids", "a_group", "b_group")],
                         StructField("overlaps", ArrayType(link))])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                block = align([text], a_path, b_path)
                found = zip(block.shared.rows().tolist(), block.shared.indices.tolist(), block.shared.data.tolist(), strict=True)
                rows.append(([x.tolist() for x in (block.a, block.b, block.a_group, block.b_group)], [{"a": a, "b": b, "bytes": n} for a, b, n in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array([r[0][k] for r in rows], pa.list_(pa.int64())) for k in range(4)], pa.array([r[1] for r in rows], arrow.field(5).type)], schema=arrow)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
