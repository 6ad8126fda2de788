"""Token ids as length-delimited binary records with masked checksums.

A data file is a row of records: length of the payload (unsigned 64-bit, little-endian),
masked CRC-32C of these 8 bytes, payload, masked CRC-32C of the payload; the framing of
TFRecord files. The payload is the ids of one document, little-endian unsigned 16-bit, or
32-bit if the vocabulary needs it. An index is a Parquet table beside the data with a row
per record (shard, row, id, offset, length, tokens, tokens before it in the shard), so a reader can fetch
records in any order.

Documents are sorted by id over all shards. Null and empty texts give a record with the
end id only; rows with a null id come first; rows that repeat an id each give a record.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import SharedFile, open_fs, slices
from quillsieve.session import stage, stage_path

END_ID = 2
# Bytes of text for one shard, records in one read.
SHARD_BYTES = 64 << 20
READ_BYTES = 4 << 20
_MASK_DELTA = 0xA282EAD8  # fixed value of the format
_POLYNOMIAL = 0x82F63B78  # CRC-32C, reflected
_BLOCK = 256
_CACHE_WORDS = 400_000
_JOINED = 1_000
# The cut into words that the shortcut of the encoder holds for (a fixed value of the file).
_WORD_CUT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# ASCII punctuation behind a letter that stays one letter in lower case.
_PUNCTUATION = re.compile(r"[!-/:-@\[-`{-~](?<=[A-Za-zÀ-ÖØ-öø-ÿ].)")


@lru_cache(maxsize=1)
def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The table of one byte, and four tables that move a register past a block of zeros."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(_POLYNOMIAL), step >> 1).astype(np.uint32)
    moved = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    for _ in range(_BLOCK):
        moved = step[moved & 0xFF] ^ (moved >> np.uint32(8))
    return step, moved


def _past_block(crc: np.ndarray) -> np.ndarray:
    _, moved = _crc_tables()
    return moved[0][crc & 0xFF] ^ moved[1][(crc >> 8) & 0xFF] ^ moved[2][(crc >> 16) & 0xFF] ^ moved[3][crc >> 24]


def crc32c(payloads: list[bytes]) -> np.ndarray:
    """CRC-32C of each payload. All are cut into blocks, which are worked off side by side;
    zeros in front fill the first block, as they do not change an empty register."""
    step, _ = _crc_tables()
    sizes = np.array([len(p) for p in payloads], np.int64)
    blocks = -(-sizes // _BLOCK)
    first = np.cumsum(blocks) - blocks
    data = np.zeros((int(blocks.sum()), _BLOCK), np.uint8)
    flat = data.reshape(-1)
    for payload, n, at, size in zip(payloads, blocks.tolist(), first.tolist(), sizes.tolist(), strict=True):
        if not n:
            continue
        begin = (at + n) * _BLOCK - size
        flat[begin : begin + size] = np.frombuffer(payload, np.uint8)
        if size >= 4:
            flat[begin : begin + 4] ^= 0xFF  # a register that begins with ones
    crc = np.zeros(len(data), np.uint32)
    for column in np.ascontiguousarray(data.T):
        crc = step[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
    out = np.zeros(len(payloads), np.uint32)
    order = np.argsort(-blocks, kind="stable")
    for k in range(int(blocks.max()) if len(blocks) else 0):
        live = order[: np.searchsorted(-blocks[order], -k, "left")]
        out[live] = _past_block(out[live]) ^ crc[first[live] + k]
    for i in np.flatnonzero(sizes < 4):
        register = 0xFFFFFFFF
        for byte in payloads[i]:
            register = int(step[(register ^ byte) & 0xFF]) ^ (register >> 8)
        out[i] = register
    return out ^ np.uint32(0xFFFFFFFF)


def masked(crc: np.ndarray) -> np.ndarray:
    return (((crc >> np.uint32(15)) | (crc << np.uint32(17))) + np.uint32(_MASK_DELTA)).astype(np.uint32)


def frame(payloads: list[bytes]) -> list[bytes]:
    """Each payload with its lengths and checksums."""
    heads = [struct.pack("<Q", len(p)) for p in payloads]
    head_crc, body_crc = masked(crc32c(heads)).tolist(), masked(crc32c(payloads)).tolist()
    return [b"".join((h, struct.pack("<I", a), p, struct.pack("<I", b))) for h, a, p, b in zip(heads, head_crc, payloads, body_crc, strict=True)]


def unframe(data: bytes, offsets: list[int]) -> list[bytes]:
    """Payloads of the records that begin at the offsets; raises on a broken checksum."""
    heads = [data[o : o + 8] for o in offsets]
    payloads = [data[o + 12 : o + 12 + int.from_bytes(h, "little")] for o, h in zip(offsets, heads, strict=True)]
    told = np.array([(int.from_bytes(data[o + 8 : o + 12], "little"), int.from_bytes(data[o + 12 + len(p) : o + 16 + len(p)], "little"))
                     for o, p in zip(offsets, payloads, strict=True)], np.uint64).reshape(-1, 2)
    if (masked(crc32c(heads)) != told[:, 0]).any() or (masked(crc32c(payloads)) != told[:, 1]).any():
        raise ValueError("a record's checksum does not fit its bytes")
    return payloads


def _by_words(form: dict) -> bool:
    """Whether a tokenizer's file folds case, drops white space and ends words with ``</w>``
    in the way that :class:`Encoder` cuts texts for."""
    def has(part: str, kind: str) -> list[dict]:
        parts = form.get(part) or {}
        return [p for p in parts.get("normalizers", parts.get("pretokenizers", [parts])) if p.get("type") == kind]

    model = form.get("model") or {}
    cut = [p for p in has("pre_tokenizer", "Split") if p.get("invert") and p.get("behavior") == "Removed"]
    return (
        model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("continuing_subword_prefix") and not model.get("dropout")
        and bool(has("normalizer", "Lowercase")) and [p["pattern"].get("Regex") for p in cut] == [_WORD_CUT])


class Encoder:
    """Ids of whole texts by a tokenizer.

    Texts are encoded whole, unless the tokenizer's file says that it drops white space and
    ends words with ``</w>``. Then a text's ids are those of its pieces between spaces, line breaks and the places where ASCII
    punctuation follows a Latin letter, as no word of the tokenizer reaches past these. The
    pieces' ids are remembered. New words of letters only are encoded many at a time and cut
    at the word ends; should the count of ends differ from that of words, and for all other
    pieces, each is encoded alone.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._known: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            self._words = _by_words(json.load(file))
        vocabulary = self._tokenizer.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kind = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")

    @staticmethod
    def pieces(text: str) -> list[str]:
        if "<|" not in text:  # else a special token may stand there, which must stay whole
            text = _PUNCTUATION.sub(r" \g<0>", text)
            if text.isascii():
                text = text.lower()
        return text.replace("\n", " ").split(" ")

    def _each(self, pieces: list[str]) -> Iterator[np.ndarray]:
        for found in self._tokenizer.encode_batch_fast(pieces, add_special_tokens=False):
            yield np.array(found.ids, self.kind)

    def _learn(self, fresh: list[str]) -> None:
        words = [p for p in fresh if p.isalpha()]
        alone = [p for p in fresh if not p.isalpha()]
        parts = [words[at : at + _JOINED] for at in range(0, len(words), _JOINED)]
        for part, ids in zip(parts, self._each([" ".join(part) for part in parts]), strict=True):
            cuts = ((np.flatnonzero(self._ends[ids]) + 1) * self.kind.itemsize).tolist()
            if len(cuts) != len(part):
                alone += part
                continue
            data = ids.tobytes()
            self._known.update(zip(part, map(data.__getitem__, map(slice, [0, *cuts], cuts)), strict=True))
        for at in range(0, len(alone), _JOINED):
            part = alone[at : at + _JOINED]
            self._known.update(zip(part, (ids.tobytes() for ids in self._each(part)), strict=True))

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """The ids of each text and the end id, in the width of the vocabulary."""
        if not self._words:
            return [np.append(ids, np.array([end_id], self.kind)).tobytes() for ids in self._each(texts)]
        pieces = [self.pieces(t) for t in texts]
        used = set(chain.from_iterable(pieces))
        if len(self._known) > _CACHE_WORDS:  # the pieces at hand stay, frequent ones among them
            self._known = {p: self._known[p] for p in used & self._known.keys()}
        self._learn(list(used.difference(self._known)))
        end = np.array([end_id], self.kind).tobytes()
        return [b"".join(map(self._known.__getitem__, own)) + end for own in pieces]


def _write(batches: Iterator[pa.RecordBatch], folder: str, tokenizer: str, end_id: int) -> Iterator[pa.RecordBatch]:
    encoder, shard = Encoder(tokenizer), TaskContext.get().partitionId()
    out, tokens, row = None, 0, 0
    for whole in batches:
        for batch in slices(whole):
            out = out or SharedFile(f"{folder}/part-{shard:06d}.records")
            ids = encoder.encode([t or "" for t in batch.column(1).to_pylist()], end_id)
            framed = frame(ids)
            n = np.array([len(x) // encoder.kind.itemsize for x in ids], np.int64)
            length = np.array([len(x) for x in framed], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(n), shard, np.int64)), pa.array(np.arange(row, row + len(n))), batch.column(0),
                 pa.array(out.size + np.cumsum(length) - length), pa.array(length), pa.array(n), pa.array(tokens + np.cumsum(n) - n),
                 pa.array(np.full(len(n), encoder.kind.itemsize, np.int32))],
                ["shard", "row", "id", "offset", "length", "tokens", "before", "width"])
            out.write(b"".join(framed))
            tokens += int(n.sum())
            row += len(n)
    if out:
        out.close()


_INDEX = "shard bigint, row bigint, id bigint, offset bigint, length bigint, tokens bigint, before bigint, width int"


def write_records(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                  end_id: int = END_ID, shards: int | None = None) -> DataFrame:
    """Write data files to ``folder`` and the index to ``folder/index``; the index is returned."""
    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    if shards is None:
        size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        cores = docs.sparkSession.sparkContext.defaultParallelism
        shards = max(cores, -(-size // SHARD_BYTES))
    # equal ids are put in the order of their texts, so that a repeated run writes the same files
    placed = narrow.repartitionByRange(shards, "id").sortWithinPartitions("id", "text")
    index = placed.mapInArrow(partial(_write, folder=folder, tokenizer=tokenizer, end_id=end_id), _INDEX)
    index.write.mode("overwrite").parquet(f"{folder}/index")
    return docs.sparkSession.read.schema(_INDEX).parquet(f"{folder}/index")


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    """Ids of the records of index rows. Rows of one shard that lie together are fetched at
    once, up to ``READ_BYTES`` and at least one record."""
    for batch in batches:
        shard, offset, length = (np.asarray(batch.column(k)) for k in ("shard", "offset", "length"))
        at = 0
        while at < len(shard):
            end, last = at + 1, offset[at] + length[at]
            while end < len(shard) and shard[end] == shard[at] and offset[end] == last and last + length[end] - offset[at] <= READ_BYTES:
                last = offset[end] + length[end]
                end += 1
            system, path = open_fs(f"{folder}/part-{shard[at]:06d}.records")
            with system.open_input_file(path) as file:
                file.seek(int(offset[at]))
                data = file.read(int(last - offset[at]))
            width = np.dtype(f"<u{batch.column('width')[at].as_py()}")
            payloads = unframe(data, (offset[at:end] - offset[at]).tolist())
            rows = batch.slice(at, end - at)
            ids = [np.frombuffer(p, width).astype("<u4") for p in payloads]
            yield pa.RecordBatch.from_arrays(
                [rows.column("shard"), rows.column("row"), rows.column("id"), rows.column("before"),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())],
                ["shard", "row", "id", "before", "n_tokens", "ids"])
            at = end


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """(shard, row, id, before, n_tokens, ids) of the records of an index, or of some of its
    rows in any order; ids are little-endian unsigned 32-bit integers, read from the data
    files with both checksums verified."""
    return index.mapInArrow(partial(_read, folder=folder), "shard bigint, row bigint, id bigint, before bigint, n_tokens bigint, ids binary")


def token_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write all documents, read the files back and return (id, start, n_tokens, ids_crc32)
    from them; start is the number of ids of all documents before."""
    folder = stage_path(docs.sparkSession, "records")
    index = write_records(docs, folder, tokenizer, id_col, text_col, end_id)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _read(batches, folder):
            crc = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(crc, pa.int64())], ["shard", "row", "id", "before", "n_tokens", "ids_crc32"])

    # the index is written shard by shard in order of the offsets, and is read in that order
    read = stage(index.mapInArrow(check, "shard bigint, row bigint, id bigint, before bigint, n_tokens bigint, ids_crc32 bigint"), "records-read")
    shards = read.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn(
        "first", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    # one row per data file of 64 MB of text
    return read.join(shards.select("shard", "first"), "shard").select(
        "id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
