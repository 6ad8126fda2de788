"""WARC archives whose records are compressed one by one with a Zstandard dictionary.

An archive is a ``.warc.zst`` file: a skippable frame with the dictionary, then a frame
per record, the first of them a ``warcinfo`` record. The dictionary is built from the first records of the archive (up to
``SAMPLE_BYTES``, held until it is built); an archive with too little to learn from has
none. An index row (archive, offset, length) per record serves readers that want few.

Of the records with equal payloads of at least ``minimum`` bytes the one with the smallest
id is a response with the payload; the others are revisits that name its record and
address and carry the headers only. Smaller payloads are all responses.

Null payloads are empty, and so is a null address; a long payload is a record like any other.
An empty table gives no archives, and further columns are not read. Rows with a null id are written as responses of their own and stay apart from
the groups. Rows that repeat an id and a payload are one response and revisits of it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillsieve.llm.common import SharedFile, open_fs, slices
from quillsieve.session import stage, stage_path

DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
LEVEL = 3
# Fixed values of the formats: the skippable frame of a dictionary, the profile of revisits.
_SKIPPABLE = 0x184D2A5D
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "1970-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url}')}>"


def _line(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def _framed(fields: list[str], block: bytes) -> bytes:
    """A record of header fields and a block, with the block's digest and length."""
    fields = ["WARC/1.1", *fields, f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info_record(name: str) -> bytes:
    """The record that opens an archive."""
    return _framed([
        "WARC-Type: warcinfo", f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", f"WARC-Date: {_DATE}",
        f"WARC-Filename: {name}", "Content-Type: application/warc-fields"], b"format: WARC File Format 1.1\r\n")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, refers_uri: str | None = None) -> bytes:
    """The bytes of one record; the page's id and that of the response stand in fields of their own."""
    uri = _line(url or "")
    headers = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = headers if refers_to is not None else headers + payload
    fields = [
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, uri)}",
        f"WARC-Date: {_DATE}", f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if refers_to is not None:
        target = _line(refers_uri or "")
        fields += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, target)}", f"WARC-Refers-To-Target-URI: {target}",
                   f"WARC-Refers-To-Date: {_DATE}", f"X-Refers-To-Page-ID: {refers_to}"]
    return _framed([*fields, "Content-Type: application/http; msgtype=response"], block)


def parse(data: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """(WARC fields, HTTP headers, payload) of the bytes of one record; raises on a block that is cut."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if len(block) != int(fields["Content-Length"]) or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("a record's length does not fit its bytes")
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


class Writer:
    """One archive. Records wait until the dictionary is built."""

    def __init__(self, uri: str, dictionary_bytes: int = DICTIONARY_BYTES, sample_bytes: int = SAMPLE_BYTES, level: int = LEVEL):
        self._out, self._level = SharedFile(uri), level
        self._dictionary_bytes, self._sample_bytes = dictionary_bytes, sample_bytes
        self._waiting: list[tuple[object, bytes]] = []
        self._held = 0
        self._compressor: zstandard.ZstdCompressor | None = None

    def add(self, key, data: bytes) -> Iterator[tuple[object, int, int]]:
        """(key, offset, length) of the records that were written now."""
        self._waiting.append((key, data))
        self._held += len(data)
        if self._compressor or self._held >= self._sample_bytes:
            yield from self._flush()

    def _flush(self) -> Iterator[tuple[object, int, int]]:
        if self._compressor is None:
            dictionary = self._train([d for _, d in self._waiting])
            if dictionary is not None:
                raw = dictionary.as_bytes()
                self._out.write(struct.pack("<II", _SKIPPABLE, len(raw)) + raw)
            self._compressor = zstandard.ZstdCompressor(self._level, dict_data=dictionary, write_checksum=True)
        for key, data in self._waiting:
            framed, at = self._compressor.compress(data), self._out.size
            self._out.write(framed)
            yield key, at, len(framed)
        self._waiting, self._held = [], 0

    def _train(self, samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
        try:
            return zstandard.train_dictionary(self._dictionary_bytes, samples)
        except zstandard.ZstdError:  # too few or too small samples
            return None

    def close(self) -> Iterator[tuple[object, int, int]]:
        yield from self._flush()
        self._out.close()


def read_archive(uri: str) -> Iterator[bytes]:
    """The records of an archive in their order, one frame in memory at a time."""
    system, path = open_fs(uri)
    with system.open_input_stream(path, compression=None) as source:
        pending = source.read(8)
        dictionary = None
        if len(pending) == 8 and struct.unpack("<II", pending)[0] == _SKIPPABLE:
            dictionary = zstandard.ZstdCompressionDict(source.read(struct.unpack("<II", pending)[1]))
            pending = b""
        engine = zstandard.ZstdDecompressor(dict_data=dictionary)
        frame, parts = None, []
        while True:
            if not pending:
                pending = source.read(1 << 20)
                if not pending:
                    break
            frame = frame or engine.decompressobj()
            parts.append(frame.decompress(pending))
            pending = frame.unused_data if frame.eof else b""
            if frame.eof:
                yield b"".join(parts)
                frame, parts = None, []
        if frame is not None:
            raise ValueError(f"{uri} ends inside a record")


_INFO = object()  # key of the record that has no row in the index
_INDEX = "archive string, id bigint, offset bigint, length bigint"


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    name, writer = f"part-{TaskContext.get().partitionId():06d}.warc.zst", None

    def rows(found: list[tuple[object, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array([name] * len(found), pa.string()), *[pa.array(c, pa.int64()) for c in columns]], ["archive", "id", "offset", "length"])

    for whole in batches:
        for batch in slices(whole):
            found = []
            if writer is None:
                writer = Writer(f"{folder}/{name}")
                found += writer.add(_INFO, info_record(name))
            for page_id, payload, url, refers_to, refers_uri in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                found += writer.add(page_id, record(page_id, url, payload, refers_to, refers_uri))
            yield rows([r for r in found if r[0] is not _INFO])
    if writer:
        yield rows([r for r in writer.close() if r[0] is not _INFO])


def revisits(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", minimum: int = 0, url_col: str = "url") -> DataFrame:
    """(id, digest, refers_to, refers_uri): for each digest of several payloads the rows that
    repeat its smallest id's, with that row's id and address. Rows that repeat this id and payload are told apart by their number."""
    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    keyed = stage(pages.where(F.col(id_col).isNotNull()).where(F.octet_length(payload) >= minimum).select(
        F.col(id_col).cast("bigint").alias("id"), F.unhex(F.sha1(payload)).alias("digest"), F.col(url_col).alias("url")), "warc-digests")
    groups = stage(keyed.groupBy("digest").agg(F.min(F.struct("id", "url")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "digest", F.col("first.id").alias("refers_to"), F.col("first.url").alias("refers_uri")), "warc-groups")
    return keyed.join(groups, "digest").select("id", "digest", "refers_to", "refers_uri")


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", minimum: int = 0) -> DataFrame:
    """Write all rows to archives in ``folder`` and return the index."""
    again = stage(revisits(pages, id_col, payload_col, minimum, url_col), "warc-revisits")
    rows = pages.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(payload_col), F.lit("")).cast("binary").alias("payload"), F.col(url_col).alias("url"))
    # rows that repeat the first id of a group: one of them is the response
    repeated = again.where("id = refers_to").groupBy("id", "digest").count().where("count > 1")
    others = again.where("id <> refers_to").select("id", "digest", "refers_to", "refers_uri").distinct()
    if repeated.isEmpty() and others.groupBy("id").count().where("count > 1").isEmpty():
        planned = rows.join(others.select("id", "refers_to", "refers_uri"), "id", "left")
    else:  # ids are not unique: the digest tells the rows of an id apart, a number the equal ones
        named = rows.withColumn("digest", F.unhex(F.sha1("payload")))
        number = F.row_number().over(Window.partitionBy("id", "digest").orderBy("url"))
        first = again.select("id", "digest", "refers_to", "refers_uri").distinct()
        planned = named.withColumn("number", number).join(first, ["id", "digest"], "left").withColumn(
            "refers_to", F.when((F.col("id") != F.col("refers_to")) | (F.col("number") > 1), F.col("refers_to")))
    index = planned.select("id", "payload", "url", "refers_to", "refers_uri").mapInArrow(partial(_write, folder=folder), _INDEX)
    index.write.mode("overwrite").parquet(f"{folder}/index")
    return pages.sparkSession.read.schema(_INDEX).parquet(f"{folder}/index")


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to, payload) of all records of
    the archives of an index. The payload's length is that of the HTTP headers, also for
    revisits; a response's payload is checked against its digest and length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                out, size = [], 0
                for data in read_archive(f"{folder}/{name}"):
                    fields, http, payload = parse(data)
                    if fields["WARC-Type"] == "warcinfo":
                        continue
                    kind, told = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
                    length = int(http.rpartition(b"Content-Length: ")[2])
                    if kind == "response" and (digest(payload) != told or len(payload) != length):
                        raise ValueError("a payload does not fit its digest")
                    page, target = fields["X-Page-ID"], fields.get("X-Refers-To-Page-ID")
                    out.append((int(page) if page else None, length, told, kind, int(target) if target else None, payload if kind == "response" else None))
                    size += len(payload)
                    if size > 8 << 20 or len(out) >= 2000:
                        yield _batch(out)
                        out, size = [], 0
                yield _batch(out)

    archives = index.select("archive").distinct()
    # a task per archive
    return archives.repartition(max(1, archives.count())).mapInArrow(run, "id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [("id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
    columns = list(zip(*rows, strict=True)) or [[]] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds, strict=True)], schema=pa.schema(kinds))


def archive_table(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", minimum: int = 0) -> DataFrame:
    """Write the archives to the shared folder, read them back and return a row per record,
    without the payloads."""
    folder = stage_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder, id_col, payload_col, url_col, minimum), folder).drop("payload")
