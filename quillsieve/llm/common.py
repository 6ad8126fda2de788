"""What the corpus operators share: tables, shared files and Arrow columns."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; only Spark opens the path."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a location below the shared folder, for use in tasks."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri if "://" in uri else os.path.abspath(uri))


class SharedFile:
    """A file that appears under its name only when it is complete.

    It is written under a name of its own and moved on :meth:`close`, so two attempts
    of the same task never mix; both write the same bytes.
    """

    def __init__(self, uri: str):
        self._fs, self._path = open_fs(uri)
        self._temporary = f"{self._path}.{uuid.uuid4().hex}"
        self._fs.create_dir(os.path.dirname(self._path), recursive=True)
        self._out = self._fs.open_output_stream(self._temporary, compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self._out.write(data)
        self.size += len(data)

    def close(self) -> None:
        self._out.close()
        self._fs.move(self._temporary, self._path)


def slices(batch: pa.RecordBatch, limit: int = 2 << 20, column: int = 1) -> Iterator[pa.RecordBatch]:
    """A batch in parts with texts of about ``limit`` bytes, at least one row each."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, end - at)
        at = end


def binary_text(name: str = "text") -> F.Column:
    """A text column as bytes, null as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary").alias(name)


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's longs."""
    return values.astype(np.uint64, copy=False).view(np.int64)


def starts_of(sorted_keys: np.ndarray) -> np.ndarray:
    """Index at which each run of equal keys begins."""
    if not len(sorted_keys):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers ``starts[i] .. starts[i]+lengths[i]-1`` of all i, one after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
