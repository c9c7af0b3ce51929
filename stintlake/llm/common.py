"""Text, hashing and staging helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import shutil
import string
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.session import stage

#: Byte table that lower-cases A-Z and leaves every other byte alone.
LOWER = bytes(range(256)).lower()

__all__ = [
    "LOWER", "ascii_lower", "crc_remainder", "documents", "drop_extra", "lean", "mix64", "on_release",
    "ship", "stage", "string_array", "table", "text_bytes", "word_hash",
]


_SHIPPED: set[str] = set()
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Give this package to the executors, once per application, wherever it is run from.

    Texts are long, so where the session leaves the rows of an Arrow batch at their default,
    batches of 2,000 rows bound the memory of Python workers.
    """
    if spark.conf.get(_BATCH_ROWS) == "10000":
        spark.conf.set(_BATCH_ROWS, "2000")
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    folder = os.path.join(os.path.dirname(SparkFiles.getRootDirectory()), "py-files")
    os.makedirs(folder, exist_ok=True)
    name = os.path.join(folder, package.name)
    context.addPyFile(shutil.make_archive(name, "zip", package.parent, package.name))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ascii_lower(column: Column) -> Column:
    """A-Z in lower case; other letters stay as they are."""
    return F.translate(column, string.ascii_uppercase, string.ascii_lowercase)


def crc_remainder(column: Column, modulus: int) -> Column:
    """crc32 of the column as text, modulo ``modulus``; NULL counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def drop_extra(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that other columns of any name cannot clash."""
    return df.select(*names)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, without decoding them; NULL as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    for value in column.cast(kind):
        yield value.as_py() or b""


def string_array(values: Iterable[str | None]) -> pa.Array:
    return pa.array(values, pa.string())


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over 64 bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_hash(word: bytes) -> int:
    """A 64-bit hash of a word, the same in every process."""
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def crc32(data: bytes) -> int:
    return zlib.crc32(data)


# Memory of Python workers, which Spark uses again for later stages

_RELEASE: dict[str, Callable[[], None]] = {}


def on_release(owner: str, empty: Callable[[], None]) -> None:
    """Say how to empty the memo of an owner, for when a worker turns to something else."""
    _RELEASE[owner] = empty


@cache
def _libc():
    import ctypes

    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def _give_back() -> None:
    """Return freed memory to the system, which keeps idle workers small."""
    pa.default_memory_pool().release_unused()
    libc = _libc()
    if libc is not None and hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)


def lean(run: Callable, owner: str = "") -> Callable:
    """``run``, a function of Arrow batches, without what other owners left in the worker before."""

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, empty in _RELEASE.items():
            if name != owner:
                empty()
        _give_back()
        try:
            yield from run(batches)
        finally:
            _give_back()

    return tidy
