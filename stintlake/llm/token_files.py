"""Token ids of documents as compressed, seekable files, in ascending doc_id order.

A file is Parquet with one row per segment of whole documents; Spark's writer and reader carry it
to any store and commit it as a whole. A segment's payload holds a directory of its documents
and the ids as range-coded blocks, each coded on its own and checked by a crc32. A range shuffle
on doc_id puts documents in order; nothing but one number per partition meets in one place.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stintlake.llm import range_coder
from stintlake.llm.common import lean
from stintlake.llm.token_ids import END_ID, OWNER
from stintlake.llm.token_ids import encode as encode_text
from stintlake.llm.token_ids import vocabulary_path, words_of

#: Ids after which a segment is closed; a longer document is one segment.
SEGMENT_IDS = 1 << 22
MAGIC = b"TIDF\x01\0\0\0"
_FILE = "part int, segment int, first_id long, docs long, tokens long, before long, payload binary"


def pack_segment(doc_ids: list[int | None], sizes: list[int], ids: np.ndarray) -> bytes:
    """A segment from its documents' ids, their numbers of tokens, and all tokens."""
    coded = range_coder.encode(ids)
    numbers = np.array([i or 0 for i in doc_ids], "<i8")
    missing = np.array([i is None for i in doc_ids], np.uint8)
    sections = [
        zlib.compress(np.diff(numbers, prepend=0).astype("<i8").tobytes()),
        zlib.compress(missing.tobytes()),
        zlib.compress(np.array(sizes, "<u4").tobytes()),
        zlib.compress(coded.lengths.astype("<u4").tobytes()),
        zlib.compress(coded.words.astype("<u4").tobytes()),
        zlib.compress(coded.alphabets.astype("<u4").tobytes()),
        coded.checksums.astype("<u4").tobytes(),
        coded.differences,
        coded.packed,
    ]
    head = MAGIC + struct.pack(f"<{len(sections)}Q", *map(len, sections))
    directory = b"".join(sections[:-1])
    check = struct.pack("<I", zlib.crc32(directory, zlib.crc32(head)))
    return head + check + directory + sections[-1]


def unpack_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, numbers of tokens and all tokens; raises if anything is damaged."""
    count, at = 9, len(MAGIC)
    if payload[:at] != MAGIC:
        raise ValueError("not a segment of token ids")
    lengths = struct.unpack_from(f"<{count}Q", payload, at)
    at += 8 * count
    (check,) = struct.unpack_from("<I", payload, at)
    directory = payload[at + 4:at + 4 + sum(lengths[:-1])]
    if zlib.crc32(directory, zlib.crc32(payload[:at])) != check:
        raise ValueError("the directory of a segment is damaged")
    at += 4
    parts = []
    for n in lengths:
        parts.append(payload[at:at + n])
        at += n
    number = lambda i: np.frombuffer(zlib.decompress(parts[i]), "<u4").astype(np.int64)
    doc_ids = np.cumsum(np.frombuffer(zlib.decompress(parts[0]), "<i8")).tolist()
    missing = zlib.decompress(parts[1])
    coded = range_coder.Coded(
        number(3), number(4), number(5), np.frombuffer(parts[6], "<u4"), parts[7], parts[8]
    )
    names = [None if m else i for i, m in zip(doc_ids, missing)]
    return names, number(2), range_coder.decode(coded)


def write_token_files(
    docs: DataFrame, path: str, *, vocabulary: str | None = None, segment_ids: int = SEGMENT_IDS
) -> None:
    """Encode the whole texts of ``docs(doc_id, text)`` to files below ``path``, which must be new.

    Each document ends with the id 2; NULL and empty texts are that id alone. Rows are ordered
    by doc_id, NULL first, then by a hash of the text; repeated rows are kept. An empty table
    gives files without segments. Other columns are ignored.
    """
    tokenizer = vocabulary or vocabulary_path()
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(tokenizer)
        part = TaskContext.get().partitionId()
        segment = before = 0
        names: list[int | None] = []
        parts: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts), "<u4")
            payload = pack_segment(names, [len(p) // 4 for p in parts], ids)
            row = [part, segment, names[0], len(names), len(ids), before, payload]
            kinds = (pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, kinds)],
                ["part", "segment", "first_id", "docs", "tokens", "before", "payload"],
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                names.append(doc_id.as_py())
                parts.append(encode_text(words, text.as_py()) + end)
                held += len(parts[-1]) // 4
                if held >= segment_ids:
                    yield out()
                    segment, before = segment + 1, before + held
                    names.clear()
                    parts.clear()
                    held = 0
        if names:
            yield out()

    key = F.xxhash64("text")
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id", key).sortWithinPartitions("doc_id", key)
    )
    ordered.mapInArrow(lean(run, OWNER), _FILE).write.option("compression", "none").parquet(path)


def read_token_files(spark: SparkSession, path: str, *, ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens and
    ids_crc32, and with ``ids`` its ids as little-endian unsigned 32-bit integers.

    Blocks whose checksum does not fit raise an error.
    """
    files = spark.read.schema(_FILE).parquet(path)
    totals = files.groupBy("part").agg(F.sum("tokens").alias("total"))  # one row per partition
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("part", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset"))
    located = files.join(F.broadcast(offsets), "part").select(
        (F.col("offset") + F.col("before")).alias("start"), "payload"
    )
    kinds = [pa.int64()] * 4 + [pa.binary()] * ids
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, payload in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids, sizes, found = unpack_segment(payload.as_py())
                raw = found.astype("<u4").tobytes()
                del found
                ends = np.cumsum(sizes)
                for at in range(0, len(sizes), 2000):
                    span = [(4 * int(e - n), 4 * int(e)) for e, n in zip(ends[at:at + 2000], sizes[at:at + 2000])]
                    texts = [raw[a:b] for a, b in span]
                    columns = [
                        doc_ids[at:at + 2000], [start + a // 4 for a, _ in span], sizes[at:at + 2000],
                        list(map(zlib.crc32, texts)), *[texts] * ids,
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)], names
                    )

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids
    return located.mapInArrow(lean(run, OWNER), schema)
