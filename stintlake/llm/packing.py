"""Packing token sequences: bounded-space, online best fit with a fixed number of open windows.

Each partition keeps at most ``open_windows`` unfilled windows. A document's tokens beyond whole
windows go to the open window with the least room that still holds them. If none does and all
windows are open, the fullest one is topped up with the head of the piece and emitted, and the
tail is placed in the same way. At the end of a partition the windows left open are poured
together, which leaves one partial window; the partial windows of many partitions are merged
in groups of ``merge_group``. Documents never leave their partition and are not shuffled.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import lean, stage
from stintlake.llm.token_ids import END_ID, OWNER, encode, vocabulary_path, words_of

WINDOW = 4096
OPEN_WINDOWS = 64
MERGE_GROUP = 128

PIECES = """doc_id long, start long, length long, ids_crc32 long, doc_tokens long,
    sequence_id long, offset long, ids binary, open boolean"""
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()),
    ("offset", pa.int64()), ("ids", pa.binary()), ("open", pa.bool_()),
])
#: (doc_id, start, ids, doc_tokens)
Piece = tuple[int | None, int, bytes, int]


class Packer:
    """Open windows of one partition. ``emit`` gets the pieces of each finished window."""

    def __init__(self, window: int, slots: int, emit: Callable[[list[Piece]], None]):
        self.window, self.slots, self.emit = window, slots, emit
        self.open: list[tuple[int, list[Piece]]] = []  # (room, pieces), room rising

    def _put(self, at: int, piece: Piece) -> None:
        room, pieces = self.open.pop(at) if at < len(self.open) else (self.window, [])
        pieces.append(piece)
        room -= len(piece[2]) // 4
        if room == 0:
            self.emit(pieces)
            return
        at = next((i for i, w in enumerate(self.open) if w[0] >= room), len(self.open))
        self.open.insert(at, (room, pieces))

    def add(self, doc_id: int | None, start: int, ids: bytes, doc_tokens: int) -> None:
        size = 4 * self.window
        while len(ids) >= size:
            self.emit([(doc_id, start, ids[:size], doc_tokens)])
            start, ids = start + self.window, ids[size:]
        while ids:
            need = len(ids) // 4
            at = next((i for i, w in enumerate(self.open) if w[0] >= need), len(self.open))
            if at < len(self.open) or len(self.open) < self.slots:
                self._put(at, (doc_id, start, ids, doc_tokens))
                return
            head = self.open[0][0]  # the fullest takes the head and is done
            self._put(0, (doc_id, start, ids[:4 * head], doc_tokens))
            start, ids = start + head, ids[4 * head:]

    def pour(self) -> list[Piece]:
        """Merge what is open: whole windows are emitted, the rest (under one) is returned."""
        left = [p for _, pieces in self.open for p in pieces]
        self.open, self.slots = [], 1
        for piece in left:
            self.add(*piece)
        rest = [p for _, pieces in self.open for p in pieces]
        self.open = []
        return rest


class _Rows:
    """Collects pieces as Arrow batches; sequences are numbered from ``first``."""

    def __init__(self, first: int, keep_ids: bool):
        self.sequence, self.keep_ids, self.rows = first, keep_ids, []

    def window(self, pieces: list[Piece], still_open: bool = False) -> None:
        offset = 0
        for doc_id, start, ids, doc_tokens in pieces:
            kept = ids if self.keep_ids or still_open else None
            self.rows.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), doc_tokens,
                              self.sequence, offset, kept, still_open))
            offset += len(ids) // 4
        self.sequence += 1

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _ARROW)], schema=_ARROW
        )


def pack_documents(
    docs: DataFrame,
    *,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    merge_group: int = MERGE_GROUP,
    vocabulary: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """Pack the texts of ``docs(doc_id, text)`` into sequences of at most ``window`` tokens.

    One row per piece: the document, the piece's place in it (``start``, ``length``), the
    sequence and the place there (``sequence_id``, ``offset``), ``doc_tokens``, the crc32 of
    its ids and, with ``keep_ids``, the ids as little-endian unsigned 32-bit integers.

    - A NULL or empty text is one token, the end id; an empty table gives no rows.
    - NULL, tied or repeated doc_ids are packed row by row, each row on its own.
    - A text longer than a window is cut; other columns of ``docs`` are ignored.
    """
    path = vocabulary or vocabulary_path()
    end = END_ID.to_bytes(4, "little")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        rows = _Rows(TaskContext.get().partitionId() << 32, keep_ids)
        packer = Packer(window, open_windows, rows.window)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids = encode(words, text.as_py()) + end
                packer.add(doc_id.as_py(), 0, ids, len(ids) // 4)
                if len(rows.rows) >= 5000:
                    yield rows.take()
        rest = packer.pour()
        if rest:
            rows.window(rest, still_open=True)
        yield rows.take()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = _Rows((TaskContext.get().partitionId() | 1 << 30) << 32, keep_ids)
        packer = Packer(window, 1, rows.window)
        for batch in batches:
            for r in batch.to_pylist():
                packer.add(r["doc_id"], r["start"], r["ids"], r["doc_tokens"])
        rest = packer.pour()
        if rest:
            rows.window(rest)
        yield rows.take()

    packed = stage(docs.select("doc_id", "text").mapInArrow(lean(pack, OWNER), PIECES), "packed")
    left = packed.filter("open")
    groups = max(1, -(-left.select("sequence_id").distinct().count() // merge_group))
    merged = (
        left.repartitionByRange(groups, "sequence_id")
        .sortWithinPartitions("sequence_id", "offset")
        .mapInArrow(lean(merge, OWNER), PIECES)
    )
    out = packed.filter("not open").unionByName(merged).drop("open")
    return out if keep_ids else out.drop("ids")


def report(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Sequences, tokens and padding; a length that is a power of two needs no padding."""
    lengths = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    power = F.col("tokens").bitwiseAND(F.col("tokens") - 1) == 0
    return lengths.agg(
        F.count("*").alias("sequences"),
        F.sum("tokens").alias("tokens"),
        F.sum(F.when(power, 0).otherwise(window - F.col("tokens"))).alias("padding"),
    )
