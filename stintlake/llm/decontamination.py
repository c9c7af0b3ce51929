"""Benchmark decontamination with a generalised suffix automaton of the test items.

The items' words go into one automaton per block of items; training words are streamed
through it while the length of the longest match is tracked. Wherever at least ``window`` words
match, or a shorter item matches whole, the words are hit. Spans of hit words are cut, and
texts that are hit beyond a share of their words are dropped. An automaton is broadcast; its
size is bounded by ``block_words``, and larger benchmarks take several blocks one after another.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stintlake.llm.common import ascii_lower, lean, stage, text_bytes

#: Consecutive words that make a hit.
WINDOW = 10
#: Words of items in one automaton.
BLOCK_WORDS = 200_000
#: Blocks chained in one stage before their result is written.
CHAIN = 4
#: Texts with a larger share of hit words are dropped whole.
MAX_COVERAGE = 0.8

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Lower-cases A-Z and turns every byte that is no part of a word into a blank.
_FOLD = bytes(c if _WORD.match(bytes([c])) else 32 for c in bytes(range(256)).lower())

_SPANS = "array<struct<first:int,last:int>>"
_SPAN_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class Automaton:
    """All factors of the items' word sequences; links lead to the longest other suffix."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = []
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            coded.append((name, ids))
            last = 0
            for c in ids:
                last = self._extend(last, c)
        self.owners: dict[int, set[str]] = {}  # state of a whole window -> items
        self.short: dict[int, list[tuple[int, str]]] = {}  # state of a short item -> (length, item)
        for name, ids in coded:
            state, matched = 0, 0
            for c in ids:
                state, matched = self.step(state, matched, c)
                if matched >= window:
                    self.owners.setdefault(self.top(state), set()).add(name)
            if 0 < len(ids) < window:
                self.short.setdefault(state, []).append((len(ids), name))
        self.least = min([window, *(n for v in self.short.values() for n, _ in v)])
        pairs = {(a, b) for _, ids in coded for a, b in zip(ids, ids[1:])}
        self.bits = max(16, 4 * len(pairs)).bit_length()
        self.pairs = np.zeros(1 << self.bits, bool)
        for a, b in pairs:
            self.pairs[(a * 0x9E3779B1 + b) & ((1 << self.bits) - 1)] = True

    def _extend(self, last: int, c: int) -> int:
        held = self.next[last].get(c)
        if held is not None:
            return held if self.length[held] == self.length[last] + 1 else self._clone(last, c, held)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = new
            last = self.link[last]
        if last >= 0:
            held = self.next[last][c]
            self.link[new] = (
                held if self.length[held] == self.length[last] + 1 else self._clone(last, c, held)
            )
        return new

    def _clone(self, last: int, c: int, held: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[held]))
        self.length.append(self.length[last] + 1)
        self.link.append(self.link[held])
        self.link[held] = copy
        while last >= 0 and self.next[last].get(c) == held:
            self.next[last][c] = copy
            last = self.link[last]
        return copy

    def step(self, state: int, matched: int, c: int) -> tuple[int, int]:
        """The state and length of the longest match after one more word."""
        while state and c not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        after = self.next[state].get(c)
        return (0, 0) if after is None else (after, matched + 1)

    def top(self, state: int) -> int:
        """The state of the last ``window`` words of a match that is at least as long."""
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def search(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word spans (first, last), and the items that were found."""
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(-1)), np.int64, len(words))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for lo, hi in self._runs(ids):
            state = matched = 0
            for i in range(lo, hi):
                state, matched = self.step(state, matched, int(ids[i]))
                if matched >= self.window:
                    found |= self.owners[self.top(state)]
                    spans.append((i - self.window + 1, i))
                if self.short:
                    self._short(state, matched, i, spans, found)
        return _merged(spans), found

    def _short(self, state: int, matched: int, i: int, spans: list, found: set) -> None:
        reach = matched
        while state > 0:
            for length, name in self.short.get(state, ()):
                if length <= reach:
                    found.add(name)
                    spans.append((i - length + 1, i))
            state = self.link[state]
            reach = self.length[state]

    def _runs(self, ids: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches in which every neighbouring pair may be one of the items' pairs.

        Nothing shorter than ``least`` can hold a match, so the rest is not walked.
        """
        known = ids >= 0
        if self.least > 1:
            slot = (ids[:-1] * 0x9E3779B1 + ids[1:]) & ((1 << self.bits) - 1)
            known = known[:-1] & known[1:] & self.pairs[slot]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], known.view(np.int8), [0]])))
        more = 1 if self.least > 1 else 0
        for lo, hi in zip(edges[::2], edges[1::2]):
            if hi - lo + more >= self.least:
                yield int(lo), int(hi) + more


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def item_blocks(
    benchmark: DataFrame, window: int, block_words: int
) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items in blocks of at most ``block_words`` words; longer items in overlapping parts."""
    block, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("string"), "text").filter("text IS NOT NULL")
    for name, text in rows.toLocalIterator():
        words = words_of(text.encode())
        for at in range(0, max(1, len(words) - window + 1), block_words - window + 1):
            part = words[at:at + block_words]
            if not part:
                continue
            if block and size + len(part) > block_words:
                yield block
                block, size = [], 0
            block.append((name or "", part))
            size += len(part)
    if block:
        yield block


_BUILT: dict[str, Automaton] = {}


def _automaton(key: str, items: list, window: int) -> Automaton:
    """Built once in each worker process."""
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Automaton(items, window)
    return _BUILT[key]


def find_matches(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """All rows and columns of ``docs`` with ``hit_words``, ``hit_spans`` and ``hit_items``.

    ``hit_words`` counts the words of the text, ``hit_spans`` holds the first and last position
    of each run of hit words, ``hit_items`` the ids of items with a window in the text.

    - NULL and empty texts have no words; items without words, and NULL items, never match.
    - An item with fewer than ``window`` words is one window. Repeated items each count by id.
    - Input columns named as the three are replaced; an empty table gives no rows.
    """
    if block_words < 2 * window:
        raise ValueError("a block must hold two windows at least")
    added = ("hit_words", "hit_spans", "hit_items")
    names = [c for c in docs.columns if c not in added]
    at = names.index("text")
    schema = T.StructType([*docs.select(*names).schema.fields])
    schema = schema.add("hit_words", T.IntegerType()).add("hit_spans", T.DataType.fromDDL(_SPANS))
    schema = schema.add("hit_items", T.ArrayType(T.StringType()))
    context = docs.sparkSession.sparkContext

    out = docs.select(
        *names, F.lit(0).alias("hit_words"),
        F.array().cast(_SPANS).alias("hit_spans"), F.array().cast("array<string>").alias("hit_items"),
    )
    blocks = item_blocks(benchmark, window, block_words)
    searched = False
    for number, block in enumerate(blocks):
        if number and number % CHAIN == 0:
            out = stage(out, "matched")
        out = out.mapInArrow(
            lean(_searcher(context.broadcast(block), window, at, len(names))), schema
        )
        searched = True
    if not searched:  # no item has a word
        return out.withColumn("hit_words", _count_words(F.col("text")))
    return out


def _count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(ascii_lower(text), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")), F.lit(0))


def _searcher(items, window: int, at: int, width: int):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, items.value, window)
        for batch in batches:
            old_spans, old_items = batch.column(width + 1), batch.column(width + 2)
            counts, spans, found = [], [], []
            for i, text in enumerate(text_bytes(batch.column(at))):
                words = words_of(text)
                more, names = automaton.search(words)
                old = [(s["first"], s["last"]) for s in old_spans[i].as_py() or ()] if more else []
                counts.append(len(words))
                spans.append(
                    [{"first": a, "last": b} for a, b in _merged(old + more)]
                    if more else old_spans[i].as_py()
                )
                found.append(sorted(names | set(old_items[i].as_py())) if names else old_items[i].as_py())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(counts, pa.int32()),
                 pa.array(spans, _SPAN_TYPE), pa.array(found, pa.list_(pa.string()))],
                batch.schema.names,
            )

    return run


def _cut(text: bytes, spans: list[dict]) -> bytes:
    """The text without the words of the spans and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text.translate(_LOWER))]
    out, at = [], 0
    for s in spans:
        out.append(text[at:places[s["first"]][0]])
        at = places[s["last"]][1]
    return b"".join([*out, text[at:]])


_LOWER = bytes(range(256)).lower()


def remove_matches(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW,
    max_coverage: float = MAX_COVERAGE, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` without the spans that match the benchmark, with the same columns.

    Rows with more than ``max_coverage`` of their words hit are dropped. Cutting repeats until
    a text is free of hits, since the ends of a cut may match again. A column n_chars follows the
    text where it is cut. Other rows are unchanged.
    """
    names = docs.columns
    clean, dirty = [], stage(
        find_matches(docs, benchmark, window=window, block_words=block_words), "hits"
    )
    while True:
        clean.append(dirty.filter("size(hit_spans) = 0").select(*names))
        hit = F.expr("aggregate(hit_spans, 0, (n, s) -> n + s.last - s.first + 1)")
        kept = dirty.filter("size(hit_spans) > 0").filter(hit <= max_coverage * F.col("hit_words"))
        if kept.isEmpty():
            break
        cut = _cut_texts(kept, names)
        dirty = stage(find_matches(cut, benchmark, window=window, block_words=block_words), "hits")
    out = clean[0]
    for part in clean[1:]:
        out = out.unionByName(part)
    return out


def _cut_texts(hits: DataFrame, names: list[str]) -> DataFrame:
    at = names.index("text")
    schema = hits.select(*names).schema
    numbers = (T.IntegerType, T.LongType)
    counted = "n_chars" in names and isinstance(schema["n_chars"].dataType, numbers)
    count = names.index("n_chars") if counted else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(names)).to_pylist()
            texts = [_cut(t, s) for t, s in zip(text_bytes(batch.column(at)), spans)]
            columns = batch.columns[:-1]
            columns[at] = pc.cast(pa.array(texts, pa.binary()), pa.string())
            if count is not None:
                columns[count] = pc.utf8_length(columns[at]).cast(columns[count].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    return hits.select(*names, "hit_spans").mapInArrow(lean(run), schema)
