"""Scoring texts with a word n-gram model in shards of an Elias-Fano trie.

Counts come from all training texts. Every word is kept, and every two- and three-word sequence
that occurs at least ``min_count`` times, whatever the size of the input. A sequence belongs to the
shard that its last two words hash to. A shard is a small trie: words, under each the words that
follow it, under each such pair the words before it; the ranges are monotone pointers in
Elias-Fano code, and probabilities and back-off weights are quantised to a byte.

Probabilities are interpolated by absolute discounting. A context gives what its kept sequences
do not take to the next shorter one; the last step is the smoothed relative frequency of the
word. In logarithms the score is a sum of one value for each word, kept pair and kept triple of a
text, so shards add up their parts and no shard needs another. Shards are rows of a staged table.
To score, a task gets a range of shards, lays them out as files beside its executor and maps them;
sequences travel there as dictionary-coded columns, text after text, and a text's parts are added up
over the whole range before they are put out. Nothing passes through the driver.
"""

from __future__ import annotations

import itertools
import math
import os
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlake.llm import succinct
from stintlake.llm.common import lean, mix64, stage
from stintlake.session import drop_stages, fresh_path, shuffles_removed, staged, staging

DISCOUNT = 0.75
MIN_COUNT = 2
#: Added to each count, and the number of word kinds is raised by one for words never seen.
SMOOTHING = 0.1
#: Training tokens for each shard, which bound its sequences. The number of shards follows the input.
MAX_ENTRIES = 1_000_000
#: Words of the vocabulary for each shard.
BLOCK_WORDS = 1_000_000
#: Shards at least, so that small inputs spread too.
LEAST_SHARDS = 24
#: Shards that one task looks up at most, beyond LEAST_SHARDS ranges of them. They are mapped, not held.
RANGE_SHARDS = 64
#: Texts are gathered to about so many words before they are dealt to shards.
CHUNK_WORDS = 400_000
#: Words of the texts that are counted at once.
COUNT_WORDS = 2 * CHUNK_WORDS
#: Bytes of dealt parts that a task gathers before it looks them up, shard by shard.
HELD_BYTES = 3 << 20
#: A level is decoded as a whole where there are so many entries a sequence, or fewer, to look up.
DECODED = 16
#: Bits of the filters of words and pairs that may be in the model.
FILTER_BITS = 27
#: Frequent words that are sent as places in a table.
COMMON = 65_536

_END = b"\n"  # no word holds white space
#: In place of the hash of a word: none, and the start of a text.
NONE, START = 0, 1


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh3_64_intdigest(word)


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct tokens, rising, and of all texts the places of their tokens there, each
    text with its end, and the numbers of their tokens."""
    import xxhash

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    coded = lists.flatten().dictionary_encode()
    word, kinds = coded.indices.to_numpy(), coded.dictionary
    text = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(lists).to_numpy())
    none = pc.index(kinds, pa.scalar("", kinds.type)).as_py()  # beside white space at the ends of a text
    if none >= 0:
        word, text = word[word != none], text[word != none]
    binary = pa.large_binary() if pa.types.is_large_string(kinds.type) else pa.binary()
    kinds = kinds.cast(binary).to_numpy(zero_copy_only=False)
    hashes = np.append(np.fromiter(map(xxhash.xxh3_64_intdigest, kinds), np.uint64, len(kinds)), np.uint64(_hash(_END)))
    order = np.argsort(hashes)
    rank = np.empty(len(hashes), np.int64)
    rank[order] = np.arange(len(hashes))
    out = np.full(len(word) + len(texts), rank[-1])
    out[np.arange(len(word)) + text] = rank[word]
    return hashes[order], out, np.bincount(text, minlength=len(texts)) + 1


def _chunks(
    batches: Iterator[pa.RecordBatch], at: int, words: int = CHUNK_WORDS
) -> Iterator[tuple[pa.Table, pa.Array]]:
    """Rows with about so many words, without the texts, and their texts."""
    parts: list[pa.RecordBatch] = []
    texts: list[pa.Array] = []
    size = 0
    for batch in batches:
        rows, column, start = batch.drop_columns([batch.schema.names[at]]), batch.column(at), 0
        for i, n in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
            size += n
            if size > 6 * words:
                parts.append(rows.slice(start, i + 1 - start))
                texts.append(column.slice(start, i + 1 - start))
                yield pa.Table.from_batches(parts), pa.concat_arrays(texts)
                parts, texts, size, start = [], [], 0, i + 1
        if start < len(column):
            parts.append(rows.slice(start))
            texts.append(column.slice(start))
    if texts:
        yield pa.Table.from_batches(parts), pa.concat_arrays(texts)


def _find(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Places of the keys in a sorted table, -1 where missing."""
    if not len(table):
        return np.full(len(keys), -1, np.int64)
    at = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[at] == keys, at, -1)


# Counting


def count_words(docs: DataFrame) -> DataFrame:
    """hash and n of every token of ``docs(text)``, the end of each text included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches, 0, COUNT_WORDS):
            hashes, word, _ = _words(texts)
            n = np.bincount(word, minlength=len(hashes))
            yield pa.RecordBatch.from_arrays([_signed(hashes[n > 0]), pa.array(n[n > 0])], ["hash", "n"])

    return (
        docs.select("text").mapInArrow(lean(run), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    )


# Sequences on their way to shards


def _shifted(values: np.ndarray, starts: np.ndarray, first: int) -> np.ndarray:
    """The value before each token, ``first`` at the start of a text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[starts] = first
    return out


@dataclass
class Tokens:
    """Tokens of several texts as places in ``names``, the rising hashes of words; two before each."""

    names: np.ndarray
    u: np.ndarray
    v: np.ndarray
    w: np.ndarray
    #: the text of each token
    text: np.ndarray

    @staticmethod
    def of(texts: pa.Array) -> Tokens:
        hashes, numbers, sizes = _words(texts)
        names = np.concatenate([np.array([NONE, START], np.uint64), hashes])
        w, starts = numbers + 2, np.cumsum(sizes) - sizes
        v = _shifted(w, starts, START)
        return Tokens(names, _shifted(v, starts, NONE), v, w, np.repeat(np.arange(len(texts)), sizes))

    def pair_hashes(self) -> np.ndarray:
        return _pair_hashes(self.names[self.v], self.names[self.w])

    def only(self, keep: np.ndarray, keep_u: np.ndarray) -> Tokens:
        """Some of the tokens, and the first word of their triples only where it matters."""
        return Tokens(
            self.names, np.where(keep_u, self.u, 0)[keep], self.v[keep], self.w[keep], self.text[keep]
        )


def _pair_hashes(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return (mix64(v * np.uint64(0x9E3779B97F4A7C15) + w) >> np.uint64(1)).view(np.int64)


def _bits_of(places: DataFrame) -> np.ndarray:
    """A bitmap of fixed size of ``places(place)``, modulo its size.

    It only spares work: what passes by chance is counted or looked up as without it.
    """
    rows = places.select(F.expr(f"place & {(1 << FILTER_BITS) - 1}").alias("place")).groupBy(
        F.shiftright("place", 6).alias("word")
    ).agg(F.bit_or(F.expr("shiftleft(1L, cast(place & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bits[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return bits


def _passes(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    at = places & ((1 << FILTER_BITS) - 1)
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def _word_shard(hashes: np.ndarray, shards: int) -> np.ndarray:
    """As pmod(hash, shards) on Spark."""
    return hashes.view(np.int64) % shards


def _code(v: np.ndarray, w: np.ndarray, u: np.ndarray, kinds: int) -> np.ndarray:
    """One number for each three, in their order."""
    both = v * kinds + w
    if kinds >= 1 << 21:
        both = np.unique(both, return_inverse=True)[1]
    return both * kinds + u


def _dealt(shard: np.ndarray) -> dict[int, np.ndarray]:
    """The places of each shard, rising."""
    order = np.argsort(_narrow(shard), kind="stable")  # small types are sorted by their digits
    edges = np.flatnonzero(np.diff(shard[order])) + 1
    return {int(shard[part[0]]): part for part in np.split(order, edges)} if len(order) else {}


def _narrow(n: np.ndarray) -> np.ndarray:
    """Counts in the smallest type that holds them all."""
    most = int(n.max()) if len(n) else 0
    return n.astype("<u1" if most < 1 << 8 else "<u2" if most < 1 << 16 else "<u4" if most < 1 << 32 else "<u8")


def _common_words(words: DataFrame) -> np.ndarray:
    """Sorted hashes of at most COMMON of the most frequent words. They only shorten what is sent."""
    band = F.floor(F.log2("n") * 4)
    sizes = {r[0]: r[1] for r in words.groupBy(band).count().collect()}  # a few hundred at most
    least, held = None, 0
    for b in sorted(sizes, reverse=True):
        held += sizes[b]
        if held > COMMON:
            break
        least = b
    if least is None:
        return np.zeros(0, np.uint64)
    return np.sort(words.filter(band >= least).select("hash").toArrow().column(0).to_numpy().view(np.uint64))


def _columns(names: np.ndarray, place: np.ndarray, **columns: np.ndarray) -> dict[str, np.ndarray]:
    """Places in ``names``, rising hashes, as places among the names that occur, which come with them:
    first those that have a ``place`` among the common, as that place, then the hashes of the others,
    both as steps."""
    there = np.zeros(len(names), bool)
    for column in columns.values():
        there[column] = True
    common, rare = np.flatnonzero(there & (place >= 0)), np.flatnonzero(there & (place < 0))
    moved = np.empty(len(names), np.int64)
    moved[common], moved[rare] = np.arange(len(common)), np.arange(len(common), len(common) + len(rare))
    steps = np.diff(names[rare], prepend=np.uint64(0))  # of rising hashes: the first bytes are small
    return {
        "common": _narrow(np.diff(place[common], prepend=0)),
        "names": steps.view(np.uint8).reshape(-1, 8).T.ravel(),  # first bytes lie together
        **{k: _narrow(moved[c]) for k, c in columns.items()},
    }


def _pack(arrays: dict[str, np.ndarray]) -> bytes:
    data = succinct.dump(arrays, {})
    return len(data).to_bytes(8, "little") + pa.compress(data, "zstd", asbytes=True)


def _unpack(data: pa.Buffer, common: np.ndarray) -> dict[str, np.ndarray]:
    size = int.from_bytes(data.slice(0, 8).to_pybytes(), "little")
    arrays = succinct.parse(pa.decompress(data.slice(8), size, "zstd"))[0]
    rare = np.ascontiguousarray(arrays["names"].reshape(8, -1).T).view(np.uint64).ravel()
    kept = common[np.cumsum(arrays["common"], dtype=np.int64)]
    return {**arrays, "names": np.concatenate([kept, np.cumsum(rare, dtype=np.uint64)])}


def _shard_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[pa.RecordBatch]]]:
    """The batches of each shard, from rows in order of the first column."""
    def cut() -> Iterator[tuple[int, pa.RecordBatch]]:
        for batch in batches:
            shard = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(shard)) + 1), len(shard)]
            for a, b in itertools.pairwise(edges):
                if a < b:
                    yield int(shard[a]), batch.slice(a, b - a)

    for shard, group in itertools.groupby(cut(), key=lambda x: x[0]):
        yield shard, (part for _, part in group)


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(hashes, np.uint64).view(np.int64))


# Counting sequences


def _kept(docs: DataFrame, frequent: Broadcast, common: Broadcast, shards: int, least: int) -> DataFrame:
    """shard, u, v, w, n, place of every sequence with at least ``least`` occurrences; u is NULL in
    pairs, and place, the hash that the filter of pairs takes, is NULL in triples.

    Only words that pass the filter ``frequent`` can be in one.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _chunks(batches, 0):
            t = Tokens.of(texts)
            often = _passes(frequent.value, t.names.view(np.int64)) | (t.names == START)
            t = t.only(often[t.v] & often[t.w], often[t.u])
            _, first, n = np.unique(
                _code(t.v, t.w, t.u, len(t.names)), return_index=True, return_counts=True
            )
            t = Tokens(t.names, t.u[first], t.v[first], t.w[first], first)
            place = _find(common.value, t.names)
            for shard, at in _dealt(t.pair_hashes() % shards).items():
                columns = _columns(t.names, place, u=t.u[at], v=t.v[at], w=t.w[at])
                data = _pack({**columns, "n": _narrow(n[at])})
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([data])], ["shard", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, group in _shard_groups(batches):
            # parts sent by chunks; the number of shards bounds what one of them holds
            parts = [_unpack(data.as_buffer(), common.value) for part in group for data in part.column(1)]
            names, at = np.unique(np.concatenate([p["names"] for p in parts]), return_inverse=True)
            at = np.split(at, np.cumsum([len(p["names"]) for p in parts])[:-1])
            u, v, w = (np.concatenate([a[p[c]] for a, p in zip(at, parts)]) for c in "uvw")
            n = np.concatenate([p["n"].astype(np.int64) for p in parts])
            code = _code(v, w, u, len(names))
            order = np.argsort(code)
            u, v, w, n = u[order], v[order], w[order], n[order]
            new_pair = np.concatenate([[True], (np.diff(v) != 0) | (np.diff(w) != 0)])
            three = np.flatnonzero(new_pair | np.concatenate([[True], np.diff(u) != 0]))
            two = np.flatnonzero(new_pair)
            for at_, is_pair in ((two, True), (three, False)):
                sums = np.add.reduceat(n, at_)
                keep = sums >= least
                if not is_pair:
                    keep &= names[u[at_]] != NONE
                at_, sums = at_[keep], sums[keep]
                none = pa.nulls(len(at_), pa.int64())
                before = none if is_pair else _signed(names[u[at_]])
                place = pa.array(_pair_hashes(names[v[at_]], names[w[at_]])) if is_pair else none
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at_), shard, np.int32)), before, _signed(names[v[at_]]),
                     _signed(names[w[at_]]), pa.array(sums), place],
                    ["shard", "u", "v", "w", "n", "place"],
                )

    dealt = docs.select("text").mapInArrow(lean(deal), "shard int, data binary")
    return dealt.repartition("shard").sortWithinPartitions("shard").mapInArrow(
        lean(add), "shard int, u long, v long, w long, n long, place long"
    )


# The trie


def _book(values: np.ndarray) -> np.ndarray:
    """Levels of a byte: half at equal shares, half at equal steps, so that no value is far off."""
    if not len(values):
        return np.zeros(256)
    shares = np.quantile(values, (np.arange(128) + 0.5) / 128)
    return np.sort(np.concatenate([shares, np.linspace(values.min(), values.max(), 128)]))


@dataclass
class Level:
    """Sequences of one length: pointers of what they extend, the words added, quantised values."""

    pointers: succinct.EliasFano
    children: np.ndarray
    width: int
    log_p: np.ndarray
    p_book: np.ndarray

    @staticmethod
    def build(
        context: np.ndarray, child: np.ndarray, contexts: int, width: int, log_p: np.ndarray
    ) -> Level:
        """From entries sorted by context and child."""
        ends = np.cumsum(np.bincount(context, minlength=contexts))
        pointers = succinct.EliasFano.build(np.concatenate([[0], ends]).astype(np.int64))
        book = _book(log_p)
        return Level(
            pointers, succinct.pack_bits(child, width), width, succinct.encode_levels(log_p, book), book
        )

    def range_of(self, context: np.ndarray) -> np.ndarray:
        """First and last-but-one place of what is below each context, as two columns."""
        both = self.pointers.get(np.concatenate([context, context + 1]))
        return both.reshape(2, -1).T

    def find(self, ranges: np.ndarray, child: np.ndarray) -> np.ndarray:
        """The entry of each child in its context's range, -1 where there is none."""
        lo, hi = ranges[:, 0].copy(), ranges[:, 1].copy()
        open_ = np.flatnonzero(lo < hi)
        while len(open_):  # the first child that is not smaller
            middle = (lo[open_] + hi[open_]) >> 1
            smaller = succinct.read_bits(self.children, middle, self.width) < child[open_]
            lo[open_[smaller]] = middle[smaller] + 1
            hi[open_[~smaller]] = middle[~smaller]
            open_ = open_[lo[open_] < hi[open_]]
        out = np.full(len(child), -1, np.int64)
        at = np.flatnonzero(lo < ranges[:, 1])
        same = succinct.read_bits(self.children, lo[at], self.width) == child[at]
        out[at[same]] = lo[at[same]]
        return out

    def entries(self, context: np.ndarray, child: np.ndarray) -> np.ndarray:
        """The entry of each child below its context, -1 where there is none."""
        if DECODED * len(child) < len(self.log_p):
            return self.find(self.range_of(context), child)
        sizes = np.diff(self.pointers.all())
        keys = np.repeat(np.arange(len(sizes)) << self.width, sizes)
        keys |= succinct.read_bits(self.children, np.arange(len(keys)), self.width)
        return _find(keys, context << self.width | child)

    def put(self, name: str) -> tuple[dict[str, np.ndarray], dict[str, int]]:
        """Arrays and numbers under a name, for a file that holds several levels."""
        arrays, numbers = succinct.flat([(f"{name}.pointers", self.pointers)])
        for part in ("children", "log_p", "p_book"):
            arrays[f"{name}.{part}"] = getattr(self, part)
        return arrays, {**numbers, f"{name}.width": self.width}

    @staticmethod
    def taken(arrays: dict[str, np.ndarray], numbers: dict[str, int], name: str) -> Level:
        return Level(
            succinct.sequence(arrays, numbers, f"{name}.pointers"), arrays[f"{name}.children"],
            numbers[f"{name}.width"], arrays[f"{name}.log_p"], arrays[f"{name}.p_book"],
        )


def _log_base(count: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """log10 of the smoothed relative frequency of words with these counts."""
    return np.log10((count + SMOOTHING) / (total + SMOOTHING * (kinds + 1)))


def _shard_file(rows: dict[str, np.ndarray]) -> bytes:
    """The trie of one shard. Rows are words (kind 0: w, n and weight x), pairs (kind 1: v, w,
    probability x and value y) and triples (kind 2: u, v, w, the share x that their context
    leaves them, and its weight y)."""
    one, two, three = ({c: a[rows["kind"] == k] for c, a in rows.items()} for k in range(3))
    order = np.argsort(one["w"])
    log_back = np.log10(one["x"][order])
    book = _book(log_back)
    arrays = {
        "hashes": one["w"][order], "n": _narrow(one["n"][order]), "book": book,
        "back": succinct.encode_levels(log_back, book),
    }

    names = np.unique(np.concatenate([two["v"], two["w"], three["u"]]))
    width = max(1, len(names).bit_length())
    v, w = _find(names, two["v"]), _find(names, two["w"])
    order = np.lexsort((w, v))
    v, w, two = v[order], w[order], {c: a[order] for c, a in two.items()}
    pairs = Level.build(v, w, len(names), width, two["y"].astype(float))

    place = np.searchsorted(
        v * len(names) + w, _find(names, three["v"]) * len(names) + _find(names, three["w"])
    )
    u = _find(names, three["u"])
    order = np.lexsort((u, place))
    place, u, three = place[order], u[order], {c: a[order] for c, a in three.items()}
    shorter, back = two["x"][place], three["y"].astype(float)
    value = np.log10(three["x"] + back * shorter) - np.log10(back) - np.log10(shorter)
    triples = Level.build(place, u, len(v), width, value)
    numbers = {}
    for name, level in (("pairs", pairs), ("triples", triples)):
        more, also = level.put(name)
        arrays, numbers = {**arrays, **more}, {**numbers, **also}
    return succinct.dump({**arrays, "names": names}, numbers)


@dataclass
class Model:
    """The staged shards and the totals of the training texts."""

    #: shard and data
    files: DataFrame
    shards: int
    total: int
    kinds: int
    #: log10 of the weight of a text's start
    start: float
    #: filter of the hashes of kept pairs
    pairs: Broadcast
    #: hashes of frequent words
    common: Broadcast


class MappedShards:
    """Shards of a task as files in the executor's own folder, mapped into memory."""

    def __enter__(self) -> MappedShards:
        self.folder = tempfile.TemporaryDirectory(dir=SparkFiles.getRootDirectory())
        self.shards: dict[int, Shard] = {}
        return self

    def __exit__(self, *_) -> None:
        self.shards.clear()
        self.folder.cleanup()

    def add(self, number: int, data: pa.Buffer) -> None:
        path = os.path.join(self.folder.name, str(number))
        with open(path, "wb") as file:
            file.write(data)
        self.shards[number] = Shard(np.memmap(path, np.uint8, "r"))


class Shard:
    """One shard as it is looked up."""

    def __init__(self, data: pa.Buffer | np.memmap):
        self.arrays, numbers = succinct.parse(data)
        self.pairs = Level.taken(self.arrays, numbers, "pairs")
        self.triples = Level.taken(self.arrays, numbers, "triples")

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts and log10 weights, 0 of unknown words."""
        at = _find(self.arrays["hashes"], hashes)
        n, log_back = np.zeros(len(hashes), np.int64), np.zeros(len(hashes))
        hit = np.flatnonzero(at >= 0)
        n[hit] = self.arrays["n"][at[hit]]
        log_back[hit] = self.arrays["book"][self.arrays["back"][at[hit]]]
        return n, log_back

    def sequences(self, names: np.ndarray, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        """What the pair and the triple that end at each token add to its log10 probability."""
        out = np.zeros(len(w))
        if not len(self.arrays["names"]):
            return out
        used = _places(len(names), u, v, w)
        known = np.full(len(names), -1, np.int64)
        known[used] = _find(self.arrays["names"], names[used])
        u, v, w = known[u], known[v], known[w]
        at = np.flatnonzero((v >= 0) & (w >= 0))
        entry = self.pairs.entries(v[at], w[at])
        at, entry = at[entry >= 0], entry[entry >= 0]
        out[at] = self.pairs.p_book[self.pairs.log_p[entry]]
        some = u[at] >= 0
        at, entry = at[some], entry[some]
        entry = self.triples.entries(entry, u[at])
        hit = entry >= 0
        out[at[hit]] += self.triples.p_book[self.triples.log_p[entry[hit]]]
        return out


def _places(size: int, *columns: np.ndarray) -> np.ndarray:
    """The places below ``size`` that occur in the columns."""
    there = np.zeros(size, bool)
    for column in columns:
        there[column] = True
    return np.flatnonzero(there)


def train(
    docs: DataFrame, *, min_count: int = MIN_COUNT, max_entries: int = MAX_ENTRIES,
    block_words: int = BLOCK_WORDS,
) -> Model:
    """Learn from every row of ``docs(text)``; NULL counts as an empty text, which is one end.

    Sequences seen fewer than ``min_count`` times are left to shorter contexts. There is a shard
    for every ``max_entries`` tokens and ``block_words`` words, which changes no result beyond
    the rounding to bytes. An empty table learns a model in which every word has the same small
    probability.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "shards")
    with staging(spark):
        shards, total, kinds, back, pairs, common = _write_shards(docs, path, min_count, max_entries, block_words)
    files = spark.read.schema("shard int, data binary").parquet(path)
    return Model(files, shards, total, kinds, math.log10(back), pairs, common)


def _write_shards(docs: DataFrame, path: str, min_count: int, max_entries: int, block_words: int) -> tuple:
    """Number of shards, tokens, words, the weight of a text's start, the filter of pairs, frequent words."""
    spark = docs.sparkSession
    context = spark.sparkContext
    first = staged(spark)
    words = stage(count_words(docs), "word-counts")
    total, kinds = words.agg(F.sum("n"), F.count("*")).first()
    total, kinds = total or 0, kinds or 0
    shards = max(LEAST_SHARDS, -(-total // max_entries), -(-kinds // block_words))
    frequent = context.broadcast(_bits_of(words.filter(F.col("n") >= min_count).select(F.col("hash").alias("place"))))
    common = context.broadcast(_common_words(words))
    kept = stage(_kept(docs, frequent, common, shards, min_count), "kept")
    counted = staged(spark)
    pairs = kept.filter("u IS NULL").drop("u", "place")
    triples = kept.filter("u IS NOT NULL").drop("place")
    filter_ = context.broadcast(_bits_of(kept.filter("u IS NULL").select("place")))

    def weight(taken: str, n: str) -> Column:
        return F.greatest(F.lit(1) - F.coalesce(F.col(taken), F.lit(0.0)) / F.greatest(F.col(n), F.lit(1)), F.lit(1e-9))

    mass = F.sum("n") - F.lit(DISCOUNT) * F.count("*")
    # The start of a text is a context of its own; it is followed as often as there are texts.
    texts = docs.count()
    start = spark.range(1).select(F.lit(START).cast("long").alias("v"), F.lit(texts).alias("m"))
    follows = stage(
        words.select(F.col("hash").alias("v"), F.col("n").alias("m")).unionByName(start)
        .join(pairs.groupBy("v").agg(mass.alias("taken")), "v", "left")
        .select("v", "m", weight("taken", "m").alias("back")), "word-weights",
    )
    extended = triples.groupBy(F.col("u").alias("v"), F.col("v").alias("w")).agg(mass.alias("taken"))
    one = (F.col("k") + SMOOTHING) / F.lit(total + SMOOTHING * (kinds + 1))
    p = (F.col("n") - DISCOUNT) / F.col("m") + F.col("back") * one
    two = stage(
        pairs.join(follows, "v").join(words.select(F.col("hash").alias("w"), F.col("n").alias("k")), "w")
        .join(extended, ["v", "w"], "left")
        .withColumns({"p": p, "back2": weight("taken", "n")}).select(
            "shard", "v", "w", "n", "back2", F.col("p").alias("x"),
            (F.log10(F.col("p") / F.col("back") / one) + F.log10("back2")).cast("float").alias("y"),
        ), "pairs",
    )
    contexts = two.select(
        F.col("v").alias("u"), F.col("w").alias("v"), F.col("n").alias("m"), F.col("back2").cast("float").alias("y")
    )
    three = stage(
        triples.join(contexts, ["u", "v"]).select(
            "shard", "u", "v", "w", ((F.col("n") - DISCOUNT) / F.col("m")).alias("x"), "y",
        ), "triples",
    )
    drop_stages(spark, first, counted)  # only the three frames written last are read from here on
    none = F.lit(None).cast("long")
    columns = ["shard", "kind", "u", "v", "w", "n", "x", "y"]
    rows = (
        follows.filter(F.col("v") != START).select(
            F.pmod(F.col("v"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("kind"), none.alias("u"),
            F.col("v").alias("w"), F.col("m").alias("n"), F.col("back").alias("x"), F.lit(None).cast("float").alias("y"),
        ).withColumn("v", none).select(columns)
        .unionByName(two.withColumns({"kind": F.lit(1), "u": none, "n": none}).select(columns))
        .unionByName(three.withColumns({"kind": F.lit(2), "n": none}).select(columns))
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, group in _shard_groups(batches):
            table = pa.Table.from_batches(list(group))
            got = {}
            for name in columns[1:]:
                a = table[name].combine_chunks().fill_null(0).to_numpy(zero_copy_only=False)
                got[name] = a.view(np.uint64) if name in ("u", "v", "w") else a
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([_shard_file(got)])], ["shard", "data"]
            )

    with shuffles_removed(spark):
        rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(
            lean(build), "shard int, data binary"
        ).write.parquet(path)
    back = follows.filter(F.col("v") == START).first()["back"]  # one row
    return shards, total, kinds, back, filter_, common


# Scoring


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score and score of each row of ``docs(doc_id, text)``.

    ``n_tokens`` counts the words and the end; ``n_known`` those seen in training. ``base_score``
    is the log10 probability from single words, ``score`` that of the whole model.

    - NULL and empty texts are one token, the end. Rows with equal ids are scored one by one.
    - Texts of any length are scored whole; other columns are ignored; no rows give no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    shards, total, kinds, start = model.shards, model.total, model.kinds, model.start
    kept, common = model.pairs, model.common
    ranges = max(LEAST_SHARDS, shards // RANGE_SHARDS)
    names = ["range", "kind", "chunk", "shard", "doc_id", "n_tokens", "data"]
    out = ["place", "doc_id", "n_tokens", "n_known", "base_score", "score"]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in _chunks(batches, 1):
            t = Tokens.of(texts)
            # places of a chunk follow each other, so its first place names them all
            at_row = rows["place"].combine_chunks().to_numpy()
            chunk, size = int(at_row[0]), len(texts)
            sizes = np.bincount(t.text, minlength=size)
            # every row once with its id, for the sums to be named after
            yield pa.RecordBatch.from_arrays(
                [pa.array(at_row % ranges, pa.int32()), pa.array(np.full(size, 2, np.int32)), pa.array(at_row),
                 pa.nulls(size, pa.int32()), rows["doc_id"].combine_chunks(), pa.array(sizes),
                 pa.nulls(size, pa.binary())], names,
            )
            # every word of a text once, with how often it occurs
            both, times = np.unique(t.text * len(t.names) + t.w, return_counts=True)
            of, word = np.divmod(both, len(t.names))
            may = _passes(kept.value, t.pair_hashes())
            t = t.only(may, np.concatenate([[False], may[:-1]]))
            words, pairs = _dealt(_word_shard(t.names[word], shards)), _dealt(t.pair_hashes() % shards)
            place = _find(common.value, t.names)
            for shard in sorted({*words, *pairs}):
                a, b = (d.get(shard, np.zeros(0, np.int64)) for d in (words, pairs))
                columns = _columns(t.names, place, word=word[a], u=t.u[b], v=t.v[b], w=t.w[b])
                counts = [np.bincount(x, minlength=size) for x in (of[a], t.text[b])]
                data = _pack({
                    **columns, "times": _narrow(times[a]),
                    "word_sizes": _narrow(counts[0]), "pair_sizes": _narrow(counts[1]),
                })
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard * ranges // shards], pa.int32()), pa.array([1], pa.int32()), pa.array([chunk]),
                     pa.array([shard], pa.int32()), pa.nulls(1, rows["doc_id"].type), pa.nulls(1, pa.int64()),
                     pa.array([data])], names,
                )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _shard_groups(batches):
            with MappedShards() as mapped:
                held: list[tuple[int, int, bytes]] = []
                for batch in group:
                    kinds_of, chunks, numbers = (batch.column(i).fill_null(0).to_numpy() for i in (1, 2, 3))
                    for i in np.flatnonzero(kinds_of < 2).tolist():
                        number, data = int(numbers[i]), batch.column(6)[i].as_buffer()
                        if kinds_of[i] == 0:
                            mapped.add(number, data)
                            continue
                        if held and chunks[i] != held[-1][0] and sum(len(d) for *_, d in held) > HELD_BYTES:
                            yield from _sums(mapped, held, batch.column(4).type)
                            held = []
                        held.append((int(chunks[i]), number, data.to_pybytes()))
                    ids = batch.filter(pa.array(kinds_of == 2))
                    zero, size = np.zeros(ids.num_rows), ids.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [ids.column(2), ids.column(4), ids.column(5), pa.array(zero.astype(np.int64)),
                         pa.array(zero), pa.array(np.full(size, start))], out,
                    )
                yield from _sums(mapped, held, batch.column(4).type)

    def _sums(
        mapped: MappedShards, held: list[tuple[int, int, bytes]], id_type: pa.DataType
    ) -> Iterator[pa.RecordBatch]:
        """The sums of the texts of whole chunks over the shards of a range."""
        sums: dict[int, np.ndarray] = {}
        for number, group in itertools.groupby(sorted(held, key=lambda x: x[1]), key=lambda x: x[1]):
            chunks, data = zip(*((c, d) for c, _, d in group))
            for chunk, parts in zip(chunks, _looked_up(mapped.shards.get(number), data)):
                sums[chunk] = sums[chunk] + parts if chunk in sums else parts
        for chunk, parts in sums.items():
            yield _summed(chunk, parts, id_type)

    def _looked_up(found: Shard | None, data: tuple[bytes, ...]) -> list[np.ndarray]:
        """For each part sent to a shard: tokens looked up, known tokens and both scores of its texts."""
        parts = [_unpack(pa.py_buffer(d), common.value) for d in data]
        firsts = np.cumsum([0, *(len(a["names"]) for a in parts)])
        names = np.concatenate([a["names"] for a in parts])
        word, u, v, w = (
            np.concatenate([a[c].astype(np.int64) + first for a, first in zip(parts, firsts)])
            for c in ("word", "u", "v", "w")
        )
        times, word_sizes, pair_sizes = (
            np.concatenate([a[c] for a in parts]).astype(np.int64) for c in ("times", "word_sizes", "pair_sizes")
        )
        n, log_back = np.zeros(len(names), np.int64), np.zeros(len(names))
        more = np.zeros(len(w))
        if found:
            used = _places(len(names), word)
            n[used], log_back[used] = found.words(names[used])
            more = found.sequences(names, u, v, w)
        size = len(word_sizes)
        of = np.repeat(np.arange(size), word_sizes)
        base = np.bincount(of, times * _log_base(n, total, kinds)[word], size).astype(float)
        full = base + np.bincount(of, times * log_back[word], size)
        full = full + np.bincount(np.repeat(np.arange(size), pair_sizes), more, size)
        known = np.bincount(of, times * (n[word] > 0), size)
        sums = np.stack([word_sizes.astype(float) + pair_sizes, known, base, full])
        return np.split(sums, np.cumsum([len(a["word_sizes"]) for a in parts])[:-1], axis=1)

    def _summed(chunk: int, sums: np.ndarray, id_type: pa.DataType) -> pa.RecordBatch:
        at = np.flatnonzero(sums[0] > 0)
        _, known, base, full = sums[:, at]
        return pa.RecordBatch.from_arrays(
            [pa.array(chunk + at), pa.nulls(len(at), id_type), pa.array(np.zeros(len(at), np.int64)),
             pa.array(known.astype(np.int64)), pa.array(base), pa.array(full)], out,
        )

    dealt = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("place")).mapInArrow(
        lean(deal), f"range int, kind int, chunk long, shard int, doc_id {kind}, n_tokens long, data binary"
    )
    files = model.files.select(
        F.expr(f"CAST(shard * {ranges}L DIV {shards} AS INT)").alias("range"),
        F.lit(0).alias("kind"), F.lit(None).cast("long").alias("chunk"), "shard",
        F.lit(None).cast(kind).alias("doc_id"), F.lit(None).cast("long").alias("n_tokens"), "data",
    )
    parts = files.unionByName(dealt).repartition("range").sortWithinPartitions(
        "range", "kind", "chunk", "shard"
    ).mapInArrow(
        lean(look_up), f"place long, doc_id {kind}, n_tokens long, n_known long, base_score double, score double",
    )
    return parts.groupBy("place").agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"),
        *[F.sum(c).alias(c) for c in out[2:]],
    ).select(
        "doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score"
    )
