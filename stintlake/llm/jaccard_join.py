"""N-gram Jaccard self-join of texts by count-vector R-trees.

A text is its set of five-word shingles, as 64-bit hashes. Shingles are also hashed into groups,
and the counts per group make a point; the sum of coordinate minima of two points is never
less than the size of the sets' intersection. Similar sets must share one of their rarest
shingles (the prefix that the threshold allows), so each shingle of a prefix is a block. In a
block, points are packed into an R-tree that is joined with itself: node pairs whose maxima
cannot reach the overlap that the threshold asks for, or that are connected already, are left out.
What survives is verified on the sets.

Texts with equal sets are one class from the start. A first round verifies only neighbours in
each block, which connects large groups of copies with a few pairs per text. The second round
joins what is left in blocks that still hold several components. A block puts out no pairs, but
groups that all its surviving pairs lie in; groups of several blocks are united, and each
meets once, in tiles of bounded size, where all its sets are compared.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlake.llm.common import LOWER, lean, mix64, on_release, stage, text_bytes
from stintlake.llm.components import connected

WORDS = 5
THRESHOLD_PERCENT = 75
GROUPS = 64
#: Points in a leaf and children in a node of a tree.
FANOUT = 32
#: Blocks up to this size are compared row by row instead of by a tree.
SMALL_BLOCK = 12
#: The frequency sketch: texts and shingles at most that a task counts at a time, log2 of the
#: counters and of those that are added up together, and the least count that matters.
SKETCH_TEXTS = 30_000
SKETCH_HELD = 1 << 20
SKETCH_BITS, SKETCH_SPAN = 24, 12
SKETCH_LEAST = 8
#: Neighbours of a text that the first round verifies: those met in most of its blocks.
NEIGHBOURS = 4
#: A block expected to be larger is dealt to several tasks in the first round.
SALT_ROWS = 4096
#: Texts and shingles of a part of a group, on average; a tile compares one part or two.
TILE_ROWS = 2048
TILE_SHINGLES = 1 << 21

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                         0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)


# Sets, prefixes and points of texts


class _Hashes(dict):
    """Word to 64-bit hash, for the words a worker met last."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 200_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_HASHES, _OWNER = _Hashes(), "shingles"
on_release(_OWNER, _HASHES.clear)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of the text's runs of ``words`` words; of all, if there are fewer."""
    found = text.translate(LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), np.uint64)
    for i in range(min(words, len(h))):
        out += h[i:i + n] * (_MULTIPLIERS[i % 5] * np.uint64(2 * (i // 5) + 1))
    return np.unique(mix64(out))


def needed_overlap(a, b, percent: int):
    """The least intersection of sets of sizes ``a`` and ``b`` that makes them similar."""
    return -(-percent * (a + b) // (100 + percent))


def _prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def _point(h: np.ndarray) -> bytes:
    """Counts per group, and before them the bytes of a count.

    The number of groups doubles with the size of the set, since counts of many shingles in few
    groups tell no two texts apart. Groups follow the top bits, so halves of a group add up.
    """
    bits = max(6, (len(h) >> 3).bit_length())
    counts = np.bincount((h >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    width = 1 if counts.max() < 1 << 8 else 2 if counts.max() < 1 << 16 else 4
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def _points(values: list[bytes], groups: int = GROUPS) -> np.ndarray:
    """Points as rows of ``groups`` counts, finer ones added up."""
    out = np.zeros((len(values), groups), np.int32)
    kinds = np.array([v[0] for v in values])
    sizes = np.array([len(v) for v in values])
    for width, size in {(int(k), int(n)) for k, n in zip(kinds, sizes)}:
        at = np.flatnonzero((kinds == width) & (sizes == size))
        raw = np.frombuffer(b"".join([values[i][1:] for i in at]), f"<u{width}")
        out[at] = raw.reshape(len(at), groups, -1).sum(axis=2)
    return out if out.size and out.max() >= 256 else out.astype(np.uint8)


def _overlap_bound(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Sums of coordinate minima of pairs, each in the finest groups that both points have."""
    groups = np.array([min((len(x) - 1) // x[0], (len(y) - 1) // y[0]) for x, y in zip(a, b)])
    out = np.zeros(len(a), np.int64)
    for g in np.unique(groups):
        at = np.flatnonzero(groups == g)
        for part in range(0, len(at), max(1, 4_000_000 // int(g))):
            some = at[part:part + max(1, 4_000_000 // int(g))]
            x, y = _points([a[i] for i in some], int(g)), _points([b[i] for i in some], int(g))
            out[some] = np.minimum(x, y).sum(axis=1, dtype=np.int64)
    return out


def frequency_sketch(docs: DataFrame, words: int, texts: int = SKETCH_TEXTS) -> np.ndarray:
    """Levels (log2) of the counts of shingles in all texts, by counter.

    Every text is counted; a task puts its counts out after ``texts`` texts, or sooner if they
    are long, and they are added up by ranges of counters. The sketch has a fixed size and only orders shingles
    from rare to frequent; whatever it says, the order is the same for all texts, and so no
    similar pair is lost.
    """
    span = 1 << SKETCH_SPAN

    def counted(slots: list[np.ndarray]) -> pa.RecordBatch:
        slot, n = np.unique(np.concatenate(slots), return_counts=True)
        part = slot >> SKETCH_SPAN
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        ends = np.append(starts[1:], len(slot))
        low, n = (slot & (span - 1)).astype("<u2"), n.astype("<u4")
        return pa.RecordBatch.from_arrays(
            [pa.array(part[starts].astype(np.int32)),
             pa.array([low[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary()),
             pa.array([n[i:j].tobytes() for i, j in zip(starts, ends)], pa.binary())],
            ["part", "slots", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for text in text_bytes(batch.column(0)):
                slots.append((shingles(text, words) >> np.uint64(64 - SKETCH_BITS)).astype(np.int32))
                held += len(slots[-1])
                if len(slots) >= texts or held >= SKETCH_HELD:
                    yield counted(slots)
                    slots, held = [], 0
        if slots:
            yield counted(slots)

    def leveled(part: int, total: np.ndarray) -> pa.RecordBatch:
        level = np.minimum(255, np.frexp(total.astype(float))[1]).astype(np.uint8)
        level[total < SKETCH_LEAST] = 0
        return pa.RecordBatch.from_arrays(
            [pa.array([part], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["part", "levels"]
        )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, np.zeros(span, np.int64)
        for batch in batches:
            for part, slots, counts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if part != last:
                    if last is not None:
                        yield leveled(last, total)
                    last, total = part, np.zeros(span, np.int64)
                total[np.frombuffer(slots, "<u2")] += np.frombuffer(counts, "<u4")
        if last is not None:
            yield leveled(last, total)

    counts = docs.select("text").mapInArrow(lean(run, _OWNER), "part int, slots binary, counts binary")
    rows = (
        counts.repartition("part").sortWithinPartitions("part")
        .mapInArrow(lean(add_up, _OWNER), "part int, levels binary").toArrow()
    )
    sketch = np.zeros((1 << (SKETCH_BITS - SKETCH_SPAN), span), np.uint8)
    for part, levels in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
        sketch[part] = np.frombuffer(levels, np.uint8)
    return sketch.ravel()


_TEXTS = """doc_id {kind}, text_key long, text_hash binary, digest binary, n int, keys binary,
    point binary"""


def describe(docs: DataFrame, sketch, words: int, percent: int) -> DataFrame:
    """Per row: hashes of text and set, the set's size, its prefix (rarest first) and its point."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = sketch.value
        for batch in batches:
            rows = []
            for text in text_bytes(batch.column(1)):
                h = shingles(text, words)
                if not len(h):
                    rows.append((xxhash.xxh3_128_digest(text), None, 0, None, None))
                    continue
                level = levels[(h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                order = np.argsort(level, kind="stable")[:_prefix_length(len(h), percent)]
                rows.append((
                    xxhash.xxh3_128_digest(text), xxhash.xxh3_128_digest(h.tobytes()), len(h),
                    h[order].tobytes(), _point(h),
                ))
            kinds = (pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary())
            columns = zip(*rows) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "text_key", "text_hash", "digest", "n", "keys", "point"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    key = F.xxhash64(F.col("text")).alias("text_key")
    return docs.select("doc_id", "text", key).mapInArrow(lean(run, _OWNER), _TEXTS.format(kind=kind))


# Blocks


def _block_rows(prefixes: DataFrame, sketch, salt_rows: int) -> DataFrame:
    """A row for each shingle of each prefix: key, salt, salted, n, node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = sketch.value
        for batch in batches:
            for part in range(0, batch.num_rows, 2000):
                some = batch.slice(part, 2000)
                parts = [np.frombuffer(k, np.uint64) for k in some.column(2).to_pylist()]
                sizes = [len(p) for p in parts]
                keys = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
                node = np.repeat(some.column(0).to_numpy(), sizes)
                n = np.repeat(some.column(1).to_numpy(), sizes)
                level = levels[(keys >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                expected = np.where(level > 0, np.exp2(level), 0)
                salts = np.maximum(1, expected // salt_rows).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array((node % salts).astype(np.int32)),
                     pa.array(salts > 1), pa.array(n), pa.array(node)],
                    ["key", "salt", "salted", "n", "node"],
                )

    return prefixes.select("node", "n", "keys").mapInArrow(
        lean(run, _OWNER), "key long, salt int, salted boolean, n int, node long"
    )


_SHARED = "key long, salted boolean, n int, node long, first boolean, before long, lead long, salt int"


def _shared(rows: DataFrame, percent: int, *block: str) -> DataFrame:
    """Rows of blocks with several nodes, with the node before and the block's first node.

    Both are the row's own node where the sizes cannot be similar; ``first`` marks first nodes.
    """
    in_order = rows.repartition(*block).sortWithinPartitions(*block, "n", "node")
    names = ["key", "salt", "salted", "n", "node"]
    by_salt = "salt" in block

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = lead = None  # the last row so far, and its block's first node
        waiting = False  # the last row is the first of its block and not yet put out
        for batch in batches:
            if not batch.num_rows:
                continue
            t = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if last is not None:
                t = [np.concatenate([[a], b]).astype(b.dtype) for a, b in zip(last, t)]
            same = t[0][1:] == t[0][:-1]
            if by_salt:
                same &= t[1][1:] == t[1][:-1]
            size = len(t[0])
            after = np.concatenate([[False], same])
            head = np.maximum.accumulate(np.where(after, 0, np.arange(size)))
            first, least = t[4][head], t[3][head]
            if last is not None:
                first, least = np.where(head == 0, lead[0], first), np.where(head == 0, lead[1], least)
            starts = first == t[4]
            near = after & (100 * np.concatenate([[0], t[3][:-1]]).astype(np.int64) >= percent * t[3].astype(np.int64))
            before = np.where(near, np.concatenate([[0], t[4][:-1]]), t[4])
            fits = 100 * least.astype(np.int64) >= percent * t[3].astype(np.int64)
            leads = np.where(fits, first, t[4])
            out = after.copy()
            out[:-1] |= same & ~after[:-1]
            out |= t[2]  # a salted block's only node may meet others of its key
            if last is not None:
                out[0] = waiting and bool(same[0])
            took = np.flatnonzero(out)
            columns = [x[took] for x in (t[0], t[2], t[3], t[4], starts, before, leads, t[1])]
            kinds = (pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["key", "salted", "n", "node", "first", "before", "lead", "salt"],
            )
            waiting = not out[-1]
            last, lead = [x[-1] for x in t], (first[-1], least[-1])

    return in_order.select(*names).mapInArrow(lean(run, _OWNER), _SHARED)


# Trees


def _tree(points: np.ndarray, n: np.ndarray, component: np.ndarray) -> list[dict]:
    """Levels from leaves to root; rows must be in packing order. Each node has the maxima of
    its points, the range of their sizes and their component, or -1 if they have several."""
    level = {"max": points, "low": n, "high": n, "one": component}
    levels = [level]
    while len(level["low"]) > 1:
        at = np.arange(0, len(level["low"]), FANOUT)
        least = np.minimum.reduceat(level["one"], at)
        level = {
            "max": np.maximum.reduceat(level["max"], at, axis=0),
            "low": np.minimum.reduceat(level["low"], at),
            "high": np.maximum.reduceat(level["high"], at),
            "one": np.where(least == np.maximum.reduceat(level["one"], at), least, -1),
        }
        levels.append(level)
    return levels


def _survive(level: dict, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of nodes may hold a similar pair that is not connected yet."""
    low_a, low_b = level["low"][a], level["low"][b]
    keep = (level["one"][a] < 0) | (level["one"][a] != level["one"][b])
    keep &= (100 * level["high"][b] >= percent * low_a) & (100 * level["high"][a] >= percent * low_b)
    at = np.flatnonzero(keep)
    for part in range(0, len(at), 20_000):
        some = at[part:part + 20_000]
        bound = np.minimum(level["max"][a[some]], level["max"][b[some]]).sum(axis=1, dtype=np.int64)
        # the smallest sizes that fit each other on both sides
        x = np.maximum(low_a[some], -(-percent * low_b[some] // 100))
        y = np.maximum(low_b[some], -(-percent * low_a[some] // 100))
        keep[some] = bound >= needed_overlap(x, y, percent)
    return keep


def tree_join(
    points: np.ndarray, n: np.ndarray, component: np.ndarray, percent: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that pass the bound, from a join of the rows' R-tree with itself."""
    order = _packing_order(points, n)
    levels = _tree(points[order], n[order].astype(np.int64), component[order])
    work = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while work:
        depth, a, b = work.pop()
        if depth == 0:
            yield order[a], order[b]
            continue
        below = levels[depth - 1]
        size = len(below["low"])
        for part in range(0, len(a), 200):
            x = (a[part:part + 200, None] * FANOUT + np.arange(FANOUT))[:, :, None]
            y = (b[part:part + 200, None] * FANOUT + np.arange(FANOUT))[:, None, :]
            x, y = np.broadcast_arrays(x, y)
            fits = (x < size) & (y < size) & ((x < y) if depth == 1 else (x <= y))
            x, y = x[fits], y[fits]
            keep = _survive(below, x, y, percent)
            if keep.any():
                work.append((depth - 1, x[keep], y[keep]))


def _packing_order(points: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Slices by size, and in each by the coordinates that vary most."""
    slice_rows = FANOUT * max(1, int(np.sqrt(len(n) / FANOUT)))
    by_size = np.argsort(n, kind="stable")
    rank = np.empty(len(n), np.int64)
    rank[by_size] = np.arange(len(n)) // slice_rows
    widest = np.argsort(-points.astype(float).var(axis=0), kind="stable")[:4]
    return np.lexsort((*(points[:, g] for g in widest[::-1]), rank))


def _near_rows(key: np.ndarray, points: np.ndarray, n: np.ndarray, component: np.ndarray, percent: int):
    """The same for many small blocks at once: rows are compared with those that follow."""
    level = {"max": points, "low": n.astype(np.int64), "high": n.astype(np.int64), "one": component}
    for step in range(1, SMALL_BLOCK):
        a = np.flatnonzero(key[step:] == key[:-step])
        if not len(a):
            return
        keep = _survive(level, a, a + step, percent)
        yield a[keep], a[keep] + step


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the groups of rows ``a`` and ``b``; ``label`` is the first row of each row's group."""
    while True:
        x, y = label[a], label[b]
        new = x != y
        if not new.any():
            return
        a, b = a[new], b[new]
        np.minimum.at(label, np.maximum(x, y)[new], np.minimum(x, y)[new])
        while (label[label] != label).any():
            label[:] = label[label]


def _block_groups(rows: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b), fewer than its rows in each block, that hold together all pairs of nodes that
    survive the block's tree: rows are key, n, node, component, point."""
    in_order = rows.repartition("key").sortWithinPartitions("key", "n", "node")

    def groups_of(block: pa.Table) -> pa.RecordBatch:
        key = block.column("key").to_numpy()
        n, node = block.column("n").to_numpy(), block.column("node").to_numpy()
        component = block.column("component").to_numpy()
        raw = block.column("point").to_pylist()
        groups = np.array([(len(v) - 1) // v[0] for v in raw])
        edges = np.flatnonzero(np.diff(key)) + 1
        starts = np.concatenate([[0], edges, [len(key)]])
        sizes = np.diff(starts)
        small = np.repeat(sizes <= SMALL_BLOCK, sizes)
        at = np.flatnonzero(small)
        label = np.arange(len(key))
        coarse = _points([raw[i] for i in at])
        for a, b in _near_rows(key[at], coarse, n[at], component[at], percent):
            a, b = at[a], at[b]
            bound = _overlap_bound([raw[i] for i in a], [raw[i] for i in b])
            keep = bound >= needed_overlap(n[a].astype(np.int64), n[b].astype(np.int64), percent)
            _unite(label, a[keep], b[keep])
        for i in np.flatnonzero(sizes > SMALL_BLOCK):
            rows = np.arange(starts[i], starts[i + 1])
            group = np.arange(len(rows))
            for g in np.unique(groups[rows]):
                # Similar texts differ in size by a third at most, so their groups at most by half.
                own = np.flatnonzero((groups[rows] == g) | (groups[rows] == 2 * g))
                points = _points([raw[k] for k in rows[own]], int(g))
                found, held = [], 0
                for a, b in tree_join(points, n[rows[own]], component[rows[own]], percent):
                    found.append((own[a], own[b]))
                    held += len(a)
                    if held > 200_000:
                        _unite(group, *map(np.concatenate, zip(*found)))
                        found, held = [], 0
                if found:
                    _unite(group, *map(np.concatenate, zip(*found)))
            label[rows] = rows[group]
        at = np.flatnonzero(label != np.arange(len(label)))
        both = np.stack([node[label[at]], node[at]], axis=1).astype(np.int64)
        both = np.unique(both, axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(groups_of, _whole_groups(batches, 1))

    return in_order.select("key", "n", "node", "component", "point").mapInArrow(
        lean(run, _OWNER), "a long, b long"
    ).distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[pa.Table]:
    """Tables of one or more whole groups, from rows in order of the first ``columns`` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy() for i in range(columns)]
        new = np.flatnonzero(np.any([k != k[-1] for k in keys], axis=0))
        cut = int(new[-1]) + 1 if len(new) else 0  # rows before belong to whole groups
        if held and any(held[-1].column(i)[-1].as_py() != k[0] for i, k in enumerate(keys)):
            yield pa.Table.from_batches(held)
            held = []
        if cut:
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


# Verification


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose points, in full, allow the threshold."""
    point = classes.select("node", "n", "point")
    joined = (
        pairs.join(point.toDF("a", "n_a", "point_a"), "a").join(point.toDF("b", "n_b", "point_b"), "b")
        .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n_a, n_b = (batch.column(i).to_numpy() for i in range(4))
            bound = _overlap_bound(batch.column(4).to_pylist(), batch.column(5).to_pylist())
            keep = bound >= needed_overlap(n_a.astype(np.int64), n_b.astype(np.int64), percent)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])

    return joined.select("a", "b", "n_a", "n_b", "point_a", "point_b").mapInArrow(lean(run, _OWNER), "a long, b long")


#: Bits of the filter that picks the texts to read again.
FILTER_BITS = 27


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that holds the places of all ``keys(text_key)``.

    It only spares work: a text that passes by chance is left out by the join that follows.
    """
    place = F.col("text_key").bitwiseAND((1 << FILTER_BITS) - 1)
    bit = F.expr(f"shiftleft(1L, cast(text_key & {(1 << FILTER_BITS) - 1} & 63 as int))")
    rows = (
        keys.select(F.shiftright(place, 6).alias("word"), bit.alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    )
    words = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    words[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return words


def _sets_of(docs: DataFrame, classes: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node and words of every class in ``nodes(node)``, read again from one text of the class.

    Compressed words are a fraction of the hashes of their shingles.
    """
    import xxhash

    wanted = stage(
        classes.join(nodes, "node", "left_semi").select("node", "text_hash", "text_key"), "wanted"
    )
    filter_ = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            place = batch.column(1).to_numpy() & ((1 << FILTER_BITS) - 1)
            passes = (filter_.value[place >> 6] >> (place & 63)) & 1 == 1
            names, sets = [], []
            for text in text_bytes(batch.column(0).filter(pa.array(passes))):
                name = xxhash.xxh3_128_digest(text)
                if name not in seen:
                    seen.add(name)
                    names.append(name)
                    sets.append(zlib.compress(b" ".join(text.translate(LOWER).split()), 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(sets, pa.binary())], ["text_hash", "words"]
            )

    found = docs.select("text", F.xxhash64("text").alias("text_key")).mapInArrow(
        lean(run, _OWNER), "text_hash binary, words binary"
    )
    # equal texts from several tasks: any of them will do
    return stage(
        found.join(wanted, "text_hash").groupBy("node").agg(F.first("words").alias("words")), "sets"
    )


def _verified(pairs: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, tuple[bytes, np.ndarray]] = {}

        def set_of(side: int, packed: bytes) -> np.ndarray:
            if side not in last or last[side][0] != packed:
                last[side] = packed, shingles(zlib.decompress(packed), words)
            return last[side][1]

        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = set_of(0, x.as_py()), set_of(1, y.as_py())
                if len(x) > len(y):
                    x, y = y, x
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], ["a", "b"]
            )

    first = pairs.join(sets.toDF("a", "words_a"), "a")
    return first.join(sets.toDF("b", "words_b"), "b").select("a", "b", "words_a", "words_b").mapInArrow(
        lean(run, _OWNER), "a long, b long"
    )


def tile_links(
    node: np.ndarray, component: np.ndarray, second: np.ndarray, sets: list[np.ndarray], percent: int
) -> list[tuple[int, int]]:
    """Pairs of nodes with similar sets that connect all components of a tile that such pairs connect.

    Rows are compared with each other or, if some are of the ``second`` part, across parts.
    """
    size = np.array([len(x) for x in sets], np.int64)
    label = np.unique(component, return_inverse=True)[1]
    by_size = np.argsort(size, kind="stable")
    alone = bool(second.all() or not second.any())
    rows = by_size if alone else by_size[~second[by_size]]
    table = by_size if alone else by_size[second[by_size]]
    sizes = size[table]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    kinds, flat = np.unique(np.concatenate([sets[i] for i in table]), return_inverse=True)
    mark = np.zeros(len(kinds), np.uint8)
    links = []
    for p, i in enumerate(rows):
        n = int(size[i])
        lo = int(np.searchsorted(sizes, -(-percent * n // 100)))
        hi = p if alone else int(np.searchsorted(sizes, 100 * n // percent, "right"))
        if lo >= hi or (label[table[lo:hi]] == label[i]).all():
            continue
        place = np.minimum(np.searchsorted(kinds, sets[i]), len(kinds) - 1)
        place = place[kinds[place] == sets[i]]
        mark[place] = 1
        both = np.add.reduceat(mark[flat[ends[lo]:ends[hi]]], ends[lo:hi] - ends[lo], dtype=np.int64)
        mark[place] = 0
        similar = table[lo:hi][100 * both >= percent * (n + sizes[lo:hi] - both)]
        other, at = np.unique(label[similar], return_index=True)
        new = other != label[i]
        links += [(int(node[i]), int(node[j])) for j in similar[at[new]]]
        if new.any():
            label[np.isin(label, other)] = label[i]
    return links


def _group_links(groups: DataFrame, classes: DataFrame, sets: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) across the components of each group, fewer than rows in each tile.

    ``groups(node, root)`` is split into parts by a hash of the node, and each two parts meet in
    a tile. A group of one part meets in one task; larger ones send each set to as many
    tiles as there are parts.
    """
    of = groups.join(classes.select("node", "n"), "node")
    sizes = of.groupBy("root").agg(
        F.ceil(F.greatest(F.count("*") / TILE_ROWS, F.sum("n") / TILE_SHINGLES)).cast("int").alias("parts")
    )
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    rows = (
        of.join(sizes, "root").join(found.select("node", F.col("root").alias("component")), "node", "left")
        .join(sets, "node")
        .select("root", "node", F.coalesce("component", "node").alias("component"), "words", part.alias("part"),
                F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
        .select("root", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"),
                (F.col("part") > F.col("other")).alias("second"), "node", "component", "words")
    )
    tile = ["root", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, 3):
            keys = [table.column(i).to_numpy() for i in range(3)]
            second, node, component = (table.column(i).to_numpy() for i in range(3, 6))
            edges = np.flatnonzero(np.any([np.diff(k) != 0 for k in keys], axis=0)) + 1
            links = []
            for a, b in itertools.pairwise([0, *edges.tolist(), len(node)]):
                sets = [shingles(zlib.decompress(x.as_py()), words) for x in table.column(6)[a:b]]
                links += tile_links(node[a:b], component[a:b], second[a:b].astype(bool), sets, percent)
            x, y = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return rows.repartition(*tile).sortWithinPartitions(*tile, "node").mapInArrow(
        lean(run, _OWNER), "a long, b long"
    )


# The join


def _classes(texts: DataFrame) -> DataFrame:
    """One row per distinct set: digest, node, label (the smallest id), and one of its texts."""
    sets = texts.filter("n > 0").groupBy("digest").agg(
        F.min("doc_id").alias("label"), F.min("place").alias("place")
    )
    of = texts.select("place", "n", "point", "text_hash", "text_key")
    numbered = sets.join(of, "place").withColumn("node", F.monotonically_increasing_id())
    return stage(numbered, "classes")


def jaccard_components(
    docs: DataFrame, *, words: int = WORDS, percent: int = THRESHOLD_PERCENT,
    salt_rows: int = SALT_ROWS, sketch_texts: int = SKETCH_TEXTS,
) -> DataFrame:
    """Link texts whose sets of ``words``-word shingles have a Jaccard similarity of ``percent`` or more.

    One row per row of ``docs(doc_id, text)``: doc_id, text_key (hash of the text), n_shingles,
    component_id (the smallest doc_id reachable by links) and first_key (the text_key of the
    row that the component is named after).

    - Fewer words than a shingle: the whole sequence is one shingle. NULL texts and texts
      without words have no shingle and are linked with nothing.
    - Repeated rows and equal texts are linked. NULL doc_ids name a component only if all its ids are NULL.
    - Other columns are ignored; an empty table gives no rows; texts of any length are whole.
    """
    context = docs.sparkSession.sparkContext
    docs = docs.select("doc_id", "text")
    sketch = context.broadcast(frequency_sketch(docs, words, sketch_texts))
    described = describe(docs, sketch, words, percent)
    texts = stage(described.withColumn("place", F.monotonically_increasing_id()), "texts")
    classes = _classes(texts)
    prefixes = texts.select("place", "keys").join(classes.select("place", "node", "n"), "place")
    blocks = _block_rows(prefixes, sketch, salt_rows)
    shared = stage(_shared(blocks, percent, "key", "salt"), "shared")
    leads = _shared(
        shared.filter("salted and first").select("key", "salt", "salted", "n", "node"), percent, "key"
    )
    neighbours = shared.select("node", "before", "lead").unionByName(leads.select("node", "before", "lead"))
    met = neighbours.select("node", F.explode(F.array("before", "lead")).alias("other")).filter(
        "node <> other"
    ).groupBy("node", "other").agg(F.count("*").alias("blocks"))
    # At most two for each shingle of the prefix; the second round finds what this one leaves out.
    best = F.slice(F.sort_array(F.collect_list(F.struct("blocks", "other")), False), 1, NEIGHBOURS)
    pairs = met.groupBy("node").agg(best.alias("near")).select("node", F.explode("near").alias("near")).select(
        F.least("node", "near.other").alias("a"), F.greatest("node", "near.other").alias("b")
    ).distinct()
    tried = stage(_bounded(pairs, classes, percent), "pairs")
    ends = tried.select(F.explode(F.array("a", "b")).alias("node")).distinct()  # a few pairs a text
    links = stage(_verified(tried, _sets_of(docs, classes, ends, words), words, percent), "links")
    found = stage(connected(links), "components")

    mixed = stage(_mixed_blocks(shared, classes, found, percent), "mixed")
    if not mixed.isEmpty():
        groups = stage(connected(mixed), "groups")
        sets = _sets_of(docs, classes, groups.select("node"), words)
        more = stage(_group_links(groups, classes, sets, found, words, percent), "more-links")
        if not more.isEmpty():
            tree = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
            found = stage(connected(more.unionByName(tree)), "components")
    return _labelled(texts, classes, found)


def _mixed_blocks(shared: DataFrame, classes: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Edges that hold together the pairs, each across two components, that survive in the blocks
    with several."""
    of = shared.select("key", "n", "node").join(found, "node", "left").select(
        "key", "n", "node", F.coalesce("root", "node").alias("component")
    )
    of = stage(of, "block-components")
    mixed = of.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).filter("low <> high").select("key")
    rows = of.join(mixed, "key", "left_semi").join(classes.select("node", "point"), "node")
    return _block_groups(rows, percent)


def _labelled(texts: DataFrame, classes: DataFrame, found: DataFrame) -> DataFrame:
    named = classes.select("digest", "node", "label", "text_key").join(found, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    first = F.min_by(F.struct("label", "text_key"), F.struct(F.col("label").isNull(), "label"))
    names = named.groupBy("root").agg(first.alias("first"))
    of_class = stage(
        named.select("digest", "root").join(names, "root").select(
            "digest", F.col("first.label").alias("component_id"), F.col("first.text_key").alias("first_key")
        ), "class-components",
    )
    empty = texts.filter("n = 0").select(
        "doc_id", "text_key", F.lit(0).cast("long").alias("n_shingles"),
        F.col("doc_id").alias("component_id"), F.col("text_key").alias("first_key"),
    )
    return empty.unionByName(texts.filter("n > 0").join(of_class, "digest").select(
        "doc_id", "text_key", F.col("n").cast("long").alias("n_shingles"), "component_id", "first_key",
    ))


def keep_one(docs: DataFrame, **options: int) -> DataFrame:
    """One row of ``docs`` for each component, the one it is named after, with all columns.

    Texts without a shingle all stay. Of rows with the same id and text one stays. Columns of any
    name are kept.
    """
    labels = stage(jaccard_components(docs, **options), "labels")
    chosen = labels.filter("doc_id <=> component_id AND text_key = first_key").groupBy(
        F.col("doc_id").alias("id"), F.col("text_key").alias("key")
    ).agg((F.max("n_shingles") > 0).alias("linked"), F.count("*").alias("copies"))
    chosen = stage(chosen, "chosen").select(F.struct("*").alias("one"))
    # Columns of any name lie in one struct, apart from those of the join.
    keyed = docs.select(F.struct("*").alias("row"), F.xxhash64("text").alias("text_key"))
    same = F.col("row.doc_id").eqNullSafe(F.col("one.id")) & (F.col("text_key") == F.col("one.key"))
    rows = keyed.join(chosen.hint("shuffle_hash"), same)  # texts are streamed, not sorted
    several = F.col("one.linked") & (F.col("one.copies") > 1)
    if chosen.filter(several).isEmpty():
        return rows.select("row.*")
    once = rows.filter(several).dropDuplicates(["one"])
    return rows.filter(~several).unionByName(once).select("row.*")
