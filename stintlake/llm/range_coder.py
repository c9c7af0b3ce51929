"""Context-mixing range coder for sequences of integer ids, many blocks side by side.

Each block starts from nothing: it has an alphabet of its own, and its models adapt only to its
own ids. Three models predict the next id: order 2 and order 1 each name the id that last followed
the last two ids or the last one, with a confidence; order 0 gives every id of the alphabet a
share by its count. The probability of an id is the mixture of the three, whose weights
are learned for each pair of confidences, and drives a 60-bit range coder that puts out 20-bit words.
A block is coded step by step; numpy carries out each step for all blocks at once.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

from stintlake.llm.succinct import pack_bits, read_bits

#: Ids of one block.
BLOCK = 4096
#: log2 of slots for two-id contexts, of the shares of order 0, of the mixing weights.
_SLOTS, _SHARE, _WEIGHT = 12, 15, 15
_TOTAL = _SHARE + _WEIGHT
_WORD = 20
_LOW = 40  # the register holds three words: 60 bits
_ONE = 1 << _WEIGHT
_RATE = 5
#: Steps between refreshes of the order-0 shares, once warmed up.
_REFRESH = 512
#: log2 of the parts of the order-0 shares that a table leads into.
_PARTS = 8


class _Mixer:
    """The models of all blocks. Rows are blocks; ids are places in the block's alphabet."""

    def __init__(self, sizes: np.ndarray, reads: bool = False):
        self.sizes, self.reads = sizes, reads
        self.steps = 16
        blocks, width = len(sizes), int(sizes.max())
        self.width = width
        self.rows = np.arange(blocks, dtype=np.int64)
        self.one = np.zeros(blocks * width, np.int32)  # candidate * 8 + confidence
        self.two = np.zeros(blocks << _SLOTS, np.int32)
        self.base1 = self.rows * width
        self.base2 = self.rows << _SLOTS
        self.base0 = self.rows * (width + 1)
        self.take2 = np.full(blocks << 6, _ONE // 2, np.int32)  # weight of order 2
        self.take1 = np.full(blocks << 6, _ONE // 2, np.int32)  # weight of order 1 in the rest
        self.basew = self.rows << 6
        self.last = np.zeros(blocks, np.int64)
        self.before = np.zeros(blocks, np.int64)
        self.counts = (np.arange(width)[None, :] < sizes[:, None]).astype(np.int32)
        self.seen: list[np.ndarray] = []
        self.next = 16
        self._refresh()

    def _refresh(self) -> None:
        """Shares of order 0 from the counts: at least one each, 2 ** _SHARE together."""
        if self.seen:
            new = np.bincount(np.concatenate(self.seen), minlength=self.counts.size)
            self.counts += 24 * new.reshape(self.counts.shape).astype(np.int32)
            self.seen = []
        total = self.counts.sum(axis=1, dtype=np.int64)
        upto = np.cumsum(self.counts, axis=1, dtype=np.int64)
        room = (1 << _SHARE) - self.sizes
        order = np.minimum(np.arange(1, self.width + 1)[None, :], self.sizes[:, None])
        shares = np.zeros((len(self.sizes), self.width + 1), np.int32)
        shares[:, 1:] = upto * room[:, None] // total[:, None] + order
        self.upto = shares.ravel()
        if self.reads:  # where in the alphabet each part of the shares begins
            part = shares[:, 1:] >> (_SHARE - _PARTS)
            flat = part + (self.rows << (_PARTS + 1))[:, None]
            per_part = np.bincount(flat.ravel(), minlength=len(self.rows) << (_PARTS + 1))
            per_part = per_part.reshape(-1, 2 << _PARTS)[:, :1 << _PARTS]
            lead = np.zeros((len(self.rows), (1 << _PARTS) + 1), np.int32)
            lead[:, 1:] = np.cumsum(per_part, axis=1)
            self.lead = lead.ravel()

    def predict(self, n: int) -> None:
        """Candidates and weights for the next id of the first ``n`` blocks."""
        self.n = n
        last = self.last[:n]
        self.at1 = self.base1[:n] + last
        mixed = (self.before[:n] * 40503 + last) * 2654435761
        self.at2 = self.base2[:n] + ((mixed >> 9) & ((1 << _SLOTS) - 1))
        e1, e2 = self.one[self.at1], self.two[self.at2]
        self.e1, self.e2 = e1, e2
        self.s1, self.s2 = e1 & 7, e2 & 7
        self.c1, self.c2 = e1 >> 3, e2 >> 3
        self.atw = self.basew[:n] + ((self.s2 << 3) | self.s1)
        self.p2, self.p1 = self.take2[self.atw], self.take1[self.atw]
        w2 = np.where(self.s2 > 0, self.p2, 0).astype(np.int64)
        alone = (self.s1 > 0) & ((self.c1 != self.c2) | (self.s2 == 0))
        w1 = np.where(alone, ((_ONE - w2) * self.p1) >> _WEIGHT, 0)
        self.w1, self.w2 = w1, w2
        self.w0 = _ONE - w1 - w2

    def interval(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and length of the ids' part of the mixture."""
        at = self.base0[:self.n] + x
        start = self.upto[at]
        share = self.upto[at + 1] - start
        low = self.w0 * start + ((self.w1 * (self.c1 < x) + self.w2 * (self.c2 < x)) << _SHARE)
        size = self.w0 * share + ((self.w1 * (self.c1 == x) + self.w2 * (self.c2 == x)) << _SHARE)
        return low, size

    def find(self, v: np.ndarray) -> np.ndarray:
        """The ids whose part of the mixture holds the values."""
        swap = self.c1 > self.c2
        a, b = np.where(swap, self.c2, self.c1), np.where(swap, self.c1, self.c2)
        wa = np.where(swap, self.w2, self.w1) << _SHARE
        wb = np.where(swap, self.w1, self.w2) << _SHARE
        base = self.base0[:self.n]
        start_a = self.w0 * self.upto[base + a]
        end_a = self.w0 * self.upto[base + a + 1] + wa
        start_b = self.w0 * self.upto[base + b] + wa
        end_b = self.w0 * self.upto[base + b + 1] + wa + wb
        x = np.where(v < end_a, a, b).astype(np.int64)
        rest = np.flatnonzero((v < start_a) | ((v >= end_a) & (v < start_b)) | (v >= end_b))
        if len(rest):
            u = v[rest]
            u = u - np.where(u >= start_a[rest], wa[rest], 0) - np.where(u >= end_b[rest], wb[rest], 0)
            x[rest] = self._search(rest, u // self.w0[rest])
        return x

    def _search(self, rows: np.ndarray, share: np.ndarray) -> np.ndarray:
        """The ids of order 0 that hold the shares: a part by table, the rest by halving."""
        base = self.base0[rows] + 1
        part = (rows * ((1 << _PARTS) + 1)) + (share >> (_SHARE - _PARTS))
        lo = self.lead[part].astype(np.int64)
        hi = np.minimum(self.lead[part + 1], self.sizes[rows] - 1).astype(np.int64)
        open_ = np.flatnonzero(lo < hi)
        while len(open_):
            l, h = lo[open_], hi[open_]
            middle = (l + h) >> 1
            above = self.upto[base[open_] + middle] <= share[open_]
            lo[open_] = l = np.where(above, middle + 1, l)
            hi[open_] = h = np.where(above, h, middle)
            open_ = open_[l < h]
        return lo

    def update(self, x: np.ndarray) -> None:
        n = self.n
        hit1, hit2 = self.c1 == x, self.c2 == x
        self.one[self.at1] = _learned(self.e1, self.c1, self.s1, hit1, x)
        self.two[self.at2] = _learned(self.e2, self.c2, self.s2, hit2, x)
        some = self.s2 > 0
        target = np.where(hit2, _ONE - 64, 64)
        self.take2[self.atw] = np.where(some, self.p2 + ((target - self.p2) >> _RATE), self.p2)
        some = (self.w1 > 0) & ~(hit2 & some)
        target = np.where(hit1, _ONE - 64, 64)
        self.take1[self.atw] = np.where(some, self.p1 + ((target - self.p1) >> _RATE), self.p1)
        self.before[:n] = self.last[:n]
        self.last[:n] = x
        self.seen.append(self.base1[:n] + x)
        self.next -= 1
        if self.next == 0:
            self._refresh()
            self.steps = min(2 * self.steps, _REFRESH)
            self.next = self.steps


def _learned(entry, candidate, state, hit, x):
    """A hit raises the confidence; a miss halves it, or puts the new id in place."""
    miss = np.where(state <= 1, x * 8 + 1, (candidate << 3) | (state >> 1))
    return np.where(hit & (state > 0), entry + (state < 7), miss)


@dataclass
class Coded:
    """Coded blocks: ids and words of each, alphabets as differences, checksums, packed words."""

    lengths: np.ndarray
    words: np.ndarray
    alphabets: np.ndarray  # sizes
    checksums: np.ndarray
    differences: bytes
    packed: bytes


def encode(ids: np.ndarray, block: int = BLOCK) -> Coded:
    """Code an array of ids (under 2 ** 31) as blocks of ``block`` ids; the last may be shorter."""
    n = len(ids)
    if not n:
        none = np.zeros(0, np.int64)
        return Coded(none, none, none, none, zlib.compress(b""), b"")
    blocks = -(-n // block)
    lengths = np.full(blocks, block, np.int64)
    lengths[-1] = n - block * (blocks - 1)
    alphabets, dense = [], np.zeros(blocks * block, np.int32)
    for start in range(0, n, block):
        alphabet, places = _alphabet(ids[start:start + block])
        alphabets.append(alphabet)
        dense[start:start + len(places)] = places
    sizes = np.array([len(a) for a in alphabets])
    steps = np.concatenate([np.diff(a, prepend=0) for a in alphabets])
    by_step = np.ascontiguousarray(dense.reshape(blocks, block).T)

    mixer = _Mixer(sizes)
    low, span = np.zeros(blocks, np.int64), np.full(blocks, 1 << 60, np.int64)
    out = np.zeros((blocks, int(lengths.max()) * 2 + 8), np.int64)
    at = np.zeros(blocks, np.int64)
    active = blocks
    for t in range(int(lengths.max())):
        if t == lengths[-1]:
            active = blocks - 1
        x = by_step[t, :active]
        mixer.predict(active)
        start, size = mixer.interval(x)
        unit = span[:active] >> _TOTAL
        low[:active] += unit * start
        span[:active] = unit * size
        mixer.update(x)
        _put(low, span, out, at, active)
    for _ in range(3):  # the register
        out[mixer.rows, at] = low >> _LOW
        at += 1
        low = (low & ((1 << _LOW) - 1)) << _WORD
    for j in range(int(at.max()) - 1, 0, -1):  # carries
        out[:, j - 1] += out[:, j] >> _WORD
        out[:, j] &= (1 << _WORD) - 1
    words = out[np.arange(out.shape[1])[None, :] < at[:, None]]
    raw = ids.astype("<u4")
    checksums = np.array([zlib.crc32(raw[i * block:(i + 1) * block].tobytes()) for i in range(blocks)], np.int64)
    return Coded(lengths, at, sizes, checksums, zlib.compress(steps.astype("<u4").tobytes()),
                 pack_bits(words, _WORD).tobytes())


def _alphabet(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order, and the place of each id there."""
    top = int(ids.max())
    if top >= 1 << 20:
        return np.unique(ids, return_inverse=True)
    there = np.zeros(top + 1, bool)
    there[ids] = True
    alphabet = np.flatnonzero(there)
    place = np.empty(top + 1, np.int32)
    place[alphabet] = np.arange(len(alphabet))
    return alphabet, place[ids]


def _put(low: np.ndarray, span: np.ndarray, out: np.ndarray, at: np.ndarray, active: int) -> None:
    """Put out the top word where the span has become small; a carry stays in the word."""
    full = np.flatnonzero(span[:active] < 1 << _LOW)
    while len(full):
        l = low[full]
        out[full, at[full]] = l >> _LOW
        at[full] += 1
        low[full] = (l & ((1 << _LOW) - 1)) << _WORD
        span[full] <<= _WORD
        full = full[span[full] < 1 << _LOW]


def decode(coded: Coded) -> np.ndarray:
    """The ids of all blocks; raises if a block's checksum does not fit."""
    blocks = len(coded.lengths)
    if not blocks:
        return np.zeros(0, np.int64)
    sizes, lengths = coded.alphabets.astype(np.int64), coded.lengths
    steps = np.frombuffer(zlib.decompress(coded.differences), "<u4").astype(np.int64)
    firsts = np.cumsum(sizes) - sizes
    upto = np.cumsum(steps)
    alphabet = upto - np.repeat(upto[firsts] - steps[firsts], sizes)
    total = int(coded.words.sum())
    packed = np.frombuffer(coded.packed, np.uint8)
    words = np.concatenate([read_bits(packed, np.arange(total), _WORD), np.zeros(4, np.int64)])
    at = np.cumsum(coded.words) - coded.words
    code = (words[at] << _LOW) | (words[at + 1] << _WORD) | words[at + 2]
    at = at + 3
    span = np.full(blocks, 1 << 60, np.int64)
    mixer = _Mixer(sizes, reads=True)
    longest = int(lengths.max())
    dense = np.zeros((longest, blocks), np.int64)
    active = blocks
    for t in range(longest):
        if t == lengths[-1]:
            active = blocks - 1
        mixer.predict(active)
        unit = span[:active] >> _TOTAL
        value = np.minimum(code[:active] // unit, (1 << _TOTAL) - 1)
        x = mixer.find(value)
        start, size = mixer.interval(x)
        code[:active] -= unit * start
        span[:active] = unit * size
        mixer.update(x)
        full = np.flatnonzero(span[:active] < 1 << _LOW)
        while len(full):
            code[full] = (code[full] << _WORD) | words[np.minimum(at[full], total)]
            at[full] += 1
            span[full] <<= _WORD
            full = full[span[full] < 1 << _LOW]
        dense[t, :active] = x
    inside = np.arange(longest)[None, :] < lengths[:, None]
    ids = alphabet[(dense.T + firsts[:, None])[inside]]
    raw = ids.astype("<u4")
    ends = np.cumsum(lengths)
    for i, (a, b) in enumerate(zip(ends - lengths, ends)):
        if zlib.crc32(raw[a:b].tobytes()) != coded.checksums[i]:
            raise ValueError(f"block {i} is damaged")
    return ids
