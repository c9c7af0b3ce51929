"""Compact arrays in one memory-mapped file: packed integers, Elias-Fano sequences, code books."""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Unsigned integers with ``width`` bits each, little-endian, with spare bytes at the end."""
    parts = []
    for at in range(0, len(values), 1 << 16):
        v = values[at:at + (1 << 16)].astype("<u8")
        bits = np.unpackbits(v.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :width]
        parts.append(np.packbits(bits.ravel(), bitorder="little"))
    return np.concatenate([*parts, np.zeros(16, np.uint8)])


def read_bits(packed: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """The integers at the given places."""
    if width == 0:
        return np.zeros(len(at), np.int64)
    words = np.ndarray((len(packed) - 7,), "<u8", packed, strides=(1,))
    bit = at.astype(np.int64) * width
    found = words[bit >> 3] >> (bit & 7).astype(np.uint64)
    return (found & np.uint64((1 << width) - 1)).astype(np.int64)


class EliasFano:
    """A non-decreasing sequence: low bits packed, high bits in unary, a rank per 64 bits."""

    def __init__(self, arrays: dict[str, np.ndarray], size: int, low_bits: int):
        self.arrays, self.size, self.low_bits = arrays, size, low_bits

    @staticmethod
    def build(values: np.ndarray) -> EliasFano:
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        bits = np.zeros((n + (top >> low_bits) + 64) // 64 * 64, np.uint8)
        bits[(values >> low_bits) + np.arange(n)] = 1
        words = np.packbits(bits, bitorder="little").view("<u8")
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        low = pack_bits(values & ((1 << low_bits) - 1), low_bits) if low_bits else np.zeros(16, np.uint8)
        kind = "<u4" if n < 1 << 32 else "<u8"
        return EliasFano({"low": low, "high": words, "ranks": ranks.astype(kind)}, n, low_bits)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at the given places."""
        high, ranks = self.arrays["high"], self.arrays["ranks"]
        word = np.searchsorted(ranks, at.astype(ranks.dtype), side="right") - 1
        left = at - ranks[word].astype(np.int64)  # ones to skip in the word
        octets = high[word].reshape(-1, 1).view(np.uint8).astype(np.int16)
        upto = np.cumsum(_ONES[octets], axis=1)
        octet = (upto <= left[:, None]).sum(axis=1)
        rows = np.arange(len(at))
        before = np.where(octet > 0, upto[rows, octet - 1], 0)
        place = word * 64 + octet * 8 + _NTH_ONE[octets[rows, octet], left - before]
        return ((place - at) << self.low_bits) | read_bits(self.arrays["low"], at, self.low_bits)

    def all(self) -> np.ndarray:
        """All values."""
        at = np.arange(self.size)
        ones = np.flatnonzero(np.unpackbits(self.arrays["high"].view(np.uint8), bitorder="little"))
        return ((ones - at) << self.low_bits) | read_bits(self.arrays["low"], at, self.low_bits)


_ONES = np.array([bin(i).count("1") for i in range(256)])
#: Place of the n-th one in a byte.
_NTH_ONE = np.array([
    ([b for b in range(8) if i >> b & 1] + [0] * 8)[:8] for i in range(256)
])


def code_book(values: np.ndarray) -> np.ndarray:
    """256 levels at equal shares of the values."""
    if not len(values):
        return np.zeros(256)
    return np.quantile(values, (np.arange(256) + 0.5) / 256)


def encode_levels(values: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest level of each value, as bytes."""
    return np.searchsorted((book[1:] + book[:-1]) / 2, values).astype(np.uint8)


def dump(arrays: dict[str, np.ndarray], numbers: dict[str, int]) -> bytes:
    """Named arrays one after the other, with a head that says where each lies."""
    head, at = {}, 0
    for name, a in arrays.items():
        head[name] = (at, len(a), a.dtype.str)
        at += -(-a.nbytes // 64) * 64
    text = json.dumps({"arrays": head, "numbers": numbers}).encode()
    text += b" " * (-(len(text) + 8) % 64)
    parts = [len(text).to_bytes(8, "little"), text]
    for a in arrays.values():
        parts += np.ascontiguousarray(a).tobytes(), b"\0" * (-a.nbytes % 64)
    return b"".join(parts)


def parse(data) -> tuple[dict[str, np.ndarray], dict[str, int]]:
    """The arrays of a buffer; nothing is copied."""
    whole = np.frombuffer(data, np.uint8)
    size = int.from_bytes(whole[:8].tobytes(), "little")
    head = json.loads(whole[8:8 + size].tobytes())
    start = 8 + size
    arrays = {
        name: whole[start + at:start + at + n * np.dtype(kind).itemsize].view(kind)
        for name, (at, n, kind) in head["arrays"].items()
    }
    return arrays, head["numbers"]


def save(path: str, arrays: dict[str, np.ndarray], numbers: dict[str, int]) -> None:
    """Write what ``dump`` gives."""
    with open(path, "wb") as f:
        f.write(dump(arrays, numbers))


def load(path: str) -> tuple[dict[str, np.ndarray], dict[str, int]]:
    """Map the arrays of a file into memory; nothing is read before it is used."""
    return parse(np.memmap(path, np.uint8, "r"))


def flat(named: Iterable[tuple[str, EliasFano]]) -> tuple[dict[str, np.ndarray], dict[str, int]]:
    """Arrays and numbers of sequences, for ``save``."""
    arrays: dict[str, np.ndarray] = {}
    numbers: dict[str, int] = {}
    for name, ef in named:
        arrays |= {f"{name}.{k}": a for k, a in ef.arrays.items()}
        numbers |= {f"{name}.size": ef.size, f"{name}.low_bits": ef.low_bits}
    return arrays, numbers


def sequence(arrays: dict[str, np.ndarray], numbers: dict[str, int], name: str) -> EliasFano:
    own = {k: arrays[f"{name}.{k}"] for k in ("low", "high", "ranks")}
    return EliasFano(own, numbers[f"{name}.size"], numbers[f"{name}.low_bits"])
