"""Double-array tries over byte strings, built and walked by numpy."""

from __future__ import annotations

import numpy as np

#: Slots ahead of the first node, so that no base is negative, and behind the last.
_MARGIN = 256


class _Slots:
    def __init__(self, size: int):
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.end, self.holes = _MARGIN, np.zeros(0, np.int32)

    def grow(self, more: int) -> None:
        need = self.end + more + _MARGIN
        if need > len(self.base):
            extra = max(need, len(self.base) * 2) - len(self.base)
            self.base = np.concatenate([self.base, np.zeros(extra, np.int32)])
            self.check = np.concatenate([self.check, np.full(extra, -1, np.int32)])

    def place(self, parents: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """Slots of new nodes, given by parent, together and rising, and by letter, rising."""
        first = np.flatnonzero(np.concatenate([[True], parents[1:] != parents[:-1]]))
        count = np.diff(np.append(first, len(parents)))
        low, high = letters[first], letters[first + count - 1]
        # Siblings get a span of their own; only children fill what spans leave free.
        several = count > 1
        span = np.where(several, high - low + 1, 0)
        self.grow(int(span.sum()) + int((~several).sum()))
        start = self.end + np.concatenate([[0], np.cumsum(span)[:-1]])
        top = self.end + int(span.sum())
        self.base[parents[first[several]]] = (start - low)[several]
        used = np.repeat(several, count)
        slots = np.empty(len(parents), np.int32)
        slots[used] = self.base[parents[used]] + letters[used]
        free = np.ones(top - self.end, bool)
        free[slots[used] - self.end] = False
        holes = np.concatenate([self.holes, np.flatnonzero(free).astype(np.int32) + self.end])
        alone = int((~several).sum())
        taken = holes[:alone]
        self.holes, rest = holes[len(taken):], alone - len(taken)
        slots[~used] = np.concatenate([taken, np.arange(top, top + rest, dtype=np.int32)])
        self.end = top + rest
        self.base[parents[~used]] = slots[~used] - letters[~used]
        self.check[slots] = parents
        return slots


def build(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``base`` and ``check`` of the strings ``data[offsets[i]:offsets[i + 1]]``.

    The strings are sorted, differ, and none begins another. The base of a last node is the
    number of its string. All nodes of a depth are placed at once.
    """
    length = np.diff(offsets)
    slots = _Slots(len(data) + 2 * _MARGIN)
    active = np.arange(len(length))
    at = np.zeros(len(length), np.int32)  # the node of each string so far
    same = np.zeros(len(length), bool)  # whether the string before shares that node
    depth = 0
    while len(active):
        letters = data[offsets[active] + depth].astype(np.int32)
        before = np.concatenate([[-1], letters[:-1]])
        same = same & (letters == before)
        new = ~same
        made = slots.place(at[new], letters[new])
        at = made[np.cumsum(new) - 1]
        depth += 1
        ended = length[active] == depth
        slots.base[at[ended]] = active[ended]
        # What a string shares with the one before it is shared with none that has ended.
        active, at, same = active[~ended], at[~ended], same[~ended]
    return slots.base[:slots.end + _MARGIN], slots.check[:slots.end + _MARGIN]


def step(
    base: np.ndarray, check: np.ndarray, states: np.ndarray, letters: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Whether each state goes on with its letter, and the next states of those that do."""
    onward = base[states] + letters
    known = check[onward] == states
    return known, onward[known]
