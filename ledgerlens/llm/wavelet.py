"""Words at one edit from each other, by two-dimensional range reporting in numpy.

Words of one length and of one letter less are sorted forwards and from their ends. The words that agree with a
word but for what stands at position i are those in the interval of its first i letters in
the forward order and in the interval of the letters after i in the reverse order: the points of a
rectangle in the permutation that leads from one order to the other, which a wavelet tree counts and reports.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Rectangles that are searched at once; bounds memory.
SLICE = 1_000_000


class WaveletTree:
    """Over a permutation of 0..n-1, level by level from the highest bit; at each level zeros stand before ones."""

    def __init__(self, values: np.ndarray):
        self.n = len(values)
        self.levels = int(self.n).bit_length()
        self.zeros = []  # how many zero bits stand before each place
        for bit in range(self.levels - 1, -1, -1):
            one = (values >> bit) & 1
            self.zeros.append(np.concatenate(([0], np.cumsum(1 - one))))
            values = np.concatenate([values[one == 0], values[one == 1]])

    def below(self, lo: np.ndarray, hi: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values at places lo..hi-1 are under the bound."""
        n = np.zeros(len(lo), np.int64)
        for i, zeros in enumerate(self.zeros):
            one = (bound >> (self.levels - 1 - i)) & 1 == 1
            a, b = zeros[lo], zeros[hi]
            n += np.where(one, b - a, 0)
            lo, hi = np.where(one, zeros[-1] + lo - a, a), np.where(one, zeros[-1] + hi - b, b)
        return n

    def report(self, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the rectangle, value) of all values at places lo..hi-1 from ``least`` up to below ``bound``."""
        q, base = np.arange(len(lo)), np.zeros(len(lo), np.int64)
        for i, zeros in enumerate(self.zeros):
            half = 1 << (self.levels - 1 - i)
            a, b = zeros[lo], zeros[hi]
            left = (b > a) & (base < bound[q]) & (base + half > least[q])
            right = (hi - lo > b - a) & (base + half < bound[q]) & (base + 2 * half > least[q])
            lo, hi = np.concatenate([a[left], (zeros[-1] + lo - a)[right]]), np.concatenate([b[left], (zeros[-1] + hi - b)[right]])
            base = np.concatenate([base[left], base[right] + half])
            q = np.concatenate([q[left], q[right]])
        return q, base


class _Order:
    """Rows sorted by group and text: places, shared prefixes of neighbours, and the interval of a prefix."""

    def __init__(self, letters: np.ndarray, group: np.ndarray):
        n, width = letters.shape
        text = np.ascontiguousarray(letters).view(f"S{width}").ravel()
        self.row = np.lexsort((text, group))
        self.place = np.empty(n, np.int64)
        self.place[self.row] = np.arange(n)
        ordered, g = letters[self.row], group[self.row]
        differ = ordered[1:] != ordered[:-1]
        same = np.where(differ.any(1), differ.argmax(1), width)
        shared = np.where(g[1:] == g[:-1], same, -1)
        either = np.full(n, -1)
        either[1:] = shared
        either[:-1] = np.maximum(either[:-1], shared)
        self.most = np.empty(n, np.int64)
        self.most[self.row] = either
        self.least = [shared]  # least of 1, 2, 4, ... neighbours on
        while 2 << (len(self.least) - 1) <= len(shared):
            last, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(last[:-step], last[step:]))

    def interval(self, row: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places from..to of the rows of the group that share so many first letters with the row."""
        lo, hi = self.place[row], self.place[row]
        for k in range(len(self.least) - 1, -1, -1):
            table, step = self.least[k], 1 << k
            can = hi < len(table)
            hi = hi + step * (can & (table[np.where(can, hi, 0)] >= length))
            can = lo >= step
            lo = lo - step * (can & (table[np.where(can, lo - step, 0)] >= length))
        return lo, hi + 1


def one_edit(words: list[bytes], group: np.ndarray, width: int, first: np.ndarray, last: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (row, near row) of words of one group of which one becomes the other by one edit at a position from ``first`` up to below ``last``.

    ``words`` are letters of one byte, ``width`` or one fewer each; no word is twice in a group. The replaced or deleted
    position is one of a word of ``width``; where several deletions give the same, the leftmost counts.
    So each replacement comes from both of its sides and each deletion once, then told from both.
    """
    if len(words) < 2:
        return
    size = np.array([len(w) for w in words])
    letters = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    ends = np.frombuffer(b"".join(w[::-1].ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    forward, back = _Order(letters, group), _Order(ends, group)
    tree = WaveletTree(back.place[forward.row])
    long = np.flatnonzero(size == width)
    # a rectangle holds another word only if a neighbour shares both the letters before and those after
    start = np.maximum(first[long], width - 1 - back.most[long])
    count = np.maximum(np.minimum(last[long], forward.most[long] + 1) - start, 0)
    ends_at = np.cumsum(count)
    at = 0
    while at < len(long):
        base = ends_at[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends_at, base + SLICE, "right")))
        c = count[at:to]
        row = np.repeat(long[at:to], c)
        place = np.repeat(start[at:to] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        at = to
        lo, hi = forward.interval(row, place)
        least, bound = back.interval(row, width - 1 - place)
        some = np.flatnonzero((hi - lo > 1) & (bound - least > 1))
        row, place, lo, hi, least, bound = (x[some] for x in (row, place, lo, hi, least, bound))
        some = np.flatnonzero(tree.below(lo, hi, bound) - tree.below(lo, hi, least) > 1)
        row, place, lo, hi, least, bound = (x[some] for x in (row, place, lo, hi, least, bound))
        q, value = tree.report(lo, hi, least, bound)
        other, row, place = back.row[value], row[q], place[q]
        replaced = (size[other] == width) & (other != row)
        yield row[replaced], other[replaced]
        leftmost = (place == 0) | (letters[row, np.maximum(place - 1, 0)] != letters[row, place])
        deleted = (size[other] < width) & leftmost
        yield row[deleted], other[deleted]
        yield other[deleted], row[deleted]
