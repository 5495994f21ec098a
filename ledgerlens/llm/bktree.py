"""Burkhard-Keller trees over 64-bit fingerprints, many at once in numpy.

Every group of points (a shard) gets a tree of its own. A point's child edge
carries its Hamming distance to the parent, so a search at radius r only follows
edges whose key lies within r of the distance to the node at hand. All trees of
a call grow and are searched level by level together.
"""

from __future__ import annotations

import numpy as np

#: Visited (query, node) pairs held at once; bounds a search's memory.
SLICE = 2_000_000


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def _runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of runs of equal values."""
    if len(sorted_keys) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], sorted_keys[1:] != sorted_keys[:-1])))


class Forest:
    """``points`` (uint64) with the group number of each (any integers)."""

    def __init__(self, points: np.ndarray, groups: np.ndarray):
        self.points = points
        groups_of, where = np.unique(groups, return_inverse=True)
        self.groups = groups_of
        left, bucket = np.arange(len(points)), where.astype(np.int64)
        parents, keys, kids = [], [], []
        self.roots = np.zeros(len(groups_of), np.int64)
        top = True
        while len(left):
            order = np.argsort(bucket, kind="stable")
            left, bucket = left[order], bucket[order]
            first = _runs(bucket)
            node = left[first]
            if top:
                self.roots[bucket[first]] = node
                top = False
            else:
                parents.append(bucket[first] // 65)
                keys.append(bucket[first] % 65)
                kids.append(node)
            size = np.diff(np.append(first, len(left)))
            owner = np.repeat(node, size)
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, owner = left[rest], owner[rest]
            bucket = owner * 65 + distance(points[left], points[owner])
        edge = np.concatenate(parents) * 65 + np.concatenate(keys) if parents else np.zeros(0, np.int64)
        order = np.argsort(edge)
        self.edge = edge[order]
        self.child = (np.concatenate(kids) if kids else np.zeros(0, np.int64))[order]

    def within(self, queries: np.ndarray, groups: np.ndarray, radius: int):
        """Yields (query index, point index, distance) of all points of the query's group within ``radius``."""
        slot = np.searchsorted(self.groups, groups)
        known = (slot < len(self.groups)) & (self.groups[np.minimum(slot, len(self.groups) - 1)] == groups) if len(self.groups) else np.zeros(len(groups), bool)
        q = np.flatnonzero(known)
        stack = [(q[i : i + SLICE], self.roots[slot[q[i : i + SLICE]]]) for i in range(0, len(q), SLICE)]
        while stack:
            q, node = stack.pop()
            d = distance(queries[q], self.points[node])
            hit = d <= radius
            if hit.any():
                yield q[hit], node[hit], d[hit]
            lo = np.searchsorted(self.edge, node * 65 + np.maximum(d - radius, 0), "left")
            hi = np.searchsorted(self.edge, node * 65 + np.minimum(d + radius, 64), "right")
            n = hi - lo
            go = n > 0
            q, lo, n = q[go], lo[go], n[go]
            ends = np.cumsum(n)
            at = 0
            while at < len(q):  # slices of bounded size
                base = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, base + SLICE, "right")))
                m = n[at:to]
                step = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                stack.append((np.repeat(q[at:to], m), self.child[np.repeat(lo[at:to], m) + step]))
                at = to


def lowest(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray) -> np.ndarray:
    """For n vertices with labels and links a-b: the smallest label of each vertex's component."""
    label = label.copy()
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        if (new == label).all():
            break
        label = new
    return label
