"""A BK-tree over 64-bit fingerprints, built and searched on whole arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 48


class BKTree:
    """Children of a node are keyed by their integer Hamming distance to the node.

    The tree is the one that inserting the points in order would give: the first point
    becomes the root, the others go to the child of their distance, and so on below.
    A set of ``LEAF`` points or fewer is kept flat and compared directly.
    """

    def __init__(self, points: np.ndarray):
        self.points = points
        self._root = self._build(np.arange(len(points)))

    def _build(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members
        pivot, rest = members[0], members[1:]
        distance = np.bitwise_count(self.points[rest] ^ self.points[pivot])
        children = {int(d): self._build(rest[distance == d]) for d in np.unique(distance)}
        return int(pivot), children

    def within(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of (query number, point number) that differ in at most ``radius`` bits."""
        todo = [(self._root, np.arange(len(queries)))]
        while todo:
            node, asked = todo.pop()
            if isinstance(node, np.ndarray):
                close = np.bitwise_count(
                    queries[asked][:, None] ^ self.points[node][None, :]
                ) <= radius
                at, hit = np.nonzero(close)
                if len(at):
                    yield asked[at], node[hit]
                continue
            pivot, children = node
            distance = np.bitwise_count(queries[asked] ^ self.points[pivot]).astype(np.int64)
            found = asked[distance <= radius]
            if len(found):
                yield found, np.full(len(found), pivot)
            for edge, child in children.items():
                # Only edges within the radius can lead to a point within it.
                follow = asked[np.abs(distance - edge) <= radius]
                if len(follow):
                    todo.append((child, follow))


QUERY_BLOCK = 256


def spanning_links(points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join exactly the points connected by steps of at most ``radius`` bits.

    Points must be distinct. Of a connected set of n points n - 1 links are returned,
    each to the set's first point, however many pairs are close.
    """
    parent = np.arange(len(points))
    tree = BKTree(points)
    for start in range(0, len(points), QUERY_BLOCK):
        for asked, hit in tree.within(points[start:start + QUERY_BLOCK], radius):
            _merge(parent, asked + start, hit)
    below = np.flatnonzero(parent != np.arange(len(points)))
    return points[parent[below]], points[below]


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of each pair; afterwards every point's parent is its set's first point."""
    while True:
        low, high = np.minimum(parent[a], parent[b]), np.maximum(parent[a], parent[b])
        apart = low != high
        if not apart.any():
            return
        np.minimum.at(parent, high[apart], low[apart])
        while not np.array_equal(up := parent[parent], parent):
            parent[:] = up
