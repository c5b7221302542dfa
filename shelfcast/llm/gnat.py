"""A multiway hyperplane tree over vectors, with distance ranges between sibling subtrees.

Each node holds a few split points; a row belongs to the nearest one. For each pair of
split point and sibling subtree the node knows the smallest and largest distance from
the point to any row of that subtree. A query that looks for rows at a distance between
two radii drops every subtree whose range cannot meet that ring around the query.

Inner products become distances by one more component: with M the largest norm, a row x
gets sqrt(M^2 - |x|^2) and a query q gets 0, so |q - x|^2 = |q|^2 + M^2 - 2 q.x.

The split points come from a bounded sample and travel with the tasks; the ranges are
taken over every row.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Split points are the farthest apart of so many candidates per point wanted.
CANDIDATES = 3


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def as_rows(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Data rows with the component that gives all of them the norm sqrt(largest)."""
    vectors = vectors.astype(float)
    rest = np.sqrt(np.maximum(largest - (vectors * vectors).sum(axis=1), 0.0))
    return np.column_stack([vectors, rest])


def as_queries(vectors: np.ndarray) -> np.ndarray:
    return np.column_stack([vectors.astype(float), np.zeros(len(vectors))])


@dataclass
class Node:
    points: np.ndarray
    #: For each split point the number of its node, or -1 - leaf.
    children: list[int] = field(default_factory=list)
    #: [i, j]: the least and greatest distance from split point i to the rows of subtree j.
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def _spread(points: np.ndarray, degree: int) -> np.ndarray:
    """Split points far from one another, chosen greedily from the first candidates."""
    candidates = points[:CANDIDATES * degree]
    chosen = [0]
    gap = distances(candidates, candidates[:1])[:, 0]
    while len(chosen) < degree and gap.max() > 1e-9 * max(1.0, np.abs(candidates).max()):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, distances(candidates, candidates[chosen[-1:]])[:, 0])
    return candidates[chosen]


@dataclass
class Tree:
    """Nodes and leaves; without nodes everything is in leaf 0."""

    nodes: list[Node] = field(default_factory=list)
    leaves: int = 0

    @classmethod
    def grow(cls, sample: np.ndarray, rows_each: float, leaf_rows: int, degree: int = 16) -> Tree:
        """A tree for rows of which each point of the sample stands for ``rows_each``."""
        tree = cls()
        todo = [(sample, -1, -1)]
        while todo:
            points, parent, place = todo.pop()
            wanted = min(degree, int(np.ceil(len(points) * rows_each / leaf_rows)))
            splits = _spread(points, wanted) if wanted > 1 else points[:0]
            if len(splits) > 1:
                number = len(tree.nodes)
                tree.nodes.append(Node(splits, [0] * len(splits)))
                nearest = distances(points, splits).argmin(axis=1)
                todo += [(points[nearest == k], number, k) for k in range(len(splits))]
            else:
                number = -1 - tree.leaves
                tree.leaves += 1
            if parent >= 0:
                tree.nodes[parent].children[place] = number
        return tree

    def _descend(self, points: np.ndarray):
        """(node, which points reach it, their distances to its split points, the nearest one)."""
        todo = [(0, np.arange(len(points)))] if self.nodes and len(points) else []
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            gaps = distances(points[at], node.points)
            nearest = gaps.argmin(axis=1)
            yield number, at, gaps, nearest
            todo += [(child, at[nearest == k]) for k, child in enumerate(node.children)
                     if child >= 0 and (nearest == k).any()]

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        leaf = np.zeros(len(points), np.int32)
        for number, at, _, nearest in self._descend(points):
            child = np.array(self.nodes[number].children)[nearest]
            leaf[at[child < 0]] = -1 - child[child < 0]
        return leaf

    def ranges(self, points: np.ndarray):
        """(node, i, j, least, greatest distance) of split points i and the given rows in subtree j."""
        for number, _, gaps, nearest in self._descend(points):
            for j in np.unique(nearest):
                part = gaps[nearest == j]
                for i, (least, most) in enumerate(zip(part.min(axis=0), part.max(axis=0))):
                    yield number, i, int(j), float(least), float(most)

    def set_ranges(self, rows) -> None:
        for node in self.nodes:
            node.low = np.full((len(node.points),) * 2, np.inf)
            node.high = np.full((len(node.points),) * 2, -np.inf)
        for number, i, j, least, most in rows:
            self.nodes[number].low[i, j], self.nodes[number].high[i, j] = least, most

    def meeting(self, queries: np.ndarray, inner: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, leaf) of all leaves that may hold a row between the two radii of a query.

        Radii are widened by what rounding may lose.
        """
        if not self.nodes:
            return np.arange(len(queries)), np.zeros(len(queries), np.int32)
        found_query, found_leaf = [], []
        todo = [(0, np.arange(len(queries)))]
        while todo:
            number, at = todo.pop()
            node = self.nodes[number]
            gaps = distances(queries[at], node.points)
            slack = 1e-6 * (1.0 + gaps)
            nearest_row = np.maximum(gaps - outer[at, None], inner[at, None] - gaps) - slack
            farthest_row = gaps + outer[at, None] + slack
            alive = np.ones(gaps.shape, bool)
            for i in range(len(node.points)):
                alive &= (node.high[i] >= nearest_row[:, i, None]) & (node.low[i] <= farthest_row[:, i, None])
            for j, child in enumerate(node.children):
                kept = at[alive[:, j]]
                if child >= 0 and len(kept):
                    todo.append((child, kept))
                elif len(kept):
                    found_query.append(kept)
                    found_leaf.append(np.full(len(kept), -1 - child, np.int32))
        if not found_query:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        return np.concatenate(found_query), np.concatenate(found_leaf)
