"""Spanning trees of anchors, whose edges bound inner products with any candidate."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from grantflow.llm.vectors import EXACT, products, span


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): the rows from the root outward, and each row's parent (-1: the
    root) and distance to it, of a least spanning tree."""
    at, n = points.astype(np.float64), len(points)
    order, parent, edge = np.zeros(n, np.int64), np.full(n, -1), np.zeros(n)
    near, via, free = np.full(n, np.inf), np.full(n, -1), np.ones(n, bool)
    node = 0
    for k in range(n):
        order[k], free[node], parent[node] = node, False, via[node]
        edge[node] = near[node] if k else 0.0
        apart = np.sqrt(((at - at[node]) ** 2).sum(1))
        closer = free & (apart < near)
        near[closer], via[closer] = apart[closer], node
        node = int(np.where(free, near, np.inf).argmin())
    return order, parent, edge


class Scores:
    """Inner products of one chunk of candidates with the anchors of a tree.

    At the root all are exact.  A score at an anchor lies within that at its parent plus
    or minus edge times the candidate's norm, and within the product of both norms.
    Only candidates that a caller asks for, by these bounds, are scored exactly.
    """

    def __init__(self, anchors: np.ndarray, tree: tuple[np.ndarray, np.ndarray, np.ndarray], points: np.ndarray):
        self.anchors, self.tree, self.points = anchors, tree, points
        self.norms = np.sqrt((points.astype(np.float64) ** 2).sum(1))
        self.own = np.sqrt((anchors.astype(np.float64) ** 2).sum(1))
        self.as_float = points.astype(np.float64) if span(points, anchors) < EXACT else None
        self.scored = 0

    def exact(self, anchor: int, which: np.ndarray) -> np.ndarray:
        self.scored += len(which)
        if self.as_float is not None:
            return (self.as_float[which] @ self.anchors[anchor].astype(np.float64)).astype(np.int64)
        return products(self.points[which], self.anchors[anchor : anchor + 1])[:, 0]

    def walk(self, wanted: Callable[[int, np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, candidates, scores), parents first; ``wanted(anchor, low, high)`` marks the
        candidates to score, given bounds of their scores."""
        low, high = (np.zeros((len(self.anchors), len(self.points))) for _ in range(2))
        order, parent, edge = self.tree
        for anchor in order.tolist():
            up, most = parent[anchor], self.own[anchor] * self.norms
            if up < 0:
                low[anchor], high[anchor] = -most, most
                asked = np.arange(len(self.points))
                wished = wanted(anchor, low[anchor], high[anchor])
            else:
                reach = edge[anchor] * self.norms
                slack = 1e-9 * (np.maximum(np.abs(low[up]), np.abs(high[up])) + reach + most) + 1e-6
                np.maximum(low[up] - reach - slack, -most - slack, out=low[anchor])
                np.minimum(high[up] + reach + slack, most + slack, out=high[anchor])
                wished = wanted(anchor, low[anchor], high[anchor])
                asked = np.flatnonzero(wished)
            found = self.exact(anchor, asked)
            low[anchor, asked] = high[anchor, asked] = found
            stay = wished[asked]
            yield anchor, asked[stay], found[stay]
