"""Histogram gradient-boosted trees in numpy, flattened into arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """All trees in one set of arrays.  A leaf points to itself; ``roots`` has each
    tree's first node, so ``depth`` array steps carry every row through every tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of finite features."""
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -50, 50)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Upper edges of at most ``bins`` bins for each feature, at quantiles."""
    ranks = np.linspace(0, 1, bins + 1)[1:-1]
    return [np.unique(np.quantile(column, ranks, method="lower")) for column in x.T]


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.12, bins: int = 64,
    least: float = 2.0, shrink: float = 1.0,
) -> Forest:
    """Boost logistic loss.  ``least`` is the hessian a child needs, ``shrink`` the L2 weight of leaves."""
    mean = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    base, n, width = float(np.log(mean / (1 - mean))), len(y), x.shape[1]
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots, margin = [], np.full(n, base)
    edges = bin_edges(x, bins) if n else []
    binned = [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]
    for _ in range(trees if n and 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = p - y, p * (1 - p)
        roots.append(len(nodes))
        open_nodes, where = [len(nodes)], np.zeros(n, np.int64)
        nodes.append([0, 0, len(nodes), len(nodes), 0])
        for level in range(depth + 1):
            many = len(open_nodes)
            live = where >= 0
            g = np.bincount(where[live], gradient[live], many)
            h = np.bincount(where[live], hessian[live], many)
            gain = np.full(many, 1e-6)
            split: list[tuple[int, int] | None] = [None] * many
            for f in range(width if level < depth else 0):
                size = len(edges[f]) + 1
                cell = where[live] * size + binned[f][live]
                gl = np.bincount(cell, gradient[live], many * size).reshape(many, size).cumsum(1)[:, :-1]
                hl = np.bincount(cell, hessian[live], many * size).reshape(many, size).cumsum(1)[:, :-1]
                if not gl.shape[1]:
                    continue
                gr, hr = g[:, None] - gl, h[:, None] - hl
                better = gl**2 / (hl + shrink) + gr**2 / (hr + shrink) - (g**2 / (h + shrink))[:, None]
                better = np.where((hl >= least) & (hr >= least), better, -1)
                best = better.argmax(1)
                for k in np.flatnonzero(better[np.arange(many), best] > gain):
                    gain[k], split[k] = better[k, best[k]], (f, int(best[k]))
            going, following = np.full(n, -1), []
            for k, node in enumerate(open_nodes):
                mine = where == k
                if split[k] is None:
                    nodes[node][4] = -rate * g[k] / (h[k] + shrink)
                    margin[mine] += nodes[node][4]
                    continue
                f, edge = split[k]
                low = binned[f] <= edge
                at = len(nodes)
                nodes += [[0, 0, at, at, 0], [0, 0, at + 1, at + 1, 0]]
                nodes[node][:4] = [f, edges[f][edge], at, at + 1]
                going[mine & low], going[mine & ~low] = len(following), len(following) + 1
                following += [at, at + 1]
            if not following:
                break
            open_nodes, where = following, going
    table = np.array(nodes or [[0, 0, 0, 0, 0]], float).T
    whole = [table[i].astype(np.int64) for i in (0, 2, 3)]
    return Forest(whole[0], table[1], whole[1], whole[2], table[4], np.array(roots, np.int64), depth, base)
