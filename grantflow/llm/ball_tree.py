"""Ball trees over integer vectors, searched for the largest inner products."""

from __future__ import annotations

import heapq
from dataclasses import dataclass, fields

import numpy as np

from grantflow.llm.vectors import EXACT, span

LEAF = 128

@dataclass
class BallTree:
    """Points in leaf order; a node covers ``points[first:end]`` and has its ball
    (``center``, ``radius``) and least id.  Children of a leaf are -1."""

    ids: np.ndarray
    points: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    least: np.ndarray
    first: np.ndarray
    end: np.ndarray
    left: np.ndarray
    right: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF) -> BallTree:
        """Halve along the line between two far points until a node is small or one spot."""
        order, rows, todo = np.arange(len(ids)), [], [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            own = points[order[a:b]].astype(np.float64)
            center = own.mean(0)
            apart = np.sqrt(((own - center) ** 2).sum(1))
            node = len(rows)
            rows.append([center, apart.max(), ids[order[a:b]].min(), a, b, -1, -1])
            if parent >= 0:
                rows[parent][5 + side] = node
            if b - a > leaf and apart.max() > 0:
                one = own[apart.argmax()]
                two = own[((own - one) ** 2).sum(1).argmax()]
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own @ (two - one), middle)]
                todo += [(a + middle, b, node, 1), (a, a + middle, node, 0)]
        columns = [np.array(c) for c in zip(*rows, strict=True)]
        return cls(ids[order], points[order], *columns)

    def to_bytes(self) -> list[bytes]:
        kinds = ("<i8", "<i8", "<f8", "<f8", "<i8", "<i8", "<i8", "<i8", "<i8")
        return [np.ascontiguousarray(getattr(self, f.name)).astype(k).tobytes() for f, k in zip(fields(self), kinds, strict=True)]

    @classmethod
    def from_bytes(cls, parts: list[bytes]) -> BallTree:
        kinds = ("<i8", "<i8", "<f8", "<f8", "<i8", "<i8", "<i8", "<i8", "<i8")
        got = [np.frombuffer(p, k) for p, k in zip(parts, kinds, strict=True)]
        got[1], got[2] = got[1].reshape(len(got[0]), -1), got[2].reshape(len(got[3]), -1)
        return cls(*got)

    def search(self, own_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best ``k`` (scores, ids) of each query but its own id; missing scores are the least number.

        Nodes are taken by the largest upper bound of the inner product.  A node
        is passed over by every query whose kth score so far, or ``floor``, tops
        its bound; at a tie only smaller ids could still matter.
        """
        n, low, none = len(queries), np.iinfo(np.int64).min, np.iinfo(np.int64).max
        scores, ids = np.full((n, k), low), np.full((n, k), none)
        as_float = queries.astype(np.float64)
        norms = np.sqrt((as_float**2).sum(1))
        most = span(queries, self.points)  # whole numbers of any size
        if most >= 1 << 63:
            raise ValueError("components are too large for 64-bit inner products")
        exact = most < EXACT
        points = self.points.astype(np.float64) if exact else self.points
        asked = as_float if exact else queries

        def bounds(node: int, who: np.ndarray) -> np.ndarray:
            reach = as_float[who] @ self.center[node] + norms[who] * self.radius[node]
            return reach + 1e-9 * (np.abs(reach) + norms[who] * self.radius[node]) + 1e-6

        def useful(node: int, who: np.ndarray, bound: np.ndarray) -> np.ndarray:
            top, kth = np.floor(bound), scores[who, -1]  # scores are whole numbers
            return (top >= floor[who]) & ((top > kth) | (top == kth) & (self.least[node] < ids[who, -1]))

        everyone = np.arange(n)
        first = bounds(0, everyone)
        heap = [(-first.max(initial=0), 0, everyone, first)]
        while heap:
            _, node, who, bound = heapq.heappop(heap)
            stay = useful(node, who, bound)
            who = who[stay]
            if not len(who):
                continue
            if self.left[node] < 0:
                a, b = self.first[node], self.end[node]
                found = (asked[who] @ points[a:b].T).astype(np.int64)
                there = np.broadcast_to(self.ids[a:b], found.shape).copy()
                mine = there == own_ids[who][:, None]
                found[mine], there[mine] = low, none
                if b - a > 4 * k:  # only the best k and all that tie with the last of them
                    edge = np.partition(found, b - a - k, 1)[:, b - a - k, None]
                    found, there = np.where(found >= edge, found, low), np.where(found >= edge, there, none)
                found, there = np.hstack([scores[who], found]), np.hstack([ids[who], there])
                best = np.lexsort((there, ~found), 1)[:, :k]
                scores[who], ids[who] = np.take_along_axis(found, best, 1), np.take_along_axis(there, best, 1)
                continue
            for child in (self.left[node], self.right[node]):
                bound = bounds(child, who)
                heapq.heappush(heap, (-bound.max(), int(child), who, bound))
        return scores, ids
