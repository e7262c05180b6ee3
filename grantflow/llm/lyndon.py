"""Lyndon arrays by the first phase of Baier's suffix sorter, and the runs they yield.

A run is a stretch that repeats its first ``period`` letters (the smallest such
number) at least twice and that no neighbour extends.  Each run holds a Lyndon root:
a place whose longest Lyndon word, under one of the two orders of the letters, is as
long as the period.  So the Lyndon arrays of both orders propose all runs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from grantflow.llm.bytehash import mixed, powers


def lyndon_array(letters: Sequence[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place.

    Suffixes begin in groups of equal first letter, which are taken from the greatest
    down.  A group that is taken closes its suffixes; each of them then belongs to the
    nearest open place before it.  An open place to which ``n`` of them belong starts
    with the word of its own group and ``n`` times that of the closed group: it moves
    to a new group right above its own, the larger ``n`` higher.  What a group's word
    is when it is taken is the longest Lyndon word of its suffixes.
    """
    n, first = len(letters), {}
    for i, letter in enumerate(letters):
        first.setdefault(letter, []).append(i)
    members = [first[letter] for letter in sorted(first)]
    group, found = [0] * n, [0] * n
    for g, own in enumerate(members):
        for i in own:
            group[i] = g
    size, below, above = [1] * len(members), list(range(-1, len(members) - 1)), list(range(1, len(members) + 1))
    near = list(range(n + 1))  # place i is i + 1 here, points to itself while open; 0 is before the first
    g = len(members) - 1
    while g >= 0:
        own, long = [i for i in members[g] if group[i] == g], size[g]
        members[g] = ()
        for i in own:
            found[i], near[i + 1] = long, i
        met: dict[int, int] = {}
        for i in own:
            while near[i] != i:
                near[i] = i = near[near[i]]
            if i:
                met[i - 1] = met.get(i - 1, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for i, times in met.items():
            moved.setdefault((times, group[i]), []).append(i)
        for times, low in sorted(moved, reverse=True):
            new, own = len(members), moved[times, low]
            members.append(own)
            size.append(size[low] + times * long)
            below.append(low)
            above.append(above[low])
            below[above[low]], above[low] = new, new
            for i in own:
                group[i] = new
        g = below[g]
    return found


class Extensions:
    """Longest common extensions in one array of letters, by prefix hashes and binary search."""

    def __init__(self, letters: np.ndarray):
        up, self.down = powers(len(letters) + 1)
        self.sums = np.zeros(len(letters) + 1, np.uint64)
        np.cumsum(mixed(letters + 1) * up[:-1], out=self.sums[1:])

    def _alike(self, x: np.ndarray, y: np.ndarray, size: np.ndarray) -> np.ndarray:
        left = (self.sums[x + size] - self.sums[x]) * self.down[x]
        return left == (self.sums[y + size] - self.sums[y]) * self.down[y]

    def common(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """How far the letters from (or, ``back``, before) ``x`` and ``y`` agree, up to ``most``."""
        found = np.zeros(len(x), np.int64)
        step = 1 << int(most.max(initial=0)).bit_length()
        while step:
            longer = np.minimum(found + step, most)
            same = self._alike(x - longer, y - longer, longer) if back else self._alike(x, y, longer)
            found, step = np.where(same, longer, found), step >> 1
        return found


def _plain(letters: np.ndarray, first: int, end: int, at: int, period: int) -> tuple[int, int]:
    """The stretch around ``at`` that keeps a period, letter by letter."""
    a, b = at, at + period
    while b < end and letters[b] == letters[b - period]:
        b += 1
    while a > first and letters[a - 1] == letters[a - 1 + period]:
        a -= 1
    return a, b


def runs(letters: np.ndarray, segments: Sequence[tuple[int, int]], times: int = 2, least: int = 2) -> np.ndarray:
    """Rows (start, end, period) of the runs in segments of ``letters`` that are at least
    ``times`` (2 or more) periods and ``least`` letters long, by start, then period.

    Hashes find the extensions; each stretch is then compared letter by letter, and
    found anew that way should two hashes have collided.
    """
    at, long, low, high = [], [], [], []
    for a, b in segments:
        for own in (letters[a:b], -letters[a:b]):
            word = np.array(lyndon_array(own.tolist()), np.int64)
            # the leftmost root of such a run has times - 1 periods from its start on
            root = np.flatnonzero(np.arange(b - a) + (times - 1) * word <= b - a)
            again = root + word[root] if times > 2 else root
            root = root[own[root] == own[again]]
            at.append(root + a)
            long.append(word[root])
            low.append(np.full(len(root), a))
            high.append(np.full(len(root), b))
    if not at:
        return np.zeros((0, 3), np.int64)
    at, long, low, high = (np.concatenate(x) for x in (at, long, low, high))
    lce = Extensions(letters)
    start = at - lce.common(at, at + long, at - low, back=True)
    end = at + long + lce.common(at, at + long, high - at - long)
    kept = end - start >= np.maximum(times * long, least)
    found = np.unique(np.stack([start, end, long], 1)[kept], axis=0)
    bounds = dict(zip(zip(start.tolist(), end.tolist(), long.tolist(), strict=True), zip(at, low, high, strict=True), strict=True))
    for row in found:
        a, b, p = row.tolist()
        if not np.array_equal(letters[a : b - p], letters[a + p : b]):
            root, first, last = bounds[a, b, p]
            row[:2] = _plain(letters, first, last, root, p)
    found = found[found[:, 1] - found[:, 0] >= np.maximum(times * found[:, 2], least)]
    return np.unique(found, axis=0) if len(found) else found
