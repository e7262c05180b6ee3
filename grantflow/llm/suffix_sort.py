"""Sort many suffixes at once."""

from __future__ import annotations

import numpy as np

from grantflow.llm.bytehash import PrefixHashes


def common_prefix(hashes: PrefixHashes, x: np.ndarray, y: np.ndarray, depth: int) -> np.ndarray:
    """Length of the common prefix of each pair of suffixes, at most ``depth``, by
    binary search over equal prefix hashes."""
    out = np.full(len(x), depth)
    differ = np.flatnonzero(hashes.ranges(x, depth) != hashes.ranges(y, depth))
    x, y = x[differ], y[differ]
    found = np.zeros(len(x), np.int64)
    step = 1 << (depth.bit_length() - 1)
    while step:
        longer = np.minimum(found + step, depth - 1)
        found = np.where(hashes.ranges(x, longer) == hashes.ranges(y, longer), longer, found)
        step >>= 1
    out[differ] = found
    return out


def sort_suffixes(data: np.ndarray, group: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the first ``depth`` bytes of suffixes inside each group, eight bytes at a time.

    Returns the order and the class of each place in it: equal suffixes of a group
    share a class.  In each round only places that are equal so far go on, those of all
    groups in the same step.  The bytes themselves are compared.
    """
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray(len(data) + 1, ">u8", padded.data, strides=(1,))  # the eight bytes from each place on
    order = np.argsort(group, kind="stable")
    own = group[order]
    head = np.append(True, own[1:] != own[:-1])[: len(own)]
    for at in range(0, depth, 8):
        tied = np.flatnonzero(~head | np.append(~head[1:], False)[: len(head)])
        if not len(tied):
            break
        block, mine = np.cumsum(head[tied]), order[tied]
        value = eight[start[mine] + at].astype(np.uint64) >> np.uint64(8 * max(0, at + 8 - depth))
        by = np.lexsort((value, block))
        order[tied], value = mine[by], value[by]
        head[tied[1:]] |= value[1:] != value[:-1]
    return order, np.cumsum(head) - 1
