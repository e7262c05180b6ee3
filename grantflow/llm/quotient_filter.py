"""Counting quotient filter: a compact, lossless multiset of fingerprints.

A fingerprint splits into a quotient (its slot) and a remainder (what is stored).
Remainders of one quotient lie in a sorted run; a run starts at its quotient or
right behind the run before.  Three bits a slot say which quotients occur, where
runs end, and which slots hold digits of a counter.  All steps are array
operations; filters merge by their sorted entries without loss.
"""

from __future__ import annotations

import struct

import numpy as np

HEAD = struct.Struct("<QQBBx")


class CountingQuotientFilter:
    """``width``-bit fingerprints, the upper ``quotient`` bits of which are slots."""

    def __init__(self, width: int, quotient: int, occupied, run_end, counter, slots):
        self.width, self.quotient = width, quotient
        self.occupied, self.run_end, self.counter, self.slots = occupied, run_end, counter, slots

    @classmethod
    def of(cls, fingerprints: np.ndarray, width: int) -> CountingQuotientFilter:
        return cls.of_counts(*np.unique(fingerprints.astype(np.uint64), return_counts=True), width)

    @classmethod
    def of_counts(cls, values: np.ndarray, counts: np.ndarray, width: int) -> CountingQuotientFilter:
        """From sorted distinct fingerprints and how often each occurs."""
        quotient = min(width - 1, max(1, int(len(values) * 4 // 3).bit_length()))
        rest = width - quotient
        home = (values >> np.uint64(rest)).astype(np.int64)
        extra, left = np.zeros(len(values), np.int64), counts.astype(np.uint64) - np.uint64(1)
        while left.any():  # digits of count - 1, each as wide as a remainder
            extra += left > 0
            left = left >> np.uint64(rest)
        before = np.cumsum(1 + extra) - (1 + extra)
        at = before + (np.maximum.accumulate(home - before) if len(home) else home)
        n = max(1 << quotient, int(at[-1] + 1 + extra[-1]) if len(at) else 0)
        slots, run_end, counter = np.zeros(n, np.uint64), np.zeros(n, bool), np.zeros(n, bool)
        slots[at] = values & np.uint64((1 << rest) - 1)
        left = counts.astype(np.uint64) - np.uint64(1)
        for k in range(1, int(extra.max(initial=0)) + 1):
            more = extra >= k
            slots[at[more] + k] = left[more] & np.uint64((1 << rest) - 1)
            counter[at[more] + k] = True
            left = left >> np.uint64(rest)
        last = np.append(home[1:] != home[:-1], True)[: len(home)]
        run_end[(at + extra)[last]] = True
        occupied = np.zeros(1 << quotient, bool)
        occupied[home] = True
        return cls(width, quotient, occupied, run_end, counter, slots)

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct fingerprints and their counts."""
        rest = self.width - self.quotient
        quotients, ends = np.flatnonzero(self.occupied), np.flatnonzero(self.run_end)
        starts = np.maximum(quotients, np.concatenate([[0], ends[:-1] + 1])) if len(ends) else ends
        size = ends - starts + 1
        used = np.repeat(starts - np.cumsum(size) + size, size) + np.arange(size.sum())
        home, digit = np.repeat(quotients, size), self.counter[used]
        entry = np.cumsum(~digit) - 1
        values = (home[~digit].astype(np.uint64) << np.uint64(rest)) | self.slots[used[~digit]]
        counts = np.ones(len(values), np.uint64)
        first = np.flatnonzero(~digit)
        place = np.arange(len(used)) - first[entry] - 1 if len(used) else used
        for k in range(int(place.max(initial=-1)) + 1):
            mine = digit & (place == k)
            counts[entry[mine]] += self.slots[used[mine]] << np.uint64(rest * k)
        return values, counts

    def to_bytes(self) -> bytes:
        nbytes = (self.width - self.quotient + 7) // 8
        bits = [np.packbits(x).tobytes() for x in (self.occupied, self.run_end, self.counter)]
        packed = self.slots.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :nbytes]
        return HEAD.pack(len(self.slots), len(self.occupied), self.width, self.quotient) + b"".join(bits) + packed.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> CountingQuotientFilter:
        n, m, width, quotient = HEAD.unpack_from(data)
        at, bits = HEAD.size, []
        for size in (m, n, n):
            raw = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
            bits.append(np.unpackbits(raw, count=size).astype(bool))
            at += len(raw)
        nbytes = (width - quotient + 7) // 8
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :nbytes] = np.frombuffer(data, np.uint8, n * nbytes, at).reshape(n, nbytes)
        return cls(width, quotient, *bits, wide.reshape(-1).view("<u8").astype(np.uint64))


def merge(filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
    """One filter with the counts of all; widths must be equal."""
    if len({f.width for f in filters}) != 1:
        raise ValueError("filters of different widths cannot be merged")
    values, counts = (np.concatenate(x) for x in zip(*[f.entries() for f in filters], strict=True))
    order = np.argsort(values, kind="stable")  # the parts are sorted runs
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    summed = np.add.reduceat(counts, first) if len(first) else counts
    return CountingQuotientFilter.of_counts(values[first], summed, filters[0].width)
