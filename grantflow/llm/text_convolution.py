"""A small convolutional text classifier in numpy.

A word is the sum of two hashed rows of an embedding table, one for the whole word and
one for how it begins; filters of several widths slide over a text and each reports its
largest value; a logistic unit weighs these.  A text of any length is read whole, in
pieces.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np

BUCKETS = 1 << 20
DEPTH, FILTERS, WIDTHS = 8, 8, (1, 2, 3)
BEGINNING = 4  # characters
# What comes in a smaller share of the training texts, or in fewer than three, has no row of its own.
LEAST_SHARE = 1 / 500
STEPS, BATCH, RATE = 1200, 32, 0.2
PIECE = 1 << 13  # places that one matrix product covers
LEARNED_PIECE = 1 << 19  # the same in a step of the fit: most batches as a whole
WORD = re.compile(r"\w+")


class _Buckets(dict):
    def __missing__(self, word: str) -> int:
        whole, begun = (zlib.crc32(x.encode()) % BUCKETS for x in (word, f"{word[:BEGINNING]}-"))
        self[word] = both = whole * BUCKETS + begun
        return both


def hashed_words(texts: list[str]) -> list[list[int]]:
    """For each word of each text, lower-cased: the bucket of the word, times ``BUCKETS``,
    plus that of its beginning."""
    known = _Buckets()
    return [list(map(known.__getitem__, WORD.findall(text.lower()))) for text in texts]


@dataclass
class Model:
    """``rows``: trained buckets, ascending; ``table``: a zero row, then one for each of them.
    ``filters[k]``: width, depth, filter; ``shift``: one for each filter; ``weights``, ``base``."""

    rows: np.ndarray
    table: np.ndarray
    filters: list[np.ndarray]
    shift: np.ndarray
    weights: np.ndarray
    base: float
    _at: np.ndarray | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_at": None}  # each process makes its own

    def places(self, words: np.ndarray) -> np.ndarray:
        """Two table rows for each hashed word; 0 where a bucket has none."""
        if self._at is None:
            self._at = np.zeros(BUCKETS, np.int32)
            self._at[self.rows] = np.arange(1, len(self.rows) + 1)
        return self._at[np.stack([words // BUCKETS, words % BUCKETS], 1)]

    def responses(self, places: np.ndarray) -> np.ndarray:
        """What each filter (first axis) says at each place; the last ``max(WIDTHS) - 1``
        places only serve the ones before."""
        x, n = self.table[places[:, 0]] + self.table[places[:, 1]], len(places) - max(WIDTHS) + 1
        every = np.concatenate([f[o] for f in self.filters for o in range(len(f))], 1).T @ x.T
        said, at = np.repeat(self.shift[:, None], n, 1), 0
        for k, f in enumerate(self.filters):
            for o in range(len(f)):
                said[k * FILTERS : (k + 1) * FILTERS] += every[at : at + FILTERS, o : o + n]
                at += FILTERS
        return said

    def features(self, places: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """The largest response of each filter in each text; places of owner -1 belong to none."""
        best = np.zeros((texts, len(self.weights)), np.float32)
        reach = max(WIDTHS) - 1
        for a in range(0, len(places) - reach, PIECE):
            said, own = self.responses(places[a : a + PIECE + reach]), owner[a : a + PIECE][: len(places) - reach - a]
            first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            most, who = np.maximum.reduceat(said, first, 1).T, own[first]
            best[who[who >= 0]] = np.maximum(best[who[who >= 0]], most[who >= 0])
        return best

    def scores(self, words: list) -> np.ndarray:
        """Probability of label 1 of each list of hashed words."""
        places, owner = laid_out([self.places(np.asarray(w, np.int64)) for w in words])
        margin = self.features(places, owner, len(words)) @ self.weights + self.base
        return 1 / (1 + np.exp(-np.clip(margin.astype(np.float64), -50, 50)))


def laid_out(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, with zero rows between them, and the text of each place; a
    text without words owns one zero row."""
    gap = max(WIDTHS) - 1
    sizes = np.array([max(1, len(t)) for t in texts], np.int64)
    starts = np.cumsum(sizes + gap) - sizes - gap
    places, owner = np.zeros((int((sizes + gap).sum()), 2), np.int64), np.full(int((sizes + gap).sum()), -1)
    for k, (text, a) in enumerate(zip(texts, starts.tolist(), strict=True)):
        places[a : a + len(text)] = text
        owner[a : a + sizes[k]] = k
    return places, owner


def _adagrad(value: np.ndarray, gradient: np.ndarray, seen: np.ndarray, at=slice(None)) -> None:
    seen[at] += gradient**2
    value[at] -= RATE * gradient / np.sqrt(seen[at] + 1e-8)


@dataclass
class Learning:
    """A model on its way: ``seen`` has the summed squares of the gradients of ``parts``."""

    model: Model
    seen: list[np.ndarray]

    @property
    def parts(self) -> list[np.ndarray]:
        m = self.model
        return [m.table, *m.filters, m.shift, m.weights, np.array([m.base], np.float32)]

    def numbers(self) -> np.ndarray:
        """All that is learned, in one array of float32."""
        return np.concatenate([x.ravel() for x in (*self.parts, *self.seen)])

    def put(self, numbers: np.ndarray) -> None:
        """Go on from what :meth:`numbers` told, of this model or the mean of several."""
        at, taken = 0, []
        for x in (*self.parts, *self.seen):
            taken.append(numbers[at : at + x.size].reshape(x.shape).astype(np.float32))
            at += x.size
        own, m, n = taken[: len(self.seen)], self.model, len(WIDTHS)
        m.table, m.filters, m.shift, m.weights, m.base = own[0], own[1 : 1 + n], own[-3], own[-2], float(own[-1][0])
        self.seen = taken[len(self.seen) :]


def buckets_of(words: np.ndarray) -> np.ndarray:
    """The distinct buckets of a hashed text."""
    return np.unique([words // BUCKETS, words % BUCKETS])


def least_texts(texts: int) -> float:
    """In how many of the training texts a bucket must come to have a row."""
    return max(3, texts * LEAST_SHARE)


def begin(rows: np.ndarray, texts: int, ones: float, seed: int = 7) -> tuple[Learning, np.random.Generator]:
    """A model before the first step for ``texts`` training texts, ``ones`` of label 1; equal input gives an equal one."""
    rng, width = np.random.default_rng(seed), len(WIDTHS) * FILTERS
    table = rng.normal(0, 0.1, (len(rows) + 1, DEPTH)).astype(np.float32)
    table[0] = 0
    filters = [rng.normal(0, 0.3, (w, DEPTH, FILTERS)).astype(np.float32) for w in WIDTHS]
    share = float(np.clip(ones / texts if texts else 0.5, 1e-3, 1 - 1e-3))
    model = Model(rows, table, filters, np.zeros(width, np.float32), rng.normal(0, 0.3, width).astype(np.float32), float(np.log(share / (1 - share))))
    if not 0 < ones < texts:
        model.weights[:] = 0
    made = Learning(model, [])
    made.seen = [np.full_like(x, 1e-3) for x in made.parts]
    return made, rng


def _peaks(model: Model, places: np.ndarray, owner: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each text and filter the place of its largest response, and that response."""
    reach, width = max(WIDTHS) - 1, len(model.weights)
    peak, most = np.zeros((texts, width), np.int64), np.full((texts, width), -np.inf, np.float32)
    for a in range(0, len(places) - reach, LEARNED_PIECE):
        said = model.responses(places[a : a + LEARNED_PIECE + reach])
        own = owner[a : a + said.shape[1]]
        starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(own)], strict=True):
            k = own[s]
            if k >= 0:
                best = said[:, s:e].argmax(1)
                value = said[np.arange(width), s + best]
                larger = value > most[k]
                peak[k, larger], most[k, larger] = a + s + best[larger], value[larger]
    return peak, most


def learn(made: Learning, texts: list[np.ndarray], labels: np.ndarray, rng: np.random.Generator, many: int = STEPS) -> Learning:
    """``many`` further steps on hashed texts."""
    model, seen = made.model, made.seen
    own, (table, *filters, _, _, base) = [model.places(t) for t in texts], made.parts
    order = np.zeros(0, np.int64)
    for _ in range(many):
        if len(order) < BATCH:
            order = np.append(order, rng.permutation(len(texts)))
        some, order = order[:BATCH], order[BATCH:]
        places, owner = laid_out([own[k] for k in some])
        peak, most = _peaks(model, places, owner, len(some))
        pooled = np.maximum(most, 0)
        error = (1 / (1 + np.exp(-(pooled @ model.weights + base[0]))) - labels[some]).astype(np.float32) / len(some)
        back = error[:, None] * model.weights * (most > 0)
        steps, touched = [], []
        for k, f in enumerate(filters):
            cols = slice(k * FILTERS, (k + 1) * FILTERS)
            gradient, part = np.zeros_like(f), back[:, cols]
            for o in range(len(f)):
                row = places[peak[:, cols] + o]
                gradient[o] = np.einsum("nf,nfd->df", part, table[row].sum(2))
                change = (part[:, :, None] * f[o].T).reshape(-1, DEPTH)
                touched += [(row[:, :, half].ravel(), change) for half in (0, 1)]
            steps.append(gradient)
        row, change = np.concatenate([t[0] for t in touched]), np.concatenate([t[1] for t in touched])
        used, slot = np.unique(row, return_inverse=True)
        summed = np.zeros((len(used), DEPTH), np.float32)
        np.add.at(summed, slot, change)
        summed[used == 0] = 0
        _adagrad(table, summed, seen[0], used)
        for f, gradient, kept in zip(filters, steps, seen[1:], strict=False):
            _adagrad(f, gradient, kept)
        _adagrad(model.shift, back.sum(0), seen[-3])
        _adagrad(model.weights, error @ pooled, seen[-2])
        _adagrad(base, error.sum(keepdims=True), seen[-1])
    model.base = float(base[0])
    return made


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """Fit to hashed texts; equal input gives an equal model."""
    rows, many = np.unique(np.concatenate([buckets_of(t) for t in texts]), return_counts=True) if texts else (np.zeros(0, np.int64), np.zeros(0))
    made, rng = begin(rows[many >= least_texts(len(texts))].astype(np.int64), len(texts), float(labels.sum()), seed)
    return learn(made, texts, labels, rng).model if 0 < labels.sum() < len(labels) else made.model
