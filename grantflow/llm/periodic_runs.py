"""Stretches of words that repeat themselves periodically, and texts without the repeats.

Words are runs of characters other than blanks (space and 09 to 0D).  A run is a
stretch of words with smallest period q, at least ``times`` periods and ``least``
words long, that no neighbouring word extends.  Each document is worked on alone, in
one pass without a shuffle: words become numbers, places whose three words come too
seldom to lie in a run are set aside, and the stretches that remain go through the
Lyndon arrays of both orders (see ``lyndon``).  Time and memory grow with the text.

Null and empty texts have no runs and collapse to the empty text.  Repeated rows are
treated alike; columns named like the new ones are replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from itertools import chain, compress, count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.llm.bytehash import mixed
from grantflow.llm.lyndon import runs
from grantflow.llm.texts import add_text_columns

WORD = r"[^\x20\x09-\x0D]+"
TIMES, LEAST = 4, 6


def frequent_stretches(letters: np.ndarray, ends: np.ndarray, times: int, least: int) -> list[tuple[int, int]]:
    """Stretches of places, inside the texts that end at ``ends``, outside of which no run lies.

    In a run of period 2 or more, ``times`` periods long, each three words in a row come
    ``times - 1`` times or more; with period 1 they come ``least - 2`` times.  Equal
    hashes of different words only add places.
    """
    seldom, short = min(times - 1, max(least, times) - 2), max(least, times) - 2
    text = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    if seldom < 2 or len(letters) < 3:
        return [(a, b) for a, b in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), strict=True) if b - a >= short + 2]
    x = mixed(letters)
    three = mixed(mixed(x[:-2] + mixed(text[:-2] + 1)) + mixed(x[1:-1])) + x[2:]
    _, which, many = np.unique(three, return_inverse=True, return_counts=True)
    often = (many[which] >= seldom) & (text[2:] == text[:-2])
    # a stretch ends where the next text begins
    cut = np.flatnonzero(np.diff(np.concatenate([[0], np.where(often, text[:-2] + 1, 0), [0]])))
    return [(a, b + 2) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True) if often[a] and b - a >= short]


def runs_of_texts(texts: list[str], times: int = TIMES, least: int = LEAST) -> list[tuple[list, list, list, str]]:
    """(starts, lengths, periods, collapsed text) of each text, by start, then period."""
    words = [re.findall(WORD, text) for text in texts]
    ends = np.cumsum([len(w) for w in words])
    number = defaultdict(count().__next__)
    letters = np.fromiter(map(number.__getitem__, chain.from_iterable(words)), np.int64, int(ends[-1]) if len(ends) else 0)
    found = runs(letters, frequent_stretches(letters, ends, times, least), times, least)
    owner = np.searchsorted(ends, found[:, 0], side="right")
    made = []
    for k, own in enumerate(words):
        mine = found[owner == k] - np.array([ends[k] - len(own), ends[k] - len(own), 0]) if (owner == k).any() else found[:0]
        stay = np.ones(len(own), bool)
        for a, b, p in mine.tolist():
            stay[a + p : b] = False
        text = " ".join(compress(own, stay.tolist()) if len(mine) else own)
        made.append((mine[:, 0].tolist(), (mine[:, 1] - mine[:, 0]).tolist(), mine[:, 2].tolist(), text))
    return made


def periodic_runs(df: DataFrame, text: str = "text", times: int = TIMES, least: int = LEAST, keep=None) -> DataFrame:
    """Add ``runs`` (array of start, length, period, in words) and ``collapsed``: the words
    that no run holds after its first period, joined by one space."""
    fields = {"_start": "array<bigint>", "_length": "array<bigint>", "_period": "array<bigint>", "collapsed": "string"}
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("runs", "collapsed")]
    inner = {f"_own_{i}": c for i, c in enumerate(kept)}
    source = df.select(*[F.col(f"`{c}`").alias(k) for k, c in inner.items()], F.col(f"`{text}`").alias("_text"))
    made = add_text_columns(source, "_text", fields, lambda: lambda texts: list(zip(*runs_of_texts(texts, times, least), strict=True)), list(inner))
    zipped = F.arrays_zip(F.col("_start").alias("start"), F.col("_length").alias("length"), F.col("_period").alias("period"))
    return made.select(*[F.col(k).alias(c) for k, c in inner.items()], zipped.alias("runs"), "collapsed")


def made_periodic(id: Column, text: Column) -> Column:
    """The text with a periodic end, for every tenth id by its hash: with h = crc32 of the
    decimal id and g = h div 10, words from a = g mod n on become those of
    a + (i - a) mod p, where p = 1 + (n - a) div (3 + g mod 8).  Others stay."""
    crc = F.crc32(id.cast("string"))
    g, words = F.floor(crc / 10), F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))

    def turned(own: Column) -> Column:
        n = F.size(own).cast("bigint")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.sequence(F.lit(0).cast("bigint"), n - a - 1)
        end = F.transform(tail, lambda i: F.element_at(own, (a + i % p + 1).cast("int")))
        return F.array_join(F.concat(F.slice(own, F.lit(1), a.cast("int")), end), " ")

    # one array, named once: the words are found a single time
    some = F.transform(F.array(words), lambda own: F.when(F.size(own) > 0, turned(own)))[0]
    return F.when(crc % 10 == 0, F.coalesce(some, text)).otherwise(text)
