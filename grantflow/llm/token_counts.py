"""Exact token counts at every prefix, by dynamic programming.

A sequence of tokens is the BPE encoding of its text exactly when each two
neighbours are the encoding of theirs.  So the last token of the encoding of a
prefix is the one token that ends there and fits behind the last token of the
shorter prefix, and the count is one more than there.  One pass over a piece
gives the counts at all its prefixes; a text's counts are those of its pieces in
a row.  What is stored is the step from each prefix to the next, one signed byte
per byte of text: cutting a text to a token budget or asking for the cost of any
prefix needs no encoding again.

Two rules of the cutting into pieces look ahead, so a prefix that ends inside
such a place is cut differently from the whole text: blanks in front of a word,
and contractions; likewise the inside of a special token.  Those places get the
counts of the prefix as it would be cut itself.

Null and empty texts count 0 bytes and 0 tokens.  Columns named like the new
ones are replaced; repeated rows are counted alike.  Prefixes are counted in
bytes; counts are those of the library where the prefix ends between characters.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.llm.pretokens import cutter
from grantflow.llm.texts import add_text_columns

REMEMBERED = 1_000_000
CONTRACTED = ("'re", "'ve", "'ll")


def byte_characters() -> dict[str, int]:
    """Characters that stand for the 256 bytes in vocabulary files: visible
    Latin-1 ones for themselves, the others from U+0100 on in order."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(others)}


class PrefixCounter:
    """Counts for one vocabulary with merges and special tokens."""

    def __init__(self, vocabulary: dict, pattern: str):
        model, letters = vocabulary["model"], byte_characters()
        if model["type"] != "BPE" or vocabulary.get("normalizer") or vocabulary["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("byte-level BPE without normaliser or prefix space is asked for")
        raw = lambda token: bytes(letters[c] for c in token)
        special = {t["content"] for t in vocabulary.get("added_tokens", ())}
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.ids = {raw(t): i for t, i in model["vocab"].items() if t not in special}
        self.tokens = {i: t for t, i in self.ids.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.merges = {(raw(a), raw(b)): rank for rank, (a, b) in enumerate(pairs)}
        self.longest = max(map(len, self.tokens.values()))
        self.cut, self.fits, self.known = cutter(pattern), {}, {}

    def _merged(self, text: bytes) -> list[bytes]:
        parts = [text[i : i + 1] for i in range(len(text))]
        while len(parts) > 1:
            ranks = [self.merges.get(p, len(self.merges)) for p in zip(parts, parts[1:])]
            at = min(range(len(ranks)), key=ranks.__getitem__)
            if ranks[at] == len(self.merges):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, before: int, token: int) -> bool:
        """Whether the two tokens are the encoding of their bytes; -1: nothing before."""
        asked = [self.tokens[i] for i in (before, token) if i >= 0]
        return self._merged(b"".join(asked)) == asked

    def counts(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of a piece, from the empty one on."""
        ids, fits, longest, n = self.ids, self.fits, self.longest, len(piece)
        last, count = [-1] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                token = ids.get(piece[start:end])
                if token is None:
                    continue
                key = (last[start] << 20) + token
                ok = fits.get(key)
                if ok is None:
                    ok = fits[key] = self._fit(last[start], token)
                if ok:
                    last[end], count[end] = token, count[start] + 1
                    break
            else:
                raise ValueError("the vocabulary lacks some single bytes")
        return count

    def steps(self, pieces: set[str]) -> None:
        """Remember the steps between the counts of new pieces."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        if len(self.fits) > REMEMBERED:
            self.fits.clear()
        for piece in pieces:
            if piece not in self.known:
                count = np.diff(self.counts(piece.encode()))
                if len(count) and np.abs(count).max() > 127:
                    raise ValueError("a step of more than 127 tokens")
                self.known[piece] = count.astype(np.int8).tobytes()

    def prefix_steps(self, texts: list[str]) -> list[bytes]:
        """For each text one signed byte per byte: the change of the count there."""
        parts = [self._between_specials(t) for t in texts]
        cut = [[self.cut(segment) for segment, _ in own] for own in parts]
        self.steps({piece for own in cut for pieces in own for piece in pieces})
        out = []
        for own, pieces in zip(parts, cut, strict=True):
            if len(own) == 1:
                out.append(self._segment(own[0][0], pieces[0]))
            else:
                out.append(b"".join(self._segment(s, p) + self._special(p, t) for (s, t), p in zip(own, pieces, strict=True)))
        return out

    def _between_specials(self, text: str) -> list[tuple[str, str]]:
        """(text, special token behind it or nothing) in order."""
        if not self.special or not self.special.search(text):
            return [(text, "")]
        found, at = [], 0
        for m in self.special.finditer(text):
            found.append((text[at : m.start()], m.group()))
            at = m.end()
        return [*found, (text[at:], "")]

    def _segment(self, text: str, pieces: list[str]) -> bytes:
        steps = b"".join(map(self.known.__getitem__, pieces))
        if "'" not in text and not re.search(r"\s\s", text):
            return steps
        own, at = np.frombuffer(steps, np.int8).astype(np.int64), 0
        for piece, following in zip(pieces, [*pieces[1:], ""]):
            size = len(piece.encode())
            if piece in CONTRACTED:  # cut short, it is a mark and a letter
                self._put(own, at, [0, 1, 2, int(own[at : at + size].sum())])
            elif piece.isspace() and following:  # up to the word, the blanks are one piece
                blank = re.match(r"\s", following)
                run = piece + (blank.group() if blank else "")
                if len(run) > len(piece):
                    reach = len(run.encode())
                    counts = self.counts(run.encode())
                    behind = own[at : at + reach + 1].sum()
                    self._put(own, at, [*counts, int(behind)] if at + reach < len(own) else counts)
            at += size
        if np.abs(own).max(initial=0) > 127:
            raise ValueError("a step of more than 127 tokens")
        return own.astype(np.int8).tobytes()

    @staticmethod
    def _put(steps: np.ndarray, at: int, counts: list[int]) -> None:
        steps[at : at + len(counts) - 1] = np.diff(counts)

    def _special(self, pieces: list[str], token: str) -> bytes:
        """Steps inside a special token: until its end it is ordinary text."""
        if not token:
            return b""
        tail = pieces[-1] if pieces else ""
        total = lambda text: sum(self.counts(p.encode())[-1] for p in self.cut(text))
        base, raw, counts = total(tail), token.encode(), [0]
        for k in range(1, len(raw)):
            counts.append(total(tail + raw[:k].decode(errors="ignore")) - base)
        return np.diff([*counts, 1]).astype(np.int8).tobytes()


_counters: dict[tuple[str, str], PrefixCounter] = {}


def counter(file: bytes, pattern: str) -> PrefixCounter:
    """The counter of a vocabulary file; a worker builds it once."""
    key = (hashlib.sha256(file).hexdigest(), pattern)
    if key not in _counters:
        _counters[key] = PrefixCounter(json.loads(file), pattern)
    return _counters[key]


def prefix_counts(df: DataFrame, path: str, pattern: str, text: str = "text", keep=None) -> DataFrame:
    """Add ``n_bytes``, ``n_tokens`` and ``prefix_steps`` (one signed byte per byte).

    The vocabulary file (a few MB, whatever the corpus) is sent to the tasks.
    """
    with open(path, "rb") as file:
        sent = df.sparkSession.sparkContext.broadcast(file.read())

    def prepare():
        own = counter(sent.value, pattern)

        def make(texts: list[str]):
            steps = own.prefix_steps(texts)
            return [len(x) for x in steps], [int(np.frombuffer(x, np.int8).sum()) for x in steps], steps

        return make

    fields = {"n_bytes": "bigint", "n_tokens": "bigint", "prefix_steps": "binary"}
    return add_text_columns(df, text, fields, prepare, keep)


def tokens_at(steps: bytes, n_bytes: int) -> int:
    """Tokens of the prefix of so many bytes."""
    return int(np.frombuffer(steps, np.int8)[:n_bytes].sum())


def longest_prefix(steps: bytes, text: bytes, budget: int) -> int:
    """Bytes of the longest prefix of whole characters with at most ``budget`` tokens."""
    counts = np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])
    between = np.append((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, True)
    return int(np.flatnonzero((counts <= budget) & between)[-1]) if budget >= 0 else 0


def truncate(df: DataFrame, budget: int, text: str = "text", steps: str = "prefix_steps") -> DataFrame:
    """Add ``truncated``: the longest prefix within the budget, from the stored counts."""
    kept = [c for c in df.columns if c != "truncated"]
    schema = T.StructType([df.schema[c] for c in kept]).add("truncated", T.StringType())
    names, t, s = [f.name for f in schema], kept.index(text), kept.index(steps)

    def run(batches):
        for batch in batches:
            cut = []
            for value, own in zip(batch.column(t), batch.column(s), strict=True):
                raw = (value.as_py() or "").encode()
                cut.append(raw[: longest_prefix(own.as_py() or b"", raw, budget)].decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cut, type=pa.string())], names=names)

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)
