"""Byte-level BPE by rounds over padded matrices.

Every distinct piece of text is one row of token ids, padded and bucketed by
length.  Each round looks up all neighbouring pairs in a hashed pair table, lets
every row merge its leftmost pair of least rank, and closes the gap.  Rows
without a mergeable pair leave the matrix.  No pass needs a shuffle, and a lost
task is simply run again.

Null and empty texts have no tokens.  Columns named like the new ones are
replaced; repeated rows are encoded alike.  Pieces of more than ``LONG`` bytes,
where a full row per merge would be quadratic, take the same merges from a heap.
"""

from __future__ import annotations

import base64
import hashlib
import heapq

import numpy as np
from pyspark.sql import DataFrame

from grantflow.llm.pretokens import cutter
from grantflow.llm.texts import add_text_columns

MISS = np.int32(2**31 - 1)
LONG = 512
# Bytes of the matrices of one bucket, and pieces remembered by a worker.
MATRIX_CELLS = 1 << 20
REMEMBERED = 300_000


class PairTable:
    """Open-addressing hash table from a pair of ids to the id of their merge."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(4, int(4 * len(merged)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, MISS, np.int32)
        keys, at = self._key(left, right), None
        at = self._slot(keys)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == -1
            # of several keys that want one free slot the last writer stays
            self.keys[at[todo[free]]] = keys[todo[free]]
            won = self.keys[at[todo]] == keys[todo]
            self.values[at[todo[won]]] = merged[todo[won]]
            todo = todo[~won]
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    @staticmethod
    def _key(left, right):
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys):
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids of the pairs, MISS where they don't merge."""
        keys = self._key(left, right)
        at = self._slot(keys)
        found = self.keys[at]
        out = np.where(found == keys, self.values[at], MISS)
        todo = np.flatnonzero((found != keys) & (found != -1))
        while len(todo):
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)
            found = self.keys[at[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[at[todo[hit]]]
            todo = todo[~hit & (found != -1)]
        return out


class Codec:
    """Encoder and decoder for one vocabulary of byte strings and their ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.cut = ranks, cutter(pattern)
        self.one = np.full(256, MISS, np.int32)
        size = max(ranks.values()) + 1
        lengths = np.zeros(size, np.int64)
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            lengths[rank] = len(token)
            if len(token) == 1:
                self.one[token[0]] = rank
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), merged.append(rank)
        if (self.one == MISS).any():
            raise ValueError("the vocabulary lacks some single bytes")
        self.pairs = PairTable(np.array(left, np.int32), np.array(right, np.int32), np.array(merged, np.int32))
        self.lengths, self.starts = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        flat = np.zeros(int(lengths.sum()), np.uint8)
        for token, rank in ranks.items():
            flat[self.starts[rank] : self.starts[rank] + len(token)] = np.frombuffer(token, np.uint8)
        self.flat, self.known = flat, {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.cut(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [p for p in set().union(*cut) if p not in self.known]
        self.known.update(zip(new, self.encode_pieces([p.encode() for p in new]), strict=True))
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in cut]

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                out[i] = self._merge_long(piece)
            elif piece:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for bits, rows in buckets.items():
            step = max(1, MATRIX_CELLS >> bits)
            for k in range(0, len(rows), step):
                self._merge_rows(pieces, rows[k : k + step], 1 << bits, out)
        return out

    def _merge_rows(self, pieces: list[bytes], rows: list[int], width: int, out: list[bytes]) -> None:
        size = np.array([len(pieces[i]) for i in rows])
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(-1, width)
        columns = np.arange(width)
        ids = np.where(columns < size[:, None], self.one[raw], -1)
        gain = np.full((len(rows), width), MISS, np.int32)  # the last column stays empty
        pair = columns[:-1] < size[:, None] - 1
        gain[:, :-1][pair] = self.pairs.find(ids[:, :-1][pair], ids[:, 1:][pair])
        place = np.array(rows)
        while len(place):
            at = gain.argmin(1)  # the leftmost of equal ranks
            best = gain[np.arange(len(at)), at]
            live = best < MISS
            if not live.all():
                for i, row, n in zip(place[~live], ids[~live].astype("<u4"), size[~live], strict=True):
                    out[i] = row[:n].tobytes()
                place, ids, gain, size, at, best = (x[live] for x in (place, ids, gain, size, at, best))
                if not len(place):
                    return
            # merge in place, then close the gap behind it
            line = np.arange(len(at))
            ids[line, at] = best
            shift = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, shift, 1)
            gain = np.take_along_axis(gain, shift, 1)
            size = size - 1
            past = columns >= size[:, None]
            ids[past] = -1
            gain[columns >= size[:, None] - 1] = MISS
            for first in (at - 1, at):
                ok = (first >= 0) & (first < size - 1)
                r, c = line[ok], first[ok]
                gain[r, c] = self.pairs.find(ids[r, c], ids[r, c + 1])

    def _merge_long(self, piece: bytes) -> bytes:
        ids = self.one[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self.pairs.find(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        seen: dict[tuple[int, int], int] = dict(zip(zip(ids, ids[1:]), first))
        heap = [(rank, i, ids[i], ids[i + 1]) for i, rank in enumerate(first) if rank != MISS]
        heapq.heapify(heap)

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                pair = (ids[i], ids[after[i]])
                if pair not in seen:
                    seen[pair] = int(self.pairs.find(np.array(pair[:1]), np.array(pair[1:]))[0])
                if seen[pair] != MISS:
                    heapq.heappush(heap, (seen[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        """Bytes that the ids (as ``encode`` gives them) stand for."""
        tokens = np.frombuffer(ids, "<u4")
        if not len(tokens):
            return b""
        n = self.lengths[tokens]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.starts[tokens] - ends + n, n) + np.arange(ends[-1])].tobytes()


def read_ranks(path: str) -> bytes:
    """The rank file, to be sent to the tasks (about 1 MB, whatever the corpus)."""
    with open(path, "rb") as file:
        return file.read()


_codecs: dict[tuple[str, str], Codec] = {}


def codec(file: bytes, pattern: str) -> Codec:
    """The codec of a rank file; a worker builds it once."""
    key = (hashlib.sha256(file).hexdigest(), pattern)
    if key not in _codecs:
        lines = (line.split() for line in file.splitlines() if line.strip())
        _codecs[key] = Codec({base64.b64decode(token): int(rank) for token, rank in lines}, pattern)
    return _codecs[key]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep=None) -> DataFrame:
    """Add ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)."""
    sent = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def prepare():
        own = codec(sent.value, pattern)

        def make(texts: list[str]):
            ids = own.encode(texts)
            return [len(x) // 4 for x in ids], ids

        return make

    return add_text_columns(df, text, {"n_tokens": "bigint", "ids": "binary"}, prepare, keep)


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary): the bytes that the ids stand for; null ids stand for none."""
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    sent = df.sparkSession.sparkContext.broadcast(read_ranks(path))
    kept = [c for c in df.columns if c != "decoded"]
    schema = T.StructType([df.schema[c] for c in kept]).add("decoded", T.BinaryType())
    names, at = [f.name for f in schema], kept.index(ids)

    def run(batches):
        own = codec(sent.value, pattern)
        for batch in batches:
            made = pa.array([own.decode(x.as_py() or b"") for x in batch.column(at)], type=pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, made], names=names)

    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def round_trip(
    df: DataFrame, path: str, pattern: str, text: str = "text", keep=None, with_ids: bool = False
) -> DataFrame:
    """Encode and decode in one pass; add ``n_tokens``, the digests of ids and bytes, and ``ids`` if asked for."""
    sent = df.sparkSession.sparkContext.broadcast(read_ranks(path))

    def prepare():
        own = codec(sent.value, pattern)

        def make(texts: list[str]):
            ids = own.encode(texts)
            made = [
                [len(x) // 4 for x in ids],
                [hashlib.sha256(x).hexdigest() for x in ids],
                [hashlib.sha256(own.decode(x)).hexdigest() for x in ids],
            ]
            return [*made, ids] if with_ids else made

        return make

    fields = {"n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"}
    fields |= {"ids": "binary"} if with_ids else {}
    return add_text_columns(df, text, fields, prepare, keep)
