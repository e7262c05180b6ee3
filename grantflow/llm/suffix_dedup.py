"""Remove byte strings that also start in a document with a smaller id.

Texts are byte strings; every ``LENGTH`` bytes in a row are a window.  A window that
also occurs in a document of smaller id is marked, judged on the input, and every
byte under a marked window is removed.

Documents are dealt once, by a hash of id and text, into chunks of about
``CHUNK_BYTES``, written as a bucketed table that all further steps read without a
shuffle of texts.  Chunks and key ranges ("shelves") talk in packed messages:

1. Each window is anchored at the least of the hashes of its ``GRAM``-byte pieces.
   Equal windows have the same anchor at the same place.  A chunk sends each of its
   distinct anchors once, however often it occurs.
2. A shelf answers which of them occur in other chunks or twice in this one.
3. For these, a chunk sends the stretch of windows around the anchor, each distinct
   stretch once with its least id.  Anchors in ``HOT_CHUNKS`` chunks or more, as of a
   line in a third of all documents, are sent window by window, each under its own
   hash, so that they spread over the shelves.
4. A shelf gathers the stretches of an anchor.  Where they differ, it sorts their
   suffixes by their bytes (:mod:`.suffix_sort`) and takes the least id of equal ones.  It answers which windows have a smaller id
   elsewhere.
5. The chunk marks those windows, and those that repeat inside the chunk.

What a step has shuffled is let go once its result is written, so the disk holds the texts
and one step at a time.

Within a chunk a stretch is known by two 64-bit hashes, and so it is on a shelf where
all stretches of an anchor are equal: no bytes are compared there.  Null counts as the empty
text.  Texts shorter than a window keep all bytes.  Rows of equal id never match
each other; rows with a null id neither lose bytes nor match.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.llm.bytehash import PrefixHashes, mixed
from grantflow.llm.suffix_sort import sort_suffixes
from grantflow.session import free_shuffles, scratch_dir, settle

LENGTH, GRAM = 50, 20
CHUNK_BYTES, SLAB_BYTES = 8 << 20, 1 << 20
HOT_CHUNKS = 256
SORTED_AT_ONCE = 1 << 18
POSITION = np.uint64(0xFFFFFFFF)
CODEC = "zstd"


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def ranges_of(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many ranges in a row."""
    before = np.cumsum(size) - size
    return data[np.repeat(start - before, size) + np.arange(size.sum())]


class Slab:
    """Some documents in a row: their stretches of windows with one anchor, and the
    place of the anchor in the first window (``lead``)."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, ids: np.ndarray):
        self.data, self.bounds, self.ids = data, bounds, ids
        n = len(data) - LENGTH + 1
        self.hashes = PrefixHashes(data)
        self.start = self.many = self.doc = self.lead = np.zeros(0, np.int64)
        self.key = np.zeros(0, np.uint64)
        if n <= 0:
            return
        grams = mixed(self.hashes.all_of(GRAM))
        packed = (grams & ~POSITION) | np.arange(len(grams), dtype=np.uint64)
        least = least_of(packed, LENGTH - GRAM + 1)
        long = np.flatnonzero(np.diff(bounds) >= LENGTH)
        edge = np.zeros(n + 1, np.int8)
        edge[bounds[long]], edge[bounds[long + 1] - LENGTH + 1] = 1, -1
        new = np.cumsum(edge[:n], dtype=np.int8).view(bool)  # the windows inside a document
        new[1:] &= (least[1:] != least[:-1]) | (edge[1:n] == 1)
        self.start = np.flatnonzero(new)
        self.doc = np.searchsorted(bounds, self.start, side="right") - 1
        own = (least[self.start] & POSITION).astype(np.int64)
        self.many = np.minimum(np.append(self.start[1:], n), bounds[self.doc + 1] - LENGTH + 1) - self.start
        self.key, self.lead = grams[own], own - self.start

    def split(self, hot: np.ndarray) -> None:
        """Make a stretch of each window of hot anchors."""
        if not len(hot) or not len(self.key):
            return
        mine = among(self.key, hot)
        many = np.where(mine, self.many, 1)
        again = np.repeat(np.arange(len(many)), many)
        step = np.arange(len(again)) - np.repeat(np.cumsum(many) - many, many)
        self.start = self.start[again] + step
        self.doc, self.many = self.doc[again], np.where(mine, 1, self.many)[again]
        single = mine[again]
        self.lead = np.where(single, 0, self.lead[again])
        self.key = self.key[again]
        self.key[single] = mixed(self.hashes.ranges(self.start[single], LENGTH) + np.uint64(1))

    def keep(self, which: np.ndarray) -> None:
        own = self.start, self.many, self.key, self.doc, self.lead
        self.start, self.many, self.key, self.doc, self.lead = (x[which] for x in own)

    def content(self) -> np.ndarray:
        return mixed(self.hashes.ranges(self.start, self.many + LENGTH - 1))


def among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is one of the sorted ``known``."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def slabs(table: pa.Table) -> Iterator[Slab]:
    """The documents of a chunk in slabs; rows without an id are left out."""
    table = table.filter(pc.is_valid(table.column("doc_id")))
    ids = table.column("doc_id").to_numpy()
    for chunk in table.column("raw").chunks:
        offsets = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1].astype(np.int64)
        data = np.frombuffer(chunk.buffers()[2] or b"", np.uint8)
        a = 0
        while a < len(chunk):
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + SLAB_BYTES, side="right")) - 1)
            yield Slab(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ids[a:b])
            a = b
        ids = ids[len(chunk) :]


def groups(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that sorts by the keys (the first one first), and the places where
    a new value of all but the last key begins."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    change[:1] = True
    for k in keys[:-1]:
        change[1:] |= k[order][1:] != k[order][:-1]
    return order, np.flatnonzero(change)


def binaries(flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values that lie one behind the other."""
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(flat.tobytes())])


def parcels(to: np.ndarray, name: str, sender: dict[str, int], columns: dict[str, np.ndarray], ragged=None) -> pa.Table:
    """One row per addressee in ``to`` with the packed values of each column.

    ``ragged``: name, bytes and sizes of a column with values of different length.
    """
    order = np.argsort(to, kind="stable")
    own = to[order]
    ends = np.append(np.flatnonzero(own[1:] != own[:-1]) + 1, len(own)) if len(own) else np.zeros(0, np.int64)
    made = {name: pa.array(own[ends - 1].astype(np.int32))}
    made |= {k: pa.array(np.full(len(ends), v, np.int32)) for k, v in sender.items()}
    for k, values in columns.items():
        made[k] = binaries(values[order], ends * values.itemsize)
    if ragged:
        k, data, sizes = ragged
        flat = ranges_of(data, (np.cumsum(sizes) - sizes)[order], sizes[order])
        made[k] = binaries(flat, np.cumsum(sizes[order])[ends - 1] if len(ends) else ends)
    return pa.table(made)


def unpacked(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x or b"" for x in table.column(column).to_pylist()), kind)


def sizes_of(table: pa.Table, column: str, item: int) -> np.ndarray:
    return pc.binary_length(table.column(column)).to_numpy().astype(np.int64) // item


def send_anchors(table: pa.Table, shelves: int) -> pa.Table:
    """Step 1: the distinct anchors of a chunk, and whether two documents of it have them."""
    found = [(s.key, s.ids[s.doc]) for s in slabs(table)]
    key = np.concatenate([k for k, _ in found] or [np.zeros(0, np.uint64)])
    ids = np.concatenate([i for _, i in found] or [np.zeros(0, np.int64)])
    order, first = groups(key, ids)
    last = np.append(first[1:], len(order)) - 1
    twice = ids[order[first]] != ids[order[last]]
    key = key[order[first]]
    return parcels((key % np.uint64(shelves)).astype(np.int64), "shelf", {"chunk": _chunk(table)}, {"keys": key, "twice": twice})


def answer_anchors(table: pa.Table, hot_chunks: int) -> pa.Table:
    """Step 2: for each chunk its anchors that occur elsewhere too, and the hot ones."""
    key, twice = unpacked(table, "keys", np.uint64), unpacked(table, "twice", bool)
    chunk = np.repeat(table.column("chunk").to_numpy(), sizes_of(table, "keys", 8))
    order, first = groups(key, chunk)
    many = np.diff(np.append(first, len(order)))
    shared = (many > 1) | (np.maximum.reduceat(twice[order], first) if len(first) else False)
    wanted = order[np.repeat(shared, many)]
    hot = np.repeat(many >= hot_chunks, many)[np.repeat(shared, many)]
    return parcels(chunk[wanted], "chunk", {}, {"keys": key[wanted], "hot": hot})


def send_stretches(table: pa.Table, answers: pa.Table, shelves: int) -> pa.Table:
    """Step 3: each distinct stretch around a shared anchor, with its least id."""
    shared, hot = unpacked(answers, "keys", np.uint64), unpacked(answers, "hot", bool)
    shared, hot = np.sort(shared), np.sort(shared[hot])
    parts = [[], [], [], [], [], []]
    for slab in slabs(table):
        slab.keep(among(slab.key, shared))
        slab.split(hot)
        size = slab.many + LENGTH - 1
        made = slab.key, slab.content(), slab.ids[slab.doc], size, slab.lead, ranges_of(slab.data, slab.start, size)
        for part, values in zip(parts, made, strict=True):
            part.append(values)
    kinds = np.uint64, np.uint64, np.int64, np.int64, np.int64, np.uint8
    key, content, ids, size, lead, flat = (np.concatenate(p or [np.zeros(0, t)]) for p, t in zip(parts, kinds, strict=True))
    order, first = groups(key, content, ids)
    pick = order[first]
    flat = ranges_of(flat, (np.cumsum(size) - size)[pick], size[pick])
    key, ids, size = key[pick], ids[pick], size[pick]
    columns = {"keys": key, "least": ids, "size": size.astype(np.uint8), "lead": lead[pick].astype(np.uint8)}
    shelf = (key % np.uint64(shelves)).astype(np.int64)
    sent = parcels(shelf, "shelf", {"chunk": _chunk(table) if len(table) else -1}, columns, ("raw", flat, size))
    raw = pa.array([pa.compress(x.as_buffer(), codec=CODEC, asbytes=True) for x in sent.column("raw")], pa.binary())
    return sent.set_column(sent.schema.get_field_index("raw"), "raw", raw)


def answer_stretches(table: pa.Table) -> pa.Table:
    """Step 4: for each stretch the windows that a document of smaller id has elsewhere."""
    key, least = unpacked(table, "keys", np.uint64), unpacked(table, "least", np.int64)
    size, data = unpacked(table, "size", np.uint8).astype(np.int64), inflated(table)
    chunk = np.repeat(table.column("chunk").to_numpy(), sizes_of(table, "keys", 8))
    lead = unpacked(table, "lead", np.uint8).astype(np.uint64)
    start = np.cumsum(size) - size
    content = contents_of(data, start, size)
    # one of each content per key, with the least id; what is left alone has no answer
    order, first = groups(key, content, least)
    many = np.diff(np.append(first, len(order)))
    head = order[first]
    by_key, first_key = groups(key[head], content[head])
    alone = np.repeat(np.diff(np.append(first_key, len(by_key))) == 1, np.diff(np.append(first_key, len(by_key))))
    several = np.zeros(len(head), bool)
    several[by_key] = ~alone
    windows = size[head] - LENGTH + 1
    base = np.cumsum(windows) - windows
    smallest = np.repeat(least[head], windows)  # per window of each distinct stretch
    offset = np.arange(len(smallest)) - np.repeat(base, windows)
    # equal windows have the anchor at the same place
    kin = mixed(np.repeat(key[head], windows) ^ (np.repeat(lead[head], windows) - offset.astype(np.uint64)))
    todo = np.flatnonzero(np.repeat(several, windows))
    todo = todo[np.argsort(kin[todo], kind="stable")]
    owner = np.repeat(np.arange(len(head)), windows)
    for part in pieces(kin[todo], SORTED_AT_ONCE):
        rows = todo[part]
        used, mine = np.unique(owner[rows], return_inverse=True)
        near = size[head[used]]
        local = (np.cumsum(near) - near)[mine] + offset[rows]
        ranked, kind = sort_suffixes(ranges_of(data, start[head[used]], near), kin[rows], local, LENGTH)
        lowest = np.full(int(kind.max(initial=-1)) + 1, np.iinfo(np.int64).max)
        np.minimum.at(lowest, kind, smallest[rows[ranked]])
        smallest[rows[ranked]] = lowest[kind]
    # bits of the windows of each entry whose least id is smaller than its own
    entry_of = np.repeat(np.arange(len(head)), many)
    mask = np.zeros(len(order), np.uint32)
    wide = int(windows.max(initial=0))
    for k in range(wide):
        has = windows[entry_of] > k
        low = smallest[(base[entry_of] + k)[has]] < least[order[has]]
        mask[has] |= low.astype(np.uint32) << np.uint32(k)
    told = mask > 0
    rows = order[told]
    return parcels(chunk[rows], "chunk", {}, {"keys": key[rows], "content": content[rows], "mask": mask[told]})


def inflated(table: pa.Table) -> np.ndarray:
    """The bytes of the stretches of all rows."""
    many = [int(np.frombuffer(x or b"", np.uint8).sum(dtype=np.int64)) for x in table.column("size").to_pylist()]
    raw = [pa.decompress(x.as_buffer(), n, codec=CODEC) for x, n in zip(table.column("raw"), many, strict=True)]
    return np.frombuffer(b"".join(raw), np.uint8)


def contents_of(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of stretches that lie one behind the other, as :meth:`Slab.content` has them."""
    out, step = np.zeros(len(start), np.uint64), SLAB_BYTES // LENGTH
    for k in range(0, len(start), step):
        own, base = slice(k, k + step), start[k]
        end = start[own][-1] + size[own][-1]
        out[own] = mixed(PrefixHashes(data[base:end]).ranges(start[own] - base, size[own]))
    return out


def pieces(sorted_values: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of about ``limit`` that never part equal values."""
    a = 0
    while a < len(sorted_values):
        b = min(a + limit, len(sorted_values))
        b = int(np.searchsorted(sorted_values, sorted_values[b - 1], side="right"))
        yield slice(a, b)
        a = b


def cut_documents(table: pa.Table, answers: pa.Table, with_bytes: bool) -> pa.Table:
    """Step 5: remove the bytes under marked windows from the documents of a chunk."""
    hot = np.sort(unpacked(answers, "hot", np.uint64))
    key, content = unpacked(answers, "keys", np.uint64), unpacked(answers, "content", np.uint64)
    mask = unpacked(answers, "mask", np.uint32)
    told = np.argsort(key, kind="stable")
    key, content, mask = key[told], content[told], mask[told]
    held, cut = [], []
    for slab in slabs(table):
        slab.split(hot)
        held.append((slab.key, slab.content(), slab.ids[slab.doc]))
        slab.start, slab.many = slab.start.astype(np.int32), slab.many.astype(np.uint8)
        slab.hashes = slab.key = slab.doc = slab.lead = None  # not needed to cut
        cut.append(slab)
    keys, contents, ids = (np.concatenate(x) for x in zip(*held, strict=True)) if held else (key, content, mask)
    order, first = groups(keys, contents, ids)
    many = np.diff(np.append(first, len(order)))
    least = np.empty(len(order), np.int64)
    least[order] = np.repeat(ids[order[first]], many) if len(first) else ids
    marks = np.zeros(len(order), np.uint32)
    both, new = mixed(key) + content, mixed(keys) + contents
    by = np.argsort(both)
    if len(by):
        at = by[np.minimum(np.searchsorted(both[by], new), len(by) - 1)]
        hit = (key[at] == keys) & (content[at] == contents)
        marks[hit] = mask[at[hit]]
    marks[ids > least] = np.uint32(0xFFFFFFFF)
    out, k = [], 0
    for slab in cut:
        own = marks[k : k + len(slab.start)]
        k += len(slab.start)
        out += _cut(slab, own, with_bytes)
    for raw in table.filter(pc.is_null(table.column("doc_id"))).column("raw").to_pylist():
        out.append((None, len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw if with_bytes else None))
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    columns = zip(*out, strict=True) if out else [[]] * 6
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds, strict=True)})


def _cut(slab: Slab, marks: np.ndarray, with_bytes: bool) -> list[tuple]:
    n = len(slab.data)
    marked = np.zeros(n + 1, np.int64)
    for k in range(int(slab.many.max(initial=0))):
        hit = (slab.many > k) & ((marks >> np.uint32(k)) & np.uint32(1) > 0)
        marked[slab.start[hit] + k] = 1
    total = np.concatenate([[0], np.cumsum(marked[:n])])
    gone = total[1:] > total[np.maximum(np.arange(1, n + 1) - LENGTH, 0)]
    inside = np.ones(n, bool)
    inside[slab.bounds[:-1][slab.bounds[:-1] < n]] = False  # a document's first byte starts a run
    rise = gone & ~(np.append(False, gone[:-1])[:n] & inside)
    removed, rises = np.append(0, np.cumsum(gone)), np.append(0, np.cumsum(rise))
    out = []
    for i, a, b in zip(slab.ids.tolist(), slab.bounds[:-1].tolist(), slab.bounds[1:].tolist()):
        lost = int(removed[b] - removed[a])
        raw = slab.data[a:b]
        raw = (raw[~gone[a:b]] if lost else raw).tobytes()
        out.append((i, b - a, lost, int(rises[b] - rises[a]), hashlib.sha256(raw).hexdigest(), raw if with_bytes else None))
    return out


def _chunk(table: pa.Table) -> int:
    return table.column("chunk")[0].as_py()


def repeated_strings(
    df: DataFrame, text: str = "text", id: str = "doc_id", chunk_bytes: int = CHUNK_BYTES, hot_chunks: int = HOT_CHUNKS,
    with_bytes: bool = False,
) -> DataFrame:
    """Per document: id, n_bytes, n_removed, n_spans, kept_sha256, and kept (bytes, if asked for)."""
    spark = df.sparkSession
    raw = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    plain = df.select(F.col(f"`{id}`").cast("bigint").alias("doc_id"), raw.alias("raw"))
    total = plain.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    chunks = max(1, -(-total // chunk_bytes))
    dealt = plain.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "raw"), F.lit(chunks)).cast("int"))
    name, path = f"texts_{uuid.uuid4().hex}", scratch_dir(spark, "texts")
    dealt = dealt.repartition(chunks, "chunk")
    dealt.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(chunks, "chunk").saveAsTable(name)
    texts = spark.table(name)
    free_shuffles(spark)

    anchors = texts.groupBy("chunk").applyInArrow(
        lambda t: send_anchors(t, chunks), "shelf int, chunk int, keys binary, twice binary"
    )
    shared = settle(
        anchors.groupBy("shelf").applyInArrow(lambda t: answer_anchors(t, hot_chunks), "chunk int, keys binary, hot binary")
    )
    free_shuffles(spark)
    stretches = (
        texts.groupBy("chunk").cogroup(shared.groupBy("chunk"))
        .applyInArrow(lambda t, a: send_stretches(t, a, chunks), "shelf int, chunk int, keys binary, least binary, size binary, lead binary, raw binary")
    )
    marks = settle(
        stretches.groupBy("shelf").applyInArrow(answer_stretches, "chunk int, keys binary, content binary, mask binary")
    )
    free_shuffles(spark)
    none = F.lit(None).cast("binary")
    hot = shared.where(F.instr(F.hex("hot"), "01") > 0).mapInArrow(_hot_keys, "chunk int, hot binary")
    hot = hot.select("chunk", none.alias("keys"), none.alias("content"), none.alias("mask"), "hot")
    answers = marks.withColumn("hot", none).unionByName(hot)
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    cut = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(lambda t, a: cut_documents(t, a, with_bytes), schema)
    cut = settle(cut.withColumnRenamed("doc_id", id) if with_bytes else cut.withColumnRenamed("doc_id", id).drop("kept"))
    spark.sql(f"DROP TABLE {name}")  # the chunks were needed until here
    return cut


def _hot_keys(batches):
    for batch in batches:
        made = []
        for keys, hot in zip(batch.column("keys"), batch.column("hot"), strict=True):
            made.append(np.frombuffer(keys.as_py(), np.uint64)[np.frombuffer(hot.as_py(), bool)].tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("chunk"), pa.array(made, pa.binary())], names=["chunk", "hot"])
