"""Near duplicates by ProbMinHash signatures, banding and exact verification.

A text is its lower-case words; its shingles are each five words in a row (all
words, if fewer), weighted by how often they occur.  The similarity of two texts
is the probability Jaccard of these weights: for each shingle in both, one over
the sum over all shingles of the larger of the two weight ratios.

Signature: each shingle sends arrivals of a Poisson process whose rate is its
weight, all drawn from its hash; each arrival goes to a random register, and a
register keeps the shingle that came first.  A shingle stops once its next
arrival is later than every register of its text.  Registers of two texts agree
with a chance equal to their similarity.

Pairs: texts that agree in all registers of one of the bands share a bucket.  A
bucket proposes its members to one of them, its hub, so proposals grow with the
documents and not with pairs.  The hub is the member that shares buckets most, as
the text does of which the others are edited copies.  Every document is compared
exactly with the hub it shares most bands with, and where that leaves both in different
classes, with its other hubs.

Members of buckets that then still span several classes, the rest, get ``FINE`` further
registers in bands of ``FINE_ROWS``.  In a bucket of at most ``SMALL`` members all of
different classes meet.  A larger one proposes a hub and falls apart by longer bands:
its members are keyed again by that band and each of the ``NEXT`` bands behind it, and
so on for ``LEVELS`` levels.  Members of buckets that are large even then, and of several
classes, meet by the prefix filter below.  Texts meet by one byte of each register: those that agree
in fewer than three standard deviations below the threshold are not compared further
(one in 740 of the pairs at the threshold).  A pair at the threshold agrees
in one band with a chance of 1 - 5e-6 and in two close ones, which only families with
larger buckets need, with one of 0.99 or more; the more alike, the likelier.  ``exact=True`` compares the
rest by a prefix filter instead, which loses no pair at all but costs the square of a
family of texts that share even their rarest shingles.

Classes are the connected components of the links found.  Links of a finer level join
whole classes, so that no level goes over the links before it again.

Texts of equal words form a class without any of this, also those of no words
(null, empty or blank).  A class is named by its least ``doc_id`` (null only if it
has no other).  Rows with equal id and text are one document.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.llm.bytehash import PrefixHashes, mixed
from grantflow.llm.components import components, with_links
from grantflow.llm.texts import add_text_columns, slices
from grantflow.operators.joins import hot_join
from grantflow.session import settle

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4
FINE, FINE_ROWS = 240, 6
SMALL, NEXT, LEVELS = 512, 4, 4
CELLS = 1 << 18
BLOCKS = 64


def words(text: str) -> str:
    return " ".join(text.lower().split())


def shingles(texts: list[str], size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of normalised texts: document, hash and weight of each distinct shingle, in order."""
    raw = [t.encode() + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    ends = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    doc = np.searchsorted(np.cumsum([len(r) for r in raw]), starts, side="right")
    full = ends > starts
    starts, ends, doc = starts[full], ends[full], doc[full]
    word = mixed(PrefixHashes(data).ranges(starts, ends - starts))
    factor = mixed(np.arange(101, 101 + size, dtype=np.uint64)) | np.uint64(1)
    count = np.bincount(doc, minlength=len(texts))
    first = np.cumsum(count) - count
    n = max(0, len(word) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += word[k : k + n] * factor[k]
    inside = doc[:n] == doc[size - 1 :] if n else np.zeros(0, bool)
    short = np.flatnonzero((count > 0) & (count < size))
    less = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        more = count[short] > k
        less[more] += word[first[short[more]] + k] * factor[k]
    doc = np.concatenate([doc[:n][inside], short])
    value = mixed(np.concatenate([total[inside], less + np.uint64(1)]))
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1]))[: len(doc)])
    return doc[new], value[new], np.diff(np.append(new, len(doc))).astype(np.float64)


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, texts: int, registers: int) -> np.ndarray:
    """(texts, registers) array of the shingles that arrived first; 0 without shingles."""
    times = np.full(texts * registers, np.inf)
    first = np.zeros(texts * registers, np.uint64)
    at, k = np.zeros(len(doc)), 0
    while len(doc):
        k += 1
        seed = mixed(value + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64)))
        at = at - np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)) / weight
        cell = doc * registers + (mixed(seed ^ np.uint64(0xC2B2AE3D27D4EB4F)) % np.uint64(registers)).astype(np.int64)
        better = at < times[cell]
        np.minimum.at(times, cell[better], at[better])
        won = better & (times[cell] == at)
        first[cell[won]] = value[won]
        live = np.unique(doc)
        latest = np.zeros(texts)
        latest[live] = times.reshape(texts, registers)[live].max(1)
        going = at < latest[doc]
        doc, value, weight, at = doc[going], value[going], weight[going], at[going]
    return first.reshape(texts, registers)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One signed key per band."""
    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    key = np.broadcast_to(key, (len(signature), bands)).copy()
    for k in range(rows):
        key = mixed(key ^ signature[:, k::rows])
    return key.view(np.int64)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of (sorted shingles, weights) of two texts."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    v, w = a[1][i], b[1][j]
    ratio, order = w / v, np.argsort(w / v, kind="stable")
    # sum over all shingles of max(v'/v, w'/w) = (sum of v' with w'/v' <= r) / v + (sum of w' with w'/v' > r) / w
    low = np.cumsum(v[order])
    high = w.sum() - np.cumsum(w[order])
    upto = np.searchsorted(ratio[order], ratio, side="right") - 1
    total = (low[upto] + a[1].sum() - v.sum()) / v + (high[upto] + b[1].sum() - w.sum()) / w
    return float((1 / total).sum())


def sketch(df: DataFrame, text: str, bands: int, rows: int) -> DataFrame:
    """``doc_id``, ``hash``, ``content`` (128 bits of the words) and ``bands``."""

    def prepare():
        def make(texts: list[str]):
            own = [words(t) for t in texts]
            signed = signatures(*shingles(own), len(own), bands * rows)
            keys = band_keys(signed, bands, rows)
            return [xxhash.xxh3_128_digest(t.encode()) for t in own], [k if t else [] for t, k in zip(own, keys, strict=True)]

        return make

    fields = {"content": "binary", "bands": "array<bigint>"}
    return add_text_columns(df, text, fields, prepare, ["doc_id", "hash"])


def verified(pairs: DataFrame, bodies: DataFrame, threshold: float, keep: Sequence[str] = ()) -> DataFrame:
    """The ``a``-``b`` pairs (and columns ``keep``) whose texts are similar enough."""
    one = hot_join(pairs.select("a", "b", *keep), bodies.select(F.col("node").alias("b"), F.col("text").alias("_hub")), ["b"], "inner")
    two = hot_join(one, bodies.select(F.col("node").alias("a"), "text"), ["a"], "inner")

    def prepare():
        def make(texts: list[str], hubs: list[str]):
            # a text that meets several others is cut into shingles once
            place = {t: k for k, t in enumerate(dict.fromkeys([*texts, *[h or "" for h in hubs]]))}
            doc, value, weight = shingles([words(t) for t in place])
            cut = np.searchsorted(doc, np.arange(len(place) + 1))
            own = [(value[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]
            return [[similarity(own[place[t]], own[place[h or ""]]) >= threshold for t, h in zip(texts, hubs, strict=True)]]

        return make

    return add_text_columns(two, "text", {"near": "boolean"}, prepare, ["a", "b", *keep], ["_hub"]).where("near").drop("near")


def near_duplicates(
    df: DataFrame, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
    exact: bool = False,
) -> DataFrame:
    """One row per document: id, ``hash`` (of the text), class_id, class_size, kept."""
    plain = df.select(F.col(f"`{id}`").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    plain = plain.withColumn("hash", F.xxhash64("text"))
    slim = settle(sketch(plain, "text", bands, rows))
    heads = slim.groupBy("content").agg(F.min(F.struct("doc_id", "hash")).alias("head"), F.first("bands").alias("bands"))
    most = slim.count()
    nodes = settle(heads.withColumn("node", F.monotonically_increasing_id()), most)
    members = nodes.select("node", F.explode("bands").alias("key"))
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # the first hub is the member with most company in all its buckets: the text others vary;
    # a member has one bucket and one hub per band at most, so its lists are short
    buckets = hot_join(members, sizes, ["key"], "inner").groupBy("node")
    shared = settle(buckets.agg(F.sum("n").alias("company"), F.collect_list("key").alias("keys")), most)
    rank = F.shiftleft("company", 20) + F.pmod(F.xxhash64("node"), F.lit(1 << 20))
    hubs = _with_hub(shared.select("node", F.explode("keys").alias("key"), (-rank).alias("order")), F.col("order"))
    held = settle(hubs.groupBy("node").agg(F.collect_list("key").alias("keys"), F.collect_list("hub").alias("hubs")), most)
    others = F.array_distinct(F.filter("hubs", lambda h: h != F.col("node")))
    least = lambda h: F.named_struct(F.lit("less"), -F.size(F.filter("hubs", lambda x: x == h)), F.lit("hub"), h)
    shares = F.transform(others, least)
    ranked = held.select("node", F.array_min(shares)["hub"].alias("first"), F.explode(others).alias("hub"))
    # a hub has any number of members
    first_hub = F.max(F.when(F.col("hub") == F.col("first"), F.struct("node", "hub"))).alias("first")
    asks = bands * held.count()
    proposed = settle(_pairs(ranked, "first", "node", "hub").groupBy("a", "b").agg(first_hub), asks)
    # null ids are equal inside a struct; a place is that of one node, so its repeats lie beside it
    asked = held.select("node").join(nodes.select("node", F.col("head").alias("place")), "node")
    placed = plain.select(F.struct("doc_id", "hash").alias("place"), "text")
    bodies = settle(placed.join(asked, "place").dropDuplicates(["place"]).select("node", "text"))

    links = settle(verified(proposed.where("first IS NOT NULL").select("a", "b", "first"), bodies, threshold, ["first"]))
    # two members of one hub need no comparison with another one they share
    under = links.select(F.col("first.node").alias("node"), F.col("first.hub").alias("label"))
    apart = _apart(proposed.where("first IS NULL").select("a", "b"), under, "a", "b")
    labels = components(links.select("a", "b").union(settle(verified(settle(apart, asks), bodies, threshold))))
    rest = _rest(_labelled(held, labels).select("node", "label", F.explode("keys").alias("key")))
    if exact:
        labels = _linked(settle(_able(rest, bodies, threshold)), labels, bodies, threshold)
    else:
        labels = _finer(rest, labels, bodies, threshold)
    return _classes(slim, nodes, labels)


def _linked(pairs: DataFrame, labels: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """Labels after a comparison of ``pairs`` (a written table)."""
    if pairs.isEmpty():
        return labels
    found = settle(verified(pairs, bodies, threshold))
    return labels if found.isEmpty() else with_links(labels, found)


def fine_sketch(texts: DataFrame) -> DataFrame:
    """node, label, ``fine``: keys of the finer bands, ``bytes``: one of each register."""

    def prepare():
        def make(some: list[str]):
            doc, value, weight = shingles([words(t) for t in some])
            signed = signatures(doc, mixed(value ^ np.uint64(0xA5A5A5A5A5A5A5A5)), weight, len(some), FINE)
            keys = band_keys(signed, FINE // FINE_ROWS, FINE_ROWS)
            return [list(keys), [row.tobytes() for row in mixed(signed).astype(np.uint8)]]

        return make

    return add_text_columns(texts, "text", {"fine": "array<bigint>", "bytes": "binary"}, prepare, ["node", "label"])


def _least_alike(threshold: float) -> int:
    """How many registers agree at least, but for three standard deviations."""
    return int(FINE * threshold - 3 * (FINE * threshold * (1 - threshold)) ** 0.5)


def _alike(buckets: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different labels, of ``members`` (node, label, bytes, keys) in one row, whose bytes agree enough.

    A pair is given by one bucket only, that of the least key both have.
    """
    least = _least_alike(threshold)

    def meet(batches):
        for batch in batches:
            for key, row in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = row.values
                node, label = (held.field(c).to_numpy(zero_copy_only=False) for c in ("node", "label"))
                own = np.frombuffer(b"".join(held.field("bytes").to_pylist()), np.uint8).reshape(len(node), FINE)
                keys = [set(k) for k in held.field("keys").to_pylist()]
                for i in range(len(node) - 1):
                    near = np.flatnonzero((label[i + 1 :] != label[i]) & ((own[i + 1 :] == own[i]).sum(1) >= least)) + i + 1
                    near = np.array([j for j in near if min(keys[i] & keys[j]) == key], np.int64)
                    if len(near):
                        a, b = np.maximum(node[near], node[i]), np.minimum(node[near], node[i])
                        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return buckets.select("key", "members").mapInArrow(meet, "a bigint, b bigint")


def _alike_hubs(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs of node, label, bytes and hub, hub_label, hub_bytes of different labels whose bytes agree enough."""
    least = _least_alike(threshold)
    names = ["node", "label", "bytes", "hub", "hub_label", "hub_bytes"]

    def meet(batches):
        for batch in batches:
            if batch.num_rows:
                node, label, hub, other = (batch.column(k).to_numpy() for k in (0, 1, 3, 4))
                one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, FINE) for k in (2, 5))
                near = (label != other) & ((one == two).sum(1) >= least)
                a, b = np.maximum(node, hub)[near], np.minimum(node, hub)[near]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return pairs.select(*names).mapInArrow(meet, "a bigint, b bigint")


def _finer(rest: DataFrame, labels: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """Labels after members of the rest have met in ever finer buckets."""
    fine = settle(fine_sketch(bodies.join(rest, "node")))
    member = F.struct("node", "label", "bytes", "keys").alias("member")
    ahead = F.transform(F.sequence(F.lit(1), F.lit(NEXT)), lambda d: F.pmod(F.col("band") + d, F.size("fine")))
    most = fine.count()
    tested, known, many = None, labels, None
    for level in range(LEVELS):
        if labels is not known:
            known = labels
            fine = settle(_labelled(fine.drop("label"), labels), most)
        if many is None:
            keyed = fine.select("node", "label", F.posexplode("fine").alias("band", "key"))
        else:
            keyed = hot_join(many.select("node", "band", "key"), fine.select("node", "label", "fine"), ["node"], "inner")
            keyed = keyed.select("node", "label", "key", "fine", F.explode(ahead).alias("band"))
            keyed = keyed.select("node", "label", "band", F.xxhash64("key", F.get("fine", F.col("band"))).alias("key"))
        hub = F.min_by("node", F.xxhash64("key", "node")).alias("hub")
        sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("label").alias("least"), F.max("label").alias("most"), hub)
        mixed_ = settle(hot_join(keyed, sizes.where("least < most").select("key", "n", "hub"), ["key"], "inner"))
        many = mixed_.where(F.col("n") > SMALL)
        more = not many.isEmpty()
        # a node has FINE / FINE_ROWS * NEXT ** level buckets at most; its bytes join its lists of them once
        own_keys = F.collect_set(F.when(F.col("n") <= SMALL, F.col("key"))).alias("keys")
        own_hubs = F.collect_set(F.when((F.col("n") > SMALL) & (F.col("node") != F.col("hub")), F.col("hub"))).alias("hubs")
        leads = F.max((F.col("n") > SMALL) & (F.col("node") == F.col("hub"))).alias("leads")
        held = settle(mixed_.groupBy("node").agg(own_keys, own_hubs, leads).join(fine.select("node", "label", "bytes"), "node"), most)
        few = held.select("node", "label", "bytes", "keys", F.explode("keys").alias("key"))
        pairs = _alike(few.groupBy("key").agg(F.collect_list(member).alias("members")), threshold)
        if more:
            # hubs are few: one for SMALL members or more
            own = [F.col(c).alias(f"hub_{c}") for c in ("label", "bytes")]
            hubs = settle(held.where("leads").select(F.col("node").alias("hub"), *own), most)
            two = hot_join(held.select("node", "label", "bytes", F.explode("hubs").alias("hub")), hubs, ["hub"], "inner")
            pairs = pairs.unionByName(_alike_hubs(two.where("label <> hub_label"), threshold))
        met = pairs.withColumn("old", F.lit(False))
        if tested is not None:
            met = met.unionByName(tested.withColumn("old", F.lit(True)))
        pairs = settle(met.groupBy("a", "b").agg(F.max("old").alias("old")).where("NOT old").select("a", "b"))
        tested = pairs if tested is None else tested.unionByName(pairs)
        labels = _linked(pairs, labels, bodies, threshold)
        if not more:
            return labels
    # buckets that no level made small: the exact way for those that still span several classes
    left = settle(_rest(_labelled(many.select("node", "key"), labels)))
    return labels if left.isEmpty() else _linked(settle(_able(left, bodies, threshold)), labels, bodies, threshold)


def _with_hub(members: DataFrame, order: Column) -> DataFrame:
    """node, key, hub: members of buckets with the least of each by ``order``."""
    hubs = members.groupBy("key").agg(F.min_by("node", order).alias("hub"))
    return hot_join(members.select("node", "key"), hubs, ["key"], "inner")


def _pairs(held: DataFrame, *keep: str) -> DataFrame:
    """Members and hubs as pairs, the larger node first."""
    pair = F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")
    return held.where("node <> hub").select(*pair, *keep)


def _labelled(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``nodes`` with their label (a node without links is its own)."""
    return nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _rest(marked: DataFrame) -> DataFrame:
    """node, label: members (node, label, key) of buckets that span several classes."""
    ends = marked.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most"))
    several = hot_join(marked, ends.where("least < most").select("key"), ["key"], "left_semi")
    return several.groupBy("node").agg(F.first("label").alias("label"))


def _cell(value: np.ndarray) -> np.ndarray:
    return (value % np.uint64(CELLS)).astype(np.int64)


def occurrences(texts: DataFrame) -> np.ndarray:
    """In how many texts shingles occur, added up by cell."""

    def count(batches):
        seen = np.zeros(CELLS, np.int64)
        for batch in batches:
            for _, some in slices(batch.column(0)):
                seen += np.bincount(_cell(shingles([words(t) for t in some])[1]), minlength=CELLS)
        cells = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(seen[cells])], names=["cell", "n"])

    counted = texts.select("text").mapInArrow(count, "cell bigint, n bigint")
    found = counted.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(CELLS, np.uint32)
    seen[found.column("cell").to_numpy()] = np.minimum(found.column("n").to_numpy(), (1 << 32) - 1)
    return seen


def prefixes(texts: list[str], seen: np.ndarray, threshold: float) -> tuple[list[np.ndarray], list[int]]:
    """Of normalised texts: the shingles one of which any similar text has, rarest
    first, and how many of them do for the text with the larger share in common."""
    doc, value, weight = shingles(texts)
    order = np.lexsort((value, seen[_cell(value)], doc))
    value, weight = value[order], weight[order]
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    upto = np.concatenate([[0], np.cumsum(weight)])
    left = upto[cut[1:]][doc] - upto[:-1]  # weight from here to the end of the text
    share = left / (upto[cut[1:]] - upto[cut[:-1]])[doc] + 1e-9
    wide, some = share >= threshold, share >= 2 * threshold / (1 + threshold)
    return (
        [value[a:b][wide[a:b]].view(np.int64) for a, b in zip(cut, cut[1:])],
        np.bincount(doc[some], minlength=len(texts)).tolist(),
    )


def _able(rest: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """Pairs of different labels that the prefix filter lets pass."""
    texts = settle(hot_join(bodies, rest, ["node"], "inner"))
    seen = occurrences(texts)

    def prepare():
        return lambda some: prefixes([words(t) for t in some], seen, threshold)

    cut = add_text_columns(texts, "text", {"tokens": "array<bigint>", "many": "int"}, prepare, ["node", "label"])
    tokens = settle(cut.select("node", "label", F.posexplode("tokens").alias("at", "token"), "many").selectExpr("node", "label", "token", "at < many AS first"))
    # only tokens of several classes make pairs
    ends = tokens.groupBy("token").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.max("first").alias("any"))
    held = hot_join(tokens, ends.where("least < most AND any").select("token"), ["token"], "left_semi")
    # by label, so that members of one class never meet; in blocks, so that no list grows with the class
    block = F.pmod(F.xxhash64("node"), F.lit(BLOCKS))
    lists = settle(
        held.groupBy("token", "label", block.alias("block"))
        .agg(F.collect_list("node").alias("nodes"), F.collect_list(F.when(F.col("first"), F.col("node"))).alias("firsts"))
        .drop("block")
    )
    others = lists.select("token", F.col("label").alias("_other"), F.col("nodes").alias("hubs"))
    met = hot_join(lists.where("size(firsts) > 0").select("token", "label", "firsts"), others, ["token"], "inner").where("label <> _other")
    pairs = met.select(F.explode("firsts").alias("node"), "hubs").select("node", F.explode("hubs").alias("hub"))
    return _pairs(pairs).distinct()


def _apart(pairs: DataFrame, labels: DataFrame, one: str, two: str) -> DataFrame:
    """Pairs whose two nodes have different labels (a node without links is its own)."""
    marked = pairs
    for column, into in ((one, "_la"), (two, "_lb")):
        marked = hot_join(marked, labels.select(F.col("node").alias(column), F.col("label").alias(into)), [column], "left")
    differ = F.coalesce("_la", F.col(one)) != F.coalesce("_lb", F.col(two))
    return marked.where(differ).select(*pairs.columns)


def _classes(slim: DataFrame, nodes: DataFrame, labels: DataFrame) -> DataFrame:
    named = nodes.select("node", "content").join(labels, "node", "left")
    named = named.select("content", F.coalesce("label", "node").alias("label"))
    rows = settle(hot_join(slim.select("doc_id", "hash", "content"), named, ["content"], "inner").drop("content"))
    first = rows.groupBy("label").agg(
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "hash"))).alias("head"),
        F.min("hash").alias("_hash"),
        F.count(F.lit(1)).alias("class_size"),
    )
    full = hot_join(rows, first, ["label"], "inner")
    kept = F.when(F.col("head").isNull(), F.col("hash") == F.col("_hash")).otherwise(
        F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("hash") == F.col("head.hash"))
    )
    return full.select("doc_id", "hash", F.col("head.doc_id").alias("class_id"), "class_size", kept.alias("kept"))
