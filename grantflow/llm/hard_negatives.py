"""Hard negatives: rows of other labels whose score comes close below that of a positive.

Vectors become integers by ``floor(scale * x)``; a score is the inner product with the
anchor.  All rows are dealt into shards, anchors into blocks, both by a number given
to each row, so that neither a label nor a repeated row makes one of them large.  A
block holds a spanning tree of its anchors (``anchor_tree``).  Every block meets every
shard twice: first for the best rows of the anchor's label, its positives; then, with
the windows that these leave for negatives, for the best rows of other labels inside
them.  In a shard candidates come in chunks; what a chunk found raises the score from
which the next ones are looked at.  The best of all shards are ranked at the end.  A
task holds one block and one shard at a time.

Rows with a null id, label or vector, or with null or non-finite components take no
part.  Rows of equal ids each count, as anchors too, but are no candidates for each
other.  Scores that tie go by id.  Only vectors of the same length are compared, empty
ones score 0.  A component past 62 bits or a score past 64 is an error.  An anchor
without positives, or a positive without negatives, yields no row; so does an empty
table.  Further columns, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.llm import vectors
from grantflow.llm.anchor_tree import Scores, spanning_tree
from grantflow.session import settle

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
# Percent of the positive's score between which a negative's lies.
LOW, HIGH = 30, 90
SHARD_ROWS, BLOCK_ROWS, CHUNK_ROWS = 8192, 256, 2048

BLOCK = ("rows", "ids", "labels", "points", "order", "parent", "edge")
SHARD = ("s_ids", "s_labels", "s_points")


def _packed(df: DataFrame, key: str, names: tuple[str, ...], with_tree: bool) -> DataFrame:
    """One row for each ``dim`` and ``key``, with its rows as bytes."""

    def pack(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        points = vectors.matrix(table.column("v"), dim)
        parts = [table.column(c).to_numpy().astype("<i8") for c in ("id", "label")] + [points.astype("<i8")]
        if with_tree:
            order, parent, edge = spanning_tree(points)
            parts = [table.column("row").to_numpy().astype("<i8"), *parts, order.astype("<i8"), parent.astype("<i8"), edge.astype("<f8")]
        kept = {c: table.column(c)[:1] for c in ("dim", key)}
        return pa.table(kept | {n: pa.array([p.tobytes()], pa.binary()) for n, p in zip(names, parts, strict=True)})

    return df.groupBy("dim", key).applyInArrow(pack, f"dim int, {key} int, " + ", ".join(f"{n} binary" for n in names))


class _Best:
    """The best ``k`` (score, id) so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> float:
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores):
            scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
            first = np.lexsort((ids, ~scores))[: self.k]
            self.scores, self.ids = scores[first], ids[first]


def windows(positive_score: int, low: int = LOW, high: int = HIGH) -> tuple[int, int]:
    """Least and largest whole score of a negative; empty where the first is larger."""
    return -(-low * positive_score // 100), high * positive_score // 100


def _positives(block: dict, shard: dict, k: int):
    """(anchor, ids, scores) of the best ``k`` of its label in the shard."""
    best = [_Best(k) for _ in block["ids"]]
    for at in range(0, len(shard["ids"]), CHUNK_ROWS):
        ids, labels, points = (shard[c][at : at + CHUNK_ROWS] for c in ("ids", "labels", "points"))

        def wanted(a, low, high):
            return (labels == block["labels"][a]) & (ids != block["ids"][a]) & (high >= best[a].floor)

        for a, which, scores in Scores(block["points"], block["tree"], points).walk(wanted):
            best[a].add(scores, ids[which])
    return [(a, b.ids, b.scores) for a, b in enumerate(best) if len(b.ids)]


def _negatives(block: dict, shard: dict, k: int, low: int, high: int):
    """(anchor, number of its positive, ids, scores) of the best ``k`` in that positive's window."""
    best: list[list[tuple[int, int, int, _Best]]] = [[] for _ in block["ids"]]
    for a, nth, score in block["positives"]:
        bounds = windows(score, low, high)
        if bounds[0] <= bounds[1]:
            best[a].append((*bounds, nth, _Best(k)))
    for at in range(0, len(shard["ids"]), CHUNK_ROWS):
        ids, labels, points = (shard[c][at : at + CHUNK_ROWS] for c in ("ids", "labels", "points"))

        def wanted(a, least, most):
            fits = np.zeros(len(ids), bool)
            for from_, to, _, found in best[a]:
                fits |= (most >= max(from_, found.floor)) & (least <= to)
            return fits & (labels != block["labels"][a]) & (ids != block["ids"][a])

        for a, which, scores in Scores(block["points"], block["tree"], points).walk(wanted):
            for from_, to, _, found in best[a]:
                inside = (scores >= from_) & (scores <= to)
                found.add(scores[inside], ids[which[inside]])
    return [(a, nth, b.ids, b.scores) for a, own in enumerate(best) for _, _, nth, b in own if len(b.ids)]


def _unpacked(row: dict) -> tuple[dict, dict]:
    dim = row["dim"]
    ints = {c: np.frombuffer(row[c], "<i8") for c in (*BLOCK[:-1], *SHARD)}
    block = {c: ints[c] for c in ("rows", "ids", "labels")} | {"points": ints["points"].reshape(len(ints["ids"]), dim)}
    block["tree"] = (ints["order"], ints["parent"], np.frombuffer(row["edge"], "<f8"))
    shard = {c: ints[f"s_{c}"] for c in ("ids", "labels")}
    return block, shard | {"points": ints["s_points"].reshape(len(shard["ids"]), dim)}


def _best_rows(blocks: DataFrame, shards: DataFrame, k: int) -> DataFrame:
    """row, dim, block, anchor_id, positive_id, score and rank ``nth`` of the positives."""
    names = ["dim", "block", *BLOCK, *SHARD]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block, shard = _unpacked(row)
                for a, ids, scores in _positives(block, shard, k):
                    same = [np.full(len(ids), x) for x in (block["rows"][a], row["dim"], row["block"], block["ids"][a])]
                    same[1:3] = [x.astype(np.int32) for x in same[1:3]]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*same, ids, scores)], names=found)

    found = ["row", "dim", "block", "anchor_id", "positive_id", "score"]
    schema = "row bigint, dim int, block int, anchor_id bigint, positive_id bigint, score bigint"
    rows = vectors.every_pair(shards, blocks).select(*names).mapInArrow(run, schema)
    order = Window.partitionBy("row").orderBy(F.desc("score"), "positive_id")
    return rows.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k)


def _close_rows(blocks: DataFrame, shards: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """row, nth, anchor_id, positive_id, positive_score, negative_id, negative_score of each shard."""
    names = ["dim", "block", "positives", *BLOCK, *SHARD]
    found = ["row", "nth", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                block, shard = _unpacked(row)
                place = {r: a for a, r in enumerate(block["rows"].tolist())}
                told = {(place[x["row"]], x["nth"]): x for x in row["positives"]}
                block["positives"] = [(a, nth, x["score"]) for (a, nth), x in told.items()]
                for a, nth, ids, scores in _negatives(block, shard, k, low, high):
                    x, n = told[a, nth], len(ids)
                    same = [np.full(n, v, np.int64) for v in (x["row"], nth, block["ids"][a], x["positive_id"], x["score"])]
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*same, ids, scores)], names=found)

    return vectors.every_pair(shards, blocks).select(*names).mapInArrow(run, ", ".join(f"{c} bigint" for c in found))


def mine(
    df: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding",
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor and each of its ``positives`` best rows of the same label: the
    ``negatives`` best rows of other labels with ``low * positive_score <= 100 *
    negative_score <= high * positive_score``.
    """
    own = {"id": F.col(f"`{id}`").cast("bigint"), "label": F.col(f"`{label}`").cast("bigint")}
    read = df.select(*[c.alias(k) for k, c in own.items()], F.col(f"`{vector}`").cast("array<double>").alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
    part = read.where(F.col("id").isNotNull() & F.col("label").isNotNull() & vectors.sound(F.col("v")))
    # numbers are given once and written, so that a lost task cannot change them
    rows = settle(part.select("id", "label", "anchor", vectors.whole(F.col("v"), scale).alias("v"), F.size("v").alias("dim"), F.monotonically_increasing_id().alias("row")))
    sizes = rows.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors")).first()
    many, some = (max(1, -(-n // size)) for n, size in ((sizes["rows"], SHARD_ROWS), (sizes["anchors"], BLOCK_ROWS)))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    shards = settle(_packed(rows.withColumn("shard", deal(many)), "shard", SHARD, False))
    blocks = settle(_packed(rows.where("anchor").withColumn("block", deal(some)), "block", BLOCK, True))
    best = settle(_best_rows(blocks, shards, positives))
    told = best.groupBy("dim", "block").agg(F.collect_list(F.struct("row", "nth", "positive_id", "score")).alias("positives"))
    close = _close_rows(settle(blocks.join(told, ["dim", "block"])), shards, negatives, low, high)
    order = Window.partitionBy("row", "nth").orderBy(F.desc("negative_score"), "negative_id")
    ranked = close.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
