"""Exact search for the largest inner products: a ball tree per shard.

Vectors become integers by ``floor(scale * x)``.  They are dealt into shards by the
number of their row, so that no repeated id makes one large; each shard builds a ball tree, written once.  Queries travel in
blocks.  A first pass takes each block through one shard; the kth scores found
there are shared with all other shards as the floor below which no node is opened.
The second pass takes the blocks through the other shards, without a copy of a block
for each of them (``vectors.every_pair``).  The best of all shards are ranked at the end.  A task holds one tree and one block.

Vectors that are null, empty or hold null or non-finite components take no part,
nor do null ids.  Rows of equal ids all count: as candidates, but for each other, and
as queries, whose results then share the ranks of their id.  A query's own id is no
candidate.  Only vectors of the same length are compared.  A component past 62 bits,
or components whose inner products could pass 64, fail loudly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.llm import vectors
from grantflow.llm.ball_tree import BallTree
from grantflow.session import settle

SCALE, TOP = 256, 5
SHARD_ROWS, BLOCK_ROWS = 8192, 256
PARTS = ("ids", "points", "center", "radius", "least", "first", "end", "left", "right")


def integer_vectors(df: DataFrame, id: str, vector: str, scale: int, *keep: str) -> DataFrame:
    """``id``, ``v`` (array of bigint) and ``dim`` of the rows that take part, and ``keep``."""
    read = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"), *keep)
    read = read.where(F.col("id").isNotNull() & vectors.sound(F.col("v")) & (F.size("v") > 0))
    return read.select("id", vectors.whole(F.col("v"), scale).alias("v"), F.size("v").alias("dim"), *keep)


def _matrix(table: pa.Table) -> np.ndarray:
    return vectors.matrix(table.column("v"), table.column("dim")[0].as_py())


def trees(rows: DataFrame, shards: int) -> DataFrame:
    """``dim``, ``shard`` and the parts of its tree."""

    def build(table: pa.Table) -> pa.Table:
        tree = BallTree.build(table.column("id").to_numpy(), _matrix(table))
        row = {c: table.column(c)[:1] for c in ("dim", "shard")}
        return pa.table(row | {p: pa.array([b], pa.binary()) for p, b in zip(PARTS, tree.to_bytes(), strict=True)})

    dealt = rows.select("id", "v", "dim", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"))
    schema = "dim int, shard int, " + ", ".join(f"{p} binary" for p in PARTS)
    return dealt.groupBy("dim", "shard").applyInArrow(build, schema)


def blocks(queries: DataFrame, many: int) -> DataFrame:
    """``dim``, ``block``, ``ids`` and ``vectors`` (bytes), ``n``: queries in blocks."""

    def pack(table: pa.Table) -> pa.Table:
        ids, points = table.column("id").to_numpy(), _matrix(table)
        return pa.table({
            "dim": table.column("dim")[:1], "block": table.column("block")[:1],
            "own": pa.array([ids.astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([points.astype("<i8").tobytes()], pa.binary()),
        })

    dealt = queries.select("id", "v", "dim", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(many)).cast("int").alias("block"))
    return dealt.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, own binary, vectors binary")


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Each row's block through its tree: query_id, vec_id, score; ``floors`` may be null."""
    names = ["dim", "block", "own", "vectors", "floors", *PARTS]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(j)[i].as_py() for j, n in enumerate(names)}
                tree = BallTree.from_bytes([row[p] for p in PARTS])
                own = np.frombuffer(row["own"], "<i8")
                asked = np.frombuffer(row["vectors"], "<i8").reshape(len(own), row["dim"])
                floor = np.full(len(own), -np.inf)
                if row["floors"]:
                    floor = np.frombuffer(row["floors"], "<f8")
                scores, ids = tree.search(own, asked, k, floor)
                hit = (scores > np.iinfo(np.int64).min) & (scores >= floor[:, None])
                who = np.broadcast_to(own[:, None], ids.shape)[hit]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(who), pa.array(np.full(len(who), row["dim"], np.int32)), pa.array(np.full(len(who), row["block"], np.int32)),
                     pa.array(ids[hit]), pa.array(scores[hit])],
                    names=["query_id", "dim", "block", "vec_id", "score"],
                )

    return pairs.select(*names).mapInArrow(run, "query_id bigint, dim int, block int, vec_id bigint, score bigint")


def _floors(found: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Blocks with the kth score found so far of each of their queries."""
    kth = found.groupBy("dim", "block", "query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
    rows = kth.where(F.col("n") >= k).groupBy("dim", "block").agg(F.collect_list(F.struct("query_id", "score")).alias("known"))

    def fill(batches):
        for batch in batches:
            made = []
            for own, known in zip(batch.column("own"), batch.column("known"), strict=True):
                ids = np.frombuffer(own.as_py(), "<i8")
                by_id = {x["query_id"]: float(x["score"]) for x in known.as_py() or []}
                made.append(np.array([by_id.get(int(i), -np.inf) for i in ids], "<f8").tobytes())
            kept = [batch.column(c) for c in ("dim", "block", "own", "vectors")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(made, pa.binary())], names=["dim", "block", "own", "vectors", "floors"])

    joined = asked.join(rows, ["dim", "block"], "left").select("dim", "block", "own", "vectors", "known")
    return joined.mapInArrow(fill, "dim int, block int, own binary, vectors binary, floors binary")


def top_inner_products(
    df: DataFrame, is_query: Column, id: str = "vec_id", vector: str = "embedding", k: int = TOP, scale: int = SCALE
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` largest of each query, ties to the smaller id."""
    marked = df.select(F.col(f"`{id}`").alias("id"), F.col(f"`{vector}`").alias("v"), F.coalesce(is_query, F.lit(False)).alias("query"))
    number = F.monotonically_increasing_id()
    # numbers are given once and written, so that a lost task cannot change them
    rows = settle(integer_vectors(marked, "id", "v", scale, "query").withColumn("row", number))
    asked = rows.where("query")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    forest = settle(trees(rows, shards))
    packed = settle(blocks(asked, max(1, asked.count() // BLOCK_ROWS)))
    here = F.pmod(F.xxhash64("dim", "block"), F.lit(shards)).cast("int")
    pilot = packed.withColumn("shard", here).withColumn("floors", F.lit(None).cast("binary"))
    first = settle(_searched(pilot.join(forest, ["dim", "shard"]), k))
    floors = settle(_floors(first, packed, k).withColumn("_done", here))
    others = vectors.every_pair(forest, floors, F.col("shard") != F.col("_done"))
    found = first.unionByName(_searched(others, k))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
