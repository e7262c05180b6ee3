"""Mix sources to target weights by pivotal dependent rounding.

Sources in code-point order (null last) weigh 5, 2, 1, repeating, and share all
words.  A source is given at most 3 times its own words; what it can't take the
others share by weight.  A document then should be copied target / size of its
source times.  The whole part is certain.  The fractions are rounded in pairs: a
random step moves words from one document to the other, with chances that keep
both expectations and the words of the pair, until one of the two is integral.
The other goes on to the next.

Pairs meet in a reduction tree.  Documents fall into leaves by a hash, and are
rounded there source by source, the long ones first, so that what stays open is
mostly short.  Each leaf leaves at most one open document of a source; 32 leaves
make the next one, up to the root, where the last open document of each source is
rounded alone.  No task holds more than one document and its batch, whatever the
share of a source.

Chances come from hashes of the two documents, so reruns agree, also after a lost
executor.  Null text: no words.  Documents without words are copied by their own
chance and take no words.  Rows that repeat are documents of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.llm.texts import add_text_columns
from grantflow.operators.numbering import running_offset
from grantflow.session import settle

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
LEAF_ROWS = 1024
FAN_BITS = 5
WORD = (1 << 64) - 1


def sizes(df: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Add ``size``: runs of anything but blanks (space, tab to carriage return)."""

    def prepare():
        return lambda texts: [[len(t.encode().split()) for t in texts]]

    return add_text_columns(df, text, {"size": "bigint"}, prepare, keep)


def targets(
    slim: DataFrame, source: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of every source.

    Sources whose share tops their limit get the limit; the rest is shared again
    until none tops it.  Each round is one sum over the sources, two numbers of
    which reach the driver.
    """
    found = slim.groupBy(source).agg(F.sum("size").alias("source_size"))
    ranked = running_offset(found.withColumn("_none", F.col(source).isNull()), ["_none", source], "_place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    rows = settle(ranked.select(source, "source_size", weight.alias("_weight"), (most * F.col("source_size")).alias("_limit")))
    words, share, full = rows.agg(F.sum("source_size")).first()[0] or 0, 0.0, -1
    while True:
        over = F.col("_weight") * share > F.col("_limit") if full >= 0 else F.lit(False)
        taken, left, n = rows.agg(
            F.coalesce(F.sum(F.when(over, F.col("_limit"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("_weight"))), F.lit(0.0)),
            F.coalesce(F.sum(over.cast("int")), F.lit(0)),
        ).first()
        if n == full or not left:
            share = share if left else float("inf")
            break
        share, full = max(share, (words - taken) / left), n
    return rows.select(source, "source_size", F.least(F.col("_weight") * share, F.col("_limit").cast("double")).alias("target"))


def chance(a: int, b: int) -> float:
    """Uniform number from the keys of a pair."""
    x = (a * 0x9E3779B97F4A7C15 + b * 0xC2B2AE3D27D4EB4F + 0x165667B19E3779F9) & WORD
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & WORD
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & WORD
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


def settle_pair(p: float, s: int, q: float, t: int, u: float) -> tuple[float, float]:
    """Move words between fractions ``p`` of ``s`` words and ``q`` of ``t`` until one is 0 or 1."""
    room, stock = (1 - p) * s, q * t  # words that the first can take and the second give
    have, gap = p * s, (1 - q) * t  # and the other way round
    up, down = min(room, stock), min(have, gap)
    if u * (up + down) < down:
        ends = (1.0, (stock - up) / t) if room <= stock else ((have + up) / s, 0.0)
    else:
        ends = (0.0, q + down / t) if have <= gap else ((have - down) / s, 1.0)
    return tuple(0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x for x in ends)


def _rounded(batches):
    """Round rows that lie sorted by (leaf, source); open rows get no copies."""
    group, held = None, None
    for batch in batches:
        rows, out = batch.to_pylist(), []
        for row in rows:
            key = (row["leaf"], row["source"])
            if key != group:
                if held:
                    out.append(held)
                group, held = key, None
            if row["part"] <= 1e-12 or row["part"] >= 1 - 1e-12:
                out.append(row | {"copies": row["whole"] + round(row["part"])})
            elif not row["size"]:
                out.append(row | {"copies": row["whole"] + (chance(row["key"], 1) < row["part"])})
            elif held is None:
                held = row
            else:
                p, q = settle_pair(held["part"], held["size"], row["part"], row["size"], chance(held["key"], row["key"]))
                held, row = held | {"part": p}, row | {"part": q}
                for x in (held, row):
                    if x["part"] in (0.0, 1.0):
                        out.append(x | {"copies": x["whole"] + int(x["part"])})
                held = next((x for x in (held, row) if x["part"] not in (0.0, 1.0)), None)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=batch.schema)
    if held:
        yield pa.RecordBatch.from_pylist([held], schema=batch.schema)


def copies(slim: DataFrame, aims: DataFrame, rows: int) -> DataFrame:
    """``slim`` with source_size, target and ``copies`` of each document.

    ``slim`` has doc_id, source and size, and may have more; ``rows`` is its count.
    """
    own = slim.columns
    many = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    aimed = slim.join(aims, F.col("source").eqNullSafe(F.col("_source")), "left")
    bits = max(0, (rows // LEAF_ROWS).bit_length())
    key = F.xxhash64("doc_id", "source", "size", *[c for c in own if c not in ("doc_id", "source", "size")])
    level = (
        aimed.drop("_source").withColumn("whole", F.floor(many).cast("int"))
        .withColumn("part", many - F.col("whole"))
        .withColumn("key", key)
        .withColumn("leaf", F.expr(f"pmod(key, {1 << bits})"))
        .withColumn("copies", F.lit(None).cast("int"))
    )
    columns, done = [*own, "source_size", "target", "copies"], []
    while True:
        dealt = level.repartition("leaf", "source").sortWithinPartitions("leaf", "source", F.desc("size"), "key")
        level = settle(dealt.mapInArrow(_rounded, dealt.schema))
        done.append(level.where("copies is not null").select(*columns))
        level = level.where("copies is null")
        if not bits:
            break
        bits = max(0, bits - FAN_BITS)
        level = level.withColumn("leaf", F.expr(f"leaf div {1 << FAN_BITS}"))
    # the last one of each source: its own chance, from its hash
    own_chance = F.expr("pmod(xxhash64(key, 7), 1048576) / 1048576")
    last = level.withColumn("copies", F.col("whole") + (own_chance < F.col("part")).cast("int"))
    return reduce(DataFrame.unionByName, [*done, last.select(*columns)])


def mix(df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id", "source")) -> DataFrame:
    """Per document: ``keep``, size, source_size, target, copies and taken (words, repeats counted)."""
    slim = settle(sizes(df, text, list(keep)))
    aims = targets(slim).withColumnRenamed("source", "_source")
    mixed = copies(slim, settle(aims), slim.count())
    return mixed.withColumn("taken", F.col("copies").cast("bigint") * F.col("size"))
