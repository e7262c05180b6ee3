"""Dense ids in a stated order, without sorting a fact table in one task.

The one primitive is :func:`running_offset`: range-partition by the order, sort
inside the partitions, write that once to the shared folder, and add up the
partition sizes.  Only one row per partition ever meets in a single task.  The
written table pins the range borders, so a lost executor cannot change an id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.functions.cleaning import trim_text
from grantflow.operators.joins import null_safe_join
from grantflow.session import settle

# Rows of one group that one task may hold.
BLOCK = 65_536


def block_of(row_no: str, block: int) -> Column:
    """Number of the block a row number lies in (integer division)."""
    return F.expr(f"cast(`{row_no}` as bigint) div {block}")


def running_offset(
    df: DataFrame, order: Sequence[str], into: str = "offset", weight: str | None = None
) -> DataFrame:
    """Add the number of rows (or the sum of ``weight``) before each row.

    ``order`` must be a total order of the frame.  An empty order numbers the
    rows as they lie, without a shuffle.
    """
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = settle(df.withColumn("_slot", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_slot", 33))
    if weight is None:
        size = F.count(F.lit(1))
        inside = F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    else:
        size = F.sum(weight)
        before = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
        inside = F.coalesce(F.sum(weight).over(before), F.lit(0))
    sizes = placed.groupBy("_part").agg(size.alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # written down, so that its size is known and the rows need no shuffle to meet it
    starts = settle(sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start")))
    return (
        placed.withColumn("_inside", inside)
        .join(starts, "_part")
        .withColumn(into, (F.col("_start") + F.col("_inside")).cast("bigint"))
        .drop("_slot", "_part", "_start", "_inside")
    )


def first_seen_ids(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    into: str,
    stored: DataFrame | None = None,
    start: int = 1,
) -> DataFrame:
    """Dense ids for the distinct ``keys``, by first appearance in ``order``.

    Keys already in ``stored`` keep their ids and are left out; new ids continue
    after the largest stored one.  Returns ``keys`` and ``into`` for the new keys.
    """
    # a single number can be minimised in a hash aggregate, a struct needs a sort
    ranks = F.struct(*[F.col(c) for c in order])
    least = F.struct(F.min(order[0]).alias(order[0])) if len(order) == 1 else F.min(ranks)
    first = df.groupBy(*keys).agg(least.alias("_first"))
    if stored is not None:
        first = null_safe_join(first, stored.select(*keys).distinct(), keys, "left_anti")
    flat = first.select(*keys, *[F.col(f"_first.{c}").alias(f"_o_{c}") for c in order])
    placed = running_offset(flat, [*[f"_o_{c}" for c in order], *keys], "_before")
    return placed.select(*keys, (next_id(stored, into, start) + F.col("_before")).alias(into))


def _numbered(
    df: DataFrame, group: Sequence[str], order: Sequence[str], row_no: str, block: int
) -> DataFrame:
    """Add ``_place``: rows before this one by (group, order, row_no), and
    ``_group_start``: rows before its group.

    Rows are numbered inside blocks of ``block`` row numbers; the block counts,
    a far smaller table, get the running offset.  Null is a value like others
    and comes first.
    """
    keys = [*group, *order, "_block"]
    blocked = df.withColumn("_block", block_of(row_no, block))
    counts = blocked.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    offsets = running_offset(counts, keys, "_before", "_rows").drop("_rows")
    if group:
        starts = offsets.groupBy(*group).agg(F.min("_before").alias("_group_start"))
        offsets = null_safe_join(offsets, starts, list(group), "inner")
    else:
        offsets = offsets.withColumn("_group_start", F.lit(0).cast("bigint"))
    inside = Window.partitionBy(*keys).orderBy(row_no)
    return (
        null_safe_join(blocked, offsets, keys, "inner")
        .withColumn("_place", F.col("_before") + F.row_number().over(inside) - 1)
        .drop("_block", "_before")
    )


def next_id(stored: DataFrame | None, column: str, start: int = 1) -> Column:
    """First free id after the stored ones, as a scalar subquery."""
    base = F.lit(start).cast("bigint")
    if stored is None:
        return base
    return F.coalesce(stored.agg(F.max(column).cast("bigint")).scalar() + 1, base)


def serial_ids(
    df: DataFrame,
    order: Sequence[str],
    row_no: str,
    into: str,
    start: int = 1,
    stored: DataFrame | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """Number every row by (``order``, ``row_no``), after the stored ids.

    The input is read twice: settle one that is costly to compute.
    """
    placed = _numbered(df, [], order, row_no, block)
    return placed.withColumn(into, next_id(stored, into, start) + F.col("_place")).drop(
        "_place", "_group_start"
    )


def positions(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    row_no: str,
    into: str,
    block: int = BLOCK,
) -> DataFrame:
    """Dense position 0, 1, 2 ... of each row inside its group."""
    placed = _numbered(df, group, order, row_no, block)
    return placed.withColumn(into, F.col("_place") - F.col("_group_start")).drop(
        "_place", "_group_start"
    )


def loaded_ids(
    df: DataFrame, into: str, start: int = 1, stored: DataFrame | None = None
) -> DataFrame:
    """Number rows as they lie, after the stored ids: an auto-id column."""
    placed = running_offset(df, [], "_before")
    return placed.withColumn(into, next_id(stored, into, start) + F.col("_before")).drop("_before")


def file_ids(
    df: DataFrame, file: str, into: str, start: int = 1, stored: DataFrame | None = None
) -> DataFrame:
    """One id per file in listing order: (``file``, ``into``)."""
    placed = running_offset(df.select(file).distinct(), [file], "_before")
    return placed.select(file, (next_id(stored, into, start) + F.col("_before")).alias(into))


def stable_id(name: Column | str) -> Column:
    """Repeatable id of a name: md5 of the trimmed text."""
    return F.md5(trim_text(name))
