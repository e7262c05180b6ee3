"""Operators that follow row order inside a document or file.

Every one takes the group (document, file; never null) and an explicit integer
row number, which should be nearly dense: a line or row count, not a time stamp.
A group may hold any share of all rows, so windows run over blocks of ``block``
row numbers and the little that crosses a block border travels as a small table
(carry-down) or as copied border rows (neighbours).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.fixed_values import CONTINUATION_NAMES
from grantflow.functions.cleaning import is_grant_id, trim_text
from grantflow.operators.joins import hot_join
from grantflow.operators.numbering import BLOCK, block_of, running_offset
from grantflow.session import settle


def carry_down(
    df: DataFrame,
    group: Sequence[str],
    row_no: str,
    value: Column,
    into: str,
    block: int = BLOCK,
) -> DataFrame:
    """Last non-null ``value`` at or above each row of the group.

    The input is read more than once: settle one that is costly to compute.
    """
    blocked = df.withColumns(
        {"_value": value, "_block": block_of(row_no, block)}
    )
    keys = [*group, "_block"]
    lasts = blocked.where(F.col("_value").isNotNull()).groupBy(*keys).agg(
        F.max_by("_value", row_no).alias("_last")
    )
    above = (
        Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = blocked.select(*keys).distinct().join(lasts, keys, "left").select(
        *group, "_block", F.last("_last", ignorenulls=True).over(above).alias("_carried")
    ).where(F.col("_carried").isNotNull())
    inside = (
        Window.partitionBy(*group, "_block").orderBy(row_no).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        blocked.join(carried, keys, "left")
        .withColumn(into, F.coalesce(F.last("_value", ignorenulls=True).over(inside), "_carried"))
        .drop("_value", "_block", "_carried")
    )


def forward_fill(
    df: DataFrame, group: Sequence[str], row_no: str, column: str, block: int = BLOCK
) -> DataFrame:
    """Fill nulls of ``column`` with the last value above."""
    return carry_down(df, group, row_no, F.col(f"`{column}`"), column, block)


def repair_wrapped(
    df: DataFrame,
    group: Sequence[str],
    row_no: str,
    name: str,
    fragments: Sequence[str] = tuple(CONTINUATION_NAMES),
    passes: int = 3,
    block: int = BLOCK,
) -> DataFrame:
    """Append continuation fragments to the row above and clear them.

    Per pass: a row that is not the first of its group and whose trimmed name is
    in ``fragments`` joins the row above.  A fragment climbs one row per pass, so
    a row needs the ``passes`` rows below it: the first rows of a block are
    copied into the block before.  Row numbers must run 0, 1, 2 ... per group;
    a gap fails the job.
    """
    number = F.col(row_no)
    home = block_of(row_no, block)
    to_before = (number % block < passes) & (number >= block)
    copies = F.when(
        to_before,
        F.array(F.struct(home.alias("b"), F.lit(True).alias("own")),
                F.struct((home - 1).alias("b"), F.lit(False).alias("own"))),
    ).otherwise(F.array(F.struct(home.alias("b"), F.lit(True).alias("own"))))
    spread = df.withColumn("_copy", F.explode(copies)).select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_copy.b").alias("_block"),
        F.col("_copy.own").alias("_own"),
    )
    window = Window.partitionBy(*group, "_block").orderBy(row_no)
    above = F.lag(row_no).over(window)
    starts = number % block == 0
    gap = F.when(above.isNull(), ~(F.col("_own") & starts)).otherwise(above != number - 1)
    checked = spread.withColumn(
        "_first",
        F.when(gap, F.raise_error(F.lit(f"{row_no} must run without gaps from 0"))).otherwise(
            number == 0
        ),
    ).withColumn("_text", F.coalesce(F.col(f"`{name}`"), F.lit("")))
    for _ in range(passes):
        trimmed = trim_text("_text")
        moved = ~F.col("_first") & trimmed.isin(*fragments)
        marked = checked.withColumns({"_trim": trimmed, "_moved": moved})
        base = F.when(F.col("_moved"), F.lit("")).otherwise(F.col("_text"))
        joined = F.concat_ws(" ", trim_text(base), F.lead("_trim").over(window))
        checked = marked.withColumn(
            "_text", F.when(F.lead("_moved").over(window), joined).otherwise(base)
        )
    return (
        checked.where("_own")
        .withColumn(name, F.col("_text"))
        .select(*[F.col(f"`{c}`") for c in df.columns])
    )


def fold_name_only(
    df: DataFrame,
    group: Sequence[str],
    row_no: str,
    name: str,
    others: Sequence[str],
    block: int = BLOCK,
) -> DataFrame:
    """Append rows that hold only a name to the last full row above, drop them.

    The first row of a group (row number 0) is never folded; rows without a name
    are dropped.
    """
    full = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNotNull() for c in others])
    anchor = full | (F.col(row_no) == 0)
    tied = settle(carry_down(df, group, row_no, F.when(anchor, F.col(row_no)), "_anchor", block))
    folded = (
        tied.where((F.col(row_no) != F.col("_anchor")) & F.col(f"`{name}`").isNotNull())
        .groupBy(*group, "_anchor")
        .agg(F.expr(f"listagg(`{name}`, ' ') within group (order by `{row_no}`)").alias("_more"))
        .withColumnRenamed("_anchor", row_no)
    )
    kept = tied.where(F.col(row_no) == F.col("_anchor")).drop("_anchor")
    return (
        kept.join(folded, [*group, row_no], "left")
        .withColumn(
            name,
            F.when(F.col("_more").isNotNull(), F.concat_ws(" ", F.col(f"`{name}`"), "_more")).otherwise(
                F.col(f"`{name}`")
            ),
        )
        .where(F.col(f"`{name}`").isNotNull())
        .drop("_more")
    )


def split_header_detail(
    df: DataFrame,
    group: Sequence[str],
    row_no: str,
    field: str,
    start: int | Column = 1,
    chained: bool = True,
    detail: Column | None = None,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Split rows into headers and details (rows whose ``field`` is a grant id).

    Headers get a dense id per distinct text and group, by first appearance;
    every header row is returned, repeats with the same id.  A detail row takes
    the id of the header above it; one above all headers is dropped.  With
    ``chained`` the ids of a group start after those of the group before it,
    else each group starts at ``start``.

    Both frames carry ``description_id`` and ``description``.
    """
    test = is_grant_id(F.coalesce(F.col(field), F.lit(""))) if detail is None else detail
    header = F.when(~test, trim_text(F.coalesce(F.col(field), F.lit(""))))
    tied = settle(
        carry_down(df.withColumn("_detail", test), group, row_no, header, "description", block)
    )
    first = (
        tied.where(~F.col("_detail"))
        .groupBy(*group, "description")
        .agg(F.min(row_no).alias("_first"))
    )
    placed = running_offset(first, [*group, "_first"], "_before")
    if not chained:
        floor = placed.groupBy(*group).agg(F.min("_before").alias("_floor"))
        placed = placed.join(floor, list(group)).withColumn(
            "_before", F.col("_before") - F.col("_floor")
        )
    ids = placed.select(
        *group, "description", (F.col("_before") + start).cast("bigint").alias("description_id")
    )
    known = hot_join(
        tied.where(F.col("description").isNotNull()), ids, [*group, "description"], "inner"
    )
    return (
        known.where(~F.col("_detail")).drop("_detail"),
        known.where("_detail").drop("_detail"),
    )
