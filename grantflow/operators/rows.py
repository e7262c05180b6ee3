"""Distinct, first-wins, stacking, filters and small aggregates."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def stack(frames: Sequence[DataFrame], fill_missing: bool = False) -> DataFrame:
    """Union by name; ``fill_missing`` adds absent columns as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=fill_missing), frames)


def stack_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return stack(frames).dropDuplicates()


def stack_roles(df: DataFrame, roles: Sequence[dict[str, str]]) -> DataFrame:
    """Stack projections of one frame (source column -> target column) in one scan."""
    rows = [
        F.struct(*[F.col(f"`{src}`").alias(dst) for src, dst in role.items()]) for role in roles
    ]
    return df.select(F.explode(F.array(*rows)).alias("_role")).select("_role.*")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key (null is a key) in the given total order.

    ``row_number() = 1`` keeps one row per key and map task before the shuffle.
    """
    if not order:
        raise ValueError("first_per_key needs an order")
    window = Window.partitionBy(*[F.col(f"`{k}`") for k in keys]).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def next_id(table: DataFrame, column: str) -> DataFrame:
    """One row ``next_id``: the largest id plus one, or 1 when the table is empty."""
    return table.agg((F.coalesce(F.max(column), F.lit(0)) + 1).cast("bigint").alias("next_id"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls per column."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Drop every column that holds a null (one aggregate pass, one row to the driver)."""
    counts = null_counts(df).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not counts[c]])


def blocks_of(
    df: DataFrame, keys: Sequence[str], order: str, value: str, block: int, into: str
) -> DataFrame:
    """Collect ``value`` per key as ordered arrays of at most ``block`` entries.

    ``order`` is a unique integer; entries of one array lie in one range of
    ``block`` order numbers, so no array grows with a hot key.
    """
    pair = F.struct(F.col(order).alias("o"), F.col(value).alias("v"))
    return (
        df.groupBy(*keys, F.expr(f"cast(`{order}` as bigint) div {block}").alias("block_no"))
        .agg(F.array_sort(F.collect_list(pair)).alias("_pairs"))
        .select(*keys, "block_no", F.transform("_pairs", lambda p: p["v"]).alias(into))
    )


# Rows of a stretch of an order that are sorted to find a page in it.
FEW = 100_000


def page(df: DataFrame, order: Sequence[str], number: int, size: int, few: int = FEW) -> DataFrame:
    """Page ``number`` (from 1) of ``size`` rows by ``order``: column names, with `` desc``
    behind those that fall; they should end in a unique key.

    The rows before the page are counted, not sorted: see :class:`Seek`.  Sorted are the
    page and at most ``few`` rows on either side that lie closest.
    """
    seek, first = Seek(df, order, few), (number - 1) * size
    low = seek.locate(first)
    if low is None:
        return df.limit(0)
    high = seek.locate(first + size - 1)
    kept = df.where(low.at_or_behind) if high is None else df.where(low.at_or_behind & high.up_to)
    return kept.orderBy(*seek.sort).offset(first - low.before).limit(size)


@dataclass
class Place:
    """A stretch of an order that holds a position: the rows before it, and its two ends."""

    before: int
    at_or_behind: Column
    up_to: Column


class Seek:
    """Selection of positions in a large order by counts of ranges.

    Key by key, some values of the key, ``RANGES`` or so with the least and the largest, cut
    the rows that can still hold the position: into the rows of each such value and those
    between two of them.  All are counted in one pass with partial sums.  What lies
    between two values is cut again while it has more than ``few`` rows; among the rows of
    one value the next key decides.  So neither a large table nor a value that most rows
    share meets in one task; a pass brings some hundred numbers to the driver.
    """

    RANGES = 64

    def __init__(self, df: DataFrame, order: Sequence[str], few: int):
        self.df, self.few = df, few
        self.keys = [(o.removesuffix(" desc"), not o.endswith(" desc")) for o in order]
        self.sort = [F.asc(f"`{c}`") if up else F.desc(f"`{c}`") for c, up in self.keys]

    def _is(self, k: int, value) -> Column:
        name = self.keys[k][0]
        return F.col(f"`{name}`").eqNullSafe(F.lit(value).cast(self.df.schema[name].dataType))

    def _behind(self, k: int, value, at: bool = False) -> Column:
        """Whether key ``k`` lies behind ``value``, or ``at`` it; null is the least value."""
        name, up = self.keys[k]
        column, bound = F.col(f"`{name}`"), F.lit(value).cast(self.df.schema[name].dataType)
        if value is None:
            found = column.isNotNull() if up else F.lit(False)
        else:
            found = F.coalesce(column > bound, F.lit(False)) if up else column.isNull() | (column < bound)
        return found | self._is(k, value) if at else found

    def _all_behind(self, fixed: Sequence, k: int, value, at: bool = False) -> Column:
        """Whether a row lies behind (or at) the ``fixed`` values of the keys before and ``value``."""
        found = self._behind(k, value, at)
        for j in reversed(range(k)):
            found = self._behind(j, fixed[j]) | (self._is(j, fixed[j]) & found)
        return found

    def _cuts(self, rows: DataFrame, k: int, many: int) -> list:
        """Some values of key ``k`` in their order, the first and the last among them."""
        name, up = self.keys[k]
        column = F.col(f"`{name}`")
        some = rows.where(F.rand(17) < 20 * self.RANGES / many).select(column.alias("v")).distinct().limit(40 * self.RANGES)
        ends = rows.agg(F.min(column).alias("least"), F.max(column).alias("most"), F.count_if(column.isNull()).alias("none")).first()
        drawn = sorted({r.v for r in some.collect()} - {None})
        values = sorted({*drawn[:: max(1, len(drawn) // self.RANGES)], ends.least, ends.most} - {None}) if ends.most is not None else []
        values = [None] * bool(ends.none) + values
        return values if up else values[::-1]

    def locate(self, position: int) -> Place | None:
        """The stretch that holds a position (from 0); None where the rows end before it."""
        rows, many, before, fixed, k = self.df, self.df.count(), 0, [], 0
        place = Place(0, F.lit(True), F.lit(True))
        if position >= many:
            return None
        while many > self.few and k < len(self.keys):
            cuts = self._cuts(rows, k, many)
            # odd: at a value; even: behind it and before the next
            number = reduce(lambda a, b: a + b, [self._behind(k, c, at).cast("int") for c in cuts for at in (True, False)])
            counted = rows.groupBy(number.alias("number")).agg(F.count(F.lit(1)).alias("n")).collect()
            for found in sorted(counted, key=lambda r: r.number):
                if before + found.n > position:
                    break
                before += found.n
            many, value = found.n, cuts[(found.number - 1) // 2]
            if found.number % 2:
                place = Place(before, self._all_behind(fixed, k, value, True), ~self._all_behind(fixed, k, value))
                rows, fixed, k = rows.where(self._is(k, value)), [*fixed, value], k + 1
            else:
                end = cuts[found.number // 2]
                place = Place(before, self._all_behind(fixed, k, value), ~self._all_behind(fixed, k, end, True))
                rows = rows.where(self._behind(k, value) & ~self._behind(k, end, True))
        return place


def search(
    df: DataFrame,
    dates: tuple[str, str, str] | None = None,
    any_of: dict[str, Sequence[object]] | None = None,
    equal: dict[str, object] | None = None,
) -> DataFrame:
    """Award search: date range (column, first, last), IN lists and equalities."""
    tests = []
    if dates:
        column, first, last = dates
        tests.append(F.col(f"`{column}`").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    tests += [F.col(f"`{c}`").isin(list(v)) for c, v in (any_of or {}).items()]
    tests += [F.col(f"`{c}`") == F.lit(v) for c, v in (equal or {}).items()]
    return df.where(reduce(lambda a, b: a & b, tests)) if tests else df
