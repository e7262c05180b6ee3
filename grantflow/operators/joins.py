"""Joins, lookups and differences.

No join here carries a broadcast hint except the one against the fixed list of
states: Spark and AQE pick a broadcast from the measured size of a side.

A key may hold a third of all rows.  On the right side repeats are removed first
(partial aggregation in the map tasks).  On the left side AQE splits the hot
partition, which it does only where both sides are shuffled for the join itself;
:func:`hot_join` sees to that.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.fixed_values import STATES
from grantflow.functions.cleaning import trim_text
from grantflow.functions.dates import declared_cast


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join where null meets null; keeps the left copy of the keys."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys]
    )
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_anti", "left_semi") else joined.drop(*[f"_r_{k}" for k in keys])


def hot_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi join on shared names whose left side may have hot keys.

    The right side often comes from an aggregate over the same keys.  Its
    partitioning would then be reused, and AQE does not split a join fed that
    way.  A hash among the keys makes the join shuffle both sides anew.
    """
    key_hash = F.xxhash64(*[F.col(f"`{k}`") for k in keys])
    return (
        left.withColumn("_key_hash", key_hash)
        .join(right.withColumn("_key_hash", key_hash), ["_key_hash", *keys], how)
        .drop("_key_hash")
    )


def enrich(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] | dict[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """Left join that brings ``columns`` of the right side; null keys never match.

    ``on`` lists shared key names, or maps left names to right names.  The right
    key column is not kept; a column brought replaces one of the same name.
    """
    pairs = on if isinstance(on, dict) else {k: k for k in on}
    slim = right.select(
        *[F.col(f"`{r}`").alias(l) for l, r in pairs.items()], *[F.col(f"`{c}`") for c in columns]
    )
    own = [c for c in left.columns if c not in columns]
    order = [F.col(f"`{c}`") for c in (*own, *columns)]
    return hot_join(left.select(*order[: len(own)]), slim, list(pairs), "left").select(*order)


def full_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join with coalesced keys; null keys match nothing and stay.

    A full join is never split by AQE.  A left join and the right rows without a
    partner are, so a hot key ends in no single task.
    """
    others = [f for f in right.schema.fields if f.name not in on]
    met = hot_join(left, right, on, "left")
    alone = keep_absent(right, left, on)
    columns = {c: (F.col(f"`{c}`") if c in on else F.lit(None).cast(left.schema[c].dataType)).alias(c) for c in met.columns[: len(left.columns)]}
    return met.union(alone.select(*columns.values(), *[F.col(f"`{f.name}`") for f in others]))


def keep_present(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``other`` (null matches nothing)."""
    return hot_join(df, other.select(*keys).distinct(), keys, "left_semi")


def keep_absent(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return hot_join(df, other.select(*keys).distinct(), keys, "left_anti")


def new_rows(new: DataFrame, stored: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` not stored yet, compared on all shared columns.

    Null equals null and repeated new rows all stay.  Both sides are compared in
    the stored column's type.  The join keys are a 64-bit hash of the row, so
    sorting a wide table compares one long, and the row itself as a struct, in
    which null equals null.
    """
    shared = [f for f in stored.schema.fields if f.name in new.columns and f.name not in ignore]
    if not shared:
        raise ValueError("the two frames share no column to compare")
    own = [
        declared_cast(F.col(f"`{f.name}`"), f.dataType, new.schema[f.name].dataType).alias(f.name)
        for f in shared
    ]
    # a value that does not fit the stored type cannot be stored: a new row
    misfits = [
        F.col(f"`{f.name}`").isNotNull() & c.isNull() for f, c in zip(shared, own, strict=True)
    ]
    left = new.withColumns(
        {
            "_hash": F.when(~reduce(lambda a, b: a | b, misfits), F.xxhash64(*own)),
            "_values": F.struct(*own),
        }
    )
    there = [F.col(f"`{f.name}`") for f in shared]
    right = (
        stored.select(F.struct(*there).alias("_values"))
        .distinct()
        .withColumn("_hash", F.xxhash64(*[F.col(f"_values.`{f.name}`") for f in shared]))
    )
    # columns that need no cast come back out of the struct, so they are shuffled once
    kinds = {f.name: f.dataType for f in shared}
    back = [
        F.col(f"_values.`{c}`").alias(c) if kinds.get(c) == new.schema[c].dataType else F.col(f"`{c}`")
        for c in new.columns
    ]
    return left.join(right, ["_hash", "_values"], "left_anti").select(*back)


def last_wins(table: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """One row per key: the value with the highest ``order``."""
    return table.groupBy(key).agg(F.max_by(F.col(f"`{value}`"), order).alias(value))


def lookup(
    df: DataFrame, column: str, table: DataFrame, key: str, value: str, order: str, into: str
) -> DataFrame:
    """Map ``column`` through a lookup table; the last of repeated keys wins, misses are null."""
    slim = last_wins(table.select(key, value, order), key, value, order).select(
        F.col(f"`{key}`").alias("_lookup_key"), F.col(f"`{value}`").alias(into)
    )
    return enrich(df, slim, {column: "_lookup_key"}, [into])


def state_table(df: DataFrame) -> DataFrame:
    """Names and codes of the states, lower case, with the two-letter code.

    Twice the fixed list of states: a proven bound, so it may be broadcast.
    """
    rows = [(name.lower(), code) for name, code in STATES.items()]
    rows += [(code.lower(), code) for code in STATES.values()]
    return df.sparkSession.createDataFrame(rows, "_state string, _abbr string")


def state_code(df: DataFrame, column: str, into: str, names: DataFrame | None = None) -> DataFrame:
    """State name (or code, any case) -> two-letter code; other text stays.

    ``names`` may bring another list of (``_state`` in lower case, ``_abbr``).
    """
    small = F.broadcast(state_table(df)) if names is None else names
    joined = df.join(small, F.lower(trim_text(column)) == F.col("_state"), "left")
    return joined.withColumn(into, F.coalesce("_abbr", F.col(f"`{column}`"))).drop("_state", "_abbr")


def drop_prefixed(
    links: DataFrame, key: str, listing: DataFrame, path: str, suffix: str
) -> DataFrame:
    """Links whose key is no prefix of any listed path.

    Keys end with ``suffix``, so the prefixes of a path that can equal a key are
    those ending at an occurrence of ``suffix``: the prefix test becomes an equi
    anti join on (almost always one) prefix per path.
    """
    piece = F.split(F.col(path), F.concat(F.lit("\\Q"), F.lit(suffix), F.lit("\\E")), -1)
    cuts = F.transform(
        F.sequence(F.lit(1), F.size("_pieces") - 1),
        lambda i: F.concat(F.array_join(F.slice("_pieces", 1, i), suffix), F.lit(suffix)),
    )
    prefixes = (
        listing.select(piece.alias("_pieces"))
        .where(F.size("_pieces") > 1)
        .select(F.explode(cuts).alias(key))
    )
    return keep_absent(links, prefixes, [key])
