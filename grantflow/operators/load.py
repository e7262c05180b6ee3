"""Conforming to a declared table, constraint checks and keyed insertion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.functions.dates import declared_cast
from grantflow.operators.rows import first_per_key
from grantflow.schemas import TABLES, TableSpec

VIOLATIONS_DDL = "table_name string, column_name string, rule string, row_key string"


def insert_if_absent(
    new: DataFrame, stored: DataFrame, key: Sequence[str], order: Sequence[Column | str]
) -> DataFrame:
    """Rows to append: the first new row of each key that is not stored."""
    unique = first_per_key(new, key, order)
    return unique.join(stored.select(*key).distinct(), list(key), "left_anti")


def apply_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fill nulls with the declared defaults of the table."""
    known = {c: v for c, v in spec.defaults.items() if c in df.columns}
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in known.items()}) if known else df


def cast_once(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of another type beside themselves in the declared one (``_cast_*``).

    :func:`conform` and the rule tests take them from there instead of casting again.
    """
    kinds = {f.name: f.dataType for f in spec.schema.fields if f.name in df.columns and not isinstance(f.dataType, T.StringType)}
    return df.withColumns({f"_cast_{c}": _declared(df, c, kind) for c, kind in kinds.items() if df.schema[c].dataType != kind})


def _declared(df: DataFrame, name: str, kind: T.DataType) -> Column:
    if f"_cast_{name}" in df.columns:
        return F.col(f"`_cast_{name}`")
    return declared_cast(F.col(f"`{name}`"), kind, df.schema[name].dataType)


def conform(df: DataFrame, spec: TableSpec, keep: Sequence[str] = ()) -> DataFrame:
    """Cast to the declared columns, in order; absent columns become null."""
    return df.select(
        *[
            (_declared(df, f.name, f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in spec.schema.fields
        ],
        *keep,
    )


def row_key(spec: TableSpec) -> Column:
    return F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in spec.key])


def _rule_tests(df: DataFrame, spec: TableSpec) -> list[tuple[str, str, Column]]:
    """Column, rule and the test that tells whether a row breaks it."""
    tests = []
    for f in spec.schema.fields:
        if f.name not in df.columns:
            if f.name in spec.required:
                tests.append((f.name, "required", F.lit(True)))
            continue
        column = F.col(f"`{f.name}`")
        given = df.schema[f.name].dataType
        if given != f.dataType and not isinstance(f.dataType, T.StringType):
            tests.append((f.name, "type", column.isNotNull() & _declared(df, f.name, f.dataType).isNull()))
        if f.name in spec.lengths:
            tests.append((f.name, "length", F.length(column.cast("string")) > spec.lengths[f.name]))
        if f.name in spec.required or (f.name in spec.key and f.name != spec.serial):
            tests.append((f.name, "required", column.isNull()))
    return tests


def breaks_rules(df: DataFrame, spec: TableSpec) -> Column:
    """Whether a row breaks any rule, without naming it."""
    return F.coalesce(reduce(lambda a, b: a | b, [test for _, _, test in _rule_tests(df, spec)], F.lit(False)), F.lit(False))


def broken_rules(df: DataFrame, spec: TableSpec) -> Column:
    """Array of (column, rule) a row breaks: type, length, required."""
    found = [
        F.when(test, F.struct(F.lit(name).alias("column_name"), F.lit(rule).alias("rule")))
        for name, rule, test in _rule_tests(df, spec)
    ]
    if not found:
        return F.array().cast("array<struct<column_name:string,rule:string>>")
    return F.array_compact(F.array(*found))


def violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row per broken type, length or required rule."""
    return (
        df.select(row_key(spec).alias("row_key"), F.explode(broken_rules(df, spec)).alias("_broken"))
        .select(F.lit(spec.name).alias("table_name"), "_broken.column_name", "_broken.rule", "row_key")
    )


def key_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that occur more than once."""
    return (
        df.groupBy(*spec.key)
        .count()
        .where("count > 1")
        .select(
            F.lit(spec.name).alias("table_name"),
            F.lit(",".join(spec.key)).alias("column_name"),
            F.lit("primary key").alias("rule"),
            row_key(spec).alias("row_key"),
        )
    )


def reference_violations(
    df: DataFrame, spec: TableSpec, stored: Mapping[str, DataFrame]
) -> DataFrame:
    """Foreign key values without a parent row; ``row_key`` is the missing value.

    Child values are made distinct before the anti join, so a value that a third
    of the rows share crosses the shuffle once per task.
    """
    found = []
    for column, (parent, parent_column) in spec.parents.items():
        if parent not in stored or column not in df.columns:
            continue
        values = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_value")).distinct()
        known = stored[parent].select(F.col(parent_column).alias("_value")).distinct()
        found.append(
            values.join(known, "_value", "left_anti").select(
                F.lit(spec.name).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit("foreign key").alias("rule"),
                F.col("_value").cast("string").alias("row_key"),
            )
        )
    if not found:
        return df.sparkSession.createDataFrame([], VIOLATIONS_DDL)
    return reduce(lambda a, b: a.unionByName(b), found)


def add_column(df: DataFrame, name: str, kind: str) -> DataFrame:
    """Add a null column of the given type."""
    if name in df.columns:
        raise ValueError(f"column {name} exists")
    return df.withColumn(name, F.lit(None).cast(kind))


def emptied(df: DataFrame) -> DataFrame:
    """The frame without rows: what a truncated table holds."""
    return df.limit(0)


def children(name: str) -> list[str]:
    """Tables that refer to ``name``, directly or through others, in load order."""
    found = {name}
    for spec in TABLES.values():
        if any(parent in found for parent, _ in spec.parents.values()):
            found.add(spec.name)
    return [t for t in TABLES if t in found and t != name]


def load_order(names: Sequence[str]) -> list[TableSpec]:
    """Specs of ``names``, parents first."""
    return [TABLES[t] for t in TABLES if t in set(names)]
