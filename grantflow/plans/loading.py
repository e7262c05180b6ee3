"""Loading finished tables, parents first, each one all or nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from grantflow.functions.dates import declared_cast
from grantflow.operators.joins import hot_join, new_rows
from grantflow.operators.load import conform, load_order
from grantflow.operators.numbering import loaded_ids
from grantflow.operators.rows import first_per_key
from grantflow.schemas import TABLES, TableSpec
from grantflow.session import letting_go, settled_for_now
from grantflow.sources.tables import Ledger, LoadRejected, bucket_masks, bucket_of, marked_buckets, publish, read_table

REJECTS_DDL = "source string, key string, rule string, text string"


def typed_keys(df: DataFrame, spec: TableSpec) -> dict[str, Column]:
    """The key columns in their declared types, as ``_key_*``."""
    kinds = {f.name: f.dataType for f in spec.schema.fields}
    return {f"_key_{k}": declared_cast(F.col(f"`{k}`"), kinds[k], df.schema[k].dataType) for k in spec.key}


def without_key(df: DataFrame, spec: TableSpec) -> Column:
    """Whether a row lacks a part of the key, or has one that does not fit its type."""
    return reduce(lambda a, b: a | b, [c.isNull() for c in typed_keys(df, spec).values()])


def rejected_rows(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows that cannot be stored for want of a key: source, key, rule, text."""
    return df.where(without_key(df, spec)).select(
        F.lit(spec.name).alias("source"),
        F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in spec.key]).alias("key"),
        F.lit("key").alias("rule"),
        F.to_json(F.struct("*")).alias("text"),
    )


def first_of_each_key(df: DataFrame, spec: TableSpec, order: Sequence[Column | str] = ()) -> DataFrame:
    """One row per key, with the key in its declared types beside it; rows without a key are left out."""
    keys = typed_keys(df, spec)
    ranks = list(order) or [F.col(f"`{c}`") for c in df.columns]
    return first_per_key(df.withColumns(keys).dropna(subset=list(keys)), list(keys), ranks)


def absent(first: DataFrame, stored: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of :func:`first_of_each_key` whose key is not stored; only stored keys are read."""
    keys = [f"_key_{k}" for k in spec.key]
    there = stored.select(*[F.col(f"`{k}`").alias(f"_key_{k}") for k in spec.key])
    return first.join(there, keys, "left_anti").drop(*keys)


def rows_to_load(
    df: DataFrame, stored: DataFrame | None, spec: TableSpec, order: Sequence[Column | str] = (), after: int | None = None
) -> DataFrame:
    """Rows of ``df`` the table lacks: one per key, if that key is not stored.

    Keys are compared in their declared types, and of the stored table only the
    key columns are read.  A table with an auto id that ``df`` does not bring is
    compared on all columns but the id and numbered after the stored rows (after
    ``after``, where the caller knows the largest id).  ``order`` decides which of
    several new rows with one key is kept; by default the smallest row.  Rows without
    a key are left out; see :func:`rejected_rows`.  Without ``stored`` the table is empty.
    """
    if spec.serial is not None and spec.serial not in df.columns:
        fresh = df if stored is None else new_rows(df, stored, [spec.serial])
        return loaded_ids(fresh, spec.serial, stored=stored) if after is None else loaded_ids(fresh, spec.serial, after + 1)
    first = first_of_each_key(df, spec, order)
    return first.drop(*typed_keys(df, spec)) if stored is None else absent(first, stored, spec)


def clashes(df: DataFrame, stored: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of rows whose given id is stored with other content."""
    own = conform(df.select(*[c for c in spec.columns if c in df.columns]), spec).select(
        *spec.key, F.struct(*[F.col(f"`{c}`") for c in spec.columns if c in df.columns]).alias("_new")
    )
    held = stored.select(
        *spec.key, F.struct(*[F.col(f"`{c}`") for c in spec.columns if c in df.columns]).alias("_old")
    )
    return hot_join(own, held, list(spec.key), "inner").where(~F.col("_new").eqNullSafe(F.col("_old"))).select(*spec.key)


def load_tables(
    frames: Mapping[str, DataFrame],
    root: str,
    run_id: str,
    orders: Mapping[str, Sequence[Column | str]] | None = None,
    check_parents: bool = True,
) -> dict[str, bool]:
    """Publish the frames under one run id; returns which tables were new.

    A run that stopped half way can be repeated with its run id: published
    tables are left alone, the others are written again.  Rows without a key are
    written under ``root/rejects`` before the table's rows become visible.  A given
    serial id that is stored with other content raises :class:`LoadRejected`.

    Where rows are stored already, the new ones are written once, so that their buckets
    are known: of the stored table only these are opened.
    """
    specs = load_order(list(frames))
    above = {s.name: {p for p, _ in s.parents.values()} if check_parents else set() for s in specs}
    done, known = {}, None
    for spec in specs:
        df = frames[spec.name]
        spark = df.sparkSession
        known = known or Ledger(spark, root, *{t for s in specs for t in (s.name, *above[s.name])})
        if known.is_published(spec.name, run_id):
            done[spec.name] = False
            continue
        parents = {p: read_table(spark, root, TABLES[p], known) for p in above[spec.name]}
        order = (orders or {}).get(spec.name, ())
        # what one table needs on the way is not kept for the next ones
        with letting_go(spark):
            if all(k in df.columns for k in spec.key):
                done[spec.name] = _load_keyed(df, root, spec, run_id, order, parents, known)
            else:
                after = known.largest_key(spec.name) or 0
                stored = read_table(spark, root, spec, known) if known.visible_runs(spec.name) else None
                fresh = rows_to_load(df, stored, spec, order, after)
                done[spec.name] = publish(fresh, root, spec, run_id, parents, known)
    return done


def _load_keyed(
    df: DataFrame, root: str, spec: TableSpec, run_id: str, order: Sequence[Column | str], parents: Mapping[str, DataFrame], known: Ledger
) -> bool:
    """One table whose rows bring their key."""
    lacks, seen = Observation(f"{spec.name} {run_id} lacks"), Observation(f"{spec.name} {run_id} keys")
    lacking = F.coalesce(F.sum(without_key(df, spec).cast("bigint")), F.lit(0)).alias("rejected")
    first = first_of_each_key(df.observe(lacks, lacking), spec, order)

    def tell() -> None:
        try:
            some = lacks.get["rejected"]
        except Py4JJavaError:  # Spark left the step and its count out, as no row came out of it
            some = not rejected_rows(df, spec).isEmpty()
        if some:
            write_rejects(rejected_rows(df, spec), root, spec.name, run_id)

    if not known.visible_runs(spec.name):
        return publish(first.drop(*typed_keys(df, spec)), root, spec, run_id, parents, known, tell)
    bucket = bucket_of(spec, {k: F.col(f"`_key_{k}`") for k in spec.key})
    with settled_for_now(first.observe(seen, *bucket_masks(spec, bucket))) as rows:
        stored = read_table(df.sparkSession, root, spec, known, buckets=marked_buckets(spec, seen.get))
        if spec.serial in df.columns:
            wrong = clashes(rows, stored, spec).take(5)
            if wrong:
                raise LoadRejected(f"{spec.name}, run {run_id}: ids stored with other content, {wrong}")
        return publish(absent(rows, stored, spec), root, spec, run_id, parents, known, tell)


def write_rejects(rejects: DataFrame, root: str, name: str, run_id: str) -> None:
    rejects.write.mode("overwrite").parquet(f"{root}/rejects/table_name={name}/run_id={run_id}")


def read_rejects(spark, root: str) -> DataFrame:
    """Rejected rows of all loads, with table_name and run_id."""
    return spark.read.schema(f"{REJECTS_DDL}, table_name string, run_id string").parquet(f"{root}/rejects")
