"""Stored tables: Parquet run folders made visible by a ledger.

A load writes ``root/table/run_id=...``, is checked there, and only then gets
its ledger row.  Readers see the runs of the ledger and nothing else, so a
failed or half-written load never shows.  No rename is needed, which suits
object stores.  Whatever changes what is visible - a load, a truncation with all
tables it reaches, a compaction - is one small file of the ledger, so a stop leaves
the state before or after it, and every step can be repeated with its run id.

Inside a run rows lie in folders by a hash of their key (``_bucket``).  A load whose
keys fall into a few buckets opens those of the stored table only.  The ledger row has
the least and largest key of the run where the key is one whole number: the next id
comes from there, and runs whose keys cannot meet those of a load are not opened.

A store is made once by :func:`create_store`; a root without a ledger is an error,
so a mistyped path never loads everything as new.  A load reads the ledger rows of the
tables it touches; their number is that of the loads of these tables.  One writer may
load into a store at a time: ids and ledger numbers continue after the largest ones read.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.operators.load import (
    apply_defaults,
    breaks_rules,
    broken_rules,
    cast_once,
    children,
    conform,
    key_violations,
    reference_violations,
    row_key,
)
from grantflow.schemas import TABLES, TableSpec

LEDGER_DDL = "table_name string, run_id string, action string, seq bigint, n_rows bigint, least bigint, largest bigint"
BUCKET = "_bucket"


class LoadRejected(ValueError):
    """A load broke rules of its table; nothing of it became visible."""


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, asked of its file system."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def create_store(spark: SparkSession, root: str) -> str:
    """Make an empty store; returns its root.  Does nothing where one is."""
    if not exists(spark, f"{root}/ledger"):
        spark.createDataFrame([], LEDGER_DDL).write.parquet(f"{root}/ledger")
    return root


class Ledger:
    """The loads of some tables of a store (of all, if none is named), kept up to date by this writer.

    Actions: ``load`` adds a run, ``replace`` hides all others, ``truncate`` hides all.
    """

    def __init__(self, spark: SparkSession, root: str, *tables: str):
        if not exists(spark, f"{root}/ledger"):
            raise FileNotFoundError(f"no store at {root}: create_store makes one")
        self.spark, self.root = spark, root
        written = spark.read.schema(LEDGER_DDL).parquet(f"{root}/ledger")
        if tables:
            written = written.where(F.col("table_name").isin(*tables))
        self.notes = sorted(written.collect(), key=lambda note: note.seq)

    def _visible(self, table: str) -> list[Row]:
        notes: list[Row] = []
        for note in self.notes:
            if note.table_name == table:
                notes = {"load": [*notes, note], "replace": [note]}.get(note.action, [])
        return notes

    def visible_runs(self, table: str, span: tuple[int, int] | None = None) -> list[str]:
        """Published runs since the last truncation; with ``span``, those whose keys may lie in it."""
        return [
            n.run_id for n in self._visible(table)
            if span is None or n.least is None or (n.least <= span[1] and n.largest >= span[0])
        ]

    def largest_key(self, table: str) -> int | None:
        """The largest key of a table whose key is one whole number; None without rows."""
        return max((n.largest for n in self._visible(table) if n.largest is not None), default=None)

    def is_published(self, table: str, run_id: str) -> bool:
        return any((n.table_name, n.run_id) == (table, run_id) and n.action != "truncate" for n in self.notes)

    def add(
        self, tables: Sequence[str], run_id: str, action: str, n_rows: int = 0, least: int | None = None, largest: int | None = None
    ) -> None:
        """One note for each table, all in one file: they become visible together."""
        seq = max((note.seq for note in self.notes), default=0)
        notes = [
            Row(table_name=t, run_id=run_id, action=action, seq=seq + k, n_rows=n_rows, least=least, largest=largest)
            for k, t in enumerate(tables, 1)
        ]
        rows = self.spark.createDataFrame([tuple(n) for n in notes], LEDGER_DDL).coalesce(1)
        rows.write.mode("append").parquet(f"{self.root}/ledger")
        self.notes += notes


def bucket_of(spec: TableSpec, keys: Mapping[str, Column] | None = None) -> Column:
    """The bucket of a row by its key columns, which must have their declared types."""
    columns = [keys[k] if keys else F.col(f"`{k}`") for k in spec.key]
    return F.pmod(F.xxhash64(*columns), F.lit(spec.buckets)).cast("int")


def bucket_masks(spec: TableSpec, bucket: Column) -> list[Column]:
    """Aggregates that tell which buckets have rows, 64 buckets in each."""
    word, bit = F.shiftright(bucket, 6), F.expr("1L")
    return [
        F.coalesce(F.bit_or(F.when(word == k, F.call_function("shiftleft", bit, bucket % 64))), F.lit(0).cast("bigint")).alias(f"mask_{k}")
        for k in range(-(-spec.buckets // 64))
    ]


def marked_buckets(spec: TableSpec, seen: Mapping[str, int]) -> list[int]:
    """The buckets that :func:`bucket_masks` has found."""
    return [b for b in range(spec.buckets) if seen[f"mask_{b // 64}"] >> (b % 64) & 1]


def _has_span(spec: TableSpec) -> bool:
    kinds = {f.name: f.dataType for f in spec.schema.fields}
    return len(spec.key) == 1 and isinstance(kinds[spec.key[0]], T.IntegralType)


def _write_run(rows: DataFrame, root: str, spec: TableSpec, run_id: str, *more: Column) -> dict:
    """Write rows in declared columns as a run folder; rows, bucket masks, key span and ``more`` of it."""
    seen = Observation(f"{spec.name} {run_id}")
    least, largest = (f(spec.key[0]).cast("bigint") if _has_span(spec) else F.max(F.lit(None).cast("bigint")) for f in (F.min, F.max))
    # about one file for each bucket; large ones are split
    placed = rows.withColumn(BUCKET, bucket_of(spec)).hint("rebalance", F.col(BUCKET)).observe(
        seen, F.count(F.lit(1)).alias("rows"), least.alias("least"), largest.alias("largest"), *bucket_masks(spec, F.col(BUCKET)), *more
    )
    placed.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{root}/{spec.name}/run_id={run_id}")
    return seen.get


def compact(spark: SparkSession, root: str, spec: TableSpec, run_id: str) -> bool:
    """Write the visible rows of a table as one run, and show that instead.

    Keeps the number of runs and small files bounded under many small loads.  The old
    runs stay visible until the one ledger row that replaces them; a compaction that
    stopped before is repeated and writes its folder again.
    """
    known = Ledger(spark, root, spec.name)
    if known.is_published(spec.name, run_id):
        return False
    seen = _write_run(read_table(spark, root, spec, known), root, spec, run_id)
    known.add([spec.name], run_id, "replace", seen["rows"], seen["least"], seen["largest"])
    return True


def read_table(
    spark: SparkSession,
    root: str,
    spec: TableSpec,
    known: Ledger | None = None,
    but: str | None = None,
    buckets: Sequence[int] | None = None,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """All visible rows of a table, in its declared columns; ``but`` leaves one run out.

    Runs and ``buckets`` are partition filters: other folders are not opened, nor are
    runs without a key in ``span``.  Columns added to the spec later read as null from
    older runs.
    """
    runs = [r for r in (known or Ledger(spark, root, spec.name)).visible_runs(spec.name, span) if r != but]
    if not runs or buckets is not None and not buckets:
        return spark.createDataFrame([], spec.schema)
    places = [T.StructField("run_id", T.StringType()), T.StructField(BUCKET, T.IntegerType())]
    stored = spark.read.schema(T.StructType([*spec.schema.fields, *places])).parquet(f"{root}/{spec.name}")
    stored = stored.where(F.col("run_id").isin(runs))
    if buckets is not None and len(buckets) < spec.buckets:
        stored = stored.where(F.col(BUCKET).isin(list(buckets)))
    return stored.select(*spec.columns)


def _stored_keys(staged: DataFrame, stored: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys of a run that the table holds already."""
    return staged.join(stored.select(*spec.key), list(spec.key), "left_semi").select(
        F.lit(spec.name).alias("table_name"),
        F.lit(",".join(spec.key)).alias("column_name"),
        F.lit("primary key").alias("rule"),
        row_key(spec).alias("row_key"),
    )


def publish(
    df: DataFrame,
    root: str,
    spec: TableSpec,
    run_id: str,
    parents: Mapping[str, DataFrame] | None = None,
    known: Ledger | None = None,
    before: Callable[[], None] | None = None,
) -> bool:
    """Load ``df`` as one run of the table, all or nothing.

    Returns False when that run is published already.  Raises
    :class:`LoadRejected` when a row breaks a rule of the table; its message names
    the folder where all rows lie, with the broken rules in ``_broken``.  ``before``
    runs when all checks are passed, right before the run becomes visible.
    """
    spark = df.sparkSession
    known = known or Ledger(spark, root, spec.name)
    if known.is_published(spec.name, run_id):
        return False
    filled = cast_once(apply_defaults(df, spec), spec)
    target = f"{root}/{spec.name}/run_id={run_id}"
    # the broken rules of a row are written beside it: one pass over the input; listed only where there are some
    checked = filled.withColumn("_broken", F.when(breaks_rules(filled, spec), F.to_json(broken_rules(filled, spec))))
    seen = _write_run(conform(checked, spec, keep=["_broken"]), root, spec, run_id, F.count("_broken").alias("broken"))
    staged_schema = T.StructType([*spec.schema.fields, T.StructField("_broken", T.StringType())])
    staged = spark.read.schema(staged_schema).parquet(target)
    if seen["broken"]:
        examples = staged.where("_broken is not null").select(row_key(spec), "_broken").take(5)
        raise LoadRejected(f"{spec.name}, run {run_id}: {seen['broken']} rows in {target}, {examples}")
    span = None if seen["least"] is None else (seen["least"], seen["largest"])
    problems = [key_violations(staged, spec)]
    if known.visible_runs(spec.name):
        stored = read_table(spark, root, spec, known, buckets=marked_buckets(spec, seen), span=span)
        problems.append(_stored_keys(staged, stored, spec))
    if parents:
        problems.append(reference_violations(staged, spec, parents))
    found = reduce(lambda a, b: a.unionByName(b), problems).take(5)
    if found:
        raise LoadRejected(f"{spec.name}, run {run_id}: {found}, rows in {target}")
    if before:
        before()
    known.add([spec.name], run_id, "load", seen["rows"], seen["least"], seen["largest"])
    return True


def truncate(spark: SparkSession, root: str, name: str, run_id: str, cascade: bool = True) -> list[str]:
    """Hide all rows of a table and, with ``cascade``, of the tables that refer to it, at once."""
    names = [name, *(children(name) if cascade else [])]
    Ledger(spark, root, *names).add(names, run_id, "truncate")
    return names


def table_columns(name: str) -> list[str]:
    return TABLES[name].columns


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, bounds: tuple[int, int], parts: int
) -> DataFrame:
    """Read a warehouse table over JDBC in parallel, split on a numeric column.

    Credentials come from the session or the URL, never from code.
    """
    return (
        spark.read.format("jdbc")
        .options(
            url=url, dbtable=table, partitionColumn=column,
            lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts,
        )
        .load()
    )
