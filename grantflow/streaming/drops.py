"""File drops picked up once, loaded, and moved aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.plans.loading import rows_to_load, typed_keys, without_key, write_rejects
from grantflow.schemas import TableSpec
from grantflow.sources.files import CSV_OPTIONS
from grantflow.session import settled_for_now
from grantflow.sources.tables import Ledger, bucket_masks, bucket_of, marked_buckets, publish, read_table


CORRUPT = "_corrupt_record"


def read_drops(
    spark: SparkSession,
    source: str,
    schema: str | T.StructType,
    archive: str | None = None,
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """CSV files of a folder as a stream, each file once.

    A line that does not fit the schema is kept whole in ``_corrupt_record``.
    ``multi_line`` is for cells with line breaks; it reads a file in one task.

    With ``archive`` Spark moves the files of a batch there while a later batch
    runs, so the newest files stay behind; the checkpoint, not the move, keeps
    a file from being read twice.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rescued = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    options = {**CSV_OPTIONS, "multiLine": str(multi_line).lower(), "columnNameOfCorruptRecord": CORRUPT}
    reader = spark.readStream.schema(rescued).options(**options)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(source)


def marked_drops(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """The batch with ``_rule``: ``format`` or ``key`` where a row cannot be stored, else null."""
    if CORRUPT not in batch.columns:
        batch = batch.withColumn(CORRUPT, F.lit(None).cast("string"))
    rule = F.when(F.col(CORRUPT).isNotNull(), "format").when(without_key(batch, spec), "key")
    return batch.withColumn("_rule", rule)


def split_drops(batch: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Rows that can be stored, and the others as (source, key, rule, text)."""
    marked = batch if "_rule" in batch.columns else marked_drops(batch, spec)
    text = F.coalesce(CORRUPT, F.to_json(F.struct(*[c for c in marked.columns if c not in (CORRUPT, "_rule")])))
    bad = marked.where("_rule is not null").select(
        F.lit(spec.name).alias("source"),
        F.concat_ws("|", *[F.col(f"`{k}`").cast("string") for k in spec.key]).alias("key"),
        F.col("_rule").alias("rule"),
        text.alias("text"),
    )
    return marked.where("_rule is null").drop(CORRUPT, "_rule"), bad


def load_drops(
    stream: DataFrame,
    root: str,
    spec: TableSpec,
    checkpoint: str,
    order: Sequence[str] = (),
) -> None:
    """Load everything that has arrived, then stop.

    Every micro-batch is one run of the table named after its batch id.  A batch
    repeated after a failure finds its run published and does nothing, so rows
    arrive exactly once.  Lines that do not fit the schema, and rows without a
    key, are written under ``root/rejects`` and stop nothing.

    A batch is read from its files once and written; its buckets and rejects are
    counted on the way.  Of the stored table only keys in these buckets are read, so
    a small batch does not cost more as the table grows.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        run_id = f"batch-{batch_id:09d}"
        spark = batch.sparkSession
        known = Ledger(spark, root, spec.name)
        if known.is_published(spec.name, run_id):
            return
        seen = Observation(f"{spec.name} {run_id} drops")
        marked = marked_drops(batch, spec)
        keys = {k[len("_key_") :]: c for k, c in typed_keys(marked, spec).items()}
        bucket = F.when(F.col("_rule").isNull(), bucket_of(spec, keys))
        with settled_for_now(marked.observe(seen, F.count("_rule").alias("bad"), *bucket_masks(spec, bucket)), "drops") as rows:
            good, bad = split_drops(rows, spec)
            stored = read_table(spark, root, spec, known, buckets=marked_buckets(spec, seen.get))
            fresh = rows_to_load(good, stored, spec, [F.col(c) for c in order], known.largest_key(spec.name) or 0)
            tell = (lambda: write_rejects(bad, root, spec.name, run_id)) if seen.get["bad"] else None
            publish(fresh, root, spec, run_id, known=known, before=tell)

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
