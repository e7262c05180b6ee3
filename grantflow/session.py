"""Session settings and the shared folder used for checkpoints and staging."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators count on.  Skewed shuffle joins are split by
# AQE, also where the split costs a further exchange.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


_settled: list[str] = []

# A table known to have at most SMALL_ROWS rows is written in FEW_FILES files.
SMALL_ROWS, FEW_FILES = 1 << 18, 16


def build_session(app: str = "grantflow", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="grantflow-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def settle(df: DataFrame, most: int | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` once under the shared folder and go on from the written table.

    Cuts lineage: a lost executor reads the table again instead of computing it
    again, and steps that read their input several times read files.  ``most`` is a
    bound on its rows, where one is known: a small table is written in few files, also
    where AQE does not join small shuffle partitions, since writing and opening a file
    takes longer than its rows do.  Not for long texts or costly rows.
    """
    if most is not None and most <= SMALL_ROWS:
        df = df.coalesce(FEW_FILES)
    path = scratch_dir(df.sparkSession, "settled")
    df.write.parquet(path, compression=codec)
    _settled.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps.

    Spark deletes them once the driver's JVM has collected the plans that made them; a
    driver with a roomy heap does so late, and until then all steps of a job lie on disk.
    """
    spark._jvm.System.gc()


@contextmanager
def letting_go(spark: SparkSession) -> Iterator[None]:
    """Tables settled inside the block are deleted at its end, and its shuffles let go."""
    kept = len(_settled)
    try:
        yield
    finally:
        while len(_settled) > kept:
            _delete(spark, _settled.pop())
        free_shuffles(spark)


@contextmanager
def with_settings(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings that hold inside the block only."""
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def settled_for_now(df: DataFrame, name: str = "step", codec: str | None = None) -> Iterator[DataFrame]:
    """``df`` written once under the shared folder, and deleted at the end of the block."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def drop_settled(spark: SparkSession) -> int:
    """Delete the tables written by :func:`settle`; frames built on them end here."""
    count = len(_settled)
    while _settled:
        _delete(spark, _settled.pop())
    return count
