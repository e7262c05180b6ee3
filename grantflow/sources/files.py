"""CSV tables, run folders and operators over file listings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.fixed_values import BATCH_PATTERN, HISTORY_BATCH_PATTERN
from grantflow.functions.cleaning import file_name, file_stem
from grantflow.functions.dates import date_key_of_file
from grantflow.operators.joins import keep_absent

# Quotes are doubled inside quoted cells.
CSV_OPTIONS = {"header": "true", "escape": '"'}


def read_csv(
    spark: SparkSession, path: str, schema: str | T.StructType, multi_line: bool = False
) -> DataFrame:
    """Headered CSV with a declared schema; a value that does not fit fails the job.

    Large files are split.  A table whose cells hold line breaks needs
    ``multi_line``, which reads each file in one task.
    """
    options = {**CSV_OPTIONS, "mode": "FAILFAST", "multiLine": str(multi_line).lower()}
    return spark.read.schema(schema).options(**options).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Headered CSV; errors reach the caller, an existing path is never replaced."""
    df.write.mode("error").option("header", True).option("escape", '"').csv(path)


def run_stamp(now: datetime) -> str:
    return now.strftime("%Y%m%d_%H%M%S")


def write_tables(frames: Mapping[str, DataFrame], root: str, run_id: str) -> list[str]:
    """Write named tables under one run id; returns the paths."""
    paths = []
    for name, df in frames.items():
        path = f"{root}/{name}/run_id={run_id}"
        write_csv(df, path)
        paths.append(path)
    return paths


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """Path, length and modification time of the files under ``root``.

    The content column is not selected, so no file is opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return (
        reader.load(root)
        .select("path", "length", "modificationTime")
        .where(~F.col("path").endswith("/"))
    )


def latest_batch(files: DataFrame, path: str = "path", pattern: str = BATCH_PATTERN) -> DataFrame:
    """Files whose path holds the largest time stamp found by ``pattern``."""
    stamp = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    newest = files.agg(F.max(stamp)).scalar()
    return files.where(F.col(path).contains(newest))


def route_files(
    files: DataFrame, rules: Sequence[tuple[str, str]], path: str = "path", keys: Sequence[str] = ()
) -> DataFrame:
    """First path (in listing order) per rule: (``keys``, keyword, table_name, path).

    The rules are a short list in code, so each file is tested against them in
    place; no join is needed.
    """
    lowered = F.lower(F.col(path))
    hits = [
        F.when(
            lowered.contains(word.lower()),
            F.struct(F.lit(word).alias("keyword"), F.lit(table).alias("table_name")),
        )
        for word, table in rules
    ]
    matched = files.select(
        *keys, F.col(path).alias("path"), F.explode(F.array_compact(F.array(*hits))).alias("_rule")
    )
    return matched.groupBy(*keys, "_rule.keyword", "_rule.table_name").agg(F.min("path").alias("path"))


def group_by_date(
    files: DataFrame, path: str = "path", pattern: str = HISTORY_BATCH_PATTERN
) -> DataFrame:
    """Files with the date of their name as group key, in long form.

    One row per file keeps a date with very many files spread over tasks.
    """
    date = F.nullif(F.regexp_extract(path, pattern, 1), F.lit(""))
    return files.select(date.alias("date_key"), F.col(path).alias("path")).where(
        F.col("date_key").isNotNull()
    )


def last_files(files: DataFrame, count: int, path: str = "path") -> DataFrame:
    """Last ``count`` files in listing order."""
    return files.orderBy(F.col(path).desc()).limit(count)


def unprocessed(files: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """Files not in the ledger of processed ones."""
    return keep_absent(files, done, [path])


def name_parts(files: DataFrame, path: str = "path") -> DataFrame:
    """Add base name, stem and date key of each path."""
    return files.withColumns(
        {
            "file_name": file_name(path),
            "stem": file_stem(path),
            "date_key": date_key_of_file(file_stem(path)),
        }
    )
