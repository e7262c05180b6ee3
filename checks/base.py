"""Registry of checked queries and small helpers they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Driver tables of one scale by attribute."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def check(name: str, sql: str | None = None):
    """Register ``build(tables)`` as a query, with the SQL that must agree."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return plain(build(Tables(tune(spark), folder)))

        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        run.__name__ = name
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Dates and decimals as text, so that both engines print the same value."""
    as_text = (T.DateType, T.DecimalType, T.TimestampType, T.TimestampNTZType)
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("string").alias(f.name)
            if isinstance(f.dataType, as_text)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def dec(column: str) -> "F.Column":
    return F.col(column).cast("decimal(18,2)")
