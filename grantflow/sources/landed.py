"""Landed API responses: paged results and nested award documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.fixed_values import PAGE_LIMIT
from grantflow.operators.joins import enrich
from grantflow.schemas import AWARD_DETAIL_DDL


def merge_pages(
    pages: DataFrame, stop: str, limit: int = PAGE_LIMIT, source: str = "source_id"
) -> DataFrame:
    """Rows of (source, page, has_next, results) up to the stop page, exploded.

    ``stop``: ``empty`` ends before the first empty page, ``short`` after the
    first page below ``limit``, ``has_next`` after the first page that is empty
    or announces no further one.
    """
    size = F.coalesce(F.size("results"), F.lit(0))
    size = F.when(size < 0, 0).otherwise(size)
    last: Column = {
        "empty": size == 0,
        "short": size < limit,
        "has_next": (size == 0) | ~F.coalesce("has_next", F.lit(False)),
    }[stop]
    ends = pages.where(last).groupBy(source).agg(F.min("page").alias("_end"))
    kept = enrich(pages, ends, [source], ["_end"]).where(
        F.col("_end").isNull() | (F.col("page") <= F.col("_end"))
    )
    return kept.select(
        source, "page", F.posexplode("results").alias("pos", "result")
    ).select(source, "page", "pos", "result.*")


def _read_awards(column: str) -> Column:
    options = {"columnNameOfCorruptRecord": "_corrupt"}
    return F.from_json(column, f"{AWARD_DETAIL_DDL}, _corrupt string", options)


def parse_awards(df: DataFrame, column: str) -> DataFrame:
    """JSON text of award documents -> nested columns, without the malformed ones."""
    read = df.select(_read_awards(column).alias("_doc"))
    return read.where("_doc is not null and _doc._corrupt is null").select("_doc.*").drop("_corrupt")


def rejected_awards(df: DataFrame, column: str, key: str, source: str = "awards") -> DataFrame:
    """Documents that are no award: source, key, rule (missing or format), text."""
    read = df.select(F.col(f"`{key}`").cast("string").alias("key"), F.col(f"`{column}`").alias("text"), _read_awards(column).alias("_doc"))
    rule = F.when(F.col("text").isNull(), "missing").otherwise("format")
    return read.where("_doc is null or _doc._corrupt is not null").select(F.lit(source).alias("source"), "key", rule.alias("rule"), "text")


def flatten_awards(docs: DataFrame) -> DataFrame:
    """Nested award documents -> 26 flat columns; absent parts are null."""
    program = F.get("cfda_info", F.lit(0))
    return docs.select(
        F.col("fain").alias("Award ID"),
        "generated_unique_award_id",
        "total_funding",
        "total_account_outlay",
        "total_account_obligation",
        program["cfda_objectives"].alias("cfda_objectives"),
        program["cfda_title"].alias("cfda_title"),
        program["cfda_number"].alias("cfda_number"),
        F.col("place_of_performance.state_name").alias("place_of_performance_state_name"),
        F.col("place_of_performance.state_code").alias("place_of_performance_state_code"),
        "total_outlay",
        F.col("total_obligation").alias("total_obligated"),
        *[
            F.col(f"{role}_agency.{tier}tier_agency.{part}").alias(f"{role}_{label}_{part}")
            for role in ("awarding", "funding")
            for tier, label in (("top", "agency"), ("sub", "sub_agency"))
            for part in ("name", "code")
        ],
        F.col("recipient.location.state_name").alias("recipient_state_name"),
        F.col("recipient.location.state_code").alias("recipient_state_code"),
        F.col("funding_agency.office_agency_name").alias("funding_office_name"),
        F.col("awarding_agency.office_agency_name").alias("awarding_office_name"),
        F.col("period_of_performance_start_date").alias("start_date"),
        F.col("period_of_performance_current_end_date").alias("end_date"),
    )


def tag_award_id(children: DataFrame, awards: DataFrame, key: str = "generated_internal_id") -> DataFrame:
    """Attach the readable award id to child rows.

    Awards are made distinct first, so a repeated award cannot multiply children.
    """
    return enrich(children, awards.select(key, "`Award ID`").distinct(), [key], ["Award ID"])


def explode_children(parents: DataFrame, key: str, array: str) -> DataFrame:
    """Array of child structs -> one row per child, tagged with the parent key."""
    kind = parents.schema[array].dataType
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"{array} is no array")
    return parents.select(key, F.posexplode(array).alias("pos", "_child")).select(
        key, "pos", "_child.*"
    )
