"""Tables built from award search results, award details and their children."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.functions.cleaning import (
    integer_code,
    lenient_number,
    strict,
    strip_chars,
    trim_text,
    whole_code,
)
from grantflow.functions.dates import staging_date, strict_date
from grantflow.fixed_values import STAGING_DATE_FORMAT
from grantflow.operators.joins import enrich, full_join, lookup
from grantflow.operators.numbering import stable_id
from grantflow.operators.rows import stack_distinct, stack_roles
from grantflow.session import settle


def states(other: DataFrame) -> DataFrame:
    """Distinct recipient states; rows without a code are dropped (it is the key)."""
    return (
        other.select(
            F.col("recipient_state_name").alias("state_name"),
            F.col("recipient_state_code").alias("state_code"),
        )
        .dropna(subset=["state_code"])
        .dropDuplicates()
    )


def cfda_programs(other: DataFrame) -> DataFrame:
    """Distinct programs; rows without a number are dropped (it is the key)."""
    return (
        other.select("cfda_number", "cfda_title", "cfda_objectives")
        .dropna(subset=["cfda_number"])
        .dropDuplicates()
    )


GRANT_COLUMNS = [
    "grant_id", "generated_internal_id", "cfda_number", "place_of_performance_state_code",
    "recipient_state_code", "awarding_agency_code", "funding_agency_code",
    "awarding_sub_agency_code", "funding_sub_agency_code", "total_funding",
    "total_account_outlay", "total_account_obligation", "total_outlay", "total_obligated",
    "description", "award_type", "def_codes", "public_law_number", "covid_19_obligations",
    "covid_19_outlays", "infrastructure_obligations", "infrastructure_outlays", "start_date",
    "end_date", "funding_office_name", "awarding_office_name",
]
SEARCH_COLUMNS = {
    "Award Type": "award_type",
    "def_codes": "def_codes",
    "Description": "description",
    "COVID-19 Obligations": "covid_19_obligations",
    "COVID-19 Outlays": "covid_19_outlays",
    "Infrastructure Outlays": "infrastructure_outlays",
    "Infrastructure Obligations": "infrastructure_obligations",
}


def grants(awards: DataFrame, other: DataFrame, fund_codes: DataFrame) -> DataFrame:
    """Award details with the fields of the search result and the public law.

    A single fund code (``['Q']``) is looked up, the last of repeated codes
    wins; several codes in one award miss the lookup and give a null law.
    ``fund_codes`` carries its row order as ``row_no``.
    """
    found = awards.select(
        F.col("generated_internal_id"),
        *[F.col(f"`{old}`").alias(new) for old, new in SEARCH_COLUMNS.items()],
    )
    details = other.withColumnsRenamed(
        {"Award ID": "grant_id", "generated_unique_award_id": "generated_internal_id"}
    )
    joined = enrich(details, found, ["generated_internal_id"], list(SEARCH_COLUMNS.values()))
    coded = joined.withColumns(
        {
            "def_codes": strip_chars("def_codes", "[]'\""),
            "start_date": staging_date("start_date"),
            "end_date": staging_date("end_date"),
            "awarding_agency_code": integer_code("awarding_agency_code"),
            "funding_agency_code": integer_code("funding_agency_code"),
        }
    )
    return lookup(
        coded, "def_codes", fund_codes, "def_codes", "PL Number 1", "row_no", "public_law_number"
    ).select(*GRANT_COLUMNS)


def recipients(awards: DataFrame, subawards: DataFrame) -> DataFrame:
    """Distinct recipient names of both sources with a repeatable id."""
    names = stack_distinct(
        [
            awards.select(trim_text("Recipient Name").alias("recipient_name")),
            subawards.select(trim_text("recipient_name").alias("recipient_name")),
        ]
    ).dropna()
    return names.withColumn("recipient_id", stable_id("recipient_name"))


def subaward_rows(subawards: DataFrame, awards: DataFrame, known: DataFrame) -> DataFrame:
    """Subawards with the readable grant id and the recipient id.

    A malformed action date fails the job.
    """
    ids = awards.select("generated_internal_id", F.col("`Award ID`").alias("grant_id")).distinct()
    named = enrich(subawards, ids, ["generated_internal_id"], ["grant_id"]).withColumn(
        "recipient_name", trim_text("recipient_name")
    )
    return enrich(named, known, ["recipient_name"], ["recipient_id"]).select(
        "subaward_id",
        "grant_id",
        "subaward_number",
        "description",
        F.date_format(strict_date("action_date"), STAGING_DATE_FORMAT).alias("action_date"),
        "amount",
        "recipient_id",
    )


def funding(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("`Award ID`").alias("grant_id"),
        "transaction_obligated_amount",
        "gross_outlay_amount",
        "federal_account",
        "account_title",
        "object_class",
        "object_class_name",
        "program_activity_code",
        "program_activity_name",
        strict("reporting_fiscal_year", "int").alias("reporting_fiscal_year"),
        strict("reporting_fiscal_quarter", "int").alias("reporting_fiscal_quarter"),
        strict("reporting_fiscal_month", "int").alias("reporting_fiscal_month"),
        strict("is_quarterly_submission", "boolean").alias("is_quarterly_submission"),
    )


def sub_agencies(other: DataFrame) -> DataFrame:
    pairs = stack_roles(
        other,
        [
            {f"{role}_sub_agency_name": "sub_agency_name", f"{role}_sub_agency_code": "sub_agency_code"}
            for role in ("awarding", "funding")
        ],
    )
    return (
        pairs.dropna()
        .dropDuplicates()
        .withColumn("sub_agency_code", whole_code("sub_agency_code"))
    )


def agencies(funding_rows: DataFrame, other: DataFrame) -> DataFrame:
    """Agency names with the codes of one source and the ids of the other.

    Names found in one source only stay, with nulls for the rest.
    """
    coded = stack_roles(
        other,
        [
            {f"{role}_agency_name": "agency_name", f"{role}_agency_code": "agency_code"}
            for role in ("awarding", "funding")
        ],
    )
    identified = stack_roles(
        funding_rows,
        [
            {
                f"{role}_agency_name": "agency_name",
                f"{role}_agency_id": "agency_id",
                f"{role}_toptier_agency_id": "toptier_agency_id",
                f"{role}_agency_slug": "agency_slug",
            }
            for role in ("funding", "awarding")
        ],
    )
    # few names of many rows: each source is read once, the join and its reader meet the names
    names = [settle(source.dropna().dropDuplicates()) for source in (coded, identified)]
    both = full_join(*names, ["agency_name"])
    return both.select(
        "agency_name",
        whole_code("agency_code").alias("agency_code"),
        strict("agency_id", "int").alias("agency_id"),
        strict("toptier_agency_id", "int").alias("toptier_agency_id"),
        "agency_slug",
    )


def transactions(rows: DataFrame) -> DataFrame:
    return rows.drop("id", "generated_internal_id").select(
        F.col("`Award ID`").alias("grant_id"),
        "type",
        "type_description",
        staging_date("action_date").alias("action_date"),
        "action_type",
        "action_type_description",
        "modification_number",
        "description",
        "federal_action_obligation",
        "face_value_loan_guarantee",
        "original_loan_subsidy_cost",
        F.col("cfda_number").cast("string").alias("cfda_number"),
    )


def federal_awards(awards: DataFrame, known: DataFrame) -> DataFrame:
    """Awards with the recipient id; names are unique in ``known`` by construction."""
    trimmed = awards.withColumn("recipient_name", trim_text("Recipient Name"))
    return enrich(trimmed, known, ["recipient_name"], ["recipient_id"]).select(
        F.col("`Award ID`").alias("grant_id"),
        "recipient_id",
        strict("Award Amount", "decimal(18,2)").alias("award_amount"),
        strict("Total Outlays", "decimal(18,2)").alias("total_outlays"),
        F.col("Description").alias("description"),
        F.col("`Award Type`").alias("award_type"),
        lenient_number("COVID-19 Obligations").alias("covid_19_obligations"),
        lenient_number("COVID-19 Outlays").alias("covid_19_outlays"),
        lenient_number("Infrastructure Obligations").alias("infrastructure_obligations"),
        lenient_number("Infrastructure Outlays").alias("infrastructure_outlays"),
        staging_date("Start Date").alias("start_date"),
        staging_date("End Date").alias("end_date"),
    )


def award_tables(
    awards: DataFrame,
    other: DataFrame,
    funding_rows: DataFrame,
    subawards: DataFrame,
    transaction_rows: DataFrame,
    fund_codes: DataFrame,
) -> dict[str, DataFrame]:
    """All ten tables of the award pipeline by table name."""
    known = settle(recipients(awards, subawards))
    return {
        "states": states(other),
        "cfdaprograms": cfda_programs(other),
        "agencies": agencies(funding_rows, other),
        "subagency": sub_agencies(other),
        "recipients": known,
        "grants": grants(awards, other, fund_codes),
        "federalawards": federal_awards(awards, known),
        "funding": funding(funding_rows),
        "transactions": transactions(transaction_rows),
        "subawards": subaward_rows(subawards, awards, known),
    }
