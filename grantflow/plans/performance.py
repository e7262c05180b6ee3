"""Quarterly performance reports: cells and question blocks -> three tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.fixed_values import FIRST_PERFORMANCE_ID, QUESTION_ALIASES, REPORT_PERIOD
from grantflow.functions.cleaning import amount, normalise_missing
from grantflow.functions.dates import lenient_date
from grantflow.operators.joins import enrich
from grantflow.operators.numbering import BLOCK, file_ids, next_id, serial_ids
from grantflow.operators.ordered import split_header_detail
from grantflow.session import settle
from grantflow.sources.documents import cells_to_rows, pick_table, question_answers

ACTIVITY_COLUMNS = {
    "Grantee_Activity_Number": "activity_number",
    "Activity_Type": "activity_type",
    "Activity_Status": "activity_status",
    "Project_Number": "project_number",
    "Project_Title": "project_title",
    "Projected_Start_Date": "projected_start_date",
    "Projected_End_Date": "projected_end_date",
    "National_Objective": "national_objective",
    "Responsible_Organization": "responsible_organization",
    "Benefit_Type": "benefit_type",
    "Activity_Title": "activity_title",
    "Completed_Activity_Actual_End_Date": "completed_activity_actual_end_date",
}
DATE_COLUMNS = [
    "projected_start_date", "projected_end_date", "completed_activity_actual_end_date",
]


def budget_rows(cells: DataFrame) -> DataFrame:
    """Rows of the last table on the first page of each report, header row skipped."""
    return cells_to_rows(pick_table(cells, page=0, index=-1, skip_rows=1), 3, ["doc_id", "row_no"])


def performance_reports(
    details: DataFrame,
    activity_ids: DataFrame,
    start: int = FIRST_PERFORMANCE_ID,
    block: int = BLOCK,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Detail rows with activity, description and a running id after the stored ones.

    ``c1`` is the amount of the period, ``c2`` the amount to date.
    """
    # numbering reads its input twice
    tied = settle(enrich(details, activity_ids, ["doc_id"], ["activity_id"]))
    return serial_ids(tied, ["doc_id"], "row_no", "performance_id", start, stored, block).select(
        "performance_id",
        "activity_id",
        F.col("description_id").alias("amount_desc_id"),
        F.trim("c0").alias("grant_id"),
        amount("c2").alias("to_date_amount"),
        amount("c1").alias("time_period_amount"),
    )


def activities(answers: DataFrame, activity_ids: DataFrame) -> DataFrame:
    """One activity per report; missing answers and unreadable dates are null."""
    named = normalise_missing(answers).withColumnsRenamed(ACTIVITY_COLUMNS)
    dated = named.withColumns({c: lenient_date(c) for c in DATE_COLUMNS})
    return enrich(dated, activity_ids, ["doc_id"], ["activity_id"]).select(
        "activity_id", *ACTIVITY_COLUMNS.values()
    )


def amount_descriptions(headers: DataFrame, period: str = REPORT_PERIOD) -> DataFrame:
    """Every header row; repeats share an id and fall to the first at load."""
    return headers.select(
        F.col("description_id").alias("amount_desc_id"),
        "description",
        amount("c1").alias("time_period_amount"),
        F.lit(period).alias("time_period"),
        amount("c2").alias("to_date_amount"),
        "doc_id",
        "row_no",
    )


def performance_tables(
    cells: DataFrame,
    blocks: DataFrame,
    stored: Mapping[str, DataFrame] | None = None,
    period: str = REPORT_PERIOD,
    block: int = BLOCK,
    first_report: int = FIRST_PERFORMANCE_ID,
    next_description: int = 1,
) -> dict[str, DataFrame]:
    """The three tables of new reports; all three ids continue after the stored ones.

    Give ``stored`` for every load but the first.  An id given twice with other
    content is refused at load.  One load may run at a time.
    """
    stored = stored or {}
    start = next_id(stored.get("amountdescriptions"), "amount_desc_id", next_description)
    headers, details = split_header_detail(
        budget_rows(cells), ["doc_id"], "row_no", "c0", start=start, block=block
    )
    ids = file_ids(cells, "doc_id", "activity_id", stored=stored.get("activities"))
    return {
        "activities": activities(question_answers(blocks, QUESTION_ALIASES), ids),
        "amountdescriptions": amount_descriptions(headers, period),
        "performancereports": performance_reports(
            details, ids, first_report, block, stored.get("performancereports")
        ),
    }
