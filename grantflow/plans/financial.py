"""Grant financial reports: table rows in two layouts -> one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.fixed_values import (
    CONTINUATION_NAMES,
    NEW_LAYOUT,
    OLD_LAYOUT,
    OLD_LAYOUT_BEFORE_YEAR,
)
from grantflow.functions.cleaning import (
    currency_decimal,
    currency_whole,
    missing_to_null,
    percentage,
    trim_text,
)
from grantflow.functions.dates import report_date
from grantflow.operators.joins import enrich, state_code
from grantflow.operators.numbering import BLOCK, positions, serial_ids
from grantflow.operators.ordered import fold_name_only, forward_fill, repair_wrapped
from grantflow.session import settle
from grantflow.sources.documents import TABLE, report_tables

VALUE_COLUMNS = [c for c in NEW_LAYOUT if c != "Grantee"]
MONEY_MODES = {"whole": currency_whole, "decimal": currency_decimal}


def name_layout(rows: DataFrame, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Positional columns c0, c1 ... -> the names of a layout."""
    return rows.select(*keep, *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])


def unify_layouts(
    old: DataFrame | None, new: DataFrame | None, keep: Sequence[str]
) -> DataFrame:
    """Both layouts under the names of the new one; what the old one lacks is null."""
    frames = []
    if new is not None:
        frames.append(name_layout(new, NEW_LAYOUT, keep))
    if old is not None:
        named = name_layout(old, OLD_LAYOUT, keep)
        frames.append(named.drop("Last Month Spending").withColumnRenamed("Grant", "Grant ID"))
    stacked = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1], True)
    lacking = {n: F.lit(None).cast("string") for n in NEW_LAYOUT if n not in stacked.columns}
    return stacked.withColumns(lacking).select(*keep, *NEW_LAYOUT)


def by_width(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rows of both layouts, told apart by their width, under the names of the new one."""
    old = [n if n != "Grant" else "Grant ID" for n in OLD_LAYOUT]
    of_old = {n: F.col(f"c{old.index(n)}") for n in NEW_LAYOUT if n in old}
    named = [
        F.when(F.col("width") == len(old), of_old.get(n, F.lit(None).cast("string")))
        .otherwise(F.col(f"c{i}")).alias(n)
        for i, n in enumerate(NEW_LAYOUT)
    ]
    return rows.select(*keep, *named)


def is_old_layout(date: Column | str) -> Column:
    return F.year(date) < OLD_LAYOUT_BEFORE_YEAR


def repair_rows(
    rows: DataFrame,
    file: str,
    row_no: str,
    fragments: Sequence[str] = tuple(CONTINUATION_NAMES),
    block: int = BLOCK,
) -> DataFrame:
    """Wrapped names joined, names filled down, name-only rows folded upwards.

    Rows left with neither a name nor a value (a fragment was taken from them,
    or they were blank) are dropped, so no name is added twice.
    """
    clean = rows.withColumns({n: missing_to_null(F.col(f"`{n}`"), [""]) for n in NEW_LAYOUT})
    joined = settle(repair_wrapped(clean, [file], row_no, "Grantee", fragments, block=block))
    hollow = F.coalesce(*[F.col(f"`{c}`") for c in VALUE_COLUMNS]).isNull()
    kept = joined.where(~(hollow & (F.col("Grantee") == "")) | (F.col(row_no) == 0))
    blank = kept.withColumn("Grantee", missing_to_null("Grantee", [""]))
    filled = forward_fill(blank, [file], row_no, "Grantee", block)
    return fold_name_only(filled, [file], row_no, "Grantee", VALUE_COLUMNS, block)


def financial_reports(
    rows: DataFrame, state: str | None = "PR", money: str = "whole"
) -> DataFrame:
    """Typed columns of the table, for one state (None: all states).

    ``money`` is ``whole`` (amounts printed without cents) or ``decimal``.
    """
    currency = MONEY_MODES[money]
    coded = state_code(rows, "Grantee", "state_code")
    kept = coded if state is None else coded.where(F.col("state_code") == state)
    keep = [c for c in rows.columns if c not in NEW_LAYOUT]
    return kept.select(
        *keep,
        trim_text("Grant ID").alias("grant_id"),
        "state_code",
        currency("Grant Award").cast("decimal(18,2)").alias("grant_award"),
        currency("Balance").cast("decimal(18,2)").alias("balance"),
        F.col("Disaster Year").try_cast("int").alias("disaster_year"),
        F.col("Grant Age in Months").try_cast("smallint").alias("grant_age_in_months"),
        percentage("Expected Spending %").alias("expected_spending_percentage"),
        percentage("Drawn %").alias("drawn_percentage"),
        F.col("Spending Status").alias("spending_status"),
        currency("Amount Behind Pace").cast("decimal(18,2)").alias("amount_behind_pace"),
    )


def report_dates(front_pages: DataFrame) -> DataFrame:
    return front_pages.select("doc_id", report_date("text", "file_name").alias("report_date"))


def layout_widths(dates: DataFrame) -> DataFrame:
    """Columns of each report's layout; reports without a date have the new one."""
    width = F.when(is_old_layout("report_date"), len(OLD_LAYOUT)).otherwise(len(NEW_LAYOUT))
    return dates.select("doc_id", width.alias("width"))


def skipped_tables(cells: DataFrame, front_pages: DataFrame) -> DataFrame:
    """Tables left out of the load: doc_id, page, table_no, width, reason."""
    widths = layout_widths(report_dates(front_pages))
    return report_tables(cells, len(NEW_LAYOUT), widths=widths)[1]


def financial_tables(
    cells: DataFrame,
    front_pages: DataFrame,
    state: str | None = "PR",
    money: str = "whole",
    stored: DataFrame | None = None,
    block: int = BLOCK,
) -> dict[str, DataFrame]:
    """Table rows of all reports; ``front_pages`` is (doc_id, file_name, text).

    Which layout a report has is judged on its date and the shapes of its tables,
    one row each; :func:`skipped_tables` tells the tables that fit neither.
    """
    dates = report_dates(front_pages)
    good, _ = report_tables(cells, len(NEW_LAYOUT), widths=layout_widths(dates))
    rows = settle(by_width(good, [*TABLE, "row_no"]))
    placed = positions(rows, ["doc_id"], ["page", "table_no"], "row_no", "place", block).drop(
        "page", "table_no", "row_no"
    )
    typed = financial_reports(repair_rows(placed, "doc_id", "place", block=block), state, money)
    # numbering reads its input twice
    tied = settle(enrich(typed, dates, ["doc_id"], ["report_date"]))
    return {
        "grantfinancialreports": serial_ids(
            tied, ["doc_id"], "place", "report_id", stored=stored, block=block
        ).drop("doc_id", "place")
    }
