"""Dates in text: lenient and strict parsing, month names, file names."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.fixed_values import (
    DATE_FORMATS,
    FILE_DATE_PATTERN,
    FILE_MONTH_PATTERN,
    HEADING_YEARS_PATTERN,
    ISO_DATE_PATTERN,
    LAW_DATE_FORMATS,
    LONG_DATE_FORMAT,
    LONG_DATE_PATTERN,
    STAGING_DATE_FORMAT,
    UNKNOWN_DATE,
)
from grantflow.functions.cleaning import as_column


# Text a date format can read, per letter run of the format.
SHAPES = {
    "yyyy": "[0-9]{4}", "MMMM": "[A-Za-z]{3,9}", "MMM": "[A-Za-z]{3}", "MM": "[0-9]{2}",
    "dd": "[0-9]{2}", "d": "[0-9]{1,2}",
}


def shape_of(fmt: str) -> str:
    """Pattern of the texts that ``fmt`` may read."""
    return "^" + re.sub(r"[A-Za-z]+", lambda run: SHAPES[run.group()], fmt) + "$"


def _date_by(column: Column, fmt: str) -> Column:
    """Text of the shape of ``fmt`` -> date, null where it names no day.

    Where all parts are digits of fixed width, they are put in ISO order and cast, which
    takes a fraction of a parse by format.  A line end, which a pattern lets pass, is no date there.
    """
    if not {"yyyy", "MM", "dd"} == set(re.findall("[A-Za-z]+", fmt)):
        return F.try_to_date(column, fmt)
    parts = [F.substring(column, fmt.index(part) + 1, len(part)) for part in ("yyyy", "MM", "dd")]
    iso = column if fmt == "yyyy-MM-dd" else F.concat_ws("-", *parts)
    return F.when(F.length(column) == len(fmt), iso.try_cast("date"))


def lenient_date(value: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses wins; none -> null.

    A format is tried only on text of its shape: a failed parse costs an
    exception, a failed pattern next to nothing.
    """
    column = as_column(value)
    return F.coalesce(*[F.when(column.rlike(shape_of(fmt)), _date_by(column, fmt)) for fmt in formats])


def staging_date(value: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """Lenient date as ``MM-dd-yyyy`` text."""
    return F.date_format(lenient_date(value, formats), STAGING_DATE_FORMAT)


def declared_cast(value: Column, to: T.DataType, given: T.DataType) -> Column:
    """Lenient cast to a declared type; text dates may be ISO or staged."""
    if given == to:
        return value
    if isinstance(to, T.DateType) and isinstance(given, T.StringType):
        return lenient_date(value, ["yyyy-MM-dd", STAGING_DATE_FORMAT])
    return value.try_cast(to)


def strict_date(value: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    """Date that fails the job on bad text (ANSI)."""
    return F.to_date(as_column(value), fmt)


def long_date(value: Column | str) -> Column:
    """``January 31, 2024`` -> date, else null."""
    return lenient_date(value, [LONG_DATE_FORMAT])


def law_date(value: Column | str) -> Column:
    """``Sept. 8, 2017`` and its variants -> date, else null.

    The law pattern admits a day stuck to the month and a point or dash before
    the year (``Sept.8, 2017``, ``Feb. 9-2018``); they are spaced alike first.
    """
    plain = F.regexp_replace(
        as_column(value), r"(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)t?\.", "$1"
    )
    plain = F.regexp_replace(plain, r"^Sept(?![a-z])", "Sep")
    plain = F.regexp_replace(plain, r"^([A-Za-z]{3,9})\.?\s*(\d{1,2})\s*[.,-]?\s*(\d{4})$", "$1 $2, $3")
    return lenient_date(plain, LAW_DATE_FORMATS)


def month_from_file_name(name: Column | str) -> Column:
    """First ``yyyy-m`` of the name as the first day of that month."""
    column = as_column(name)
    year = F.regexp_extract(column, FILE_MONTH_PATTERN, 1)
    month = F.regexp_extract(column, FILE_MONTH_PATTERN, 2)
    return F.try_to_date(F.concat_ws("-", year, F.lpad(month, 2, "0")), "yyyy-MM")


def date_key_of_file(stem: Column | str) -> Column:
    """Date part of a file name with ``_`` inside, or ``unknown_date``."""
    found = F.regexp_extract(as_column(stem), FILE_DATE_PATTERN, 0)
    return F.coalesce(F.nullif(F.translate(found, "-", "_"), F.lit("")), F.lit(UNKNOWN_DATE))


def dates_in_text(text: Column | str) -> Column:
    """All long dates, then all ISO dates, in text order."""
    column = as_column(text)
    return F.concat(
        F.regexp_extract_all(column, F.lit(LONG_DATE_PATTERN), F.lit(0)),
        F.regexp_extract_all(column, F.lit(ISO_DATE_PATTERN), F.lit(0)),
    )


def report_date(text: Column | str, name: Column | str) -> Column:
    """First date of the text (long dates before ISO ones), else the file month."""
    first = F.get(dates_in_text(text), F.lit(0))
    return F.coalesce(
        lenient_date(first, [LONG_DATE_FORMAT, "yyyy-MM-dd"]), month_from_file_name(name)
    )


def heading_end_year(text: Column | str) -> Column:
    """End year of the first ``yyyy-yyyy`` of the text, else null."""
    span = F.nullif(F.regexp_extract(as_column(text), HEADING_YEARS_PATTERN, 0), F.lit(""))
    return F.substring(span, 6, 4)


def repair_year(found: Column | str, end_year: Column | str) -> Column:
    """Replace a year that has not four digits by ``end_year`` when known."""
    column, year = as_column(found), as_column(end_year)
    own = F.element_at(F.split(column, " "), -1)
    repaired = F.concat(F.regexp_replace(column, r"[0-9]+$", ""), year)
    return F.when((F.length(own) != 4) & year.isNotNull(), repaired).otherwise(column)
