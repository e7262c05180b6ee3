"""Expressions over one line of a disaster history report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantflow.fixed_values import (
    EVENT_PATTERNS,
    EVENT_YEAR_PATTERN,
    LAW_NUMBER_PATTERN,
    LAW_PATTERN,
    REPORT_TERRITORY,
    STANDALONE_LAW_PATTERN,
)
from grantflow.functions.cleaning import as_column, digits_and_point, trim_text


def unicode_classes(pattern: str) -> str:
    r"""Make ``\d \w \s \b`` cover Unicode (PDF text holds no-break spaces)."""
    return f"(?U){pattern}"


def first_pattern(line: Column | str, patterns: Sequence[str] = tuple(EVENT_PATTERNS)) -> Column:
    """Match of the first pattern that fits at the start of the line, else null."""
    # one ordered alternation: the first alternative that fits decides
    tried = "|".join(f"(?:{p})" for p in patterns)
    found = F.regexp_extract(as_column(line), unicode_classes(f"^(?:{tried})"), 0)
    return F.nullif(trim_text(found), F.lit(""))


def has_law(line: Column | str) -> Column:
    """True for every line in which a law number can be found."""
    return as_column(line).rlike(unicode_classes(LAW_NUMBER_PATTERN))


def law_mentions(line: Column | str) -> Column:
    """Array of (pl_number, pl_date) of a line; an absent date is null."""
    column, pattern = as_column(line), F.lit(unicode_classes(LAW_PATTERN))
    pairs = F.arrays_zip(
        F.regexp_extract_all(column, pattern, F.lit(1)).alias("number"),
        F.regexp_extract_all(column, pattern, F.lit(2)).alias("date"),
    )
    return F.transform(
        pairs,
        lambda p: F.struct(
            trim_text(p["number"]).alias("pl_number"),
            F.nullif(trim_text(p["date"]), F.lit("")).alias("pl_date"),
        ),
    )


def standalone_laws(line: Column | str) -> Column:
    """Array of law numbers of a line, whatever follows them."""
    pattern = F.lit(unicode_classes(STANDALONE_LAW_PATTERN))
    found = F.regexp_extract_all(as_column(line), pattern, F.lit(1))
    return F.transform(found, trim_text)


def has_award(line: Column | str, territory: str = REPORT_TERRITORY) -> Column:
    """Territory named, exactly one dollar sign, at least one digit or point after it."""
    column = as_column(line)
    parts = F.split(column, r"\$")
    return (
        column.contains(territory)
        & (F.size(parts) == 2)
        & (digits_and_point(F.get(parts, F.lit(1))) != "")
    )


def award_grantee(line: Column | str, territory: str = REPORT_TERRITORY) -> Column:
    """Text between the territory and the dollar sign, else the territory itself."""
    column = as_column(line)
    pattern = unicode_classes(rf"{territory}\s(.*?)\s+\$")
    return F.when(
        column.rlike(pattern), trim_text(F.regexp_extract(column, pattern, 1))
    ).otherwise(F.lit(territory))


def award_amount(line: Column | str) -> Column:
    after = F.get(F.split(as_column(line), r"\$"), F.lit(1))
    return digits_and_point(after).try_cast("decimal(15,2)")


def event_year(event: Column | str) -> Column:
    """First year or year range of an event name, else null."""
    return F.nullif(
        F.regexp_extract(as_column(event), unicode_classes(EVENT_YEAR_PATTERN), 1), F.lit("")
    )


def event_name(event: Column | str) -> Column:
    """Event name without its year or year range where that stands at the end."""
    column = as_column(event)
    year, plain = event_year(column), trim_text(column)
    cut = trim_text(F.substring(plain, F.lit(1), F.length(plain) - F.length(year)))
    return (
        F.when(year.isNull(), column).when(plain.endswith(year), cut).otherwise(plain)
    )
