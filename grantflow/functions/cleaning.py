"""Scalar cleaning of text, codes, money and percentages."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow.fixed_values import GRANT_ID_PATTERN, MISSING_TEXT

# Everything Python's str.strip() removes.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trim_text(value: Column | str) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(as_column(value), F.lit(WHITESPACE))


def strip_chars(value: Column | str, chars: str) -> Column:
    """Remove any of ``chars`` from both ends, e.g. list brackets and quotes."""
    return F.btrim(as_column(value), F.lit(chars))


def missing_to_null(value: Column | str, markers: Iterable[str] = MISSING_TEXT) -> Column:
    column = as_column(value)
    return F.when(~column.isin(*markers), column)


def normalise_missing(df: DataFrame, markers: Iterable[str] = MISSING_TEXT) -> DataFrame:
    """Turn every missing-value marker in every text column into null."""
    markers = list(markers)
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: missing_to_null(F.col(f"`{name}`"), markers) for name in text})


def currency_whole(value: Column | str) -> Column:
    """``($1,200)`` -> -1200; empty or a lone minus -> 0.

    The decimal point is dropped like any other character, so this fits amounts
    printed without cents only.  Null stays null; text that still is no number
    (two minus signs) becomes null.
    """
    kept = F.regexp_replace(F.translate(as_column(value), "()", "-"), "[^-0-9]", "")
    return F.when(kept.isin("", "-"), F.lit(0).cast("bigint")).otherwise(kept.try_cast("bigint"))


def currency_decimal(value: Column | str) -> Column:
    """Like :func:`currency_whole`, keeping cents."""
    kept = F.regexp_replace(F.translate(as_column(value), "()", "-"), "[^-0-9.]", "")
    zero = F.lit(0).cast("decimal(18,2)")
    return F.when(kept.isin("", "-"), zero).otherwise(kept.try_cast("decimal(18,2)"))


def amount(value: Column | str) -> Column:
    """``$1,234.50`` -> 1234.50; text that is no number becomes null."""
    return F.translate(as_column(value), "$, ", "").try_cast("decimal(18,2)")


def percentage(value: Column | str) -> Column:
    """``45,5 %`` -> 45.50."""
    plain = F.translate(as_column(value), ",%", ".")
    return trim_text(plain).try_cast("decimal(5,2)")


def digits_and_point(value: Column | str) -> Column:
    return F.regexp_replace(as_column(value), "[^0-9.]", "")


def integer_code(value: Column | str) -> Column:
    """``86.0`` -> ``86``."""
    return as_column(value).try_cast("double").try_cast("bigint").cast("string")


def whole_code(value: Column | str) -> Column:
    """``086`` or ``86.0`` -> 86 as int; text that is no number fails the job."""
    return as_column(value).cast("double").cast("int")


def lenient_number(value: Column | str, to: str = "decimal(18,2)") -> Column:
    return as_column(value).try_cast(to)


def strict(value: Column | str, to: str) -> Column:
    """Cast that fails the job on bad text (ANSI)."""
    return as_column(value).cast(to)


def is_grant_id(value: Column | str) -> Column:
    return trim_text(value).rlike(GRANT_ID_PATTERN)


def add_missing_columns(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Add the columns of ``wanted`` (name -> type) the frame lacks, as null."""
    lacking = {n: F.lit(None).cast(t) for n, t in wanted.items() if n not in df.columns}
    return df.withColumns(lacking) if lacking else df


def file_name(path: Column | str) -> Column:
    return F.element_at(F.split(as_column(path), "/"), -1)


def file_stem(path: Column | str) -> Column:
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def file_extension(path: Column | str) -> Column:
    return F.regexp_extract(file_name(path), r".(\.[^.]*)$", 1)
