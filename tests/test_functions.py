"""Column functions against hand-written results."""

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from grantflow.functions import cleaning as C
from grantflow.functions import dates as D
from grantflow.functions import reports as R


def run(spark, function, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in frame.orderBy("i").select(function(F.col("v"))).collect()]


def text(spark, function, values):
    return [None if v is None else str(v) for v in run(spark, function, values)]


def test_strip_list_literal(spark):
    given = ["['Q']", "['Q', 'N']", None]
    assert run(spark, lambda c: C.strip_chars(c, "[]'\""), given) == ["Q", "Q', 'N", None]


def test_currency_whole_drops_the_point(spark):
    given = ["$1,234", "($1,200)", "$ -", "$", "$1,234.56", None, "1-2"]
    assert run(spark, C.currency_whole, given) == [1234, -1200, 0, 0, 123456, None, None]


def test_currency_decimal_keeps_cents(spark):
    given = ["$1,234.56", "($1,200)", "$ -", None]
    assert run(spark, C.currency_decimal, given) == [Decimal("1234.56"), Decimal("-1200"), 0, None]


def test_amount(spark):
    assert run(spark, C.amount, ["$1,234.50", " $ 7 ", "x"]) == [Decimal("1234.50"), Decimal("7.00"), None]


def test_percentage(spark):
    assert run(spark, C.percentage, ["45%", "45,5 %", None]) == [Decimal("45.00"), Decimal("45.50"), None]


def test_trim_takes_every_white_space(spark):
    assert run(spark, C.trim_text, ["  a b\t\r\n", "x", None]) == ["a b", "x", None]


def test_missing_markers(spark):
    assert run(spark, C.missing_to_null, ["", "nan", "No answer found", "x", None]) == [None, None, None, "x", None]


def test_codes(spark):
    assert run(spark, C.integer_code, ["86.0", "086", None, "A1"]) == ["86", "86", None, None]
    assert run(spark, C.whole_code, ["086", "86.0", None]) == [86, 86, None]


def test_grant_ids(spark):
    given = ["B-17-DM-72-0001", " B-17-DM-72-0001 ", "B-17-DM-72-00012", "Total", ""]
    assert run(spark, C.is_grant_id, given) == [True, True, False, False, False]


def test_strict_date_fails(spark):
    assert text(spark, D.strict_date, ["2024-01-31", None]) == ["2024-01-31", None]
    with pytest.raises(PySparkException):
        run(spark, D.strict_date, ["31.1.2024"])


def test_lenient_date(spark):
    given = ["2024-01-31", "01/31/2024", "January 31, 2024", "2024-02-30", "", None]
    assert run(spark, D.staging_date, given) == ["01-31-2024"] * 3 + [None] * 3


def test_law_date(spark):
    given = ["Sept. 8, 2017", "Feb. 9, 2018", "May 5, 2020", "September 8 2017", "Sept 8, 2017", "soon", None]
    assert text(spark, D.law_date, given) == [
        "2017-09-08", "2018-02-09", "2020-05-05", "2017-09-08", "2017-09-08", None, None,
    ]


def test_file_name_dates(spark):
    given = ["report-2023-7.pdf", "report-2023-13.pdf", "final.pdf"]
    assert text(spark, D.month_from_file_name, given) == ["2023-07-01", None, None]
    given = ["report-2023-7", "report 1-15-2024", "final"]
    assert run(spark, D.date_key_of_file, given) == ["2023_7", "1_15_2024", "unknown_date"]


def test_report_date_falls_through(spark):
    frame = spark.createDataFrame(
        [(0, "printed 2020-01-02, as of March 5, 2021", "r-2022-1"), (1, "2020-01-02", "r-2022-1"),
         (2, "none", "r-2022-1"), (3, "none", "r")],
        "i int, t string, n string",
    )
    found = frame.orderBy("i").select(D.report_date("t", "n").cast("string")).collect()
    assert [r[0] for r in found] == ["2021-03-05", "2020-01-02", "2022-01-01", None]


def test_year_repair(spark):
    frame = spark.createDataFrame(
        [(0, "March 5, 202", "2023"), (1, "March 5, 20244", "2023"), (2, "March 5, 2024", "2023"), (3, "March 5, 202", None)],
        "i int, d string, y string",
    )
    found = frame.orderBy("i").select(D.repair_year("d", "y")).collect()
    assert [r[0] for r in found] == ["March 5, 2023", "March 5, 2023", "March 5, 2024", "March 5, 202"]


def test_headings_first_pattern_wins(spark):
    given = [
        "Hurricanes Irma, Maria 2017", "Floods 2016-2017", "2017 Hurricanes and more", "2016-2017 Floods x",
        "Hurricanes Katrina, Rita", "P.L. 115-56", "CDBG-DR Grant History 2001-2023", "Tornado 2011 and 2012 text",
    ]
    assert run(spark, R.first_pattern, given) == [
        "Hurricanes Irma, Maria 2017", "Floods 2016-2017", "2017 Hurricanes and more", "2016-2017 Floods x",
        "Hurricanes Katrina, Rita", None, None, "Tornado 2011",
    ]


def test_laws_of_a_line(spark):
    given = ["P.L. 115-56 Sept. 8, 2017 and PL 115-123", "P.L. 114-223", "none", "P.L. 115-1234"]
    found = [[tuple(x) for x in row] for row in run(spark, R.law_mentions, given)]
    assert found[0][0] == ("P.L. 115-56", "Sept. 8, 2017")
    assert found[0][1][0] == "PL 115-123"
    assert found[1:3] == [[("P.L. 114-223", None)], []]
    assert run(spark, R.standalone_laws, given) == [["P.L. 115-56", "PL 115-123"], ["P.L. 114-223"], [], []]


def test_award_lines(spark):
    given = [
        "PUERTO RICO Department of Housing $1,507,179,000", "PUERTO RICO $5", "PUERTO RICO a $1 $2",
        "FLORIDA State $615", "PUERTO RICO none $", "no dollar PUERTO RICO",
    ]
    assert run(spark, R.has_award, given) == [True, True, False, False, False, False]
    assert run(spark, R.award_grantee, given)[:2] == ["Department of Housing", "PUERTO RICO"]
    assert [str(v) for v in run(spark, R.award_amount, given)[:2]] == ["1507179000.00", "5.00"]


def test_event_name_and_year(spark):
    given = ["Hurricanes Irma, Maria 2017", "Floods 2016-2017", "2017 Storms", "Storms", None]
    assert run(spark, R.event_name, given) == ["Hurricanes Irma, Maria", "Floods", "2017 Storms", "Storms", None]
    assert run(spark, R.event_year, given) == ["2017", "2016-2017", "2017", None, None]
