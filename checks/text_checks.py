"""TX: extraction from report text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Tables, check
from checks.shapes import LINES_SQL, report_lines
from grantflow.functions import dates as D
from grantflow.functions import reports as R
from grantflow.plans.history import (
    award_lines,
    extract,
    leftover_laws,
    marked_lines,
    report_dates,
    sectioned_laws,
    sections,
)

WITH_LINES = "WITH " + LINES_SQL.strip()


@check(
    "TX1_report_date",
    """SELECT o_orderkey, CASE o_orderkey % 4
         WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
         WHEN 2 THEN CASE WHEN o_orderkey % 14 BETWEEN 1 AND 12
                     THEN '2023-' || lpad(CAST(o_orderkey % 14 AS VARCHAR), 2, '0') || '-01' END
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS report_date FROM orders""",
)
def tx1(t: Tables):
    """A long date after an ISO one still comes first; ISO alone; none, so the file month; long alone."""
    texts = t.orders.selectExpr(
        "o_orderkey",
        "concat('in/report-2023-', o_orderkey % 14, '.pdf') as name",
        """case o_orderkey % 4
             when 0 then concat('printed 2001-01-01 as of ', date_format(o_orderdate, 'MMMM d, yyyy'), '.')
             when 1 then concat('as of ', date_format(o_orderdate, 'yyyy-MM-dd'))
             when 2 then 'nothing dated'
             else concat('on ', date_format(o_orderdate, 'MMMM d, yyyy')) end as text""",
    )
    return texts.select("o_orderkey", D.report_date("text", "name").alias("report_date"))


@check(
    "TX2_long_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders""",
)
def tx2(t: Tables):
    text = F.expr(
        "case when o_orderkey % 7 = 0 then '' else date_format(o_orderdate, 'MMMM d, yyyy') end"
    )
    return t.orders.select("o_orderkey", D.long_date(text).alias("day"))


@check(
    "TX3_file_month",
    """SELECT doc_id, CASE WHEN doc_id % 16 BETWEEN 1 AND 12
         THEN '2023-' || lpad(CAST(doc_id % 16 AS VARCHAR), 2, '0') || '-01' END AS month FROM documents""",
)
def tx3(t: Tables):
    name = F.expr("case when doc_id % 16 = 14 then 'final.pdf' else concat('report-2023-', doc_id % 16, '.pdf') end")
    return t.documents.select("doc_id", D.month_from_file_name(name).alias("month"))


@check("TX4_report_date_repair", WITH_LINES + "SELECT doc_id, report_date FROM dates")
def tx4(t: Tables):
    return report_dates(report_lines(t))


@check(
    "TX5_law_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
       FROM orders""",
)
def tx5(t: Tables):
    text = F.expr(
        """case when o_orderkey % 9 = 0 then 'unclear'
                when o_orderkey % 8 = 4 then date_format(o_orderdate, "MMM. d-yyyy")
                when o_orderkey % 8 = 5 then date_format(o_orderdate, "MMM.d, yyyy")
                when month(o_orderdate) = 9 and o_orderkey % 2 = 0 then concat('Sept.', date_format(o_orderdate, 'd, yyyy'))
                when month(o_orderdate) = 9 then concat('Sept. ', date_format(o_orderdate, 'd, yyyy'))
                when o_orderkey % 4 = 0 then date_format(o_orderdate, 'MMM. d, yyyy')
                when o_orderkey % 4 = 1 then date_format(o_orderdate, 'MMMM d, yyyy')
                when o_orderkey % 4 = 2 then date_format(o_orderdate, 'MMM d yyyy')
                else date_format(o_orderdate, 'MM/dd/yyyy') end"""
    )
    return t.orders.select("o_orderkey", D.law_date(text).alias("day"))


@check(
    "TX6_laws_under_event",
    WITH_LINES + "SELECT doc_id, line_no, event AS disaster_event, pl_number, pl_text AS pl_date FROM direct",
)
def tx6(t: Tables):
    return sectioned_laws(sections(marked_lines(report_lines(t)))).drop("pos")


@check(
    "TX7_leftover_laws",
    WITH_LINES + "SELECT doc_id, line_no, event AS disaster_event, pl_number FROM leftover",
)
def tx7(t: Tables):
    tied = sections(marked_lines(report_lines(t)))
    return leftover_laws(tied, sectioned_laws(tied)).drop("pos", "pl_date")


@check(
    "TX8_award_lines",
    WITH_LINES
    + """SELECT doc_id, line_no, event AS disaster_event, grantee_name, CAST(grant_award AS VARCHAR) AS grant_award
         FROM award_lines""",
)
def tx8(t: Tables):
    return award_lines(sections(marked_lines(report_lines(t)))).drop("territory")


@check("TX9_headings", WITH_LINES + "SELECT doc_id, line_no, heading FROM headed")
def tx9(t: Tables):
    return report_lines(t).select("doc_id", "line_no", R.first_pattern("line").alias("heading"))


@check(
    "TX10_event_name_year",
    """SELECT o_orderkey, 'Storm ' || o_orderstatus AS name,
         CASE o_orderkey % 3 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR)
              WHEN 1 THEN year(o_orderdate) || '-' || (year(o_orderdate) + 1) END AS year FROM orders""",
)
def tx10(t: Tables):
    event = F.expr(
        """concat('Storm ', o_orderstatus, case o_orderkey % 3 when 0 then concat(' ', year(o_orderdate))
           when 1 then concat('  ', year(o_orderdate), '-', year(o_orderdate) + 1) else '' end)"""
    )
    return t.orders.select("o_orderkey", R.event_name(event).alias("name"), R.event_year(event).alias("year"))


@check(
    "TX_extract_laws",
    WITH_LINES + "SELECT doc_id, line_no, event AS disaster_event, pl_number, pl_text AS pl_date FROM laws",
)
def tx_extract(t: Tables):
    """All of the above: laws of events that have an award."""
    laws, _ = extract(report_lines(t))
    return laws.drop("pos")
