"""PR, FL: projection, scalar cleaning, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Tables, check, dec
from grantflow.functions import cleaning as C
from grantflow.functions import dates as D
from grantflow.operators.rows import drop_null_columns, null_counts, page, search, stack
from grantflow.plans.financial import unify_layouts

MONEY = "CAST(CAST({0} AS DECIMAL(18,2)) AS VARCHAR)"


@check(
    "PR1_project_rename",
    """SELECT o_orderkey AS grant_id, o_orderstatus AS award_type, o_orderpriority AS description FROM orders""",
)
def pr1(t: Tables):
    names = {"o_orderkey": "grant_id", "o_orderstatus": "award_type", "o_orderpriority": "description"}
    return t.orders.select(*names).withColumnsRenamed(names)


@check("PR2_drop_columns", "SELECT * EXCLUDE (o_orderdate, o_totalprice) FROM orders")
def pr2(t: Tables):
    return t.orders.drop("o_orderdate", "o_totalprice")


# Four printed forms of a date and junk in every seventh row.
DATE_TEXT_SQL = """
WITH texts AS (
  SELECT o_orderkey, o_orderdate, CASE
    WHEN o_orderkey % 7 = 0 THEN 'junk'
    WHEN o_orderkey % 4 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
    WHEN o_orderkey % 4 = 1 THEN strftime(o_orderdate, '%m/%d/%Y')
    WHEN o_orderkey % 4 = 2 THEN strftime(o_orderdate, '%B %-d, %Y')
    ELSE strftime(o_orderdate, '%b %-d, %Y') END AS text
  FROM orders
), parsed AS (
  SELECT *, coalesce(try_strptime(text, '%Y-%m-%d'), try_strptime(text, '%m/%d/%Y'),
                     try_strptime(text, '%B %-d, %Y'), try_strptime(text, '%b %-d, %Y')) AS found
  FROM texts
)"""


def date_texts(t: Tables):
    return t.orders.selectExpr(
        "o_orderkey",
        """case when o_orderkey % 7 = 0 then 'junk'
                when o_orderkey % 4 = 0 then date_format(o_orderdate, 'yyyy-MM-dd')
                when o_orderkey % 4 = 1 then date_format(o_orderdate, 'MM/dd/yyyy')
                when o_orderkey % 4 = 2 then date_format(o_orderdate, 'MMMM d, yyyy')
                else date_format(o_orderdate, 'MMM d, yyyy') end as text""",
    )


@check(
    "PR3_lenient_date",
    DATE_TEXT_SQL + "SELECT o_orderkey, strftime(found, '%m-%d-%Y') AS staged FROM parsed",
)
def pr3(t: Tables):
    return date_texts(t).select("o_orderkey", D.staging_date("text").alias("staged"))


@check(
    "PR4_strict_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%m-%d-%Y') AS staged FROM orders",
)
def pr4(t: Tables):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("text"))
    return text.select("o_orderkey", F.date_format(D.strict_date("text"), "MM-dd-yyyy").alias("staged"))


@check(
    "PR5_lenient_number",
    """SELECT c_custkey, CAST(TRY_CAST(CASE WHEN c_custkey % 5 = 0 THEN 'n/a'
         ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS DECIMAL(18,2)) AS VARCHAR) AS amount
       FROM customer""",
)
def pr5(t: Tables):
    text = F.when(F.col("c_custkey") % 5 == 0, F.lit("n/a")).otherwise(dec("c_acctbal").cast("string"))
    return t.customer.select("c_custkey", C.lenient_number(text).alias("amount"))


@check(
    "PR6_strict_casts",
    """SELECT l_orderkey, l_linenumber, l_shipdate::DATE::VARCHAR AS day, year(l_shipdate)::INT AS year,
              l_returnflag = 'A' AS flag, CAST(l_quantity AS BIGINT) AS quantity FROM lineitem""",
)
def pr6(t: Tables):
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.to_date("l_shipdate").alias("day"),
        C.strict(F.date_format("l_shipdate", "yyyy"), "int").alias("year"),
        C.strict(F.when(F.col("l_returnflag") == "A", F.lit("True")).otherwise(F.lit("False")), "boolean").alias("flag"),
        C.strict(F.col("l_quantity").cast("decimal(18,0)").cast("string"), "bigint").alias("quantity"),
    )


@check("PR7_trim", "SELECT o_orderkey, o_orderpriority AS clean FROM orders")
def pr7(t: Tables):
    padded = F.concat(F.lit("\t  "), F.col("o_orderpriority"), F.lit(" \r\n"))
    return t.orders.select("o_orderkey", C.trim_text(padded).alias("clean"))


@check(
    "PR8_strip_chars",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN '1'', ''2' ELSE left(o_orderpriority, 1) END AS code
       FROM orders""",
)
def pr8(t: Tables):
    text = F.when(F.col("o_orderkey") % 10 == 0, F.lit("['1', '2']")).otherwise(
        F.concat(F.lit("['"), F.substring("o_orderpriority", 1, 1), F.lit("']"))
    )
    return t.orders.select("o_orderkey", C.strip_chars(text, "[]'\"").alias("code"))


@check(
    "PR9_missing_markers",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN o_orderpriority END AS a,
              CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS b FROM orders""",
)
def pr9(t: Tables):
    frame = t.orders.selectExpr(
        "o_orderkey",
        """case o_orderkey % 4 when 0 then '' when 1 then 'nan' when 2 then 'No answer found'
           else o_orderpriority end as a""",
        "case when o_orderstatus = 'O' then '' else o_orderstatus end as b",
    )
    return C.normalise_missing(frame)


def money_texts(t: Tables):
    """Account balances as printed: ``($1,234)``, ``$ -``, ``$1,234``."""
    return t.customer.selectExpr(
        "c_custkey",
        """case when c_custkey % 9 = 0 then '$ -'
                when c_custkey % 11 = 0 then null
                when c_acctbal < 0 then concat('($', format_number(-cast(c_acctbal as decimal(18,2)), 2), ')')
                else concat('$', format_number(cast(c_acctbal as decimal(18,2)), 2)) end as text""",
    )


@check(
    "PR10_currency_whole",
    """SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 0 WHEN c_custkey % 11 = 0 THEN NULL
              ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) * 100 AS BIGINT) END AS whole FROM customer""",
)
def pr10(t: Tables):
    """Cents are printed here, and the point is dropped like any other character."""
    return money_texts(t).select("c_custkey", C.currency_whole("text").alias("whole"))


@check(
    "PR10_currency_decimal",
    """SELECT c_custkey, CAST(CASE WHEN c_custkey % 9 = 0 THEN 0 WHEN c_custkey % 11 = 0 THEN NULL
              ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS VARCHAR) AS exact FROM
       (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal FROM customer)""",
)
def pr10_decimal(t: Tables):
    return money_texts(t).select("c_custkey", C.currency_decimal("text").alias("exact"))


@check(
    "PR11_amount",
    "SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS amount FROM orders",
)
def pr11(t: Tables):
    text = F.concat(F.lit("$ "), F.format_number(dec("o_totalprice"), 2))
    return t.orders.select("o_orderkey", C.amount(text).alias("amount"))


@check(
    "PR12_percentage",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 7 THEN NULL ELSE
              CAST(CAST(CAST(l_discount * 100 AS INT) + 0.5 AS DECIMAL(5,2)) AS VARCHAR) END AS share FROM lineitem""",
)
def pr12(t: Tables):
    text = F.when(
        F.col("l_linenumber") != 7,
        F.concat(F.round(F.col("l_discount") * 100).cast("int").cast("string"), F.lit(",5 %")),
    )
    return t.lineitem.select("l_orderkey", "l_linenumber", C.percentage(text).alias("share"))


@check(
    "PR13_digits_and_point",
    "SELECT doc_id, regexp_replace(text, '[^0-9.]', '', 'g') AS kept FROM documents",
)
def pr13(t: Tables):
    return t.documents.select("doc_id", C.digits_and_point("text").alias("kept"))


@check(
    "PR14_integer_code",
    """SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_custkey AS VARCHAR) END AS code
       FROM customer""",
)
def pr14(t: Tables):
    text = F.when(F.col("c_custkey") % 6 != 0, F.concat(F.lit("0"), "c_custkey", F.lit(".0")))
    return t.customer.select("c_custkey", C.integer_code(text).alias("code"))


@check(
    "PR15_add_missing_columns",
    """SELECT o_orderkey, o_orderstatus, CAST(NULL AS VARCHAR) AS note, CAST(NULL AS INTEGER) AS age,
              'Apr 1 thru Jun 30, 2024' AS time_period FROM orders""",
)
def pr15(t: Tables):
    frame = t.orders.select("o_orderkey", "o_orderstatus")
    added = C.add_missing_columns(frame, {"o_orderstatus": "string", "note": "string", "age": "int"})
    return added.withColumn("time_period", F.lit("Apr 1 thru Jun 30, 2024"))


@check(
    "PR16_two_layouts",
    """SELECT o_orderkey, o_orderstatus AS "Grantee", 'B-' || o_orderkey AS "Grant ID", o_orderpriority AS "Spending Status",
              CASE WHEN year(o_orderdate) < 1998 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS "Disaster Year"
       FROM orders""",
)
def pr16(t: Tables):
    """Orders before 1998 in the layout of six columns, later ones in that of ten."""
    old = t.orders.where("o_orderdate < timestamp_ntz'1998-01-01'").selectExpr(
        "o_orderkey", "o_orderstatus as c0", "concat('B-', o_orderkey) as c1", "'1' as c2", "'2' as c3",
        "'gone' as c4", "o_orderpriority as c5",
    )
    new = t.orders.where("o_orderdate >= timestamp_ntz'1998-01-01'").selectExpr(
        "o_orderkey", "o_orderstatus as c0", "concat('B-', o_orderkey) as c1", "'1' as c2", "'2' as c3",
        "date_format(o_orderdate, 'yyyy') as c4", "'5' as c5", "'6' as c6", "'7' as c7",
        "o_orderpriority as c8", "'9' as c9",
    )
    return unify_layouts(old, new, ["o_orderkey"]).select(
        "o_orderkey", "Grantee", "Grant ID", "Spending Status", "Disaster Year"
    )


@check(
    "PR17_date_columns",
    DATE_TEXT_SQL + "SELECT o_orderkey, CAST(CAST(found AS DATE) AS VARCHAR) AS day FROM parsed",
)
def pr17(t: Tables):
    return date_texts(t).select("o_orderkey", D.lenient_date("text").alias("day"))


# --- filters --------------------------------------------------------------------------


@check("FL1_equality", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def fl1(t: Tables):
    return search(t.orders, equal={"o_orderstatus": "F"}).select("o_orderkey", "o_custkey")


@check(
    "FL2_award_search",
    """SELECT o_orderkey, o_orderpriority FROM orders
       WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31'
         AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O'""",
)
def fl2(t: Tables):
    return search(
        t.orders,
        dates=("o_orderdate", "1996-01-01", "1998-12-31"),
        any_of={"o_orderpriority": ["1-URGENT", "2-HIGH"]},
        equal={"o_orderstatus": "O"},
    ).select("o_orderkey", "o_orderpriority")


@check(
    "FL4_grant_id_rows",
    """SELECT conv_id, turn, regexp_full_match(trim(code), 'B-[0-9]{2}-[A-Z]{2}-[0-9]{2}-[0-9]{4}') AS is_grant
       FROM (SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN ' B-17-DM-72-' || lpad(CAST(conv_id % 10000 AS VARCHAR), 4, '0')
             WHEN 1 THEN 'B-17-DM-72-' || conv_id || 'x' ELSE text END AS code FROM conversations)""",
)
def fl4(t: Tables):
    code = F.expr(
        """case turn % 3 when 0 then concat(' B-17-DM-72-', lpad(cast(conv_id % 10000 as string), 4, '0'))
           when 1 then concat('B-17-DM-72-', conv_id, 'x') else text end"""
    )
    return t.conversations.select("conv_id", "turn", C.is_grant_id(code).alias("is_grant"))


def holed_orders(t: Tables):
    return t.orders.selectExpr(
        "o_orderkey",
        "nullif(o_orderstatus, 'P') as o_orderstatus",
        "case when o_orderkey % 5 = 0 then null else o_orderpriority end as o_orderpriority",
    )


HOLED_SQL = """
WITH holed AS (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority FROM orders
)"""


@check(
    "FL5_drop_null_rows",
    HOLED_SQL + "SELECT * FROM holed WHERE o_orderstatus IS NOT NULL AND o_orderpriority IS NOT NULL",
)
def fl5(t: Tables):
    return holed_orders(t).dropna()


@check("FL5_drop_null_subset", HOLED_SQL + "SELECT * FROM holed WHERE o_orderpriority IS NOT NULL")
def fl5_subset(t: Tables):
    return holed_orders(t).dropna(subset=["o_orderpriority"])


@check("FL6_drop_null_columns", "SELECT o_orderkey FROM orders")
def fl6(t: Tables):
    return drop_null_columns(holed_orders(t))


@check(
    "AG7_null_counts",
    HOLED_SQL
    + """SELECT count(*) - count(o_orderkey) AS o_orderkey, count(*) - count(o_orderstatus) AS o_orderstatus,
                count(*) - count(o_orderpriority) AS o_orderpriority FROM holed""",
)
def ag7(t: Tables):
    return null_counts(holed_orders(t))


@check(
    "OR10_sorted_page",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM orders
       ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC, o_orderkey LIMIT 100 OFFSET 100""",
)
def or10(t: Tables):
    frame = t.orders.select("o_orderkey", dec("o_totalprice").alias("price"))
    return page(frame, ["price desc", "o_orderkey"], number=2, size=100)


@check(
    "OR10_deep_pages",
    """SELECT page, l_orderkey, l_linenumber, CAST(l_quantity AS INT) AS quantity, l_returnflag FROM
         (SELECT *, (row_number() OVER (ORDER BY l_returnflag DESC, CAST(l_quantity AS INT), l_orderkey, l_linenumber) - 1) // 50 + 1 AS page
          FROM lineitem)
       WHERE page IN (1, 40, 90)""",
)
def or10_deep(t: Tables):
    """Three pages, the second behind tens of thousands of ties of the first two keys, one past the end."""
    frame = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("int").alias("quantity"), "l_returnflag")
    order = ["l_returnflag desc", "quantity", "l_orderkey", "l_linenumber"]
    pages = [(n, page(frame, order, n, 50, few=500)) for n in (1, 40, 90, 10**7)]
    return stack([rows.withColumn("page", F.lit(n).cast("bigint")) for n, rows in pages])
