"""OR: operators that follow row order, and ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Tables, check
from checks.shapes import BUDGET_SQL, report_cells
from grantflow.operators.numbering import (
    file_ids,
    first_seen_ids,
    positions,
    serial_ids,
    stable_id,
)
from grantflow.operators.ordered import (
    carry_down,
    fold_name_only,
    forward_fill,
    repair_wrapped,
    split_header_detail,
)
from grantflow.plans.performance import budget_rows


@check(
    "OR1_carry_down",
    """SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (
         PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS question
       FROM conversations""",
)
def or1(t: Tables):
    asked = F.when(F.col("role") == "user", F.col("text"))
    return carry_down(t.conversations, ["conv_id"], "turn", asked, "question").select(
        "conv_id", "turn", "question"
    )


@check(
    "OR1_carry_down_one_group",
    """SELECT o_orderkey, last_value(CASE WHEN o_orderkey % 700 = 3 THEN o_custkey END IGNORE NULLS) OVER (
         ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM orders""",
)
def or1_one_group(t: Tables):
    """All orders as one document, in blocks of 512 rows: sections cross many blocks."""
    lines = t.orders.select(F.lit("all").alias("doc"), "o_orderkey", "o_custkey")
    heading = F.when(F.col("o_orderkey") % 700 == 3, F.col("o_custkey"))
    return carry_down(lines, ["doc"], "o_orderkey", heading, "section", block=512).select(
        "o_orderkey", "section"
    )


@check(
    "OR3_forward_fill",
    """SELECT o_custkey, o_orderkey, last_value(CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END IGNORE NULLS)
         OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS name
       FROM orders""",
)
def or3(t: Tables):
    holed = t.orders.selectExpr(
        "o_custkey", "o_orderkey", "case when o_orderkey % 3 = 0 then o_orderpriority end as name"
    )
    return forward_fill(holed, ["o_custkey"], "o_orderkey", "name", block=4096)


@check(
    "OR2_headers",
    "WITH " + BUDGET_SQL.strip()
    + """SELECT b.doc_id, b.row_no, b.c0 AS description, h.id AS description_id FROM budget b
         JOIN head_ids h ON h.doc_id = b.doc_id AND h.head = b.c0 WHERE b.is_head""",
)
def or2_headers(t: Tables):
    headers, _ = split_header_detail(budget_rows(report_cells(t)), ["doc_id"], "row_no", "c0")
    return headers.select("doc_id", "row_no", "description", "description_id")


@check(
    "OR2_details",
    "WITH " + BUDGET_SQL.strip()
    + """SELECT b.doc_id, b.row_no, b.c0 AS grant_id, h.own_id AS description_id FROM budget_tied b
         JOIN head_ids h ON h.doc_id = b.doc_id AND h.head = b.head WHERE NOT b.is_head""",
)
def or2_details(t: Tables):
    """Ids that start anew in every document."""
    _, details = split_header_detail(
        budget_rows(report_cells(t)), ["doc_id"], "row_no", "c0", chained=False
    )
    return details.select("doc_id", "row_no", F.col("c0").alias("grant_id"), "description_id")


FRAGMENTS = ["", "Of.", "And ornd.", "Ietzte."]
WRAP_PASS = """
p{n} AS (
  SELECT doc_id, i, CASE WHEN lead(moved) OVER w
           THEN trim(CASE WHEN moved THEN '' ELSE f END) || ' ' || trim(lead(f) OVER w)
           ELSE CASE WHEN moved THEN '' ELSE f END END AS f
  FROM (SELECT doc_id, i, f, i > 1 AND trim(f) IN ('', 'Of.', 'And ornd.', 'Ietzte.') AS moved FROM p{m})
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)
)"""
WRAP_SQL = (
    """WITH p0 AS (
  SELECT doc_id, unnest(generate_series(1, len(parts))) AS i, unnest(parts) AS f
  FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)
),"""
    + ",".join(WRAP_PASS.format(n=n, m=n - 1) for n in (1, 2, 3))
)


@check("OR4_wrapped_names", WRAP_SQL + "SELECT doc_id, CAST(i - 1 AS INT) AS line_no, f AS name FROM p3")
def or4(t: Tables):
    """Lines of all documents as names; blank and common short lines are fragments."""
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "name"))
    return repair_wrapped(lines, ["doc_id"], "line_no", "name", FRAGMENTS, block=64)


@check(
    "OR5_fold_name_only",
    """WITH base AS (
         SELECT l_orderkey // 50 AS file, l_orderkey % 50 AS line_no, min(l_returnflag) AS name,
                CASE WHEN l_orderkey % 3 = 0 THEN max(l_linestatus) END AS status
         FROM lineitem GROUP BY l_orderkey
       ), tied AS (
         SELECT *, last_value(CASE WHEN status IS NOT NULL OR line_no = 0 THEN line_no END IGNORE NULLS) OVER (
           PARTITION BY file ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS anchor FROM base
       )
       SELECT file, anchor AS line_no, string_agg(name, ' ' ORDER BY line_no) AS name, max(status) AS status
       FROM tied WHERE anchor IS NOT NULL GROUP BY file, anchor""",
)
def or5(t: Tables):
    rows = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_returnflag").alias("name"), F.max("l_linestatus").alias("status")
    ).selectExpr(
        "l_orderkey div 50 as file", "l_orderkey % 50 as line_no", "name",
        "case when l_orderkey % 3 = 0 then status end as status",
    )
    return fold_name_only(rows, ["file"], "line_no", "name", ["status"], block=16)


@check(
    "OR6_first_seen_ids",
    """SELECT o_custkey, row_number() OVER (ORDER BY min(o_orderkey)) AS grantee_id FROM orders GROUP BY o_custkey""",
)
def or6(t: Tables):
    return first_seen_ids(t.orders, ["o_custkey"], ["o_orderkey"], "grantee_id")


@check(
    "OR7_continue_ids",
    """SELECT o_custkey, 1000 + row_number() OVER (ORDER BY min(o_orderkey)) AS grantee_id FROM orders
       WHERE o_custkey % 4 <> 0 GROUP BY o_custkey""",
)
def or7(t: Tables):
    """Every fourth customer is stored already, the largest stored id is 1000."""
    stored = t.orders.where("o_custkey % 4 = 0").groupBy("o_custkey").agg(
        F.when(F.col("o_custkey") == 0, F.lit(1000)).otherwise(F.lit(7)).cast("bigint").alias("grantee_id")
    )
    top = t.customer.where("c_custkey = 0").selectExpr("c_custkey as o_custkey", "1000L as grantee_id")
    return first_seen_ids(
        t.orders, ["o_custkey"], ["o_orderkey"], "grantee_id", stored=stored.unionByName(top)
    )


@check(
    "OR7_serial_ids",
    """SELECT o_custkey, o_orderkey, 127 + row_number() OVER (ORDER BY o_custkey, o_orderkey) AS performance_id
       FROM orders""",
)
def or7_serial(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey")
    return serial_ids(rows, ["o_custkey"], "o_orderkey", "performance_id", start=128, block=2048)


@check(
    "OR8_file_ids",
    """SELECT 'r' || lpad(CAST(conv_id AS VARCHAR), 20, '0') AS doc_id,
              row_number() OVER (ORDER BY conv_id) AS activity_id
       FROM (SELECT DISTINCT conv_id FROM conversations)""",
)
def or8(t: Tables):
    return file_ids(report_cells(t), "doc_id", "activity_id")


@check(
    "OR8_positions",
    """SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS place FROM events""",
)
def or8_positions(t: Tables):
    return positions(t.events.select("user_id", "event_id"), ["user_id"], [], "event_id", "place", block=1024)


@check(
    "OR9_stable_ids",
    """SELECT name, md5(name) AS recipient_id FROM
         (SELECT c_name AS name FROM customer UNION SELECT s_name FROM supplier)""",
)
def or9(t: Tables):
    names = t.customer.selectExpr("concat(' ', c_name) as name").union(t.supplier.selectExpr("s_name as name"))
    return names.select(F.trim("name").alias("name"), stable_id("name").alias("recipient_id")).distinct()
