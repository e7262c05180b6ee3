"""JN, AG, SE: joins, distinct, aggregates, set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import Tables, check, dec
from checks.shapes import ANSWERS_SQL, question_blocks
from grantflow.fixed_values import QUESTION_ALIASES
from grantflow.functions.cleaning import normalise_missing
from grantflow.operators.joins import (
    enrich,
    full_join,
    keep_absent,
    keep_present,
    lookup,
    new_rows,
    state_code,
)
from grantflow.operators.load import insert_if_absent
from grantflow.operators.rows import (
    blocks_of,
    first_per_key,
    next_id,
    stack,
    stack_distinct,
    stack_roles,
)
from grantflow.sources.documents import question_answers


@check(
    "JN1_left_join",
    """SELECT o_orderkey, c_name, c_mktsegment FROM orders
       LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON o_custkey = c_custkey""",
)
def jn1(t: Tables):
    some = t.customer.where("c_custkey % 3 <> 0")
    joined = enrich(t.orders, some, {"o_custkey": "c_custkey"}, ["c_name", "c_mktsegment"])
    return joined.select("o_orderkey", "c_name", "c_mktsegment")


@check(
    "JN2_left_join_same_key",
    """SELECT l.o_orderkey, r.n FROM orders l LEFT JOIN
         (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_orderkey) r
         ON l.o_orderkey = r.l_orderkey""",
)
def jn2(t: Tables):
    counts = (
        t.lineitem.where("l_returnflag = 'A'").groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return enrich(t.orders.select("o_orderkey"), counts, ["o_orderkey"], ["n"])


@check(
    "JN3_full_outer_join",
    """SELECT coalesce(a.name, b.name) AS agency_name, a.suppliers, b.customers FROM
         (SELECT 'Agency ' || s_nationkey AS name, count(*) AS suppliers FROM supplier GROUP BY 1) a
         FULL JOIN (SELECT 'Agency ' || (c_nationkey + 5) AS name, count(*) AS customers FROM customer GROUP BY 1) b
         ON a.name = b.name""",
)
def jn3(t: Tables):
    a = t.supplier.groupBy(F.concat(F.lit("Agency "), "s_nationkey").alias("agency_name")).agg(
        F.count(F.lit(1)).alias("suppliers")
    )
    b = t.customer.groupBy(F.concat(F.lit("Agency "), F.col("c_nationkey") + 5).alias("agency_name")).agg(
        F.count(F.lit(1)).alias("customers")
    )
    return full_join(a, b, ["agency_name"])


@check(
    "JN4_semi_join",
    """SELECT c_custkey, c_name FROM customer WHERE c_custkey IN
         (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def jn4(t: Tables):
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").withColumnRenamed("o_custkey", "c_custkey")
    return keep_present(t.customer, urgent, ["c_custkey"]).select("c_custkey", "c_name")


STORED_SQL = """
WITH fresh AS (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price
  FROM orders, (VALUES (0), (1)) v(j) WHERE j = 0 OR o_orderkey % 4 = 1
), stored AS (
  SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
         CASE WHEN o_orderkey % 5 = 0 THEN NULL
              WHEN o_orderkey % 6 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price
  FROM orders WHERE o_orderkey % 2 = 0
)"""


def fresh_orders(t: Tables):
    """Orders with nulls; every fourth row twice."""
    base = t.orders.select(
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 5 != 0, dec("o_totalprice")).alias("price"),
    )
    return base.unionByName(base.where("o_orderkey % 4 = 1"))


def stored_orders(t: Tables):
    """Even orders under a serial id, some with another price."""
    return t.orders.where("o_orderkey % 2 = 0").select(
        (F.col("o_orderkey") + 900_000).alias("order_id"),
        "o_orderkey",
        F.expr("nullif(o_orderstatus, 'P')").alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 5 == 0, F.lit(None))
        .when(F.col("o_orderkey") % 6 == 0, F.lit(0).cast("decimal(18,2)"))
        .otherwise(dec("o_totalprice"))
        .alias("price"),
    )


@check(
    "JN5_new_rows",
    STORED_SQL
    + """SELECT o_orderkey, o_orderstatus, CAST(price AS VARCHAR) AS price FROM fresh f WHERE NOT EXISTS (
           SELECT 1 FROM stored s WHERE s.o_orderkey IS NOT DISTINCT FROM f.o_orderkey
             AND s.o_orderstatus IS NOT DISTINCT FROM f.o_orderstatus AND s.price IS NOT DISTINCT FROM f.price)""",
)
def jn5(t: Tables):
    return new_rows(fresh_orders(t), stored_orders(t), ignore=["order_id"])


@check(
    "SE4_new_rows_keep_duplicates",
    STORED_SQL
    + """SELECT o_orderkey, count(*) AS copies FROM fresh f WHERE NOT EXISTS (
           SELECT 1 FROM stored s WHERE s.o_orderkey IS NOT DISTINCT FROM f.o_orderkey
             AND s.o_orderstatus IS NOT DISTINCT FROM f.o_orderstatus AND s.price IS NOT DISTINCT FROM f.price)
         GROUP BY o_orderkey""",
)
def se4(t: Tables):
    rows = new_rows(fresh_orders(t), stored_orders(t), ignore=["order_id"])
    return rows.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"))


@check(
    "LD1_insert_if_absent",
    STORED_SQL
    + """SELECT o_orderkey, o_orderstatus, CAST(min(price) AS VARCHAR) AS price FROM fresh
         WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stored) GROUP BY ALL""",
)
def ld1(t: Tables):
    return insert_if_absent(fresh_orders(t), stored_orders(t), ["o_orderkey"], ["price"])


@check(
    "JN6_lookup_last_wins",
    """SELECT o_orderkey, law FROM orders LEFT JOIN
         (SELECT n_regionkey + 1 AS code, arg_max('115-' || n_nationkey, n_nationkey) AS law FROM nation
          WHERE n_regionkey < 4 GROUP BY 1) ON CAST(left(o_orderpriority, 1) AS INT) = code""",
)
def jn6(t: Tables):
    codes = t.nation.where("n_regionkey < 4").selectExpr(
        "cast(n_regionkey + 1 as string) as def_codes", "concat('115-', n_nationkey) as law", "n_nationkey as row_no"
    )
    orders = t.orders.withColumn("code", F.substring("o_orderpriority", 1, 1))
    return lookup(orders, "code", codes, "def_codes", "law", "row_no", "law").select("o_orderkey", "law")


@check(
    "JN7_state_code",
    """SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'PR' WHEN 1 THEN 'TX' WHEN 2 THEN 'LA'
              WHEN 3 THEN 'NATION_' || c_nationkey END AS state_code FROM customer""",
)
def jn7(t: Tables):
    """Names in any case, codes, text that is no state, nulls."""
    frame = t.customer.selectExpr(
        "c_custkey",
        """case c_nationkey % 5 when 0 then ' PUERTO rico ' when 1 then 'Texas' when 2 then 'la'
           when 3 then concat('NATION_', c_nationkey) end as state""",
    )
    return state_code(frame, "state", "state_code").select("c_custkey", "state_code")


@check(
    "JN8_not_yet_collected",
    """SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem l
       WHERE NOT EXISTS (SELECT 1 FROM lineitem o WHERE o.l_suppkey = l.l_suppkey
                         AND o.l_returnflag = l.l_returnflag AND o.l_quantity > 45)""",
)
def jn8(t: Tables):
    pairs = t.lineitem.select("l_suppkey", "l_returnflag").distinct()
    return keep_absent(pairs, t.lineitem.where("l_quantity > 45"), ["l_suppkey", "l_returnflag"])


@check("JN9_question_answers", "WITH " + ANSWERS_SQL.strip() + "SELECT * FROM answered")
def jn9(t: Tables):
    return question_answers(question_blocks(t))


NULLED = ", ".join(f"nullif({a}, 'No answer found') AS {a}" for a in QUESTION_ALIASES)


@check("JN9_answers_without_markers", "WITH " + ANSWERS_SQL.strip() + f"SELECT doc_id, {NULLED} FROM answered")
def jn9_clean(t: Tables):
    return normalise_missing(question_answers(question_blocks(t)))


# --- distinct and aggregates ---------------------------------------------------------


@check(
    "AG1_distinct_rows",
    """SELECT DISTINCT l_returnflag, l_linestatus, nullif(l_linenumber, 3) AS l_linenumber FROM lineitem""",
)
def ag1(t: Tables):
    return t.lineitem.selectExpr(
        "l_returnflag", "l_linestatus", "nullif(l_linenumber, 3) as l_linenumber"
    ).dropDuplicates()


@check(
    "AG2_first_per_key",
    """SELECT * FROM (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
         QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus <> 'O', o_orderkey) = 1)""",
)
def ag2(t: Tables):
    """Rows of the first source (status O) before the others."""
    tagged = t.orders.withColumn("source", (F.col("o_orderstatus") != "O").cast("int"))
    return first_per_key(tagged, ["o_custkey"], ["source", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


@check("AG3_distinct_values", "SELECT DISTINCT user_id FROM events")
def ag3(t: Tables):
    return t.events.select("user_id").distinct()


@check(
    "AG4_next_id",
    """SELECT max(o_orderkey) + 1 AS next_id, 'orders' AS table_name FROM orders UNION ALL SELECT 1, 'empty'""",
)
def ag4(t: Tables):
    full = next_id(t.orders, "o_orderkey").withColumn("table_name", F.lit("orders"))
    empty = next_id(t.orders.where("o_orderkey < 0"), "o_orderkey").withColumn("table_name", F.lit("empty"))
    return full.unionByName(empty)


@check(
    "AG5_latest_rows",
    """SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def ag5(t: Tables):
    latest = t.orders.agg(F.max("o_orderdate")).scalar()
    return t.orders.where(F.col("o_orderdate") == latest).select("o_orderkey", "o_custkey")


@check(
    "AG6_collect_groups",
    """SELECT o_custkey, o_orderkey // 4096 AS block_no,
              string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS order_keys
       FROM orders GROUP BY 1, 2""",
)
def ag6(t: Tables):
    keyed = t.orders.withColumn("text", F.col("o_orderkey").cast("string"))
    lists = blocks_of(keyed, ["o_custkey"], "o_orderkey", "text", 4096, "order_keys")
    return lists.withColumn("order_keys", F.array_join("order_keys", ","))


# --- set operations ------------------------------------------------------------------


@check(
    "SE1_stack_roles",
    """SELECT 'F-' || o_orderstatus AS name, o_orderkey AS code FROM orders
       UNION ALL SELECT o_orderpriority, o_custkey FROM orders""",
)
def se1(t: Tables):
    frame = t.orders.withColumn("status", F.concat(F.lit("F-"), "o_orderstatus"))
    return stack_roles(
        frame, [{"status": "name", "o_orderkey": "code"}, {"o_orderpriority": "name", "o_custkey": "code"}]
    )


@check(
    "SE2_stack_fill_missing",
    """SELECT c_name AS name, c_mktsegment AS segment, CAST(NULL AS BIGINT) AS suppkey FROM customer
       UNION ALL SELECT s_name, NULL, s_suppkey FROM supplier""",
)
def se2(t: Tables):
    return stack(
        [
            t.customer.selectExpr("c_name as name", "c_mktsegment as segment"),
            t.supplier.selectExpr("s_name as name", "s_suppkey as suppkey"),
        ],
        fill_missing=True,
    )


@check(
    "SE3_stack_distinct",
    "SELECT c_nationkey AS nation FROM customer UNION SELECT s_nationkey FROM supplier",
)
def se3(t: Tables):
    return stack_distinct(
        [t.customer.selectExpr("c_nationkey as nation"), t.supplier.selectExpr("s_nationkey as nation")]
    )
