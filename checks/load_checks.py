"""LD: defaults, constraints, publishing."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from checks.base import Tables, check
from grantflow.operators import load as L
from grantflow.plans.loading import load_tables
from grantflow.schemas import TABLES, TableSpec
from grantflow.session import scratch_dir
from grantflow.sources.tables import LoadRejected, compact, create_store, publish, read_table, truncate

ORDERS = TableSpec(
    "orders",
    "o_orderkey bigint, o_orderstatus string, o_orderpriority string, price decimal(18,2), day date",
    ("o_orderkey",),
    parents={"o_orderstatus": ("status", "code")},
    required=("o_orderpriority",),
    lengths={"o_orderpriority": 8},
    defaults={"o_orderstatus": "unknown"},
)


@check(
    "LD2_defaults",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE o_orderstatus END AS o_orderstatus FROM orders",
)
def ld2(t: Tables):
    holed = t.orders.selectExpr("o_orderkey", "nullif(o_orderstatus, 'P') as o_orderstatus")
    return L.apply_defaults(holed, ORDERS)


def raw_orders(t: Tables):
    """Orders as text: some bad prices, long and missing priorities, staged dates."""
    return t.orders.selectExpr(
        "o_orderkey",
        "o_orderstatus",
        "case when o_orderkey % 8 = 0 then null else o_orderpriority end as o_orderpriority",
        "case when o_orderkey % 9 = 0 then 'n/a' else cast(o_orderkey + 0.005 as string) end as price",
        "date_format(o_orderdate, 'MM-dd-yyyy') as day",
    )


@check(
    "LD3_conform",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
              CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey || '.01' END AS price,
              strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def ld3(t: Tables):
    """Half a cent rounds up, as in a decimal(18,2) column."""
    return L.conform(raw_orders(t), ORDERS)


@check(
    "LD3_violations",
    """SELECT 'orders' AS table_name, 'price' AS column_name, 'type' AS rule, CAST(o_orderkey AS VARCHAR) AS row_key
         FROM orders WHERE o_orderkey % 9 = 0
       UNION ALL SELECT 'orders', 'o_orderpriority', 'required', CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 8 = 0
       UNION ALL SELECT 'orders', 'o_orderpriority', 'length', CAST(o_orderkey AS VARCHAR) FROM orders
         WHERE o_orderkey % 8 <> 0 AND length(o_orderpriority) > 8""",
)
def ld3_violations(t: Tables):
    return L.violations(raw_orders(t), ORDERS)


@check(
    "LD4_key_violations",
    """SELECT 'lineitem' AS table_name, 'l_orderkey,l_linenumber' AS column_name, 'primary key' AS rule,
              l_orderkey || '|' || l_linenumber AS row_key
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def ld4_key(t: Tables):
    spec = TableSpec("lineitem", "l_orderkey bigint, l_linenumber int", ("l_orderkey", "l_linenumber"))
    return L.key_violations(t.lineitem, spec)


@check(
    "LD4_reference_violations",
    """SELECT DISTINCT 'lineitem' AS table_name, 'l_suppkey' AS column_name, 'foreign key' AS rule,
              CAST(l_suppkey AS VARCHAR) AS row_key
       FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 <> 0)""",
)
def ld4_reference(t: Tables):
    spec = TableSpec(
        "lineitem", "l_orderkey bigint, l_suppkey bigint", ("l_orderkey",),
        parents={"l_suppkey": ("supplier", "s_suppkey")},
    )
    return L.reference_violations(t.lineitem, spec, {"supplier": t.supplier.where("s_suppkey % 3 <> 0")})


PLAIN_ORDERS = replace(ORDERS, name="plain_orders", parents={}, lengths={}, required=())


@check(
    "LD5_staged_publish",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
              strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def ld5(t: Tables):
    """Two good runs; one that breaks the key and shows nothing; a repeat that adds nothing."""
    root = create_store(t.spark, scratch_dir(t.spark, "publish"))
    rows = t.orders.withColumns({"price": F.col("o_totalprice").cast("decimal(18,2)"), "day": F.to_date("o_orderdate")})
    first, second = rows.where("o_orderkey % 2 = 0"), rows.where("o_orderkey % 2 = 1")
    publish(first, root, PLAIN_ORDERS, "run1")
    publish(second, root, PLAIN_ORDERS, "run2")
    try:
        publish(first, root, PLAIN_ORDERS, "run3")
        raise AssertionError("a repeated key was published")
    except LoadRejected:
        pass
    publish(first, root, PLAIN_ORDERS, "run1")
    return read_table(t.spark, root, PLAIN_ORDERS)


@check(
    "LD5_compacted",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
              strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""",
)
def ld5_compacted(t: Tables):
    """Four runs made one, a repeat of that, and another run behind it."""
    root = create_store(t.spark, scratch_dir(t.spark, "compact"))
    rows = t.orders.withColumns({"price": F.col("o_totalprice").cast("decimal(18,2)"), "day": F.to_date("o_orderdate")})
    for part in range(4):
        publish(rows.where(f"o_orderkey % 5 = {part}"), root, PLAIN_ORDERS, f"run{part}")
    compact(t.spark, root, PLAIN_ORDERS, "compacted")
    compact(t.spark, root, PLAIN_ORDERS, "compacted")
    publish(rows.where("o_orderkey % 5 = 4"), root, PLAIN_ORDERS, "run4")
    return read_table(t.spark, root, PLAIN_ORDERS)


@check(
    "LD6_parents_first",
    """SELECT 'grantee' AS table_name, count(*) AS n FROM customer
       UNION ALL SELECT 'granthistory', count(*) FROM orders UNION ALL SELECT 'disaster', count(*) FROM nation
       UNION ALL SELECT 'states', count(*) FROM region""",
)
def ld6(t: Tables):
    """Children are given before their parents; the load sorts that out, twice."""
    frames = {
        "granthistory": t.orders.selectExpr(
            "o_orderkey as grant_history_id", "o_orderkey % 25 as disaster_id", "o_custkey as grantee_id",
            "o_totalprice as grant_award", "cast(o_orderdate as date) as report_date",
        ),
        "grantee": t.customer.selectExpr(
            "c_custkey as grantee_id", "c_name as grantee_name", "concat('R', c_nationkey % 5) as state_code"
        ),
        "disaster": t.nation.selectExpr("n_nationkey as disaster_id", "n_name as disaster_name", "'2017' as disaster_year"),
        "states": t.region.selectExpr("concat('R', r_regionkey) as state_code", "r_name as state_name"),
    }
    root = create_store(t.spark, scratch_dir(t.spark, "load"))
    for run_id in ("run1", "run2"):
        load_tables(frames, root, run_id)
    counts = [
        read_table(t.spark, root, TABLES[name]).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table_name"), "n"
        )
        for name in frames
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


@check(
    "LD7_truncate",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1",
)
def ld7(t: Tables):
    """Load, truncate, load other rows: only the last are visible."""
    root = create_store(t.spark, scratch_dir(t.spark, "truncate"))
    publish(t.orders.where("o_orderkey % 2 = 0"), root, PLAIN_ORDERS, "run1")
    truncate(t.spark, root, PLAIN_ORDERS.name, "run2")
    publish(t.orders.where("o_orderkey % 2 = 1"), root, PLAIN_ORDERS, "run3")
    return read_table(t.spark, root, PLAIN_ORDERS).select("o_orderkey", "o_orderstatus")


@check(
    "LD8_add_column",
    """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS report_date
       FROM orders""",
)
def ld8(t: Tables):
    """Rows loaded before the column was declared read as null."""
    root = create_store(t.spark, scratch_dir(t.spark, "add-column"))
    before = TableSpec("wide", "o_orderkey bigint, o_orderstatus string", ("o_orderkey",))
    after = replace(before, ddl=before.ddl + ", report_date date")
    publish(t.orders.where("o_orderkey % 2 = 0"), root, before, "run1")
    later = L.add_column(t.orders.where("o_orderkey % 2 = 1"), "report_date", "date")
    publish(later.withColumn("report_date", F.to_date("o_orderdate")), root, after, "run2")
    return read_table(t.spark, root, after)


@check(
    "LD9_column_names",
    """SELECT column_name, (SELECT count(*) FROM orders) AS n_rows FROM
         (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)""",
)
def ld9(t: Tables):
    names = F.array(*[F.lit(c) for c in t.orders.columns])
    return t.orders.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(names).alias("column_name"), "n_rows")
