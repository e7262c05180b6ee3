"""SR, ST: files, landed pages, documents and web pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from checks.base import Tables, check
from checks.shapes import BUDGET_SQL, financial_cells, report_cells
from grantflow.fixed_values import AWARD_FILE_TABLES
from grantflow.functions.cleaning import file_extension
from grantflow.schemas import TableSpec
from grantflow.session import scratch_dir
from grantflow.sources.documents import (
    pick_table,
    pick_tables,
    report_tables,
    rows_by_header,
    cells_to_rows,
    text_lines,
)
from grantflow.sources.files import (
    group_by_date,
    last_files,
    latest_batch,
    list_files,
    name_parts,
    read_csv,
    route_files,
    run_stamp,
    unprocessed,
    write_csv,
    write_tables,
)
from grantflow.sources.landed import (
    explode_children,
    flatten_awards,
    merge_pages,
    parse_awards,
    rejected_awards,
    tag_award_id,
)
from grantflow.sources.tables import compact, create_store, publish, read_table
from grantflow.sources.web import new_links, page_links, report_links
from grantflow.plans.loading import read_rejects
from grantflow.streaming.drops import load_drops, read_drops

# --- CSV tables ------------------------------------------------------------------


@check(
    "SR1_read_csv",
    """SELECT c_custkey, c_name, c_nationkey, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal,
              c_mktsegment FROM customer""",
)
def sr1(t: Tables):
    path = scratch_dir(t.spark, "customer-csv")
    frame = t.customer.withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(18,2)"))
    write_csv(frame, path)
    return read_csv(t.spark, path, frame.schema)


@check("SR2_write_csv", "SELECT conv_id, turn, role, text FROM conversations")
def sr2(t: Tables):
    """Texts with commas, quotes and line breaks survive the round trip."""
    path = scratch_dir(t.spark, "conversations-csv")
    write_csv(t.conversations, path)
    return read_csv(t.spark, path, t.conversations.schema, multi_line=True)


@check(
    "SR3_write_run",
    """SELECT 'nation' AS table_name, n_nationkey AS id, n_name AS name FROM nation
       UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier""",
)
def sr3(t: Tables):
    frames = {
        "nation": t.nation.selectExpr("cast(n_nationkey as bigint) as id", "n_name as name"),
        "supplier": t.supplier.selectExpr("s_suppkey as id", "s_name as name"),
    }
    root = scratch_dir(t.spark, "run")
    paths = write_tables(frames, root, run_stamp(datetime(2024, 2, 2, 1, 1, 1)))
    parts = [
        read_csv(t.spark, path, "id bigint, name string").select(
            F.lit(name).alias("table_name"), "id", "name"
        )
        for name, path in zip(frames, paths, strict=True)
    ]
    return parts[0].unionByName(parts[1])


@check(
    "SR4_list_files",
    """SELECT DISTINCT 'o_orderstatus=' || o_orderstatus AS folder, '.csv' AS extension, true AS has_bytes
       FROM orders""",
)
def sr4(t: Tables):
    path = scratch_dir(t.spark, "orders-csv")
    t.orders.select("o_orderkey", "o_orderstatus").write.partitionBy("o_orderstatus").csv(path)
    return (
        list_files(t.spark, path, "*.csv")
        .select(
            F.element_at(F.split("path", "/"), -2).alias("folder"),
            file_extension("path").alias("extension"),
            (F.col("length") > 0).alias("has_bytes"),
        )
        .distinct()
    )


# --- file listings (paths made from documents) -------------------------------------

BATCH_PATHS_SQL = """
WITH files AS (
  SELECT doc_id, 'usa_spending_data/' || lower(lang) || '_2024' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0')
         || lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || '_010101.csv' AS path
  FROM documents
)"""


def batch_paths(t: Tables):
    return t.documents.selectExpr(
        "doc_id",
        """concat('usa_spending_data/', lower(lang), '_2024', lpad(cast(1 + doc_id % 12 as string), 2, '0'),
                  lpad(cast(1 + doc_id % 28 as string), 2, '0'), '_010101.csv') as path""",
    )


@check(
    "SR5_latest_batch",
    BATCH_PATHS_SQL
    + """SELECT doc_id, path FROM files
         WHERE regexp_extract(path, '[0-9]{8}_[0-9]{6}') =
               (SELECT max(regexp_extract(path, '[0-9]{8}_[0-9]{6}')) FROM files)""",
)
def sr5(t: Tables):
    return latest_batch(batch_paths(t))


WORDS = [word for word, _ in AWARD_FILE_TABLES]
WORDS_SQL = ", ".join(f"'{w}'" for w in WORDS)
RULES_SQL = ", ".join(f"('{w}', '{n}')" for w, n in AWARD_FILE_TABLES)


@check(
    "SR6_route_files",
    f"""WITH files AS (
          SELECT 'in/' || CASE WHEN doc_id % 3 = 0 THEN upper(w) ELSE w END || '_' || lpad(CAST(doc_id AS VARCHAR), 20, '0')
                 || '.csv' AS path
          FROM (SELECT doc_id, (ARRAY[{WORDS_SQL}])[CAST(doc_id % {len(WORDS)} + 1 AS INT)] AS w FROM documents)
        ), rules(keyword, table_name) AS (VALUES {RULES_SQL})
        SELECT keyword, table_name, min(path) AS path FROM files JOIN rules ON contains(lower(path), keyword)
        GROUP BY keyword, table_name""",
)
def sr6(t: Tables):
    word = F.element_at(F.array(*[F.lit(w) for w in WORDS]), (F.col("doc_id") % len(WORDS) + 1).cast("int"))
    files = t.documents.select(
        F.concat(
            F.lit("in/"),
            F.when(F.col("doc_id") % 3 == 0, F.upper(word)).otherwise(word),
            F.lit("_"),
            F.lpad(F.col("doc_id").cast("string"), 20, "0"),
            F.lit(".csv"),
        ).alias("path")
    )
    return route_files(files, AWARD_FILE_TABLES)


HISTORY_NAMES_SQL = """
WITH files AS (
  SELECT doc_id, 'history_reports/grantee_' || CASE doc_id % 4
           WHEN 0 THEN (1 + doc_id % 12) || '_' || (1 + doc_id % 28) || '_2024'
           WHEN 1 THEN '2023_' || (1 + doc_id % 12)
           WHEN 2 THEN 'unknown_date' ELSE 'final' END || '.csv' AS path
  FROM documents
)"""


def history_names(t: Tables):
    return t.documents.selectExpr(
        "doc_id",
        """concat('history_reports/grantee_', case doc_id % 4
             when 0 then concat(1 + doc_id % 12, '_', 1 + doc_id % 28, '_2024')
             when 1 then concat('2023_', 1 + doc_id % 12)
             when 2 then 'unknown_date' else 'final' end, '.csv') as path""",
    )


@check(
    "SR7_group_by_date",
    HISTORY_NAMES_SQL
    + """SELECT regexp_extract(path, 'grantee_(.*)[.]csv$', 1) AS date_key, path FROM files
         WHERE doc_id % 4 <> 3""",
)
def sr7(t: Tables):
    return group_by_date(history_names(t))


@check(
    "FL7_last_files",
    BATCH_PATHS_SQL + "SELECT DISTINCT path FROM files ORDER BY path DESC LIMIT 2",
)
def fl7(t: Tables):
    return last_files(batch_paths(t).select("path").distinct(), 2)


@check(
    "PR18_file_names",
    BATCH_PATHS_SQL
    + """SELECT doc_id, split_part(path, '/', 2) AS file_name, replace(split_part(path, '/', 2), '.csv', '') AS stem,
                '.csv' AS extension FROM files""",
)
def pr18(t: Tables):
    return name_parts(batch_paths(t)).select(
        "doc_id", "file_name", "stem", file_extension("path").alias("extension")
    )


@check(
    "TX11_file_date_key",
    """SELECT doc_id, CASE doc_id % 3
         WHEN 0 THEN '2024_' || (1 + doc_id % 12)
         WHEN 1 THEN (1 + doc_id % 12) || '_' || (1 + doc_id % 28) || '_2023' ELSE 'unknown_date' END AS date_key
       FROM documents""",
)
def tx11(t: Tables):
    files = t.documents.selectExpr(
        "doc_id",
        """concat('in/report ', case doc_id % 3 when 0 then concat('2024-', 1 + doc_id % 12)
             when 1 then concat(1 + doc_id % 12, '-', 1 + doc_id % 28, '-2023') else 'final' end, '.pdf') as path""",
    )
    return name_parts(files).select("doc_id", "date_key")


# --- processed files and drops ---------------------------------------------------------


@check(
    "SR8_unprocessed_files",
    BATCH_PATHS_SQL
    + """SELECT doc_id, path FROM files
         WHERE path NOT IN (SELECT path FROM files WHERE doc_id % 12 < 6)""",
)
def sr8(t: Tables):
    files = batch_paths(t)
    return unprocessed(files, files.where("doc_id % 12 < 6"))


EVENT_TABLE = TableSpec(
    "events",
    "event_id bigint, user_id bigint, event_type string, value decimal(18,2), props string",
    ("event_id",),
)


USER_TABLE = TableSpec("users", "user_id bigint, event_id bigint, n bigint", ("user_id",), buckets=16)


@check(
    "ST1_file_drops",
    """SELECT event_id, user_id, event_type, CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value, props
       FROM events""",
)
def st1(t: Tables):
    """Two drops and a run, a third drop (with repeats of the first) and a run, an idle run."""
    home = scratch_dir(t.spark, "drops")
    create_store(t.spark, f"{home}/tables")
    rows = t.events.select(
        "event_id", "user_id", "event_type", F.col("value").cast("decimal(18,2)").alias("value"), "props"
    )

    def drop(number: int, kept) -> None:
        write_csv(rows.where(kept), f"{home}/in/drop{number}")

    def run() -> None:
        stream = read_drops(t.spark, f"{home}/in/*", EVENT_TABLE.schema)
        load_drops(stream, f"{home}/tables", EVENT_TABLE, f"{home}/checkpoint", ["event_type"])

    third = F.col("event_id") % 3
    drop(0, third == 0)
    drop(1, third == 1)
    run()
    drop(2, (third == 2) | (F.col("event_id") % 9 == 0))
    run()
    run()
    return read_table(t.spark, f"{home}/tables", EVENT_TABLE)


@check(
    "ST1_rejected_rows",
    """SELECT CASE WHEN event_id % 3 = 0 THEN 'format' ELSE 'key' END AS rule, count(*) AS n
       FROM events WHERE event_id % 3 <> 1 GROUP BY ALL
       UNION ALL SELECT 'loaded', count(*) FROM events WHERE event_id % 3 = 1""",
)
def st1_rejected(t: Tables):
    """A third of the lines has a number that is none, a third no key; neither stops the others."""
    home = scratch_dir(t.spark, "drops")
    root = create_store(t.spark, f"{home}/tables")
    rows = t.events.selectExpr(
        "case when event_id % 3 <> 2 then event_id end as event_id",
        "case when event_id % 3 = 0 then 'many' else cast(user_id as string) end as user_id",
        "event_type", "cast(cast(value as decimal(18,2)) as string) as value", "props",
    )
    write_csv(rows, f"{home}/in/drop")
    stream = read_drops(t.spark, f"{home}/in/*", EVENT_TABLE.schema)
    load_drops(stream, root, EVENT_TABLE, f"{home}/checkpoint", ["event_type"])
    found = read_rejects(t.spark, root).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    loaded = read_table(t.spark, root, EVENT_TABLE).agg(F.count(F.lit(1)).alias("n"))
    return found.unionByName(loaded.select(F.lit("loaded").alias("rule"), "n"))


@check(
    "ST1_bucketed_load",
    """SELECT user_id, max(event_id) AS event_id, count(*) AS n FROM events
       WHERE user_id IS NOT NULL GROUP BY user_id""",
)
def st1_bucketed(t: Tables):
    """All users but every tenth are loaded and compacted; a drop of all users adds the others."""
    home = scratch_dir(t.spark, "bucketed")
    root = create_store(t.spark, f"{home}/tables")
    users = t.events.where("user_id is not null").groupBy("user_id").agg(F.max("event_id").alias("event_id"), F.count(F.lit(1)).alias("n"))
    for part in (1, 2):
        publish(users.where(f"user_id % 10 <> 0 and user_id % 2 = {part % 2}"), root, USER_TABLE, f"run{part}")
    compact(t.spark, root, USER_TABLE, "compacted")
    write_csv(users.where("user_id % 10 = 0").unionByName(users.withColumn("n", F.lit(-1)).where("user_id % 10 <> 0")), f"{home}/in/drop")
    load_drops(read_drops(t.spark, f"{home}/in/*", USER_TABLE.schema), root, USER_TABLE, f"{home}/checkpoint")
    return read_table(t.spark, root, USER_TABLE)


# --- landed pages ---------------------------------------------------------------------

PAGES_SQL = """
WITH base AS (
  SELECT 'u' || user_id AS source_id, CAST(event_id // 200 AS INT) AS page, event_id, user_id,
         CAST(value AS DECIMAL(18,2)) AS value FROM events
), sized AS (
  SELECT *, count(*) OVER (PARTITION BY source_id, page) AS n, (user_id + page) % 11 = 0 AS emptied,
         (user_id + page) % 7 <> 0 AS has_next FROM base
)"""


def api_pages(t: Tables, emptied: bool):
    """Pages of 200 event ids; a page keeps at most those of its user."""
    child = F.struct(
        F.concat(F.lit("e"), "event_id").alias("id"), F.col("value").cast("decimal(18,2)").alias("amount")
    )
    grouped = (
        t.events.withColumn("page", F.expr("cast(event_id div 200 as int)"))
        .groupBy("user_id", "page")
        .agg(F.array_sort(F.collect_list(child)).alias("results"))
    )
    gone = ((F.col("user_id") + F.col("page")) % 11 == 0) & F.lit(emptied)
    return grouped.select(
        F.concat(F.lit("u"), "user_id").alias("source_id"),
        "page",
        ((F.col("user_id") + F.col("page")) % 7 != 0).alias("has_next"),
        F.when(~gone, F.col("results")).otherwise(F.slice("results", 1, 0)).alias("results"),
    )


def _pages_oracle(stop: str, emptied: bool, inclusive: bool = True) -> str:
    gone = "AND NOT emptied" if emptied else ""
    return (
        PAGES_SQL
        + f""", ends AS (SELECT source_id, min(page) AS last_page FROM sized WHERE {stop} GROUP BY source_id)
        SELECT s.source_id, s.page, 'e' || s.event_id AS id, CAST(s.value AS VARCHAR) AS amount
        FROM sized s LEFT JOIN ends e ON e.source_id = s.source_id
        WHERE (e.last_page IS NULL OR s.page <= e.last_page) {gone}"""
    )


@check("SR9_pages_until_empty", _pages_oracle("emptied", True))
def sr9_empty(t: Tables):
    return merge_pages(api_pages(t, True), "empty").drop("pos")


@check("SR9_pages_until_short", _pages_oracle("n < 2", False))
def sr9_short(t: Tables):
    return merge_pages(api_pages(t, False), "short", limit=2).drop("pos")


@check("SR9_pages_until_no_next", _pages_oracle("NOT has_next OR emptied", True))
def sr9_next(t: Tables):
    return merge_pages(api_pages(t, True), "has_next").drop("pos")


AWARD_DOC = """to_json(named_struct(
  'fain', concat('G', o_orderkey),
  'generated_unique_award_id', concat('ASST_', o_orderkey),
  'total_funding', cast(o_totalprice as decimal(18,2)),
  'total_account_outlay', cast(o_totalprice + 1 as decimal(18,2)),
  'total_account_obligation', cast(o_totalprice + 2 as decimal(18,2)),
  'total_outlay', case when o_orderkey % 3 = 0 then null else cast(c_acctbal as decimal(18,2)) end,
  'total_obligation', cast(c_acctbal + 1 as decimal(18,2)),
  'cfda_info', case when o_orderkey % 7 = 0 then null
     when o_orderkey % 5 = 0 then array()
     else array(named_struct('cfda_number', concat('14.', c_nationkey), 'cfda_title', c_mktsegment, 'cfda_objectives', c_name),
                named_struct('cfda_number', 'second', 'cfda_title', 'second', 'cfda_objectives', 'second')) end,
  'place_of_performance', named_struct('state_name', concat('N', c_nationkey), 'state_code', cast(c_nationkey as string)),
  'awarding_agency', case when o_orderkey % 4 = 0 then null else named_struct(
     'toptier_agency', named_struct('name', concat('A', c_nationkey), 'code', o_orderstatus),
     'subtier_agency', named_struct('name', o_orderpriority, 'code', concat('s', c_nationkey)),
     'office_agency_name', concat('O', c_nationkey)) end,
  'funding_agency', case when o_orderkey % 4 = 1 then null else named_struct(
     'toptier_agency', named_struct('name', concat('F', c_nationkey), 'code', o_orderpriority),
     'subtier_agency', case when o_orderkey % 4 = 2 then null
        else named_struct('name', o_orderstatus, 'code', concat('f', c_nationkey)) end,
     'office_agency_name', c_mktsegment) end,
  'recipient', named_struct('location', named_struct('state_name', c_name, 'state_code', c_mktsegment)),
  'period_of_performance_start_date', date_format(o_orderdate, 'yyyy-MM-dd'),
  'period_of_performance_current_end_date', date_format(o_orderdate, 'dd.MM.yyyy')))"""


def award_documents(t: Tables):
    """Award documents as JSON text: empty, null and two-element program lists, absent agencies."""
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.selectExpr("o_orderkey", f"{AWARD_DOC} as body")


@check(
    "SR10_flatten_awards",
    """SELECT 'G' || o_orderkey AS "Award ID", 'ASST_' || o_orderkey AS generated_unique_award_id,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total_funding,
         CAST(CAST(o_totalprice + 1 AS DECIMAL(18,2)) AS VARCHAR) AS total_account_outlay,
         CAST(CAST(o_totalprice + 2 AS DECIMAL(18,2)) AS VARCHAR) AS total_account_obligation,
         CASE WHEN o_orderkey % 3 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END AS total_outlay,
         CAST(CAST(c_acctbal + 1 AS DECIMAL(18,2)) AS VARCHAR) AS total_obligated,
         CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN '14.' || c_nationkey END AS cfda_number,
         CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN c_mktsegment END AS cfda_title,
         CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 THEN c_name END AS cfda_objectives,
         'N' || c_nationkey AS place_of_performance_state_name,
         CAST(c_nationkey AS VARCHAR) AS place_of_performance_state_code,
         CASE WHEN o_orderkey % 4 <> 0 THEN 'A' || c_nationkey END AS awarding_agency_name,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderstatus END AS awarding_agency_code,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_orderpriority END AS awarding_sub_agency_name,
         CASE WHEN o_orderkey % 4 <> 0 THEN 's' || c_nationkey END AS awarding_sub_agency_code,
         CASE WHEN o_orderkey % 4 <> 0 THEN 'O' || c_nationkey END AS awarding_office_name,
         CASE WHEN o_orderkey % 4 <> 1 THEN 'F' || c_nationkey END AS funding_agency_name,
         CASE WHEN o_orderkey % 4 <> 1 THEN o_orderpriority END AS funding_agency_code,
         CASE WHEN o_orderkey % 4 NOT IN (1, 2) THEN o_orderstatus END AS funding_sub_agency_name,
         CASE WHEN o_orderkey % 4 NOT IN (1, 2) THEN 'f' || c_nationkey END AS funding_sub_agency_code,
         CASE WHEN o_orderkey % 4 <> 1 THEN c_mktsegment END AS funding_office_name,
         c_name AS recipient_state_name, c_mktsegment AS recipient_state_code,
         strftime(o_orderdate, '%Y-%m-%d') AS start_date, strftime(o_orderdate, '%d.%m.%Y') AS end_date
       FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def sr10(t: Tables):
    """All 26 columns."""
    return flatten_awards(parse_awards(award_documents(t), "body"))


@check(
    "SR10_rejected_documents",
    """SELECT 'awards' AS source, CAST(o_orderkey AS VARCHAR) AS key,
              CASE WHEN o_orderkey % 4 = 0 THEN 'missing' ELSE 'format' END AS rule,
              CASE WHEN o_orderkey % 4 = 2 THEN '{"fain": "G' || o_orderkey
                   WHEN o_orderkey % 4 = 3 THEN 'not found' END AS text
       FROM orders WHERE o_orderkey % 4 <> 1""",
)
def sr10_rejected(t: Tables):
    """Absent, cut off and foreign texts are told, each with its key; sound documents are not."""
    docs = award_documents(t).selectExpr(
        "o_orderkey",
        """case o_orderkey % 4 when 0 then null when 1 then body when 2 then concat('{"fain": "G', o_orderkey)
           else 'not found' end as body""",
    )
    return rejected_awards(docs, "body", "o_orderkey")


@check(
    "SR10_event_props",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def sr10_props(t: Tables):
    return t.events.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@check(
    "SR11_tag_children",
    """SELECT 'ASST_' || o_orderkey AS generated_internal_id, j AS pos,
              CASE WHEN j = 0 THEN o_orderstatus ELSE o_orderpriority END AS id,
              CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE 'G' || o_orderkey END AS "Award ID"
       FROM orders, (VALUES (0), (1)) v(j)""",
)
def sr11(t: Tables):
    parents = t.orders.selectExpr(
        "concat('ASST_', o_orderkey) as generated_internal_id",
        "array(named_struct('id', o_orderstatus), named_struct('id', o_orderpriority)) as results",
    )
    listed = t.orders.where("o_orderkey % 6 <> 0").selectExpr(
        "concat('ASST_', o_orderkey) as generated_internal_id", "concat('G', o_orderkey) as `Award ID`"
    )
    children = explode_children(parents, "generated_internal_id", "results")
    return tag_award_id(children, listed.unionByName(listed))


ORDERS_TABLE = TableSpec(
    "orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string", ("o_orderkey",)
)


@check("SR12_read_stored_table", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")
def sr12(t: Tables):
    root = create_store(t.spark, scratch_dir(t.spark, "stored"))
    publish(t.orders, root, ORDERS_TABLE, "run1")
    return read_table(t.spark, root, ORDERS_TABLE)


@check("LD10_full_scan", "SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM events")
def ld10(t: Tables):
    """Every row and column; the time as a number, which both engines print alike."""
    return t.events.withColumn("ts", F.unix_micros(F.col("ts").cast("timestamp")))


# --- documents -------------------------------------------------------------------------


@check(
    "SR13_text_lines",
    """SELECT doc_id, CAST(i - 1 AS INT) AS line_no, parts[i] AS line
       FROM (SELECT doc_id, parts, unnest(generate_series(1, len(parts))) AS i
             FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))""",
)
def sr13(t: Tables):
    return text_lines(t.documents, "text", ["doc_id"])


FINANCIAL_NEW_SQL = """
WITH base AS (
  SELECT 'n' || lpad(CAST(c_nationkey AS VARCHAR), 20, '0') AS doc_id, CAST(c_custkey // 200 AS INT) AS page,
         CAST(c_custkey % 200 + 1 AS INT) AS row_no, c_custkey, c_mktsegment,
         c_custkey % 8 IN (2, 5) AS hollow,
         CASE c_custkey % 8 WHEN 0 THEN 'Puerto Rico' WHEN 1 THEN 'Baton' WHEN 2 THEN 'Rouge, LA' WHEN 3 THEN ''
              WHEN 4 THEN 'pr' WHEN 5 THEN 'Suffix' WHEN 6 THEN 'Texas' ELSE 'Orleans' END AS who,
         CASE WHEN c_acctbal < 0 THEN '($' || format('{:,}', CAST(trunc(-c_acctbal) AS BIGINT)) || ')'
              WHEN c_custkey % 9 = 0 THEN '$ -'
              ELSE '$' || format('{:,}', CAST(trunc(c_acctbal) AS BIGINT)) END AS money,
         (c_custkey % 100) || ',5 %' AS share, CAST(2000 + c_custkey % 20 AS VARCHAR) AS year_text
  FROM customer WHERE c_nationkey % 2 = 1
)"""


@check(
    "SR14_report_tables",
    FINANCIAL_NEW_SQL
    + """SELECT doc_id, page, 0 AS table_no, row_no, who AS c0,
                CASE WHEN hollow THEN '' ELSE ' B-' || c_custkey || ' ' END AS c1,
                CASE WHEN hollow THEN '' ELSE money END AS c2, CASE WHEN hollow THEN '' ELSE money END AS c3,
                CASE WHEN hollow THEN '' ELSE year_text END AS c4, CASE WHEN hollow THEN '' ELSE '12' END AS c5,
                CASE WHEN hollow THEN '' ELSE share END AS c6, CASE WHEN hollow THEN '' ELSE share END AS c7,
                CASE WHEN hollow THEN '' ELSE c_mktsegment END AS c8, CASE WHEN hollow THEN '' ELSE money END AS c9
         FROM base""",
)
def sr14(t: Tables):
    """Tables of the new layout under one header per report, out of the reports of both layouts."""
    rows, _ = report_tables(financial_cells(t), 10)
    return rows


@check(
    "SR14_skipped_tables",
    """SELECT DISTINCT 'n' || lpad(CAST(c_nationkey AS VARCHAR), 20, '0') AS doc_id,
              CAST(c_custkey // 200 AS INT) AS page, 'other layout' AS reason
       FROM customer WHERE c_nationkey % 2 = 0
       UNION SELECT 'n' || lpad(CAST(n_nationkey AS VARCHAR), 20, '0'), 0, 'other layout'
       FROM nation WHERE n_nationkey % 2 = 0""",
)
def sr14_skipped(t: Tables):
    _, skipped = report_tables(financial_cells(t), 10)
    return skipped.select("doc_id", "page", "reason")


@check(
    "SR14_rows_by_header",
    "WITH " + BUDGET_SQL.strip()
    + """SELECT doc_id, 0 AS page, 1 AS table_no, row_no, c0 AS "Overall",
                '$' || format('{:,.2f}', CAST(period AS DOUBLE)) AS "This Period",
                '$' || CAST(CAST(to_date AS DECIMAL(18,2)) AS VARCHAR) AS "To Date"
         FROM budget
         UNION ALL SELECT DISTINCT doc_id, u.page, 0, 1, NULL, NULL, NULL FROM budget, (VALUES (0), (1)) u(page)""",
)
def sr14_header(t: Tables):
    """All tables of all reports; those without such a header give rows without values."""
    return rows_by_header(report_cells(t), ["Overall", "This Period", "To Date"])


@check(
    "SR15_pick_last_table",
    "WITH " + BUDGET_SQL.strip()
    + """SELECT doc_id, row_no, c0, '$' || format('{:,.2f}', CAST(period AS DOUBLE)) AS c1,
                '$' || CAST(CAST(to_date AS DECIMAL(18,2)) AS VARCHAR) AS c2 FROM budget""",
)
def sr15(t: Tables):
    chosen = pick_table(report_cells(t), page=0, index=-1, skip_rows=1)
    return cells_to_rows(chosen, 3, ["doc_id", "row_no"])


@check(
    "SR15_pick_many_tables",
    "WITH " + BUDGET_SQL.strip()
    + """SELECT DISTINCT doc_id, 0 AS page, 0 AS table_no, 1 AS row_no, 'a' AS c0, 'b' AS c1, 'c' AS c2
         FROM budget""",
)
def sr15_many(t: Tables):
    """The table of page 1 has an empty cell in its only row, so the row is dropped."""
    return pick_tables(report_cells(t), {0: [0], 1: [0]}, 3)


# --- web pages ---------------------------------------------------------------------------

LINKS_SQL = r"""
WITH seen AS (
  SELECT page_id, url,
         regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g') AS html
  FROM pages
), anchors AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\s[^>]*>.*?</a>')) AS tag FROM seen
), links AS (
  SELECT page_id, regexp_extract(tag, '(?i)href="([^"]*)"', 1) AS href,
         regexp_replace(regexp_extract(tag, '(?is)<a\s[^>]*>(.*)</a>', 1), '<[^>]*>', '', 'g') AS link_text
  FROM anchors
)"""


@check("SR16_page_links", LINKS_SQL + "SELECT page_id, href, link_text FROM links")
def sr16(t: Tables):
    return page_links(t.pages, "html", ["page_id"]).drop("link_no")


@check(
    "FL3_link_filter",
    LINKS_SQL
    + """SELECT page_id, href, link_text, 'https://www.hud.gov/' || href AS report_url,
                substr(href, 2) AS file_name
         FROM links WHERE link_text LIKE '%th%' AND href LIKE '%e' AND href LIKE '/%'
           AND href NOT LIKE '%/%/%'""",
)
def fl3(t: Tables):
    links = page_links(t.pages, "html", ["page_id"])
    return report_links(links, "th", suffix="e").drop("link_no")


KEYS_SQL = """
, keyed AS (SELECT page_id, 'reports/' || page_id || '-' || substr(href, 2) || '.pdf' AS file_key FROM links)"""


def _keyed_links(t: Tables):
    links = page_links(t.pages, "html", ["page_id"])
    return links.select("page_id", F.concat("page_id", F.lit("-"), F.expr("substring(href, 2)"), F.lit(".pdf")).alias("file_name"))


@check(
    "SR17_new_links",
    LINKS_SQL + KEYS_SQL
    + """, listing AS (SELECT file_key || '.part' AS path FROM keyed WHERE page_id % 3 = 0
                       UNION ALL SELECT file_key FROM keyed WHERE page_id % 5 = 0)
         SELECT page_id, file_key FROM keyed k
         WHERE NOT EXISTS (SELECT 1 FROM listing l WHERE starts_with(l.path, k.file_key))""",
)
def sr17(t: Tables):
    """Some keys are listed with a further suffix, some only in the archive."""
    links = _keyed_links(t)
    raw = links.where("page_id % 3 = 0").select(F.concat(F.lit("reports/"), "file_name", F.lit(".part")).alias("path"))
    old = links.where("page_id % 5 = 0").select(F.concat(F.lit("archived/reports/"), "file_name").alias("path"))
    return new_links(links, raw, old, "reports").select("page_id", "file_key")


@check(
    "JN10_prefix_and_contains",
    f"""WITH paths AS (SELECT page_id, 'in/' || (ARRAY[{WORDS_SQL}])[CAST(page_id % {len(WORDS)} + 1 AS INT)] || url AS path
                       FROM pages),
        rules(keyword, table_name) AS (VALUES {RULES_SQL})
        SELECT page_id, keyword, table_name, path FROM paths JOIN rules ON contains(lower(path), keyword)""",
)
def jn10(t: Tables):
    word = F.element_at(F.array(*[F.lit(w) for w in WORDS]), (F.col("page_id") % len(WORDS) + 1).cast("int"))
    paths = t.pages.select("page_id", F.concat(F.lit("in/"), word, "url").alias("path"))
    return route_files(paths, AWARD_FILE_TABLES, keys=["page_id"])
