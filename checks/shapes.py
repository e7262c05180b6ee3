"""Raw inputs of the pipelines shaped from the driver tables.

Each shape exists twice: as a DataFrame and as the text of SQL common table
expressions, so that the oracle starts from the driver tables as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.base import Tables
from grantflow.fixed_values import QUESTION_ALIASES

# --- award pipeline -----------------------------------------------------------


def orders_customer(t: Tables) -> DataFrame:
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))


def awards(t: Tables) -> DataFrame:
    return orders_customer(t).selectExpr(
        "concat('G', o_orderkey) as `Award ID`",
        "case when o_orderkey % 3 = 0 then concat('  ', c_name, ' ') else c_name end as `Recipient Name`",
        "cast(o_totalprice as decimal(18,2)) as `Award Amount`",
        "cast(o_totalprice as decimal(18,2)) as `Total Outlays`",
        "o_orderpriority as Description",
        "o_orderstatus as `Award Type`",
        """case when o_orderkey % 13 = 0 then null
                when o_orderkey % 10 = 0 then "['1', '2']"
                else concat("['", substr(o_orderpriority, 1, 1), "']") end as def_codes""",
        "case when o_orderkey % 4 = 0 then 'n/a' else cast(c_nationkey * 100 as string) end as `COVID-19 Obligations`",
        "cast(c_nationkey as string) as `COVID-19 Outlays`",
        "'1.50' as `Infrastructure Obligations`",
        "cast(null as string) as `Infrastructure Outlays`",
        "case when o_orderkey % 7 = 0 then 'junk' else date_format(o_orderdate, 'yyyy-MM-dd') end as `Start Date`",
        "date_format(o_orderdate, 'MM/dd/yyyy') as `End Date`",
        "concat('ASST_', o_orderkey) as generated_internal_id",
    )


AWARDS_SQL = """
awards AS (
  SELECT 'G' || o_orderkey AS award_id,
         CASE WHEN o_orderkey % 3 = 0 THEN '  ' || c_name || ' ' ELSE c_name END AS recipient_name,
         CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
         o_orderpriority AS descr, o_orderstatus AS award_type,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              WHEN o_orderkey % 10 = 0 THEN '[''1'', ''2'']'
              ELSE '[''' || substr(o_orderpriority, 1, 1) || ''']' END AS def_codes,
         CASE WHEN o_orderkey % 4 = 0 THEN 'n/a' ELSE CAST(c_nationkey * 100 AS VARCHAR) END AS covid_obl,
         CAST(c_nationkey AS VARCHAR) AS covid_out,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS start_ts,
         o_orderdate AS end_ts,
         'ASST_' || o_orderkey AS internal_id
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def other(t: Tables) -> DataFrame:
    return orders_customer(t).join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "concat('G', o_orderkey) as `Award ID`",
        "concat(case when o_orderkey % 11 = 0 then 'MISS_' else 'ASST_' end, o_orderkey) as generated_unique_award_id",
        "cast(o_totalprice as decimal(18,2)) as total_funding",
        "cast(c_acctbal as decimal(18,2)) as total_account_outlay",
        "cast(o_totalprice as decimal(18,2)) as total_account_obligation",
        "concat('Goals of ', n_name) as cfda_objectives",
        "concat('Program ', n_name) as cfda_title",
        "case when n_nationkey = 7 then null else concat('14.', 200 + n_nationkey) end as cfda_number",
        "n_name as place_of_performance_state_name",
        "lpad(cast(n_nationkey as string), 2, '0') as place_of_performance_state_code",
        "cast(o_totalprice as decimal(18,2)) as total_outlay",
        "cast(o_totalprice as decimal(18,2)) as total_obligated",
        "concat('Agency ', n_nationkey) as awarding_agency_name",
        "concat('0', 10 + n_nationkey) as awarding_agency_code",
        "concat('Sub ', n_nationkey) as awarding_sub_agency_name",
        "cast(8600 + n_nationkey as string) as awarding_sub_agency_code",
        "case when n_nationkey = 5 then null else concat('Agency ', n_nationkey + 3) end as funding_agency_name",
        "concat('0', 13 + n_nationkey) as funding_agency_code",
        "concat('Sub ', n_nationkey + 2) as funding_sub_agency_name",
        "cast(8602 + n_nationkey as string) as funding_sub_agency_code",
        "n_name as recipient_state_name",
        "case when n_nationkey = 3 then null else lpad(cast(n_nationkey as string), 2, '0') end as recipient_state_code",
        "concat('Office ', n_regionkey) as funding_office_name",
        "concat('Office ', n_nationkey) as awarding_office_name",
        "case when o_orderkey % 7 = 0 then 'junk' else date_format(o_orderdate, 'yyyy-MM-dd') end as start_date",
        "date_format(o_orderdate, 'yyyy-MM-dd') as end_date",
    )


OTHER_SQL = """
other AS (
  SELECT 'G' || o_orderkey AS award_id,
         (CASE WHEN o_orderkey % 11 = 0 THEN 'MISS_' ELSE 'ASST_' END) || o_orderkey AS internal_id,
         CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(c_acctbal AS DECIMAL(18,2)) AS acct,
         n_nationkey AS n, n_name, n_regionkey,
         CASE WHEN n_nationkey = 7 THEN NULL ELSE '14.' || (200 + n_nationkey) END AS cfda_number,
         CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderdate END AS start_ts,
         o_orderdate AS end_ts
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
)"""


def fund_codes(t: Tables) -> DataFrame:
    return t.nation.selectExpr(
        "cast(n_regionkey + 1 as string) as def_codes",
        "concat('115-', n_nationkey) as `PL Number 1`",
        "n_nationkey as row_no",
    )


def funding_rows(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
        "cast(l_extendedprice as decimal(18,2)) as transaction_obligated_amount",
        "cast(l_discount * 100 as decimal(18,2)) as gross_outlay_amount",
        "'Q' as disaster_emergency_fund_code",
        "concat('086-', l_linenumber) as federal_account",
        "concat('Account ', l_returnflag) as account_title",
        "concat('Agency ', s_nationkey + 10) as funding_agency_name",
        "s_nationkey + 10 as funding_agency_id",
        "s_nationkey + 110 as funding_toptier_agency_id",
        "concat('agency-', s_nationkey + 10) as funding_agency_slug",
        "concat('Agency ', s_nationkey) as awarding_agency_name",
        "s_nationkey as awarding_agency_id",
        "s_nationkey + 100 as awarding_toptier_agency_id",
        "case when s_nationkey = 4 then null else concat('agency-', s_nationkey) end as awarding_agency_slug",
        "l_linestatus as object_class",
        "concat('Class ', l_linestatus) as object_class_name",
        "lpad(cast(l_linenumber as string), 4, '0') as program_activity_code",
        "concat('Activity ', l_linenumber) as program_activity_name",
        "date_format(l_shipdate, 'yyyy') as reporting_fiscal_year",
        "cast(quarter(l_shipdate) as string) as reporting_fiscal_quarter",
        "cast(month(l_shipdate) as string) as reporting_fiscal_month",
        "case when l_orderkey % 3 = 0 then 'False' when l_orderkey % 3 = 1 then 'True' end as is_quarterly_submission",
        "concat('ASST_', l_orderkey) as generated_internal_id",
        "concat('G', l_orderkey) as `Award ID`",
    )


def subawards(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
        "cast(l_orderkey * 10 + l_linenumber as string) as subaward_id",
        "concat('S-', l_linenumber) as subaward_number",
        "concat(l_returnflag, l_linestatus) as description",
        "date_format(l_shipdate, 'yyyy-MM-dd') as action_date",
        "cast(l_extendedprice as decimal(18,2)) as amount",
        "case when l_orderkey % 2 = 0 then concat(' ', s_name, ' ') else s_name end as recipient_name",
        "concat(case when l_orderkey % 9 = 0 then 'NONE_' else 'ASST_' end, l_orderkey) as generated_internal_id",
    )


def transaction_rows(t: Tables) -> DataFrame:
    return t.lineitem.selectExpr(
        "concat('T', l_orderkey, '-', l_linenumber) as id",
        "l_returnflag as type",
        "concat('Type ', l_returnflag) as type_description",
        "case when l_orderkey % 7 = 0 then 'soon' else date_format(l_shipdate, 'yyyy-MM-dd') end as action_date",
        "l_linestatus as action_type",
        "concat('Action ', l_linestatus) as action_type_description",
        "cast(l_linenumber as string) as modification_number",
        "cast(null as string) as description",
        "cast(l_extendedprice as decimal(18,2)) as federal_action_obligation",
        "cast(l_tax as decimal(18,2)) as face_value_loan_guarantee",
        "cast(l_discount as decimal(18,2)) as original_loan_subsidy_cost",
        "concat('14.2', l_linenumber, '0') as cfda_number",
        "concat('ASST_', l_orderkey) as generated_internal_id",
        "concat('G', l_orderkey) as `Award ID`",
    )


# --- disaster history reports ---------------------------------------------------


def report_lines(t: Tables) -> DataFrame:
    """One document per customer: a title, a date, then lines per order."""
    front = t.customer.selectExpr(
        "concat('c', lpad(cast(c_custkey as string), 20, '0')) as doc_id",
        "concat('report-2023-', c_custkey % 14, '.pdf') as file_name",
        """posexplode(array(
             'CDBG-DR Grant History 2001-2023',
             case c_custkey % 4 when 0 then 'January 31, 2024' when 1 then 'as of March 5, 202'
                  when 2 then 'Feb 5, 2022' else 'no date' end)) as (line_no, line)""",
    )
    body = t.orders.selectExpr(
        "concat('c', lpad(cast(o_custkey as string), 20, '0')) as doc_id",
        "concat('report-2023-', o_custkey % 14, '.pdf') as file_name",
        "o_orderkey",
        """posexplode(array(
             case when o_orderkey % 6 = 0
                    then concat('Floods ', year(o_orderdate), '-', year(o_orderdate) + 1)
                  when o_orderkey % 3 = 0
                    then concat('Hurricane ', o_orderstatus, ' ', year(o_orderdate))
                  else 'Total' end,
             concat('P.L. 1', 10 + o_orderkey % 20, '-', 1 + o_orderkey % 199,
                    case when o_orderkey % 5 = 0 then ''
                         else concat(' ', date_format(o_orderdate, 'MMM. d, yyyy')) end),
             case when o_orderkey % 10 = 0 then concat('PUERTO RICO $', cast(o_totalprice as bigint))
                  when o_orderkey % 2 = 0
                    then concat('PUERTO RICO Dept ', substr(o_orderpriority, 3), '  $',
                                format_number(cast(o_totalprice as bigint), 0))
                  else concat('FLORIDA State $', cast(o_totalprice as bigint)) end)) as (j, line)""",
    ).selectExpr("doc_id", "file_name", "2 + cast(o_orderkey as bigint) * 3 + j as line_no", "line")
    return front.unionByName(body)


LINES_SQL = """
lines AS (
  SELECT 'c' || lpad(CAST(c_custkey AS VARCHAR), 20, '0') AS doc_id,
         'report-2023-' || (c_custkey % 14) || '.pdf' AS file_name,
         j AS line_no,
         CASE WHEN j = 0 THEN 'CDBG-DR Grant History 2001-2023'
              WHEN c_custkey % 4 = 0 THEN 'January 31, 2024'
              WHEN c_custkey % 4 = 1 THEN 'as of March 5, 202'
              WHEN c_custkey % 4 = 2 THEN 'Feb 5, 2022' ELSE 'no date' END AS line
  FROM customer, (VALUES (0), (1)) v(j)
  UNION ALL
  SELECT 'c' || lpad(CAST(o_custkey AS VARCHAR), 20, '0'),
         'report-2023-' || (o_custkey % 14) || '.pdf',
         2 + o_orderkey * 3 + j,
         CASE j WHEN 0 THEN
                CASE WHEN o_orderkey % 6 = 0
                       THEN 'Floods ' || year(o_orderdate) || '-' || (year(o_orderdate) + 1)
                     WHEN o_orderkey % 3 = 0
                       THEN 'Hurricane ' || o_orderstatus || ' ' || year(o_orderdate)
                     ELSE 'Total' END
                WHEN 1 THEN
                'P.L. 1' || (10 + o_orderkey % 20) || '-' || (1 + o_orderkey % 199) ||
                CASE WHEN o_orderkey % 5 = 0 THEN ''
                     ELSE ' ' || strftime(o_orderdate, '%b. %-d, %Y') END
                ELSE
                CASE WHEN o_orderkey % 10 = 0 THEN 'PUERTO RICO $' || CAST(floor(o_totalprice) AS BIGINT)
                     WHEN o_orderkey % 2 = 0
                       THEN 'PUERTO RICO Dept ' || substr(o_orderpriority, 3) || '  $' ||
                            format('{:,}', CAST(floor(o_totalprice) AS BIGINT))
                     ELSE 'FLORIDA State $' || CAST(floor(o_totalprice) AS BIGINT) END END
  FROM orders, (VALUES (0), (1), (2)) v(j)
),
headed AS (
  SELECT *, CASE WHEN line LIKE 'Floods %' OR line LIKE 'Hurricane %' THEN line END AS heading FROM lines
),
tied AS (
  SELECT *, last_value(heading IGNORE NULLS) OVER (
      PARTITION BY doc_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event
  FROM headed
),
dates AS (
  SELECT doc_id, CASE min(line) FILTER (WHERE line_no = 1)
           WHEN 'January 31, 2024' THEN '2024-01-31'
           WHEN 'as of March 5, 202' THEN '2023-03-05'
           ELSE CASE WHEN CAST(regexp_extract(min(file_name), '2023-([0-9]+)', 1) AS INT) BETWEEN 1 AND 12
                     THEN '2023-' || lpad(regexp_extract(min(file_name), '2023-([0-9]+)', 1), 2, '0') || '-01'
                END END AS report_date
  FROM lines GROUP BY doc_id
),
mentions AS (
  SELECT doc_id, line_no, event, split_part(line, ' ', 1) || ' ' || split_part(line, ' ', 2) AS pl_number,
         CASE WHEN split_part(line, ' ', 3) <> '' THEN
              CAST(CAST(strptime(replace(substr(line, length(split_part(line, ' ', 1)) +
                   length(split_part(line, ' ', 2)) + 3), '.', ''), '%b %-d, %Y') AS DATE) AS VARCHAR) END AS pl_date,
         CASE WHEN split_part(line, ' ', 3) <> '' THEN substr(line, length(split_part(line, ' ', 1)) +
                   length(split_part(line, ' ', 2)) + 3) END AS pl_text
  FROM tied WHERE line LIKE 'P.L.%'
),
direct AS (SELECT * FROM mentions WHERE event IS NOT NULL),
last_event AS (
  SELECT doc_id, arg_max(event, line_no) AS event FROM tied WHERE event IS NOT NULL GROUP BY doc_id
),
leftover AS (
  SELECT m.doc_id, min(m.line_no) AS line_no, max(e.event) AS event, m.pl_number
  FROM mentions m LEFT JOIN last_event e ON e.doc_id = m.doc_id
  WHERE NOT EXISTS (SELECT 1 FROM direct d WHERE d.doc_id = m.doc_id AND d.pl_number = m.pl_number)
  GROUP BY m.doc_id, m.pl_number
),
award_lines AS (
  SELECT doc_id, line_no, event,
         CASE WHEN line LIKE 'PUERTO RICO Dept%'
              THEN 'Dept ' || trim(split_part(substr(line, 18), '$', 1)) ELSE 'PUERTO RICO' END AS grantee_name,
         CAST(replace(split_part(line, '$', 2), ',', '') AS DECIMAL(15,2)) AS grant_award
  FROM tied WHERE line LIKE 'PUERTO RICO%'
),
awarded AS (SELECT a.*, d.report_date FROM award_lines a JOIN dates d USING (doc_id)),
all_laws AS (
  SELECT doc_id, line_no, event, pl_number, pl_date, pl_text FROM direct
  UNION ALL SELECT doc_id, line_no, event, pl_number, NULL, NULL FROM leftover
),
laws AS (
  SELECT * FROM all_laws l
  WHERE EXISTS (SELECT 1 FROM awarded a WHERE a.doc_id = l.doc_id AND a.event = l.event)
),
named_events AS (
  SELECT 0 AS src, doc_id, line_no, event FROM awarded WHERE event IS NOT NULL
  UNION ALL SELECT 1, doc_id, line_no, event FROM laws
),
split_events AS (
  SELECT event, regexp_extract(event, '[0-9]{4}(-[0-9]{4})?') AS year,
         trim(regexp_replace(event, '[0-9]{4}(-[0-9]{4})?$', '')) AS name,
         min((src, doc_id, line_no)) AS first_at
  FROM named_events GROUP BY event
),
disaster_t AS (
  SELECT name AS disaster_name, year AS disaster_year, event,
         row_number() OVER (ORDER BY first_at) AS disaster_id
  FROM split_events
),
grantee_t AS (
  SELECT grantee_name, 'PR' AS state_code,
         row_number() OVER (ORDER BY min((doc_id, line_no))) AS grantee_id
  FROM awarded GROUP BY grantee_name
),
history_t AS (
  SELECT d.disaster_id, g.grantee_id, a.grant_award, a.report_date,
         row_number() OVER (ORDER BY min((a.doc_id, a.line_no))) AS grant_history_id
  FROM awarded a LEFT JOIN disaster_t d ON d.event = a.event
       LEFT JOIN grantee_t g ON g.grantee_name = a.grantee_name
  GROUP BY d.disaster_id, g.grantee_id, a.grant_award, a.report_date
)"""

# --- quarterly performance reports -----------------------------------------------


def report_cells(t: Tables) -> DataFrame:
    """Conversations as budget tables: user turns are headers, other turns details.

    Page 0 holds a small first table and the budget table, page 1 another one.
    """
    base = t.conversations.selectExpr(
        "concat('r', lpad(cast(conv_id as string), 20, '0')) as doc_id",
        "cast(turn + 1 as int) as row_no",
        """case when role = 'user' then concat('Budget ', length(text) % 5)
                else concat('B-17-DM-72-', lpad(cast(conv_id % 10000 as string), 4, '0')) end as c0""",
        "concat('$', format_number(length(text) * 1000, 2)) as c1",
        "concat('$', length(text), '.50') as c2",
    )
    body = base.selectExpr(
        "doc_id", "0 as page", "1 as table_no", "row_no",
        "posexplode(array(c0, c1, c2)) as (col_no, text)",
    )
    heads = base.select("doc_id").distinct()
    budget_head = heads.selectExpr(
        "doc_id", "0 as page", "1 as table_no", "0 as row_no",
        "posexplode(array('Overall', 'This Period', 'To Date')) as (col_no, text)",
    )
    first = heads.selectExpr(
        "doc_id", "0 as page", "0 as table_no", "1 as row_no",
        "posexplode(array('a', 'b', 'c')) as (col_no, text)",
    )
    late = heads.selectExpr(
        "doc_id", "1 as page", "0 as table_no", "1 as row_no",
        "posexplode(array('x', '', 'z')) as (col_no, text)",
    )
    return body.unionByName(budget_head).unionByName(first).unionByName(late)


BUDGET_SQL = """
budget AS (
  SELECT 'r' || lpad(CAST(conv_id AS VARCHAR), 20, '0') AS doc_id, turn + 1 AS row_no, role = 'user' AS is_head,
         CASE WHEN role = 'user' THEN 'Budget ' || (length(text) % 5)
              ELSE 'B-17-DM-72-' || lpad(CAST(conv_id % 10000 AS VARCHAR), 4, '0') END AS c0,
         CAST(length(text) * 1000 AS DECIMAL(18,2)) AS period,
         CAST(length(text) + 0.5 AS DECIMAL(18,2)) AS to_date
  FROM conversations
),
budget_tied AS (
  SELECT *, last_value(CASE WHEN is_head THEN c0 END IGNORE NULLS) OVER (
      PARTITION BY doc_id ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head
  FROM budget
),
head_ids AS (
  SELECT doc_id, c0 AS head, row_number() OVER (ORDER BY doc_id, min(row_no)) AS id,
         row_number() OVER (PARTITION BY doc_id ORDER BY min(row_no)) AS own_id
  FROM budget WHERE is_head GROUP BY doc_id, c0
),
doc_ids AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS activity_id FROM (SELECT DISTINCT doc_id FROM budget))"""

ALIASES_SQL = ", ".join(f"'{a}'" for a in QUESTION_ALIASES)


def question_blocks(t: Tables) -> DataFrame:
    """Every turn asks one question; what it links to depends on the turn."""
    names = ", ".join(f"'{a}'" for a in QUESTION_ALIASES)
    base = t.conversations.selectExpr(
        "concat('r', lpad(cast(conv_id as string), 20, '0')) as doc_id",
        "conv_id", "turn",
        f"element_at(array({names}), cast((conv_id + turn) % 12 + 1 as int)) as alias",
        """case when (conv_id + turn) % 12 in (6, 7, 9)
                then case when conv_id % 2 = 0 then '2024-03-05' else 'soon' end
                else concat('Answer ', length(text)) end as answer""",
    )
    asked = base.selectExpr(
        "doc_id", "concat('q', turn) as block_id", "'QUERY' as block_type", "alias",
        """case when turn % 5 = 3 then null when turn % 5 = 4 then array('missing')
                else array(concat('a', turn), 'spare') end as answer_ids""",
        "cast(null as string) as text",
    )
    given = base.selectExpr(
        "doc_id", "concat('a', turn) as block_id",
        "case when turn % 5 = 2 then 'LINE' else 'QUERY_RESULT' end as block_type",
        "cast(null as string) as alias", "cast(null as array<string>) as answer_ids",
        "case when (conv_id + turn) % 7 = 0 then null else answer end as text",
    )
    return asked.unionByName(given)


ANSWERS_SQL = f"""
asked AS (
  SELECT 'r' || lpad(CAST(conv_id AS VARCHAR), 20, '0') AS doc_id, turn,
         (ARRAY[{ALIASES_SQL}])[CAST((conv_id + turn) % 12 + 1 AS INT)] AS alias,
         CASE WHEN turn % 5 = 3 THEN 'No answer found'
              WHEN turn % 5 IN (2, 4) THEN NULL
              WHEN (conv_id + turn) % 7 = 0 THEN 'No answer found'
              WHEN (conv_id + turn) % 12 IN (6, 7, 9)
                THEN CASE WHEN conv_id % 2 = 0 THEN '2024-03-05' ELSE 'soon' END
              ELSE 'Answer ' || length(text) END AS answer
  FROM conversations
),
answered AS (
  SELECT doc_id, {", ".join(f"max(answer) FILTER (WHERE alias = '{a}') AS {a}" for a in QUESTION_ALIASES)}
  FROM asked GROUP BY doc_id
)"""

# --- financial reports -------------------------------------------------------------


def financial_cells(t: Tables) -> DataFrame:
    """One report per nation; even nations use the old layout of six columns.

    Names by customer: full rows, wrapped fragments, name-only rows, blanks.
    """
    rows = t.customer.selectExpr(
        "concat('n', lpad(cast(c_nationkey as string), 20, '0')) as doc_id",
        "c_nationkey % 2 = 0 as old",
        "cast(c_custkey div 200 as int) as page",
        "cast(c_custkey % 200 + 1 as int) as row_no",
        """case c_custkey % 8 when 0 then 'Puerto Rico' when 1 then 'Baton' when 2 then 'Rouge, LA'
                when 3 then '' when 4 then 'pr' when 5 then 'Suffix' when 6 then 'Texas' else 'Orleans' end as who""",
        "c_custkey % 8 in (2, 5) as hollow",
        "concat(' B-', c_custkey, ' ') as grant_id",
        """case when c_acctbal < 0 then concat('($', format_number(-cast(c_acctbal as bigint), 0), ')')
                when c_custkey % 9 = 0 then '$ -'
                else concat('$', format_number(cast(c_acctbal as bigint), 0)) end as money""",
        "concat(c_custkey % 100, ',5 %') as share",
        "cast(2000 + c_custkey % 20 as string) as year_text",
        "c_mktsegment",
    )
    old = rows.where("old").selectExpr(
        "doc_id", "page", "0 as table_no", "row_no",
        """posexplode(array(who, if(hollow, '', grant_id), if(hollow, '', money), if(hollow, '', money),
                 if(hollow, '', 'x'), if(hollow, '', c_mktsegment))) as (col_no, text)""",
    )
    new = rows.where("not old").selectExpr(
        "doc_id", "page", "0 as table_no", "row_no",
        """posexplode(array(who, if(hollow, '', grant_id), if(hollow, '', money), if(hollow, '', money),
                 if(hollow, '', year_text), if(hollow, '', '12'), if(hollow, '', share), if(hollow, '', share),
                 if(hollow, '', c_mktsegment), if(hollow, '', money))) as (col_no, text)""",
    )
    heads = t.nation.selectExpr(
        "concat('n', lpad(cast(n_nationkey as string), 20, '0')) as doc_id",
        "0 as page", "0 as table_no", "0 as row_no",
        """posexplode(case when n_nationkey % 2 = 0
             then array(' Grantee ', 'Grant', 'Grant Award', 'Balance', 'Last', 'Status')
             else array('Grantee Name', 'Grant ID', 'Award', 'Balance', 'Year', 'Age', 'Exp', 'Drawn', 'Status', 'Pace')
             end) as (col_no, text)""",
    )
    return old.unionByName(new).unionByName(heads)


def front_pages(t: Tables) -> DataFrame:
    return t.nation.selectExpr(
        "concat('n', lpad(cast(n_nationkey as string), 20, '0')) as doc_id",
        "concat('report-2023-', 1 + n_nationkey % 12) as file_name",
        """case when n_nationkey % 2 = 0 then concat('as of March ', 1 + n_nationkey, ', 2020 and 2024-01-01')
                when n_nationkey % 3 = 0 then concat('as of 2024-05-', lpad(cast(1 + n_nationkey as string), 2, '0'))
                else 'nothing' end as text""",
    )
