"""Table builders over small hand-written inputs."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from grantflow.fixed_values import NEW_LAYOUT
from grantflow.plans import awards as A
from grantflow.plans import financial as Fi
from grantflow.plans import history as H
from grantflow.plans import performance as P
from grantflow.plans.loading import load_tables
from grantflow.schemas import (
    AWARDS_DDL,
    BLOCKS_DDL,
    CELLS_DDL,
    FUNDING_DDL,
    LINES_DDL,
    OTHER_DDL,
    SUBAWARDS_DDL,
    TABLES,
    TRANSACTIONS_DDL,
)
from grantflow.session import scratch_dir
from grantflow.plans.loading import read_rejects
from grantflow.sources.tables import Ledger, LoadRejected, compact, create_store, publish, read_table


def frame(spark, ddl, *records):
    schema = T.StructType.fromDDL(ddl)
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


def award_inputs(spark):
    awards = frame(spark, AWARDS_DDL,
                   {"Award ID": "G1", "Recipient Name": " Acme ", "Award Amount": Decimal("5.00"), "Award Type": "BLOCK",
                    "def_codes": "['Q']", "Start Date": "2020-01-31", "End Date": "junk", "generated_internal_id": "A1"},
                   {"Award ID": "G2", "Recipient Name": "Acme", "def_codes": "['Q', 'N']", "generated_internal_id": "A2"})
    other = frame(spark, OTHER_DDL,
                  {"Award ID": "G1", "generated_unique_award_id": "A1", "cfda_number": "14.210", "cfda_title": "t",
                   "recipient_state_code": "PR", "recipient_state_name": "Puerto Rico", "awarding_agency_name": "HUD",
                   "awarding_agency_code": "086", "awarding_sub_agency_name": "S", "awarding_sub_agency_code": "8600",
                   "start_date": "2020-01-31"},
                  {"Award ID": "G2", "generated_unique_award_id": "A2"},
                  {"Award ID": "G3", "generated_unique_award_id": "none"})
    funding = frame(spark, FUNDING_DDL,
                    {"funding_agency_name": "HUD", "funding_agency_id": 1, "funding_toptier_agency_id": 2,
                     "funding_agency_slug": "hud", "awarding_agency_name": "EPA", "awarding_agency_id": 3,
                     "awarding_toptier_agency_id": 4, "awarding_agency_slug": "epa", "Award ID": "G1",
                     "reporting_fiscal_year": 2020, "is_quarterly_submission": False})
    subs = frame(spark, SUBAWARDS_DDL,
                 {"subaward_id": "1", "action_date": "2021-02-03", "recipient_name": " Bolt", "generated_internal_id": "A1"},
                 {"subaward_id": "2", "recipient_name": None, "generated_internal_id": "zz"})
    moves = frame(spark, TRANSACTIONS_DDL, {"id": "t", "action_date": "bad", "cfda_number": "14.210", "Award ID": "G1"})
    codes = spark.createDataFrame([("Q", "115-56", 0), ("Q", "115-123", 1)], "def_codes string, `PL Number 1` string, row_no int")
    return awards, other, funding, subs, moves, codes


def test_award_tables(spark):
    built = A.award_tables(*award_inputs(spark))
    assert rows(built["states"]) == [("Puerto Rico", "PR")]
    assert rows(built["cfdaprograms"]) == [("14.210", "t", None)]
    assert rows(built["agencies"]) == [("EPA", None, 3, 4, "epa"), ("HUD", 86, 1, 2, "hud")]
    assert rows(built["subagency"]) == [("S", 8600)]
    known = {r[0]: r[1] for r in rows(built["recipients"])}
    assert set(known) == {"Acme", "Bolt"}
    grants = {r.grant_id: r for r in built["grants"].collect()}
    assert (grants["G1"].public_law_number, grants["G1"].start_date, grants["G1"].awarding_agency_code) == ("115-123", "01-31-2020", "86")
    assert (grants["G2"].def_codes, grants["G2"].public_law_number) == ("Q', 'N", None)
    assert grants["G3"].award_type is None and len(built["grants"].columns) == 26
    assert {r.recipient_id for r in built["federalawards"].collect()} == {known["Acme"]}
    assert rows(built["subawards"].select("subaward_id", "grant_id", "action_date", "recipient_id")) == [
        ("1", "G1", "02-03-2021", known["Bolt"]), ("2", None, None, None),
    ]
    assert rows(built["transactions"].select("action_date", "cfda_number")) == [(None, "14.210")]
    assert rows(built["funding"].select("reporting_fiscal_year", "is_quarterly_submission")) == [(2020, False)]


REPORT = [
    "CDBG-DR Grant History 2001-2023", "January 31, 2024", "P.L. 107-38", "Hurricanes Irma, Maria 2017",
    "P.L. 115-56 Sept. 8, 2017", "P.L. 115-123 Feb. 9, 2018", "PUERTO RICO Department of Housing $1,507,179,000",
    "FLORIDA State $615,922,000", "Floods 2016-2017", "P.L. 114-223",
]


def lines(spark, *docs):
    data = [(d, f"{d}-2023-7.pdf", i, line) for d, text in docs for i, line in enumerate(text)]
    return spark.createDataFrame(data, LINES_DDL)


def test_history_steps(spark):
    given = lines(spark, ("d1", REPORT))
    tied = H.sections(H.headed(given), block=2)
    sections = [r[0] for r in tied.orderBy("line_no").select("disaster_event").collect()]
    assert sections == [None] * 3 + ["Hurricanes Irma, Maria 2017"] * 5 + ["Floods 2016-2017"] * 2
    assert rows(H.report_dates(given)) == [("d1", date(2024, 1, 31))]
    direct = H.sectioned_laws(tied)
    assert rows(direct.select("pl_number", "pl_date")) == [
        ("P.L. 114-223", None), ("P.L. 115-123", "Feb. 9, 2018"), ("P.L. 115-56", "Sept. 8, 2017"),
    ]
    assert rows(H.leftover_laws(tied, direct).select("pl_number", "disaster_event")) == [("P.L. 107-38", "Floods 2016-2017")]
    laws, awards = H.extract(given)
    assert {r.pl_number for r in laws.collect()} == {"P.L. 115-56", "P.L. 115-123"}
    assert rows(awards.select("disaster_event", "grantee_name", "grant_award")) == [
        ("Hurricanes Irma, Maria 2017", "Department of Housing", Decimal("1507179000.00")),
    ]


def test_history_tables_continue_stored_ids(spark):
    second = ["Floods 2016-2017", "P.L. 114-223", "PUERTO RICO Other Agency $5", "PUERTO RICO Department of Housing $7"]
    stored = {
        "grantee": spark.createDataFrame([("Department of Housing", "PR", 4)], "grantee_name string, state_code string, grantee_id bigint"),
        "disaster": spark.createDataFrame([("Floods", "2016-2017", 9)], "disaster_name string, disaster_year string, disaster_id bigint"),
        "granthistory": spark.createDataFrame([(9, 4, Decimal("1.00"), None, 20)],
                                              "disaster_id bigint, grantee_id bigint, grant_award decimal(15,2), report_date date, grant_history_id bigint"),
        "publiclaw": spark.createDataFrame([("P.L. 114-223", date(2016, 1, 1))], "pl_number string, pl_date date"),
        "disasterpubliclaw": spark.createDataFrame([(9, "P.L. 114-223")], "disaster_id bigint, pl_number string"),
    }
    built = H.history_tables(lines(spark, ("d1", REPORT), ("d2", second)), stored)
    assert rows(built["grantee"]) == [("Other Agency", "PR", 5)]
    assert rows(built["disaster"]) == [("Hurricanes Irma, Maria", "2017", 10)]
    assert rows(built["publiclaw"].select("pl_number")) == [("P.L. 115-123",), ("P.L. 115-56",)]
    assert rows(built["disasterpubliclaw"]) == [(10, "P.L. 115-123"), (10, "P.L. 115-56")]
    history = rows(built["granthistory"].select("grant_history_id", "disaster_id", "grantee_id", "grant_award"), "grant_history_id")
    assert history == [(21, 10, 4, Decimal("1507179000.00")), (22, 9, 5, Decimal("5.00")), (23, 9, 4, Decimal("7.00"))]


def test_performance_tables(spark):
    table = [["Overall", "p", "d"], ["Total Budget", "$10.00", "$20.00"], ["B-17-DM-72-0001", "$4.00", "$8.00"]]
    data = [(d, 0, t, r, c, x) for d in ("d1", "d2") for t, part in ((0, [["first"]]), (1, table))
            for r, line in enumerate(part) for c, x in enumerate(line)]
    blocks = [(d, "q1", "QUERY", "Activity_Type", ["a1"], None) for d in ("d1", "d2")]
    blocks += [("d1", "a1", "QUERY_RESULT", None, None, "Housing"),
               ("d1", "q2", "QUERY", "Projected_End_Date", ["a2"], None), ("d1", "a2", "QUERY_RESULT", None, None, "03/05/2024")]
    built = P.performance_tables(spark.createDataFrame(data, CELLS_DDL), spark.createDataFrame(blocks, BLOCKS_DDL), next_description=7)
    assert rows(built["activities"].select("activity_id", "activity_type", "projected_end_date")) == [
        (1, "Housing", date(2024, 3, 5)), (2, None, None),
    ]
    assert rows(built["performancereports"]) == [
        (128, 1, 7, "B-17-DM-72-0001", Decimal("8.00"), Decimal("4.00")),
        (129, 2, 8, "B-17-DM-72-0001", Decimal("8.00"), Decimal("4.00")),
    ]
    assert rows(built["amountdescriptions"].select("amount_desc_id", "description", "time_period")) == [
        (7, "Total Budget", "Apr 1 thru Jun 30, 2024"), (8, "Total Budget", "Apr 1 thru Jun 30, 2024"),
    ]


def test_financial_rows_are_repaired(spark):
    blank = [""] * 9
    full = ["B-1", "$1,000", "($20)", "2017", "12", "45,5 %", "10%", "On pace", "$ -"]
    names = [("Puerto Rico", full), ("", full), ("Baton", full), ("Rouge, LA", blank), ("Suffix", blank), ("Texas", full), ("", blank)]
    data = [("d", i, n, *values) for i, (n, values) in enumerate(names)]
    schema = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("place", T.IntegerType()),
                           *[T.StructField(c, T.StringType()) for c in NEW_LAYOUT]])
    repaired = Fi.repair_rows(spark.createDataFrame(data, schema), "doc_id", "place", block=4)
    assert [r.Grantee for r in repaired.orderBy("place").collect()] == [
        "Puerto Rico", "Puerto Rico", "Baton Rouge, LA Suffix", "Texas",
    ]
    typed = Fi.financial_reports(repaired).orderBy("place").drop("doc_id", "place")
    assert [tuple(r) for r in typed.collect()] == [
        ("B-1", "PR", Decimal("1000.00"), Decimal("-20.00"), 2017, 12, Decimal("45.50"), Decimal("10.00"), "On pace", Decimal("0.00")),
    ] * 2
    assert Fi.financial_reports(repaired, state=None).where(F.col("state_code") == "TX").count() == 1


def test_old_layout_has_no_pace(spark):
    cells = [("d", 0, 0, r, c, x) for r, line in enumerate([
        ["Grantee", "Grant", "Award", "Balance", "Last", "Status"], ["PR", " B-1 ", "$5", "$4", "x", "slow"],
    ]) for c, x in enumerate(line)]
    front = spark.createDataFrame([("d", "r-2019-1", "as of March 5, 2020")], "doc_id string, file_name string, text string")
    built = Fi.financial_tables(spark.createDataFrame(cells, CELLS_DDL), front)["grantfinancialreports"]
    row = built.first()
    assert (row.report_id, row.grant_id, row.grant_award, row.amount_behind_pace, row.spending_status, row.report_date) == (
        1, "B-1", Decimal("5.00"), None, "slow", date(2020, 3, 5))


def test_award_tables_load_once(spark):
    """All ten tables against their parents; a second run with the same input adds nothing."""
    root = create_store(spark, scratch_dir(spark, "awards"))
    built = A.award_tables(*award_inputs(spark))
    for run_id in ("r1", "r2"):
        assert set(load_tables(built, root, run_id).values()) == {True}
        stored = {name: read_table(spark, root, TABLES[name]) for name in built}
        assert {name: df.count() for name, df in stored.items()} == {
            "states": 1, "cfdaprograms": 1, "agencies": 1, "subagency": 1, "recipients": 2, "grants": 3,
            "federalawards": 2, "funding": 1, "transactions": 1, "subawards": 2,
        }
    grant = stored["grants"].where("grant_id = 'G1'").first()
    assert (grant.start_date, grant.awarding_sub_agency_code) == (date(2020, 1, 31), 8600)
    assert rows(stored["federalawards"].select("award_id")) == [(1,), (2,)]
    assert rows(stored["agencies"].select("agency_code", "agency_name")) == [("86", "HUD")]


def test_repeated_headers_load_as_the_first(spark):
    root = create_store(spark, scratch_dir(spark, "headers"))
    headers = spark.createDataFrame(
        [(1, "Total", "9.00", "p", "1.00", "d1", 1), (1, "Total", "2.00", "p", "1.00", "d1", 4)],
        "amount_desc_id bigint, description string, time_period_amount string, time_period string, "
        "to_date_amount string, doc_id string, row_no int",
    )
    load_tables({"amountdescriptions": headers}, root, "r1", {"amountdescriptions": ["doc_id", "row_no"]})
    stored = read_table(spark, root, TABLES["amountdescriptions"])
    assert rows(stored.select("amount_desc_id", "time_period_amount")) == [(1, Decimal("9.00"))]


def test_second_quarter_keeps_all_reports(spark):
    """Ids above ten digits stay apart, and a second load adds its reports under further ids."""
    root, stored = create_store(spark, scratch_dir(spark, "quarters")), None
    table = [["Overall", "p", "d"], ["Budget", "$10.00", "$20.00"], ["B-17-DM-72-0001", "$4.00", "$8.00"]]
    for run, doc in enumerate(("r12345678901", "r12345678902")):
        cells = [(doc, 0, 0, r, c, x) for r, line in enumerate(table) for c, x in enumerate(line)]
        blocks = [(doc, "q1", "QUERY", "Activity_Type", ["a1"], None)]
        built = P.performance_tables(spark.createDataFrame(cells, CELLS_DDL), spark.createDataFrame(blocks, BLOCKS_DDL), stored)
        load_tables(built, root, f"r{run}", {"amountdescriptions": ["doc_id", "row_no"]}, check_parents=False)
        stored = {name: read_table(spark, root, TABLES[name]) for name in built}
    reports = stored["performancereports"].select("performance_id", "activity_id", "amount_desc_id")
    assert rows(reports) == [(128, 1, 1), (129, 2, 2)]
    assert stored["activities"].count() == stored["amountdescriptions"].count() == 2
    clash = spark.createDataFrame([(1, "other", "1.00", "p", "1.00")], "amount_desc_id int, description string, "
                                  "time_period_amount string, time_period string, to_date_amount string")
    with pytest.raises(LoadRejected, match="other content"):
        load_tables({"amountdescriptions": clash}, root, "r9")


def test_keys_are_compared_in_their_declared_type(spark):
    root, spec = create_store(spark, scratch_dir(spark, "keys")), TABLES["grantee"]
    one = spark.createDataFrame([("12", "a", "PR"), ("012", "b", "PR"), (None, "c", "PR"), ("x", "d", "PR")], "grantee_id string, grantee_name string, state_code string")
    load_tables({"grantee": one}, root, "r1", check_parents=False)
    assert rows(read_table(spark, root, spec).select("grantee_id", "grantee_name")) == [(12, "a")] or rows(
        read_table(spark, root, spec).select("grantee_id", "grantee_name")) == [(12, "b")]
    assert rows(read_rejects(spark, root).select("source", "rule", "key")) == [("grantee", "key", ""), ("grantee", "key", "x")]


def test_a_missing_store_is_an_error(spark):
    with pytest.raises(FileNotFoundError, match="no store"):
        read_table(spark, scratch_dir(spark, "nowhere"), TABLES["states"])


def test_compacted_runs_show_the_same_rows(spark):
    root, spec = create_store(spark, scratch_dir(spark, "compact")), TABLES["states"]
    for k in range(3):
        publish(spark.createDataFrame([(f"S{k}", f"name {k}")], "state_code string, state_name string"), root, spec, f"r{k}")
    before = rows(read_table(spark, root, spec))
    assert compact(spark, root, spec, "all") and not compact(spark, root, spec, "all")
    assert rows(read_table(spark, root, spec)) == before and Ledger(spark, root).visible_runs("states") == ["all"]


def test_history_reads_text_once(spark, monkeypatch):
    """What is kept of a line has no text: later steps read no pattern again, and tell the same as those on lines."""
    given = lines(spark, ("d1", REPORT), ("d2", REPORT[:7]))
    marked = H.marked_lines(given)
    assert "line" not in marked.columns
    tied, plain = (H.sections(x) for x in (marked, H.headed(given)))
    assert rows(H.report_dates(marked)) == rows(H.report_dates(given))
    assert rows(H.award_lines(tied)) == rows(H.award_lines(plain))
    assert rows(H.sectioned_laws(tied)) == rows(H.sectioned_laws(plain))
    direct = H.sectioned_laws(tied)
    assert rows(H.leftover_laws(tied, direct)) == rows(H.leftover_laws(plain, direct))
    # a null document matches nothing, as before
    odd = spark.createDataFrame([(None, 0, "P.L. 1-23", "E 2001", None)], "doc_id string, line_no bigint, line string, disaster_event string, heading string")
    assert [r.pl_number for r in H.leftover_laws(odd.withColumn("line", F.lit("P.L. 11-23")), H.sectioned_laws(odd)).collect()] == ["P.L. 11-23"]
