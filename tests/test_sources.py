"""Files, landed pages, documents, web pages, stored tables, drops."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from grantflow.fixed_values import AWARD_FILE_TABLES, HISTORY_FILE_TABLES
from grantflow.functions.cleaning import normalise_missing
from grantflow.operators.load import conform
from grantflow.plans.loading import load_tables, read_rejects
from grantflow.schemas import BLOCKS_DDL, CELLS_DDL, TABLES, TableSpec
from grantflow.session import drop_settled, scratch_dir, settle
from grantflow.sources import documents as D
from grantflow.sources import files as Fi
from grantflow.sources import landed as La
from grantflow.sources import tables as St
from grantflow.sources import web as W
from grantflow.streaming.drops import load_drops, read_drops


def test_codes_survive_csv(spark, tmp_path):
    frame = spark.createDataFrame([("14.210", 'a, "quoted"\ntext'), ("14.2", None)], "code string, t string")
    Fi.write_csv(frame, str(tmp_path / "x"))
    assert rows(Fi.read_csv(spark, str(tmp_path / "x"), frame.schema, multi_line=True)) == rows(frame)
    with pytest.raises(PySparkException):
        Fi.write_csv(frame, str(tmp_path / "x"))
    with pytest.raises((PySparkException, Py4JJavaError)):
        Fi.read_csv(spark, str(tmp_path / "x"), "code int, t string").collect()


def test_newest_batch(spark):
    paths = ["usa_spending_data/grants_20240101_010101.csv", "usa_spending_data/states_20240202_010101.csv",
             "usa_spending_data/grants_20240202_010101.csv", "other/readme.txt"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r[0] for r in rows(Fi.latest_batch(files))] == [paths[2], paths[1]]


def test_routing_takes_the_first_listed(spark):
    paths = ["p/grant_1_2_2024.csv", "p/GRANTEE_1_2_2024.csv", "p/disaster_public_law_1_2_2024.csv"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    found = {r[0]: r[2] for r in rows(Fi.route_files(files, HISTORY_FILE_TABLES))}
    assert found == {"grantee": paths[1], "grant": paths[1], "disaster_public_law": paths[2]}
    assert len(AWARD_FILE_TABLES) == 10


def test_date_groups(spark):
    paths = ["h/grantee_1_15_2024.csv", "h/grant_1_15_2024.csv", "h/grant_2023_7.csv", "h/grant_unknown_date.csv", "h/x.csv"]
    files = spark.createDataFrame([(p,) for p in paths], "path string")
    assert rows(Fi.group_by_date(files).groupBy("date_key").count()) == [("1_15_2024", 2), ("2023_7", 1), ("unknown_date", 1)]


PAGES = "source_id string, page int, has_next boolean, results array<struct<id:string,amount:double>>"


@pytest.mark.parametrize(
    ("stop", "sizes", "flags", "kept"),
    [
        ("empty", [2, 0, 2], [True] * 3, {1}),
        ("short", [2, 1, 2], [True] * 3, {1, 2}),
        ("has_next", [2, 2, 2], [True, False, True], {1, 2}),
        ("has_next", [2, 0, 2], [True, True, True], {1}),
        ("empty", [2, 2], [True, True], {1, 2}),
    ],
)
def test_paging(spark, stop, sizes, flags, kept):
    data = [("s", i + 1, flag, [(f"r{i}{k}", 1.0) for k in range(n)]) for i, (n, flag) in enumerate(zip(sizes, flags))]
    pages = spark.createDataFrame(data, PAGES)
    assert {r[1] for r in rows(La.merge_pages(pages, stop, limit=2))} == kept


def test_missing_result_list_is_an_empty_page(spark):
    pages = spark.createDataFrame([("s", 1, True, None), ("s", 2, True, [("a", 1.0)])], PAGES)
    assert rows(La.merge_pages(pages, "empty")) == []


def test_flatten_awards(spark):
    docs = [
        {"fain": "a", "cfda_info": []},
        {"fain": "b", "awarding_agency": None},
        {"fain": "c", "cfda_info": [{"cfda_number": "14.210"}, {"cfda_number": "2"}],
         "awarding_agency": {"toptier_agency": {"name": "HUD", "code": "086"}, "office_agency_name": "o"}},
    ]
    frame = spark.createDataFrame([(json.dumps(d),) for d in docs], "body string")
    flat = La.flatten_awards(La.parse_awards(frame, "body"))
    assert len(flat.columns) == 26
    picked = flat.select("`Award ID`", "cfda_number", "awarding_agency_name", "awarding_agency_code", "awarding_office_name")
    assert rows(picked) == [("a", None, None, None, None), ("b", None, None, None, None), ("c", "14.210", "HUD", "086", "o")]


def test_award_id_does_not_multiply_children(spark):
    children = spark.createDataFrame([("x", 1), ("y", 2)], "generated_internal_id string, v int")
    awards = spark.createDataFrame([("x", "A"), ("x", "A")], "generated_internal_id string, `Award ID` string")
    assert rows(La.tag_award_id(children, awards)) == [("x", 1, "A"), ("y", 2, None)]


def cells(spark, tables):
    data = [
        (doc, page, table, r, c, text)
        for (doc, page, table), lines in tables.items()
        for r, line in enumerate(lines)
        for c, text in enumerate(line)
    ]
    return spark.createDataFrame(data, CELLS_DDL)


def test_report_tables(spark):
    given = cells(spark, {
        ("d", 0, 0): [["x", "y"]],
        ("d", 0, 1): [[" Grantee name", "Grant"], ["A", "1"]],
        ("d", 1, 0): [["B", "2"], ["C", "3"]],
        ("d", 1, 1): [["only"]],
        ("d", 2, 0): [["GRANTEE", "Grant"], ["D", ""]],
        ("e", 0, 0): [["A", "1"]],
    })
    found, skipped = D.report_tables(given, 2)
    assert [r[0] for r in rows(found.select("c0"))] == ["A", "B", "C", "D"]
    assert rows(skipped.select("doc_id", "page", "table_no", "reason")) == [
        ("d", 0, 0, "no header"), ("d", 1, 1, "other width"), ("e", 0, 0, "no header"),
    ]


def test_rows_by_header_stack_tables_by_name(spark):
    given = cells(spark, {("d", 0, 0): [["A ", "B"], ["1", "2"]], ("d", 0, 1): [["B", "C"], ["3", "4"]]})
    found = D.rows_by_header(given, ["A", "B", "C"]).select("A", "B", "C")
    assert rows(found) == [("1", "2", None), (None, "3", "4")]


def test_pick_tables(spark):
    given = cells(spark, {
        ("d", 0, 0): [["h", "h"], ["1", "2"]], ("d", 0, 1): [["h", "h"], ["3", ""]], ("d", 1, 0): [["5", "6"]],
        ("e", 0, 0): [["h", "h"], ["7", "8"]],
    })
    last = D.cells_to_rows(D.pick_table(given, 0, -1, skip_rows=1), 2)
    assert rows(last.select("doc_id", "c0")) == [("d", "3"), ("e", "7")]
    assert rows(D.pick_table(given, 0, 5)) == []
    many = D.pick_tables(given, {0: [1], 1: [0]}, 2).select("doc_id", "c0", "c1")
    assert rows(many) == [("d", "5", "6"), ("d", "h", "h")]


def test_question_answers(spark):
    data = [
        ("d", "q1", "QUERY", "Activity_Type", ["a1", "zz"], None), ("d", "a1", "QUERY_RESULT", None, None, "Housing"),
        ("d", "q2", "QUERY", "Project_Number", None, None), ("d", "q3", "QUERY", "Project_Title", ["gone"], None),
        ("d", "q4", "QUERY", "Benefit_Type", ["a4"], None), ("d", "a4", "QUERY_RESULT", None, None, None),
        ("d", "q5", "QUERY", "Activity_Title", ["a5"], None), ("d", "a5", "LINE", None, None, "no answer block"),
        ("d", "q6", "QUERY", "Activity_Type", ["a6"], None), ("d", "a6", "QUERY_RESULT", None, None, "Later"),
    ]
    found = D.question_answers(spark.createDataFrame(data, BLOCKS_DDL))
    names = ["Activity_Type", "Project_Number", "Project_Title", "Benefit_Type", "Activity_Title"]
    assert rows(found.select(*names)) == [("Later", "No answer found", None, "No answer found", None)]
    assert rows(normalise_missing(found).select(*names)) == [("Later", None, None, None, None)]


def test_links(spark):
    html = """<a class=x href='/r/Report 1.pdf'>CDBG-DR <b>Report</b> &amp; more</a> <A HREF="http://x.org/b.pdf">CDBG-DR b</A>
    <!-- <a href="/hidden.pdf">CDBG-DR</a> --> <a name="n">CDBG-DR</a><abbr href="/no.pdf">CDBG-DR</abbr> <a href=/c.html>CDBG-DR</a>"""
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    links = W.report_links(W.page_links(pages, "html", ["page_id"]), "CDBG-DR")
    assert rows(links.select("report_url", "file_name", "link_text")) == [
        ("http://x.org/b.pdf", "b.pdf", "CDBG-DR b"),
        ("https://www.hud.gov//r/Report 1.pdf", "Report 1.pdf", "CDBG-DR Report & more"),
    ]
    raw = spark.createDataFrame([("f/b.pdf",)], "path string")
    archived = spark.createDataFrame([("archived/f/Report 1.pdf",), ("archived/g/b.pdf",)], "path string")
    assert rows(W.new_links(links, raw, archived.limit(0), "f").select("file_name")) == [("Report 1.pdf",)]
    assert rows(W.new_links(links, raw.limit(0), archived, "f").select("file_name")) == [("b.pdf",)]


def test_publish_is_all_or_nothing(spark):
    root, spec = St.create_store(spark, scratch_dir(spark, "t")), TABLES["states"]
    good = spark.createDataFrame([("PR", "Puerto Rico"), ("TX", "Texas")], "state_code string, state_name string")
    assert St.publish(good, root, spec, "r1")
    assert not St.publish(good, root, spec, "r1")
    bad = spark.createDataFrame([("LA", "Louisiana"), ("PRX", "Long")], "state_code string, state_name string")
    with pytest.raises(St.LoadRejected, match="1 rows"):
        St.publish(bad, root, spec, "r2")
    with pytest.raises(St.LoadRejected, match="primary key"):
        St.publish(good, root, spec, "r3")
    assert rows(St.read_table(spark, root, spec)) == [("PR", "Puerto Rico"), ("TX", "Texas")]
    assert St.publish(bad.where("state_code = 'LA'"), root, spec, "r2")
    assert St.read_table(spark, root, spec).count() == 3
    assert St.truncate(spark, root, "states", "r4")[0] == "states"
    assert St.read_table(spark, root, spec).isEmpty()


def test_missing_parent_stops_the_load(spark):
    root = St.create_store(spark, scratch_dir(spark, "t"))
    frames = {"grantee": spark.createDataFrame([(1, "n", "PR")], "grantee_id int, grantee_name string, state_code string")}
    with pytest.raises(St.LoadRejected, match="foreign key"):
        load_tables(frames, root, "r1")
    frames["states"] = spark.createDataFrame([("PR", "Puerto Rico")], "state_code string, state_name string")
    assert load_tables(frames, root, "r1") == {"states": True, "grantee": True}
    assert load_tables(frames, root, "r1") == {"states": False, "grantee": False}


def test_auto_ids_continue(spark):
    root = St.create_store(spark, scratch_dir(spark, "t"))
    one = spark.createDataFrame([("d1", "1.00", "p", "2.00")], "description string, time_period_amount string, time_period string, to_date_amount string")
    two = one.unionByName(spark.createDataFrame([("d2", "1.00", "p", "2.00")], one.schema))
    load_tables({"amountdescriptions": one}, root, "r1")
    load_tables({"amountdescriptions": two}, root, "r2")
    stored = St.read_table(spark, root, TABLES["amountdescriptions"])
    assert rows(stored.select("amount_desc_id", "description")) == [(1, "d1"), (2, "d2")]


def test_added_column_reads_null_from_old_runs(spark):
    root = St.create_store(spark, scratch_dir(spark, "t"))
    old = TableSpec("w", "k int", ("k",))
    new = TableSpec("w", "k int, extra string", ("k",))
    St.publish(spark.createDataFrame([(1,)], "k int"), root, old, "r1")
    St.publish(spark.createDataFrame([(2, "x")], "k int, extra string"), root, new, "r2")
    assert rows(St.read_table(spark, root, new)) == [(1, None), (2, "x")]


def test_drops_load_once(spark, tmp_path):
    spec = TableSpec("e", "k int, v string", ("k",))
    source, root = tmp_path / "in", St.create_store(spark, str(tmp_path / "tables"))
    source.mkdir()

    def drop(name, text):
        (source / name).write_text("k,v\n" + text)

    def run():
        stream = read_drops(spark, str(source), spec.schema, archive=str(tmp_path / "archive"))
        load_drops(stream, root, spec, str(tmp_path / "checkpoint"), ["v"])
        return rows(St.read_table(spark, root, spec))

    drop("a.csv", "1,a\n2,b\n2,c\n")
    assert run() == [(1, "a"), (2, "b")]
    assert run() == [(1, "a"), (2, "b")]
    drop("b.csv", "1,other\n3,d\n")
    assert run() == [(1, "a"), (2, "b"), (3, "d")]
    assert run() == [(1, "a"), (2, "b"), (3, "d")]


def test_conform_reads_staged_dates(spark):
    frame = spark.createDataFrame([("g", "01-31-2024", "1.005")], "grant_id string, start_date string, total_funding string")
    found = conform(frame, TABLES["grants"]).select("start_date", "total_funding", "award_type")
    assert [str(v) for v in rows(found)[0]] == ["2024-01-31", "1.01", "None"]


def test_settled_tables_can_be_dropped(spark):
    frame = settle(spark.range(10))
    assert frame.count() == 10
    assert drop_settled(spark) >= 1
    with pytest.raises((PySparkException, Py4JJavaError)):
        frame.agg(F.sum("id")).collect()


def test_large_csv_files_are_split(spark, tmp_path):
    """One file, several tasks; only cells with line breaks ask for one task per file."""
    (tmp_path / "big.csv").write_text("k,v\n" + "".join(f"{k},{'x' * 100}\n" for k in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256k")
    try:
        split = Fi.read_csv(spark, str(tmp_path), "k int, v string")
        assert split.rdd.getNumPartitions() > 4 and split.count() == 20_000
        assert Fi.read_csv(spark, str(tmp_path), "k int, v string", multi_line=True).rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_long_link_targets_stay_whole(spark):
    href = "/" + "a" * 5000
    page = spark.createDataFrame([(1, f'<a href="{href}">t</a>')], "page_id int, html string")
    assert W.page_links(page, "html", ["page_id"]).first().href == href


def test_drops_reject_lines_that_do_not_fit(spark, tmp_path):
    spec = TableSpec("e", "k int, v int", ("k",))
    root = St.create_store(spark, str(tmp_path / "tables"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("k,v\nx2,7\n3,oops\n4,8\n,9\n")
    load_drops(read_drops(spark, str(tmp_path / "in"), spec.schema), root, spec, str(tmp_path / "checkpoint"))
    assert rows(St.read_table(spark, root, spec)) == [(4, 8)]
    found = rows(read_rejects(spark, root).select("rule", "text"))
    assert found == [("format", "3,oops"), ("format", "x2,7"), ("key", '{"v":9}')]


def test_malformed_awards_are_told(spark):
    docs = spark.createDataFrame([(1, '{"fain": "G1"}'), (2, "<html>"), (3, None)], "id int, body string")
    assert [r.fain for r in La.parse_awards(docs, "body").collect()] == ["G1"]
    assert rows(La.rejected_awards(docs, "body", "id")) == [("awards", "2", "format", "<html>"), ("awards", "3", "missing", None)]
