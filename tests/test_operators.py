"""Frame operators: fixtures, properties, plans."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from conftest import rows
from grantflow.operators import joins as J
from grantflow.operators import load as L
from grantflow.operators import numbering as N
from grantflow.operators import ordered as O
from grantflow.operators import rows as R
from grantflow.schemas import TABLES

FRAGMENTS = ["Rouge, LA", "PA", "County, PA", "LA"]


def names_frame(spark, files):
    data = [(f, i, n) for f, names in files.items() for i, n in enumerate(names)]
    return spark.createDataFrame(data, "file string, row_no int, name string")


def by_loop(names, fragments, passes=3):
    """The same repair, row by row."""
    names = list(names)
    for _ in range(passes):
        for i in range(1, len(names)):
            if names[i].strip() in fragments:
                names[i - 1] = f"{names[i - 1].strip()} {names[i].strip()}"
                names[i] = ""
    return names


@pytest.mark.parametrize("block", [3, 4, 65536])
@pytest.mark.parametrize(
    ("names", "expected"),
    [
        (["Baton", "Rouge, LA", "x"], ["Baton Rouge, LA", "", "x"]),
        (["Dauphin", "County,", "PA"], ["Dauphin County, PA", "", ""]),
        (["A", "", "", "", "PA"], ["A", " PA", "", "", ""]),
        (["PA", "x"], ["PA", "x"]),
    ],
)
def test_wrapped_names(spark, names, expected, block):
    frame = names_frame(spark, {"f": names})
    found = O.repair_wrapped(frame, ["file"], "row_no", "name", FRAGMENTS, block=block)
    assert [r[2] for r in rows(found, "row_no")] == expected


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.sampled_from(["A", "B", "", "PA", "County,", "LA", "Rouge, LA", " PA "]), max_size=25),
        min_size=1,
        max_size=40,
    )
)
def test_wrapped_names_equal_the_loop(spark, files):
    named = {f"f{i}": names for i, names in enumerate(files)}
    found = O.repair_wrapped(names_frame(spark, named), ["file"], "row_no", "name", FRAGMENTS, block=5)
    got = {f: [] for f in named}
    for file, _, name in rows(found, "file", "row_no"):
        got[file].append(name)
    assert got == {f: by_loop(names, FRAGMENTS) for f, names in named.items()}


def test_wrapped_names_refuse_gaps(spark):
    frame = spark.createDataFrame([("f", 0, "a"), ("f", 2, "PA")], "file string, row_no int, name string")
    with pytest.raises(PySparkException, match="without gaps"):
        O.repair_wrapped(frame, ["file"], "row_no", "name", FRAGMENTS).collect()


@pytest.mark.parametrize("block", [2, 65536])
def test_name_only_rows_fold_upwards(spark, block):
    data = [("f", 0, "A", "1"), ("f", 1, "b", None), ("f", 2, "c", None), ("f", 3, "D", "2"), ("f", 4, None, "3"),
            ("g", 0, "X", None), ("g", 1, "y", None)]
    frame = spark.createDataFrame(data, "file string, row_no int, name string, v string")
    found = O.fold_name_only(frame, ["file"], "row_no", "name", ["v"], block)
    assert rows(found.select("file", "row_no", "name", "v"), "file", "row_no") == [
        ("f", 0, "A b c", "1"), ("f", 3, "D", "2"), ("g", 0, "X y", None),
    ]


@pytest.mark.parametrize("block", [1, 3, 65536])
def test_carry_down_equals_the_loop(spark, block):
    rng = random.Random(7)
    data, expected = [], []
    for doc in range(12):
        current = None
        for line in range(rng.randrange(1, 40)):
            value = rng.choice([None, None, None, f"h{line}"])
            current = value or current
            data.append((f"d{doc}", line, value))
            expected.append((f"d{doc}", line, current))
    frame = spark.createDataFrame(data, "doc string, line int, h string")
    found = O.carry_down(frame, ["doc"], "line", F.col("h"), "section", block)
    assert rows(found.select("doc", "line", "section"), "doc", "line") == sorted(expected, key=lambda r: r[:2])


def budget(spark):
    data = [
        ("B-17-DM-72-0001", "$1.00", "$2.00"), ("Total Budget", "$10.00", "$20.00"), ("B-17-DM-72-0001", "$4.00", "$8.00"),
        ("Total Obligated", "$5.00", "$6.00"), ("Total Budget", "$7.00", "$9.00"), ("B-18-DP-72-0001", "$7.00", "$9.00"),
    ]
    both = [(d, i, *row) for d in ("d1", "d2") for i, row in enumerate(data)]
    return spark.createDataFrame(both, "doc string, row_no int, c0 string, c1 string, c2 string")


def test_headers_and_details(spark):
    headers, details = O.split_header_detail(budget(spark), ["doc"], "row_no", "c0")
    assert rows(headers.select("doc", "row_no", "description_id", "description"), "doc", "row_no") == [
        ("d1", 1, 1, "Total Budget"), ("d1", 3, 2, "Total Obligated"), ("d1", 4, 1, "Total Budget"),
        ("d2", 1, 3, "Total Budget"), ("d2", 3, 4, "Total Obligated"), ("d2", 4, 3, "Total Budget"),
    ]
    assert rows(details.select("doc", "row_no", "description_id"), "doc", "row_no") == [
        ("d1", 2, 1), ("d1", 5, 1), ("d2", 2, 3), ("d2", 5, 3),
    ]
    kept = R.first_per_key(headers, ["description_id"], ["doc", "row_no"])
    assert [r[0] for r in rows(kept.select("c1"))] == ["$10.00", "$10.00", "$5.00", "$5.00"]


def test_headers_start_anew_per_document(spark):
    _, details = O.split_header_detail(budget(spark), ["doc"], "row_no", "c0", start=5, chained=False, block=2)
    assert {r[0] for r in rows(details.select("description_id"))} == {5}


def test_ids_continue_and_stay(spark):
    stored = spark.createDataFrame([("A", 1), ("B", 2)], "name string, id bigint")
    new = spark.createDataFrame([(0, "C"), (1, "B"), (2, "D"), (3, "C")], "i int, name string")
    fresh = N.first_seen_ids(new, ["name"], ["i"], "id", stored)
    assert rows(fresh) == [("C", 3), ("D", 4)]
    again = N.first_seen_ids(new, ["name"], ["i"], "id", stored.unionByName(fresh))
    assert rows(again) == []


def test_ids_do_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    data = [(i, f"n{rng.randrange(300)}") for i in range(3000)]
    frame = spark.createDataFrame(data, "i int, name string")
    results = [
        rows(N.first_seen_ids(frame.repartition(parts), ["name"], ["i"], "id")) for parts in (1, 7, 16)
    ]
    seen = list(dict.fromkeys(name for _, name in data))
    assert results[0] == results[1] == results[2]
    assert dict(results[0]) == {name: k + 1 for k, name in enumerate(seen)}


def test_serial_ids_and_positions(spark):
    data = [(f, i) for f in ("a", "b", "c") for i in range(0, 50, 3)]
    frame = spark.createDataFrame(data, "file string, row_no int").repartition(5)
    found = rows(N.serial_ids(frame, ["file"], "row_no", "id", start=128, block=10), "file", "row_no")
    assert [r[2] for r in found] == list(range(128, 128 + len(data)))
    placed = rows(N.positions(frame, ["file"], [], "row_no", "place", block=10), "file", "row_no")
    assert [r[2] for r in placed] == list(range(17)) * 3


def test_loaded_ids_are_dense_and_unique(spark):
    stored = spark.createDataFrame([(41,)], "id bigint")
    frame = spark.range(1000).repartition(7).withColumnRenamed("id", "v")
    ids = [r[0] for r in rows(N.loaded_ids(frame, "id", stored=stored).select("id"))]
    assert sorted(ids) == list(range(42, 1042))


def test_new_rows_null_meets_null_and_duplicates_stay(spark):
    new = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c"), (2, "c")], "k int, v string")
    stored = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert rows(J.new_rows(new, stored)) == [(2, "c"), (2, "c")]
    loaded = stored.unionByName(J.new_rows(new, stored))
    assert rows(J.new_rows(new, loaded)) == []


def test_new_rows_compare_in_the_stored_type(spark):
    new = spark.createDataFrame([("1.005", "x"), ("7", "y"), ("bad", "z"), (None, "w")], "amount string, v string")
    stored = spark.sql("select 1L as id, cast(1.01 as decimal(18,2)) as amount, 'x' as v "
                       "union all select 2L, null, 'z' union all select 3L, null, 'w'")
    assert rows(J.new_rows(new, stored, ignore=["id"])) == [("7", "y"), ("bad", "z")]


def test_lookup_last_wins(spark):
    codes = spark.createDataFrame([("Q", "115-56", 0), ("Q", "115-123", 1)], "code string, law string, row_no int")
    frame = spark.createDataFrame([("Q",), ("N",), (None,)], "c string")
    assert rows(J.lookup(frame, "c", codes, "code", "law", "row_no", "law")) == [
        ("N", None), ("Q", "115-123"), (None, None),
    ]


def test_enrich_never_matches_null(spark):
    left = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (None, "y")], "k int, w string")
    assert rows(J.enrich(left, right, ["k"], ["w"])) == [(1, "a", "x"), (None, "b", None)]


def test_state_codes(spark):
    frame = spark.createDataFrame([("PUERTO RICO",), (" texas ",), ("la",), ("Nowhere",), (None,)], "s string")
    found = J.state_code(frame, "s", "code").select("code")
    assert rows(found) == [("LA",), ("Nowhere",), ("PR",), ("TX",), (None,)]


def test_prefix_anti_join(spark):
    links = spark.createDataFrame([("f/a.pdf",), ("f/b.pdf",), ("f/c.pdf",), ("f/d.pdf.pdf",)], "k string")
    listing = spark.createDataFrame([("f/a.pdf",), ("f/b.pdf.bak",), ("f/c",), ("x/f/c.pdf",), ("f/d.pdf.pdf.1",)], "p string")
    assert rows(J.drop_prefixed(links, "k", listing, "p", ".pdf")) == [("f/c.pdf",)]


def test_drop_null_columns(spark):
    frame = spark.createDataFrame([(1, 1), (2, None)], "a int, b int")
    assert R.drop_null_columns(frame).columns == ["a"]


def test_first_per_key_needs_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        R.first_per_key(spark.range(1), ["id"], [])


def test_insert_twice_is_insert_once(spark):
    new = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 2, "c")], "k int, o int, v string")
    stored = spark.createDataFrame([(2, 9, "old")], "k int, o int, v string")
    first = L.insert_if_absent(new, stored, ["k"], ["o"])
    assert rows(first) == [(1, 0, "a")]
    assert rows(L.insert_if_absent(new, stored.unionByName(first), ["k"], ["o"])) == []


def test_constraints(spark):
    grants = spark.createDataFrame(
        [("g1", "14.228", "PRX"), ("g1", "99.999", "PR")], "grant_id string, cfda_number string, recipient_state_code string"
    )
    spec = TABLES["grants"]
    assert rows(L.violations(grants, spec)) == [("grants", "recipient_state_code", "length", "g1")]
    assert rows(L.key_violations(grants, spec)) == [("grants", "grant_id", "primary key", "g1")]
    parents = {
        "cfdaprograms": spark.createDataFrame([("14.228",)], "cfda_number string"),
        "states": spark.createDataFrame([("PR",), ("PRX",)], "state_code string"),
    }
    assert rows(L.reference_violations(grants, spec, parents)) == [("grants", "cfda_number", "foreign key", "99.999")]
    agencies = spark.createDataFrame([("86", None)], "agency_code string, agency_name string")
    assert rows(L.violations(agencies, TABLES["agencies"])) == [("agencies", "agency_name", "required", "86")]


def test_load_order_and_children():
    names = [s.name for s in L.load_order(["granthistory", "grantee", "states", "disaster"])]
    assert names.index("states") < names.index("grantee") < names.index("granthistory")
    assert L.children("disaster") == ["granthistory", "disasterpubliclaw"]
    for spec in TABLES.values():
        assert all(list(TABLES).index(p) < list(TABLES).index(spec.name) for p, _ in spec.parents.values())


def test_numbering_keeps_rows_with_null_order(spark):
    df = spark.createDataFrame([("a", 0), (None, 1), ("b", 2), (None, 3)], "doc string, row_no bigint")
    assert rows(N.serial_ids(df, ["doc"], "row_no", "id").select("id", "row_no")) == [(1, 1), (2, 3), (3, 0), (4, 2)]
    placed = N.positions(df.withColumn("page", F.lit(0)), ["doc"], ["page"], "row_no", "place").select("row_no", "place")
    assert rows(placed) == [(0, 0), (1, 0), (2, 0), (3, 1)]
