"""What a load of landed files does once: parsing, recipients, casts, rules, numbering."""

import os

import pytest
from pyspark.sql import functions as F

from grantflow import schemas, session
from grantflow.functions import dates as D
from grantflow.operators import load as L
from grantflow.operators import numbering as N
from grantflow.plans.awards import award_tables
from grantflow.plans.loading import rows_to_load
from grantflow.plans.pipelines import DENSE_FILES, SMALL_TASKS, Pipeline, landed_files, read_landed
from grantflow.schemas import TableSpec
from grantflow.session import with_settings
from grantflow.sources import tables as St
from test_pipelines import PIPE, land


def test_a_landed_line_is_parsed_once(spark, tmp_path):
    land(tmp_path, "in", "a.json", {"n": 1}, "{broken", {"n": "many"}, "null", "[{\"n\": 2}]", "  ", {"m": 3})
    files = landed_files(spark, str(tmp_path / "in"))
    found, broken = read_landed(spark, str(tmp_path / "in"), "n int", files)
    for df in (found, broken):
        assert "from_json" not in df._jdf.queryExecution().toString()
    assert sorted(found.collect(), key=str) == [(1,), (None,)]
    assert sorted(r.text for r in broken.collect()) == sorted(['[{"n": 2}]', "null", "{broken", '{"n": "many"}'])
    assert {r.key for r in broken.collect()} == {r.path for r in files.collect()}


def test_parsed_documents_go_with_their_run(spark, tmp_path):
    root, kept, seen = St.create_store(spark, str(tmp_path / "store")), list(session._settled), []
    settings = SMALL_TASKS | DENSE_FILES
    before = {key: spark.conf.get(key, None) for key in settings}

    def build(new, stored):
        seen.extend(new["awards"].inputFiles())
        assert all(spark.conf.get(key) == value for key, value in settings.items())
        return {"states": new["awards"]}

    land(tmp_path / "in", "awards", "a.json", {"state_code": "TX", "state_name": "Texas"})
    pipe = Pipeline("small", {"awards": PIPE.inputs["awards"]}, (), build)
    assert pipe.run(spark, str(tmp_path / "in"), root, "r1") == {"states": True}
    assert seen and not any(os.path.exists(p.removeprefix("file://")) for p in seen) and session._settled == kept
    assert before == {key: spark.conf.get(key, None) for key in settings}


def test_settings_are_put_back(spark):
    spark.conf.set("spark.sql.sources.fileCompressionFactor", "2.0")
    with pytest.raises(ValueError), with_settings(spark, DENSE_FILES):
        raise ValueError
    assert spark.conf.get("spark.sql.sources.fileCompressionFactor") == "2.0"
    spark.conf.unset("spark.sql.sources.fileCompressionFactor")


def test_recipients_are_made_once_for_all_tables(spark):
    awards = spark.createDataFrame([("G1", "Ann ", "A1"), ("G2", "Bob", "A2")], "`Award ID` string, `Recipient Name` string, generated_internal_id string")
    filled = spark.createDataFrame([], schemas.AWARDS_DDL).unionByName(awards, allowMissingColumns=True)
    empty = [spark.createDataFrame([], ddl) for ddl in (schemas.OTHER_DDL, schemas.FUNDING_DDL, schemas.SUBAWARDS_DDL, schemas.TRANSACTIONS_DDL)]
    built = award_tables(filled, *empty, spark.createDataFrame([], f"{schemas.FUND_CODES_DDL}, row_no bigint"))
    names = built["recipients"].inputFiles()
    assert names and built["federalawards"].inputFiles() == names and built["subawards"].inputFiles() == names
    assert sorted(r.recipient_name for r in built["recipients"].collect()) == ["Ann", "Bob"]


def test_dates_of_fixed_width_read_as_by_their_format(spark):
    days = [f"{y}-{m}-{d}" for y in ("0000", "0001", "1582", "2023", "2024", "9999") for m in ("00", "01", "02", "12", "13") for d in ("00", "01", "28", "29", "30", "31", "32")]
    given = days + [f"{t[5:7]}-{t[8:]}-{t[:4]}" for t in days] + [f"{t[5:7]}/{t[8:]}/{t[:4]}" for t in days]
    given += ["2024-01-31\n", "01-31-2024\n", " 2024-01-31", "2024-01-31 ", "2024-1-31", "2024-01-31T", "", None]
    df = spark.createDataFrame([(t,) for t in given], "t string")
    by_format = F.coalesce(*[F.when(F.col("t").rlike(D.shape_of(f)), F.try_to_date("t", f)) for f in D.DATE_FORMATS])
    assert df.where(by_format.isNotNull()).count() > 100
    assert df.where(~D.lenient_date("t").eqNullSafe(by_format)).count() == 0


def test_numbered_rows_are_not_shuffled_to_meet_their_offsets(spark):
    frame = spark.range(200_000, numPartitions=3).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    with with_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "256k"}):
        numbered = N.loaded_ids(frame, "no")
        plan = numbered._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "hashpartitioning(_part" not in plan
        assert numbered.agg(F.min("no"), F.max("no"), F.count_distinct("no")).first() == (1, 200_000, 200_000)


def test_rules_are_told_only_of_rows_that_break_them(spark):
    spec = TableSpec("odd", "k bigint, name string, day date, n int", ("k",), required=("name",), lengths={"name": 3})
    rows = [("1", "abc", "2024-01-31", 1), ("2", "abcd", "soon", 2), (None, None, None, None), ("x", "ab", "01-31-2024", 4), ("5", "a", None, None)]
    df = spark.createDataFrame(rows, "k string, name string, day string, n int")
    for given in (df, L.cast_once(df, spec)):
        told = given.select("name", L.breaks_rules(given, spec).alias("any"), L.broken_rules(given, spec).alias("rules")).collect()
        assert [r["any"] for r in told] == [False, True, True, True, False] == [bool(r.rules) for r in told]
        assert [[tuple(x) for x in r.rules] for r in told][1:4] == [[("name", "length"), ("day", "type")], [("k", "required"), ("name", "required")], [("k", "type")]]
    assert L.conform(df, spec).collect() == L.conform(L.cast_once(df, spec), spec).collect()


def test_a_first_load_compares_with_nothing(spark):
    spec = TableSpec("numbered", "no bigint, name string", ("no",), serial="no")
    df = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    first = rows_to_load(df, None, spec, after=4)
    assert "LeftAnti" not in first._jdf.queryExecution().toString()
    assert sorted(r.no for r in first.collect()) == [5, 6, 7] and sorted(str(r.name) for r in first.collect()) == ["None", "a", "a"]
    keyed = TableSpec("keyed", "k int, name string", ("k",))
    twice = spark.createDataFrame([("1", "b"), ("1", "a"), (None, "c"), ("x", "d")], "k string, name string")
    assert [tuple(r) for r in rows_to_load(twice, None, keyed).collect()] == [("1", "a")]
