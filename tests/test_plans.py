"""Physical plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

from checks.catalog import QUERIES
from grantflow.operators import joins as J
from grantflow.operators import ordered as O
from grantflow.operators import rows as R

SMALL = "/root/testdata/sf0.001"

EAGER = ("LD5", "LD6", "LD7", "LD8", "ST1", "TB11", "TB12", "TB13", "TB14", "TB15", "TB19")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    modes = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return df._jdf.queryExecution().explainString(modes.fromString("formatted"))


@pytest.fixture
def no_broadcast(spark):
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name in names:
        spark.conf.unset(name)


@pytest.fixture
def small_skew(no_broadcast):
    values = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in values.items():
        no_broadcast.conf.set(name, value)
    yield no_broadcast
    for name in values:
        no_broadcast.conf.unset(name)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(EAGER)])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_filters_and_columns_reach_the_scan(spark):
    df = QUERIES["FL2_award_search"](spark, SMALL)
    text = formatted(df)
    pushed = next(line for line in text.splitlines() if line.startswith("PushedFilters"))
    for part in ("In(o_orderpriority", "GreaterThanOrEqual(o_orderdate", "LessThanOrEqual(o_orderdate", "EqualTo(o_orderstatus"):
        assert part in pushed
    assert "o_totalprice" not in text.split("ReadSchema")[1]


def test_first_per_key_filters_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("o"))
    text = plan(R.first_per_key(frame, ["k"], ["o"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_carry_down_shuffles_the_rows_once(no_broadcast):
    frame = no_broadcast.range(1000).selectExpr("id % 3 as doc", "id as line", "if(id % 7 = 0, id, null) as h")
    text = formatted(O.carry_down(frame, ["doc"], "line", F.col("h"), "section", 64))
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: (.*)", text)
    assert len(exchanges) >= 3
    # the other exchanges move block summaries, which have no row number
    assert sum("line#" in columns for columns in exchanges) == 1
    assert "SinglePartition" not in text


@pytest.mark.parametrize("how", ["enrich", "new_rows", "keep_absent", "lookup", "full"])
def test_hot_left_key_is_split(small_skew, how):
    """A key with most of the rows does not end in one task."""
    left = small_skew.range(0, 60_000, 1, 8).selectExpr(
        "if(id % 10 < 9, 1L, id) as k", "if(id % 10 < 9, 'same', cast(id as string)) as v"
    )
    right = small_skew.range(0, 20_000, 1, 4).selectExpr("id as k", "cast(id as string) as v", "id as o")
    if how == "enrich":
        df = J.enrich(left, right.groupBy("k").agg(F.max("o").alias("o")), ["k"], ["o"])
    elif how == "new_rows":
        df = J.new_rows(left, right)
    elif how == "keep_absent":
        df = J.keep_absent(left, right.where("k > 1"), ["k"])
    elif how == "full":
        df = J.full_join(left, right.select("k", "o"), ["k"])
    else:
        df = J.lookup(left, "k", right, "k", "o", "o", "found")
    df.collect()
    assert "skew=true" in plan(df)


def test_full_join_keeps_null_keys_apart(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (3, "d")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (None, "y"), (4, "z")], "k int, r string")
    ours, theirs = J.full_join(left, right, ["k"]), left.join(right, ["k"], "full")
    assert ours.columns == theirs.columns and ours.schema == theirs.schema
    assert sorted(map(str, ours.collect())) == sorted(map(str, theirs.collect()))


@pytest.mark.parametrize(("number", "size"), [(1, 10), (40, 25), (120, 25), (121, 25)])
def test_a_page_is_found_without_sorting_what_is_before(spark, number, size):
    rows = [(None if k % 7 == 0 else 1 if k % 3 else k % 50, k) for k in range(3000)]
    frame = spark.createDataFrame(rows, "a int, b int").repartition(4)
    df = R.page(frame, ["a desc", "b"], number, size, few=60)
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))[(number - 1) * size : number * size]
    assert [tuple(r) for r in df.collect()] == want
    limits = [int(n) for n in re.findall(r"limit=(\d+)", plan(df))]
    assert all(n <= 60 + size for n in limits)
