"""Every query beside its SQL at the smallest scale."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from checks.catalog import ORACLES, QUERIES
from compare import TABLES, rows_of

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, db, name):
    df = QUERIES[name](spark, SMALL)
    found = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    expected = rows_of(names, result.fetchall())
    assert Counter(found) == Counter(expected)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and df.columns[0] == "grant_id"


def test_every_operator_has_a_query():
    listed = {"SR": 17, "PR": 18, "FL": 7, "JN": 10, "AG": 7, "OR": 10, "SE": 4, "TX": 11, "LD": 10, "TB": 19, "ST": 1}
    have = {name.split("_")[0] for name in QUERIES}
    assert [f"{k}{i}" for k, n in listed.items() for i in range(1, n + 1) if f"{k}{i}" not in have] == []
