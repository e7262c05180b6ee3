"""The store: which folders a load opens, and what a stop at any step leaves behind."""

import re

import pytest
from pyspark.sql import functions as F

from grantflow.plans import loading
from grantflow.plans.loading import load_tables, read_rejects
from grantflow.schemas import TableSpec
from grantflow.session import scratch_dir
from grantflow.sources import tables as St
from grantflow.streaming.drops import load_drops, read_drops

SPEC = TableSpec("e", "k bigint, v string", ("k",), buckets=16)


class Stopped(Exception):
    pass


def frame(spark, keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k bigint, v string")


def keys(spark, root, spec=SPEC):
    return sorted(r.k for r in St.read_table(spark, root, spec).collect())


def opened(df) -> str:
    """Partition filters of the scans of a plan."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return " ".join(re.findall(r"PartitionFilters: (.*)", text))


def stop_after(monkeypatch, target, name, number):
    """Let ``name`` run ``number`` times, then stop before it returns (a fault of the caller's host)."""
    real, calls = getattr(target, name), []

    def run(*args, **kwargs):
        found = real(*args, **kwargs)
        calls.append(1)
        if len(calls) == number:
            raise Stopped
        return found

    monkeypatch.setattr(target, name, run)


def test_a_small_load_opens_its_buckets_only(spark, tmp_path, monkeypatch):
    root = St.create_store(spark, str(tmp_path / "t"))
    St.publish(frame(spark, range(1000)), root, SPEC, "r1")
    asked = []
    real = St.read_table

    def watched(*args, **kwargs):
        found = real(*args, **kwargs)
        asked.append((kwargs.get("buckets"), opened(found)))
        return found

    for module in (St, loading):
        monkeypatch.setattr(module, "read_table", watched)
    monkeypatch.setattr("grantflow.streaming.drops.read_table", watched)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("k,v\n5,other\n2000,new\n2001,new\n")
    load_drops(read_drops(spark, str(tmp_path / "in"), SPEC.schema), root, SPEC, str(tmp_path / "c"))
    assert len(keys(spark, root)) == 1002
    bounded = [(b, text) for b, text in asked if b is not None]
    assert len(bounded) == 2  # for new keys, and for the check of the keys
    assert all(1 <= len(b) <= 3 and "_bucket" in text for b, text in bounded if text)


def test_a_run_lies_in_its_buckets(spark, tmp_path):
    root = St.create_store(spark, str(tmp_path / "t"))
    St.publish(frame(spark, range(200)), root, SPEC, "r1")
    stored = spark.read.parquet(f"{root}/e")
    wrong = stored.where(St.bucket_of(SPEC) != F.col("_bucket")).count()
    assert wrong == 0 and stored.select("_bucket").distinct().count() == 16
    some = St.read_table(spark, root, SPEC, buckets=[3, 4])
    assert {r.b for r in some.select(St.bucket_of(SPEC).alias("b")).distinct().collect()} == {3, 4}


@pytest.mark.parametrize("buckets", [1, 8, 70])
def test_masks_tell_the_buckets(spark, buckets):
    spec = TableSpec("e", "k bigint", ("k",), buckets=buckets)
    rows = spark.range(25).select(F.col("id").alias("k"))
    seen = rows.agg(*St.bucket_masks(spec, St.bucket_of(spec))).first().asDict()
    want = sorted({r.b for r in rows.select(St.bucket_of(spec).alias("b")).collect()})
    assert St.marked_buckets(spec, seen) == want
    none = rows.limit(0).agg(*St.bucket_masks(spec, St.bucket_of(spec))).first().asDict()
    assert St.marked_buckets(spec, none) == []


def test_runs_outside_the_span_are_not_opened(spark, tmp_path):
    root = St.create_store(spark, str(tmp_path / "t"))
    St.publish(frame(spark, range(10)), root, SPEC, "r1")
    St.publish(frame(spark, range(100, 110)), root, SPEC, "r2")
    known = St.Ledger(spark, root, "e")
    assert known.largest_key("e") == 109
    assert known.visible_runs("e", (20, 105)) == ["r2"] and known.visible_runs("e", (20, 30)) == []
    with pytest.raises(St.LoadRejected):
        St.publish(frame(spark, [105]), root, SPEC, "r3")


def test_a_stopped_compaction_loses_nothing(spark, tmp_path, monkeypatch):
    root = St.create_store(spark, str(tmp_path / "t"))
    St.publish(frame(spark, [1]), root, SPEC, "r1")
    St.publish(frame(spark, [2]), root, SPEC, "r2")
    for target, name in ((St, "_write_run"), (St.Ledger, "add")):
        with monkeypatch.context() as patch:
            stop_after(patch, target, name, 1)
            with pytest.raises(Stopped):
                St.compact(spark, root, SPEC, f"c-{name}")
        assert keys(spark, root) == [1, 2]
        St.compact(spark, root, SPEC, f"c-{name}")
        assert keys(spark, root) == [1, 2]
    assert St.Ledger(spark, root, "e").visible_runs("e") == ["c-add"]


def test_truncation_is_one_step(spark, tmp_path):
    root = St.create_store(spark, str(tmp_path / "t"))
    before = len(list((tmp_path / "t" / "ledger").glob("part-*")))
    names = St.truncate(spark, root, "states", "t1")
    assert len(names) > 1
    assert len(list((tmp_path / "t" / "ledger").glob("part-*"))) == before + 1
    assert {n.table_name for n in St.Ledger(spark, root).notes} == set(names)


@pytest.mark.parametrize(("name", "number"), [("write_rejects", 1), ("publish", 1), ("publish", 2)])
def test_a_stopped_load_repeats_with_rows_and_rejects(spark, monkeypatch, name, number):
    root = St.create_store(spark, scratch_dir(spark, "stop"))
    states = spark.createDataFrame([("TX", "Texas"), (None, "nowhere")], "state_code string, state_name string")
    disasters = spark.createDataFrame([(1, "storm", "2017")], "disaster_id bigint, disaster_name string, disaster_year string")
    frames = {"states": states, "disaster": disasters}
    with monkeypatch.context() as patch:
        stop_after(patch, loading, name, number)
        with pytest.raises(Stopped):
            load_tables(frames, root, "r1")
    load_tables(frames, root, "r1")
    known = St.Ledger(spark, root)
    assert known.visible_runs("states") == ["r1"] and known.visible_runs("disaster") == ["r1"]
    assert [(r.table_name, r.rule) for r in read_rejects(spark, root).collect()] == [("states", "key")]
