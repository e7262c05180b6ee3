"""Landed folders: which file belongs to which input, broken lines, repeated runs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from grantflow.plans.loading import read_rejects
from grantflow.plans.pipelines import Pipeline, landed_files, read_landed
from grantflow.session import letting_go, settle
from grantflow.sources import tables as St

PIPE = Pipeline(
    "small", {"awards": "state_code string, state_name string", "other": "disaster_id bigint, disaster_name string, disaster_year string"}, (),
    lambda new, stored: {"states": new["awards"], "disaster": new["other"]},
)


def land(folder, name, file, *lines):
    (folder / name).mkdir(parents=True, exist_ok=True)
    (folder / name / file).write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))


def stored(spark, root):
    from grantflow.schemas import TABLES

    return [sorted(r[0] for r in St.read_table(spark, root, TABLES[t]).collect()) for t in ("states", "disaster")]


@pytest.mark.parametrize("home", ["landed", "awards/in", "other"])
def test_files_go_by_the_first_folder_below_the_landed_one(spark, tmp_path, home):
    landed, root = tmp_path / home, St.create_store(spark, str(tmp_path / "store"))
    land(landed, "awards", "a 1.json", {"state_code": "TX", "state_name": "Texas"}, "{broken", "")
    land(landed, "other/awards", "b.json", {"disaster_id": 1, "disaster_name": "storm", "disaster_year": "2017"}, {"disaster_id": "many"})
    assert PIPE.run(spark, str(landed), root, "r1") == {"states": True, "disaster": True}
    assert stored(spark, root) == [["TX"], [1]]
    bad = read_rejects(spark, root).orderBy("source").collect()
    assert [(r.source, r.rule, r.text) for r in bad] == [("small/awards", "format", "{broken"), ("small/other", "format", '{"disaster_id": "many"}')]
    assert bad[0].key.endswith("json") and PIPE.run(spark, str(landed), root, "r2") == {}
    land(landed, "awards", "c.json", {"state_code": "LA", "state_name": "Louisiana"})
    assert PIPE.run(spark, str(landed), root, "r3")["states"]
    assert stored(spark, root) == [["LA", "TX"], [1]]


def test_a_stopped_run_repeats_on_its_own_files(spark, tmp_path, monkeypatch):
    landed, root = tmp_path / "landed", St.create_store(spark, str(tmp_path / "store"))
    land(landed, "awards", "a.json", {"state_code": "TX", "state_name": "Texas"})

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr("grantflow.plans.pipelines.publish", stop)
        with pytest.raises(RuntimeError):
            PIPE.run(spark, str(landed), root, "r1")
    land(landed, "awards", "b.json", {"state_code": "LA", "state_name": "Louisiana"})
    PIPE.run(spark, str(landed), root, "r1")
    assert stored(spark, root)[0] == ["TX"]
    PIPE.run(spark, str(landed), root, "r2")
    assert stored(spark, root)[0] == ["LA", "TX"]
    noted = spark.read.parquet(f"{root}/input_files").select(F.element_at(F.split("path", "/"), -1).alias("f"))
    assert sorted(r.f for r in noted.collect()) == ["a.json", "b.json"]


def test_landed_files_may_be_compressed(spark, tmp_path):
    one = spark.createDataFrame([("a", 1)], "doc_id string, n int")
    for kind in ("none", "gzip", "bzip2"):
        one.coalesce(1).write.json(str(tmp_path / "in" / kind), compression=kind)
    files = landed_files(spark, str(tmp_path / "in"))
    assert sorted(r.path.split(".json")[1] for r in files.collect()) == ["", ".bz2", ".gz"]
    found, broken = read_landed(spark, str(tmp_path / "in"), "doc_id string, n int", files)
    assert [tuple(r) for r in found.collect()] == [("a", 1)] * 3 and broken.count() == 0


def test_what_a_table_needed_is_let_go(spark):
    kept = settle(spark.range(3))
    with letting_go(spark):
        inside = settle(spark.range(4))
        paths = [df.inputFiles()[0].removeprefix("file://") for df in (kept, inside)]
    assert [os.path.exists(p) for p in paths] == [True, False] and kept.count() == 3
