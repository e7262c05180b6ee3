"""Quality, mixing, search and fixity against plain versions."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantflow.llm import boosting, exact_search, fixity, mixing, quality, vectors
from grantflow.llm.ball_tree import BallTree

SF = "/root/testdata/sf0.01"

# ---- quality -----------------------------------------------------------------------


def test_trees_learn_and_flat_arrays_agree_with_a_walk():
    chance = np.random.default_rng(0)
    x = chance.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    forest = boosting.fit(x[:2000], y[:2000])
    assert ((forest.scores(x[2000:]) > 0.5) == y[2000:]).mean() > 0.9

    def walk(row):
        total = forest.base
        for node in forest.roots:
            while forest.left[node] != node:
                node = (forest.left if row[forest.feature[node]] <= forest.threshold[node] else forest.right)[node]
            total += forest.value[node]
        return total

    assert np.allclose([walk(r) for r in x[:50]], forest.margins(x[:50]))
    for some in (x[:0], x[:5]):
        assert len(boosting.fit(some, np.ones(len(some))).scores(x)) == 3000


def test_held_out_accuracy(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.score(documents, quality.train(documents, labels), keep=["doc_id"])
    rows = {r.doc_id: r for r in scored.collect()}
    assert len(rows) == documents.count()
    for r in rows.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    known = [(rows[r.doc_id], r.quality) for r in labels.collect() if r.doc_id in rows]
    held = [(r.predicted, q) for r, q in known if r.held_out]
    assert len(held) > 50 and np.mean([p == q for p, q in held]) > 0.93
    again = quality.score(documents, quality.train(documents.repartition(7), labels.repartition(3)), keep=["doc_id"])
    assert {r.doc_id: r.score for r in again.collect()} == {i: r.score for i, r in rows.items()}


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "", 5), (2, None, 5), (None, "some words here", 5), (3, "w " * 100_000, 5), (3, "again", 5)], "doc_id long, text string, score int"
    )
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (3, 1), (None, 0)], "doc_id long, quality int")
    for known in (labels, labels.limit(0)):
        rows = quality.score(docs, quality.train(docs, known)).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert {r.held_out for r in rows if r.doc_id is None} == {True}
        assert len({r.score for r in rows if not r.text}) == 1
    assert quality.score(docs.limit(0), quality.train(docs.limit(0), labels)).count() == 0


# ---- mixing -------------------------------------------------------------------------


def shares(sizes):
    """Targets of sources in order, by filling up again and again."""
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    target, left, free = {}, sum(sizes.values()), set(sizes)
    while free:
        unit = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * unit > 3 * sizes[s]}
        for s in over or free:
            target[s] = 3.0 * sizes[s] if over else weight[s] * unit
        left -= sum(3 * sizes[s] for s in over)
        free = free - over if over else set()
    return target


def mixed_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size string").repartition(6)
    return df, [r.asDict() for r in mixing.mix(df).collect()]


def test_mix(spark):
    chance = random.Random(2)
    rows = []
    for i in range(4000):
        source = chance.choice(["big"] * 8 + ["a", "b", "Z", "é", "", None, "😀", "￿"])
        n = min(3000, int(chance.paretovariate(1.1) * 10))
        rows.append((i, " \t".join(["w"] * n), source, "x"))
    rows += [(4001, None, "a", "x"), (4002, "", "none", "x"), (4003, " x\x1c y\n\r z", "b", "x"), (None, "one two", None, "x"), (5, "twice over", "a", "x"), (5, "twice over", "a", "x")]
    df, got = mixed_rows(spark, rows)
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").encode().split())
    target = shares(dict(sizes))
    taken, longest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        if r["source_size"]:
            assert int(r["target"] / r["source_size"]) <= r["copies"] <= -(-r["target"] // r["source_size"])
        taken[r["source"]] += r["taken"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s]
    assert abs(sum(taken.values()) / sum(sizes.values()) - 1) < 0.05
    again = mixing.mix(df.repartition(3)).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["copies"])
    assert [r["copies"] for r in sorted(again, key=key)] == [r["copies"] for r in sorted(got, key=key)]


def test_pairs_keep_words_and_chances():
    chance = random.Random(1)
    for p, s, q, t in [(0.3, 100, 0.4, 7), (0.9, 5, 0.8, 5), (0.5, 1, 0.5, 10_000), (0.2, 30, 0.7, 20)]:
        ends = [mixing.settle_pair(p, s, q, t, chance.random()) for _ in range(20_000)]
        assert all(abs(a * s + b * t - p * s - q * t) < 1e-6 * (s + t) for a, b in ends)
        assert all({a, b} & {0.0, 1.0} and 0 <= a <= 1 and 0 <= b <= 1 for a, b in ends)
        assert abs(np.mean([a for a, _ in ends]) - p) < 0.015 and abs(np.mean([b for _, b in ends]) - q) < 0.015


def test_mix_of_nothing(spark):
    df, got = mixed_rows(spark, [(1, "", "a", "x"), (2, None, None, "x")])
    assert [r["taken"] for r in got] == [0, 0]
    assert mixing.mix(df.limit(0)).count() == 0


# ---- search -------------------------------------------------------------------------


def plain_top(rows, k=5):
    sound = [
        (i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v)
    ]
    scored = {q: [] for q, _ in sound if q % 50 == 0}
    for q, v in sound:
        if q in scored:
            scored[q] += [(-sum(a * b for a, b in zip(v, w)), c) for c, w in sound if c != q and len(w) == len(v)]
    return sorted((q, n, c, -s) for q, found in scored.items() for n, (s, c) in enumerate(sorted(found)[:k], 1))


def test_repeated_ids_and_large_components(spark):
    rows = [(0, [1.0, 0.0]), (1, [3.0, 0.0]), (1, [9.0, 0.0]), (2, [float(1 << 22), 1.0]), (2, [-1.0, 0.0]), (100, [2.0, 0.0]), (100, [1.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, exact_search.top_inner_products(df, F.col("vec_id") % 50 == 0).collect())) == plain_top(rows)
    rows += [(4, [2.0**32, -(2.0**32)])]
    df = spark.createDataFrame(rows, df.schema)
    assert sorted(map(tuple, exact_search.top_inner_products(df, F.col("vec_id") % 50 == 0).collect())) == plain_top(rows)
    for far in (2.0**53, -1e300):
        with pytest.raises(Exception, match="too large|out of range"):
            exact_search.top_inner_products(df.union(spark.createDataFrame([(3, [far, far])], df.schema)), F.col("vec_id") % 50 == 0).collect()


def test_search(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "SHARD_ROWS", 300)
    monkeypatch.setattr(exact_search, "BLOCK_ROWS", 7)
    chance = np.random.default_rng(3)
    rows = [(i, chance.normal(size=8).astype(np.float32).tolist()) for i in range(-100, 1500)]
    rows += [(i, rows[4][1]) for i in range(1500, 2100)]  # one very common vector
    rows += [(2150, None), (2200, []), (2250, [None] * 8), (2300, [float("nan")] * 8), (2350, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    rows += [(2400, [0.5, 0.25]), (2401, [1.0, 1.0]), (2450, [0.0] * 8), (50, [9.0] * 8), (50, rows[150][1]), (2500, [-3000.0] * 8)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int").repartition(5)
    got = exact_search.top_inner_products(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == plain_top(rows)
    assert exact_search.top_inner_products(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert exact_search.top_inner_products(df.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


def test_blocks_are_not_copied_for_each_shard(spark, monkeypatch):
    """No plan multiplies the blocks before they meet the shards, in a shuffle or the driver."""
    monkeypatch.setattr(exact_search, "SHARD_ROWS", 20)
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(200)] + [(i, [float(i % 3)]) for i in range(200, 260)]
    got = exact_search.top_inner_products(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 50 == 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert sorted(map(tuple, got.collect())) == plain_top(rows)


def test_every_pair_is_of_one_length(spark):
    one = spark.createDataFrame([(2, "a"), (2, "b"), (3, "c")], "dim int, left string")
    two = spark.createDataFrame([(2, "x"), (3, "y"), (4, "z")], "dim int, right string")
    assert sorted(map(tuple, vectors.every_pair(one, two).collect())) == [(2, "a", "x"), (2, "b", "x"), (3, "c", "y")]
    assert [tuple(r) for r in vectors.every_pair(one, two, F.col("left") > "a", F.col("right") < "y").collect()] == [(2, "b", "x")]


def test_tree_prunes():
    chance = np.random.default_rng(5)
    points = (chance.normal(size=(60, 1, 8)) * 300 + chance.normal(size=(60, 200, 8)) * 3).reshape(-1, 8).astype(np.int64)
    tree = BallTree.build(np.arange(len(points)), points)
    scores, ids = tree.search(np.array([-1, -2]), points[[0, 700]], 5, np.full(2, -np.inf))
    want = np.sort(points[[0, 700]] @ points.T, 1)[:, ::-1][:, :5]
    assert (scores == want).all() and (points[[0, 700]] @ points.T)[0, ids[0]].tolist() == want[0].tolist()
    with pytest.raises(ValueError):
        tree.search(np.array([1]), np.full((1, 8), 1 << 60), 5, np.full(1, -np.inf))


# ---- fixity --------------------------------------------------------------------------


def test_fixity_finds_every_difference(spark):
    rows = [(i, f"http://x/{i}", "<p>" + "é" * (i % 700), 0) for i in range(3000)]
    rows += [(None, None, None, 0), (None, "u", "<p>", 0), (9000, "u", "", 0), (9001, None, "y" * 300_000, 0), (9002, "u", "last", 0)]
    schema = "page_id long, url string, html string, offset int"
    one = fixity.archive(spark.createDataFrame(rows, schema).repartition(4))
    assert fixity.audit(one, one).count() == 0
    bad = [(i, u, "#" + h[1:] if i in (5, 700, 9001) else h, z) for i, u, h, z in rows if i not in (1023, 9002)]
    two = fixity.archive(spark.createDataFrame(bad, schema).repartition(3))
    found = fixity.audit(one, two).collect()
    assert {(r.key, r.finding) for r in found} == {(5, "changed"), (700, "changed"), (9001, "changed"), (1023, "lost"), (9002, "lost")}
    places = {r.key: (r.file, r.offset, r.length) for r in one.where("key is not null").collect()}
    assert all(places[r.key] == (r.file, r.offset, r.length) for r in found)
    back = {(r.key, r.finding) for r in fixity.audit(two, one).collect()}
    assert back == {(5, "changed"), (700, "changed"), (9001, "changed"), (1023, "alien"), (9002, "alien")}
    assert fixity.audit(one.limit(0), one.limit(0)).count() == 0
    assert fixity.audit(one, two.limit(0)).count() == len(rows)


def test_fixity_of_a_shifted_file(spark):
    rows = [(i, "u", "t" * 100) for i in range(200)]
    one, two = (
        fixity.archive(spark.createDataFrame([r for r in rows if r[0] != gone], "page_id long, url string, html string")) for gone in (-1, 100)
    )
    found = Counter(r.finding for r in fixity.audit(one, two).collect())
    assert found["lost"] == 100 and found["alien"] == 99
