"""Periodic runs, hard negatives and toxicity against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from grantflow.llm import anchor_tree, hard_negatives, periodic_runs, text_convolution, toxicity, vectors
from grantflow.llm.lyndon import lyndon_array, runs
from grantflow.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"

# ---- periodic runs -------------------------------------------------------------------


def plain_lyndon(w):
    own = lambda u: all(u < u[k:] for k in range(1, len(u)))
    return [max(j - i for j in range(i + 1, len(w) + 1) if own(w[i:j])) for i in range(len(w))]


def plain_runs(w, times=4, least=6):
    found, n = [], len(w)
    for p in range(1, n // times + 2):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            a, b = i, j + p
            smaller = any(all(w[k] == w[k + q] for k in range(a, b - q)) for q in range(1, p)) if b - a >= max(times * p, least) else True
            if not smaller:
                found.append((a, b, p))
            i = max(j, i + 1)
    return sorted(found)


def test_lyndon_arrays():
    chance = random.Random(1)
    for _ in range(400):
        w = [chance.randint(0, chance.choice([1, 2, 4])) for _ in range(chance.randint(0, 14))]
        assert lyndon_array(w) == plain_lyndon(w)


@pytest.mark.parametrize(("times", "least"), [(2, 2), (3, 3), (4, 6)])
def test_runs_against_all_periods(times, least):
    chance = random.Random(times)
    for _ in range(300):
        n, k = chance.randint(0, 60), chance.choice([1, 2, 4])
        w = [chance.randint(0, k) for _ in range(n)]
        if n and chance.random() < 0.5:
            a = chance.randrange(n)
            p = chance.randint(1, 1 + (n - a) // 4)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        want = plain_runs(w, times, least)
        assert [tuple(r) for r in runs(np.array(w, np.int64), [(0, n)], times, least).tolist()] == want
        text = " ".join("abcdef"[x] for x in w)
        for starts, lengths, periods, _ in periodic_runs.runs_of_texts(["x y", text, "", text], times, least)[1::2]:
            assert [(a, a + n, p) for a, n, p in zip(starts, lengths, periods, strict=True)] == want


def test_colliding_hashes_change_nothing(monkeypatch):
    monkeypatch.setattr("grantflow.llm.lyndon.mixed", lambda x: np.zeros(len(x), np.uint64))
    w = np.array([0, 1] * 8 + [2] + [3] * 9 + [0, 1, 2] * 5)
    assert [tuple(r) for r in runs(w, [(0, len(w))], 4, 6).tolist()] == plain_runs(w.tolist())


def test_long_texts_take_linear_time():
    one = "a " * 300_000
    assert periodic_runs.runs_of_texts([one])[0] == ([0], [300_000], [1], "a")
    assert periodic_runs.runs_of_texts(["b c " * 100_000])[0][:3] == ([0], [200_000], [2])


def test_periodic_columns(spark):
    rows = [(1, "x\ty\x0bx y x y x y z", 7), (2, None, 7), (3, "", 7), (3, "", 7), (None, "a b " * 6, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, runs int").withColumn("_own_0", F.lit("kept"))
    found = periodic_runs.periodic_runs(df).orderBy("doc_id").collect()
    assert [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed, r._own_0) for r in found] == [
        (None, [(0, 6, 1)], "a b", "kept"), (1, [(0, 8, 2)], "x y z", "kept"), (2, [], "", "kept"), (3, [], "", "kept"), (3, [], "", "kept"),
    ]
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_op12(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got, held = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}, 0
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    for d in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", d.text or "")
        n, h = len(w), zlib.crc32(str(d.doc_id).encode())
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        found = plain_runs(w)
        gone = {i for a, b, p in found for i in range(a + p, b)}
        best = min(found, key=lambda r: (-Fraction(r[1] - r[0], r[2]), r[0], r[2]), default=None)
        told = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
        lines = "".join(f"{a},{b - a},{p}\n" for a, b, p in found)
        assert got[d.doc_id] == (d.doc_id, len(found), *told, sha(lines), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
        held += len(found)
    assert len(got) == len(docs) and held > 0


# ---- hard negatives ------------------------------------------------------------------


def test_spanning_tree_is_least():
    chance = np.random.default_rng(1)
    points = chance.integers(-50, 50, (40, 5))
    order, parent, edge = anchor_tree.spanning_tree(points)
    assert sorted(order.tolist()) == list(range(40)) and (parent == -1).sum() == 1
    place = np.argsort(order)
    assert all(parent[a] < 0 or place[parent[a]] < place[a] for a in range(40))
    apart = np.sqrt(((points[:, None] - points) ** 2).sum(2))
    joined, total = {0}, 0.0
    while len(joined) < 40:
        cost, new = min((apart[a, b], b) for a in joined for b in range(40) if b not in joined)
        joined.add(new)
        total += cost
    assert abs(edge.sum() - total) < 1e-6


def test_bounds_hold_and_spare_work():
    chance = np.random.default_rng(2)
    anchors = (chance.normal(size=(1, 8)) * 300 + chance.normal(size=(30, 8)) * 4).astype(np.int64)
    points = (chance.normal(size=(500, 8)) * 100).astype(np.int64)
    scores, exact = anchor_tree.Scores(anchors, anchor_tree.spanning_tree(anchors), points), anchors @ points.T

    def wanted(a, low, high):
        assert (low <= exact[a]).all() and (exact[a] <= high).all()
        return high >= np.sort(exact[a])[-5]

    for a, which, found in scores.walk(wanted):
        assert (found == exact[a, which]).all() and set(np.argsort(exact[a])[-5:]) <= set(which)
    assert scores.scored < 30 * 500 / 3


@pytest.mark.parametrize("size", [1, 1 << 20, 1 << 29, 1 << 31])
def test_products_are_exact(size):
    a, b = np.array([[size - 1, -size], [3, 5]]), np.array([[-size, size - 1], [1, 1]])
    want = [[sum(int(x) * int(y) for x, y in zip(r, c, strict=True)) for c in b] for r in a]
    if max(abs(x) for r in want for x in r) < 1 << 63:
        assert vectors.products(a, b).tolist() == want
    else:
        with pytest.raises(OverflowError):
            vectors.products(a, b)


def plain_negatives(rows, every, k=5, n=10):
    kept = [
        (i, label, [int(np.floor(256 * float(x))) for x in v]) for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, label, v in kept:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in kept if j != i and len(w) == len(v)]
        for minus, j, _ in sorted(x for x in scored if x[2] == label)[:k]:
            fit = sorted(x for x in scored if x[2] != label and 30 * -minus <= 100 * -x[0] <= 90 * -minus)
            out += [(i, j, rank, x[1], -minus, -x[0]) for rank, x in enumerate(fit[:n], 1)]
    return sorted(out)


def test_hard_negatives(spark, monkeypatch):
    chance = np.random.default_rng(4)
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 150)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 7)
    rows = [(i, int(chance.integers(0, 4)), chance.normal(size=6).round(2).tolist()) for i in range(-60, 500)]
    rows += [(i, 1, rows[3][2]) for i in range(500, 700)]  # one very common row
    rows += [(20, 2, rows[5][2]), (20, 2, rows[5][2]), (40, 1, rows[9][2])]  # repeated ids, anchors too
    rows += [(800, None, [1.0] * 6), (820, 1, None), (840, 1, [float("nan")] * 6), (860, 1, [None] * 6), (None, 1, [1.0] * 6)]
    rows += [(880, 3, [0.5, 0.25]), (881, 3, [0.5, 0.25]), (882, 1, [0.25, 0.125]), (900, 2, []), (901, 2, []), (902, 1, []), (920, 9, [1.0] * 6)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, label int, embedding array<double>, row int, score int").repartition(4)
    got = hard_negatives.mine(df, F.col("vec_id") % 20 == 0)
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 20)
    assert hard_negatives.mine(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert hard_negatives.mine(df, F.lit(False)).count() == 0


def test_anchors_are_not_copied_for_each_shard(spark, monkeypatch):
    """No plan multiplies the blocks of anchors before they meet the shards."""
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 20)
    rows = [(i, i % 3, [float(i % 7), float(i % 5)]) for i in range(200)]
    got = hard_negatives.mine(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), F.col("vec_id") % 20 == 0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows, 20)


def test_components_out_of_range_are_told(spark):
    df = spark.createDataFrame([(0, 1, [1e300]), (1, 1, [1.0])], "vec_id long, label int, embedding array<double>")
    with pytest.raises(Exception, match="out of range"):
        hard_negatives.mine(df, F.col("vec_id") == 0).collect()


# ---- toxicity ------------------------------------------------------------------------


def made_texts(chance, many):
    words = ["".join(chance.choice("aeioutrns") for _ in range(5)) for _ in range(300)]
    texts, labels = [], []
    for k in range(many):
        own = [chance.choice(words) for _ in range(chance.randint(1, 80))]
        labels.append(float(k % 4 == 0))
        if labels[-1]:
            own.insert(chance.randrange(len(own)), chance.choice(["grumble!", "Grumbled", "snort", "SNORT."]))
        texts.append(" ".join(own))
    return texts, np.array(labels)


@pytest.fixture(scope="module")
def fitted():
    texts, labels = made_texts(random.Random(3), 1100)
    return text_convolution.fit([np.array(w) for w in text_convolution.hashed_words(texts[:800])], labels[:800]), (texts[800:], labels[800:])


def test_convolution_learns(fitted):
    model, (texts, labels) = fitted
    assert ((model.scores(text_convolution.hashed_words(texts)) >= 0.5) == labels).mean() > 0.97


def test_features_are_the_largest_windows(fitted, monkeypatch):
    """Against a plain loop; pieces of any size, and a text cut by several, give the same."""
    model, (texts, _) = fitted
    texts = ["", *texts[:20], "one", " ".join(texts[20:40])]
    places = [model.places(np.array(w, np.int64)) for w in text_convolution.hashed_words(texts)]
    for piece in (1 << 13, 7):
        monkeypatch.setattr(text_convolution, "PIECE", piece)
        made = model.features(*text_convolution.laid_out(places), len(texts))
        for k, rows in enumerate(places):
            x = np.concatenate([model.table[rows].sum(1), np.zeros((3, text_convolution.DEPTH))]) if len(rows) else np.zeros((4, text_convolution.DEPTH))
            for f, filters in enumerate(model.filters):
                said = [sum(x[i + o] @ filters[o] for o in range(len(filters))) for i in range(max(1, len(rows)))]
                cols = slice(f * text_convolution.FILTERS, (f + 1) * text_convolution.FILTERS)
                assert np.allclose(made[k, cols], np.maximum(np.max(said, 0) + model.shift[cols], 0), atol=1e-4)


def test_thresholds():
    scores, labels = np.array([0.9, 0.8, 0.3, 0.2, 0.1]), np.array([1, 1, 1, 0, 0.0])
    assert 0.2 < toxicity.best_threshold(scores, labels) < 0.3
    assert toxicity.best_threshold(scores, labels * 0) == 0.5 and toxicity.best_threshold(scores[:0], labels[:0]) == 0.5


def test_toxicity_of_tables(spark):
    texts, labels = made_texts(random.Random(6), 500)
    rows = [(i, t, "ab" if i % 2 else "cd", "s", 9.0) for i, t in enumerate(texts)]
    rows += [(500, None, None, None, 9.0), (501, "", "ab", "s", 9.0), (None, "snort", "xx", "s", 9.0), (3, texts[3], "ab", "s", 9.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score double")
    given = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)] + [(None, 1), (3, 1 - int(labels[3]))], "doc_id long, toxic int")
    made = toxicity.train(docs, given)
    assert set(made.by_language) == {"ab", "cd"}
    found = toxicity.score(docs, made).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r for r in found}
    held = [(by_id[i], y) for i, y in enumerate(labels) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(r.held_out for r, _ in held) and np.mean([r.toxic == y for r, y in held]) > 0.85
    assert by_id[500].score == by_id[501].score and by_id[None].held_out
    # labels, language and source are no inputs of a score
    other = toxicity.score(docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("q")), made).collect()
    assert {(r.doc_id, r.score) for r in other} == {(r.doc_id, r.score) for r in found}
    none = toxicity.train(docs, given.limit(0))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    assert toxicity.score(docs.limit(0), made).count() == 0


def test_op11(spark):
    found = QUERIES["op11_toxicity"](spark, SMALL).collect()
    assert len(found) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert all(r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)


def test_all_labelled_rows_count(spark, monkeypatch):
    """More documents than one task holds, long ones among them: every one is learned from, and
    the thresholds are those of all rows that are kept aside."""
    texts, labels = made_texts(random.Random(9), 900)
    texts = [f"{t} {'pad ' * 11_000 if i == 4 else ''}" for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "ab" if i % 3 else "cd") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    given = spark.createDataFrame([(i, int(y)) for i, y in enumerate(labels)], "doc_id long, toxic int")
    folds = np.array([zlib.crc32(str(i).encode()) % 5 for i in range(len(texts))])
    used = spark.sparkContext.accumulator(0)
    told = toxicity.learn

    def learn(made, words, *more):
        used.add(len(words))
        return told(made, words, *more)

    monkeypatch.setattr(toxicity, "learn", learn)
    for part in (100, 10_000):
        used.value = 0
        made = toxicity.train(docs, given, part_rows=part)
        assert used.value == (folds > 1).sum()
        hashed = text_convolution.hashed_words(texts)
        scores = np.array([made.model.scores([w])[0] for w in hashed])
        aside, ab = folds == 1, np.arange(len(texts)) % 3 > 0
        assert made.threshold == pytest.approx(toxicity.best_threshold(scores[aside], labels[aside]))
        assert made.by_language["ab"] == pytest.approx(toxicity.best_threshold(scores[aside & ab], labels[aside & ab]))
        assert ((scores >= 0.5) == labels)[folds == 0].mean() > 0.9
        again = toxicity.train(docs.repartition(5), given.repartition(3), part_rows=part)
        assert np.array_equal(again.model.table, made.model.table) and again.threshold == made.threshold


@pytest.mark.parametrize("slots", [1 << 25, 64])
def test_labels_of_documents(spark, monkeypatch, slots):
    """Ids that share a slot, repeat, have no label or one other than 0 and 1 get what a plain join gives."""
    monkeypatch.setattr(toxicity, "SLOTS", slots)
    ids = [*range(150), None, 3, 3, 8, -5]
    docs = spark.createDataFrame([(i, f"text {k}" if k % 9 else None, "ab") for k, i in enumerate(ids)], "_id long, _text string, _lang string")
    agreed = {i: 2 if i % 35 == 0 else i % 2 for i in range(0, 300) if i % 5 < 4}
    found = toxicity.labelled(docs, spark.createDataFrame(list(agreed.items()), "_id long, _label int")).collect()
    want = [(i, agreed[i], text_convolution.hashed_words([f"text {k}" if k % 9 else ""])[0]) for k, i in enumerate(ids) if i in agreed]
    assert sorted((r._id, r._label, list(r.words)) for r in found) == sorted(want)


def test_labelled_words_cross_no_join(spark, monkeypatch):
    """Also where the labels are too many to be broadcast, ids meet them, words do not."""
    chance, disk = random.Random(4), spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        every = [files.apply(i) for i in range(files.size())]
        return {f.getName(): f.length() for f in every if f.getName().startswith("shuffle_")}

    class Written(Exception):
        pass

    def written(spark):
        raise Written

    texts = [" ".join(f"w{chance.randrange(10**6)}" for _ in range(300)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    given = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "free_shuffles", written)
    old, broadcast = shuffles(), spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.raises(Written):
            toxicity.train(docs, given)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert 0 < sum(n for name, n in shuffles().items() if name not in old) < 8 * 300 * 300 / 4
