"""Exact, near, line and substring dedup against brute force."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grantflow.llm import exact_dedup, line_dedup, minhash, suffix_dedup
from grantflow.llm.bytehash import PrefixHashes
from grantflow.llm.components import components, with_links
from grantflow.llm.quotient_filter import CountingQuotientFilter, merge
from grantflow.llm.suffix_sort import common_prefix, sort_suffixes

SCHEMA = "doc_id long, text string, hash int, size int, keep_id int, repeated int"


def frame(spark, texts, parts=5):
    """Texts with ids, and columns whose names clash with those of operators."""
    rows = [(i, t, 1, 2, 3, 4) if not isinstance(t, tuple) else (t[0], t[1], 1, 2, 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts, "doc_id")


def sentence(chance, n):
    return " ".join("".join(chance.choice("aeioutrns") for _ in range(chance.randrange(2, 8))) for _ in range(n))


# ---- counting quotient filter -------------------------------------------------


@pytest.mark.parametrize("width", [12, 40, 63])
def test_filters_keep_every_count(width):
    chance = np.random.default_rng(1)
    parts = [chance.integers(0, 1 << min(width, 62), n).astype(np.uint64) for n in (0, 1, 500, 3000)]
    parts.append(np.repeat(parts[2][:3], [70_000, 300, 2]))
    filters = [CountingQuotientFilter.from_bytes(CountingQuotientFilter.of(p, width).to_bytes()) for p in parts]
    values, counts = merge(filters).entries()
    want = Counter(np.concatenate(parts).tolist())
    assert dict(zip(values.tolist(), counts.tolist())) == want and (np.diff(values.astype(object)) > 0).all()


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_exact_duplicates(spark):
    texts = ["Same Text", "same text", "SAME TEXT", "", None, "É", "é", "x" * 50_000, "X" * 50_000, "alone"]
    texts += ["hot copy"] * 400 + [(3, "Same Text"), (None, "nowhere"), (None, "alone"), (8, "x" * 50_000)]
    df = frame(spark, texts)
    rows = [(r.doc_id, lowered(r.text)) for r in df.collect()]
    got = exact_dedup.exact_duplicates(df)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    want = []
    for i, t in rows:
        same = [j for j, u in rows if u == t]
        keep = max((j for j in same if j is not None), default=None)
        want.append((i, keep, len(same), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert exact_dedup.exact_duplicates(df.limit(0)).count() == 0


def test_equal_fingerprints_are_compared(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "fingerprint", lambda raw: len(raw))
    df = frame(spark, ["ab", "cd", "AB", "e"])
    rows = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_duplicates(df).collect()}
    assert rows == {0: (2, 2), 1: (1, 1), 2: (2, 2), 3: (3, 1)}


# ---- lines ----------------------------------------------------------------------


def plain_lines(docs):
    """Delete every equal run of two lines, or long line, but the first."""
    runs, lines = {}, {}
    for i, t in sorted(docs.items()):
        lines[i] = [x for x in (line.strip(" \t\r\f\v") for line in (t or "").split("\n")) if x]
        own = [((a, b), k, 2) for k, (a, b) in enumerate(zip(lines[i], lines[i][1:]))]
        own += [((a,), k, 1) for k, a in enumerate(lines[i]) if len(a) >= 20]
        for key, k, n in own:
            runs.setdefault(key, []).append((i, k, n))
    gone = {(i, k + j) for found in runs.values() for i, k, n in sorted(found)[1:] for j in range(n)}
    out = {}
    for i, t in docs.items():
        kept, k = [], 0
        for line in (t or "").split("\n"):
            if not line.strip(" \t\r\f\v"):
                kept.append(line)
                continue
            if (i, k) not in gone:
                kept.append(line)
            k += 1
        removed = sorted(k for j, k in gone if j == i)
        out[i] = (None if t is None else "\n".join(kept), len(lines[i]), len(removed), sum(k - 1 not in removed for k in removed))
    return out


def test_repeated_lines(spark):
    chance = random.Random(3)
    pool = [sentence(chance, n) for n in (1, 2, 3, 3, 4, 25, 30)] + ["common line", "x"]
    texts = ["\n".join(chance.choice([*pool, "", " ", f"own {i} {k}"]) for k in range(chance.randrange(12))) for i in range(120)]
    texts += [None, "", "\n\n", "a\na\na\na", " a \r\na", "z" * 90, f"{'z' * 90}\t", "é" * 80 + "\n1", "2\n" + "é" * 80]
    texts += ["a line of twenty char", "own 1\na line of twenty char\nown 2", "nineteen characters", "own 3\nnineteen characters\nown 4", "x\na line of twenty char"]
    texts += ["head\n" + "\n".join(f"line {k % 700}" for k in range(3000))]
    df = frame(spark, texts)
    want = plain_lines(dict(enumerate(texts)))
    got = line_dedup.dedup_lines(df)
    assert got.columns == [*df.columns, "n_lines", "n_removed", "n_runs"]
    assert {r.doc_id: (r.text, r.n_lines, r.n_removed, r.n_runs) for r in got.collect()} == want
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0


def test_lines_of_repeated_and_null_ids(spark):
    text = "one line\nand another"
    rows = [(1, text), (1, text), (1, "other\n" + text), (None, text), (2, text)]
    got = sorted((r.doc_id or 0, r.text) for r in line_dedup.dedup_lines(frame(spark, rows)).collect())
    assert got == [(0, text), (1, ""), (1, ""), (1, "other"), (2, "")]


def test_columns_named_like_inner_ones_stay(spark):
    names = ["_id", "_hash", "_runs", "_kept", "_text", "_body", "repeated", "n_runs", "_own_0"]
    df = frame(spark, ["some line that is repeated\nx", "y\nsome line that is repeated"])
    df = df.withColumns({c: F.lit(f"own {c}") for c in names})
    rows = line_dedup.dedup_lines(df).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["some line that is repeated\nx", "y"]
    assert all(r[c] == f"own {c}" for r in rows for c in names if c != "n_runs")


def test_longer_windows_miss_no_run(spark):
    chance = random.Random(9)
    texts = ["\n".join(chance.choice("abc") for _ in range(12)) for _ in range(30)]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(frame(spark, texts), window=4, long_line=10**6).collect()}
    seen, want = set(), {}
    for i, t in enumerate(texts):
        lines = t.split("\n")
        marked = set()
        for k in range(len(lines) - 3):
            run = tuple(lines[k : k + 4])
            if run in seen:
                marked |= set(range(k, k + 4))
            seen.add(run)
        want[i] = len(marked)
    assert got == want


# ---- MinHash -----------------------------------------------------------------------


def weights(text):
    w = text.lower().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def probability_jaccard(a, b):
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())


def similarities(texts):
    doc, value, weight = minhash.shingles([minhash.words(t) for t in texts])
    cut = np.searchsorted(doc, np.arange(len(texts) + 1))
    return [(value[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]


def test_similarity_is_the_probability_jaccard():
    chance = random.Random(4)
    base = sentence(chance, 40).split()
    texts = [" ".join(chance.choice(base[:6]) for _ in range(n)) for n in (1, 3, 4, 5, 6, 30, 60, 60)] + [" ".join(base), " ".join(base[3:] + base[:9]), ""]
    own = similarities(texts)
    for i, a in enumerate(texts):
        assert sum(own[i][1]) == sum(weights(a).values())
        for j, b in enumerate(texts):
            assert minhash.similarity(own[i], own[j]) == pytest.approx(probability_jaccard(weights(a), weights(b)), abs=1e-9)


def test_registers_agree_as_often_as_texts_are_similar():
    chance = random.Random(6)
    vocabulary = sentence(chance, 300).split()
    a = [chance.choice(vocabulary) for _ in range(400)]
    b = a[:300] + a[50:80] + [chance.choice(vocabulary) for _ in range(60)]
    texts = [" ".join(a), " ".join(b)]
    m = 4096
    signed = minhash.signatures(*minhash.shingles(texts), 2, m)
    want = probability_jaccard(weights(texts[0]), weights(texts[1]))
    assert abs((signed[0] == signed[1]).mean() - want) < 4 * (want * (1 - want) / m) ** 0.5


def edited(chance, text, share):
    return " ".join(sentence(chance, 1) if chance.random() < share else w for w in text.split())


def test_near_duplicates_against_all_pairs(spark):
    chance = random.Random(8)
    texts = []
    for _ in range(25):
        base = sentence(chance, chance.randrange(30, 200))
        texts += [base] + [edited(chance, base, chance.choice([0.0, 0.005, 0.02, 0.05, 0.3])) for _ in range(4)]
    passage = sentence(chance, 80)
    texts += [f"{sentence(chance, 40)} {passage} {sentence(chance, 40)}" for _ in range(60)]
    origin = sentence(chance, 150)
    texts += [edited(chance, origin, 0.01) for _ in range(120)]
    texts += ["", None, "  ", "One two", "one  TWO", "one two three", "w " * 2000, sentence(chance, 9000), (7, texts[3]), (7, texts[7])]
    texts += [(None, "no id at all"), (None, "lost"), (5, "lost")]
    df = frame(spark, texts)
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    got = minhash.near_duplicates(df).collect()
    assert len(got) == len(rows)
    own = similarities([t for _, t in rows])
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if minhash.words(rows[i][1]) == minhash.words(rows[j][1]) or minhash.similarity(own[i], own[j]) >= 0.8:
                label[root(i)] = root(j)
    classes = {}
    for i, row in enumerate(rows):
        classes.setdefault(root(i), []).append(row)
    named = Counter()
    for found in classes.values():
        first = min((i for i, _ in found if i is not None), default=None)
        for i, _ in found:
            named[(i, first, len(found))] += 1
    assert Counter((r.doc_id, r.class_id, r.class_size) for r in got) == named
    assert sum(r.kept for r in got) == len(classes)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_near_copies_inside_a_template_family(spark):
    """A family just under the threshold, whose hubs link nobody, with near copies in it."""
    chance = random.Random(12)
    form = sentence(chance, 170)
    texts = [f"{form} {sentence(chance, 22)}" for _ in range(500)]
    texts += [" ".join([*t.split()[:172], sentence(chance, 20)]) for t in texts[:60]]
    own = similarities(texts)
    near = [(i, j) for i in range(len(texts)) for j in range(i) if minhash.similarity(own[i], own[j]) >= 0.8]
    assert sorted(near) == [(500 + k, k) for k in range(60)]
    assert minhash.similarity(own[100], own[200]) > 0.78
    rows = minhash.near_duplicates(frame(spark, texts)).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in rows} == {
        i: (i % 500, 2 if i % 500 < 60 else 1) for i in range(len(texts))
    }


def test_further_links_join_whole_components(spark):
    chance = random.Random(21)
    links = [(chance.randrange(1, 90), chance.randrange(1, 90)) for _ in range(60)] + [(k, k + 1) for k in range(100, 110)]
    more = [(chance.randrange(1, 120), chance.randrange(1, 120)) for _ in range(25)] + [(3, 3), (300, 301)]
    one, two = (spark.createDataFrame(x, "a bigint, b bigint") for x in (links, more))
    want = {r.node: r.label for r in components(one.union(two)).collect()}
    assert {r.node: r.label for r in with_links(components(one), two).collect()} == want
    label = {n: n for pair in links + more for n in pair}
    for _ in label:
        for a, b in links + more:
            label[a] = label[b] = min(label[a], label[b])
    assert want == label


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_prefixes_of_similar_texts_meet(threshold):
    chance = random.Random(13)
    pool = sentence(chance, 60).split()
    texts = [" ".join(chance.choice(pool[:k]) for _ in range(n)) for k in (1, 2, 3) for n in (4, 9, 30, 200) for _ in range(6)]
    base = [" ".join(chance.choice(pool) for _ in range(n)) for n in (20, 60, 150)]
    texts += [edited(chance, t, share) for t in base for share in (0, 0.01, 0.03, 0.1) for _ in range(8)] + [f"{t} {t}" for t in base]
    seen = np.random.default_rng(1).integers(0, 3, minhash.CELLS).astype(np.uint32)  # any order will do
    tokens, many = minhash.prefixes([minhash.words(t) for t in texts], seen, threshold)
    own, found = similarities(texts), 0
    for i in range(len(texts)):
        for j in range(i):
            if minhash.similarity(own[i], own[j]) >= threshold:
                found += 1
                assert set(tokens[i][: many[i]]) & set(tokens[j]) or set(tokens[j][: many[j]]) & set(tokens[i])
    assert found > 100


# ---- suffixes -----------------------------------------------------------------------


def test_suffix_sort():
    chance = np.random.default_rng(2)
    data = np.concatenate([chance.integers(97, 100, 4000), np.full(500, 97), chance.integers(0, 256, 500)]).astype(np.uint8)
    start = chance.integers(0, len(data) - 20, 3000)
    group = chance.integers(0, 7, 3000)
    order, kind = sort_suffixes(data, group, start, 20)
    keys = [(group[i], data[start[i] : start[i] + 20].tobytes()) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(3000))
    assert [a == b for a, b in zip(keys, keys[1:])] == (kind[1:] == kind[:-1]).tolist()
    common = common_prefix(PrefixHashes(data), start[:-1], start[1:], 20)
    for a, b, n in zip(start, start[1:], common):
        assert n == next((k for k in range(20) if data[a + k] != data[b + k]), 20)


def test_suffixes_are_sorted_by_bytes(monkeypatch):
    """Hashes that collide change nothing; equal suffixes keep their order."""
    monkeypatch.setattr(PrefixHashes, "ranges", lambda self, start, size: np.zeros(len(start), np.uint64))
    chance = np.random.default_rng(5)
    data = np.concatenate([np.tile(chance.integers(0, 256, 40), 20), chance.integers(254, 256, 300)]).astype(np.uint8)
    start, group = chance.integers(0, len(data) - 50 + 1, 900), chance.integers(0, 3, 900)
    order, kind = sort_suffixes(data, group, start, 50)
    keys = [(group[i], data[start[i] : start[i] + 50].tobytes(), i) for i in order]
    assert keys == sorted(keys) and [a[:2] == b[:2] for a, b in zip(keys, keys[1:])] == (kind[1:] == kind[:-1]).tolist()
    none = np.zeros(0, np.int64)
    assert [len(x) for x in sort_suffixes(data, none, none, 50)] == [0, 0]


def test_chunks_are_hashed_once_to_be_cut(monkeypatch):
    """The places found when the marks are looked up also serve to cut."""
    monkeypatch.setattr(suffix_dedup, "SLAB_BYTES", 300)
    made, slab = [], suffix_dedup.Slab
    monkeypatch.setattr(suffix_dedup, "Slab", lambda *given: made.append(given) or slab(*given))
    own = bytes(range(256)) * 2
    raw = [b"q" * 60, b"", own, b"short", b"q" * 60, own]
    table = pa.table({"doc_id": list(range(6)), "raw": raw, "chunk": [0] * 6})
    none = pa.table({c: pa.array([], pa.binary()) for c in ("keys", "content", "mask", "hot")})
    cut = suffix_dedup.cut_documents(table, none, True)
    assert len(made) == len(list(suffix_dedup.slabs(table))) > 1 and cut.column("kept").to_pylist() == [b"q" * 60, b"", own, b"short", b"", b""]


def plain_strings(docs):
    least = {}
    for i, raw in docs:
        for p in range(len(raw) - 49):
            s = raw[p : p + 50]
            least[s] = min(least.get(s, i), i) if i is not None else least.get(s, 10**9)
    out = []
    for i, raw in docs:
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 49):
            if i is not None and least[raw[p : p + 50]] < i:
                gone[p : p + 50] = True
        spans = int((gone & ~np.append(False, gone[:-1])[: len(gone)]).sum())
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_bytes, hot_chunks", [(1 << 14, 3), (2000, 5), (1 << 22, 256)])
def test_repeated_strings(spark, monkeypatch, chunk_bytes, hot_chunks):
    chance = random.Random(11)
    monkeypatch.setattr(suffix_dedup, "SLAB_BYTES", 3000)
    passage, origin = sentence(chance, 30), sentence(chance, 120)
    texts = [sentence(chance, chance.randrange(60)) for _ in range(60)]
    texts += [f"{sentence(chance, 10)} {passage} {sentence(chance, 10)}" for _ in range(50)]
    texts += [edited(chance, origin, 0.03) for _ in range(20)] + [origin] * 20
    texts += ["a" * 49, "a" * 50, "a" * 51, "a" * 3000, "ab" * 100, None, "", "日本語テキスト" * 9, "日本語テキスト" * 5 + "x", passage[:50], passage[1:51], passage[:49]]
    texts += [(3, texts[61]), (3, texts[61]), (None, origin), (None, ""), (-4, origin[30:200]), "z" * 20 + origin[100:149] + "y" * 20]
    df = frame(spark, texts)
    docs = [(r.doc_id, (r.text or "").encode()) for r in df.collect()]
    got = suffix_dedup.repeated_strings(df, chunk_bytes=chunk_bytes, hot_chunks=hot_chunks)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == plain_strings(docs)


def test_no_strings(spark):
    df = frame(spark, ["x"])
    assert suffix_dedup.repeated_strings(df.limit(0)).count() == 0
    kept = suffix_dedup.repeated_strings(frame(spark, ["q" * 60, "q" * 55 + "r"]), with_bytes=True).collect()
    assert {r.doc_id: bytes(r.kept) for r in kept} == {0: b"q" * 60, 1: b"r"}


def test_steps_let_go_what_they_shuffled(spark):
    """At the end only the last step's shuffles are on disk; stretches travel compressed."""
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {n.split("_")[1] for n in names if n.startswith("shuffle_")}

    old = shuffles()
    texts = [(i, f"{i} " + "a line of more than fifty bytes that comes again and again " * 3) for i in range(60)]
    got = suffix_dedup.repeated_strings(spark.createDataFrame(texts, "doc_id long, text string"), chunk_bytes=1000)
    end = time.time() + 20
    while len(shuffles() - old) > 3 and time.time() < end:
        time.sleep(0.2)
    assert len(shuffles() - old) <= 3 and got.where("n_removed > 0").count() == 59
    table = pa.table({"doc_id": [1, 2], "raw": [t.encode() for _, t in texts[:2]], "chunk": [0, 0]})
    keys = np.concatenate([s.key for s in suffix_dedup.slabs(table)])
    answers = pa.table({"keys": [keys.tobytes()], "hot": [np.zeros(len(keys), bool).tobytes()]})
    sent = suffix_dedup.send_stretches(table, answers, 1)
    sizes = suffix_dedup.unpacked(sent, "size", np.uint8).astype(int).sum()
    assert len(suffix_dedup.inflated(sent)) == sizes > len(sent.column("raw")[0].as_py())


def test_buckets_large_at_the_last_level_meet_exactly(spark, monkeypatch):
    """Pairs that no hub of a large bucket finds are found by the exact way for the rest."""
    monkeypatch.setattr(minhash, "LEVELS", 1)
    monkeypatch.setattr(minhash, "SMALL", 1)
    monkeypatch.setattr(minhash, "_alike_hubs", lambda pairs, threshold: pairs.selectExpr("node as a", "hub as b").limit(0))
    chance = random.Random(5)
    base, texts = [f"w{k}" for k in range(100)], []
    for k in range(12):
        own = list(base)
        for at in chance.sample(range(10, 90), 4):
            own[at] = f"x{k}-{at}"
        texts += [" ".join(own), " ".join([*own[:-1], f"y{k}"])]
    bodies = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    alone = bodies.selectExpr("node", "node as label")
    labels = minhash._finer(alone, alone, bodies, minhash.THRESHOLD)
    found = dict(map(tuple, labels.collect()))
    assert all(found[2 * k] == found[2 * k + 1] for k in range(12)) and len(set(found.values())) == 12


def test_small_labels_lie_in_few_files(spark):
    """Labels of few nodes do not cost a file and a task for each shuffle partition."""
    links = spark.range(600).selectExpr("id + 1000 as a", "id % 7 as b")
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        labels = components(links)
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value)
    assert {r.node: r.label for r in labels.collect()} == {k: k for k in range(7)} | {k + 1000: k % 7 for k in range(600)}
    assert len(labels.inputFiles()) <= 16
