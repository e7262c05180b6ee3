"""Registered queries and pipeline stages over the smallest tables, against SQL or plain versions."""

import base64
import hashlib
import struct
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from test_llm_dedup import plain_lines, plain_strings, probability_jaccard, weights
from test_llm_operators import shares
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from compare import TABLES, rows_of
from grantflow.llm import mixing, quality
from grantflow.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").collect()


def test_all_operators_are_registered():
    names = {name.split("_")[0] for name in QUERIES}
    assert names == {f"op{n}" for n in range(1, 11)} and "pipeline" in entry.queries()
    assert set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df = QUERIES[name](spark, SMALL)
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, result.fetchall())


def classes_of(rows):
    """Classes of (id, text) rows: equal words, or similar shingles, in chains."""
    own = [weights(t or "") for _, t in rows]
    holders, label = defaultdict(list), list(range(len(rows)))
    for i, w in enumerate(own):
        for s in w:
            holders[s].append(i)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    pairs = {(a, b) for found in holders.values() for a in found for b in found if a < b}
    for a, b in pairs:
        if root(a) != root(b) and (own[a] == own[b] or probability_jaccard(own[a], own[b]) >= 0.8):
            label[root(a)] = root(b)
    empty = [i for i, w in enumerate(own) if not w]
    for i in empty[1:]:
        label[root(i)] = root(empty[0])
    found = defaultdict(list)
    for i, (id, _) in enumerate(rows):
        found[root(i)].append(id)
    return list(found.values())


def test_op1(spark, documents):
    got = {r.doc_id: (r.class_id, r.class_size, r.kept) for r in QUERIES["op1_minhash_near_dedup"](spark, SMALL).collect()}
    want = {i: (min(c), len(c), i == min(c)) for c in classes_of([(r.doc_id, r.text) for r in documents]) for i in c}
    assert got == want


def test_op2(spark, documents):
    got = QUERIES["op2_quality"](spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in documents)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


def test_op3(spark, documents):
    got = QUERIES["op3_source_mix"](spark, SMALL).collect()
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in documents:
        n = len((r.text or "").encode().split())
        sizes[r.source] += n
        longest[r.source] = max(longest[r.source], n)
    target = shares(dict(sizes))
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in documents)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= longest[s] for s in sizes)


def test_op7(spark, documents):
    got = QUERIES["op7_suffix_dedup"](spark, SMALL)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_strings([(r.doc_id, (r.text or "").encode()) for r in documents])


def test_op9(spark, documents):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in QUERIES["op9_byte_bpe"](spark, SMALL).collect()}
    assert len(got) == len(documents)
    for r in documents:
        ids = library.encode_ordinary(r.text or "")
        digest = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert (got[r.doc_id].n_tokens, got[r.doc_id].ids_sha256) == (len(ids), digest)
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_op10(spark, documents):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in QUERIES["op10_token_counts"](spark, SMALL).collect()}
    assert len(got) == len(documents)
    for r in documents:
        n = len(library.encode(r.text or "", add_special_tokens=False).ids)
        assert (got[r.doc_id].n_tokens, got[r.doc_id].n_bytes, got[r.doc_id].over_limit) == (n, len((r.text or "").encode()), n > 1024)


# ---- pipeline -----------------------------------------------------------------------------

ODD = [
    (10_001, None, None, None, 0, 1.5), (10_002, "", "en", "src1", 0, 1.5), (None, "no id here", "en", "src1", 10, 1.5),
    (10_003, "twice the same row\nand a second line", "en", "src2", 5, 1.5), (10_003, "twice the same row\nand a second line", "en", "src2", 5, 1.5),
    (10_004, "word " * 30_000, "en", "src3", 5, 1.5),
]


def stage_inputs(spark, tmp_path):
    """The documents with odd rows and a column whose name an operator uses."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    odd = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, score double")
    return docs.selectExpr("*", "cast(doc_id as double) as score").unionByName(odd)


def content(rows):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.score) for r in rows)


def test_stages_one_by_one(spark, tmp_path):
    docs = stage_inputs(spark, tmp_path)
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "MinHash near-dedup", "mixing sources", "byte-level BPE"
    ]
    made = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path / f"stage{k}")
        stage(spark, docs, SMALL).write.parquet(path)
        out = spark.read.parquet(path)
        made.append((docs.collect(), out.collect()))
        if k < 4:
            assert out.dtypes == docs.dtypes
        docs = out
    before, after = made[0]
    forest = quality.train(stage_inputs(spark, tmp_path), spark.read.parquet(f"{SMALL}/labels.parquet"))
    good = [r for r in before if forest.scores(np.array([quality.statistics(r.text or "")]))[0] >= 0.3]
    assert content(after) == content(good) and 0 < len(after) < len(before)

    before, after = made[1]
    by_id = {r.doc_id: r.text for r in before if r.doc_id is not None}
    want = {i: t for i, (t, *_) in plain_lines(by_id).items()}
    assert len(after) == len(before)
    assert all(r.text == want[r.doc_id] and r.n_chars == (None if r.text is None else len(r.text)) for r in after if r.doc_id in want)

    before, after = made[2]
    classes = classes_of([(r.doc_id, r.text) for r in before])
    least = Counter(min((i for i in c if i is not None), default=None) for c in classes)
    assert Counter(r.doc_id for r in after) == least and not content(after) - content(before)

    before, after = made[3]
    drawn = {(r.doc_id, r.source): r.copies for r in mixing.mix(spark.read.parquet(str(tmp_path / "stage2")).drop("size")).collect()}
    times = Counter((r.doc_id, r.source) for r in after)
    assert max(times.values()) <= 3 and abs(sum(times.values()) - sum(drawn.values())) <= 0.2 * len(before)

    before, after = made[4]
    assert len(after) == len(before) and all(r.decoded_alike for r in after)
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = Counter((r.doc_id, struct.pack(f"<{len(x)}I", *x)) for r in before for x in [library.encode_ordinary(r.text or "")])
    assert Counter((r.doc_id, bytes(r.ids)) for r in after) == ids


def test_pipeline_runs_and_agrees(spark):
    first = [sorted(map(repr, corpus_pipeline.run(spark, SMALL).drop("ids").collect())) for _ in range(2)]
    assert first[0] == first[1] and len(first[0]) > 20


def test_stages_of_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SMALL).count() == 0
