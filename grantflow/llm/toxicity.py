"""Toxicity of whole texts: a convolutional classifier with a threshold for each language.

The classifier (``text_convolution``) is fitted on all labelled documents, whole.  Labels
whose ``crc32(id) mod 5`` is 0 are held out and never learned from; neither are those of
null ids and of ids with differing labels.  Of the others a fifth, all of them scored,
sets the thresholds and is kept from fitting.  Scoring is one pass over the texts without
a shuffle.  Labels, language, source and id are no inputs of a score.

A table of bits, made from the ids alone, tells the label of nearly all documents while they
are read (:func:`labelled`); only the rest cross a join with their words.  The documents
to fit to, of which only hashes of their words are kept (8 bytes a word, compressed),
are dealt by hash into cells that one task holds.  Up to ``PART_ROWS`` documents of
``PART_WORDS`` words are one cell.  More are learned from in ``ROUNDS`` rounds: in each
one, tasks go on from the same model, each with a cell of its own, and the next round
starts from the mean of theirs, so each document is in one round.  Means are built block by
block of the model; to the driver come one model a round and a row for each language.

Null and empty texts get the score of a text without words.  Without labels to learn
from every score is 0.5.  A language that is null or has fewer than ``LEAST_ROWS`` rows
gets the threshold of all rows.  Repeated rows are scored alike, columns named like the
new ones replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.llm.quality import FOLDS, learned
from grantflow.llm.text_convolution import BUCKETS, STEPS, Model, begin, buckets_of, hashed_words, learn, least_texts
from grantflow.llm.texts import add_text_columns
from grantflow.session import free_shuffles, settled_for_now

# What one task holds and learns from.
PART_ROWS, PART_WORDS, ROUNDS = 10_000, 1 << 24, 8
BLOCK_BYTES = 1 << 16  # of a model, in one row
SLOTS = 1 << 25
BINS = 4096  # of scores, for each unit of their logit
THRESHOLD, LEAST_ROWS = 0.5, 30


@dataclass
class Classifier:
    model: Model
    threshold: float = THRESHOLD
    by_language: dict[str, float] = field(default_factory=dict)


def best_cut(low: np.ndarray, high: np.ndarray, many: np.ndarray, hits: np.ndarray, none: float = THRESHOLD) -> float:
    """The middle of the widest gap between bins of scores that gives the largest F1; ``none``
    where one of the labels is missing.  The bins, falling: least and largest score, rows, rows of label 1."""
    if not 0 < hits.sum() < many.sum():
        return none
    f1 = 2 * hits.cumsum() / (many.cumsum() + hits.sum())
    below = np.append(high[1:], 0.0)
    cut = np.where(below < low, f1, -1)  # equal scores fall together
    best = np.flatnonzero(cut >= cut.max() - 1e-12)
    k = best[(low - below)[best].argmax()]
    return float((low[k] + below[k]) / 2)


def best_threshold(scores: np.ndarray, labels: np.ndarray, none: float = THRESHOLD) -> float:
    """:func:`best_cut` of single scores."""
    order = np.argsort(-scores, kind="stable")
    return best_cut(scores[order], scores[order], np.ones(len(order)), labels[order], none)


def train(
    documents: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "toxic", lang: str = "lang",
    part_rows: int = PART_ROWS, part_words: int = PART_WORDS,
) -> Classifier:
    """Fit and calibrate; ``part_rows`` and ``part_words`` bound what one task holds."""
    own = labels.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
    own = own.where(learned(F.col("_id")) & F.col("_label").isNotNull()).groupBy("_id")
    agreed = own.agg(F.min("_label").alias("_label"), F.max("_label").alias("_most")).where("_label = _most").drop("_most")
    language = F.col(f"`{lang}`").cast("string") if lang in documents.columns else F.lit(None).cast("string")
    docs = documents.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_text"), language.alias("_lang"))
    hashed = labelled(docs, agreed).withColumn("_aside", F.crc32(F.col("_id").cast("string")) % FOLDS == 1)
    with settled_for_now(hashed, "labelled", "zstd") as rows:
        free_shuffles(documents.sparkSession)
        model = fitted(rows.where("not _aside"), part_rows, part_words)
        return Classifier(model, *thresholds(rows.where("_aside"), model))


def labelled(docs: DataFrame, agreed: DataFrame) -> DataFrame:
    """The documents (_id, _text, _lang) whose id is in ``agreed``: _id, _lang, words, _label.

    Ids fall into ``SLOTS`` by hash.  Where all documents of a slot have the same label, it is known
    from two bits; those of slots with several answers are joined.  The table of bits has a
    fixed size, so it may be broadcast, and it is made of ids and labels only.
    """
    slot = F.pmod(F.xxhash64("_id"), F.lit(SLOTS))
    word, bit = F.floor(slot / 64).alias("_word"), (slot % 64).cast("int").alias("_bit")

    def slots_where(held: Column) -> Column:
        return F.bit_or(F.when(held, F.call_function("shiftleft", F.expr("1L"), F.col("_bit"))).otherwise(F.expr("0L")))

    told = docs.select("_id").join(agreed, "_id", "left").select(word, bit, "_label").groupBy("_word").agg(
        slots_where(F.col("_label").eqNullSafe(0)).alias("_zero"), slots_where(F.col("_label").eqNullSafe(1)).alias("_one"),
        slots_where(F.col("_label").isNotNull()).alias("_any"), slots_where(~F.coalesce(F.col("_label").isin(0, 1), F.lit(False))).alias("_rest"),
    )
    told = told.selectExpr("_word", "(_zero ^ _one) & ~_rest as _sure", "_one", "_any").where("_any <> 0")
    met = docs.select("*", word, bit).join(F.broadcast(told), "_word").where(F.getbit("_any", "_bit") == 1)
    sure, one = F.getbit("_sure", "_bit") == 1, F.getbit("_one", "_bit").cast("int").alias("_label")

    def hashed(rows: DataFrame) -> DataFrame:
        kept = [c for c in rows.columns if c != "_text"]
        return add_text_columns(rows, "_text", {"words": "array<bigint>"}, lambda: lambda texts: [hashed_words(texts)], kept)

    known = hashed(met.where(sure).select(*docs.columns, one))
    joined = hashed(met.where(~sure).select(*docs.columns)).join(agreed, "_id")
    return known.unionByName(joined)


def common_buckets(rows: DataFrame, texts: int) -> np.ndarray:
    """The buckets that come in enough of the texts, ascending."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for words in batch.column(0):
                many[buckets_of(words.values.to_numpy())] += 1
        there = np.flatnonzero(many)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(many[there])], names=["bucket", "many"])

    found = rows.select("words").mapInArrow(counted, "bucket bigint, many bigint").groupBy("bucket").agg(F.sum("many").alias("many"))
    return np.sort(found.where(F.col("many") >= least_texts(texts)).select("bucket").toArrow().column(0).to_numpy())


def fitted(rows: DataFrame, part_rows: int, part_words: int) -> Model:
    """The model of all rows (_id, _label, _lang, words)."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_label"), F.lit(0)).alias("ones"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words")).first()
    made, rng = begin(common_buckets(rows, size.n), size.n, float(size.ones))
    if not 0 < size.ones < size.n:
        return made.model
    workers = max(-(-size.n // part_rows), -(-size.words // part_words))
    rounds = ROUNDS if workers > 1 else 1
    chances = rng.spawn(workers * rounds) if workers > 1 else [rng]
    keys = [F.xxhash64("_id"), F.col("_id"), F.col("_lang"), F.xxhash64("words")]
    cell = F.pmod(F.xxhash64("_id", "_lang", "words"), F.lit(workers * rounds)).cast("int")
    dealt = rows.select("_label", "words", cell.alias("_cell"), *[k.alias(f"_k{i}") for i, k in enumerate(keys)])
    for k in range(rounds):
        mine = dealt.where(F.col("_cell") % rounds == k).repartitionById(workers, F.expr(f"cast(_cell div {rounds} as int)"))
        mine = mine.sortWithinPartitions(*[f"_k{i}" for i in range(len(keys))]).select("_cell", "_label", "words")

        def step(batches: Iterator[pa.RecordBatch], made=made, many=STEPS // rounds) -> Iterator[pa.RecordBatch]:
            words, truth, cell = [], [], None
            for batch in batches:
                cell = batch.column(0)[0].as_py() if batch.num_rows else cell
                words += [w.values.to_numpy() for w in batch.column(2)]
                truth.append(batch.column(1).to_numpy().astype(float))
            if not words:
                return
            raw = learn(made, words, np.concatenate(truth), chances[cell], many).numbers().tobytes()
            for b in range(0, len(raw), BLOCK_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b // BLOCK_BYTES]), pa.array([cell]), pa.array([len(words)]), pa.array([raw[b : b + BLOCK_BYTES]], pa.binary())],
                    names=["block", "cell", "n", "numbers"],
                )

        def mean(some: pa.Table) -> pa.Table:
            some = some.sort_by("cell")  # sums of equal order
            parts = np.stack([np.frombuffer(x.as_py(), np.float32) for x in some.column("numbers")]).astype(float)
            whole = np.average(parts, axis=0, weights=some.column("n").to_numpy()).astype(np.float32)
            return pa.table({"block": some.column("block").slice(0, 1), "numbers": pa.array([whole.tobytes()], pa.binary())})

        blocks = mine.mapInArrow(step, "block bigint, cell bigint, n bigint, numbers binary").groupBy("block").applyInArrow(mean, "block bigint, numbers binary").toArrow()
        if blocks.num_rows:
            made.put(np.frombuffer(b"".join(blocks.sort_by("block").column("numbers").to_pylist()), np.float32))
        if rounds > 1:
            free_shuffles(rows.sparkSession)
    return made.model


def thresholds(rows: DataFrame, model: Model) -> tuple[float, dict[str, float]]:
    """The best threshold of all rows (_label, _lang, words), and that of each language.

    The rows are counted in bins of their score, which keep the least and the largest one.
    """

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.concatenate([model.scores([w.values.to_numpy()]) for w in batch.column(2)]) if batch.num_rows else np.zeros(0)
            with np.errstate(divide="ignore"):
                bins = np.floor(np.clip(np.log(scores) - np.log1p(-scores), -50, 50) * BINS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores), pa.array(bins)], names=["lang", "label", "score", "bin"])

    def cut(some: pd.DataFrame) -> pd.DataFrame:
        some = some.sort_values("bin", ascending=False)
        low, high, many, hits = (some[c].to_numpy(float) for c in ("low", "high", "many", "hits"))
        return pd.DataFrame({"lang": some["lang"].iloc[:1], "rows": [int(many.sum())], "threshold": [best_cut(low, high, many, hits, np.nan)]})

    bins = rows.select("_lang", "_label", "words").mapInArrow(scored, "lang string, label int, score double, bin bigint").groupBy("lang", "bin")
    bins = bins.agg(F.min("score").alias("low"), F.max("score").alias("high"), F.count(F.lit(1)).alias("many"), F.sum("label").alias("hits"))
    every = bins.groupBy("bin").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("many").alias("many"), F.sum("hits").alias("hits"))
    both = bins.where("lang is not null").unionByName(every.withColumn("lang", F.lit(None).cast("string")))
    found = both.groupBy("lang").applyInPandas(cut, "lang string, rows bigint, threshold double").where(f"lang is null or rows >= {LEAST_ROWS}").collect()
    plain = {r.lang: r.threshold for r in found if r.threshold is not None and not np.isnan(r.threshold)}
    overall = plain.get(None, THRESHOLD)
    return overall, {r.lang: plain.get(r.lang, overall) for r in sorted(found, key=lambda r: r.lang or "") if r.lang is not None}


def score(
    df: DataFrame, made: Classifier, text: str = "text", id: str = "doc_id", lang: str = "lang", keep=None
) -> DataFrame:
    """Add score, held_out and toxic (1: the score reaches the threshold of the language)."""
    model = made.model
    wanted = [c for c in (df.columns if keep is None else keep) if c not in ("score", "held_out", "toxic")]
    inner = {f"_own_{i}": F.col(f"`{c}`") for i, c in enumerate(wanted)}
    inner |= {"_id": F.col(f"`{id}`"), "_lang": F.col(f"`{lang}`").cast("string") if lang in df.columns else F.lit(None).cast("string")}
    source = df.select(*[c.alias(k) for k, c in inner.items()], F.col(f"`{text}`").alias("_text"))
    scored = add_text_columns(source, "_text", {"score": "double"}, lambda: lambda texts: [model.scores(hashed_words(texts))], list(inner))
    limit = F.lit(made.threshold)
    if made.by_language:
        known = F.create_map(*[F.lit(x) for pair in made.by_language.items() for x in pair])
        limit = F.coalesce(F.try_element_at(known, F.coalesce("_lang", F.lit(""))), limit)
    return scored.select(
        *[F.col(f"_own_{i}").alias(c) for i, c in enumerate(wanted)], "score",
        (~learned(F.col("_id"))).alias("held_out"), (F.col("score") >= limit).cast("int").alias("toxic"),
    )
