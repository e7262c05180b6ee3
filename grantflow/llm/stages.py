"""Operators as stages of a corpus pipeline: documents in, documents out.

Every stage keeps the columns of its input, also ones named like those that an
operator adds, and works on all of it.  ``n_chars`` follows a changed text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantflow.llm import bpe, line_dedup, minhash, mixing, quality

ADDED = (
    "score", "predicted", "held_out", "n_lines", "n_removed", "n_runs", "hash", "head", "node", "size", "source_size",
    "target", "copies", "taken", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "repeated",
)


def aside(docs: DataFrame) -> DataFrame:
    """Rename columns that operators would replace; only a clash costs anything."""
    return docs.withColumnsRenamed({c: f"_own_{c}" for c in ADDED if c in docs.columns})


def back(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their names and in their order."""
    return df.select(*[F.col(f"`_own_{c}`" if c in ADDED else f"`{c}`").alias(c) for c in docs.columns])


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """Add two hashes that tell rows apart by id and text (and ``more``)."""
    return docs.withColumns({"hash": F.xxhash64(F.coalesce(F.col("text"), F.lit(""))), "node": id_key(*more)})


def id_key(*more: str) -> Column:
    return F.xxhash64("doc_id", F.col("doc_id").isNull(), *more)


def rank_in_key(df: DataFrame) -> DataFrame:
    """Number rows of equal id and text; a join on the same keys has them together already."""
    return df.withColumn("head", F.row_number().over(Window.partitionBy("hash", "node").orderBy("hash")))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    forest = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return back(quality.score(aside(docs), forest).where("predicted = 1"), docs)


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the runs of lines that an earlier place has."""
    made = back(line_dedup.dedup_lines(aside(docs)), docs)
    return made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else made


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: that of the least id."""
    stay = minhash.near_duplicates(docs).where("kept").select("hash", id_key().alias("node")).distinct()
    held = keyed(aside(docs)).join(stay, ["hash", "node"], "left_semi")
    return back(rank_in_key(held).where("head = 1"), docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to three times."""
    own = keyed(aside(docs), "source")
    drawn = mixing.mix(own, keep=("doc_id", "source", "hash", "node")).groupBy("hash", "node")
    drawn = drawn.agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("size"))
    met = rank_in_key(own.join(drawn, ["hash", "node"]))
    times = F.expr("cast(copies div size + if(head <= copies % size, 1, 0) as int)")
    return back(met.withColumn("taken", F.explode(F.array_repeat(F.lit(1), times))), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, the ids of each text and whether they decode to it."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    here = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    plain = docs.select(*here, "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    coded = bpe.round_trip(plain, path, pattern, keep=[*here, "text_sha256"], with_ids=True)
    return coded.select(*here, "n_tokens", "ids", (F.col("decoded_sha256") == F.col("text_sha256")).alias("decoded_alike"))
