"""Quality of whole texts: boosted trees over document statistics.

The forest is fitted on at most ``MOST_TRAINING_ROWS`` labelled documents, those of
the least id hashes, of which only the statistics reach the driver (a few MB).
Labels whose ``crc32(id) mod 5`` is 0 are held out and never learned from; so are
those of null ids and ids with differing labels.  Scoring is one pass over the
texts without a shuffle.  Labels, language, source and id are no inputs.

Null and empty texts have statistics 0 and get the score of such texts.  Without
labels to learn from every score is 0.5.  Repeated rows are scored alike, columns
named like the new ones replaced.
"""

from __future__ import annotations

import operator
import string
from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.llm.boosting import Forest, fit
from grantflow.llm.texts import add_text_columns

MOST_TRAINING_ROWS = 20_000
THRESHOLD = 0.3
FOLDS = 5
KINDS = {
    "upper": string.ascii_uppercase, "lower": string.ascii_lowercase, "digit": string.digits, "blank": " ", "line": "\n",
    "stop": ".", "comma": ",;:", "quote": "'\"()-", "shout": "!?", "bar": "|", "mark": "#$%&*", "rest": "<>{}[]=+@^~\\/_`",
}
CLASSES = np.zeros((256, len(KINDS) + 1))
CLASSES[128:, -1] = 1
for _k, _chars in enumerate(KINDS.values()):
    CLASSES[list(_chars.encode()), _k] = 1


def statistics(text: str) -> list[float]:
    """Numbers that describe one whole text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    bytes_of = np.bincount(raw, minlength=256)
    n, words, lines = max(1, len(raw)), text.split(), text.split("\n")
    many = max(1, len(words))
    share = bytes_of[bytes_of > 0] / n
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    counts = Counter(words)
    return [
        *(bytes_of @ CLASSES / n),
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        float(-(share * np.log2(share)).sum()) if len(raw) else 0.0,
        float(lengths.mean()) if words else 0.0,
        float(lengths.std()) if words else 0.0,
        float((lengths <= 3).mean()) if words else 0.0,
        float(lengths.max(initial=0)),
        len(counts) / many,
        max(counts.values(), default=0) / many,
        sum(map(operator.eq, words, words[1:])) / many,
        sum(map(str.istitle, words)) / many,
        sum(map(str.isupper, words)) / many,
        sum(map(str.isalpha, words)) / many,
        len(lines) / many,
        len(set(lines)) / len(lines),
        max(map(len, lines)) / n,
    ]


def learned(id: Column) -> Column:
    """Whether a label may be learned from."""
    return F.coalesce(F.crc32(id.cast("string")) % FOLDS != 0, F.lit(False))


def train(
    documents: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", label: str = "quality",
    most: int = MOST_TRAINING_ROWS,
) -> Forest:
    """Fit a forest; ``most`` bounds the labelled documents used."""
    own = labels.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
    own = own.where(learned(F.col("_id")) & F.col("_label").isNotNull()).groupBy("_id")
    agreed = own.agg(F.min("_label").alias("_label"), F.max("_label").alias("_most")).where("_label = _most")
    # at most ``most`` rows of two numbers: small enough for every task
    chosen = agreed.orderBy(F.xxhash64("_id"), "_id").limit(most).select("_id", "_label")
    docs = documents.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(F.broadcast(chosen), "_id")
    rows = add_text_columns(
        docs, "_text", {"x": "array<double>"}, lambda: lambda texts: [[statistics(t) for t in texts]], ["_id", "_label"]
    )
    found = rows.orderBy(F.xxhash64("_id"), "_id", "x").limit(most).toPandas()
    x = np.array(found["x"].tolist(), float).reshape(len(found), len(statistics("")))
    return fit(x, found["_label"].to_numpy(float))


def score(
    df: DataFrame, forest: Forest, text: str = "text", id: str = "doc_id", threshold: float = THRESHOLD, keep=None
) -> DataFrame:
    """Add held_out, score and predicted (1: quality is good enough)."""

    def prepare():
        def make(texts: list[str]):
            scores = forest.scores(np.array([statistics(t) for t in texts], float))
            return [scores, (scores >= threshold).astype(np.int32)]

        return make

    scored = add_text_columns(df, text, {"score": "double", "predicted": "int"}, prepare, keep)
    return scored.withColumn("held_out", ~learned(F.col(f"`{id}`")))
