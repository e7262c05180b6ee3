"""From raw documents to token ids: quality, line dedup, near-dedup, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from grantflow.llm import stages
from grantflow.session import settle, tune

STAGES = [
    ("quality classifier", stages.good_quality),
    ("line dedup", stages.fresh_lines),
    ("MinHash near-dedup", stages.one_of_each),
    ("mixing sources", stages.mixed_sources),
    ("byte-level BPE", stages.token_ids),
]

# A fitted classifier and random rounding have no SQL; tests/llm hold the stages
# against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
