"""Exact duplicates: counting quotient filters pick what has to be compared.

1. Every text gets a 64-bit fingerprint and a SHA-256 of its normalised bytes.
2. Each partition of fingerprints builds counting quotient filters, one for each
   slice of the fingerprint range.  The filters of a slice merge into one.  A
   fingerprint crosses the network once per partition, however hot it is.
3. Only texts whose fingerprint counts more than one are read again and compared
   byte by byte: grouped by the normalised text itself, which map tasks combine
   before the shuffle.  Equal fingerprints of different texts end here.

Null counts as the empty text; empty texts are equal to each other.  Of equal
texts the largest ``doc_id`` stays (null is smaller than any).  Rows that repeat
an id count each, and share the decision of that id.
"""

from __future__ import annotations

import hashlib
import string

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.llm.quotient_filter import CountingQuotientFilter, merge
from grantflow.llm.texts import add_text_columns
from grantflow.operators.joins import hot_join
from grantflow.session import settle

FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
# Fingerprints that one slice should hold, and slices at least.
SLICE_ROWS = 1 << 15
LEAST_SLICES = 64


def fingerprint(raw: bytes) -> int:
    return xxhash.xxh3_64_intdigest(raw) - (1 << 63)  # as a signed number


def fingerprints(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep``, ``fp`` and ``text_sha256`` of the text with A-Z lowered."""

    def prepare():
        def make(texts: list[str]):
            raw = [t.encode().translate(FOLD) for t in texts]
            return [fingerprint(r) for r in raw], [hashlib.sha256(r).hexdigest() for r in raw]

        return make

    return add_text_columns(df, text, {"fp": "bigint", "text_sha256": "string"}, prepare, keep)


def repeated_fingerprints(fps: DataFrame, rows: int) -> DataFrame:
    """``fp`` and ``n`` of the fingerprints that occur more than once among ``rows`` rows."""
    bits = max(LEAST_SLICES, rows // SLICE_ROWS).bit_length()
    width = 64 - bits

    def build(batches):
        found = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        values = np.sort(np.concatenate(found or [np.zeros(0, np.int64)])).view(np.uint64)
        values = np.sort(values ^ np.uint64(1 << 63))
        part = values >> np.uint64(width)
        edges = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)]).tolist()
        rows_of = [(int(part[a]), values[a:b] & np.uint64((1 << width) - 1)) for a, b in zip(edges, [*edges[1:], len(part)])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in rows_of], pa.int64()),
                pa.array([CountingQuotientFilter.of(v, width).to_bytes() for _, v in rows_of], pa.binary()),
            ],
            names=["slice", "filter"],
        )

    def combine(table: pa.Table) -> pa.Table:
        whole = merge([CountingQuotientFilter.from_bytes(f.as_py()) for f in table.column("filter")])
        values, counts = whole.entries()
        values, counts = values[counts > 1], counts[counts > 1]
        full = (np.uint64(table.column("slice")[0].as_py()) << np.uint64(width)) | values
        return pa.table({"fp": (full ^ np.uint64(1 << 63)).view(np.int64), "n": counts.astype(np.int64)})

    filters = fps.select("fp").mapInArrow(build, "slice bigint, filter binary")
    return filters.groupBy("slice").applyInArrow(combine, "fp bigint, n bigint")


def exact_duplicates(df: DataFrame, text: str = "text", id: str = "doc_id") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    slim = settle(fingerprints(df.select(F.col(f"`{id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), "text", ["doc_id"]))
    repeated = settle(repeated_fingerprints(slim, slim.count()))

    def prepare():
        def make(texts: list[str]):
            raw = [t.encode().translate(FOLD) for t in texts]
            return [fingerprint(r) for r in raw], raw

        return make

    raw = add_text_columns(df, text, {"fp": "bigint", "raw": "binary"}, prepare, [id])
    suspects = hot_join(raw.withColumnRenamed(id, "doc_id"), repeated.select("fp"), ["fp"], "left_semi")
    equal = (
        suspects.groupBy("fp", "raw")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1")
        .select(F.sha2("raw", 256).alias("text_sha256"), "keep_id", "group_size")
    )
    joined = hot_join(slim, equal, ["text_sha256"], "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        F.col("doc_id").alias(id),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )
