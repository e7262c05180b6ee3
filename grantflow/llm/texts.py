"""Map whole texts through vectorised Python, a bounded slice at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters of text that one call of a text function gets, unless one text alone is longer.
SLICE_CHARS = 1 << 20

ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()),
    "array<double>": pa.list_(pa.float64()), "array<int>": pa.list_(pa.int32()),
    "array<array<bigint>>": pa.list_(pa.list_(pa.int64())),
}


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_CHARS) -> Iterator[tuple[int, list[str]]]:
    """(offset, texts) in order; null counts as the empty text."""
    held, start, size = [], 0, 0
    for i in range(len(texts)):
        text = texts[i].as_py() or ""
        if held and size + len(text) > limit:
            yield start, held
            held, start, size = [], i, 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def add_text_columns(
    df: DataFrame,
    text: str,
    fields: dict[str, str],
    prepare: Callable[[], Callable[..., Sequence[Sequence]]],
    keep: Sequence[str] | None = None,
    also: Sequence[str] = (),
    limit: int = SLICE_CHARS,
) -> DataFrame:
    """Add ``fields`` (name: type) computed from the texts of one column.

    ``prepare()`` runs once in each task and returns the function that turns a
    list of texts (and a list of values of each column in ``also``) into one
    sequence of values per field.  ``keep`` lists the columns to carry along
    (all by default); a new field replaces a column of the same name.  Nothing
    is shuffled.  ``limit`` is the number of characters that one call gets.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c not in fields]
    schema = T.StructType([df.schema[c] for c in kept])
    for name, kind in fields.items():
        schema = schema.add(name, T.DataType.fromDDL(kind))
    kinds, names = [ARROW[kind] for kind in fields.values()], [f.name for f in schema]
    read = [*kept, *also, text]
    source = df.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(read)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = prepare()
        for batch in batches:
            rest, others, texts = batch.columns[: len(kept)], batch.columns[len(kept) : -1], batch.columns[-1]
            for start, some in slices(texts, limit):
                values = make(some, *[c.slice(start, len(some)).to_pylist() for c in others])
                made = [pa.array(v, type=kind) for v, kind in zip(values, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([c.slice(start, len(some)) for c in rest] + made, names=names)

    return source.mapInArrow(run, schema)
