"""Delete repeated runs of lines, found by winnowing over line hashes.

A line counts by its text without blanks around it; blank lines are passed over
and never deleted.  What may repeat is a window: ``window`` lines in a row, or a
single line of at least ``long_line`` characters.  So only short lines need equal
neighbours.  Each window selects its least line hash (the first of equal ones) as
fingerprint; windows in a row mostly select the same line.  Equal windows select the
same place, so every repeated run of lines that holds a window shares a fingerprint
with its first occurrence: none is missed.  A run of long lines is selected line by
line.

There is one row for each selected line.  Fingerprints that occur once are left
behind first.  The positions of the others are joined to their first occurrence with
the same lines around them: a match reaches from the fingerprint to both sides over
the windows that selected it, and matches that touch or overlap make up longer ones.
Of equal windows the first one, by (document id, text, line), stays; the later runs
are deleted.  All is judged on the input, also within one document.

Counting which fingerprints and windows repeat combines in the map tasks, so a line
in a third of all documents crosses the network once per task.  Null texts stay
null and empty ones empty; a text may become empty.  Rows with equal id and text
are one document and keep alike.  Ids may be null (they come first).  Columns of any
name stay; ``n_lines``, ``n_removed`` and ``n_runs`` are replaced.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.llm.texts import add_text_columns
from grantflow.operators.joins import hot_join
from grantflow.session import settle

BLANKS = " \t\r\f\v"
WINDOW = 2
LONG_LINE = 20


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode()) - (1 << 63)


def fingerprints(hashes: list[int], lengths: list[int], window: int, long_line: int) -> dict[int, list[list[int]]]:
    """For each selected place the windows that selected it: hash, place of the first line, lines."""
    alone = [n >= long_line for n in lengths]
    found = {i: [[h, i, 1]] for i, (h, long) in enumerate(zip(hashes, alone, strict=True)) if long}
    for i in range(len(hashes) - window + 1):
        if all(alone[i : i + window]):  # its lines are windows of their own
            continue
        some = hashes[i : i + window]
        run = xxhash.xxh3_64_intdigest(b"".join(h.to_bytes(8, "little", signed=True) for h in some)) - (1 << 63)
        found.setdefault(i + some.index(min(some)), []).append([run, i, window])
    return found


def selected_lines(df: DataFrame, text: str, window: int, long_line: int) -> DataFrame:
    """``doc_id``, ``_text`` (hash) and a row for each selected line: fp, place, and windows
    (hash, first place and lines of each, in a row)."""

    def prepare():
        def make(texts: list[str]):
            out = [], [], []
            for t in texts:
                lines = [x for x in (line.strip(BLANKS) for line in t.split("\n")) if x]
                hashes = [line_hash(x) for x in lines]
                found = fingerprints(hashes, [len(x) for x in lines], window, long_line)
                out[0].append([hashes[i] for i in found])
                out[1].append(list(found))
                out[2].append([[x for one in windows for x in one] for windows in found.values()])
            return out

        return make

    fields = {"_fp": "array<bigint>", "_place": "array<bigint>", "_windows": "array<array<bigint>>"}
    hashed = add_text_columns(df, text, fields, prepare, ["doc_id", "_text"])
    rows = hashed.select("doc_id", "_text", F.explode(F.arrays_zip(*fields)).alias("x"))
    return rows.select("doc_id", "_text", *[F.col(f"x.{c}").alias(c[1:]) for c in fields])


def repeated_lines(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``_text`` and ``repeated``: (place, size) of the later windows."""
    where = F.struct("doc_id", "_text", "place")
    shared = rows.groupBy("fp").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first < last").select("fp")
    held = hot_join(rows, shared, ["fp"], "left_semi")
    each = F.transform(F.sequence(F.lit(1), F.size("windows"), F.lit(3)), lambda i: F.slice("windows", i, F.lit(3)))
    held = settle(held.select("doc_id", "_text", F.explode(each).alias("x")).selectExpr("doc_id", "_text", "x[0] run", "x[1] place", "x[2] size"))
    first = held.groupBy("run", "size").agg(F.min(where).alias("first"), F.max(where).alias("last")).where("first < last")
    later = hot_join(held, first.select("run", "size", "first"), ["run", "size"], "inner").where(F.col("first") < where)
    return later.groupBy("doc_id", "_text").agg(F.collect_set(F.struct("place", "size")).alias("repeated"))


def without(text: str, runs: list[dict]) -> tuple[str, int, int, int]:
    """Text without the runs, its lines, and how many lines and runs went."""
    gone = {i for r in runs for i in range(r["place"], r["place"] + r["size"])}
    kept, place = [], 0
    for line in text.split("\n"):
        if not line.strip(BLANKS):
            kept.append(line)
            continue
        if place not in gone:
            kept.append(line)
        place += 1
    return "\n".join(kept), place, len(gone), sum(i - 1 not in gone for i in gone)


def dedup_lines(
    df: DataFrame, text: str = "text", id: str = "doc_id", window: int = WINDOW, long_line: int = LONG_LINE
) -> DataFrame:
    """``df`` with the text deduplicated; adds n_lines, n_removed, n_runs."""
    added = {"n_lines": "bigint", "n_removed": "bigint", "n_runs": "bigint"}
    kept = [c for c in df.columns if c not in added]
    key, body = F.col(f"`{id}`"), F.col(f"`{text}`")
    inner = [F.col(f"`{c}`").alias(f"_own_{i}") for i, c in enumerate(kept)]
    marked = df.select(*inner, key.alias("_id"), body.alias("_body"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("_hash"))
    slim = df.select(key.alias("doc_id"), F.xxhash64(F.coalesce(body, F.lit(""))).alias("_text"), body.alias("text"))
    repeated = settle(repeated_lines(selected_lines(slim, "text", window, long_line)))
    # one plan at every size: texts meet their marks by a slim key, sorted and split by AQE where hot
    same = F.col("_id").eqNullSafe(F.col("doc_id")) & (F.col("_hash") == F.col("_text"))
    joined = marked.join(repeated.hint("merge"), same, "left")

    def prepare():
        def make(texts: list[str], runs: list):
            return list(zip(*[without(t, r or []) for t, r in zip(texts, runs, strict=True)], strict=True))

        return make

    own = [f"_own_{i}" for i in range(len(kept))]
    made = add_text_columns(joined, "_body", {"_kept": "string", **added}, prepare, own, ["repeated"])
    new = {c: F.when(F.col(o).isNotNull(), F.col("_kept")) if c == text else F.col(o) for o, c in zip(own, kept, strict=True)}
    return made.select(*[column.alias(c) for c, column in new.items()], *added)
