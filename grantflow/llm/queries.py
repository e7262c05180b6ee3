"""Registered queries of the text operators: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.llm import bpe, exact_dedup, exact_search, fixity, hard_negatives, line_dedup, minhash, mixing, periodic_runs, quality, suffix_dedup, token_counts, toxicity
from grantflow.session import settle, tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(*tables: str, sql: str | None = None):
    """Register ``build(frames of the tables)`` under the function's name."""

    def register(build: Callable[..., DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(*[tune(spark).read.parquet(f"{folder}/{table}.parquet") for table in tables])

        run.__name__ = build.__name__
        QUERIES[build.__name__] = run
        if sql:
            ORACLES[build.__name__] = sql.strip()
        return build

    return register


@query("documents")
def op9_byte_bpe(documents: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(documents, path, public_tokenizers.PATTERN, keep=["doc_id"])


@query("documents")
def op10_token_counts(documents: DataFrame) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    counted = token_counts.prefix_counts(documents, path, public_tokenizers.PATTERN, keep=["doc_id"])
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"))


@query(
    "documents",
    sql="""
    WITH t AS (
        SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x
        FROM documents
    )
    SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
    FROM t
    """,
)
def op8_exact_dedup(documents: DataFrame) -> DataFrame:
    return exact_dedup.exact_duplicates(documents)


@query("documents")
def op3_source_mix(documents: DataFrame) -> DataFrame:
    mixed = mixing.mix(documents)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query(
    "documents",
    sql=r"""
    WITH line AS (
        SELECT doc_id, u.raw, u.i, trim(u.raw, e' \t\r\f\v') AS x
        FROM documents, unnest(string_split(text, chr(10))) WITH ORDINALITY AS u(raw, i)
    ), placed AS (
        SELECT doc_id, x, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS place,
               lead(x) OVER (PARTITION BY doc_id ORDER BY i) AS y
        FROM line WHERE x <> ''
    ), run AS (
        SELECT doc_id, place, 2 AS n, x, y FROM placed WHERE y IS NOT NULL
        UNION ALL SELECT doc_id, place, 1, x, '' FROM placed WHERE length(x) >= 20
    ), later AS (
        SELECT doc_id, place, n, row_number() OVER (PARTITION BY n, x, y ORDER BY doc_id, place) AS nth FROM run
    ), gone AS (
        SELECT DISTINCT doc_id, place + k AS place FROM later, unnest(range(n)) AS r(k) WHERE nth > 1
    ), numbered AS (
        SELECT doc_id, raw, i, x,
               CASE WHEN x <> '' THEN count(*) FILTER (WHERE x <> '') OVER (PARTITION BY doc_id ORDER BY i) END AS place
        FROM line
    ), joined AS (
        SELECT n.*, g.place AS gone, before.place AS before
        FROM numbered n LEFT JOIN gone g USING (doc_id, place)
        LEFT JOIN gone before ON before.doc_id = n.doc_id AND before.place = n.place - 1
    ), rebuilt AS (
        SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY i) FILTER (WHERE gone IS NULL), '') AS text,
               count(place) AS n_lines, count(gone) AS n_removed,
               count(*) FILTER (WHERE gone IS NOT NULL AND before IS NULL) AS n_runs
        FROM joined GROUP BY doc_id
    )
    SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(r.text, '') END AS text,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, coalesce(n_runs, 0) AS n_runs
    FROM documents d LEFT JOIN rebuilt r USING (doc_id)
    """,
)
def op4_line_dedup(documents: DataFrame) -> DataFrame:
    return line_dedup.dedup_lines(documents).select("doc_id", "text", "n_lines", "n_removed", "n_runs")


@query("documents")
def op1_minhash_near_dedup(documents: DataFrame) -> DataFrame:
    return minhash.near_duplicates(documents).select("doc_id", "class_id", "class_size", "kept")


@query("documents", "labels")
def op2_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = quality.score(documents, quality.train(documents, labels), keep=["doc_id"])
    return scored.select("doc_id", "held_out", "score", "predicted")


@query(
    "embeddings",
    sql="""
    WITH v AS (
        SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x::DOUBLE)]) = len(embedding)
    ), scored AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
        FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
    ), ranked AS (
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
)
def op6_exact_top_k(embeddings: DataFrame) -> DataFrame:
    return exact_search.top_inner_products(embeddings, F.col("vec_id") % 50 == 0)


@query("documents")
def op7_suffix_dedup(documents: DataFrame) -> DataFrame:
    return suffix_dedup.repeated_strings(documents)


WARC_RECORD = r"""
    SELECT page_id, page_id // 256 AS file,
           strlen(e'WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:' || page_id
                  || e'>\r\nWARC-Target-URI: ' || coalesce(url, '') || e'\r\nContent-Type: text/html\r\nContent-Length: '
                  || strlen(coalesce(html, '')) || e'\r\n\r\n' || coalesce(html, '') || e'\r\n\r\n') AS length
    FROM pages
"""


@query(
    "pages",
    sql=f"""
    WITH record AS ({WARC_RECORD}), placed AS (
        SELECT *, coalesce(sum(length) OVER (
            PARTITION BY file ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset"
        FROM record
    )
    SELECT file, "offset", page_id AS key, length,
           CASE WHEN file % 13 = 4 AND page_id % 256 >= 250 THEN 'lost' ELSE 'changed' END AS finding
    FROM placed WHERE page_id % 97 = 5 OR file % 13 = 4 AND page_id % 256 >= 250
    """,
)
def op5_warc_fixity(pages: DataFrame) -> DataFrame:
    """Audit a replica in which every 97th page has another first byte and some files lack their end."""
    rot, cut = F.expr("page_id % 97 = 5"), F.expr("page_id div 256 % 13 = 4 AND page_id % 256 >= 250")
    turned = F.concat(F.lit("#"), F.expr("substring(html, 2)"))
    replica = pages.where(~F.coalesce(cut, F.lit(False))).withColumn("html", F.when(rot, turned).otherwise(F.col("html")))
    return fixity.audit(settle(fixity.archive(pages)), settle(fixity.archive(replica)))


@query("documents")
def op12_periodic_runs(documents: DataFrame) -> DataFrame:
    """Runs of each text, of every tenth with a periodic end (see ``made_periodic``)."""
    turned = documents.select("doc_id", periodic_runs.made_periodic(F.col("doc_id"), F.col("text")).alias("text"))
    found = periodic_runs.periodic_runs(turned, keep=["doc_id"])
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    # the first of the strongest, compared as whole numbers
    strongest = F.reduce(
        F.slice("runs", 2, F.greatest(F.size("runs"), F.lit(1))),
        F.get("runs", F.lit(0)),
        lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best),
    )
    return found.withColumn("_best", strongest).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "embeddings",
    sql="""
    WITH v AS (
        SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x::DOUBLE)]) = len(embedding)
    ), scored AS (
        SELECT a.row, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike, list_dot_product(a.v, c.v)::BIGINT AS score
        FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0
    ), positive AS (
        SELECT row, anchor_id, vec_id, score, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS nth
        FROM scored WHERE alike
    ), ranked AS (
        SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.row, nth ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
        FROM positive p JOIN scored s ON p.row = s.row AND NOT s.alike
         AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
        WHERE nth <= 5
    )
    SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
    """,
)
def op13_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Every hundredth row is an anchor; every seventh first moves to the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(embeddings.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query("documents", "labels")
def op11_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = toxicity.score(documents, toxicity.train(documents, labels), keep=["doc_id"])
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", "held_out", "score", predicted, F.col("toxic").alias("by_language"))
