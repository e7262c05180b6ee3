"""Document text as lines, OCR cells as table rows, question blocks as columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.fixed_values import NO_ANSWER, QUESTION_ALIASES
from grantflow.functions.cleaning import trim_text

TABLE = ["doc_id", "page", "table_no"]


def text_lines(docs: DataFrame, text: str, keep: Sequence[str]) -> DataFrame:
    """Ordered lines of each text: (``keep``, line_no, line)."""
    return docs.select(*keep, F.posexplode(F.split(text, "\n")).alias("line_no", "line"))


def cells_to_rows(cells: DataFrame, width: int, keys: Sequence[str] = (*TABLE, "row_no")) -> DataFrame:
    """Cell rows -> table rows with text columns c0, c1 ...; absent cells are null.

    One aggregate with a fixed column list: no extra job to find the columns.
    """
    return cells.groupBy(*keys).agg(
        *[F.max(F.when(F.col("col_no") == k, F.col("text"))).alias(f"c{k}") for k in range(width)]
    )


def table_shapes(cells: DataFrame) -> DataFrame:
    """Width and first cell of every table."""
    corner = (F.col("row_no") == 0) & (F.col("col_no") == 0)
    return cells.groupBy(*TABLE).agg(
        (F.max("col_no") + 1).alias("width"),
        F.max(F.when(corner, F.col("text"))).alias("first_cell"),
    )


def report_tables(
    cells: DataFrame, width: int, word: str = "grantee", widths: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows of all tables of a document under its first header, and the skipped tables.

    A table whose first cell names ``word`` has a header row, which is left out.
    Tables above the first header, of another width than it, or of another than
    ``width`` columns are skipped and reported with the reason.  With ``widths``
    (doc_id, width) each document has its own, at most ``width``, and rows keep it.
    """
    shapes = table_shapes(cells).withColumn(
        "headed", F.coalesce(F.lower(trim_text("first_cell")).contains(word), F.lit(False))
    )
    heads = (
        shapes.where("headed")
        .groupBy("doc_id")
        .agg(F.min(F.struct("page", "table_no", "width")).alias("head"))
    )
    shapes = shapes.join(heads, "doc_id", "left")
    wanted: Column = F.lit(width)
    if widths is not None:
        shapes = shapes.join(widths.select("doc_id", F.col("width").alias("_wanted")), "doc_id", "left")
        wanted = F.coalesce("_wanted", F.lit(width))
    judged = shapes.withColumn(
        "reason",
        F.when(
            F.col("head").isNull()
            | (F.struct("page", "table_no") < F.struct("head.page", "head.table_no")),
            F.lit("no header"),
        )
        .when(F.col("width") != F.col("head.width"), F.lit("other width"))
        .when(F.col("width") != wanted, F.lit("other layout")),
    )
    good = judged.where(F.col("reason").isNull()).select(*TABLE, "headed", *(["width"] if widths is not None else []))
    rows = (
        cells_to_rows(cells, width)
        .join(good, TABLE)
        .where(~(F.col("headed") & (F.col("row_no") == 0)))
        .drop("headed")
    )
    return rows, judged.where(F.col("reason").isNotNull()).select(*TABLE, "width", "reason")


def rows_by_header(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """Promote row 0 of each table to its header and stack all tables by column name."""
    heads = cells.where("row_no = 0").select(*TABLE, "col_no", trim_text("text").alias("_name"))
    named = cells.where("row_no > 0").join(heads, [*TABLE, "col_no"], "left")
    return named.groupBy(*TABLE, "row_no").agg(
        *[F.max(F.when(F.col("_name") == n, F.col("text"))).alias(n) for n in names]
    )


def pick_table(cells: DataFrame, page: int, index: int, skip_rows: int = 0) -> DataFrame:
    """Cells of one table per document; a negative index counts from the last table."""
    chosen = cells.where((F.col("page") == page) & (F.col("row_no") >= skip_rows))
    if index >= 0:
        return chosen.where(F.col("table_no") == index)
    lasts = (
        cells.where(F.col("page") == page)
        .groupBy(F.col("doc_id").alias("_doc"))
        .agg((F.max("table_no") + 1 + index).alias("_table"))
    )
    return chosen.join(
        lasts, (F.col("doc_id") == F.col("_doc")) & (F.col("table_no") == F.col("_table"))
    ).drop("_doc", "_table")


def pick_tables(cells: DataFrame, wanted: Mapping[int, Sequence[int]], width: int) -> DataFrame:
    """Rows of the wanted tables per page; rows with an empty cell are dropped."""
    tests: list[Column] = [
        (F.col("page") == page) & F.col("table_no").isin(list(tables))
        for page, tables in wanted.items()
    ]
    rows = cells_to_rows(cells.where(reduce(lambda a, b: a | b, tests)), width)
    columns = [f"c{k}" for k in range(width)]
    return rows.withColumns({c: F.nullif(c, F.lit("")) for c in columns}).dropna(subset=columns)


def question_answers(
    blocks: DataFrame, aliases: Sequence[str] = QUESTION_ALIASES, order: str = "block_id"
) -> DataFrame:
    """One row per document with the answer to each question.

    A question without a link, or whose answer has no text, reads
    ``No answer found``; one linked to a missing block or to a block of another
    type stays null.  Of repeated questions the last in ``order`` wins.
    """
    questions = blocks.where("block_type = 'QUERY'").select(
        "doc_id", "alias", F.col(order).alias("_order"), F.get("answer_ids", F.lit(0)).alias("_answer")
    )
    answers = blocks.where("block_type = 'QUERY_RESULT'").select(
        F.col("doc_id").alias("_doc"),
        F.col("block_id").alias("_block"),
        F.coalesce("text", F.lit(NO_ANSWER)).alias("_text"),
    )
    linked = questions.join(
        answers,
        (F.col("doc_id") == F.col("_doc")) & (F.col("_answer") == F.col("_block")),
        "left",
    ).select(
        "doc_id",
        "alias",
        "_order",
        F.when(F.col("_answer").isNull(), F.lit(NO_ANSWER)).otherwise(F.col("_text")).alias("_text"),
    )
    return linked.groupBy("doc_id").agg(
        *[
            F.max_by(
                "_text", F.when((F.col("alias") == a) & F.col("_text").isNotNull(), F.col("_order"))
            ).alias(a)
            for a in aliases
        ]
    )
