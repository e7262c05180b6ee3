"""Disaster history reports: lines -> events, laws and awards -> five tables.

All documents are processed at once; the group of every ordered step is the
document, the order its line number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.fixed_values import HEADING_YEARS_PATTERN, REPORT_DATE_PATTERN, REPORT_TERRITORY
from grantflow.functions.cleaning import trim_text
from grantflow.functions.dates import (
    heading_end_year,
    law_date,
    long_date,
    month_from_file_name,
    repair_year,
)
from grantflow.functions.reports import (
    award_amount,
    award_grantee,
    event_name,
    event_year,
    first_pattern,
    has_award,
    has_law,
    law_mentions,
    standalone_laws,
)
from grantflow.operators.joins import (
    enrich,
    keep_absent,
    keep_present,
    null_safe_join,
    state_code,
)
from grantflow.operators.numbering import BLOCK, first_seen_ids
from grantflow.operators.ordered import carry_down
from grantflow.operators.rows import first_per_key
from grantflow.session import settle


def report_dates(lines: DataFrame) -> DataFrame:
    """Report date per document (doc_id, report_date).

    The first line with ``Month d, y`` decides; a year that has not four digits
    is replaced by the end year of the first ``yyyy-yyyy`` of the text.  Text
    that is no date after all falls back to the month in the file name.
    """
    read = lines if "_found" in lines.columns else lines.where(may_date("line")).withColumns(dated("line"))
    hits = (
        read.where(F.col("_found").isNotNull() | F.col("_year").isNotNull())
        .groupBy("doc_id")
        .agg(
            F.min_by("_found", F.when(F.col("_found").isNotNull(), F.col("line_no"))).alias("_found"),
            F.min_by("_year", F.when(F.col("_year").isNotNull(), F.col("line_no"))).alias("_year"),
        )
    )
    docs = lines.select("doc_id", "file_name").distinct()
    return enrich(docs, hits, ["doc_id"], ["_found", "_year"]).select(
        "doc_id",
        F.coalesce(
            long_date(repair_year("_found", "_year")), month_from_file_name("file_name")
        ).alias("report_date"),
    )


def may_date(line: str) -> Column:
    return F.col(line).rlike(f"{REPORT_DATE_PATTERN}|{HEADING_YEARS_PATTERN}")


def dated(line: str) -> dict[str, Column]:
    """The date and the end year that a line may tell."""
    found = F.nullif(F.regexp_extract(line, REPORT_DATE_PATTERN, 1), F.lit(""))
    return {"_found": found, "_year": heading_end_year(line)}


def told(lines: DataFrame) -> DataFrame:
    """Everything a line tells by itself (``_law``, ``_date``: whether it may tell such), read from its text once: later steps do not need the text."""
    return lines.withColumns(
        {
            "_laws": F.when(F.col("_law"), law_mentions("line")),
            "_alone": F.when(F.col("_law"), standalone_laws("line")),
            "_award": F.when(has_award("line"), F.struct(award_grantee("line").alias("grantee_name"), award_amount("line").alias("grant_award"))),
            **{c: F.when(F.col("_date"), e) for c, e in dated("line").items()},
        }
    ).drop("line", "_law", "_date")


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are worked out once for each row.

    A plain column is worked out again in each filter and column that uses it; what a
    generator has made is not.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    made = df.select(*kept, F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias("_once"))
    found = made.select(*kept, *[F.col(f"_once.{c}").alias(c) for c in columns])
    return found.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*df.columns, *columns])])


def headed(lines: DataFrame) -> DataFrame:
    """Trimmed lines with their heading, if they are one."""
    return once(once(lines, line=trim_text("line")), heading=first_pattern("line"))


def sections(heads: DataFrame, block: int = BLOCK) -> DataFrame:
    """Lines with the event they stand under (null above the first)."""
    return carry_down(heads, ["doc_id"], "line_no", F.col("heading"), "disaster_event", block)


def sectioned_laws(tied: DataFrame) -> DataFrame:
    """Laws with optional dates mentioned under an event."""
    mentioned = F.col("_laws") if "_laws" in tied.columns else law_mentions("line")
    return (
        tied.where(F.col("disaster_event").isNotNull())
        .select("doc_id", "line_no", "disaster_event", F.posexplode(mentioned).alias("pos", "_law"))
        .select("doc_id", "line_no", "pos", "disaster_event", "_law.pl_number", "_law.pl_date")
    )


def leftover_laws(tied: DataFrame, known: DataFrame) -> DataFrame:
    """Law numbers found nowhere in ``known``, under the last event of their document."""
    alone = F.col("_alone") if "_alone" in tied.columns else standalone_laws("line")
    found = tied.select("doc_id", "line_no", F.posexplode(alone).alias("pos", "pl_number")).select(
        "doc_id", "pl_number", F.struct("line_no", "pos").alias("_at"), F.lit(False).alias("_known")
    )
    # both meet in one aggregate with partial results; null keys match nothing
    there = known.select("doc_id", "pl_number").dropna().withColumns({"_at": F.lit(None).cast(found.schema["_at"].dataType), "_known": F.lit(True)})
    fresh = (
        found.unionByName(there)
        .groupBy("doc_id", "pl_number")
        .agg(F.min("_at").alias("_at"), F.max("_known").alias("_known"))
        .where(~F.col("_known"))
        .drop("_known")
    )
    lasts = (
        tied.where(F.col("disaster_event").isNotNull())
        .groupBy("doc_id")
        .agg(F.max_by("disaster_event", "line_no").alias("disaster_event"))
    )
    return enrich(fresh, lasts, ["doc_id"], ["disaster_event"]).select(
        "doc_id",
        "_at.line_no",
        "_at.pos",
        "disaster_event",
        "pl_number",
        F.lit(None).cast("string").alias("pl_date"),
    )


def award_lines(tied: DataFrame) -> DataFrame:
    """One record per line that names the territory and one dollar amount."""
    own = ["doc_id", "line_no", "disaster_event", F.lit(REPORT_TERRITORY).alias("territory")]
    if "_award" in tied.columns:
        return tied.where(F.col("_award").isNotNull()).select(*own, "_award.grantee_name", "_award.grant_award")
    return tied.where(has_award("line")).select(
        *own, award_grantee("line").alias("grantee_name"), award_amount("line").alias("grant_award")
    )


def marked_lines(lines: DataFrame) -> DataFrame:
    """The lines that hold a heading, a law, an award or a date, and what they tell, written once.

    The one step that reads the text: it neither shuffles nor sorts.
    """
    found = once(headed(lines), _law=has_law("line"), _date=may_date("line"))
    telling = F.col("line").contains(REPORT_TERRITORY) | F.col("_law") | F.col("_date")
    return settle(told(found.where(F.col("heading").isNotNull() | telling)))


def extract(lines: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(laws, awards) of all documents; only laws of events with an award stay."""
    marked = marked_lines(lines)
    telling = marked.select("doc_id", "line_no", "heading", "_laws", "_alone", "_award")
    some = F.coalesce("heading", F.get("_laws", F.lit(0))["pl_number"], F.get("_alone", F.lit(0))).isNotNull() | F.col("_award").isNotNull()
    tied = settle(sections(telling.where(some), block))
    awards = enrich(award_lines(tied), report_dates(marked), ["doc_id"], ["report_date"])
    direct = sectioned_laws(tied)
    laws = direct.unionByName(leftover_laws(tied, direct))
    return keep_present(laws, awards, ["doc_id", "disaster_event"]), awards


def grantee_rows(awards: DataFrame) -> DataFrame:
    """Awards with trimmed names, the state code, and event name and year."""
    clean = awards.withColumns(
        {c: trim_text(c) for c in ("disaster_event", "grantee_name", "territory")}
    )
    return state_code(clean, "territory", "state_code").withColumns(
        {"disaster_name": event_name("disaster_event"), "disaster_year": event_year("disaster_event")}
    )


def grantees(rows: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Grantees that are not stored, with further ids."""
    keys = ["grantee_name", "state_code"]
    return first_seen_ids(rows, keys, ["doc_id", "line_no"], "grantee_id", stored)


def disasters(rows: DataFrame, laws: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Events by (name, year) that are not stored: those of awards first, then those of laws."""
    keys = ["disaster_name", "disaster_year"]
    columns = [*keys, "doc_id", "line_no"]
    # names are taken of each event, not of each law
    events = laws.groupBy("disaster_event").agg(F.min(F.struct("doc_id", "line_no")).alias("_first"))
    named = events.select("disaster_event", "_first.*").withColumns(
        {"disaster_name": event_name("disaster_event"), "disaster_year": event_year("disaster_event")}
    )
    seen = (
        rows.select(F.lit(0).alias("source"), *columns)
        .unionByName(named.select(F.lit(1).alias("source"), *columns))
        .where(F.col("disaster_name").isNotNull())
    )
    return first_seen_ids(seen, keys, ["source", "doc_id", "line_no"], "disaster_id", stored)


def public_laws(laws: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """One row per law number that is not stored, by first mention."""
    mentions = laws.select(trim_text("pl_number").alias("pl_number"), "pl_date", "doc_id", "line_no", "pos")
    # only dates of first mentions are read
    window = Window.partitionBy("pl_number").orderBy("doc_id", "line_no", "pos")
    firsts = mentions.withColumn("_rank", F.rank().over(window)).where("_rank = 1").drop("_rank")
    fresh = first_per_key(firsts.withColumn("pl_date", law_date("pl_date")), ["pl_number"], ["doc_id", "line_no", "pos", "pl_date"])
    fresh = fresh.select("pl_number", "pl_date")
    return fresh if stored is None else keep_absent(fresh, stored, ["pl_number"])


def disaster_laws(
    laws: DataFrame, events: DataFrame, stored: DataFrame | None = None
) -> DataFrame:
    """Distinct (disaster_id, pl_number) that are not stored; the event is matched by name and year."""
    # names are taken of distinct pairs, not of each law
    pairs = laws.select("disaster_event", trim_text("pl_number").alias("pl_number")).dropDuplicates()
    named = pairs.select(
        event_name("disaster_event").alias("disaster_name"),
        event_year("disaster_event").alias("disaster_year"),
        "pl_number",
    ).dropDuplicates()
    pairs = (
        null_safe_join(named, events, ["disaster_name", "disaster_year"], "left")
        .select("disaster_id", "pl_number")
        .dropna()
    )
    pairs = pairs.dropDuplicates()
    return pairs if stored is None else keep_absent(pairs, stored, ["disaster_id", "pl_number"])


def grant_history(
    rows: DataFrame, events: DataFrame, names: DataFrame, stored: DataFrame | None = None
) -> DataFrame:
    """Distinct awards with event and grantee ids that are not stored, with further ids."""
    linked = null_safe_join(rows, events, ["disaster_name", "disaster_year"], "left")
    linked = null_safe_join(linked, names, ["grantee_name", "state_code"], "left")
    return first_seen_ids(
        linked,
        ["disaster_id", "grantee_id", "grant_award", "report_date"],
        ["doc_id", "line_no"],
        "grant_history_id",
        stored,
    )


def _with_stored(fresh: DataFrame, stored: DataFrame | None) -> DataFrame:
    return fresh if stored is None else stored.select(*fresh.columns).unionByName(fresh)


def history_tables(
    lines: DataFrame, stored: Mapping[str, DataFrame] | None = None, block: int = BLOCK
) -> dict[str, DataFrame]:
    """What ``lines`` add to the five history tables.

    Of the stored tables only keys and ids are read: names and events to link the new
    awards and laws, and the keys that are there already.
    """
    stored = stored or {}
    laws, awards = extract(lines, block)
    laws, rows = settle(laws), settle(grantee_rows(awards))
    names = grantees(rows, stored.get("grantee"))
    events = disasters(rows, laws, stored.get("disaster"))
    all_events, all_names = _with_stored(events, stored.get("disaster")), _with_stored(names, stored.get("grantee"))
    return {
        "grantee": names,
        "disaster": events,
        "publiclaw": public_laws(laws, stored.get("publiclaw")),
        "disasterpubliclaw": disaster_laws(laws, all_events, stored.get("disasterpubliclaw")),
        "granthistory": grant_history(rows, all_events, all_names, stored.get("granthistory")),
    }
