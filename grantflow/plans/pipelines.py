"""The four pipelines: a folder of landed files -> loaded tables, each file once.

A landed folder has one sub-folder of JSON Lines per input.  A run reads the lines of
files that the ledger of input files lacks, builds the tables, loads them parents first,
and notes the files last.  Which file a line comes from is told by Spark itself, so no
list of files passes through the driver.  A line that is no such document is a reject
with its file and stops nothing.  The files of a run are written down before anything is
built: a run that stopped half way is repeated with its run id on the same files; what it
had loaded is not taken for stored rows, so the ids come out the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow import schemas
from grantflow.operators.joins import keep_absent, keep_present
from grantflow.operators.rows import stack
from grantflow.plans.awards import award_tables
from grantflow.plans.financial import financial_tables
from grantflow.plans.history import history_tables
from grantflow.plans.loading import load_tables, write_rejects
from grantflow.plans.performance import performance_tables
from grantflow.schemas import TABLES, TableSpec
from grantflow.session import letting_go, settle, with_settings
from grantflow.sources.tables import Ledger, exists, publish, read_table

# The landed amounts of these may be words; the builder reads them leniently.
LANDED_AWARDS_DDL = re.sub(r"(`(?:COVID-19|Infrastructure) \w+`) decimal\(18,2\)", r"\1 string", schemas.AWARDS_DDL)
INPUT_FILES = TableSpec("input_files", "pipeline string, path string", ("pipeline", "path"))
CORRUPT = "_corrupt_record"
JSON_FILES = "*.json{,.gz,.bz2}"  # landed as they are, or compressed
# Landed files and the parsed documents hold many times their size on disk: a task takes
# less of them, and a join side made of documents is estimated larger before it may be
# broadcast.  (Not while lines meet the list of files, which must stay small to Spark.)
SMALL_TASKS = {"spark.sql.files.maxPartitionBytes": "16m"}
DENSE_FILES = {"spark.sql.sources.fileCompressionFactor": "10.0"}
Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Pipeline:
    """``inputs`` maps a sub-folder to its schema; ``build`` gets them and the stored tables."""

    name: str
    inputs: Mapping[str, str]
    tables: Sequence[str]
    build: Callable[[Frames, Frames], Frames]
    orders: Mapping[str, Sequence[str]] = field(default_factory=dict)

    def run(
        self, spark: SparkSession, landed: str, root: str, run_id: str, check_parents: bool = True
    ) -> dict[str, bool]:
        """Load the new files; returns which tables got a run (none without new files)."""
        known = Ledger(spark, root, INPUT_FILES.name, *self.tables)
        if known.is_published(INPUT_FILES.name, run_id):
            return {}
        seen = read_table(spark, root, INPUT_FILES, known).where(F.col("pipeline") == self.name)
        noted = f"{root}/pipelines/{self.name}/{run_id}"
        if not exists(spark, f"{noted}/_SUCCESS"):
            # the first folder below the landed one is the input
            folders = [f"{landed.rstrip('/')}/{name}" for name in self.inputs]
            found = [landed_files(spark, f) for f in folders if exists(spark, f)]
            fresh = keep_absent(stack(found), seen, ["path"]) if found else seen.select("path").limit(0)
            fresh.select(F.lit(self.name).alias("pipeline"), "path").write.mode("overwrite").parquet(noted)
        files = spark.read.schema(INPUT_FILES.schema).parquet(noted)
        if files.isEmpty():
            return {}
        frames, broken = {}, []
        # the documents of the run are written down parsed, and go when its tables are loaded
        with letting_go(spark), with_settings(spark, SMALL_TASKS):
            for name, ddl in self.inputs.items():
                folder = f"{landed.rstrip('/')}/{name}"
                if not exists(spark, folder):
                    frames[name] = spark.createDataFrame([], ddl)
                    continue
                frames[name], bad = read_landed(spark, folder, ddl, files)
                broken.append(bad.withColumn("source", F.lit(f"{self.name}/{name}")))
            with with_settings(spark, DENSE_FILES):
                if broken:
                    rejects = stack(broken).select("source", "key", F.lit("format").alias("rule"), "text")
                    write_rejects(rejects, root, f"{self.name}_lines", run_id)
                stored = {t: read_table(spark, root, TABLES[t], known, but=run_id) for t in self.tables}
                orders = {t: [F.col(c) for c in columns] for t, columns in self.orders.items()}
                done = load_tables(self.build(frames, stored), root, run_id, orders, check_parents)
        publish(files, root, INPUT_FILES, run_id)
        return done


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` of the JSON files of a folder, as the rows read from them tell it."""
    reader = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=JSON_FILES)
    return reader.load(folder).select(F.col("_metadata.file_path").alias("path"))


def read_landed(spark: SparkSession, folder: str, ddl: str, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Documents of the ``files`` (path) that lie in a folder, and the lines that are none as (key: file, text).

    Every line is parsed once: the documents are settled, the lines that are none beside them.
    """
    kept = T.StructType([*T.StructType.fromDDL(ddl).fields, T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.options(recursiveFileLookup="true", pathGlobFilter=JSON_FILES)
    lines = reader.text(folder).where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("path"))
    own = keep_present(lines, files, ["path"])
    parsed = own.select("path", "value", F.from_json("value", kept, {"columnNameOfCorruptRecord": CORRUPT}).alias("doc"))
    bad = F.col("doc").isNull() | F.col(f"doc.{CORRUPT}").isNotNull()
    told = {"_file": F.when(bad, F.col("path")), "_line": F.when(bad, F.col("value"))}
    rows = settle(parsed.select("doc.*", *[c.alias(n) for n, c in told.items()]).drop(CORRUPT), codec="zstd")
    docs = rows.where(F.col("_line").isNull()).drop(*told)
    return docs, rows.where(F.col("_line").isNotNull()).select(F.col("_file").alias("key"), F.col("_line").alias("text"))


AWARDS = Pipeline(
    "awards",
    {
        "awards": LANDED_AWARDS_DDL, "other": schemas.OTHER_DDL, "funding": schemas.FUNDING_DDL,
        "subawards": schemas.SUBAWARDS_DDL, "transactions": schemas.TRANSACTIONS_DDL, "fund_codes": f"{schemas.FUND_CODES_DDL}, row_no bigint",
    },
    (),
    lambda new, stored: award_tables(
        new["awards"], new["other"], new["funding"], new["subawards"], new["transactions"], new["fund_codes"]
    ),
)
HISTORY = Pipeline(
    "history",
    {"lines": schemas.LINES_DDL},
    ("grantee", "disaster", "publiclaw", "disasterpubliclaw", "granthistory"),
    lambda new, stored: history_tables(new["lines"], stored),
)
PERFORMANCE = Pipeline(
    "performance",
    {"cells": schemas.CELLS_DDL, "blocks": schemas.BLOCKS_DDL},
    ("activities", "amountdescriptions", "performancereports"),
    lambda new, stored: performance_tables(new["cells"], new["blocks"], stored),
    {"amountdescriptions": ["doc_id", "row_no"]},
)
FINANCIAL = Pipeline(
    "financial",
    {"cells": schemas.CELLS_DDL, "front_pages": "doc_id string, file_name string, text string"},
    ("grantfinancialreports",),
    lambda new, stored: financial_tables(
        new["cells"], new["front_pages"], stored=stored["grantfinancialreports"]
    ),
)
