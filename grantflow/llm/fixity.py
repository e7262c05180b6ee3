"""WARC records and a Merkle audit of their replicas, in DataFrame functions only.

Records lie in archive files in the order of their keys.  A tree has one node per
record (SHA-256 of its bytes), one per offset range of ``RANGE_BYTES`` over the
records that start there, one per ``FAN`` ranges in a row, and so on up to a root
per file.  A node's digest covers the places and digests of its children in order,
so an added, lost, moved or changed record changes every digest above it.

Two replicas are compared at their roots, and only children of nodes that differ
are read below: a sound file costs one row, a broken record one path.  No task
gathers more than a range or ``FAN`` nodes, whatever the size of a file.

Records of null key or null payload are records like others (the payload counts as
empty); equal keys lie in the order of their bytes.  Exactly equal records at one
place do not occur, since places are offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.operators.joins import hot_join
from grantflow.session import settle

FILE_RECORDS = 256
RANGE_BYTES = 1 << 16
FAN = 16
EOL = "\r\n"


def record_bytes(key: Column, url: Column, payload: Column) -> Column:
    """One WARC/1.0 resource record: header, payload, two empty lines."""
    body = F.coalesce(payload, F.lit("")).cast("binary")
    head = F.concat(
        F.lit(f"WARC/1.0{EOL}WARC-Type: resource{EOL}WARC-Record-ID: <urn:page:"),
        F.coalesce(key.cast("string"), F.lit("")),
        F.lit(f">{EOL}WARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit(f"{EOL}Content-Type: text/html{EOL}Content-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(EOL + EOL),
    )
    return F.concat(head.cast("binary"), body, F.lit(EOL + EOL).cast("binary"))


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Records of archive files: file, key, length, digest, offset.

    Files hold the keys of one span of ``FILE_RECORDS``; records without a key are
    dealt by their digest.  What is sorted are digests, not payloads.
    """
    raw = record_bytes(F.col(f"`{key}`"), F.col(f"`{url}`"), F.col(f"`{payload}`"))
    slim = pages.select(F.col(f"`{key}`").cast("bigint").alias("key"), raw.alias("_raw"))
    slim = slim.select("key", F.octet_length("_raw").cast("bigint").alias("length"), F.sha2("_raw", 256).alias("digest"))
    return placed(slim.withColumn("file", file_of(F.col("key"), F.col("digest"))))


def file_of(key: Column, digest: Column) -> Column:
    spare = -1 - F.pmod(F.xxhash64(digest), F.lit(1 << 20))
    return F.coalesce(F.floor(key / F.lit(FILE_RECORDS)).cast("bigint"), spare)


def placed(records: DataFrame) -> DataFrame:
    """Add each record's ``offset`` in its file."""
    before = Window.partitionBy("file").orderBy("key", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint"))


def tree(records: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN) -> DataFrame:
    """All nodes above the records: file, level (1: ranges), node, digest.

    Each level is written, one job a level; there are as many as a longest file needs.

    ``node`` is the number of the range on its level; levels go up until every
    file has one node.
    """
    nodes, level, span = None, 1, range_bytes
    below = records.select("file", F.col("offset").alias("place"), F.concat_ws(":", "key", "length", "digest").alias("digest"))
    while True:
        inside = F.concat_ws(",", F.transform(F.sort_array(F.collect_list(F.struct("place", "digest"))), lambda x: F.concat_ws("=", x["place"], x["digest"])))
        node = F.floor(F.col("place") / F.lit(span)).cast("bigint")
        own = settle(below.groupBy("file", node.alias("node")).agg(F.sha2(inside, 256).alias("digest")).withColumn("level", F.lit(level)))
        nodes = own if nodes is None else nodes.unionByName(own)
        if not (own.agg(F.max("node")).first()[0] or 0):
            return nodes
        below, level, span = own.select("file", F.col("node").alias("place"), "digest"), level + 1, fan


def audit(
    records: DataFrame, replica: DataFrame, range_bytes: int = RANGE_BYTES, fan: int = FAN
) -> DataFrame:
    """Where a replica differs: file, offset, key, length, finding.

    ``finding`` is changed (other bytes at the same place and key), lost (not in
    the replica at its place) or alien (in the replica only).
    """
    one, two = tree(records, range_bytes, fan), tree(replica, range_bytes, fan)
    top = min(x.agg(F.max("level")).first()[0] or 1 for x in (one, two))
    wrong = None
    for level in range(top, 0, -1):
        own = [x.where(F.col("level") == level).select("file", "node", "digest") for x in (one, two)]
        if wrong is not None:
            span = [x.withColumn("_up", F.floor(F.col("node") / F.lit(fan)).cast("bigint")) for x in own]
            above = wrong.withColumnRenamed("node", "_up")
            own = [hot_join(x, above, ["file", "_up"], "left_semi").drop("_up") for x in span]
        both = own[0].join(own[1].withColumnRenamed("digest", "_other"), ["file", "node"], "full")
        wrong = settle(both.where(~F.col("digest").eqNullSafe(F.col("_other"))).select("file", "node"))
    node = F.floor(F.col("offset") / F.lit(range_bytes)).cast("bigint")
    asked = [hot_join(x.withColumn("node", node), wrong, ["file", "node"], "left_semi") for x in (records, replica)]
    left = asked[0].select("file", "offset", "key", "length", "digest")
    right = asked[1].select("file", "offset", F.col("key").alias("_key"), F.col("length").alias("_length"), F.col("digest").alias("_digest"))
    met = left.join(right, ["file", "offset"], "full")
    same_key = F.col("digest").isNotNull() & F.col("_digest").isNotNull() & F.col("key").eqNullSafe(F.col("_key"))
    found = met.where(~(F.col("digest").eqNullSafe(F.col("_digest")) & F.col("key").eqNullSafe(F.col("_key"))))
    rows = F.array(
        F.when(same_key, F.struct("key", "length", F.lit("changed").alias("finding"))),
        F.when(~same_key & F.col("digest").isNotNull(), F.struct("key", "length", F.lit("lost").alias("finding"))),
        F.when(
            ~same_key & F.col("_digest").isNotNull(),
            F.struct(F.col("_key").alias("key"), F.col("_length").alias("length"), F.lit("alien").alias("finding")),
        ),
    )
    told = found.select("file", "offset", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("x"))
    return told.select("file", "offset", "x.key", "x.length", "x.finding")
