"""Report links in web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.fixed_values import REPORT_SITE, REPORT_SUFFIX
from grantflow.functions.cleaning import file_name
from grantflow.operators.joins import drop_prefixed
from grantflow.operators.rows import stack

UNSEEN_HTML = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
ANCHOR = r"(?is)<a\s([^>]*)>(.*?)</a\s*>"
HREF = r"""(?i)(?:^|\s)href\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _plain(value: Column) -> Column:
    for entity, char in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(char))
    return value


def page_links(pages: DataFrame, html: str, keep: list[str]) -> DataFrame:
    """Links of each page in order: (``keep``, link_no, href, link_text)."""
    seen = F.regexp_replace(html, UNSEEN_HTML, "")
    anchors = F.arrays_zip(
        F.regexp_extract_all(seen, F.lit(ANCHOR), F.lit(1)).alias("head"),
        F.regexp_extract_all(seen, F.lit(ANCHOR), F.lit(2)).alias("body"),
    )
    found = pages.select(*keep, F.posexplode(anchors).alias("link_no", "_a"))
    has_href = F.col("_a.head").rlike(HREF)
    href = F.concat(*[F.regexp_extract("_a.head", HREF, k) for k in (1, 2, 3)])
    text = F.regexp_replace(F.col("_a.body"), "<[^>]*>", "")
    return found.where(has_href).select(
        *keep, "link_no", _plain(href).alias("href"), _plain(text).alias("link_text")
    )


def report_links(
    links: DataFrame, title: str, suffix: str = REPORT_SUFFIX, site: str = REPORT_SITE
) -> DataFrame:
    """Links whose text holds ``title`` and whose target ends with ``suffix``."""
    return links.where(F.col("link_text").contains(title) & F.col("href").endswith(suffix)).withColumns(
        {
            "report_url": F.when(F.col("href").startswith("http"), F.col("href")).otherwise(
                F.concat(F.lit(site), F.col("href"))
            ),
            "file_name": file_name("href"),
        }
    )


def new_links(
    links: DataFrame,
    raw: DataFrame,
    archived: DataFrame,
    folder: str,
    suffix: str = REPORT_SUFFIX,
    path: str = "path",
) -> DataFrame:
    """Links whose file is neither in the raw nor in the archived listing.

    A listed path counts when it starts with the key of the file.
    """
    inside = F.when(
        F.col(path).startswith("archived/"), F.substring(path, F.lit(10), F.length(path))
    )
    listing = stack([raw.select(path), archived.select(inside.alias(path)).dropna()])
    keyed = links.withColumn("file_key", F.concat(F.lit(f"{folder}/"), F.col("file_name")))
    return drop_prefixed(keyed, "file_key", listing, path, suffix)
