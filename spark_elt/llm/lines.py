"""Repeated lines of a site, by the share of its pages that contain them.

For every host the distinct lines of its pages are counted; a line on more than
``ratio`` of the host's pages is boilerplate there and is dropped from them. Only
(host, line hash) pairs are shuffled, aggregated before; the texts stay in place. A host
has less than (distinct lines per page) / ``ratio`` boilerplate lines, so its list is
small however many pages it has. The lists are stored and measured: up to
``BROADCAST_LINES`` lines they are broadcast, beyond it they join the pages by host, in a
join whose hot hosts can be split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

RATIO = 0.1
LEAST_PAGES = 5
BROADCAST_LINES = 500_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """The boilerplate lines of each host: ``host`` and ``lines`` (their hashes)."""
    pages = docs.select(F.col(host).alias("host"), F.col("text").cast("string").alias("text"))
    totals = pages.groupBy("host").agg(F.count("*").alias("pages"))
    hashes = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    held = (
        pages.select("host", F.explode(hashes).alias("line"))
        .groupBy("host", "line").agg(F.count("*").alias("n")).where(F.col("n") >= least_pages)
    )
    common = held.join(totals.withColumnRenamed("host", "h"), F.col("host").eqNullSafe(F.col("h")))
    return common.where(F.col("n") > ratio * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("lines"))


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``docs`` without the boilerplate lines of their hosts: all its columns, ``text``
    changed, and ``n_chars`` set to the new length where there is such a column.

    A line counts once per page and is the same if its characters are; blank lines are
    never counted or dropped. Hosts where a line is on fewer than ``least_pages`` pages
    keep it. A page of boilerplate lines only is a copied page and stays as it is.
    A null text stays null, an empty one empty; pages without host are one host.
    Repeated rows count as pages each. An empty table gives no rows.
    """
    lists = settle(boilerplate(docs, host, ratio, least_pages).select(F.col("host").alias("__host"), F.col("lines").alias("__lines")))
    if (lists.agg(F.sum(F.size("__lines"))).first()[0] or 0) <= BROADCAST_LINES:
        lists = F.broadcast(lists)
    own = _lines(F.col("text").cast("string"))
    left = F.filter(own, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("__lines"), F.xxhash64(x)))
    some = F.exists(left, lambda x: F.trim(x) != "")
    joined = docs.join(lists, F.col(host).eqNullSafe(F.col("__host")), "left")
    joined = joined.withColumn("__left", F.when(F.col("__lines").isNotNull(), F.when(some, left)))
    changed = joined.withColumn("text", F.when(F.col("__left").isNull(), F.col("text")).otherwise(F.array_join("__left", "\n")))
    length = F.length("text")
    return changed.select(*(length.cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """What ``drop_boilerplate`` leaves of each page: ``doc_id``, ``n_lines`` before,
    ``n_dropped``, and ``kept_md5`` of the text after (nulls count as empty)."""
    before = docs.select(
        "doc_id", F.col(host).alias("host"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.size(_lines(F.coalesce(F.col("text").cast("string"), F.lit("")))).cast("long").alias("n_lines"),
    )
    after = drop_boilerplate(before, "host", ratio, least_pages)
    return after.select(
        "doc_id", "n_lines", (F.col("n_lines") - F.size(_lines(F.col("text")))).alias("n_dropped"), F.md5("text").alias("kept_md5")
    )


ORACLE = f"""
WITH pages AS (
  SELECT row_number() OVER () AS r, doc_id, source AS host, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), held AS (
  SELECT DISTINCT r, host, line FROM (SELECT r, host, unnest(lines) AS line FROM pages) WHERE trim(line, ' ') <> ''
), common AS (
  SELECT host, line FROM held GROUP BY host, line
  HAVING count(*) >= {LEAST_PAGES} AND count(*) > {RATIO} * (SELECT count(*) FROM pages p WHERE p.host IS NOT DISTINCT FROM held.host)
), numbered AS (
  SELECT r, host, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM pages
), marked AS (
  SELECT n.r, n.line, n.pos, c.line IS NOT NULL AS gone, trim(n.line, ' ') <> '' AND c.line IS NULL AS stays
  FROM numbered n LEFT JOIN common c ON n.host IS NOT DISTINCT FROM c.host AND n.line = c.line
), left_over AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_gone, bool_or(stays) AS has_own,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS cut, string_agg(line, chr(10) ORDER BY pos) AS whole
  FROM marked GROUP BY r
)
SELECT doc_id, n_lines, CASE WHEN has_own THEN n_gone ELSE 0 END AS n_dropped, md5(CASE WHEN has_own THEN cut ELSE whole END) AS kept_md5
FROM left_over JOIN pages USING (r)
"""
