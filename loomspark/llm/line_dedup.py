"""Boilerplate lines by their share of a site's pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.site_lines import HAS_WORD, SQL, document_counts, host_of, host_sizes, line_hash, lines_of
from loomspark.plans.scratch import written

#: A line goes if its pages are more than this share of the host's pages, and it stands on this many pages.
MAX_RATIO_PERCENT = 5
MIN_PAGES = 10


def boilerplate(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(host, line) over the ratio, as a written table whose size the planner knows."""
    counts = document_counts(docs, text, host).filter(F.col("n_docs") >= MIN_PAGES)
    over = counts.join(host_sizes(docs, text, host), "host").filter(F.col("n_docs") * 100 > F.col("host_docs") * MAX_RATIO_PERCENT)
    return written(over.select("host", "line"), "boilerplate")


def drop_lines(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` without its boilerplate lines, and n_lines (with a word) and n_dropped_lines beside it.

    Rows keep all their columns, whatever their names; of columns named n_lines or n_dropped_lines, in any case of letters, the new
    ones stay.  A null text stays null and has no lines; an empty one and one without boilerplate stay as they are, and
    so does a line that ties with the ratio; a null host is one host of its own; null ids are a key like others; rows
    that repeat are each cleaned alike and, as copies, count as one page; an empty table gives an empty table.  Texts are
    shuffled once, by row; a site of any size is spread.
    """
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped_lines")]
    body = F.col(f"row.`{text}`")
    rows = docs.select(
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(-(1 << 63))).alias("id"),
        host_of(host),
        F.coalesce(F.xxhash64(F.col(f"`{text}`")), F.lit(0)).alias("hash"),
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),  # own columns cannot clash with those inside
    )
    keys = ["id", "host", "hash"]
    numbered = F.transform(lines_of(body), lambda x, i: F.struct(i.alias("at"), F.when(x.rlike(HAS_WORD), line_hash(x)).alias("line")))
    each = rows.select(*keys, numbered.alias("x")).select(*keys, F.explode_outer("x").alias("x")).select(*keys, "x.at", "x.line")
    dropped = each.filter("line IS NOT NULL").join(boilerplate(docs, text, host), ["host", "line"]).groupBy(*keys).agg(F.collect_set("at").alias("drop"))
    met = rows.join(dropped, keys, "left")
    worded = F.size(F.filter(lines_of(body), lambda x: x.rlike(HAS_WORD)))
    left = F.array_join(F.filter(lines_of(body), lambda x, i: ~F.array_contains("drop", i)), "\n")
    cleaned = F.when(F.col("drop").isNull(), body).otherwise(left)
    return met.select(
        *[cleaned.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in names],
        F.when(body.isNull(), 0).otherwise(worded).cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped_lines"),
    )


ORACLE = (
    SQL
    + rf""",
bad AS (SELECT host, h, true AS gone FROM counts JOIN sizes USING (host) WHERE n_docs >= {MIN_PAGES} AND n_docs * 100 > host_docs * {MAX_RATIO_PERCENT}),
marked AS (SELECT ls.doc_id, ls.idx, ls.line, hl.h IS NOT NULL AS worded, coalesce(gone, false) AS gone
  FROM ls LEFT JOIN hl USING (doc_id, idx) LEFT JOIN bad ON bad.host = ls.host AND bad.h = hl.h),
back AS (SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY idx) FILTER (NOT gone), '') AS cleaned, count(*) FILTER (worded) AS n_lines, count(*) FILTER (gone) AS n_dropped_lines
  FROM marked GROUP BY doc_id)
SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE cleaned END AS text, lang, source, n_chars, n_lines, n_dropped_lines FROM documents JOIN back USING (doc_id)"""
)
