"""Lines of a site: how many of its documents hold each line.

A document counts once for a line, and exact copies of a document count as one: documents of a host with the same text are
one document, for a line and for the host alike.  A page that was copied a thousand times does not make its own lines look
like boilerplate this way, while a line that stands in many different documents does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import BLANK, words

#: A line has a word.
HAS_WORD = r"[^\x20\x09-\x0D]"


def normal(line: Column) -> Column:
    """Lower case, runs of blanks as one space, none at the ends."""
    return F.lower(F.trim(F.regexp_replace(line, BLANK, " ")))


def line_hash(line: Column) -> Column:
    """First 64 bits of the MD5 of the normalised line."""
    return F.unhex(F.substring(F.md5(normal(line)), 1, 16))


def lines_of(text: Column) -> Column:
    """All lines of a text, ``\\n`` apart; null has none."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed(text: Column) -> Column:
    """(line, words) for each line with a word, repeats included."""
    worded = F.filter(lines_of(text), lambda x: x.rlike(HAS_WORD))
    return F.transform(worded, lambda x: F.struct(line_hash(x).alias("line"), F.size(words(x)).alias("words")))


def host_of(host: str) -> Column:
    """A null host is the host of those without one."""
    return F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")).alias("host")


def document_of(text: str) -> Column:
    """What copies of a document share: a hash of its whole text."""
    return F.coalesce(F.xxhash64(F.col(f"`{text}`")), F.lit(0)).alias("document")


def document_counts(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(host, line, n_docs) of every line of every host: its different documents.

    Distinct documents are counted in two steps, so a line that a whole site shares is summed before it is dealt out
    and no task gets all its documents.
    """
    worded = F.filter(lines_of(F.col(f"`{text}`")), lambda x: x.rlike(HAS_WORD))
    first = docs.select(host_of(host), document_of(text), F.array_distinct(F.transform(worded, line_hash)).alias("hashes"))
    # The outer form, here as in the other operators: for a plain explode the planner adds a filter that works out the whole array once more.
    each = first.select("host", "document", F.explode_outer("hashes").alias("line")).filter("line IS NOT NULL")
    return each.groupBy("host", "line", "document").agg(F.lit(1).alias("__one")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n_docs"))


def host_sizes(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(host, host_docs): different documents of a host, counted in two steps too."""
    return docs.select(host_of(host), document_of(text)).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))


# The same for DuckDB, over a table ``documents``; line hashes are hexadecimal there.
SQL = r"""WITH ls AS (SELECT doc_id, coalesce(source, '') AS host, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS idx FROM documents),
hl AS (SELECT doc_id, host, idx, line, len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words,
    left(md5(lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')))), 16) AS h
  FROM ls WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
units AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(md5(text), '') AS unit FROM documents),
counts AS (SELECT hl.host, h, count(DISTINCT unit) AS n_docs FROM hl JOIN units USING (doc_id) GROUP BY hl.host, h),
sizes AS (SELECT host, count(DISTINCT unit) AS host_docs FROM units GROUP BY host)"""
