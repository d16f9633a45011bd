"""Quality rules: base figures of a document, and lines that too many documents of its host share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import BLANK, words
from loomspark.llm.site_lines import SQL, document_counts, hashed, host_sizes, lines_of
from loomspark.plans.scratch import written

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A line is over the limits if more documents of its host hold it than both the number and the share.
MAX_DOCS = 10
MAX_SHARE_PERCENT = 10
#: A document is depleted if less than this share of its words is left.
MIN_LEFT_PERCENT = 30


def base_figures(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of the whole text.

    Windows of three words are compared by a 64-bit hash.  A document without a repeated window is done after one
    pass; for others hashes and places are sorted together, and the repeated places say how many words they cover.
    """
    raw = F.coalesce(F.col(text), F.lit(""))
    kept = docs.columns
    out = docs.withColumn("__words", words(F.col(text)))
    spots = F.when(F.size("__words") >= 3, F.sequence(F.lit(0), F.size("__words") - 3)).otherwise(F.array().cast("array<int>"))
    window = lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(3)])
    out = out.withColumn("__windows", F.transform(spots, window))
    repeats = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    out = out.withColumn("__sorted", F.when(repeats, F.sort_array(placed)).otherwise(F.array().cast("array<struct<h:bigint,at:int>>")))
    beside = lambda x, j: F.coalesce(F.get("__sorted", j)["h"] == x["h"], F.lit(False))
    twice = F.filter("__sorted", lambda x, j: beside(x, j - 1) | beside(x, j + 1))
    out = out.withColumn("__places", F.sort_array(F.transform(twice, lambda x: x["at"])))
    cover = F.transform("__places", lambda p, j: F.least(F.lit(3), F.coalesce(F.get("__places", j + 1) - p, F.lit(3))))
    worded = F.filter(lines_of(F.col(text)), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("__lines", worded)
    return out.select(
        *kept,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.regexp_replace(raw, BLANK, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(raw, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.aggregate(cover, F.lit(0).cast("long"), lambda a, x: a + x).alias("n_repeat_words"),
    )


def common_lines(docs: DataFrame, text: str, host: str) -> DataFrame:
    """(host, line) over the limits, as a written table whose size the planner knows."""
    counts = document_counts(docs, text, host).filter(F.col("n_docs") > MAX_DOCS)
    over = counts.join(host_sizes(docs, text, host), "host").filter(F.col("n_docs") * 100 > F.col("host_docs") * MAX_SHARE_PERCENT)
    return written(over.select("host", "line"), "common-lines")


def judge(docs: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, host, text_hash, the base figures, n_removed_words, base_failed and kept of each row of ``docs``.

    Null and empty texts have no words and fail; a null host is one host of its own; null ids stay; rows that
    repeat are documents like others and each give a row; lines that tie with a limit stay; an empty table gives an
    empty table; other columns are not read, whatever their names.  One row and some short line rows go through
    the shuffles, never a text.  The lines over the limits are joined by size: broadcast while small, else by a
    shuffle whose skew adaptive execution splits.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(text).alias("text_hash"),
        F.col(text).alias("text"),
    )
    figures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    based = base_figures(rows).withColumn("lines", F.array_append(hashed(F.col("text")), F.struct(F.lit(None).cast("binary").alias("line"), F.lit(0).alias("words"))))
    keys = ["doc_id", "host", "text_hash"]
    each = based.select(*keys, *figures, F.explode_outer("lines").alias("x")).select(*keys, *figures, "x.line", "x.words")
    common = common_lines(docs, text, host).withColumn("over", F.lit(True))
    marked = each.join(common, ["host", "line"], "left")
    # The row without a line that each document has says how many documents share the key.
    summed = marked.groupBy(*keys).agg(
        *[F.first(f).alias(f) for f in figures],
        F.coalesce(F.sum(F.when(F.col("over"), F.col("words"))), F.lit(0)).cast("long").alias("n_removed_words"),
        F.count(F.when(F.col("line").isNull(), 1)).cast("int").alias("times"),
    )
    removed = F.floor(F.col("n_removed_words") / F.col("times")).cast("long")
    out = summed.select(*keys, *figures, removed.alias("n_removed_words"), F.explode_outer(F.array_repeat(F.lit(0), F.col("times"))).alias("__time")).drop("__time")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    depleted = (F.col("n_words") - F.col("n_removed_words")) * 100 < F.col("n_words") * MIN_LEFT_PERCENT
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


ORACLE = (
    SQL
    + rf""",
over AS (SELECT host, h FROM counts JOIN sizes USING (host) WHERE n_docs > {MAX_DOCS} AND n_docs * 100 > host_docs * {MAX_SHARE_PERCENT}),
removed AS (SELECT doc_id, sum(words)::BIGINT AS n FROM hl JOIN over USING (host, h) GROUP BY doc_id),
w AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
tri AS (SELECT doc_id, unnest(range(1, len(ws) - 1)) AS p, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS t FROM w),
rep AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, t) AS c FROM tri) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM rep, range(3) AS r(k) GROUP BY doc_id),
dup AS (SELECT doc_id, (count(*) - count(DISTINCT line))::BIGINT AS n FROM hl GROUP BY doc_id),
figures AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(dup.n, 0)::BIGINT AS n_dup_lines,
    coalesce(cov.n, 0)::BIGINT AS n_repeat_words, coalesce(removed.n, 0)::BIGINT AS n_removed_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN cov USING (doc_id) LEFT JOIN removed USING (doc_id)),
judged AS (SELECT *, n_words < {MIN_WORDS} OR n_repeat_words * 100 > n_words * {MAX_REPEAT_PERCENT} AS base_failed FROM figures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_removed_words, base_failed,
  NOT base_failed AND NOT (n_words - n_removed_words) * 100 < n_words * {MIN_LEFT_PERCENT} AS kept FROM judged"""
)
