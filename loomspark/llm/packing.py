"""Batches of rows of similar length.

A histogram of all lengths is enough to choose the buckets that minimise padding: a dynamic programme over it picks the upper bounds.
Inside each bucket rows are cut into batches that stay within a token budget when every row is padded to the bucket's bound.
"""

from __future__ import annotations

from array import array

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import ranked, words
from loomspark.plans.scratch import written

BUCKETS = 8
BUDGET = 16_384


def bounds(histogram: list[tuple[int, int]], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets that minimise the padded total; of equal choices the lowest bounds.

    With rows sorted by length a bucket is a run of lengths, and its cost is its longest length times its rows.  For a number
    of buckets the best cost up to a length is the lower envelope of lines (one for each end of the bucket before)
    at that length, walked along once since slopes fall and lengths rise.
    """
    lengths = sorted(histogram)
    upto = [0]
    for _, n in lengths:
        upto.append(upto[-1] + n)
    size = len(lengths)
    cost: list[int | None] = [0] + [None] * size
    backs: list[array] = []
    for _ in range(min(buckets, size)):
        new: list[int | None] = [None] * (size + 1)
        back = array("l", [0]) * (size + 1)
        hull: list[tuple[int, int, int]] = []  # slope, start, end of the bucket before
        at = 0
        for j in range(1, size + 1):
            if cost[j - 1] is not None:
                line = (-upto[j - 1], cost[j - 1], j - 1)
                while len(hull) - at >= 2 and _useless(hull[-2], hull[-1], line):
                    hull.pop()
                hull.append(line)
            x = lengths[j - 1][0]
            while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] < hull[at][0] * x + hull[at][1]:
                at += 1
            if hull:
                new[j] = hull[at][0] * x + hull[at][1] + x * upto[j]
                back[j] = hull[at][2]
        backs.append(back)
        cost = new
        if cost[size] is None:
            break
    out, j = [], size
    for back in reversed(backs):
        if j == 0:
            break
        out.append(lengths[j - 1][0])
        j = back[j]
    return sorted(out)


def _useless(a: tuple, b: tuple, c: tuple) -> bool:
    """Whether line ``b`` is nowhere below both ``a`` (steeper to the left) and ``c``."""
    return (c[1] - a[1]) * (a[0] - b[0]) <= (b[1] - a[1]) * (a[0] - c[0])


def pack(docs: DataFrame, length: Column, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_tokens, bucket (from 0), bucket_len, batch (from 0 in each bucket) and place (in the batch) of each row of ``docs``.

    ``length`` is the number of tokens of a row; null counts as 0.  Rows are never cut or dropped: one that is longer than the budget
    is a batch of its own.  Order within a bucket is by length, id (null first) and a hash of the text; rows equal in all three
    are interchangeable.  An empty table gives an empty table; other columns are not read.  The driver sees the histogram
    only, one entry for each length that occurs: d different lengths need d * (d - 1) / 2 tokens at least, so ten billion
    tokens have under 150,000 of them.  Buckets of any size are ranked over all tasks.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("__hash"))
    rows = written(rows, "lengths")  # texts are read once
    histogram = [tuple(r) for r in rows.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()]
    tops = bounds(histogram, buckets) or [0]
    limit = F.array(*[F.lit(t).cast("long") for t in tops])
    bucket = F.size(F.filter(limit, lambda t: t < F.col("n_tokens")))
    placed = ranked(rows.withColumn("bucket", bucket), ["bucket", "n_tokens", "doc_id", "__hash"], "rank", "packed", within=["bucket"])
    bucket_len = F.element_at(limit, F.col("bucket") + 1)
    fits = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(F.lit(1), F.col("bucket_len")))).cast("long")
    out = placed.withColumn("bucket_len", bucket_len).withColumn("__fits", fits)
    return out.select("doc_id", "n_tokens", "bucket", "bucket_len", F.floor(F.col("rank") / F.col("__fits")).cast("long").alias("batch"), (F.col("rank") % F.col("__fits")).alias("place"))


def word_length(text: str = "text") -> Column:
    return F.size(words(F.col(text)))


def _layers() -> str:
    """DuckDB: best cost up to each length with 1 to BUCKETS buckets, and where the last of them begins."""
    parts = ["d0 AS (SELECT 0::BIGINT AS j, 0::HUGEINT AS cost)"]
    for k in range(1, BUCKETS + 1):
        parts.append(
            f"d{k} AS (SELECT p.j, min(d.cost + p.len::HUGEINT * (p.c - coalesce(q.c, 0))) AS cost, arg_min(d.j, (d.cost + p.len::HUGEINT * (p.c - coalesce(q.c, 0))) * 1000000 + d.j) AS i "
            f"FROM pre p JOIN d{k - 1} d ON d.j < p.j LEFT JOIN pre q ON q.j = d.j GROUP BY p.j)"
        )
    return ",\n".join(parts)


def _path() -> str:
    """DuckDB: the ends of the chosen buckets, from the last; with fewer lengths than buckets every length is one."""
    steps = [f"e{BUCKETS} AS (SELECT max(j) AS j FROM pre)"]
    for k in range(BUCKETS, 1, -1):
        steps.append(f"e{k - 1} AS (SELECT d{k}.i AS j FROM d{k} JOIN e{k} USING (j) WHERE d{k}.i > 0)")
    ends = " UNION ALL ".join(f"SELECT j FROM e{k}" for k in range(1, BUCKETS + 1))
    return ",\n".join(steps) + f",\ntops AS (SELECT len AS top FROM pre WHERE (SELECT count(*) FROM pre) <= {BUCKETS} OR j IN ({ends}))"


ORACLE = rf"""WITH n AS (SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))::BIGINT AS n_tokens FROM documents),
h AS (SELECT n_tokens AS len, count(*) AS n FROM n GROUP BY 1),
pre AS (SELECT len, row_number() OVER (ORDER BY len) AS j, (sum(n) OVER (ORDER BY len))::HUGEINT AS c FROM h),
{_layers()},
{_path()},
tt AS (SELECT top, (row_number() OVER (ORDER BY top) - 1)::INTEGER AS bucket FROM tops),
b AS (SELECT doc_id, n_tokens, min(bucket) AS bucket, min(top) AS bucket_len FROM n JOIN tt ON top >= n_tokens GROUP BY doc_id, n_tokens),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY n_tokens, doc_id) - 1 AS rank, greatest(1, {BUDGET} // greatest(1, bucket_len)) AS fits FROM b)
SELECT doc_id, n_tokens, bucket, bucket_len, (rank // fits)::BIGINT AS batch, (rank % fits)::BIGINT AS place FROM r"""
