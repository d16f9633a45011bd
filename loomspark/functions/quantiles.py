"""Exact quantiles without sorting a column in one place."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BINS = 4_096
DIRECT = 50_000


def _order_statistics(rows: DataFrame, col: str, lo: float, hi: float, ranks: Sequence[int], count: float = math.inf) -> dict[int, float]:
    """The values at the given 0-based ranks of a column of finite numbers.

    Each pass counts rows in equal-width bins of the intervals that hold a rank, all intervals in one job, and keeps the
    bins the ranks fall in.  It ends when the intervals hold one value each or few rows together; only bin counts and
    those few rows reach the driver.
    """
    x = F.col(col)
    found: dict[int, float] = {}
    # (first value, last value) -> ranks inside, counted from the first row of the interval
    todo, left = {(lo, hi): {r: r for r in ranks}}, count
    while todo:
        for (a, b), inside in list(todo.items()):
            if a == b:
                found.update(dict.fromkeys(inside, a))
                del todo[(a, b)]
        if not todo:
            break
        spans = list(todo)
        which = F.when(F.lit(False), F.lit(0))
        for i, (a, b) in enumerate(spans):
            which = which.when((x >= a) & (x <= b), i)
        tagged = rows.select(x.alias("x"), which.alias("i")).filter("i IS NOT NULL")
        if left <= DIRECT:
            values: dict[int, list] = {}
            for r in tagged.collect():
                values.setdefault(r.i, []).append(r.x)
            for i, span in enumerate(spans):
                xs = sorted(values[i])
                found.update({r: xs[k] for r, k in todo[span].items()})
            break
        start = F.element_at(F.array(*[F.lit(a) for a, _ in spans]), F.col("i") + 1)
        # Halves first: the difference of two finite numbers may not be one.  A width that comes out as 0 belongs to an interval of
        # fewer numbers than bins, and each of them is a bin of its own.
        widths = [b / BINS - a / BINS for a, b in spans]
        width = F.element_at(F.array(*[F.lit(w or 1.0) for w in widths]), F.col("i") + 1)
        place = F.least(F.floor(F.col("x") / width - start / width), F.lit(BINS - 1)).cast("double")
        tiny = F.col("i").isin([i for i, w in enumerate(widths) if not w or any(math.isinf(v / w) for v in spans[i])])
        bins = tagged.groupBy("i", F.when(tiny, F.col("x")).otherwise(place).alias("bin")).agg(
            F.count("*").alias("n"), F.min("x").alias("a"), F.max("x").alias("b")
        )
        counted = sorted(bins.collect(), key=lambda r: (r.i, r.a))
        nxt: dict = {}
        left = 0
        for i, span in enumerate(spans):
            seen = 0
            for row in (r for r in counted if r.i == i):
                hit = {r: k - seen for r, k in todo[span].items() if seen <= k < seen + row.n}
                if hit:
                    nxt[(row.a, row.b)] = hit
                    left += row.n
                seen += row.n
        todo = nxt
    return found


def exact_quantiles(df: DataFrame, fractions: Mapping[str, Sequence[float]]) -> dict[str, list[float]]:
    """Quantiles of several columns, with linear interpolation on ``fraction * (n - 1)``; nulls do not count.

    The order is minus infinity, the finite numbers, infinity, NaN, for any number of rows; only finite numbers are searched.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in fractions]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = rows.agg(*[f for c in fractions for f in _extent(c)]).first()
        out = {}
        for c, fs in fractions.items():
            low, fin, high, nan = (stats[f"{c}_{k}"] for k in ("low", "fin", "high", "nan"))
            n = low + fin + high + nan
            if not n:
                out[c] = [math.nan] * len(fs)
                continue
            spots = [f * (n - 1) for f in fs]
            ranks = {int(s) for s in spots} | {min(int(s) + 1, n - 1) for s in spots}
            at = {r: -math.inf if r < low else math.inf if r < low + fin + high else math.nan for r in ranks if not low <= r < low + fin}
            inside = sorted(r - low for r in ranks - set(at))
            if inside:
                finite = rows.select(c).filter(_finite(c))
                found = _order_statistics(finite, c, stats[f"{c}_lo"], stats[f"{c}_hi"], inside, fin)
                at |= {r + low: x for r, x in found.items()}
            out[c] = []
            for s in spots:
                i, part = int(s), s - int(s)
                a, b = at[i], at[min(i + 1, n - 1)]
                out[c].append(a if part == 0 or a == b else (1 - part) * a + part * b)
        return out
    finally:
        rows.unpersist()


def _finite(c: str):
    return ~F.isnan(c) & (F.abs(c) != math.inf)


def _extent(c: str) -> list:
    """Counts of the numbers that are not finite, and count and ends of those that are."""
    x = F.when(_finite(c), F.col(c))
    return [
        F.count_if(F.col(c) == -math.inf).alias(f"{c}_low"), F.count(x).alias(f"{c}_fin"), F.count_if(F.col(c) == math.inf).alias(f"{c}_high"),
        F.count_if(F.isnan(c)).alias(f"{c}_nan"), F.min(x).alias(f"{c}_lo"), F.max(x).alias(f"{c}_hi"),
    ]


SKETCH = 10_000


def grouped_median(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``(keys, median)`` of each group, exact, with no group gathered in one place; keys may be null.

    A sketch with a guaranteed rank error brackets the median; rows below the bracket are counted, and only the distinct
    values inside it, a few thousandths of a group, are ranked.
    """
    rows = df.select(F.to_json(F.struct(*keys)).alias("__k"), *keys, F.col(col).cast("double").alias("x")).filter("x IS NOT NULL")
    near = [0.5 - 2.0 / SKETCH, 0.5 + 2.0 / SKETCH]
    marks = rows.groupBy("__k").agg(F.percentile_approx("x", near, SKETCH).alias("m"), F.count("*").alias("n"))
    # one place further on each side than the sketch can be wrong, and never past the ends
    tagged = rows.join(marks, "__k").select("__k", *keys, "x", "n", F.get("m", F.lit(0)).alias("lo"), F.get("m", F.lit(1)).alias("hi"))
    low = tagged.groupBy("__k").agg(F.count_if(F.col("x") < F.col("lo")).alias("below"), F.first("n").alias("n"))
    inside = tagged.filter((F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi"))).groupBy("__k", *keys, "x").agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy("__k").orderBy("x"))
    ranked = inside.withColumn("upto", upto).join(low, "__k").withColumn("last", F.col("below") + F.col("upto")).withColumn("first", F.col("last") - F.col("c"))
    a, b = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    holds = lambda r: (F.col("first") <= r) & (r < F.col("last"))
    one = lambda r: F.max(F.when(holds(r), F.col("x")))
    return ranked.groupBy("__k", *keys).agg(((one(a) + one(b)) / 2).alias("median")).drop("__k")
