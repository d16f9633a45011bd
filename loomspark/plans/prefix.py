"""Running sums and neighbours without one task per key.

A plain ``Window.partitionBy(key).orderBy(pos)`` puts a whole key in one task.
Here a key is cut in blocks of ``width`` consecutive positions; each block is a window
of its own, and only one total per block goes to the next level.  Position columns are
integers, at least 0 and unique within a key, so no block holds more than ``width`` rows.

Without a key the positions may be anything that sorts, hashed or string ids too: the rows are dealt out in ranges of their
order, and one total per range goes to the next level.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.plans.lineage import cut

WIDTH = 65_536


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Mapping[str, Column],
    *,
    inclusive: bool = True,
    width: int = WIDTH,
    levels: int = 1,
    tie: str | None = None,
) -> DataFrame:
    """Add one running sum per entry of ``sums`` (name -> value column).

    ``tie`` orders rows that share a position.  One level leaves ``rows / width`` block totals per key to a single window; ``levels=2`` cuts those again.
    """
    keys = list(keys)
    names = list(sums)
    if not keys:
        return _ranged(df, [order, *([tie] if tie else [])], sums, inclusive)
    src = df
    for n in names:
        src = src.withColumn(f"__v_{n}", sums[n])
    src = src.withColumn("__blk", F.floor(F.col(order) / F.lit(width)).cast("long"))
    out = _scan(src, keys, order, names, inclusive, width, levels, tie)
    return out.drop("__blk", *[f"__v_{n}" for n in names])


def _ranged(df, order, sums, inclusive):
    """Running sums over all rows, in ranges of ``order``; the ranges are written, so that both passes see the same ones."""
    names = list(sums)
    values = df.withColumns({f"__v_{n}": sums[n] for n in names})
    rows = cut(values.repartitionByRange(*[F.col(c) for c in order]).withColumn("__part", F.spark_partition_id()))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    totals = rows.groupBy("__part").agg(*[F.sum(f"__v_{n}").alias(f"__t_{n}") for n in names])
    offs = totals.select("__part", *[F.coalesce(F.sum(f"__t_{n}").over(before), F.lit(0).cast("long")).alias(f"__o_{n}") for n in names])
    local = rows.withColumns({f"__l_{n}": F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0).cast("long")) for n in names})
    out = local.join(F.broadcast(offs), "__part").withColumns({n: F.col(f"__l_{n}") + F.col(f"__o_{n}") for n in names})
    return out.drop("__part", *[f"__{k}_{n}" for n in names for k in "vlo"])


def _scan(src, keys, order, names, inclusive, width, levels, tie=None):
    start, stop = Window.unboundedPreceding, 0 if inclusive else -1
    inside = Window.partitionBy(*keys, "__blk").orderBy(order, *([tie] if tie else [])).rowsBetween(start, stop)
    out = src
    for n in names:
        out = out.withColumn(n, F.coalesce(F.sum(f"__v_{n}").over(inside), F.lit(0).cast("long")))
    totals = src.groupBy(*keys, "__blk").agg(*[F.sum(f"__v_{n}").alias(f"__v_{n}") for n in names])
    if levels > 1:
        upper = totals.withColumnRenamed("__blk", "__ord").withColumn(
            "__blk", F.floor(F.col("__ord") / F.lit(width)).cast("long")
        )
        offs = _scan(upper, keys, "__ord", [f"{n}" for n in names], False, width, levels - 1)
        offs = offs.select(*keys, F.col("__ord").alias("__blk"), *[F.col(n).alias(f"__o_{n}") for n in names])
    else:
        # Top level: one row per width**(levels+1) positions and key.
        before = Window.partitionBy(*keys).orderBy("__blk").rowsBetween(Window.unboundedPreceding, -1)
        offs = totals.select(
            *keys,
            "__blk",
            *[F.coalesce(F.sum(f"__v_{n}").over(before), F.lit(0).cast("long")).alias(f"__o_{n}") for n in names],
        )
    joined = out.join(offs, [*keys, "__blk"])
    for n in names:
        joined = joined.withColumn(n, F.col(n) + F.col(f"__o_{n}"))
    return joined.drop(*[f"__o_{n}" for n in names])


def dense_index(df: DataFrame, order: str, *, name: str = "idx", width: int = WIDTH) -> DataFrame:
    """Rank of each row by a unique id, from 0, without a sort in one place."""
    return running_sums(df, [], order, {name: F.lit(1).cast("long")}, inclusive=False, width=width)


def neighbour(df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], step: int = -1) -> DataFrame:
    """Columns ``prev_*`` / ``next_*`` of the row ``step`` places away.

    Positions are dense per key, so this is an equi-join on (key, position): it spreads
    one huge key over all tasks, where ``lag`` would keep it in one.
    """
    tag = "prev" if step < 0 else "next"
    other = df.select(*keys, (F.col(order) - step).alias(order), *[F.col(c).alias(f"{tag}_{c}") for c in cols])
    return df.join(other, [*keys, order], "left")
