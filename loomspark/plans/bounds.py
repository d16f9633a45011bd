"""Size checks in front of everything that leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F


class TooLarge(ValueError):
    """A side that has to be small is not."""


def collect_bounded(df: DataFrame, max_rows: int, what: str) -> list[Row]:
    """Collect a side whose size is checked first; never more than ``max_rows`` rows travel."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise TooLarge(f"{what}: more than {max_rows} rows")
    return rows


def fits(df: DataFrame, max_rows: int) -> bool:
    return df.limit(max_rows + 1).count() <= max_rows


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores when a scan gives fewer partitions than there are cores.

    Large inputs already have more partitions than cores and pass through without
    a shuffle; only a small file in one piece is redistributed by ``keys``.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= want else df.repartition(want, *[F.col(k) for k in keys])


#: Rows that a task gets, about, where each of them becomes many.
DEALT_ROWS = 50_000


def dealt(df: DataFrame, *keys: str, rows: int = DEALT_ROWS) -> DataFrame:
    """Rows dealt out by ``keys`` to tasks of about ``rows`` each, as many as the table needs.

    What is made of the rows stays in these tasks as far as it is grouped by ``keys``, so slim rows are shuffled, not what they become.
    """
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows))
    return df.repartition(tasks, *[F.col(k) for k in keys])


def checked(df: DataFrame, bad, message: str) -> DataFrame:
    """``df``, failing while it is computed when a row satisfies ``bad``; costs no pass of its own."""
    return df.filter(F.when(bad, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))


def require(df: DataFrame, bad, message: str) -> DataFrame:
    """Fail at once when any row of a small table satisfies ``bad``; otherwise return ``df`` unchanged."""
    hit = df.filter(bad).limit(1).count()
    if hit:
        raise ValueError(message)
    return df
