"""A uniform shuffle into shards of exact size.

How many rows of each input partition go to each shard is drawn at once, as the contingency table that a uniform
permutation would give (multivariate hypergeometric, row by row).  Each partition is then permuted on its own and dealt
out by its row of the table, the rows are exchanged, and each shard is permuted again.
"""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.llm.common import ranked
from loomspark.plans.scratch import written

SHARDS = 24
SEED = 20_240_601
#: A table of counts up to this size is broadcast; a larger one is shuffled.
BROADCAST_BYTES = 32 << 20


def shard_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart, the larger first."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _stirling(n: int) -> float:
    """ln n! less Stirling's formula for it."""
    if n < 16:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi) if n else 0.0
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / n**2) / n**2) / n**2) / n


def _deviance(x: int, mean: float) -> float:
    """x ln(x / mean) + mean - x without the difference of large numbers."""
    if abs(x - mean) < 0.1 * (x + mean):
        v = (x - mean) / (x + mean)
        total, term, j = (x - mean) * v, 2 * x * v, 1
        while True:
            term *= v * v
            more = total + term / (2 * j + 1)
            if more == total:
                return total
            total, j = more, j + 1
    return x * math.log(x / mean) + mean - x


def _binomial(x: int, n: int, p: float) -> float:
    """ln of the chance of x of n; exact to the digits of a double, however large n is."""
    if x == 0 or x == n:
        return n * (math.log1p(-p) if x == 0 else math.log(p)) if n else 0.0
    error = _stirling(n) - _stirling(x) - _stirling(n - x) - _deviance(x, n * p) - _deviance(n - x, n * (1 - p))
    return error + 0.5 * (math.log(n) - math.log(2 * math.pi) - math.log(x) - math.log(n - x))


def hypergeometric(good: int, bad: int, draws: int, rng: random.Random) -> int:
    """How many of ``draws`` from ``good + bad`` are good: outwards from the mode until the drawn mass is reached.

    The mode's chance is a quotient of binomial ones (all three with the share drawn), so it keeps the digits of a double for
    any number of rows; those beside it follow by factors.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low == high:
        return low
    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    share = draws / (good + bad)
    p = math.exp(_binomial(mode, good, share) + _binomial(draws - mode, bad, share) - _binomial(draws, good + bad, share))
    left = rng.random() - p
    down = up = mode
    p_down = p_up = p
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


#: Rows up to which the library draws a row of the table at once.
LIBRARY_ROWS = 10**9


def communication_matrix(counts: list[int], sizes: list[int], seed: int, library_rows: int = LIBRARY_ROWS) -> list[list[int]]:
    """Rows from each partition to each shard; row sums are ``counts``, column sums ``sizes``.

    The law is that of a uniform permutation whichever of the two samplers draws.
    """
    fast, exact = np.random.default_rng(seed), random.Random(seed)
    room = list(sizes)
    out = []
    for n in counts:
        if sum(room) < library_rows:
            row = [int(x) for x in fast.multivariate_hypergeometric(np.array(room, np.int64), n, method="marginals")] if n else [0] * len(room)
        else:
            row, rest, draws = [], sum(room), n
            for size in room:
                rest -= size
                take = hypergeometric(size, rest, draws, exact)
                row.append(take)
                draws -= take
        room = [a - b for a, b in zip(room, row)]
        out.append(row)
    return out


def shuffle(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``docs`` with shard (int) and slot (long, from 0 without gaps within a shard); columns of these names are replaced.

    Every row is dealt out whatever it holds: nulls, empty and long texts, rows that repeat.  Sizes of shards are at
    most one apart.  An empty table gives an empty table.  The rows are written once to the shared folder, so that partitions and the
    order in them are the same for every later step and after a lost executor; places are worked out on row numbers
    alone and meet the rows in one shuffle.  The table of counts has a row for each partition and is all the driver holds.
    """
    docs = docs.drop(*{"shard", "slot"} & set(docs.columns))
    rows = docs.withColumn("__part", F.spark_partition_id()).withColumn("__row", F.monotonically_increasing_id())
    rows = written(rows, "rows")
    counts = sorted((r["__part"], r["n"]) for r in rows.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect())
    matrix = communication_matrix([n for _, n in counts], shard_sizes(sum(n for _, n in counts), shards), seed)
    ends = [(part, [int(x) for x in np.cumsum(row)]) for (part, _), row in zip(counts, matrix)]
    table = docs.sparkSession.createDataFrame(ends, "__part int, __ends array<long>")
    table = F.broadcast(table) if 8 * len(ends) * shards <= BROADCAST_BYTES else table
    numbers = rows.select("__part", "__row")
    local = Window.partitionBy("__part").orderBy(F.xxhash64(F.lit(seed), "__row"), "__row")
    placed = numbers.withColumn("__place", F.row_number().over(local) - 1).join(table, "__part")
    dealt = placed.select("__row", F.size(F.filter("__ends", lambda e: e <= F.col("__place"))).alias("shard"), F.xxhash64(F.lit(seed + 1), "__row").alias("__again"))
    slots = ranked(dealt, ["shard", "__again", "__row"], "slot", "dealt", within=["shard"])
    return rows.join(slots.select("__row", "shard", "slot"), "__row").drop("__part", "__row")


def write_shards(shuffled: DataFrame, path: str) -> None:
    """One folder for each shard, rows in order of their slots, files cut by ranges of slots."""
    shuffled.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
