"""Decoding filters as operators over tables of candidate distributions.

Rows are ``(dist_id, token_id, logit)``.  A distribution has at most one row per vocabulary entry, so a window per
``dist_id`` is bounded by the vocabulary, and a chain of filters shares one shuffle on ``dist_id``.  Ties go to the
smaller token id.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.plans.bounds import fits

Filter = Callable[[DataFrame], DataFrame]

W_ALL = ("dist_id",)
NEG_INF = float("-inf")
# Natural logarithm of the largest float32: fixed value.
FLOAT_MAX_LOG = 88.7228391
#: Rows of a bias table that is sent to all tasks.
MAX_BIAS = 200_000


def _all() -> Window:
    return Window.partitionBy("dist_id")


def _ranked() -> Window:
    return Window.partitionBy("dist_id").orderBy(F.desc("logit"), "token_id")


def softmax(df: DataFrame) -> DataFrame:
    """Add ``p``."""
    e = F.exp(F.col("logit") - F.max("logit").over(_all()))
    return df.withColumn("__e", e).withColumn("p", F.col("__e") / F.sum("__e").over(_all())).drop("__e")


def temperature(df: DataFrame, t: float) -> DataFrame:
    """Divide by ``t``; at 0 or below only the first maximum keeps its logit."""
    if t > 0:
        return df.withColumn("logit", F.col("logit") / t)
    return _only_first(df, F.lit(True))


def _only_first(df: DataFrame, where: Column) -> DataFrame:
    first = F.row_number().over(_ranked()) == 1
    return df.withColumn("logit", F.when(~where | first, F.col("logit")).otherwise(NEG_INF))


def dynamic_temperature(df: DataFrame, t: float, delta: float, exponent: float = 1.0) -> DataFrame:
    """Temperature between ``t - delta`` and ``t + delta`` by normalised entropy."""
    if delta <= 0:
        return temperature(df, t)
    low, high = max(0.0, t - delta), t + delta
    n = F.count("*").over(_all())
    ent = -F.sum(F.when(F.col("p") > 0, F.col("p") * F.ln("p")).otherwise(0.0)).over(_all())
    share = F.when(n > 1, ent / F.ln(n.cast("double")))
    temp = F.when(n > 1, low + (high - low) * F.pow(F.greatest(share, F.lit(0.0)), F.lit(exponent))).otherwise(1.0)
    hot = softmax(df).withColumn("__t", temp)
    frozen = F.col("__t") <= 0
    cooled = hot.withColumn("logit", F.when(frozen, F.col("logit")).otherwise(F.col("logit") / F.col("__t")))
    return softmax(_only_first(cooled, frozen).drop("__t", "p"))


def top_k(df: DataFrame, k: int) -> DataFrame:
    if k <= 0:
        return df
    return df.withColumn("__r", F.row_number().over(_ranked())).filter(F.col("__r") <= k).drop("__r")


def _rank_and_sum(df: DataFrame, order: Window) -> DataFrame:
    """Rank and probability mass in front of each row."""
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("__r", F.row_number().over(order)).withColumn("__c", F.coalesce(F.sum("p").over(before), F.lit(0.0)))


def top_p(df: DataFrame, p: float, min_keep: int = 0) -> DataFrame:
    """The smallest head whose probability reaches ``p``."""
    if p >= 1:
        return df
    rows = _rank_and_sum(softmax(df), _ranked())
    return rows.filter((F.col("__c") < p) | (F.col("__r") <= max(min_keep, 1))).drop("__r", "__c")


def min_p(df: DataFrame, p: float, min_keep: int = 0) -> DataFrame:
    """Candidates at least ``p`` times as likely as the best."""
    if p <= 0:
        return df
    rows = df.withColumn("__r", F.row_number().over(_ranked())).withColumn("__m", F.max("logit").over(_all()))
    return rows.filter((F.col("logit") >= F.col("__m") + math.log(p)) | (F.col("__r") <= max(min_keep, 1))).drop("__r", "__m")


def typical(df: DataFrame, p: float, min_keep: int = 0) -> DataFrame:
    """Candidates whose surprise is closest to the entropy, until their mass exceeds ``p``."""
    if p >= 1:
        return df
    surprise = F.when(F.col("p") > 0, -F.ln("p"))
    with_h = softmax(df).withColumn("__h", F.sum(F.col("p") * F.coalesce(surprise, F.lit(0.0))).over(_all()))
    shifted = with_h.withColumn("__s", F.coalesce(F.abs(surprise - F.col("__h")), F.lit(float("inf"))))
    order = Window.partitionBy("dist_id").orderBy("__s", "token_id")
    rows = _rank_and_sum(shifted, order)
    return rows.filter((F.col("__c") <= p) | (F.col("__r") <= max(min_keep, 1))).drop("__r", "__c", "__s", "__h")


def _uniform(seed: int) -> Column:
    """A number in [0, 1) from the distribution's id: the same on every run and partitioning."""
    return F.pmod(F.xxhash64("dist_id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))


def xtc(df: DataFrame, probability: float, threshold: float, min_keep: int = 0, seed: int = 0) -> DataFrame:
    """With some probability drop all likely candidates but the least likely of them."""
    if probability <= 0 or threshold > 0.5:
        return df
    rows = softmax(df)
    n = F.count("*").over(_all())
    likely = F.sum((F.col("p") >= threshold).cast("int")).over(_all())
    rows = (
        rows.withColumn("__r", F.row_number().over(_ranked()) - 1)
        .withColumn("__last", F.greatest(likely - 1, F.lit(0)))
        .withColumn("__n", n)
    )
    on = (F.col("__n") >= 2) & (_uniform(seed) <= probability) & (F.col("__n") - F.col("__last") >= min_keep)
    return rows.filter(~on | (F.col("__r") >= F.col("__last"))).drop("__r", "__last", "__n")


def top_n_sigma(df: DataFrame, n: float) -> DataFrame:
    """Mask logits more than ``n`` deviations below the best, then softmax."""
    if n <= 0:
        return softmax(df)
    finite = F.when(F.col("logit") != NEG_INF, F.col("logit"))
    rows = df.withColumn("__s", F.stddev_pop(finite).over(_all())).withColumn("__m", F.max("logit").over(_all())).withColumn(
        "__n", F.count("*").over(_all())
    )
    low = F.col("__m") - n * F.col("__s")
    masked = rows.withColumn("logit", F.when((F.col("__n") > 1) & (F.col("logit") < low), NEG_INF).otherwise(F.col("logit")))
    return softmax(masked.drop("__s", "__m", "__n"))


def penalties(df: DataFrame, history: DataFrame, last_n: int, repeat: float = 1.0, freq: float = 0.0, present: float = 0.0) -> DataFrame:
    """Penalise tokens among the last ``last_n`` of ``history(dist_id, tokens)``; candidates stay where they are, the tokens come to them."""
    if last_n == 0 or (repeat == 1 and freq == 0 and present == 0):
        return df
    tail = F.col("tokens") if last_n < 0 else F.slice("tokens", -F.least(F.size("tokens"), F.lit(last_n)), last_n)
    seen = history.filter(F.size("tokens") > 0).groupBy("dist_id").agg(F.flatten(F.collect_list(tail)).alias("__seen"))
    x = F.col("logit")
    scaled = F.when(x <= 0, x * repeat).otherwise(x / repeat) - (F.col("__c") * freq + present)
    counted = df.join(seen, "dist_id", "left").withColumn("__c", F.size(F.filter("__seen", lambda s: s == F.col("token_id")))).drop("__seen")
    return counted.withColumn("logit", F.when(F.col("__c") > 0, scaled).otherwise(x)).drop("__c")


def _repeat_lengths(tokens: np.ndarray, allowed: int, breakers: Sequence[Sequence[int]]) -> dict[int, int]:
    """Longest repeated suffix each next token would extend, for one history."""
    back = tokens[::-1]
    n = len(back)
    limit = n
    for i in range(n):
        fits = [len(b) - 1 for b in breakers if b[0] == back[i] and len(b) - 1 <= i and all(back[i - k - 1] == t for k, t in enumerate(b[1:]))]
        if fits:
            limit = i - max(fits)
            break
    if limit < allowed:
        return {}
    # Z-function of the reversed history: how far a suffix ending k tokens earlier agrees with the end
    z, left, right = [0] * n, 0, 0
    for k in range(1, n):
        if k < right:
            z[k] = min(right - k, z[k - left])
        while k + z[k] < n and back[z[k]] == back[k + z[k]]:
            z[k] += 1
        if k + z[k] > right:
            left, right = k, k + z[k]
    out: dict[int, int] = {}
    for k in range(1, n):
        length = min(z[k], limit)
        if length >= allowed:
            nxt = int(back[k - 1])
            out[nxt] = max(out.get(nxt, 0), length)
    single = {b[0] for b in breakers if len(b) == 1}
    return {t: r for t, r in out.items() if t not in single}


def dry(
    df: DataFrame,
    history: DataFrame,
    multiplier: float,
    base: float = 1.75,
    allowed: int = 2,
    last_n: int = -1,
    breakers: Sequence[Sequence[int]] = (),
) -> DataFrame:
    """Penalise tokens that would extend a repeated sequence of ``history(dist_id, tokens)``."""
    if multiplier == 0 or base < 1 or last_n == 0:
        return df
    item = T.StructType([T.StructField("token_id", T.IntegerType()), T.StructField("len", T.IntegerType())])

    @F.pandas_udf(T.ArrayType(item))
    def repeats(tokens: pd.Series) -> pd.Series:
        def one(seq) -> list:
            seq = np.asarray(seq)
            seq = seq[-last_n:] if last_n > 0 else seq
            if len(seq) <= allowed:
                return []
            return [{"token_id": t, "len": n} for t, n in _repeat_lengths(seq, allowed, breakers).items()]

        return tokens.map(one)

    most = int(FLOAT_MAX_LOG / math.log(base)) if base > 1.000001 else 0
    found = history.select("dist_id", repeats("tokens").alias("h")).filter(F.size("h") > 0)
    hits = found.groupBy("dist_id").agg(F.flatten(F.collect_list("h")).alias("__h"))
    over = F.col("len") - allowed
    over = F.least(over, F.lit(most)) if most > 0 else over
    cost = F.when(F.col("len").isNotNull(), multiplier * F.pow(F.lit(base), over.cast("double")))
    own = F.transform(F.filter("__h", lambda h: h["token_id"] == F.col("token_id")), lambda h: h["len"])
    met = df.join(hits, "dist_id", "left").select(*df.columns, F.explode_outer(own).alias("len"))
    return met.withColumn("logit", F.col("logit") - F.coalesce(cost, F.lit(0.0))).drop("len")


def logit_bias(df: DataFrame, bias: DataFrame) -> DataFrame:
    """Add ``bias(token_id, bias)``; a table of the usual size is sent to the candidates, which are many for each token."""
    small = F.broadcast(bias) if fits(bias, MAX_BIAS) else bias
    return df.join(small, "token_id", "left").withColumn("logit", F.col("logit") + F.coalesce("bias", F.lit(0.0))).drop("bias")


def greedy(df: DataFrame) -> DataFrame:
    return df.groupBy("dist_id").agg(F.min_by("token_id", F.struct(-F.col("logit"), F.col("token_id"))).alias("token_id"))


def draw(df: DataFrame, seed: int) -> DataFrame:
    """One candidate per distribution, weighted by probability; repeatable by seed."""
    rows = _rank_and_sum(softmax(df), _ranked()).withColumn("__u", _uniform(seed))
    return rows.filter(F.col("__c") <= F.col("__u")).groupBy("dist_id").agg(F.max_by("token_id", "__r").alias("token_id"))


# Default order of the filters: fixed value.
DEFAULT_CHAIN = ("penalties", "dry", "top_n_sigma", "top_k", "typical", "top_p", "min_p", "xtc", "temperature")
_BY_NAME = {f.__name__: f for f in (penalties, dry, top_n_sigma, top_k, typical, top_p, min_p, xtc, temperature, dynamic_temperature)}


def chain(df: DataFrame, settings: dict[str, dict], order: Sequence[str | Filter] = DEFAULT_CHAIN) -> DataFrame:
    """Apply filters in order; a step is a name with settings, or a function ``DataFrame -> DataFrame``."""
    steps: list[Filter] = []
    for step in order:
        if callable(step):
            steps.append(step)
        elif step in settings:
            steps.append(lambda d, s=step: _BY_NAME[s](d, **settings[s]))
    return softmax(reduce(lambda d, f: f(d), steps, df).drop("p"))
