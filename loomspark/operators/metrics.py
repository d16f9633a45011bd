"""Evaluation metrics over logged scores.

Scored positions are rows ``(chunk, pos, target, logits array<double>)``.  All reports are built from sums, so partial
sums are all that is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspark.functions import arrays as A
from loomspark.functions.quantiles import exact_quantiles
from loomspark.plans.prefix import running_sums
from loomspark.plans.scratch import written

LOG_FLOOR = 16.0
Q_MAX = 65535.0
LOWEST_FLOAT = -3.4028234663852886e38
Z95 = 1.95996398454
HUMAN_SCORE = 48.11
MIN_VALUES = 100


def log_softmax(df: DataFrame, *, logits: str = "logits", target: str = "target") -> DataFrame:
    """Add the target's ``logit``, ``logp`` and ``prob`` and its loss ``nll``."""
    logit = F.get(logits, F.col(target))
    return (
        df.withColumn("logit", logit)
        .withColumn("logp", logit - A.log_sum_exp(logits))
        .withColumn("prob", F.exp("logp"))
        .withColumn("nll", -F.col("logp"))
    )


def pack_logprobs(logits) -> Column:
    """16-bit packing of a row's log-probabilities: ``struct(scale, min_log_prob, q)``; nothing below max-16."""
    x = F.col(logits) if isinstance(logits, str) else logits

    def pack(r: Column) -> Column:
        low, scale = r["low"], (r["top"] - r["low"]) / Q_MAX
        q = F.transform(x, lambda v: F.when((scale > 0) & (v > low), F.rint((v - low) / scale)).otherwise(0.0).cast("int"))
        return F.struct(scale.alias("scale"), (low - r["lse"]).alias("min_log_prob"), q.alias("q"))

    top = F.array_max(x)
    low = F.greatest(F.array_min(x), top - LOG_FLOOR)
    return A.let(F.struct(top.alias("top"), low.alias("low"), A.log_sum_exp(x).alias("lse")), pack)


def unpack_logprobs(packed) -> Column:
    p = F.col(packed) if isinstance(packed, str) else packed
    return F.transform(p["q"], lambda q: p["scale"] * q + p["min_log_prob"])


def _mean_err(s: Column, s2: Column, n: Column) -> tuple[Column, Column]:
    """Mean and its error; the error is 0 up to ten values."""
    mean = s / n
    var = s2 / n - mean * mean
    return mean, F.when((var > 0) & (n > 10), F.sqrt(F.greatest(var, F.lit(0.0)) / (n - 1))).otherwise(0.0)


def _covariance(a: Column, b: Column, ab: Column, n: Column) -> Column:
    return F.when(n < 10, 0.0).otherwise((ab / n - (a / n) * (b / n)) / (n - 1))


def mean_err(df: DataFrame, col: str) -> DataFrame:
    s = df.agg(F.sum(col).alias("s"), F.sum(F.col(col) * F.col(col)).alias("s2"), F.count(col).alias("n"))
    mean, err = _mean_err(F.col("s"), F.col("s2"), F.col("n"))
    return s.select(mean.alias("mean"), err.alias("err"), "n")


def _ppl(s: Column, s2: Column, n: Column) -> tuple[Column, Column]:
    mean = s / n
    var = F.greatest(s2 / n - mean * mean, F.lit(0.0))
    ppl = F.exp(mean)
    return ppl, F.when(n > 1, ppl * F.sqrt(var / (n - 1)))


def perplexity(df: DataFrame, *, nll: str = "nll", keys: tuple[str, ...] = ()) -> DataFrame:
    """``exp(mean loss)`` and its error."""
    sums = df.groupBy(*keys).agg(F.sum(nll).alias("s"), F.sum(F.col(nll) * F.col(nll)).alias("s2"), F.count(nll).alias("n"))
    ppl, err = _ppl(F.col("s"), F.col("s2"), F.col("n"))
    return sums.select(*keys, ppl.alias("ppl"), err.alias("err"), "n")


def perplexity_curve(df: DataFrame, *, nll: str = "nll", chunk: str = "chunk") -> DataFrame:
    """Perplexity of the first 1, 2, 3 … chunks."""
    per = df.groupBy(chunk).agg(F.sum(nll).alias("a"), F.sum(F.col(nll) * F.col(nll)).alias("b"), F.count(nll).alias("c"))
    run = running_sums(per, [], chunk, {"s": F.col("a"), "s2": F.col("b"), "n": F.col("c")})
    ppl, err = _ppl(F.col("s"), F.col("s2"), F.col("n"))
    return run.select(chunk, ppl.alias("ppl"), err.alias("err"), "n")


def kl_tokens(cur: DataFrame, base: DataFrame, *, keys: tuple[str, ...] = ("chunk", "pos"), target: str = "target") -> DataFrame:
    """Divergence of each position from a base model: ``base(keys, base_logp array)``, ``cur(keys, target, logits)``."""
    return kl_columns(cur.join(base, [*keys]), target=target).select(*keys, "nll", "nll_base", "kld", "p_diff", "same_top")


def kl_columns(df: DataFrame, *, target: str = "target", logits: str = "logits", base: str = "base_logp") -> DataFrame:
    """The same for rows that already hold both sides."""
    lse = F.col("__lse")
    kld = A.let(
        lse,
        lambda z: A.fsum(
            F.zip_with(F.col(base), F.col(logits), lambda b, x: F.when(b > -LOG_FLOOR, F.exp(b) * (b - (x - z))).otherwise(0.0))
        ),
    )
    return (
        df.withColumn("__lse", A.log_sum_exp(logits))
        .withColumn("nll", lse - F.get(logits, F.col(target)))
        .withColumn("nll_base", -F.get(base, F.col(target)))
        .withColumn("kld", kld)
        .withColumn("p_diff", F.exp(-F.col("nll")) - F.exp(-F.col("nll_base")))
        .withColumn("same_top", A.argmax_first(logits) == A.argmax_first(base))
        .drop("__lse")
    )


def kl_sums(tokens: DataFrame) -> DataFrame:
    """One row of sums every report below is computed from."""
    sq = lambda c: F.sum(F.col(c) * F.col(c))
    d2 = F.col("p_diff") * F.col("p_diff")
    return tokens.agg(
        F.sum("nll").alias("nll"), sq("nll").alias("nll2"),
        F.sum("nll_base").alias("base"), sq("nll_base").alias("base2"),
        F.sum(F.col("nll") * F.col("nll_base")).alias("cross"),
        F.sum("kld").alias("kld"), sq("kld").alias("kld2"),
        F.sum("p_diff").alias("pd"), F.sum(d2).alias("pd2"), F.sum(d2 * d2).alias("pd4"),
        F.max(F.abs("p_diff")).alias("pd_max"),
        F.sum(F.col("same_top").cast("long")).alias("same"),
        F.count("*").alias("n"),
    )


def ppl_report(tokens: DataFrame) -> DataFrame:
    """Perplexity of both models, their correlation, ratio and difference, each with an error."""
    n = F.col("n")
    m, e = _mean_err(F.col("nll"), F.col("nll2"), n)
    mb, eb = _mean_err(F.col("base"), F.col("base2"), n)
    cov = _covariance(F.col("nll"), F.col("base"), F.col("cross"), n)
    s = kl_sums(tokens).select("n", m.alias("m"), e.alias("e"), mb.alias("mb"), eb.alias("eb"), cov.alias("cov"))
    ppl, base = F.exp("m"), F.exp("mb")
    ratio_err = F.sqrt(F.greatest(F.col("e") * F.col("e") + F.col("eb") * F.col("eb") - 2 * F.col("cov"), F.lit(0.0)))
    pe, be = ppl * F.col("e"), base * F.col("eb")
    diff_err = F.sqrt(F.greatest(pe * pe + be * be - 2 * ppl * base * F.col("cov"), F.lit(0.0)))
    return s.select(
        ppl.alias("ppl"), pe.alias("ppl_err"), base.alias("ppl_base"), be.alias("ppl_base_err"),
        (F.col("cov") / (F.col("e") * F.col("eb"))).alias("cor"),
        (F.col("m") - F.col("mb")).alias("ln_ratio"), ratio_err.alias("ln_ratio_err"),
        F.exp(F.col("m") - F.col("mb")).alias("ratio"), (F.exp(F.col("m") - F.col("mb")) * ratio_err).alias("ratio_err"),
        (ppl - base).alias("diff"), diff_err.alias("diff_err"), "n",
    )


# Reported percentiles: fixed values.
KLD_POINTS = {"max": 1.0, "p999": 0.999, "p990": 0.99, "median": 0.5, "p100": 0.1, "p050": 0.05, "p010": 0.01, "min": 0.0}
DP_POINTS = {
    "max": 1.0, "p999": 0.999, "p990": 0.99, "p950": 0.95, "p900": 0.9, "p750": 0.75, "median": 0.5, "p250": 0.25,
    "p100": 0.1, "p050": 0.05, "p010": 0.01, "p001": 0.001, "min": 0.0,
}


def _enough(tokens: DataFrame) -> DataFrame:
    """The table, worked out once for the passes over it."""
    tokens = written(tokens, "tokens")
    if tokens.limit(MIN_VALUES).count() < MIN_VALUES:
        raise ValueError(f"statistics need at least {MIN_VALUES} values")
    return tokens


def kld_report(tokens: DataFrame) -> DataFrame:
    tokens = _enough(tokens)
    points = exact_quantiles(tokens, {"kld": list(KLD_POINTS.values())})["kld"]
    mean, err = _mean_err(F.col("kld"), F.col("kld2"), F.col("n"))
    return kl_sums(tokens).select(mean.alias("mean"), err.alias("err"), *[F.lit(v).alias(k) for k, v in zip(KLD_POINTS, points)])


def dp_report(tokens: DataFrame) -> DataFrame:
    """Change of the target's probability, in percent."""
    tokens = _enough(tokens)
    points = exact_quantiles(tokens, {"p_diff": list(DP_POINTS.values())})["p_diff"]
    n = F.col("n")
    mean, err = _mean_err(F.col("pd"), F.col("pd2"), n)
    mse, mse_err = _mean_err(F.col("pd2"), F.col("pd4"), n)
    same = F.col("same") / n
    pct = lambda c: c * 100.0
    return kl_sums(tokens).select(
        pct(mean).alias("mean"), pct(err).alias("err"),
        *[F.lit(100.0 * v).alias(k) for k, v in zip(DP_POINTS, points)],
        pct(F.sqrt(mse)).alias("rms"), pct(0.5 / F.sqrt(mse) * mse_err).alias("rms_err"),
        pct(same).alias("same_top"), pct(F.sqrt(same * (1 - same) / (n - 1))).alias("same_top_err"),
    )


# ------------------------------------------------------------------ quizzes


def score_endings(df: DataFrame, *, task: str = "task", ending: str = "ending", logp: str = "logp") -> DataFrame:
    """The ending with the best mean log-probability; the first of equals wins."""
    per = df.groupBy(task, ending).agg(F.avg(logp).alias("score"))
    return per.groupBy(task).agg(F.min_by(ending, F.struct(-F.col("score"), F.col(ending))).alias("choice"), F.max("score").alias("score"), F.count("*").alias("n_endings"))


def wilson(k, n) -> tuple[Column, Column]:
    """95 % interval of a share k/n."""
    k, n = (F.col(c) if isinstance(c, str) else c for c in (k, n))
    f = k / n
    z = F.lit(Z95 * Z95) / n
    half = z * F.sqrt(n * (4.0 * f * (1.0 - f) + z)) / (2 * Z95)
    return (f + z * 0.5 - half) / (1.0 + z), (f + z * 0.5 + half) / (1.0 + z)


def running_accuracy(df: DataFrame, *, task: str = "task", correct: str = "correct") -> DataFrame:
    """Accuracy and its interval after each task, in task order."""
    rows = running_sums(df, [], task, {"k": F.col(correct).cast("long"), "n": F.lit(1).cast("long")})
    low, high = wilson("k", "n")
    return rows.select(task, "n", (F.col("k") / F.col("n")).alias("acc"), low.alias("low"), high.alias("high"))


TRAILING = 3


def score_blanks(df: DataFrame) -> DataFrame:
    """Choice of each fill-in task: ``(task, prefix, base1, base2, logp1, logp2, answer)``.

    ``logpK[j]`` is the log-probability of token j of sequence K (0-based).  With more than three tokens behind the common
    prefix on both sides the choice word itself is not scored, and neither is the last token when more than one remains.
    """
    skip = (F.size("logp1") - F.col("prefix") > TRAILING) & (F.size("logp2") - F.col("prefix") > TRAILING)

    def mean(arr: str, base: str) -> Column:
        start = F.when(skip, F.col(base)).otherwise(F.col("prefix"))
        left = F.size(arr) - start
        n = F.when(left > 1, left - 1).otherwise(left)
        return A.fmean(F.slice(arr, start + 1, n))

    rows = df.withColumn("score1", mean("logp1", "base1")).withColumn("score2", mean("logp2", "base2"))
    choice = F.when(F.col("score1") > F.col("score2"), 1).otherwise(2)
    return rows.select("task", "score1", "score2", choice.alias("choice"), (choice == F.col("answer")).alias("correct"))


def share_report(df: DataFrame, correct: str = "correct", *, min_tasks: int = 100) -> DataFrame:
    """Share of correct tasks in percent and its error; nothing below ``min_tasks``."""
    s = df.agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("k")).filter(F.col("n") >= min_tasks)
    p = F.col("k") / F.col("n")
    return s.select("n", (p * 100.0).alias("score"), (100.0 * F.sqrt(p * (1 - p) / (F.col("n") - 1))).alias("err"))


def score_choices(df: DataFrame) -> DataFrame:
    """Multiple choice ``(task, answer, label, logp)``: accuracy, chance, and their errors in percent."""
    per = df.groupBy("task", "answer").agg(F.avg("logp").alias("score"), F.max("label").alias("label"))
    best = per.groupBy("task").agg(F.min_by("label", F.struct(-F.col("score"), F.col("answer"))).alias("hit"), F.count("*").alias("answers"))
    s = best.agg(F.count("*").alias("n"), F.sum((F.col("hit") == 1).cast("long")).alias("k"), F.sum("answers").alias("all"))
    p, c, n = F.col("k") / F.col("n"), F.col("n") / F.col("all"), F.col("n")
    err = lambda q: 100.0 * F.sqrt(q * (1 - q) / (n - 1))
    return s.select("n", (p * 100.0).alias("score"), err(p).alias("err"), (c * 100.0).alias("chance"), err(c).alias("chance_err"))


class AboveLimit(ValueError):
    """A perplexity that the gate does not let pass."""


def gate(df: DataFrame, limit: float = 20.0, *, ppl: str = "ppl") -> DataFrame:
    """Pass the report on, or fail when a perplexity is above the limit."""
    bad = df.filter(F.col(ppl) > limit).limit(1).collect()
    if bad:
        raise AboveLimit(f"perplexity {bad[0][ppl]:.4f} is above {limit}")
    return df


def loss_report(df: DataFrame, *, loss: str = "loss", per_datapoint: bool = True, period: int = 1, keys: tuple[str, ...] = ()) -> DataFrame:
    """Training loss over batches: a mean of scaled per-datapoint losses, or a sum."""
    x = F.col(loss) * period if per_datapoint else F.col(loss)
    s = df.groupBy(*keys).agg(F.count(loss).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("s2"))
    mean = F.col("s") / F.col("n")
    var = F.greatest(F.col("s2") / F.col("n") - mean * mean, F.lit(0.0))
    nan = F.lit(float("nan"))
    value = F.when(F.col("n") == 0, 0.0).otherwise(mean if per_datapoint else F.col("s"))
    spread = F.sqrt(var / (F.col("n") - 1)) if per_datapoint else F.sqrt(var * F.col("n") / (F.col("n") - 1))
    return s.select(*keys, "n", value.alias("loss"), F.when(F.col("n") < 2, nan).otherwise(spread).alias("err"))


def accuracy_report(df: DataFrame, *, correct: str = "correct", keys: tuple[str, ...] = ()) -> DataFrame:
    s = df.groupBy(*keys).agg(F.count("*").alias("n"), F.sum(F.col(correct).cast("long")).alias("k"))
    p = F.col("k") / F.col("n")
    err = F.when(F.col("n") >= 2, F.sqrt(p * (1 - p) / (F.col("n") - 1))).otherwise(float("nan"))
    return s.select(*keys, "n", p.alias("accuracy"), err.alias("err"))


def top_logprobs(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` likeliest candidates of each distribution ``(dist_id, token_id, p)``; a zero has the lowest float as log."""
    order = Window.partitionBy("dist_id").orderBy(F.desc("p"), "token_id")
    logp = F.when(F.col("p") > 0, F.ln("p")).otherwise(LOWEST_FLOAT)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n).withColumn("logprob", logp)


def quiz_totals(df: DataFrame, *, model: str = "model", correct: str = "correct") -> DataFrame:
    """Correct answers per model, beside the human baseline."""
    per = df.groupBy(model).agg(F.sum(F.col(correct).cast("long")).cast("double").alias("total"))
    human = df.sparkSession.range(1).select(F.lit("Human").alias(model), F.lit(HUMAN_SCORE).alias("total"))
    return per.unionByName(human)
