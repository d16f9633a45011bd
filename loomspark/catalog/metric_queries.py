"""Evaluation metrics over logits derived from ``events``, and quizzes derived from ``lineitem`` and ``orders``."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.function_queries import digest, sql_digest
from loomspark.catalog.inputs import DISTS, SCORED, dists, scored
from loomspark.functions import arrays as A
from loomspark.operators import dists as D
from loomspark.operators import metrics as M

LP = f"""{SCORED}, z AS (SELECT *, list_max(logits) + ln(list_sum(list_transform(logits, lambda x: exp(x - list_max(logits))))) AS lse,
  list_max(base_logits) + ln(list_sum(list_transform(base_logits, lambda x: exp(x - list_max(base_logits))))) AS base_lse FROM scored),
nll AS (SELECT chunk, pos, target, logits[target + 1] AS logit, logits[target + 1] - lse AS logp, lse - logits[target + 1] AS nll FROM z)"""

SOFT = f"""{DISTS}, mx AS (SELECT dist_id, max(logit) AS m FROM dists GROUP BY 1), ex AS (SELECT dist_id, token_id, logit, exp(logit - m) AS e FROM dists JOIN mx USING (dist_id)),
soft AS (SELECT dist_id, token_id, logit, e / sum(e) OVER (PARTITION BY dist_id) AS p FROM ex)"""


def losses(t):
    return M.log_softmax(scored(t))


def rounded(df, places, *cols):
    return df.withColumns({c: F.round(c, places) for c in cols})


@query("m1_softmax", f"WITH {SOFT} SELECT dist_id, token_id, round(p, 9) AS p FROM soft")
def _(t):
    return D.softmax(dists(t)).select("dist_id", "token_id", F.round("p", 9).alias("p"))


@query("m1_softmax_rows", f"WITH {LP} SELECT chunk, pos, {sql_digest('list_transform(logits, lambda x: exp(x - lse))')} AS p FROM z")
def _(t):
    return scored(t).select("chunk", "pos", digest(A.softmax("logits")).alias("p"))


@query("m2_log_softmax", f"WITH {LP} SELECT chunk, pos, round(logit, 6) AS logit, round(logp, 9) AS logp, round(exp(logp), 9) AS prob FROM nll")
def _(t):
    return rounded(losses(t).select("chunk", "pos", F.round("logit", 6).alias("logit"), "logp", "prob"), 9, "logp", "prob")


@query(
    "m3_pack_logprobs",
    f"""WITH {LP}, p AS (SELECT pos, logits, lse, greatest(list_min(logits), list_max(logits) - 16) AS low, list_max(logits) AS top FROM z),
q AS (SELECT pos, (top - low) / 65535 AS scale, low - lse AS mlp, list_transform(logits, lambda x: CASE WHEN x > low AND top > low THEN round_even((x - low) / ((top - low) / 65535), 0) ELSE 0 END) AS q FROM p)
SELECT pos, round(scale, 12) AS scale, round(mlp, 9) AS min_log_prob, list_sum(q)::BIGINT AS q_sum, {sql_digest('list_transform(q, lambda v: scale * v + mlp)')} AS unpacked FROM q""",
)
def _(t):
    rows = scored(t).select("pos", M.pack_logprobs("logits").alias("k"))
    return rows.select(
        "pos",
        F.round("k.scale", 12).alias("scale"),
        F.round("k.min_log_prob", 9).alias("min_log_prob"),
        F.aggregate("k.q", F.lit(0).cast("long"), lambda s, q: s + q).alias("q_sum"),
        digest(M.unpack_logprobs("k")).alias("unpacked"),
    )


PPL = "exp(s / n) AS ppl, exp(s / n) * sqrt(greatest(s2 / n - (s / n) * (s / n), 0) / (n - 1)) AS err"


@query(
    "m4_perplexity",
    f"WITH {LP}, a AS (SELECT sum(nll) AS s, sum(nll * nll) AS s2, count(*) AS n FROM nll), r AS (SELECT {PPL}, n FROM a) SELECT round(ppl, 6) AS ppl, round(err, 6) AS err, n FROM r",
)
def _(t):
    return rounded(M.perplexity(losses(t)), 6, "ppl", "err")


@query(
    "m5_perplexity_curve",
    f"""WITH {LP}, a AS (SELECT chunk, sum(nll) AS s, sum(nll * nll) AS s2, count(*) AS n FROM nll GROUP BY 1),
c AS (SELECT chunk, sum(s) OVER w AS s, sum(s2) OVER w AS s2, (sum(n) OVER w)::BIGINT AS n FROM a WINDOW w AS (ORDER BY chunk)), r AS (SELECT chunk, {PPL}, n FROM c)
SELECT chunk, round(ppl, 6) AS ppl, round(err, 6) AS err, n FROM r""",
)
def _(t):
    return rounded(M.perplexity_curve(losses(t)), 6, "ppl", "err")


KL = f"""{LP}, kl AS (SELECT chunk, pos, lse - logits[target + 1] AS nll, base_lse - base_logits[target + 1] AS nll_base,
  list_sum(list_transform(list_zip(base_logits, logits), lambda p: CASE WHEN p[1] - base_lse > -16 THEN exp(p[1] - base_lse) * ((p[1] - base_lse) - (p[2] - lse)) ELSE 0 END)) AS kld,
  exp(logits[target + 1] - lse) - exp(base_logits[target + 1] - base_lse) AS p_diff,
  list_position(logits, list_max(logits)) = list_position(base_logits, list_max(base_logits)) AS same_top FROM z)"""


def kl(t):
    rows = scored(t)
    base = rows.select("chunk", "pos", A.let(A.log_sum_exp("base_logits"), lambda z: F.transform("base_logits", lambda x: x - z)).alias("base_logp"))
    return M.kl_tokens(rows.drop("base_logits"), base)


@query("m6_kl_tokens", f"WITH {KL} SELECT chunk, pos, round(nll, 9) AS nll, round(nll_base, 9) AS nll_base, round(kld, 9) AS kld, round(p_diff, 9) AS p_diff, same_top FROM kl")
def _(t):
    return rounded(kl(t), 9, "nll", "nll_base", "kld", "p_diff")


@query(
    "m7_mean_err",
    f"WITH {LP}, a AS (SELECT sum(logp) AS s, sum(logp * logp) AS s2, count(*) AS n FROM nll) SELECT round(s / n, 9) AS mean, round(CASE WHEN n > 10 THEN sqrt((s2 / n - (s / n) * (s / n)) / (n - 1)) ELSE 0 END, 9) AS err, n FROM a",
)
def _(t):
    return rounded(M.mean_err(losses(t), "logp"), 9, "mean", "err")


SUMS = f"""{KL}, s AS (SELECT sum(nll) AS a, sum(nll * nll) AS a2, sum(nll_base) AS b, sum(nll_base * nll_base) AS b2, sum(nll * nll_base) AS ab, sum(kld) AS k, sum(kld * kld) AS k2,
 sum(p_diff) AS d, sum(p_diff * p_diff) AS d2, sum(p_diff * p_diff * p_diff * p_diff) AS d4, sum(same_top::INTEGER)::BIGINT AS same, count(*) AS n FROM kl)"""


@query(
    "m8_ppl_report",
    f"""WITH {SUMS}, m AS (SELECT n, a / n AS m, sqrt((a2 / n - (a / n) * (a / n)) / (n - 1)) AS e, b / n AS mb, sqrt((b2 / n - (b / n) * (b / n)) / (n - 1)) AS eb, (ab / n - (a / n) * (b / n)) / (n - 1) AS cov FROM s),
r AS (SELECT *, sqrt(e * e + eb * eb - 2 * cov) AS re, exp(m) AS p, exp(mb) AS pb FROM m)
SELECT round(p, 6) AS ppl, round(p * e, 6) AS ppl_err, round(pb, 6) AS ppl_base, round(pb * eb, 6) AS ppl_base_err, round(cov / (e * eb), 6) AS cor, round(m - mb, 6) AS ln_ratio, round(re, 6) AS ln_ratio_err,
 round(exp(m - mb), 6) AS ratio, round(exp(m - mb) * re, 6) AS ratio_err, round(p - pb, 6) AS diff, round(sqrt(p * e * p * e + pb * eb * pb * eb - 2 * p * pb * cov), 6) AS diff_err, n FROM r""",
)
def _(t):
    r = M.ppl_report(kl(t))
    return rounded(r, 6, *[c for c in r.columns if c != "n"])


@query(
    "m9_kld_report",
    f"""WITH {SUMS}, q AS (SELECT {", ".join(f"quantile_cont(kld, {v}) AS {k}" for k, v in M.KLD_POINTS.items())} FROM kl)
SELECT round(k / n, 6) AS mean, round(sqrt((k2 / n - (k / n) * (k / n)) / (n - 1)), 6) AS err, {", ".join(f'round("{k}", 6) AS "{k}"' for k in M.KLD_POINTS)} FROM s, q""",
)
def _(t):
    r = M.kld_report(kl(t))
    return rounded(r, 6, *r.columns)


@query(
    "m10_dp_report",
    f"""WITH {SUMS}, q AS (SELECT {", ".join(f"100 * quantile_cont(p_diff, {v}) AS {k}" for k, v in M.DP_POINTS.items())} FROM kl)
SELECT round(100 * d / n, 6) AS mean, round(100 * sqrt((d2 / n - (d / n) * (d / n)) / (n - 1)), 6) AS err, {", ".join(f'round("{k}", 6) AS "{k}"' for k in M.DP_POINTS)},
 round(100 * sqrt(d2 / n), 6) AS rms, round(100 * 0.5 / sqrt(d2 / n) * sqrt((d4 / n - (d2 / n) * (d2 / n)) / (n - 1)), 6) AS rms_err, round(100 * same / n, 6) AS same_top, round(100 * sqrt(same / n * (1 - same / n) / (n - 1)), 6) AS same_top_err FROM s, q""",
)
def _(t):
    r = M.dp_report(kl(t))
    return rounded(r, 6, *r.columns)


# a quiz for each order: endings by line number, token scores by quantity
QUIZ = "quiz AS (SELECT l_orderkey AS task, l_linenumber % 4 AS ending, -((l_partkey * 31 + l_suppkey * 17 + l_linenumber * 7) % 100) / 25.0::DOUBLE - 0.01 AS logp FROM lineitem)"


def quiz(t):
    k = (F.col("l_partkey") * 31 + F.col("l_suppkey") * 17 + F.col("l_linenumber") * 7) % 100
    return t.lineitem.select(F.col("l_orderkey").alias("task"), (F.col("l_linenumber") % 4).alias("ending"), (-k / F.lit(25.0) - 0.01).alias("logp"))


ENDINGS = f"""{QUIZ}, pe AS (SELECT task, ending, round(avg(logp), 9) AS score FROM quiz GROUP BY 1, 2),
best AS (SELECT task, arg_min(ending, {{'s': -score, 'e': ending}}) AS choice, max(score) AS score, count(*) AS n_endings FROM pe GROUP BY 1)"""


def endings(t):
    """Scores are rounded first, so that equal means are equal in both engines."""
    per = quiz(t).groupBy("task", "ending").agg(F.round(F.avg("logp"), 9).alias("logp"))
    return M.score_endings(per)


@query("m11_endings", f"WITH {ENDINGS} SELECT task, choice, score, n_endings FROM best")
def _(t):
    return endings(t)


@query(
    "m12_wilson",
    f"""WITH {ENDINGS}, c AS (SELECT task, (choice = task % 4)::INTEGER AS ok FROM best), r AS (SELECT task, sum(ok) OVER w AS k, count(*) OVER w AS n FROM c WINDOW w AS (ORDER BY task)),
z AS (SELECT task, n, k / n AS f, 1.95996398454::DOUBLE * 1.95996398454::DOUBLE / n AS z FROM r)
SELECT task, n, f AS acc, round((f + z * 0.5 - z * sqrt(n * (4 * f * (1 - f) + z)) / (2 * 1.95996398454::DOUBLE)) / (1 + z), 9) AS low,
 round((f + z * 0.5 + z * sqrt(n * (4 * f * (1 - f) + z)) / (2 * 1.95996398454::DOUBLE)) / (1 + z), 9) AS high FROM z""",
)
def _(t):
    judged = endings(t).select("task", (F.col("choice") == F.col("task") % 4).alias("correct"))
    return rounded(M.running_accuracy(judged), 9, "low", "high")


BLANKS = """b AS (SELECT o_orderkey AS task, 2 + o_orderkey % 2 AS prefix, 1 + o_custkey % 2 AS answer,
  list_transform(range(4 + o_orderkey % 7), lambda i: -((o_custkey * 13 + i * 29) % 50) / 10.0::DOUBLE) AS l1, list_transform(range(4 + o_orderkey % 5), lambda i: -((o_custkey * 17 + i * 31) % 50) / 10.0::DOUBLE) AS l2 FROM orders),
k AS (SELECT *, CASE WHEN len(l1) - prefix > 3 AND len(l2) - prefix > 3 THEN prefix + 1 ELSE prefix END AS s1, CASE WHEN len(l1) - prefix > 3 AND len(l2) - prefix > 3 THEN prefix + 2 ELSE prefix END AS s2 FROM b),
sc AS (SELECT task, answer, round(list_avg(l1[s1 + 1:s1 + (CASE WHEN len(l1) - s1 > 1 THEN len(l1) - s1 - 1 ELSE len(l1) - s1 END)]), 9) AS score1,
 round(list_avg(l2[s2 + 1:s2 + (CASE WHEN len(l2) - s2 > 1 THEN len(l2) - s2 - 1 ELSE len(l2) - s2 END)]), 9) AS score2 FROM k)"""


def blanks(t):
    lp = lambda n, a, b: F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: -((F.col("o_custkey") * a + i * b) % 50) / F.lit(10.0))
    prefix = (F.col("o_orderkey") % 2 + 2).cast("int")
    rows = t.orders.select(
        F.col("o_orderkey").alias("task"), prefix.alias("prefix"), (prefix + 1).alias("base1"), (prefix + 2).alias("base2"),
        lp(F.col("o_orderkey") % 7 + 4, 13, 29).alias("logp1"), lp(F.col("o_orderkey") % 5 + 4, 17, 31).alias("logp2"), (F.col("o_custkey") % 2 + 1).alias("answer"),
    )
    return M.score_blanks(rows)


@query("m13_blanks", f"WITH {BLANKS} SELECT task, score1, score2 FROM sc")
def _(t):
    return rounded(blanks(t), 9, "score1", "score2").select("task", "score1", "score2")


@query(
    "m14_choices",
    f"""WITH {QUIZ}, pe AS (SELECT task, ending, round(avg(logp), 9) AS score, (task + ending) % 3 = 0 AS label FROM quiz GROUP BY 1, 2),
b AS (SELECT task, arg_min(label, {{'s': -score, 'e': ending}}) AS hit, count(*) AS answers FROM pe GROUP BY 1),
s AS (SELECT count(*) AS n, sum(hit::INTEGER) / count(*) AS p, count(*) / sum(answers) AS c FROM b)
SELECT n, round(100 * p, 6) AS score, round(100 * sqrt(p * (1 - p) / (n - 1)), 6) AS err, round(100 * c, 6) AS chance, round(100 * sqrt(c * (1 - c) / (n - 1)), 6) AS chance_err FROM s""",
)
def _(t):
    per = quiz(t).groupBy("task", F.col("ending").alias("answer")).agg(F.round(F.avg("logp"), 9).alias("logp"))
    rows = per.withColumn("label", F.when((F.col("task") + F.col("answer")) % 3 == 0, 1).otherwise(0))
    return rounded(M.score_choices(rows), 6, "score", "err", "chance", "chance_err")


@query("m15_gate", f"WITH {LP}, a AS (SELECT chunk, exp(avg(nll)) AS ppl FROM nll GROUP BY 1) SELECT chunk, round(ppl, 6) AS ppl FROM a WHERE (SELECT max(ppl) FROM a) <= 1000")
def _(t):
    """The report where the gate lets it pass, else no rows."""
    report = M.perplexity(losses(t), keys=("chunk",))
    try:
        passed = M.gate(report, 1000.0)
    except M.AboveLimit:
        passed = report.limit(0)
    return rounded(passed, 6, "ppl").select("chunk", "ppl")


@query(
    "m16_loss_accuracy",
    """WITH a AS (SELECT event_type, count(*) AS n, sum(value * 2) AS s, sum(value * value * 4) AS s2, sum((value > 20)::INTEGER) AS k FROM events GROUP BY 1)
SELECT event_type, n, round(s / n, 6) AS loss, round(sqrt((s2 / n - (s / n) * (s / n)) / (n - 1)), 6) AS err, round(k / n, 9) AS accuracy, round(sqrt(k / n * (1 - k / n) / (n - 1)), 9) AS acc_err FROM a""",
)
def _(t):
    loss = M.loss_report(t.events, loss="value", period=2, keys=("event_type",))
    acc = M.accuracy_report(t.events.withColumn("correct", F.col("value") > 20), keys=("event_type",))
    return loss.join(acc.select("event_type", "accuracy", F.col("err").alias("acc_err")), "event_type").select(
        "event_type", "n", F.round("loss", 6).alias("loss"), F.round("err", 6).alias("err"), F.round("accuracy", 9).alias("accuracy"), F.round("acc_err", 9).alias("acc_err")
    )


@query(
    "m17_top_logprobs",
    f"""WITH {SOFT}, r AS (SELECT *, row_number() OVER (PARTITION BY dist_id ORDER BY logit DESC, token_id)::INTEGER AS rank FROM soft)
SELECT dist_id, token_id, rank, round(p, 9) AS p, round(ln(p), 6) AS logprob FROM r WHERE rank <= 5""",
)
def _(t):
    return M.top_logprobs(D.softmax(dists(t)), 5).select("dist_id", "token_id", "rank", F.round("p", 9).alias("p"), F.round("logprob", 6).alias("logprob"))


@query(
    "m18_quiz_totals",
    "SELECT event_type AS model, sum((value > 20)::INTEGER)::DOUBLE AS total FROM events GROUP BY 1 UNION ALL SELECT 'Human', 48.11::DOUBLE",
)
def _(t):
    return M.quiz_totals(t.events.select(F.col("event_type").alias("model"), (F.col("value") > 20).alias("correct")))
