"""Decoding filters over candidate distributions derived from ``events``."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.inputs import DISTS, dists
from loomspark.catalog.metric_queries import SOFT
from loomspark.operators import dists as D

RANKED = f"""{SOFT}, ranked AS (SELECT *, row_number() OVER w AS r, coalesce(sum(p) OVER (PARTITION BY dist_id ORDER BY logit DESC, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c,
  max(logit) OVER (PARTITION BY dist_id) AS m FROM soft WINDOW w AS (PARTITION BY dist_id ORDER BY logit DESC, token_id))"""
RENORM = "round(exp(logit - max(logit) OVER w) / sum(exp(logit - m)) OVER w, 9)"


def kept(df):
    """Survivors of a filter, renormalised."""
    return D.softmax(df.drop("p")).select("dist_id", "token_id", F.round("p", 9).alias("p"))


def survivors(where, cte=RANKED):
    return f"""WITH {cte}, k AS (SELECT dist_id, token_id, exp(logit - m) AS e FROM ranked WHERE {where})
SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM k"""


@query("d1_softmax_ordered", f"WITH {RANKED} SELECT dist_id, token_id, r AS rank, round(p, 9) AS p FROM ranked")
def _(t):
    rows = D.softmax(dists(t)).withColumn("rank", F.row_number().over(D._ranked()).cast("long"))
    return rows.select("dist_id", "token_id", "rank", F.round("p", 9).alias("p"))


@query(
    "d2_temperature",
    f"""WITH {DISTS}, e AS (SELECT dist_id, token_id, exp(logit / 0.7) AS e FROM dists) SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM e""",
)
def _(t):
    return kept(D.temperature(dists(t), 0.7))


@query("d2_temperature_zero", f"WITH {RANKED} SELECT dist_id, token_id, CASE WHEN r = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS p FROM ranked")
def _(t):
    return kept(D.temperature(dists(t), 0.0))


@query(
    "d3_dynamic_temperature",
    f"""WITH {RANKED}, h AS (SELECT *, 0.3 + 1.4 * pow(sum(-p * ln(p)) OVER w / ln(count(*) OVER w), 1.5) AS tt FROM ranked WINDOW w AS (PARTITION BY dist_id)),
e AS (SELECT dist_id, token_id, exp((logit - m) / tt) AS e FROM h) SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM e""",
)
def _(t):
    return kept(D.dynamic_temperature(dists(t), 1.0, 0.7, 1.5))


@query("d4_top_k", survivors("r <= 5"))
def _(t):
    return kept(D.top_k(dists(t), 5))


@query("d5_top_p", survivors("c < 0.9"))
def _(t):
    return kept(D.top_p(dists(t), 0.9))


@query("d6_min_p", survivors("logit >= m + ln(0.05)"))
def _(t):
    return kept(D.min_p(dists(t), 0.05))


@query(
    "d7_typical",
    f"""WITH {RANKED}, h AS (SELECT *, sum(-p * ln(p)) OVER (PARTITION BY dist_id) AS h FROM ranked), s AS (SELECT *, abs(-ln(p) - h) AS s FROM h),
k AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY dist_id ORDER BY s, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cs, row_number() OVER (PARTITION BY dist_id ORDER BY s, token_id) AS rs FROM s),
e AS (SELECT dist_id, token_id, exp(logit - m) AS e FROM k WHERE cs <= 0.8 OR rs = 1) SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM e""",
)
def _(t):
    return kept(D.typical(dists(t), 0.8))


@query(
    "d8_xtc",
    f"""WITH {RANKED}, x AS (SELECT *, greatest(sum((p >= 0.1)::INTEGER) OVER (PARTITION BY dist_id), 1) AS likely FROM ranked),
e AS (SELECT dist_id, token_id, exp(logit - m) AS e FROM x WHERE r >= likely) SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM e""",
)
def _(t):
    return kept(D.xtc(dists(t), 1.0, 0.1))


@query(
    "d9_top_n_sigma",
    f"""WITH {RANKED}, s AS (SELECT *, stddev_pop(logit) OVER (PARTITION BY dist_id) AS s FROM ranked), e AS (SELECT dist_id, token_id, CASE WHEN logit < m - 1.5 * s THEN 0 ELSE exp(logit - m) END AS e FROM s)
SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM e""",
)
def _(t):
    return kept(D.top_n_sigma(dists(t), 1.5))


HISTORY = "hist AS (SELECT event_id AS dist_id, list_transform(range(8), lambda i: ((event_id * 31 + i * i * 7) % 16)::INTEGER) AS h FROM events)"


def history(t):
    item = lambda i: ((F.col("event_id") * 31 + i * i * 7) % 16).cast("int")
    return t.events.select(F.col("event_id").alias("dist_id"), F.transform(F.sequence(F.lit(0), F.lit(7)), item).alias("tokens"))


@query(
    "d10_penalties",
    f"""WITH {DISTS}, {HISTORY}, c AS (SELECT dist_id, tok AS token_id, count(*) AS c FROM (SELECT dist_id, unnest(h[-6:]) AS tok FROM hist) GROUP BY 1, 2)
SELECT dist_id, token_id, round(CASE WHEN c IS NULL THEN logit ELSE (CASE WHEN logit <= 0 THEN logit * 1.3 ELSE logit / 1.3 END) - (c * 0.2 + 0.1) END, 9) + 0.0 AS logit FROM dists LEFT JOIN c USING (dist_id, token_id)""",
)
def _(t):
    rows = D.penalties(dists(t), history(t), 6, 1.3, 0.2, 0.1)
    return rows.select("dist_id", "token_id", (F.round("logit", 9) + F.lit(0.0)).alias("logit"))


@query(
    "d11_dry",
    f"""WITH {DISTS}, {HISTORY}, k AS (SELECT dist_id, h, unnest(range(1, 8)) AS k FROM hist),
z AS (SELECT dist_id, h[8 - k + 1] AS token_id, list_position(list_transform(range(0, 9 - k), lambda n: n < 8 - k AND h[8 - n] = h[8 - n - k]), false) - 1 AS z FROM k),
r AS (SELECT dist_id, token_id, max(z) AS z FROM z WHERE z >= 1 GROUP BY 1, 2)
SELECT dist_id, token_id, round(logit - CASE WHEN z IS NULL THEN 0 ELSE 0.8 * pow(1.75, z - 1) END, 9) + 0.0 AS logit FROM dists LEFT JOIN r USING (dist_id, token_id)""",
)
def _(t):
    rows = D.dry(dists(t), history(t), 0.8, 1.75, 1)
    return rows.select("dist_id", "token_id", (F.round("logit", 9) + F.lit(0.0)).alias("logit"))


@query(
    "d12_logit_bias",
    f"""WITH {DISTS}, b AS (SELECT (user_id % 8)::INTEGER AS token_id, round(avg(value), 6) AS bias FROM events GROUP BY 1)
SELECT dist_id, token_id, round(logit + coalesce(bias, 0), 6) AS logit FROM dists LEFT JOIN b USING (token_id)""",
)
def _(t):
    bias = t.events.groupBy((F.col("user_id") % 8).cast("int").alias("token_id")).agg(F.round(F.avg("value"), 6).alias("bias"))
    return D.logit_bias(dists(t), bias).select("dist_id", "token_id", F.round("logit", 6).alias("logit"))


@query("d13_greedy", f"WITH {RANKED} SELECT dist_id, token_id FROM ranked WHERE r = 1")
def _(t):
    return D.greedy(dists(t))


@query("d14_draw_invariants", f"WITH {DISTS}, m AS (SELECT dist_id FROM dists GROUP BY 1) SELECT count(*) AS n, count(*) AS n_possible, 0::BIGINT AS n_changed, true AS by_weight FROM m")
def _(t):
    """A draw for each distribution, all possible, the same a second time; the mean probability of what is drawn is that of weighted draws."""
    rows = dists(t)
    first, second = D.draw(rows, 7), D.draw(rows.repartition("dist_id", "token_id"), 7).withColumnRenamed("token_id", "again")
    weights = D.softmax(rows).groupBy("dist_id").agg(F.collect_list(F.struct("token_id", "p")).alias("all"), F.sum(F.col("p") * F.col("p")).alias("want"))
    # All sides have a row for each distribution: merged, never sent whole through the driver.
    met = first.join(weights.hint("merge"), "dist_id").join(second.hint("merge"), "dist_id", "left")
    own = F.transform(F.filter("all", lambda x: x["token_id"] == F.col("token_id")), lambda x: x["p"])
    met = met.select("token_id", "again", "want", F.explode_outer(own).alias("p"))
    close = F.abs(F.avg("p") - F.avg("want")) < 3 / F.sqrt(F.count("*"))
    return met.agg(F.count("*").alias("n"), F.count("p").alias("n_possible"), F.count_if(F.col("again") != F.col("token_id")).alias("n_changed"), close.alias("by_weight"))


@query("d14_draw")
def _(t):
    return D.draw(dists(t), 7)


@query(
    "d18_chain",
    f"""WITH {DISTS}, k AS (SELECT *, row_number() OVER (PARTITION BY dist_id ORDER BY logit DESC, token_id) AS r, max(logit) OVER (PARTITION BY dist_id) AS m FROM dists),
a AS (SELECT *, exp(logit - m) / sum(exp(logit - m)) OVER (PARTITION BY dist_id) AS p FROM k WHERE r <= 10),
b AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY dist_id ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM a),
e AS (SELECT dist_id, token_id, exp((logit - m) / 0.8) AS e FROM b WHERE c < 0.95 AND logit >= m + ln(0.02))
SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM e""",
)
def _(t):
    out = D.chain(dists(t), {"top_k": {"k": 10}, "top_p": {"p": 0.95}, "min_p": {"p": 0.02}, "temperature": {"t": 0.8}})
    return out.select("dist_id", "token_id", F.round("p", 9).alias("p"))


@query(
    "u3_own_step",
    f"""WITH {DISTS}, k AS (SELECT *, row_number() OVER (PARTITION BY dist_id ORDER BY logit DESC, token_id) AS r FROM dists),
o AS (SELECT dist_id, token_id, logit FROM k WHERE r <= 10 AND token_id % 2 = 1), e AS (SELECT *, exp((logit - max(logit) OVER (PARTITION BY dist_id)) / 0.8) AS e FROM o)
SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM e""",
)
def _(t):
    """A step of the user's own between two named ones."""
    odd = lambda df: df.filter("token_id % 2 = 1")
    out = D.chain(dists(t), {"top_k": {"k": 10}, "temperature": {"t": 0.8}}, ("top_k", odd, "temperature"))
    return out.select("dist_id", "token_id", F.round("p", 9).alias("p"))


def _soft(name: str, src: str) -> str:
    own = "OVER (PARTITION BY dist_id)"
    return f"{name}_e AS (SELECT dist_id, token_id, logit, exp(logit - max(logit) {own}) AS e FROM {src}), {name} AS (SELECT dist_id, token_id, logit, e / sum(e) {own} AS p, max(logit) {own} AS m, count(*) {own} AS n FROM {name}_e)"


BY_LOGIT = "(PARTITION BY dist_id ORDER BY logit DESC, token_id)"


@query(
    "d18_default_chain",
    f"""WITH {DISTS}, {HISTORY}, c AS (SELECT dist_id, tok AS token_id, count(*) AS c FROM (SELECT dist_id, unnest(h[-6:]) AS tok FROM hist) GROUP BY 1, 2),
pen AS (SELECT dist_id, token_id, CASE WHEN c IS NULL THEN logit ELSE (CASE WHEN logit <= 0 THEN logit * 1.3 ELSE logit / 1.3 END) - (c * 0.2 + 0.1) END AS logit FROM dists LEFT JOIN c USING (dist_id, token_id)),
hk AS (SELECT dist_id, h, unnest(range(1, 8)) AS k FROM hist),
hz AS (SELECT dist_id, h[8 - k + 1] AS token_id, list_position(list_transform(range(0, 9 - k), lambda n: n < 8 - k AND h[8 - n] = h[8 - n - k]), false) - 1 AS z FROM hk),
hr AS (SELECT dist_id, token_id, max(z) AS z FROM hz WHERE z >= 1 GROUP BY 1, 2),
dried AS (SELECT dist_id, token_id, logit - CASE WHEN z IS NULL THEN 0 ELSE 0.8 * pow(1.75, z - 1) END AS logit FROM pen LEFT JOIN hr USING (dist_id, token_id)),
sigma AS (SELECT dist_id, token_id, CASE WHEN logit < max(logit) OVER w - 2.0 * stddev_pop(logit) OVER w THEN '-infinity'::DOUBLE ELSE logit END AS logit FROM dried WINDOW w AS (PARTITION BY dist_id)),
few AS (SELECT * FROM sigma QUALIFY row_number() OVER {BY_LOGIT} <= 12), {_soft('t0', 'few')},
t1 AS (SELECT *, sum(CASE WHEN p > 0 THEN -p * ln(p) ELSE 0 END) OVER (PARTITION BY dist_id) AS h FROM t0),
t2 AS (SELECT *, CASE WHEN p > 0 THEN abs(-ln(p) - h) ELSE 'infinity'::DOUBLE END AS s FROM t1),
t3 AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY dist_id ORDER BY s, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cs, row_number() OVER (PARTITION BY dist_id ORDER BY s, token_id) AS rs FROM t2),
t4 AS (SELECT dist_id, token_id, logit FROM t3 WHERE cs <= 0.95 OR rs = 1), {_soft('p0', 't4')},
p1 AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY dist_id ORDER BY logit DESC, token_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c, row_number() OVER {BY_LOGIT} AS r FROM p0),
p2 AS (SELECT dist_id, token_id, logit FROM p1 WHERE (c < 0.9 OR r = 1) AND logit >= m + ln(0.02)), {_soft('x0', 'p2')},
x1 AS (SELECT *, row_number() OVER {BY_LOGIT} - 1 AS r, greatest(sum((p >= 0.2)::INTEGER) OVER (PARTITION BY dist_id) - 1, 0) AS last FROM x0),
x2 AS (SELECT dist_id, token_id, exp((logit - m) / 0.8) AS e FROM x1 WHERE n < 2 OR r >= last)
SELECT dist_id, token_id, round(e / sum(e) OVER (PARTITION BY dist_id), 9) AS p FROM x2""",
)
def _(t):
    """All nine steps of the default order."""
    past = history(t)
    settings = {
        "penalties": {"history": past, "last_n": 6, "repeat": 1.3, "freq": 0.2, "present": 0.1},
        "dry": {"history": past, "multiplier": 0.8, "base": 1.75, "allowed": 1},
        "top_n_sigma": {"n": 2.0}, "top_k": {"k": 12}, "typical": {"p": 0.95}, "top_p": {"p": 0.9}, "min_p": {"p": 0.02},
        "xtc": {"probability": 1.0, "threshold": 0.2}, "temperature": {"t": 0.8},
    }
    return D.chain(dists(t), settings).select("dist_id", "token_id", F.round("p", 9).alias("p"))
