"""Calibration queries: ``lineitem`` folded into activations, ``embeddings`` into direction rows."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.function_queries import V, digest, sql_digest, vecs
from loomspark.operators import calib as C, hooks
from loomspark.plans.prefix import running_sums

ACT = "act AS (SELECT 'blk.' || l_suppkey % 5 || '.ffn' AS tensor, (l_partkey % 2)::INTEGER AS expert, l_orderkey AS row, l_linenumber AS col, l_quantity / 50 AS x FROM lineitem)"


def activations(t):
    return t.lineitem.select(
        F.concat(F.lit("blk."), (F.col("l_suppkey") % 5).cast("string"), F.lit(".ffn")).alias("tensor"),
        (F.col("l_partkey") % 2).cast("int").alias("expert"), F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("col"), (F.col("l_quantity") / 50).alias("x"),
    )


NAMES = "CASE l_orderkey % 3 WHEN 0 THEN 'CUDA0#blk.' || l_linenumber || '#0' WHEN 1 THEN 'x#blk.' || l_linenumber ELSE 'blk.' || l_linenumber END"


@query("c1_tensor_name", f"SELECT l_orderkey % 3 AS form, 'blk.' || l_linenumber AS name, count(*) AS n FROM lineitem GROUP BY ALL")
def _(t):
    ln, k = F.col("l_linenumber").cast("string"), F.col("l_orderkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("CUDA0#blk."), ln, F.lit("#0"))).when(k == 1, F.concat(F.lit("x#blk."), ln)).otherwise(F.concat(F.lit("blk."), ln))
    return t.lineitem.select(k.alias("form"), C.tensor_name(raw).alias("name")).groupBy("form", "name").agg(F.count("*").alias("n"))


@query(
    "c2_select_activations",
    """WITH c AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'MUL_MAT_ID' ELSE 'MUL_MAT' END AS op, (o_custkey % 40) AS n_rows, CASE WHEN o_custkey % 3 = 0 THEN 'F16' ELSE 'F32' END AS dtype,
 CASE o_orderkey % 5 WHEN 0 THEN 'output.weight' WHEN 1 THEN 'token_embd' ELSE 'blk.1.x' END AS tensor FROM orders)
SELECT o_orderkey, op, n_rows, dtype, tensor FROM c WHERE op = 'MUL_MAT_ID' OR (n_rows >= 16 AND dtype = 'F32' AND (tensor LIKE 'blk.%' OR tensor = 'output.weight'))""",
)
def _(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    rows = t.orders.select(
        "o_orderkey", F.when(k % 4 == 0, "MUL_MAT_ID").otherwise("MUL_MAT").alias("op"), (c % 40).alias("n_rows"), F.when(c % 3 == 0, "F16").otherwise("F32").alias("dtype"),
        F.when(k % 5 == 0, "output.weight").when(k % 5 == 1, "token_embd").otherwise("blk.1.x").alias("tensor"),
    )
    return C.select_activations(rows, process_output=True)


@query("u2_observe", f"WITH {ACT} SELECT tensor, col, count(*) AS n, round(max(abs(x)), 9) AS top FROM act WHERE tensor IN ('blk.1.ffn', 'blk.3.ffn') AND expert = 1 GROUP BY ALL")
def _(t):
    """A user's callback: asked for each row's tensor, then handed the rows it wants."""
    wanted = lambda df: df.tensor.isin("blk.1.ffn", "blk.3.ffn") & (df.expert == 1)
    peaks = lambda df: df.groupBy("tensor", "col").agg(F.count("*").alias("n"), F.round(F.max(F.abs("x")), 9).alias("top"))
    return hooks.observe(activations(t), wanted, peaks)


@query("c3_importance_sums", f"WITH {ACT} SELECT tensor, expert, col, round(sum(x * x), 6) AS sum_sq, count(*) AS cnt FROM act GROUP BY ALL")
def _(t):
    return C.importance_sums(activations(t)).withColumn("sum_sq", F.round("sum_sq", 6))


@query(
    "c3_importance_dense",
    f"WITH {V}, x AS (SELECT 'blk.' || label % 3 AS tensor, (label % 2)::INTEGER AS expert, unnest(v) AS x, (generate_subscripts(v, 1) - 1)::INTEGER AS col FROM e) SELECT tensor, expert, col, round(sum(x * x), 6) AS sum_sq, count(*) AS cnt FROM x GROUP BY ALL",
)
def _(t):
    rows = vecs(t).select(F.concat(F.lit("blk."), (F.col("label") % 3).cast("string")).alias("tensor"), (F.col("label") % 2).alias("expert"), F.col("v").alias("vec"))
    return C.importance_sums_dense(rows).withColumn("sum_sq", F.round("sum_sq", 6))


@query("c4_assert_finite", f"WITH {ACT}, s AS (SELECT tensor, sum(x * x) AS s FROM act GROUP BY ALL) SELECT count(*) AS n, bool_and(isfinite(s)) AS finite FROM s")
def _(t):
    sums = C.assert_finite(C.importance_sums(activations(t)))
    return sums.groupBy("tensor").agg(F.sum("sum_sq").alias("s")).agg(F.count("*").alias("n"), F.bool_and(F.abs("s") < float("inf")).alias("finite"))


@query("c5_assert_dims", f"WITH {V} SELECT 'label ' || label AS tensor, max(len(v))::INTEGER AS dim FROM e GROUP BY ALL")
def _(t):
    rows = vecs(t).select(F.concat(F.lit("label "), F.col("label").cast("string")).alias("tensor"), F.size("v").alias("dim"))
    return C.assert_dims(rows).groupBy("tensor").agg(F.max("dim").alias("dim"))


IMP = f"""{ACT}, s AS (SELECT tensor, expert, col, sum(x * x) AS sum_sq, count(*) FILTER (x > 0.02) AS cnt FROM act GROUP BY ALL), nc AS (SELECT tensor, count(DISTINCT row) AS ncall FROM act GROUP BY 1)"""


def sums_with_gaps(t):
    return activations(t).groupBy("tensor", "expert", "col").agg(F.sum(F.col("x") * F.col("x")).alias("sum_sq"), F.count_if(F.col("x") > 0.02).alias("cnt"))


@query(
    "c6_importance",
    f"WITH {IMP}, ok AS (SELECT tensor FROM s GROUP BY 1 HAVING min(cnt) > 0) SELECT tensor, expert, col, round(sum_sq / cnt * ncall, 6) AS value FROM s JOIN ok USING (tensor) JOIN nc USING (tensor)",
)
def _(t):
    calls = activations(t).groupBy("tensor").agg(F.count_distinct("row").alias("ncall"))
    return C.importance(sums_with_gaps(t), calls).withColumn("value", F.round("value", 6))


@query("c6_coverage", f"WITH {IMP} SELECT tensor, count(*) AS n, count(*) FILTER (cnt = 0) AS empty, round(100 * (count(*) - count(*) FILTER (cnt = 0)) / count(*), 6) AS pct FROM s GROUP BY 1")
def _(t):
    return C.importance_coverage(sums_with_gaps(t)).withColumn("pct", F.round("pct", 6))


@query(
    "c7_importance_merge",
    f"WITH {ACT}, f AS (SELECT row % 3 AS file, tensor, expert, col, sum(x * x) AS value, count(*) AS n FROM act GROUP BY ALL) SELECT tensor, expert, col, round(sum(value), 6) AS value, sum(n)::BIGINT AS cnt, sum(n)::BIGINT AS ncall FROM f GROUP BY 1, 2, 3",
)
def _(t):
    rows = activations(t)
    files = [
        C.importance_sums(rows.filter(F.col("row") % 3 == k)).select("tensor", "expert", "col", F.col("sum_sq").alias("value"), "cnt", F.col("cnt").alias("ncall"))
        for k in range(3)
    ]
    return C.importance_merge(*files).withColumn("value", F.round("value", 6))


SIDES = """o AS (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM e),
d AS (SELECT a.label // 2 AS layer, a.pos, list_transform(list_zip(a.v, b.v), lambda p: p[1] - p[2]) AS vec FROM o a JOIN o b ON a.label // 2 = b.label // 2 AND a.pos = b.pos AND a.label % 2 = 0 AND b.label % 2 = 1 WHERE a.label // 2 < 4)"""


def sides(t):
    rows = running_sums(vecs(t).select("label", "vec_id"), ["label"], "vec_id", {"pos": F.lit(1).cast("long")}, inclusive=False)
    both = vecs(t).join(rows.select("vec_id", "pos"), "vec_id").select((F.col("label") / 2).cast("int").alias("layer"), (F.col("label") % 2).alias("side"), "pos", F.col("v").alias("vec"))
    return C.diff_rows(both.filter("side = 0").drop("side"), both.filter("side = 1").drop("side"))


@query("c8_diff_rows", f"WITH {V}, {SIDES} SELECT layer, pos, {sql_digest('vec')} AS d FROM d")
def _(t):
    return sides(t).select("layer", "pos", digest("vec").alias("d"))


@query(
    "c9_direction_mean",
    f"""WITH {V}, {SIDES}, x AS (SELECT layer, unnest(vec) AS x, generate_subscripts(vec, 1) AS j FROM d), m AS (SELECT layer, j, avg(x) AS x FROM x GROUP BY 1, 2), l AS (SELECT layer, list(x ORDER BY j) AS c, sqrt(sum(x * x)) AS n FROM m GROUP BY 1)
SELECT layer, {sql_digest('list_transform(c, lambda x: x / n)')} AS d FROM l""",
)
def _(t):
    return C.direction_mean(sides(t)).select("layer", digest("vec").alias("d"))


RANK_ONE = "list_transform(range(1, 65), lambda j: (j + label % 3) / 64.0::DOUBLE)"


@query(
    "c10_direction_rank_one",
    f"""WITH {V}, u AS (SELECT DISTINCT label AS layer, {RANK_ONE} AS u FROM e), s AS (SELECT layer, u, sqrt(list_sum(list_transform(u, lambda x: x * x))) AS n FROM u)
SELECT layer, {sql_digest('list_transform(u, lambda x: x / n)')} AS d FROM s""",
)
def _(t):
    """Every row of a layer is a multiple of one vector, which is the direction."""
    u = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda j: (j + F.col("label") % 3) / F.lit(64.0) * (F.get("v", F.lit(0)) + 2) * F.when(F.col("vec_id") % 2 == 0, 1.0).otherwise(-1.0))
    return C.direction_pca(vecs(t).select(F.col("label").alias("layer"), u.alias("vec"))).select("layer", digest("vec").alias("d"))


@query("c10_direction_pca")
def _(t):
    return C.direction_pca(sides(t)).select("layer", digest("vec", 4).alias("d"))


@query(
    "c11_combine_directions",
    f"""WITH {V}, x AS (SELECT label % 4 + 1 AS layer, (vec_id % 3 + 1) * 0.5 AS strength, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM e), m AS (SELECT layer, j, sum(strength * x) AS x FROM x GROUP BY 1, 2)
SELECT layer::INTEGER AS layer, {sql_digest('list(x ORDER BY j)')} AS d FROM m GROUP BY 1""",
)
def _(t):
    rows = vecs(t).select(
        F.col("vec_id").alias("file"), F.concat(F.lit("direction."), (F.col("label") % 4 + 1).cast("string")).alias("name"), F.col("v").alias("vec"), ((F.col("vec_id") % 3 + 1) * 0.5).alias("strength")
    )
    return C.combine_directions(rows).select("layer", digest("vec").alias("d"))


@query("c12_tensor_sums", f"WITH {ACT} SELECT tensor, round(sum(x), 6) AS total, count(*) AS n FROM act GROUP BY 1")
def _(t):
    return C.tensor_sums(activations(t)).withColumn("total", F.round("total", 6))
