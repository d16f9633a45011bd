"""Scalar and array functions over whole tables."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.functions import arrays as A
from loomspark.functions import text


@query(
    "f1_strip",
    r"""SELECT conv_id, turn, md5(regexp_replace(chr(9) || ' ' || text || ' ' || chr(10), '^\s+|\s+$', '', 'g')) AS digest FROM conversations""",
)
def _(t):
    padded = F.concat(F.lit("\t "), "text", F.lit(" \n"))
    return t.conversations.select("conv_id", "turn", F.md5(text.strip(padded)).alias("digest"))


@query("f2_replace_all", "SELECT doc_id, md5(replace(text, 'the', '<>')) AS digest, md5(text) AS same FROM documents")
def _(t):
    return t.documents.select(
        "doc_id", F.md5(text.replace_all("text", "the", "<>")).alias("digest"), F.md5(text.replace_all("text", "", "x")).alias("same")
    )


@query(
    "f3_join_split_repeat",
    "SELECT doc_id, len(string_split(text, ' '))::INTEGER AS n, md5(array_to_string(string_split(text, ' '), '_')) AS digest, repeat(lang, 3) AS thrice FROM documents",
)
def _(t):
    parts = text.split_keep_empty("text", " ")
    return t.documents.select(
        "doc_id", F.size(parts).alias("n"), F.md5(F.array_join(parts, "_")).alias("digest"), F.repeat("lang", F.lit(3)).alias("thrice")
    )


@query(
    "f4_ends_with_escape",
    r"""SELECT page_id, ends_with(html, '</html>') AS closed, regexp_replace(url, '([.^$|()*+?\[\]{}\\])', '\\\1', 'g') AS pattern FROM pages""",
)
def _(t):
    return t.pages.select("page_id", text.ends_with("html", "</html>").alias("closed"), text.escape_regex("url").alias("pattern"))


@query("f5_sortable_stamp", "SELECT event_id, strftime(ts, '%Y_%m_%d-%H_%M_%S.%f') || '000' AS stamp FROM events")
def _(t):
    return t.events.select("event_id", text.sortable_stamp("ts").alias("stamp"))


@query("f7_json_default", "SELECT event_id, (props->>'$.k')::BIGINT AS k, -1::BIGINT AS missing, 'none' AS wrong_type FROM events")
def _(t):
    return t.events.select(
        "event_id",
        text.json_or("props", "$.k", "bigint", -5).alias("k"),
        text.json_or("props", "$.a.b", "bigint", -1).alias("missing"),
        F.coalesce(F.when(F.schema_of_variant(F.parse_json("props")) == "STRING", F.lit("text")), F.lit("none")).alias("wrong_type"),
    )


@query("f8_base64", "SELECT conv_id, turn, base64(encode(text)) AS b64, md5(text) AS digest FROM conversations")
def _(t):
    b64 = F.replace(F.base64(F.encode("text", "UTF-8")), F.lit("\r\n"), F.lit(""))
    return t.conversations.select("conv_id", "turn", b64.alias("b64"), F.md5(F.unbase64(b64)).alias("digest"))


@query(
    "f10_utf8",
    "SELECT doc_id, length(text)::INTEGER AS n_chars, strlen(text)::INTEGER AS n_bytes, md5(lower(text)) AS digest, ord(text) AS first_cp FROM documents",
)
def _(t):
    return t.documents.select(
        "doc_id", F.char_length("text").alias("n_chars"), F.octet_length("text").alias("n_bytes"), F.md5(F.lower("text")).alias("digest"), F.ascii("text").alias("first_cp")
    )


def vecs(t):
    return t.embeddings.select("vec_id", "label", A.as_double("embedding").alias("v"))


V = "e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings)"


def sql_digest(expr, places=6):
    """A vector as text, rounded."""
    return f"array_to_string(list_transform({expr}, lambda q: printf('%.{places}f', round(q, {places}) + 0.0)), ',')"


def digest(col, places=6):
    return F.array_join(F.transform(col, lambda q: F.format_string(f"%.{places}f", F.round(q, places) + F.lit(0.0))), ",")


@query("a1_sum_mean", f"WITH {V} SELECT vec_id, round(list_sum(v), 9) AS total, round(list_avg(v), 9) AS mean FROM e")
def _(t):
    return vecs(t).select("vec_id", F.round(A.fsum("v"), 9).alias("total"), F.round(A.fmean("v"), 9).alias("mean"))


@query(
    "a2_argmax_last",
    "WITH e AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: round(x, 1)) AS v FROM embeddings) "
    "SELECT vec_id, (len(v) - list_position(list_reverse(v), list_max(v)))::INTEGER AS last, (list_position(v, list_max(v)) - 1)::INTEGER AS first FROM e",
)
def _(t):
    rows = vecs(t).select("vec_id", F.transform("v", lambda x: F.round(x, 1)).alias("v"))
    return rows.select("vec_id", A.argmax_last("v").alias("last"), A.argmax_first("v").alias("first"))


@query(
    "a3_argsort_topk",
    f"""WITH {V}, x AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS i FROM e)
SELECT vec_id, string_agg(i::VARCHAR, ',' ORDER BY x, i) AS up, list(i::VARCHAR ORDER BY x DESC, i)[1] || ',' || list(i::VARCHAR ORDER BY x DESC, i)[2] || ',' || list(i::VARCHAR ORDER BY x DESC, i)[3] AS top FROM x GROUP BY 1""",
)
def _(t):
    return vecs(t).select("vec_id", F.array_join(A.argsort("v"), ",").alias("up"), F.array_join(A.top_k_indices("v", 3), ",").alias("top"))


@query(
    "a4_count_equal",
    f"WITH {V} SELECT vec_id, len(list_filter(list_zip(list_transform(v, lambda x: round(x, 1)), list_transform(list_reverse(v), lambda x: round(x, 1))), lambda p: p[1] = p[2]))::INTEGER AS n FROM e",
)
def _(t):
    r = lambda a: F.transform(a, lambda x: F.round(x, 1))
    return vecs(t).select("vec_id", A.count_equal(r("v"), r(F.reverse("v"))).alias("n"))


@query(
    "a5_elementwise",
    f"""WITH {V}, z AS (SELECT vec_id, v, list_zip(v, list_reverse(v)) AS z FROM e)
SELECT vec_id, round(list_sum(list_transform(z, lambda p: p[1] + p[2])), 6) AS a, round(list_sum(list_transform(z, lambda p: p[1] - 2 * p[2])), 6) AS s,
  round(list_sum(list_transform(z, lambda p: p[1] * p[2])), 6) AS m, round(list_sum(list_transform(z, lambda p: p[1] / (2 + p[2]))), 6) AS d,
  {sql_digest("list_transform(v, lambda x: x * x + sqrt(abs(x)) + ln(abs(x) + 1) + sin(x) + cos(x) + exp(x) - x)")} AS u FROM z""",
)
def _(t):
    b = F.reverse("v")
    u = A.unary("v", lambda x: x * x + F.sqrt(F.abs(x)) + F.ln(F.abs(x) + 1) + F.sin(x) + F.cos(x) + F.exp(x) - x)
    total = lambda fn: F.round(A.fsum(A.binary("v", b, fn)), 6)
    return vecs(t).select(
        "vec_id",
        total(lambda x, y: x + y).alias("a"),
        total(lambda x, y: x - 2 * y).alias("s"),
        total(lambda x, y: x * y).alias("m"),
        total(lambda x, y: x / (2 + y)).alias("d"),
        digest(u).alias("u"),
    )


@query(
    "a6_sign_step",
    f"WITH {V} SELECT vec_id, list_sum(list_transform(v, lambda x: sign(x)::DOUBLE)) AS signs, list_sum(list_transform(v, lambda x: CASE WHEN x > 0 THEN 1.0::DOUBLE ELSE 0 END)) AS steps FROM e",
)
def _(t):
    return vecs(t).select("vec_id", A.fsum(A.sgn("v")).alias("signs"), A.fsum(A.step("v")).alias("steps"))


_ACT = {
    "tanh": "(exp(x) - exp(-x)) / (exp(x) + exp(-x))",
    "elu": "CASE WHEN x > 0 THEN x ELSE exp(x) - 1 END",
    "relu": "greatest(x, 0)",
    "leaky_relu": "CASE WHEN x > 0 THEN x ELSE 0.1 * x END",
    "sigmoid": "1 / (1 + exp(-x))",
    "gelu": "0.5 * x * (1 + (1 - exp(-2 * 0.79788456080286536 * x * (1 + 0.044715 * x * x))) / (1 + exp(-2 * 0.79788456080286536 * x * (1 + 0.044715 * x * x))))",
    "gelu_quick": "x / (1 + exp(-1.702 * x))",
    "silu": "x / (1 + exp(-x))",
    "hard_swish": "x * least(1, greatest(0, (x + 3) / 6))",
    "hard_sigmoid": "least(1, greatest(0, (x + 3) / 6))",
}


@query(
    "a7_activations",
    f"WITH {V}, w AS (SELECT vec_id, list_transform(v, lambda q: q * 20) AS v FROM e) SELECT vec_id, "
    + ", ".join(f"round(list_sum(list_transform(v, lambda x: ({e})::DOUBLE)), 6) AS {k}" for k, e in _ACT.items())
    + " FROM w",
)
def _(t):
    rows = vecs(t).select("vec_id", A.scale("v", 20.0).alias("v"))
    return rows.select("vec_id", *[F.round(A.fsum(A.activate("v", k)), 6).alias(k) for k in _ACT])


MEAN = "list_avg(v)"


@query(
    "a8_standardise",
    f"WITH {V}, m AS (SELECT vec_id, v, list_avg(v) AS mu FROM e), s AS (SELECT vec_id, v, mu, list_avg(list_transform(v, lambda x: (x - mu) * (x - mu))) AS var FROM m) "
    f"SELECT vec_id, {sql_digest('list_transform(v, lambda x: (x - mu) / sqrt(var + 0.00001))')} AS d FROM s",
)
def _(t):
    return vecs(t).select("vec_id", digest(A.standardise("v", 1e-5)).alias("d"))


@query(
    "a9_rms_group_norm",
    f"""WITH {V}, s AS (SELECT vec_id, v, list_avg(list_transform(v, lambda x: x * x)) AS ms FROM e),
x AS (SELECT vec_id, (generate_subscripts(v, 1) - 1) AS i, unnest(v) AS x FROM e),
g AS (SELECT vec_id, i, x - avg(x) OVER w AS c, var_pop(x) OVER w AS var FROM x WINDOW w AS (PARTITION BY vec_id, i // 16)),
h AS (SELECT vec_id, list(c / sqrt(var + 0.000001) ORDER BY i) AS gn FROM g GROUP BY 1)
SELECT vec_id, {sql_digest('list_transform(v, lambda x: x / sqrt(ms + 0.000001))')} AS rms, {sql_digest('gn')} AS grp FROM s JOIN h USING (vec_id)""",
)
def _(t):
    return vecs(t).select("vec_id", digest(A.rms_norm("v")).alias("rms"), digest(A.group_norm("v", 4)).alias("grp"))


@query(
    "a10_l2_norm",
    f"WITH {V}, s AS (SELECT vec_id, v, greatest(sqrt(list_sum(list_transform(v, lambda x: x * x))), 1e-12) AS n FROM e) SELECT vec_id, {sql_digest('list_transform(v, lambda x: x / n)')} AS d FROM s",
)
def _(t):
    return vecs(t).select("vec_id", digest(A.l2_norm("v")).alias("d"))


@query(
    "a11_scale_clamp",
    f"WITH {V} SELECT vec_id, {sql_digest('list_transform(v, lambda x: x * 2.5)')} AS s, {sql_digest('list_transform(v, lambda x: least(greatest(x, -0.1), 0.1)::DOUBLE)')} AS c FROM e",
)
def _(t):
    return vecs(t).select("vec_id", digest(A.scale("v", 2.5)).alias("s"), digest(A.clamp("v", -0.1, 0.1)).alias("c"))


@query(
    "a12_shape",
    f"""WITH {V} SELECT vec_id, {sql_digest('list_concat(v, [0.0, 0.0]::DOUBLE[])')} AS padded, {sql_digest('list_concat(list_reverse(v[2:4]), v, list_reverse(v[-3:-2]))')} AS mirrored,
 {sql_digest('list_concat(v[-5:], v[:-6])')} AS rolled, {sql_digest('list_concat(v, v)')} AS doubled, '0.0,0.5,1.0,1.5' AS steps FROM e""",
)
def _(t):
    return vecs(t).select(
        "vec_id",
        digest(A.pad_zero("v", 2)).alias("padded"),
        digest(A.pad_reflect("v", 3, 2)).alias("mirrored"),
        digest(A.roll("v", 5)).alias("rolled"),
        digest(F.concat("v", "v")).alias("doubled"),
        F.array_join(A.arange(0.0, 2.0, 0.5).cast("array<string>"), ",").alias("steps"),
    )


@query(
    "a13_gather",
    f"""WITH {V} SELECT vec_id, {sql_digest('[v[vec_id % 64 + 1], v[1], v[64]]')} AS g FROM e""",
)
def _(t):
    idx = F.array((F.col("vec_id") % 64).cast("int"), F.lit(0), F.lit(63))
    return vecs(t).select("vec_id", digest(A.gather("v", idx)).alias("g"))


@query(
    "a13_scatter",
    f"""WITH {V} SELECT vec_id, {sql_digest('list_transform(v, lambda x, i: CASE WHEN i = vec_id % 64 + 1 THEN v[2] WHEN i = 64 THEN v[1] ELSE x END)')} AS s FROM e""",
)
def _(t):
    at = (F.col("vec_id") % 64).cast("int")
    idx = F.array(F.lit(63), at, F.lit(64))
    put = F.array(F.get("v", F.lit(0)), F.get("v", F.lit(1)), F.lit(0.0))
    return vecs(t).select("vec_id", digest(A.scatter("v", idx, put)).alias("s"))


@query(
    "a16_outer_product",
    f"""WITH {V}, x AS (SELECT v[i + 1] * v[j + 1] AS y, i, j FROM e, unnest(range(4)) AS r(i), unnest(range(3)) AS s(j))
SELECT i::INTEGER AS i, j::INTEGER AS j, round(sum(y), 6) AS y FROM x GROUP BY 1, 2""",
)
def _(t):
    """The sum of all rows' outer products."""
    rows = vecs(t).select(F.posexplode(A.outer(F.slice("v", 1, 4), F.slice("v", 1, 3))).alias("i", "row"))
    cells = rows.select("i", F.posexplode("row").alias("j", "y"))
    return cells.groupBy("i", "j").agg(F.round(F.sum("y"), 6).alias("y"))


@query(
    "a14_pool",
    f"""WITH {V} SELECT vec_id, {sql_digest('list_transform(range(0, 12), lambda i: list_max(v[i * 5 + 1:i * 5 + 5]))')} AS mx, {sql_digest('list_transform(range(0, 12), lambda i: list_avg(v[i * 5 + 1:i * 5 + 5]))')} AS av FROM e""",
)
def _(t):
    return vecs(t).select("vec_id", digest(A.pool("v", 5, "max")).alias("mx"), digest(A.pool("v", 5, "avg")).alias("av"))


@query(
    "a15_softmax_cross_entropy",
    f"""WITH {V}, m AS (SELECT vec_id, label, v, list_sum(list_transform(v, lambda x: exp(x))) AS z, list_sum(list_transform(v, lambda x: exp(-x))) AS y FROM e),
r AS (SELECT label, list_sum(list_transform(v, lambda x: exp(-x) / y * (x - ln(z)))) AS ce, list_max(list_transform(v, lambda x: exp(x) / z)) AS top FROM m)
SELECT label, round(-avg(ce), 9) AS loss, round(max(top), 9) AS top FROM r GROUP BY 1""",
)
def _(t):
    rows = vecs(t).select("label", A.cross_entropy("v", A.softmax(A.scale("v", -1.0))).alias("ce"), F.array_max(A.softmax("v")).alias("top"))
    return rows.groupBy("label").agg(F.round(F.avg("ce"), 9).alias("loss"), F.round(F.max("top"), 9).alias("top"))


@query(
    "a16_matrix_vector",
    f"""WITH {V}, x AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS j FROM e)
SELECT vec_id, i::INTEGER AS i, round(sum(x * (((i * 64 + j) % 7) - 3) / 10.0::DOUBLE), 6) AS y FROM x, unnest(range(4)) AS r(i) GROUP BY 1, 2""",
)
def _(t):
    import numpy as np

    from loomspark.operators.vectors import pool_rank

    w = (((np.arange(4)[:, None] * 64 + np.arange(64)) % 7) - 3) / 10.0
    rows = pool_rank(vecs(t), key="vec_id", vec="v", out=w)
    return rows.select("vec_id", F.posexplode("scores").alias("i", "y")).withColumn("y", F.round("y", 6))
