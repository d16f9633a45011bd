"""Chunk, embedding and similarity queries."""

import numpy as np
from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.function_queries import V, digest, sql_digest, vecs
from loomspark.functions import arrays as A
from loomspark.operators import vectors as vec
from loomspark.plans.bounds import spread
from loomspark.plans.prefix import running_sums


@query(
    "e1_chunk_text",
    r"""WITH RECURSIVE l AS MATERIALIZED (SELECT doc_id, unnest(p) AS line, generate_subscripts(p, 1) AS i, len(p) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
s AS MATERIALIZED (SELECT doc_id, i, CASE WHEN i < n THEN line || chr(10) ELSE line END AS piece, i = n AS tail FROM l),
r AS (SELECT doc_id, i, strlen(piece) AS cur, 0 AS chunk, NOT tail AND strlen(piece) > 512 AS cut, piece, tail FROM s WHERE i = 1
 UNION ALL SELECT s.doc_id, s.i, CASE WHEN r.cut THEN strlen(s.piece) ELSE r.cur + strlen(s.piece) END, CASE WHEN r.cut THEN r.chunk + 1 ELSE r.chunk END,
  NOT s.tail AND (CASE WHEN r.cut THEN strlen(s.piece) ELSE r.cur + strlen(s.piece) END) > 512, s.piece, s.tail FROM r JOIN s ON s.doc_id = r.doc_id AND s.i = r.i + 1),
m AS (SELECT *, max(chunk) FILTER (cut) OVER (PARTITION BY doc_id) AS last FROM r),
c AS (SELECT doc_id, least(chunk, coalesce(last, 0)) AS chunk_no, string_agg(piece, '' ORDER BY i) AS textdata FROM m GROUP BY 1, 2)
SELECT doc_id, chunk_no::INTEGER AS chunk_no, (coalesce(sum(strlen(textdata)) OVER (PARTITION BY doc_id ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS byte_offset, md5(textdata) AS digest FROM c""",
)
def _(t):
    rows = vec.chunk_text(spread(t.documents.select("doc_id", "text"), "doc_id"), 512, "\n", name="doc_id")
    return rows.select("doc_id", "chunk_no", "byte_offset", F.md5("chunk").alias("digest"))


@query(
    "e2_normalize",
    f"""WITH {V}, n AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n2, list_max(list_transform(v, lambda x: abs(x))) / 32760.0::DOUBLE AS n0,
 pow(list_sum(list_transform(v, lambda x: pow(abs(x), 3))), 1 / 3.0::DOUBLE) AS n3 FROM e)
SELECT vec_id, {sql_digest('list_transform(v, lambda x: x / n2)')} AS euclid, {sql_digest('list_transform(v, lambda x: x / n0)', 3)} AS int16, {sql_digest('list_transform(v, lambda x: x / n3)')} AS cubic, {sql_digest('v')} AS raw FROM n""",
)
def _(t):
    n = lambda p: vec.normalize("v", p)
    return vecs(t).select("vec_id", digest(n(2)).alias("euclid"), digest(n(0), 3).alias("int16"), digest(n(3)).alias("cubic"), digest(n(-1)).alias("raw"))


CENTROIDS = """x AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM e),
mean AS (SELECT label, j, avg(x) AS x FROM x GROUP BY 1, 2), cent AS (SELECT label, list(x ORDER BY j) AS c FROM mean GROUP BY 1)"""


def centroids(t):
    return vec.pool_mean(vecs(t), seq="label", vec="v")


@query(
    "e3_cosine",
    f"WITH {V}, {CENTROIDS} SELECT vec_id, round(list_cosine_similarity(v, c), 9) AS score FROM e JOIN cent USING (label)",
)
def _(t):
    rows = vecs(t).join(centroids(t), "label")
    return rows.select("vec_id", F.round(vec.cosine(F.col("v"), F.col("vec")), 9).alias("score"))


@query(
    "e4_cosine_matrix",
    f"WITH {V}, {CENTROIDS} SELECT a.label AS query_id, b.label AS doc_id, round(list_cosine_similarity(a.c, b.c), 9) AS score FROM cent a, cent b",
)
def _(t):
    m = vec.cosine_matrix(centroids(t).withColumnRenamed("label", "query_id"))
    return m.withColumn("score", F.round("score", 9))


@query(
    "e4_upper_triangle",
    f"WITH {V}, {CENTROIDS} SELECT a.label AS query_id, b.label AS doc_id, round(list_cosine_similarity(a.c, b.c), 9) AS score FROM cent a JOIN cent b ON a.label < b.label",
)
def _(t):
    m = vec.cosine_matrix(centroids(t).withColumnRenamed("label", "query_id"), upper=True)
    return m.withColumn("score", F.round("score", 9))


@query(
    "e4_pairs_above",
    f"WITH {V} SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round(list_cosine_similarity(a.v, b.v), 9) AS score FROM e a JOIN e b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.4",
)
def _(t):
    """All pairs of all vectors that are this much alike."""
    rows = vecs(t).select(F.col("vec_id").alias("query_id"), F.col("v").alias("vec"))
    return vec.cosine_matrix(rows, upper=True, floor=0.4).withColumn("score", F.round("score", 9))


@query(
    "e5_topk_similar",
    f"""WITH {V}, {CENTROIDS}, s AS (SELECT label AS query_id, vec_id AS doc_id, round(list_cosine_similarity(v, c), 12) AS score FROM cent, (SELECT vec_id, v FROM e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= 10""",
)
def _(t):
    queries = centroids(t).withColumnRenamed("label", "query_id")
    corpus = vecs(t).select(F.col("vec_id").alias("doc_id"), F.col("v").alias("vec"))
    return vec.topk_similar(queries, corpus, 10).withColumn("score", F.round("score", 6))


@query(
    "e5_topk_neighbours",
    f"""WITH {V}, s AS (SELECT a.vec_id AS query_id, b.vec_id AS doc_id, round(list_cosine_similarity(a.v, b.v), 12) AS score FROM e a, e b),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s)
SELECT query_id, doc_id, round(score, 6) AS score, rank FROM r WHERE rank <= 3""",
)
def _(t):
    """Every vector as a query: the query set is cut in blocks, none travels whole."""
    rows = vecs(t).withColumnRenamed("v", "vec")
    queries = rows.select(F.col("vec_id").alias("query_id"), "vec")
    corpus = rows.select(F.col("vec_id").alias("doc_id"), "vec")
    return vec.topk_similar(queries, corpus, 3, max_queries=256).withColumn("score", F.round("score", 6))


@query("e6_pool_mean", f"WITH {V}, {CENTROIDS} SELECT label, {sql_digest('c')} AS d FROM cent")
def _(t):
    return centroids(t).select("label", digest("vec").alias("d"))


def sequences(t):
    return vecs(t).select(F.col("label").alias("seq"), F.col("vec_id").alias("pos"), F.col("v").alias("vec"))


@query("e7_pool_cls", f"WITH {V} SELECT label AS seq, {sql_digest('arg_min(v, vec_id)')} AS d FROM e GROUP BY 1")
def _(t):
    return vec.pool_cls(sequences(t)).select("seq", digest("vec").alias("d"))


@query("e8_pool_last", f"WITH {V} SELECT label AS seq, {sql_digest('arg_max(v, vec_id)')} AS d FROM e GROUP BY 1")
def _(t):
    return vec.pool_last(sequences(t)).select("seq", digest("vec").alias("d"))


@query(
    "e9_pool_rank",
    f"""WITH {V}, x AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS j FROM e),
h AS (SELECT vec_id, i, sum(x * (((i * 64 + j) % 7) - 3) / 10.0::DOUBLE) + 0.1 * i AS y FROM x, unnest(range(4)) AS r(i) GROUP BY 1, 2),
t AS (SELECT vec_id, i, (exp(y) - exp(-y)) / (exp(y) + exp(-y)) AS y FROM h)
SELECT vec_id, round(sum(y * (i - 1.5)) + 0.25, 6) AS score FROM t GROUP BY 1""",
)
def _(t):
    w = (((np.arange(4)[:, None] * 64 + np.arange(64)) % 7) - 3) / 10.0
    rows = vec.pool_rank(
        vecs(t), key="vec_id", vec="v", dense=w, dense_bias=np.arange(4) * 0.1, out=(np.arange(4) - 1.5)[None, :], out_bias=np.array([0.25])
    )
    return rows.select("vec_id", F.round(F.get("scores", F.lit(0)), 6).alias("score"))


@query(
    "e10_pool_mean_masked",
    f"""WITH {V}, o AS (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS pos FROM e),
x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM o WHERE pos >= 5), m AS (SELECT label, j, avg(x) AS x FROM x GROUP BY 1, 2),
n AS (SELECT label, list(x ORDER BY j) AS c FROM m GROUP BY 1), k AS (SELECT label, c, sqrt(list_sum(list_transform(c, lambda x: x * x))) AS s FROM n)
SELECT label AS seq, {sql_digest('list_transform(c, lambda x: x / s)')} AS d FROM k""",
)
def _(t):
    ordinal = running_sums(vecs(t).select("label", "vec_id"), ["label"], "vec_id", {"pos": F.lit(1).cast("long")}, inclusive=False)
    rows = vecs(t).join(ordinal.select("vec_id", "pos"), "vec_id").select(F.col("label").alias("seq"), "pos", F.col("v").alias("vec"))
    return vec.pool_mean_masked(rows, 5).select("seq", digest("vec").alias("d"))


@query(
    "e11_cross_cosine",
    f"WITH {V}, {CENTROIDS} SELECT label AS query_id, vec_id AS doc_id, round(list_cosine_similarity(v, c), 9) AS score FROM cent, (SELECT vec_id, v FROM e)",
)
def _(t):
    docs = vecs(t).select(F.col("vec_id").alias("doc_id"), F.col("v").alias("vec"))
    return vec.cross_cosine(centroids(t).withColumnRenamed("label", "query_id"), docs).withColumn("score", F.round("score", 9))


def rerank_input(t):
    rows = vecs(t).join(centroids(t), "label")
    return rows.select(
        F.col("label").alias("query_id"), F.col("vec_id").alias("index"), F.floor(A.dot("v", "vec") * 1000).alias("score"), (F.col("vec_id") % 7 + 3).alias("n_tokens")
    )


@query(
    "e12_rerank_results",
    f"""WITH {V}, {CENTROIDS} SELECT label AS query_id, vec_id AS index, '{{"index":' || vec_id || ',"relevance_score":' || floor(list_inner_product(v, c) * 1000)::BIGINT || '}}' AS result, vec_id % 7 + 3 AS n_tokens FROM e JOIN cent USING (label)""",
)
def _(t):
    return vec.rerank_results(rerank_input(t))


@query(
    "e12_rerank_usage",
    "SELECT label AS query_id, sum(vec_id % 7 + 3)::BIGINT AS prompt_tokens, sum(vec_id % 7 + 3)::BIGINT AS total_tokens FROM embeddings GROUP BY 1",
)
def _(t):
    return vec.rerank_usage(rerank_input(t))


@query(
    "e13_class_scores",
    f"""WITH {V}, l AS (SELECT label, CASE WHEN label % 3 = 0 THEN label::VARCHAR ELSE 'class ' || label END AS name FROM (SELECT DISTINCT label FROM e))
SELECT vec_id AS doc_id, (i - 1)::INTEGER AS idx, name AS label, round(v[i], 6) AS score FROM e, unnest(range(1, 11)) AS r(i) JOIN l ON l.label = i - 1""",
)
def _(t):
    labels = vecs(t).select("label").distinct().select(
        F.col("label").alias("idx"), F.when(F.col("label") % 3 == 0, "").otherwise(F.concat(F.lit("class "), F.col("label").cast("string"))).alias("name")
    )
    rows = vecs(t).select(F.col("vec_id").alias("doc_id"), F.slice("v", 1, 10).alias("scores"))
    return vec.class_scores(rows, labels).withColumn("score", F.round("score", 6))
