"""Window, chunk and batch queries over the word ids of ``documents``."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.inputs import CORPUS, DOCS, IDS, doc_ids, doc_words
from loomspark.functions import text
from loomspark.operators import windows as w
from loomspark.plans.prefix import neighbour, running_sums

N_CTX = 128


def checked(df, group, *cols):
    """Per group: rows and position-weighted sums, which fix the content and order of each chunk."""
    return df.groupBy(group).agg(
        F.count("*").alias("n"), *[F.sum(F.col(c).cast("long") * (F.col("pos") + 1)).alias(f"{c}_sum") for c in cols]
    )


@query(
    "w1_chunks",
    f"""WITH {CORPUS} SELECT gpos // 128 AS chunk, count(*) AS n, sum(token_id * (gpos % 128 + 1))::BIGINT AS token_sum
FROM corpus WHERE gpos < (SELECT count(*) // 128 * 128 FROM corpus) GROUP BY 1""",
)
def _(t):
    return checked(w.chunk_tokens(doc_ids(t), N_CTX), "chunk", "token")


@query(
    "w2_skip_chunks",
    f"""WITH {CORPUS}, c AS (SELECT gpos - 3 * 128 AS p, token_id FROM corpus)
SELECT p // 128 AS chunk, count(*) AS n, sum(token_id * (p % 128 + 1))::BIGINT AS token_sum
FROM c WHERE p >= 0 AND p < (SELECT (count(*) - 384) // 128 * 128 FROM corpus) GROUP BY 1""",
)
def _(t):
    return checked(w.chunk_tokens(doc_ids(t), N_CTX, skip=3), "chunk", "token")


@query(
    "w3_stride_windows",
    f"""WITH {CORPUS}, n AS (SELECT count(*) AS n, (count(*) - 64 + 31) // 32 AS n_win FROM corpus),
e AS (SELECT unnest(range(greatest(0, CASE WHEN gpos < 64 THEN 0 ELSE (gpos - 64) // 32 + 1 END), least(n_win - 1, gpos // 32) + 1)) AS win, gpos, token_id FROM corpus, n)
SELECT win, count(*) AS n, sum(token_id * (gpos - win * 32 + 1))::BIGINT AS token_sum,
  sum(CASE WHEN gpos - win * 32 >= 32 THEN token_id ELSE 0 END)::BIGINT AS scored_sum FROM e GROUP BY 1""",
)
def _(t):
    rows = w.stride_windows(doc_ids(t), 64, 32)
    return rows.groupBy("win").agg(
        F.count("*").alias("n"),
        F.sum(F.col("token").cast("long") * (F.col("pos") + 1)).alias("token_sum"),
        F.sum(F.when(F.col("scored"), F.col("token").cast("long")).otherwise(0)).alias("scored_sum"),
    )


@query(
    "w4_score_mask",
    f"""WITH {CORPUS}, c AS (SELECT gpos // 128 AS chunk, gpos % 128 AS pos, token_id, lead(token_id) OVER (PARTITION BY gpos // 128 ORDER BY gpos) AS target
FROM corpus WHERE gpos < (SELECT count(*) // 128 * 128 FROM corpus))
SELECT chunk, count(*) AS n, sum(token_id * (pos + 1))::BIGINT AS token_sum, sum(target * (pos + 1))::BIGINT AS target_sum
FROM c WHERE pos >= 64 AND pos < 127 GROUP BY 1""",
)
def _(t):
    return checked(w.score_mask(w.chunk_tokens(doc_ids(t), N_CTX, ahead=True), N_CTX), "chunk", "token", "target")


@query(
    "w5_with_bos",
    f"""WITH {CORPUS}, c AS (SELECT gpos // 128 AS chunk, gpos % 128 AS pos, token_id AS token, CASE WHEN gpos % 128 = 0 THEN 1000 ELSE token_id END AS input
FROM corpus WHERE gpos < (SELECT count(*) // 128 * 128 FROM corpus))
SELECT chunk, count(*) AS n, sum(token * (pos + 1))::BIGINT AS token_sum, sum(input * (pos + 1))::BIGINT AS input_sum FROM c GROUP BY 1""",
)
def _(t):
    return checked(w.with_bos(w.chunk_tokens(doc_ids(t), N_CTX), 1000), "chunk", "token", "input")


@query(
    "w6_train_windows",
    f"""WITH {CORPUS}, l AS (SELECT gpos, token_id, lead(token_id) OVER (ORDER BY gpos) AS label FROM corpus),
n AS (SELECT (count(*) - 65) // 32 AS n_win FROM corpus),
e AS (SELECT unnest(range(CASE WHEN gpos < 64 THEN 0 ELSE (gpos - 64) // 32 + 1 END, least(n_win - 1, gpos // 32) + 1)) AS win, gpos, token_id, label FROM l, n)
SELECT win, count(*) AS n, sum(token_id * (gpos - win * 32 + 1))::BIGINT AS data_sum, sum(label * (gpos - win * 32 + 1))::BIGINT AS label_sum FROM e GROUP BY 1""",
)
def _(t):
    return checked(w.train_windows(doc_ids(t), 64, 32), "win", "data", "label")


@query(
    "w7_pack_greedy",
    f"""WITH RECURSIVE {DOCS}, o AS (SELECT doc_id, len(toks) AS n, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM docs),
r AS (SELECT idx, doc_id, n, n::BIGINT AS total, 0::BIGINT AS batch FROM o WHERE idx = 0
UNION ALL SELECT o.idx, o.doc_id, o.n, CASE WHEN r.total + o.n > 32768 THEN o.n ELSE r.total + o.n END,
  CASE WHEN r.total + o.n > 32768 THEN r.batch + 1 ELSE r.batch END FROM r JOIN o ON o.idx = r.idx + 1)
SELECT doc_id, n::INTEGER AS n, batch FROM r""",
)
def _(t):
    sizes = doc_words(t).select("doc_id", F.size("tokens").alias("n"))
    rows = running_sums(sizes, [], "doc_id", {"idx": F.lit(1).cast("long")}, inclusive=False)
    return w.pack_greedy(rows, [], "idx", "n", 32768, width=256).select("doc_id", "n", "batch")


PAIRS = """conv AS (SELECT conv_id, turn, role, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS toks FROM conversations),
pairs AS (SELECT a.conv_id, a.turn, a.toks AS a, b.toks AS b FROM conv a JOIN conv b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"""


def turn_pairs(t):
    """Each message with the one after it."""
    rows = t.conversations.select("conv_id", "turn", text.words("text").alias("a"))
    return neighbour(rows, ["conv_id"], "turn", ["a"], 1).filter(F.col("next_a").isNotNull()).withColumnRenamed("next_a", "b")


@query(
    "w8_task_cost",
    f"""WITH {PAIRS} SELECT conv_id, turn, (2 + (len(a) - 2) + (len(b) - 2))::INTEGER AS cost FROM pairs""",
)
def _(t):
    return turn_pairs(t).select(
        "conv_id", "turn", w.task_cost(F.lit(2), F.array(F.size("a"), F.size("b"))).cast("int").alias("cost")
    )


@query(
    "w9_common_prefix",
    """WITH i AS (SELECT conv_id, turn, list_transform(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''), lambda t: length(t) // 4) AS l FROM conversations),
p AS (SELECT a.conv_id, a.turn, a.l AS a, b.l AS b, c.l AS c FROM i a JOIN i b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 JOIN i c ON c.conv_id = a.conv_id AND c.turn = a.turn + 2),
m AS (SELECT *, least(len(a), len(b), len(c)) AS n, list_position(list_transform(range(1, least(len(a), len(b), len(c)) + 1), lambda k: a[k] = b[k] AND a[k] = c[k]), false) AS hit FROM p)
SELECT conv_id, turn, (CASE WHEN coalesce(hit, 0) > 0 THEN hit - 1 ELSE n END)::INTEGER AS shared FROM m""",
)
def _(t):
    rows = t.conversations.select("conv_id", "turn", F.transform(text.words("text"), lambda x: F.floor(F.length(x) / 4)).alias("a"))
    two = neighbour(rows, ["conv_id"], "turn", ["a"], 1).withColumnRenamed("next_a", "b")
    three = neighbour(two, ["conv_id"], "turn", ["b"], 1).withColumnRenamed("next_b", "c")
    return three.filter("b IS NOT NULL AND c IS NOT NULL").select("conv_id", "turn", w.common_prefix("a", "b", "c").alias("shared"))


@query(
    "w10_longest_common_run",
    f"""WITH {PAIRS}, x AS (SELECT conv_id, turn, unnest(a) AS tok, generate_subscripts(a, 1) AS i FROM pairs),
y AS (SELECT conv_id, turn, unnest(b) AS tok, generate_subscripts(b, 1) AS j FROM pairs),
m AS (SELECT conv_id, turn, i, i - j AS d FROM x JOIN y USING (conv_id, turn, tok)),
g AS (SELECT conv_id, turn, d, i - row_number() OVER (PARTITION BY conv_id, turn, d ORDER BY i) AS g FROM m),
r AS (SELECT conv_id, turn, count(*) AS n FROM g GROUP BY conv_id, turn, d, g)
SELECT p.conv_id, p.turn, coalesce(max(n), 0)::INTEGER AS run FROM pairs p LEFT JOIN r USING (conv_id, turn) GROUP BY 1, 2""",
)
def _(t):
    return w.longest_common_run(turn_pairs(t), "a", "b").select("conv_id", "turn", "run")


@query(
    "w11_match_prefix",
    f"""WITH {IDS}, p AS (SELECT doc_id AS prompt_id, list(token_id ORDER BY pos) AS a FROM ids GROUP BY 1),
c AS (SELECT conv_id * 1000 + turn AS cache_id, list_transform(list_filter(string_split_regex(text, '\\s+'), lambda x: x <> ''), lambda t: (ascii(t) * 31 + length(t)) % 97) AS b FROM conversations),
l AS (SELECT prompt_id, cache_id, len(b) AS lb, least(len(a), len(b)) AS n, list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda k: a[k] = b[k]), false) AS hit
  FROM p JOIN c ON a[1] = b[1]),
s AS (SELECT prompt_id, cache_id, lb, CASE WHEN coalesce(hit, 0) > 0 THEN hit - 1 ELSE n END AS shared FROM l),
r AS (SELECT prompt_id, cache_id, shared, row_number() OVER (PARTITION BY prompt_id ORDER BY shared DESC, cache_id) AS rn FROM s WHERE shared / lb > 0.02)
SELECT d.doc_id AS prompt_id, coalesce(r.cache_id, (SELECT min(cache_id) FROM c)) AS cache_id, coalesce(shared, 0)::INTEGER AS shared, r.cache_id IS NULL AS by_age
FROM documents d LEFT JOIN r ON r.prompt_id = d.doc_id AND rn = 1""",
)
def _(t):
    prompts = doc_ids(t).select(F.col("doc_id").alias("prompt_id"), "tokens")
    cache_id = (F.col("conv_id") * 1000 + F.col("turn")).alias("cache_id")
    cached = t.conversations.select(cache_id, cache_id.alias("last_used"), text.word_ids(text.words("text")).alias("tokens"))
    return w.match_prefix(prompts, cached, 0.02)
