"""N-gram queries over the words of ``documents``."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.inputs import DOCS, IDS, TOKS, doc_ids, doc_words
from loomspark.operators import ngrams as ng

BIGRAMS = f"""WITH {DOCS},
g AS (SELECT unnest(list_transform(range(1, greatest(len(toks) - 1, 1)), lambda i: {{'ngram': toks[i] || ' ' || toks[i + 1], 'token': toks[i + 2]}})) AS g FROM docs),
counts AS (SELECT g.ngram AS ngram, g.token AS token, count(*) AS cnt FROM g GROUP BY ALL)"""



def joined():
    return F.array_join("ngram", " ").alias("ngram")



@query(
    "n1_ngram_counts",
    f"""WITH {IDS}, w AS (SELECT doc_id, pos, token_id, lag(token_id, 1) OVER o AS a, lag(token_id, 2) OVER o AS b,
  lag(token_id, 3) OVER o AS c, lag(token_id, 4) OVER o AS d FROM ids WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
g AS (SELECT 1 AS n, a::VARCHAR AS ngram, token_id AS token FROM w WHERE pos >= 1
UNION ALL SELECT 2, concat_ws(' ', b, a), token_id FROM w WHERE pos >= 2
UNION ALL SELECT 3, concat_ws(' ', c, b, a), token_id FROM w WHERE pos >= 3
UNION ALL SELECT 4, concat_ws(' ', d, c, b, a), token_id FROM w WHERE pos >= 4),
cc AS (SELECT n, ngram, token, count(*) AS cnt FROM g GROUP BY ALL)
SELECT n, token, count(*) AS contexts, sum(cnt)::BIGINT AS total, max(cnt) AS top, min(ngram) AS first_ngram FROM cc GROUP BY ALL""",
)
def _(t):
    counts = ng.ngram_counts(doc_ids(t), 1, 4)
    return counts.groupBy("n", "token").agg(
        F.count("*").alias("contexts"),
        F.sum("cnt").alias("total"),
        F.max("cnt").alias("top"),
        F.min(F.array_join(F.col("ngram").cast("array<string>"), " ")).alias("first_ngram"),
    )


@query("n2_static", BIGRAMS + " SELECT ngram, token, cnt FROM counts")
def _(t):
    return ng.ngram_static(doc_words(t)).select(joined(), "token", "cnt")


@query(
    "n3_merge",
    f"""WITH {DOCS}, g AS (SELECT lang, unnest(list_transform(range(1, len(toks)), lambda i: {{'ngram': toks[i], 'token': toks[i + 1]}})) AS g FROM docs)
SELECT g.ngram AS ngram, g.token AS token, count(*) AS cnt FROM g GROUP BY ALL""",
)
def _(t):
    docs = doc_words(t)
    en = F.col("lang") == "en"
    return ng.ngram_merge(ng.ngram_counts(docs.filter(en), 1, 1), ng.ngram_counts(docs.filter(~en), 1, 1)).select(
        joined(), "token", "cnt"
    )


@query(
    "n4_predict",
    BIGRAMS
    + """, r AS (SELECT ngram, token, cnt, sum(cnt) OVER (PARTITION BY ngram)::BIGINT AS total,
  row_number() OVER (PARTITION BY ngram ORDER BY cnt DESC, token) AS rn FROM counts)
SELECT ngram, token, cnt, total FROM r WHERE rn = 1 AND total >= 2 AND 100 * cnt >= 50 * total""",
)
def _(t):
    return ng.ngram_predict(ng.ngram_flat(doc_words(t), 2, 2)).select(joined(), "token", "cnt", "total")


@query(
    "n5_predict_validated",
    f"""WITH {TOKS}, conv AS (SELECT conv_id, turn, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS toks FROM conversations),
s AS (SELECT unnest(list_transform(range(1, greatest(len(toks) - 1, 1)), lambda i: {{'g': toks[i] || ' ' || toks[i + 1], 't': toks[i + 2]}})) AS s FROM docs),
st AS (SELECT s.g AS bigram, s.t AS token, count(*) AS cs FROM s GROUP BY ALL),
p AS (SELECT unnest(flatten([list_transform(range(1, greatest(len(toks) - n + 1, 1)), lambda i: {{'n': n, 'ngram': array_to_string(toks[i:i + n - 1], ' '),
   'bigram': CASE WHEN n >= 2 THEN toks[i + n - 2] || ' ' || toks[i + n - 1] END, 'token': toks[i + n]}}) for n in [1, 2, 3, 4]])) AS p FROM conv),
pc AS (SELECT p.n AS n, p.ngram AS ngram, p.bigram AS bigram, p.token AS token, count(*) AS cnt FROM p GROUP BY ALL),
sc AS (SELECT pc.n, pc.ngram, pc.token, pc.cnt, pc.cnt * coalesce(100 * cs, 1) AS score FROM pc LEFT JOIN st ON st.bigram = pc.bigram AND st.token = pc.token),
r AS (SELECT *, sum(cnt) OVER (PARTITION BY n, ngram)::BIGINT AS total, row_number() OVER (PARTITION BY n, ngram ORDER BY score DESC, token) AS rn FROM sc)
SELECT n::INTEGER AS n, ngram, token, cnt, total FROM r WHERE rn = 1 AND total >= [2, 2, 1, 1][n] AND 100 * cnt >= [66, 50, 50, 50][n] * total""",
)
def _(t):
    from loomspark.functions import text

    prompts = t.conversations.select(text.words("text").alias("tokens"))
    docs = doc_words(t)
    parts = ng.tasks(docs, prompts)
    out = ng.ngram_predict_validated(ng.ngram_flat(prompts, parts=parts), ng.ngram_flat(docs, 2, 2, parts=parts), "lax")
    return out.select("n", joined(), "token", "cnt", "total")


def _grams(table, key=""):
    """(key, n, ngram, token, cnt) of the word lists of ``table``."""
    k = f"{key}, " if key else ""
    return f"""(SELECT {k}p.n AS n, p.ngram AS ngram, p.token AS token, count(*) AS cnt FROM (SELECT {k}unnest(flatten([list_transform(range(1, greatest(len(toks) - n + 1, 1)),
   lambda i: {{'n': n, 'ngram': array_to_string(toks[i:i + n - 1], ' '), 'token': toks[i + n]}}) for n in [1, 2, 3, 4]])) AS p FROM {table}) GROUP BY ALL)"""


def _best(grams, key, samples, percent):
    """(key, n, ngram, token): the next token of each context that passes the gates."""
    k = f"{key}, " if key else ""
    return f"""(SELECT {k}n, ngram, token FROM (SELECT {k}n, ngram, g.token, cnt, sum(cnt) OVER w AS total, row_number() OVER (PARTITION BY {k}n, ngram ORDER BY cnt * coalesce(100 * cs, 1) DESC, g.token) AS rn
   FROM {grams} g LEFT JOIN st ON n >= 2 AND st.bigram = array_to_string(string_split(ngram, ' ')[-2:], ' ') AND st.token = g.token WINDOW w AS (PARTITION BY {k}n, ngram))
   WHERE rn = 1 AND total >= {list(samples)}[n] AND 100 * cnt >= {list(percent)}[n] * total)"""


def _one(i, grams, join, samples, percent, rank):
    """Contexts of one token, weighed by the static counts of the two before."""
    return f"""SELECT prompt_id, 1 AS n, token, {rank} AS rank FROM (SELECT r.prompt_id, w.token, w.cnt, sum(w.cnt) OVER p AS total, row_number() OVER (PARTITION BY r.prompt_id ORDER BY w.cnt * coalesce(100 * cs, 1) DESC, w.token) AS rn
   FROM r{i} r JOIN {grams} w ON {join} w.n = 1 AND w.ngram = r.tail[-1] LEFT JOIN st ON st.bigram = array_to_string(r.tail[-2:], ' ') AND st.token = w.token WHERE is_open WINDOW p AS (PARTITION BY r.prompt_id))
   WHERE rn = 1 AND total >= {samples[0]} AND 100 * cnt >= {percent[0]} * total"""


def _round(i):
    return f"""g{i} AS (SELECT prompt_id, n, array_to_string(tail[-n:], ' ') AS ngram FROM r{i}, (SELECT unnest(range(2, 5)) AS n) WHERE is_open AND n <= len(tail)),
h{i} AS (SELECT prompt_id, arg_min(token, [rank, -n]) AS nx FROM (SELECT prompt_id, n, token, 1 AS rank FROM g{i} JOIN by_prompt USING (prompt_id, n, ngram) UNION ALL
  SELECT prompt_id, n, token, 2 FROM g{i} JOIN of_all USING (n, ngram) UNION ALL SELECT prompt_id, 2, token, 3 FROM g{i} JOIN likely USING (ngram) WHERE n = 2 UNION ALL
  {_one(i, 'own', 'w.prompt_id = r.prompt_id AND', ng.LAX_SAMPLES, ng.LAX_PERCENT, 1)} UNION ALL {_one(i, 'chats', '', ng.STRICT_SAMPLES, ng.STRICT_PERCENT, 2)}) GROUP BY prompt_id),
r{i + 1} AS (SELECT prompt_id, CASE WHEN is_open AND nx IS NOT NULL THEN list_append(tail, nx)[-4:] ELSE tail END AS tail,
  CASE WHEN is_open AND nx IS NOT NULL THEN list_append(draft, nx) ELSE draft END AS draft, is_open AND nx IS NOT NULL AS is_open FROM r{i} LEFT JOIN h{i} USING (prompt_id))"""


@query(
    "n6_draft",
    f"""WITH {TOKS}, words AS (SELECT item_id AS prompt_id, list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS toks FROM benchmark),
conv AS (SELECT list_filter(string_split_regex(text, '\\s+'), lambda x: x <> '') AS toks FROM conversations),
st AS (SELECT ngram AS bigram, token, cnt AS cs FROM {_grams('docs')} WHERE n = 2),
own AS {_grams('words', 'prompt_id')}, chats AS {_grams('conv')},
by_prompt AS {_best('own', 'prompt_id', ng.LAX_SAMPLES, ng.LAX_PERCENT)},
of_all AS {_best('chats', '', ng.STRICT_SAMPLES, ng.STRICT_PERCENT)},
likely AS (SELECT bigram AS ngram, token FROM (SELECT bigram, token, cs, sum(cs) OVER (PARTITION BY bigram) AS total, row_number() OVER (PARTITION BY bigram ORDER BY cs DESC, token) AS rn FROM st)
  WHERE rn = 1 AND total >= 2 AND 100 * cs >= 50 * total),
r0 AS (SELECT prompt_id, toks[-4:] AS tail, []::VARCHAR[] AS draft, true AS is_open FROM words WHERE len(toks) >= 2),
{_round(0)}, {_round(1)}, {_round(2)}
SELECT prompt_id, array_to_string(draft, ' ') AS draft, len(draft)::INTEGER AS n_draft FROM r3""",
)
def _(t):
    from loomspark.functions import text

    prompts = t.benchmark.select(F.col("item_id").alias("prompt_id"), text.words("text").alias("tokens"))
    docs = doc_words(t)
    ctx = ng.ngram_flat(prompts, keep=("prompt_id",))
    chats = t.conversations.select(text.words("text").alias("tokens"))
    parts = ng.tasks(docs, chats)
    out = ng.ngram_draft(prompts, ctx, ng.ngram_flat(chats, parts=parts), ng.ngram_flat(docs, 2, 2, parts=parts), 3, parts=parts)
    return out.select("prompt_id", F.array_join("draft", " ").alias("draft"), F.size("draft").alias("n_draft"))


@query("n7_draft_acceptance")
def _(t):
    return ng.acceptance_report(ng.draft_acceptance(doc_words(t), 64, 4))
