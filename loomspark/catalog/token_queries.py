"""Tokeniser queries over ``documents`` and ``conversations``."""

from pyspark.sql import functions as F

from loomspark.catalog import vocabularies as vocab
from loomspark.catalog.base import query
from loomspark.catalog.inputs import IDS, doc_ids
from loomspark.functions import text
from loomspark.operators import tokens as tk
from loomspark.plans.bounds import spread

B, M = tk.BORDER, "\ufdd2"


def docs(t):
    return spread(t.documents.select("doc_id", "text"), "doc_id")


def digest(col, sep="|"):
    return F.md5(F.array_join(col, sep).cast("binary")).alias("digest")


@query(
    "t1_normal_words",
    r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(regexp_replace(strip_accents(lower(text)), '([\p{P}$+<=>^`|~])', ' \1 ', 'g'), '\s+'), lambda x: x <> '') AS w FROM documents)
SELECT doc_id, len(w)::INTEGER AS n, md5(array_to_string(w, '|')) AS digest FROM w""",
)
def _(t):
    rows = docs(t).select("doc_id", tk.normal_words("text").alias("w"))
    return rows.select("doc_id", F.size("w").alias("n"), digest("w"))


def sql_cut(src, patterns):
    """Matches and gaps in order, one pattern after the other."""
    out = f"[{src}]"
    for p in patterns:
        out = (
            f"flatten(list_transform({out}, lambda p: string_split(regexp_replace(p, '({p})', '{B}\\1{B}', 'g'), '{B}')))"
        )
    return f"list_filter({out}, lambda x: x <> '')"


def pretokenised(t, family):
    rows = docs(t).select("doc_id", tk.pretokenize("text", family).alias("w"))
    return rows.select("doc_id", F.size("w").alias("n"), digest("w"))


@query(
    "t2_pretokenize_bloom",
    f"WITH w AS (SELECT doc_id, {sql_cut('text', tk.PRETOKENIZERS['bloom'])} AS w FROM documents) "
    "SELECT doc_id, len(w)::INTEGER AS n, md5(array_to_string(w, '|')) AS digest FROM w",
)
def _(t):
    return pretokenised(t, "bloom")


@query(
    "t2_pretokenize_steps",
    f"WITH w AS (SELECT doc_id, {sql_cut('text', [p for p in tk.PRETOKENIZERS['deepseek-coder'] if '一' not in p])} AS w FROM documents) "
    "SELECT doc_id, len(w)::INTEGER AS n, md5(array_to_string(w, '|')) AS digest FROM w",
)
def _(t):
    return pretokenised(t, "deepseek-coder")


# A blank that the next word takes is marked, as the twin has no look-ahead: blanks end at the mark.
PUNCTUATION, *_, DIGITS, THREE = tk.PRETOKENIZERS["default"]
WORDS = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}{M}]+|\s+"
WORDED = rf"""list_transform({sql_cut('text', [PUNCTUATION])}, lambda p: regexp_replace(p, '(\s)(\S)', '{M}\1\2', 'g'))"""
WORDED = f"""list_transform(flatten(list_transform({WORDED}, lambda p: string_split(regexp_replace(p, '({WORDS.replace("'", "''")})', '{B}\\1{B}', 'g'), '{B}'))), lambda p: replace(p, '{M}', ''))"""


def sql_parts(src, pattern):
    return f"flatten(list_transform({src}, lambda p: string_split(regexp_replace(p, '({pattern})', '{B}\\1{B}', 'g'), '{B}')))"


@query(
    "t2_pretokenize_default",
    f"WITH w AS (SELECT doc_id, list_filter({sql_parts(sql_parts(WORDED, DIGITS), THREE)}, lambda x: x <> '') AS w FROM documents) "
    "SELECT doc_id, len(w)::INTEGER AS n, md5(array_to_string(w, '|')) AS digest FROM w",
)
def _(t):
    return pretokenised(t, "default")


ROUND_TRIP = "SELECT doc_id, md5(text) AS digest FROM documents"


def round_trip(t, v):
    ids = tk.tokenize_corpus(docs(t), v, add_special=False)
    return tk.detokenize(ids, v).select("doc_id", F.md5("text").alias("digest"))


@query("t3_bpe_round_trip", ROUND_TRIP)
def _(t):
    return round_trip(t, vocab.bpe(t))


@query("t4_spm_round_trip", ROUND_TRIP)
def _(t):
    return round_trip(t, vocab.scored(t, "spm"))


@query("t5_wordpiece")
def _(t):
    v = vocab.wordpiece(t)
    return tk.token_statistics(tk.tokenize_corpus(docs(t), v), unknown=v.unk)


@query("t6_unigram_round_trip", ROUND_TRIP)
def _(t):
    return round_trip(t, vocab.scored(t, "ugm"))


@query("t7_trie_round_trip", ROUND_TRIP)
def _(t):
    return round_trip(t, vocab.byte_trie(t))


@query(
    "t8_special_partition",
    f"""WITH a AS (SELECT doc_id, list_filter(string_split(replace(replace(text, 'the', '{B}#1{B}'), 'ou', '{B}#2{B}'), '{B}'), lambda x: x <> '') AS f FROM documents)
SELECT doc_id, len(f)::INTEGER AS n, len(list_filter(f, lambda x: x = '#1'))::INTEGER AS n_the, len(list_filter(f, lambda x: x = '#2'))::INTEGER AS n_ou FROM a""",
)
def _(t):
    specials = [(1, "the", tk.ATTR_USER_DEFINED), (2, "ou", tk.ATTR_USER_DEFINED), (3, "x", tk.ATTR_CONTROL)]
    rows = docs(t).select("doc_id", tk.partition_special("text", specials, False).alias("f"))
    hits = lambda i: F.size(F.filter("f", lambda x: F.coalesce(x["id"] == i, F.lit(False))))
    return rows.select("doc_id", F.size("f").alias("n"), hits(1).alias("n_the"), hits(2).alias("n_ou"))


@query(
    "t9_add_special",
    f"""WITH {IDS}, d AS (SELECT doc_id, list(token_id ORDER BY pos) AS ids FROM ids GROUP BY 1)
SELECT doc_id, (len(ids) + 2)::INTEGER AS n, coalesce(ids[1] = 2, false) AS double_bos, coalesce(ids[-1] = 7, false) AS double_eos, array_to_string(list_concat([2], ids, [7])[:4], ' ') AS head FROM d""",
)
def _(t):
    rows = tk.add_special_tokens(doc_ids(t), bos=2, eos=7)
    head = F.array_join(F.slice("tokens", 1, 4).cast("array<string>"), " ")
    return rows.select("doc_id", F.size("tokens").alias("n"), "double_bos", "double_eos", head.alias("head"))


@query("t10_detokenize", "SELECT conv_id * 1000 + turn AS doc_id, md5(text) AS digest FROM conversations")
def _(t):
    v = vocab.scored(t, "spm")
    rows = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    return tk.detokenize(tk.tokenize_corpus(rows, v, add_special=False), v).select("doc_id", F.md5("text").alias("digest"))


@query(
    "t10_joined_bytes",
    f"""WITH {IDS}, vocab AS (SELECT token_id, min(tok) AS text FROM (SELECT tok, ((ascii(tok) * 31 + length(tok)) % 97)::INTEGER AS token_id FROM tk) GROUP BY token_id)
SELECT d.doc_id, md5(coalesce(string_agg(v.text, '' ORDER BY pos), '')) AS digest FROM documents d LEFT JOIN ids USING (doc_id) LEFT JOIN vocab v USING (token_id) GROUP BY d.doc_id""",
)
def _(t):
    pieces = vocab.word_table(t).select("token_id", F.col("text").cast("binary").alias("raw"))
    return tk.join_pieces(doc_ids(t), pieces).select("doc_id", F.md5("text").alias("digest"))


VOCAB = """vocab AS (SELECT token_id, min(tok) AS text, token_id % 5 = 0 AS added, token_id % 10 = 0 AS special FROM
  (SELECT tok, ((ascii(tok) * 31 + length(tok)) % 97)::INTEGER AS token_id FROM tk) GROUP BY token_id)"""


@query(
    "t11_token_report",
    f"""WITH {IDS}, {VOCAB}, n AS (SELECT doc_id, count(*)::INTEGER AS total FROM ids GROUP BY 1),
r AS (SELECT i.doc_id, i.pos, i.token_id, v.text AS piece, false AS invalid_utf8, total FROM ids i LEFT JOIN vocab v USING (token_id) JOIN n USING (doc_id))
SELECT doc_id, token_id, piece, invalid_utf8, total, count(*) AS n, sum(pos)::BIGINT AS pos_sum FROM r GROUP BY ALL""",
)
def _(t):
    v = vocab.word_table(t).select("token_id", F.col("text").cast("binary").alias("raw"))
    rows = tk.token_report(doc_ids(t), v)
    return rows.groupBy("doc_id", "token_id", "piece", "invalid_utf8", "total").agg(
        F.count("*").alias("n"), F.sum(F.col("pos").cast("long")).alias("pos_sum")
    )


@query(
    "t12_vocabulary_table",
    f"""WITH {IDS}, {VOCAB}, r AS (SELECT i::INTEGER AS token_id, text, added, special OR text IN ('<pad>', '<mask>', '<2mass>', '[@BOS@]')
   OR (starts_with(text, '<|') AND ends_with(text, '|>')) OR (starts_with(text, '<unused') AND ends_with(text, '>')) AS control
 FROM range(128) AS g(i) LEFT JOIN vocab ON token_id = i)
SELECT token_id, CASE WHEN text IS NULL THEN '[PAD' || token_id || ']' ELSE text END AS text,
  (CASE WHEN text IS NULL THEN 2 WHEN NOT added THEN 4 WHEN control THEN 8 ELSE 16 END)::INTEGER AS attr FROM r""",
)
def _(t):
    return tk.vocabulary_table(vocab.word_table(t), 128)


@query(
    "t13_fingerprint",
    f"WITH {IDS} SELECT doc_id, sha256('[' || string_agg(token_id::VARCHAR, ', ' ORDER BY pos) || ']') AS fingerprint FROM ids GROUP BY 1",
)
def _(t):
    return doc_ids(t).select("doc_id", tk.fingerprint("tokens").alias("fingerprint"))


@query("t14_mixed_prompts")
def _(t):
    v = vocab.bpe(t)
    ids = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("prompt_id"), "text", "turn")
    body = F.to_json(F.struct(F.col("text").alias("t"))).substr(F.lit(6), F.lit(1 << 30))
    quoted = F.expr("left(j, length(j) - 1)")
    rows = ids.withColumn("j", body).select(
        "prompt_id",
        F.when(F.col("turn") % 3 == 0, quoted)
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("[12, "), quoted, F.lit(", 34]")))
        .otherwise(F.concat(F.lit("["), quoted, F.lit(", [7, 8, 9]]")))
        .alias("prompt"),
    )
    out = tk.tokenize_prompts(rows, "prompt", v)
    return out.select("prompt_id", "prompt_no", F.size("tokens").alias("n"), F.get("tokens", F.lit(0)).alias("first"))


@query("t15_rough_count", r"""SELECT doc_id, len(string_split_regex(text, '[\s,''".?]'))::INTEGER AS n FROM documents""")
def _(t):
    return docs(t).select("doc_id", text.rough_pieces("text").alias("n"))


@query(
    "t16_token_statistics",
    f"""WITH {IDS} SELECT doc_id, count(*)::INTEGER AS n, count(DISTINCT token_id)::INTEGER AS n_distinct, round(sum((token_id = 33)::INTEGER) / count(*), 9) AS unknown_rate
FROM ids GROUP BY 1""",
)
def _(t):
    rows = tk.token_statistics(doc_ids(t), unknown=33)
    return rows.withColumn("unknown_rate", F.round("unknown_rate", 9))


@query(
    "t16_frequencies",
    r"""WITH b AS (SELECT unnest(regexp_extract_all(hex(encode(text)), '..')) AS b FROM documents)
SELECT ('0x' || b)::INTEGER + 1 AS token_id, count(*) AS cnt FROM b GROUP BY 1""",
)
def _(t):
    """Byte frequencies: a vocabulary of single bytes over distinct pieces."""
    v = tk.Vocab("rwkv", {chr(b): b + 1 for b in range(256)}, attrs={})
    lines = docs(t).select(F.explode(F.split("text", " ", -1)).alias("text"))
    blanks = docs(t).agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))).alias("cnt"))
    counts = tk.token_frequencies(lines, v)
    return counts.unionByName(blanks.select(F.lit(33).alias("token_id"), "cnt"))


CHARS = "c AS (SELECT DISTINCT unnest(string_split(text, '')) AS ch FROM documents)"


@query(
    "t17_category_ranges",
    rf"""WITH {CHARS}, f AS (SELECT ord(ch) AS cp, CASE WHEN regexp_matches(ch, '\p{{L}}') THEN 4 WHEN regexp_matches(ch, '\p{{M}}') THEN 16 WHEN regexp_matches(ch, '\p{{N}}') THEN 2
 WHEN regexp_matches(ch, '\p{{P}}') THEN 32 WHEN regexp_matches(ch, '\p{{S}}') THEN 64 WHEN regexp_matches(ch, '\p{{Z}}') THEN 8 ELSE 128 END AS flags FROM c),
g AS (SELECT cp, flags, cp - row_number() OVER (PARTITION BY flags ORDER BY cp) AS g FROM f)
SELECT min(cp) AS first, max(cp) AS last, flags FROM g GROUP BY flags, g""",
)
def _(t):
    points = tk.distinct_codepoints(t.documents)
    return tk.equal_ranges(points.select("cp", tk.category_flags("ch").alias("flags")), "flags")


@query(
    "t17_decomposed_ranges",
    f"""WITH {CHARS}, f AS (SELECT ord(ch) AS cp, ord(strip_accents(ch)) AS nfd FROM c), o AS (SELECT * FROM f WHERE cp <> nfd),
g AS (SELECT cp, nfd, cp - row_number() OVER (PARTITION BY nfd ORDER BY cp) AS g FROM o)
SELECT min(cp) AS first, max(cp) AS last, nfd FROM g GROUP BY nfd, g""",
)
def _(t):
    points = tk.distinct_codepoints(t.documents).select("cp", tk.first_of_nfd("ch").alias("nfd"))
    return tk.equal_ranges(points.filter("cp <> nfd"), "nfd")


@query(
    "t18_speech_text",
    r"""WITH m AS (SELECT doc_id, string_split(regexp_replace(text, '([0-9]+(\.[0-9]+)?)', '%B%\1%B%', 'g'), '%B%') AS p FROM documents),
n AS (SELECT doc_id, unnest(p) AS p, generate_subscripts(p, 1) AS i FROM m),
v AS (SELECT doc_id, i, p, CASE WHEN regexp_matches(p, '^[0-9]+(\.[0-9]+)?$') AND length(ltrim(regexp_extract(p, '^[0-9]+'), '0')) <= 10 THEN CASE WHEN ltrim(regexp_extract(p, '^[0-9]+'), '0') = '' THEN 0 ELSE ltrim(regexp_extract(p, '^[0-9]+'), '0')::BIGINT END END AS x,
  regexp_matches(p, '^[0-9]+(\.[0-9]+)?$') AS num FROM n),
k AS (SELECT *, list_transform([x // 1000000000, x % 1000000000 // 1000000, x % 1000000 // 1000, x % 1000], lambda q:
   (CASE WHEN q >= 100 THEN ones[q // 100 + 1] || ' hundred ' ELSE '' END) ||
   (CASE WHEN q % 100 >= 20 AND q % 10 > 0 THEN tens[q % 100 // 10 + 1] || '-' || ones[q % 10 + 1] WHEN q % 100 >= 20 THEN tens[q % 100 // 10 + 1] WHEN q % 100 > 0 THEN ones[q % 100 + 1] ELSE '' END)) AS g,
   list_transform(list_filter(string_split(CASE WHEN num THEN regexp_extract(p, '\.([0-9]+)$', 1) ELSE '' END, ''), lambda d: d <> ''), lambda d: ' ' || ones[d::INTEGER + 1]) AS dec
 FROM v, (SELECT %ONES% AS ones, %TENS% AS tens)),
s AS (SELECT doc_id, i, CASE WHEN NOT num THEN p WHEN x IS NULL OR x > 2147483647 THEN ' ' ELSE
  (CASE WHEN x = 0 THEN 'zero' ELSE (CASE WHEN x >= 1000000000 THEN g[1] || ' billion ' ELSE '' END) || (CASE WHEN x % 1000000000 >= 1000000 THEN g[2] || ' million ' ELSE '' END) ||
   (CASE WHEN x % 1000000 >= 1000 THEN g[3] || ' thousand ' ELSE '' END) || g[4] END) || (CASE WHEN contains(p, '.') THEN ' point' || array_to_string(dec, '') ELSE '' END) END AS s FROM k),
j AS (SELECT doc_id, translate(string_agg(s, '' ORDER BY i), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM s GROUP BY 1),
c AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(s, '[-_/,\.\\]', ' ', 'g'), '[^a-z\s]', '', 'g'), '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g') AS s FROM j)
SELECT doc_id, md5(regexp_replace(s, '\s', '<|text_sep|>', 'g')) AS digest FROM c""".replace("%B%", B)
    .replace("%ONES%", str(tk.ONES))
    .replace("%TENS%", str(tk.TENS)),
)
def _(t):
    return docs(t).select("doc_id", F.md5(tk.speech_text("text")).alias("digest"))
