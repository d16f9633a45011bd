"""Small vocabularies counted from ``documents``: characters, frequent bigrams and trigrams of its words."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspark.catalog.inputs import doc_words
from loomspark.functions.text import word_ids
from loomspark.operators import tokens as tk
from loomspark.plans.bounds import collect_bounded

TOP = 400


def top_grams(t, top: dict[int, int]) -> dict[int, list[str]]:
    """The most frequent letter n-grams within words: ``top[n]`` of each size, counted in one job."""
    words = doc_words(t).select(F.explode("tokens").alias("w")).groupBy("w").agg(F.count("*").alias("c"))

    def grams(n: int):
        starts = F.when(F.length("w") >= n, F.sequence(F.lit(1), F.length("w") - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.substring("w", i, F.lit(n)))

    cut = words.select("c", F.explode(F.concat(*[grams(n) for n in top])).alias("g")).filter(F.col("g").rlike("^[A-Za-z]+$"))
    counted = cut.groupBy("g").agg(F.sum("c").alias("c")).withColumn("n", F.length("g"))
    rank = F.row_number().over(Window.partitionBy("n").orderBy(F.desc("c"), "g"))
    limit = F.element_at(F.create_map(*[F.lit(x) for kv in top.items() for x in kv]), F.col("n"))
    rows = counted.withColumn("r", rank).filter(F.col("r") <= limit).collect()  # at most sum(top.values()) rows
    return {n: [r.g for r in sorted(rows, key=lambda r: r.r) if r.n == n] for n in top}


def bpe(t) -> tk.Vocab:
    grams = top_grams(t, {2: TOP, 3: TOP})
    two = grams[2]
    ids = {c: b for b, c in tk.BYTE_CHARS.items()}
    ranks = {}
    for g in two + [g for g in grams[3] if g[:2] in set(two)]:
        ranks[(g[:-1], g[-1])] = len(ranks)
        ids[g] = len(ids)
    return tk.Vocab("bpe", ids, attrs={i: tk.ATTR_NORMAL for i in ids.values()}, ranks=ranks, family="gpt2", bos=500_000, eos=500_001)


def scored(t, kind: str) -> tk.Vocab:
    """A score-based vocabulary with byte fallback."""
    ids, attrs, scores = {"<unk>": 0, "<s>": 1, "</s>": 2}, {0: tk.ATTR_UNKNOWN, 1: tk.ATTR_CONTROL, 2: tk.ATTR_CONTROL}, {}
    for b in range(256):
        ids[f"<0x{b:02X}>"] = len(ids)
        attrs[ids[f"<0x{b:02X}>"]] = tk.ATTR_BYTE
    chars = sorted(r.ch for r in collect_bounded(tk.distinct_codepoints(t.documents), 0x110000, "code points"))
    grams = top_grams(t, {1: 60, 2: TOP, 3: TOP})
    first = [f"{tk.SPACE_MARK}{g}" for g in grams[1]]
    for rank, g in enumerate([*first, *grams[2], *grams[3], tk.SPACE_MARK, *(c for c in chars if c != " ")]):
        if g not in ids:
            ids[g] = len(ids)
            attrs[ids[g]] = tk.ATTR_NORMAL
            scores[ids[g]] = -1.0 - rank / 50.0
    return tk.Vocab(kind, ids, {i: scores.get(i, 0.0) for i in ids.values()}, attrs, bos=1, eos=2)


def wordpiece(t) -> tk.Vocab:
    lower = [g.lower() for gs in top_grams(t, {1: 60, 2: TOP, 3: TOP}).values() for g in gs]
    ids = {"[UNK]": 0, "[CLS]": 1, "[SEP]": 2}
    for g in lower:
        for form in (tk.SPACE_MARK + g, g):
            ids.setdefault(form, len(ids))
    return tk.Vocab("wpm", ids, attrs={i: tk.ATTR_NORMAL if i > 2 else tk.ATTR_CONTROL for i in ids.values()}, bos=1, sep=2)


def byte_trie(t) -> tk.Vocab:
    ids = {chr(b): b + 1 for b in range(256)}
    grams = top_grams(t, {2: TOP, 3: TOP})
    for g in grams[2] + grams[3]:
        ids[g] = len(ids) + 1
    return tk.Vocab("rwkv", ids, attrs={i: tk.ATTR_NORMAL for i in ids.values()})


def word_table(t) -> DataFrame:
    """The toy ids as a vocabulary table: an id, its first word, and two flags."""
    rows = doc_words(t).select(F.explode("tokens").alias("text"))


    ids = rows.distinct().select(F.element_at(word_ids(F.array("text")), 1).alias("token_id"), "text")
    return ids.groupBy("token_id").agg(F.min("text").alias("text")).select(
        "token_id", "text", (F.col("token_id") % 5 == 0).alias("added"), (F.col("token_id") % 10 == 0).alias("special")
    )
