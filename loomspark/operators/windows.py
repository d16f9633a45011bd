"""Cutting token streams into chunks, windows, training pairs and batches.

A corpus is the documents in ``doc_id`` order.  Only one count per document takes part in the prefix
sum that gives each token its corpus position; tokens themselves are never sorted globally.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.plans.bounds import checked
from loomspark.plans.lineage import cut
from loomspark.plans.prefix import WIDTH, running_sums


def corpus_sizes(df: DataFrame, *, doc: str = "doc_id", tokens: str = "tokens") -> tuple[DataFrame, int]:
    """(token count and first token of each document, tokens in all).

    They are written, so that neither the total nor the offsets read the texts again.
    """
    sizes = cut(df.select(doc, F.size(tokens).cast("long").alias("n"), F.get(tokens, F.lit(0)).alias("first")))
    return sizes, sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def corpus_positions(df: DataFrame, sizes: DataFrame, *, doc: str = "doc_id", tokens: str = "tokens", ahead: bool = False) -> DataFrame:
    """``(doc, gpos, token)`` with ``gpos`` counting from 0 over the whole corpus; ``ahead`` adds the token behind each as ``next``.

    The next token stands in the same array but for the last of a document; that one gets the first token of the next
    document that has any, over a join of one row for each document.
    """
    offs = running_sums(sizes, [], doc, {"offset": F.col("n")}, inclusive=False)
    if not ahead:
        flat = df.select(doc, tokens).join(offs.select(doc, "offset"), doc)
        return flat.select(doc, "offset", F.posexplode(tokens).alias("p", "token")).select(doc, (F.col("offset") + F.col("p")).alias("gpos"), "token")
    behind = offs.filter("n > 0").select(F.col("offset").alias("__end"), F.col("first").alias("__next"))
    offs = offs.select(doc, "offset", (F.col("offset") + F.col("n")).alias("__end")).join(behind, "__end", "left").drop("__end")
    t = F.col(tokens)
    pair = F.arrays_zip(t.alias("token"), F.concat(F.slice(t, F.lit(2), F.size(t)), F.array("__next")).alias("next"))
    flat = df.select(doc, tokens).join(offs, doc).filter(F.size(t) > 0).select(doc, "offset", F.posexplode(pair).alias("p", "z"))
    return flat.select(doc, (F.col("offset") + F.col("p")).alias("gpos"), "z.token", "z.next")


def chunk_tokens(df: DataFrame, n_ctx: int, max_chunks: int = -1, *, skip: int = 0, tokens: str = "tokens", doc: str = "doc_id", ahead: bool = False) -> DataFrame:
    """``(chunk, pos, gpos, token)`` of the whole chunks of ``n_ctx`` tokens; the tail is dropped.  ``ahead`` adds ``next``.

    At least two chunks are required.  ``skip`` leaves out the first chunks.
    """
    sizes, n = corpus_sizes(df, doc=doc, tokens=tokens)
    if skip and n < (skip + 2) * n_ctx:
        raise ValueError(f"{n} tokens are too few to skip {skip} chunks of {n_ctx}")
    if n < 2 * n_ctx:
        raise ValueError(f"need at least {2 * n_ctx} tokens, have {n}")
    usable = (n - skip * n_ctx) // n_ctx
    if max_chunks >= 0:
        usable = min(usable, max_chunks)
    p = F.col("gpos") - skip * n_ctx
    flat = corpus_positions(df, sizes, doc=doc, tokens=tokens, ahead=ahead).filter((p >= 0) & (p < usable * n_ctx))
    return flat.select(F.floor(p / n_ctx).cast("long").alias("chunk"), (p % n_ctx).cast("int").alias("pos"), "gpos", "token", *["next"] * ahead)


def stride_windows(df: DataFrame, n_ctx: int, stride: int, *, tokens: str = "tokens", doc: str = "doc_id") -> DataFrame:
    """Overlapping windows ``(win, pos, token, scored)``; only the last ``stride`` targets of each are scored."""
    if stride <= 0:
        raise ValueError("stride must be greater than zero")
    sizes, n = corpus_sizes(df, doc=doc, tokens=tokens)
    if n <= n_ctx:
        raise ValueError(f"{n} tokens are not enough for a context of {n_ctx}")
    n_win = (n - n_ctx + stride - 1) // stride
    return _expand(corpus_positions(df, sizes, doc=doc, tokens=tokens), n_ctx, stride, n_win).withColumn(
        "scored", F.col("pos") >= n_ctx - stride
    )


def _expand(flat: DataFrame, length: int, stride: int, n_win: int) -> DataFrame:
    """Each token goes to every window ``[i*stride, i*stride+length)`` that holds it: an explode, not a join."""
    g = F.col("gpos")
    first = F.greatest(F.lit(0).cast("long"), F.floor((g - length) / stride).cast("long") + 1)
    last = F.least(F.lit(n_win - 1).cast("long"), F.floor(g / stride).cast("long"))
    wins = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    more = [c for c in ("token", "next") if c in flat.columns]
    return flat.select("gpos", *more, F.explode(wins).alias("win")).select("win", (F.col("gpos") - F.col("win") * stride).cast("int").alias("pos"), *more)


def score_mask(chunks: DataFrame, n_ctx: int) -> DataFrame:
    """Rows whose next token is predicted: the second half of each chunk, with its target; chunks carry ``next``."""
    return chunks.withColumnRenamed("next", "target").filter((F.col("pos") >= n_ctx // 2) & (F.col("pos") < n_ctx - 1))


def with_bos(chunks: DataFrame, bos: int) -> DataFrame:
    """The model sees BOS at each chunk start; targets keep the original token."""
    return chunks.withColumn("input", F.when(F.col("pos") == 0, F.lit(bos)).otherwise(F.col("token")))


def train_windows(df: DataFrame, n_ctx: int, stride: int, *, tokens: str = "tokens", doc: str = "doc_id") -> DataFrame:
    """``(win, pos, data, label)``: the label is the next token."""
    sizes, n = corpus_sizes(df, doc=doc, tokens=tokens)
    n_win = max(0, (n - n_ctx - 1) // stride)
    rows = _expand(corpus_positions(df, sizes, doc=doc, tokens=tokens, ahead=True), n_ctx, stride, n_win)
    return rows.select("win", "pos", F.col("token").alias("data"), F.col("next").alias("label"))


def common_prefix(*seqs) -> Column:
    """Length of the common prefix of k array columns."""
    cols = [F.col(s) if isinstance(s, str) else s for s in seqs]
    n = F.least(*[F.size(c) for c in cols]) if len(cols) > 1 else F.size(cols[0])
    same = F.transform(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: F.forall(F.array(*[F.get(c, i) == F.get(cols[0], i) for c in cols]), lambda e: e),
    )
    hit = F.array_position(same, F.lit(False)).cast("int")
    return F.when(hit > 0, hit - 1).otherwise(n)


def task_cost(prefix_len, lengths) -> Column:
    """Tokens of a multi-answer task when the shared prefix is counted once."""
    p = F.col(prefix_len) if isinstance(prefix_len, str) else prefix_len
    ls = F.col(lengths) if isinstance(lengths, str) else lengths
    return p + F.aggregate(ls, F.lit(0), lambda s, n: s + n - p)


def _joined(left: Column, right: Column, gap: Column | int) -> Column:
    """Hashes of runs out of those of their first part and, ``gap`` places on, their second."""
    n = F.greatest(F.least(F.size(left), F.size(right) - gap), F.lit(0))
    return F.zip_with(F.slice(left, F.lit(1), n), F.slice(right, F.lit(1) + gap, n), lambda x, y: F.xxhash64(x, y))


def longest_common_run(df: DataFrame, a: str, b: str, *, name: str = "run") -> DataFrame:
    """``df`` with the length of the longest run of tokens that both arrays hold in sequence; 0 for a null array.

    Two arrays share a run of some length if they share the hash of one.  Hashes of runs of 1, 2, 4 … tokens come each
    from the one before; then the length is put together from the longest power of two down.  All of it is in the row: work
    and memory grow with the tokens times the logarithm of the longest array, and one small pass finds that length first.
    Runs are told apart by 64-bit hashes.
    """
    sides = {"__a": a, "__b": b}
    none = F.array().cast("array<bigint>")
    longest = df.agg(F.max(F.least(F.size(a), F.size(b)))).first()[0] or 0
    levels = max(longest, 1).bit_length()
    out = df
    for side, tokens in sides.items():
        start = F.coalesce(F.transform(F.col(tokens), lambda t: F.xxhash64(t)), none)
        out = out.withColumn(f"{side}0", start)
    for k in range(1, levels):
        out = out.withColumns({f"{s}{k}": _joined(F.col(f"{s}{k - 1}"), F.col(f"{s}{k - 1}"), 1 << k - 1) for s in sides})
    out = out.withColumn("__n", F.lit(0))
    for k in range(levels - 1, -1, -1):
        longer = {f"{s}x": F.when(F.col("__n") == 0, F.col(f"{s}{k}")).otherwise(_joined(F.col(f"{s}run"), F.col(f"{s}{k}"), F.col("__n"))) if k < levels - 1 else F.col(f"{s}{k}") for s in sides}
        out = out.withColumns(longer).withColumn("__hit", F.arrays_overlap("__ax", "__bx"))
        kept = {f"{s}run": F.when(F.col("__hit"), F.col(f"{s}x")).otherwise(F.col(f"{s}run") if k < levels - 1 else none) for s in sides}
        out = out.withColumns({**kept, "__n": F.col("__n") + F.when(F.col("__hit"), F.lit(1 << k)).otherwise(0)})
    return out.select(*[F.col(f"`{c}`") for c in df.columns], F.col("__n").alias(name))


@F.pandas_udf(T.ArrayType(T.LongType()))
def _prefix_hashes(seqs: pd.Series) -> pd.Series:
    """Hash of every prefix of an id array, by a wrapped polynomial sum."""

    def one(ids):
        x = np.asarray(ids, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        powers = np.multiply.accumulate(np.full(len(x), 0x5851F42D4C957F2D, dtype=np.uint64))
        return np.cumsum(x * powers, dtype=np.uint64).view(np.int64)

    return seqs.map(one)


def _prefixes(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(keep, len, shared, h)``: length and hash of each prefix."""
    hashed = df.select(*keep, F.size("tokens").alias("len"), _prefix_hashes("tokens").alias("hs"))
    return hashed.select(*keep, "len", F.posexplode("hs").alias("p", "h")).select(*keep, "len", (F.col("p") + 1).alias("shared"), "h")


def _powers(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(keep, shared, h)`` of the prefixes of 1, 2, 4, 8 ... tokens."""
    hashed = df.select(*keep, _prefix_hashes("tokens").alias("hs"))
    some = F.filter("hs", lambda _, i: (i + 1).bitwiseAND(i) == 0)
    return hashed.select(*keep, F.posexplode(some).alias("k", "h")).select(*keep, F.expr("shiftleft(1, k)").alias("shared"), "h")


def reachable(prompts: DataFrame, cached: DataFrame) -> DataFrame:
    """``(prompt_id, tokens)`` of prompts with a cached prefix, their tokens cut where no longer prefix can be cached.

    A prefix that is cached has only cached prefixes itself.  So it is enough to look up the prefixes of 1, 2, 4, 8 ... tokens:
    what a prompt shares is shorter than twice the longest of these that is cached.
    """
    known = _powers(cached, []).distinct()
    reach = _powers(prompts, ["prompt_id"]).join(known, ["shared", "h"]).groupBy("prompt_id").agg((2 * F.max("shared") - 1).alias("reach"))
    return prompts.join(reach, "prompt_id").select("prompt_id", F.slice("tokens", F.lit(1), F.least("reach", F.size("tokens"))).alias("tokens"))


def match_prefix(prompts: DataFrame, cached: DataFrame, min_sim: float) -> DataFrame:
    """The cached sequence sharing the longest prefix with each prompt.

    ``prompts(prompt_id, tokens)``, ``cached(cache_id, last_used, tokens)`` with integer tokens.  A candidate
    counts when shared length / cached length exceeds ``min_sim``; equal lengths go to the smaller id.
    Prompts without a candidate get the least recently used entry.

    Both sides list their prefixes, the prompts as far as one can be cached; the cached side keeps one entry per distinct
    prefix, so the join is by equality on a unique key and no prompt is ever paired with all cached rows.
    """
    best = (
        _prefixes(cached, ["cache_id"])
        .filter(F.col("shared") / F.col("len") > min_sim)
        .groupBy("shared", "h")
        .agg(F.min("cache_id").alias("cache_id"))
    )
    hits = (
        _prefixes(reachable(prompts, cached), ["prompt_id"])
        .join(best, ["shared", "h"])
        .groupBy("prompt_id")
        .agg(F.max(F.struct("shared", (-F.col("cache_id")).alias("neg"))).alias("m"))
        .select("prompt_id", F.col("m.shared").alias("shared"), (-F.col("m.neg")).alias("cache_id"))
    )
    oldest = cached.agg(F.min_by("cache_id", F.struct("last_used", "cache_id")).alias("lru"))
    return (
        prompts.select("prompt_id")
        .join(hits, "prompt_id", "left")
        .join(F.broadcast(oldest))  # one row
        .select(
            "prompt_id",
            F.coalesce("cache_id", "lru").alias("cache_id"),
            F.coalesce("shared", F.lit(0)).alias("shared"),
            F.col("cache_id").isNull().alias("by_age"),
        )
    )


# ---------------------------------------------------------------- greedy batches

# A block of rows turns the open total it is entered with into the total it leaves open, and closes some
# batches on the way.  That map is piecewise: either constant, or (no batch closed) a shift.
_MAP = "lo long, hi long, out long, closed long, moves boolean"


def _jumps(sizes: np.ndarray, budget: int):
    """For each row as a batch start: the next batch start, in rows."""
    ends = np.cumsum(sizes)
    before = ends - sizes
    return ends, before, np.searchsorted(ends, before + budget, side="right")


def _block_map(sizes: np.ndarray, budget: int) -> pd.DataFrame:
    ends, before, nxt = _jumps(sizes, budget)
    n, total = len(sizes), int(ends[-1])
    out = np.zeros(n + 1, dtype=np.int64)
    closed = np.zeros(n + 1, dtype=np.int64)
    for i in range(n - 1, -1, -1):
        j = nxt[i]
        out[i], closed[i] = (out[j], closed[j] + 1) if j < n else (total - before[i], 1)
    rows = [(0, budget - total, total, 0, True)] if total <= budget else []
    for e in range(min(n, int(np.searchsorted(ends, budget, side="right")) + 1)):
        lo, hi = max(0, budget - int(ends[e]) + 1), budget - int(before[e])
        if lo <= hi:
            rows.append((lo, hi, int(out[e]), int(closed[e]), False))
    return _tidy(rows)


def _tidy(rows: list) -> pd.DataFrame:
    rows = sorted(rows)
    kept: list = []
    for r in rows:
        if kept and kept[-1][2:] == r[2:] and kept[-1][1] + 1 == r[0]:
            kept[-1] = (kept[-1][0], r[1], *r[2:])
        else:
            kept.append(r)
    return pd.DataFrame(kept, columns=["lo", "hi", "out", "closed", "moves"])


def _compose(first: pd.DataFrame, then: pd.DataFrame) -> pd.DataFrame:
    rows = []
    nxt = list(then.sort_values("lo").itertuples(index=False))
    los = [b.lo for b in nxt]
    for a in first.itertuples(index=False):
        if not a.moves:
            b = nxt[bisect_right(los, a.out) - 1]
            rows.append((a.lo, a.hi, a.out + b.out if b.moves else b.out, a.closed + b.closed, False))
            continue
        for k in range(bisect_right(los, a.lo + a.out) - 1, bisect_right(los, a.hi + a.out)):
            b = nxt[k]
            lo, hi = max(a.lo, b.lo - a.out), min(a.hi, b.hi - a.out)
            rows.append((lo, hi, a.out + b.out if b.moves else b.out, a.closed + b.closed, b.moves))
    return _tidy(rows)


def _enter(block: pd.DataFrame, carry: int) -> tuple[int, int]:
    r = block[(block.lo <= carry) & (block.hi >= carry)].iloc[0]
    return (int(carry + r.out) if r.moves else int(r.out)), int(r.closed)


def pack_greedy(
    df: DataFrame, keys: Sequence[str], order: str, size: str, budget: int, *, width: int = WIDTH, fan: int = 1024
) -> DataFrame:
    """Add ``batch``: rows in ``order`` join the open batch unless its total would exceed ``budget``.

    ``order`` counts 0, 1, 2 … within ``keys``.  A row larger than the budget is an error.  The rule is
    sequential, yet runs block-wise: every block reports how it maps the total it is entered with, these maps
    are composed in two levels, and each block then assigns its rows knowing its own entry.  No task sees more
    than ``width`` rows or ``fan`` maps of a key, but for one map per ``width * fan`` rows at the top.
    """
    keys = list(keys)
    df = checked(df, F.col(size) > budget, f"a row is larger than the budget of {budget}")
    blocked = df.withColumn("__blk", F.floor(F.col(order) / F.lit(width)).cast("long"))
    key_ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields if f.name in keys)
    key_names = [f.name for f in df.schema.fields if f.name in keys]

    def tag(pdf: pd.DataFrame, src: pd.DataFrame, extra: dict) -> pd.DataFrame:
        out = pdf.copy()
        for k in key_names:
            out[k] = src[k].iloc[0]
        for k, v in extra.items():
            out[k] = v
        return out

    def one_block(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        return tag(_block_map(pdf[size].to_numpy(np.int64), budget), pdf, {"__blk": pdf["__blk"].iloc[0]})

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        maps = [m for _, m in pdf.sort_values(["__blk", "lo"]).groupby("__blk")]
        acc = maps[0][["lo", "hi", "out", "closed", "moves"]]
        for m in maps[1:]:
            acc = _compose(acc, m)
        return tag(acc, pdf, {"__sup": pdf["__sup"].iloc[0]})

    def walk(pdf: pd.DataFrame, unit: str, carry: int, closed: int) -> pd.DataFrame:
        rows = []
        for u, m in pdf.sort_values([unit, "lo"]).groupby(unit):
            rows.append((u, carry, closed))
            carry, c = _enter(m, carry)
            closed += c
        return tag(pd.DataFrame(rows, columns=[unit, "carry", "done"]), pdf, {})

    def top(pdf: pd.DataFrame) -> pd.DataFrame:
        return walk(pdf, "__sup", 0, 0)

    def down(pdf: pd.DataFrame) -> pd.DataFrame:
        return walk(pdf.drop(columns=["carry", "done"]), "__blk", int(pdf["carry"].iloc[0]), int(pdf["done"].iloc[0]))

    lean = blocked.select(*key_names, "__blk", order, size)
    maps = lean.groupBy(*key_names, "__blk").applyInPandas(one_block, f"{_MAP}, {key_ddl}__blk long")
    maps = maps.withColumn("__sup", F.floor(F.col("__blk") / F.lit(fan)).cast("long"))
    sups = maps.groupBy(*key_names, "__sup").applyInPandas(fold, f"{_MAP}, {key_ddl}__sup long")
    at_sup = sups.groupBy(*key_names).applyInPandas(top, f"__sup long, carry long, done long, {key_ddl[:-2]}" if key_ddl else "__sup long, carry long, done long")
    entries = (
        maps.join(at_sup, [*key_names, "__sup"])
        .groupBy(*key_names, "__sup")
        .applyInPandas(down, f"{key_ddl}__blk long, carry long, done long")
    )

    def assign(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        sizes = pdf[size].to_numpy(np.int64)
        ends, _, nxt = _jumps(sizes, budget)
        batch = np.full(len(sizes), int(pdf["done"].iloc[0]), dtype=np.int64)
        i = int(np.searchsorted(ends, budget - int(pdf["carry"].iloc[0]), side="right"))
        while i < len(sizes):
            batch[i:] += 1
            i = nxt[i]
        out = pdf[key_names + [order]].copy()
        out["batch"] = batch
        return out

    order_ddl = df.schema[order].dataType.simpleString()
    done = (
        lean.join(entries, [*key_names, "__blk"])
        .groupBy(*key_names, "__blk")
        .applyInPandas(assign, f"{key_ddl}`{order}` {order_ddl}, batch long")
    )
    return df.join(done, [*key_names, order])


def batches_of(it: Iterator[pd.DataFrame], size: str, budget: int) -> Iterator[pd.DataFrame]:
    """Greedy batches over the rows one task streams through; used in front of a user model."""
    open_rows: list[pd.DataFrame] = []
    total = 0
    for pdf in it:
        start = 0
        for i, n in enumerate(pdf[size].tolist()):
            if total + n > budget and (open_rows or i > start):
                open_rows.append(pdf.iloc[start:i])
                yield pd.concat(open_rows)
                open_rows, start, total = [], i, 0
            total += n
        open_rows.append(pdf.iloc[start:])
    if open_rows:
        last = pd.concat(open_rows)
        if len(last):
            yield last
