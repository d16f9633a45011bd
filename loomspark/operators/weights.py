"""Weight-table analytics.

Tensors are rows ``(file, idx, tensor, type, shape array<long>)`` with the slowest dimension first; data are rows
``(file, tensor, row, values array<float>)`` or binary payloads.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.functions import blocks
from loomspark.operators.windows import pack_greedy
from loomspark.plans.bounds import checked, require
from loomspark.plans.prefix import running_sums

ALIGNMENT = 32
HIST_BUCKETS, HIST_RANGE = 150, 0.03


def _type_col(kind, slot: int) -> Column:
    table = F.create_map(*[F.lit(x) for k, v in blocks.BLOCK_SIZES.items() for x in (k, v[slot])])
    return F.element_at(table, F.col(kind) if isinstance(kind, str) else kind)


def n_elements(shape="shape") -> Column:
    return F.aggregate(shape, F.lit(1).cast("long"), lambda s, d: s * d)


def tensor_inventory(df: DataFrame) -> DataFrame:
    """Add ``n_elements`` and ``n_bytes``."""
    n = n_elements()
    return df.withColumn("n_elements", n).withColumn("n_bytes", (n * _type_col("type", 1) / _type_col("type", 0)).cast("long"))


def group_rollup(df: DataFrame) -> DataFrame:
    """Elements per file and name group: ``blk.N``, ``enc.blk.N``, ``enc``, … or ``base``, and the share of the file."""
    p = F.split("tensor", r"\.")
    g = (
        F.when(F.get(p, F.lit(0)) == "blk", F.concat_ws(".", F.slice(p, 1, 2)))
        .when(F.get(p, F.lit(0)).isin("enc", "dec") & (F.get(p, F.lit(1)) == "blk"), F.concat_ws(".", F.slice(p, 1, 3)))
        .when(F.get(p, F.lit(0)).isin("enc", "dec"), F.get(p, F.lit(0)))
        .otherwise("base")
    )
    per = df.withColumn("grp", g).groupBy("file", "grp").agg(F.count("*").alias("n_tensors"), F.sum(n_elements()).alias("elements"))
    total = per.groupBy("file").agg(F.sum("elements").alias("total"))
    return per.join(total, "file").select("file", "grp", "n_tensors", "elements", (100.0 * F.col("elements") / F.col("total")).alias("pct"))


def _elide(c: Column, limit: int) -> Column:
    half = limit // 2
    return F.when(F.length(c) > limit, F.concat(F.lit("`"), F.left(c, F.lit(half)), F.lit("`...`"), F.right(c, F.lit(half)), F.lit("`"))).otherwise(
        F.concat(F.lit("`"), c, F.lit("`"))
    )


def kv_listing(df: DataFrame) -> DataFrame:
    """Printable metadata ``(file, idx, key, pretty_type, n, value)`` of ``(file, idx, key, type, is_array, items array<string>)``.

    Long strings keep both ends; arrays show five strings or seven scalars.
    """
    is_str = F.col("type") == "STRING"
    shown = F.when(is_str, F.transform(F.slice("items", 1, 5), lambda s: _elide(s, 30))).otherwise(F.slice("items", 1, 7))
    more = F.when(F.size("items") > F.size(shown), ", ...").otherwise("")
    array = F.concat(F.lit("[ "), F.array_join(shown, ", "), more, F.lit(" ]"))
    first = F.get("items", F.lit(0))
    value = F.when(F.col("is_array"), array).when(is_str, _elide(first, 60)).otherwise(first)
    kind = F.when(F.col("is_array"), F.concat(F.lit("["), F.col("type"), F.lit("]"))).otherwise(F.col("type"))
    return df.select("file", "idx", "key", kind.alias("pretty_type"), F.size("items").alias("n"), value.alias("value"))


def count_label(count) -> Column:
    """Element count as ``~12M``."""
    c = F.col(count) if isinstance(count, str) else count
    out = None
    for power, suffix in ((15, "Q"), (12, "T"), (9, "B"), (6, "M"), (3, "K")):
        text = F.concat(F.lit("~"), F.bround(c * float(f"1e-{power}"), 0).cast("long").cast("string"), F.lit(suffix))
        out = F.when(c > 10.0**power, text) if out is None else out.when(c > 10.0**power, text)
    return out.otherwise(c.cast("string"))


def params_label(count, min_digits: int = 2) -> Column:
    """Parameter count as ``7.2B``: enough decimals for two digits."""
    c = F.abs(F.col(count) if isinstance(count, str) else count)
    out = None
    for power, suffix in ((12, "T"), (9, "B"), (6, "M"), (3, "K")):
        scaled = c * float(f"1e-{power}")
        whole = F.bround(scaled, 0).cast("long")
        fix = F.greatest(min_digits - F.length(F.regexp_replace(whole.cast("string"), "^0+", "")), F.lit(0))
        text = F.when(fix <= 0, F.format_string("%.0f", F.bround(scaled, 0)))
        for k in range(1, min_digits + 1):
            text = text.when(fix == k, F.format_string(f"%.{k}f", scaled))
        text = F.concat(text, F.lit(suffix))
        out = F.when(c > 10.0**power, text) if power == 12 else (out.when(c > 10.0**power, text) if power > 3 else out.otherwise(text))
    return out


def size_label(total, shared, expert, experts) -> Column:
    """``8x7B`` for expert models, else the parameter label."""
    t, s, e, n = (F.col(c) if isinstance(c, str) else c for c in (total, shared, expert, experts))
    return F.when(n > 0, F.concat(n.cast("string"), F.lit("x"), params_label(F.abs(s) + F.abs(e)))).otherwise(params_label(F.abs(t)))


def param_totals(df: DataFrame) -> DataFrame:
    """Per file: total, shared and per-expert parameters and the number of experts.

    An adapter's A side is skipped and its B side widened by A's last dimension; the total is then negative.  When a B does
    not follow its own A, all numbers of the file are 0.
    """
    a = F.endswith("tensor", F.lit(".lora_a"))
    b = F.endswith("tensor", F.lit(".lora_b"))
    rows = running_sums(df.withColumn("is_a", a).withColumn("is_b", b), ["file"], "idx", {"k": F.col("is_a").cast("long")})
    last = lambda s: F.element_at(s, -1)
    lead = rows.filter("is_a").select("file", "k", F.col("tensor").alias("a_name"), last(F.col("shape")).alias("a_last"))
    rows = rows.filter(~F.col("is_a")).join(lead, ["file", "k"], "left")
    partner = F.concat(F.expr("left(tensor, length(tensor) - 1)"), F.lit("a"))
    broken = F.col("is_b") & ~F.col("a_name").eqNullSafe(partner)
    size = F.when(F.col("is_b"), n_elements() / last(F.col("shape")) * F.col("a_last")).otherwise(n_elements()).cast("long")
    expert = F.contains("tensor", F.lit("_exps."))
    n_exp = F.get("shape", F.size("shape") - 3)
    s = rows.select("file", broken.alias("broken"), "is_b", size.alias("size"), expert.alias("expert"), n_exp.alias("n_exp"))
    agg = s.groupBy("file").agg(
        F.sum("size").alias("total"),
        F.sum(F.when(~F.col("expert"), F.col("size")).otherwise(0)).alias("shared"),
        F.sum(F.when(F.col("expert"), F.floor(F.col("size") / F.col("n_exp"))).otherwise(0)).alias("expert"),
        F.sum(F.when(F.col("expert"), F.col("n_exp")).otherwise(0)).alias("exp_sum"),
        F.count_if("expert").alias("exp_n"),
        F.bool_or("broken").alias("broken"),
    )
    adapters = rows.groupBy("file").agg(F.max("k").alias("n_a"))
    ok = ~F.col("broken")
    keep = lambda c: F.when(ok, c).otherwise(0).cast("long")
    experts = F.when(F.col("exp_n") > 0, F.floor(F.col("exp_sum") / F.col("exp_n"))).otherwise(0)
    sign = F.when(F.col("n_a") > 0, -1).otherwise(1)
    return agg.join(adapters, "file").select(
        "file", keep(F.col("total") * sign).alias("total"), keep(F.col("shared")).alias("shared"), keep(F.col("expert")).alias("expert"), keep(experts).alias("experts")
    )


# ------------------------------------------------------------------ names

# What the parts of a model id may be: (kind, pattern, whether it may come first).  Patterns are fixed values.
PART_RULES = (
    ("version", r"(?i)^(v|iter)?\d+([.]\d+)*$", True),
    ("type", r"(?i)^(i?q\d(_\w)*|b?fp?(16|32))$", True),
    ("size", r"(?i)^((([A]|\d+[x])?\d+([._]\d+)?[KMBT][\d]?)|small|mini|medium|large|x?xl)$", False),
    ("adapter", r"(?i)^lora$", False),
    ("finetune", r"(?i)^(chat|instruct|vision|lora)$", False),
)
# Written-out sizes: a dot for an underscore, 7b1 for 7.1b, a capital unit.  Fixed values.
SIZE_SPELLING = (("_", "."), (r"^(.*)(.)(\d)$", "$1.$3$2"))
SIZE_UNITS = {"K": 1e3, "M": 1e6, "B": 1e9, "T": 1e12}
ID_STATE = "struct<rest:boolean,base:array<string>,tail:array<string>,finetune:array<string>,version:array<string>,size:array<string>>"


def _spelled(part: Column) -> Column:
    """A size as it is written in names."""
    (old, new), (moved, order) = SIZE_SPELLING
    dotted = F.replace(part, F.lit(old), F.lit(new))
    dotted = F.when(dotted.rlike(r"\d$"), F.regexp_replace(dotted, moved, order)).otherwise(dotted)
    return F.when(dotted.rlike(r"\d[kmbt]$"), F.concat(F.regexp_replace(dotted, ".$", ""), F.upper(F.right(dotted, F.lit(1))))).otherwise(dotted)


def _far(size: Column, total: Column) -> Column:
    """Whether a size has little to do with the number of parameters; adapters, with a negative number, may be an eighth of it."""
    units = F.create_map(*[F.lit(x) for kv in SIZE_UNITS.items() for x in kv])
    known = size.rlike(r"^\d+(\.\d+)?[KMBT]$")
    params = F.when(known, F.regexp_extract(size, r"^([\d.]+)", 1).cast("double") * F.element_at(units, F.right(size, F.lit(1))))
    allowed = F.floor(F.abs(total) * 7 / 8)
    return F.coalesce(F.when(total < 0, params < F.floor(F.abs(total) / 8)).when(total > 0, F.abs(params - total) > allowed), F.lit(False))


def _classified(part: Column, i: Column, total: Column) -> Column:
    """(kind, text) of a part: the first rule that fits; a size that is far off is part of the finetune."""
    kind = F.lit("")
    for name, pattern, first in reversed(PART_RULES):
        fits = part.rlike(pattern) if first else (i > 0) & part.rlike(pattern)
        kind = F.when(fits & (total < 0) if name == "adapter" else fits, "type" if name == "adapter" else name).otherwise(kind)
    size = _spelled(part)
    far = (kind == "size") & _far(size, total)
    lowered = F.concat(F.regexp_replace(size, ".$", ""), F.lower(F.right(size, F.lit(1))))
    text = F.when(far, lowered).when(kind == "size", size).when(part.rlike(PART_RULES[1][1]), F.upper(part)).otherwise(part)
    return F.struct(F.when(far, "finetune").otherwise(kind).alias("kind"), text.alias("text"))


def parse_model_id(model_id, total_params=None) -> Column:
    """``struct(name, org, base, finetune, version, size)`` of ids like ``org/Base-v1-7B-chat``.

    The parts between dashes are classified by ``PART_RULES`` and read once from the left.  Words and versions belong to the base
    up to the first part of another sort, and behind it to the finetune and the version; versions at the end of an id that is
    base only are its version.  Beside a size in numbers a size in words is a word.  With ``total_params`` a size far
    from it counts as part of the finetune; a negative total marks an adapter.
    """
    total = F.lit(0) if total_params is None else F.coalesce(total_params if isinstance(total_params, Column) else F.lit(total_params), F.lit(0))
    c = F.col(model_id) if isinstance(model_id, str) else model_id
    slash = F.instr(c, "/")
    org, name = F.when(slash > 0, F.substring(c, F.lit(1), slash - 1)), F.substring(c, slash + 1, F.length(c))
    parts = F.filter(F.split(name, "-"), lambda p: p != "")
    none = F.array().cast("array<string>")
    keep = lambda cond, old, *new: F.when(cond, F.concat(old, *new)).otherwise(old)

    def read(s: Column, x: Column) -> Column:
        one = F.array(x["text"])
        opens = ~s["rest"] & ((x["kind"] == "version") | (x["kind"] == "") & x["text"].rlike(r"^\p{L}"))
        word, version = opens & (x["kind"] == ""), x["kind"] == "version"
        # A version waits in the tail: it is the base's if anything comes behind it.
        return F.struct(
            (~opens).alias("rest"),
            F.when(s["rest"] | opens & version, s["base"]).when(word, F.concat(s["base"], s["tail"], one)).otherwise(F.concat(s["base"], s["tail"])).alias("base"),
            F.when(opens & version, F.concat(s["tail"], one)).otherwise(none).alias("tail"),
            keep(~opens & x["kind"].isin("", "finetune"), s["finetune"], one).alias("finetune"),
            keep(~opens & version, s["version"], one).alias("version"),
            keep(x["kind"] == "size", s["size"], one).alias("size"),
        ).cast(ID_STATE)

    def close(s: Column) -> Column:
        joined = lambda a: F.nullif(F.array_join(a, "-"), F.lit(""))
        base, tune, size = joined(s["base"]), joined(s["finetune"]), joined(F.array_distinct(s["size"]))
        version = joined(F.concat(s["tail"], s["version"]))
        told = tune.isNotNull() | size.isNotNull() | version.isNotNull()
        return F.struct(F.when(told, base).alias("base"), tune.alias("finetune"), version.alias("version"), size.alias("size"))

    tags = F.transform(parts, lambda p, i: _classified(p, i, total))
    numbered = F.exists(tags, lambda x: (x["kind"] == "size") & x["text"].rlike(r"\d"))
    plain = lambda x: numbered & (x["kind"] == "size") & x["text"].rlike(r"^\p{L}+$")
    tags = F.transform(tags, lambda x: F.struct(F.when(plain(x), "").otherwise(x["kind"]).alias("kind"), x["text"].alias("text")))
    start = F.struct(F.lit(False).alias("rest"), *[none.alias(k) for k in ("base", "tail", "finetune", "version", "size")]).cast(ID_STATE)
    found = F.aggregate(tags, start, read, close)
    sentence = F.contains(c, F.lit(" "))
    only = lambda f: F.when(~sentence, found[f]).alias(f)
    return F.struct(
        F.when(sentence, c).otherwise(name).alias("name"),
        F.when(~sentence & ~F.startswith(org, F.lit(".")), org).alias("org"),
        only("base"), only("finetune"), only("version"), only("size"),
    )


def model_catalogue(df: DataFrame, model_id: str = "model_id") -> DataFrame:
    """Models per base, size and finetune."""
    rows = df.select(parse_model_id(model_id).alias("m")).select("m.*")
    return rows.groupBy("base", "size", "finetune").agg(F.count("*").alias("n"), F.count_distinct("org").alias("n_orgs"))


def model_file_name(df: DataFrame, stem: str = "model") -> Column:
    """``Base-7B-chat-v1-Q4_0`` from columns name, base, size, finetune, version, type, kind; missing ones are left out, ``stem`` stands for a missing name."""
    dash = lambda c: F.replace(F.trim(c), F.lit(" "), F.lit("-"))
    head = F.coalesce(F.replace(dash("base"), F.lit("/"), F.lit("-")), F.replace(dash("name"), F.lit("/"), F.lit("-")), F.lit(stem))
    return F.concat_ws("-", head, F.col("size"), dash("finetune"), dash("version"), F.upper(dash("type")), dash("kind"))


def merge_metadata(key: str, heuristic: DataFrame, override: DataFrame, direct: DataFrame) -> DataFrame:
    """One row per key; a direct value beats an override, an override beats a guess."""
    fields = [c for c in heuristic.columns if c != key]
    named = lambda d, p: d.select(key, *[F.col(c).alias(f"{p}_{c}") for c in fields if c in d.columns])
    rows = named(heuristic, "h").join(named(override, "o"), key, "full_outer").join(named(direct, "d"), key, "full_outer")
    best = lambda c: F.coalesce(*[F.col(f"{p}_{c}") for p in "doh" if f"{p}_{c}" in rows.columns]).alias(c)
    return rows.select(key, *[best(c) for c in fields])


# Names of the common decoder family: fixed values; further families come as a table.
DECODER_NAMES = [
    ("model.embed_tokens", "token_embd"),
    ("model.norm", "output_norm"),
    ("lm_head", "output"),
    ("model.layers.{bid}.input_layernorm", "blk.{bid}.attn_norm"),
    ("model.layers.{bid}.self_attn.q_proj", "blk.{bid}.attn_q"),
    ("model.layers.{bid}.self_attn.k_proj", "blk.{bid}.attn_k"),
    ("model.layers.{bid}.self_attn.v_proj", "blk.{bid}.attn_v"),
    ("model.layers.{bid}.self_attn.o_proj", "blk.{bid}.attn_output"),
    ("model.layers.{bid}.post_attention_layernorm", "blk.{bid}.ffn_norm"),
    ("model.layers.{bid}.mlp.gate_proj", "blk.{bid}.ffn_gate"),
    ("model.layers.{bid}.mlp.up_proj", "blk.{bid}.ffn_up"),
    ("model.layers.{bid}.mlp.down_proj", "blk.{bid}.ffn_down"),
]


def map_tensor_names(df: DataFrame, rules: DataFrame, *, strict: bool = True, suffixes: Sequence[str] = (".weight", ".bias")) -> DataFrame:
    """Add ``mapped``: the target of ``rules(source, target)``, tried as is and without a suffix, ``{bid}`` being the block.

    An unmapped name is an error, or null when not ``strict``.
    """
    bid = F.regexp_extract("tensor", r"(?:^|\.)(\d+)(?:\.|$)", 1)
    keyed = F.regexp_replace("tensor", r"(^|\.)\d+(\.|$)", "$1{bid}$2")
    suffix = F.lit("")
    for s in reversed(suffixes):
        suffix = F.when(F.endswith("tensor", F.lit(s)), F.lit(s)).otherwise(suffix)
    rows = df.withColumn("__bid", bid).withColumn("__sfx", suffix).withColumn("__full", keyed)
    rows = rows.withColumn("__cut", F.expr("left(__full, length(__full) - length(__sfx))"))
    rule = lambda key, out: rules.select(F.col("source").alias(key), F.col("target").alias(out))
    rows = rows.join(rule("__full", "__t1"), "__full", "left").join(rule("__cut", "__t2"), "__cut", "left")
    target = F.coalesce(F.col("__t1"), F.concat("__t2", "__sfx"))
    out = rows.withColumn("mapped", F.replace(target, F.lit("{bid}"), F.col("__bid"))).drop("__bid", "__sfx", "__full", "__cut", "__t1", "__t2")
    return checked(out, F.col("mapped").isNull(), "a tensor name has no mapping") if strict else out


def edit_kv(df: DataFrame, remove: Sequence[str], replace: dict[str, str]) -> DataFrame:
    """Metadata without the removed keys, with values replaced in place and new keys at the end."""
    kept = df.filter(~F.col("key").isin(*remove)) if remove else df
    value = F.col("value")
    for k, v in replace.items():
        value = F.when(F.col("key") == k, F.lit(v)).otherwise(value)
    kept = kept.withColumn("value", value)
    ends = df.groupBy("file").agg(F.max("idx").alias("last"))
    out = kept.select("file", "idx", "key", "value")
    for n, (k, v) in enumerate(replace.items(), 1):
        new = ends.join(df.filter(F.col("key") == k).select("file"), "file", "left_anti")
        out = out.unionByName(new.select("file", (F.col("last") + n).alias("idx"), F.lit(k).alias("key"), F.lit(v).alias("value")))
    return out


# ------------------------------------------------------------------ blocks


def quantize(df: DataFrame, kind: str, *, values: str = "values") -> DataFrame:
    """Replace float rows by ``payload`` bytes; rows are independent, so nothing is shuffled."""
    return _codec(df, values, "payload", T.BinaryType(), lambda m: [r.tobytes() for r in blocks.encode(m, kind)], np.float32)


def dequantize(df: DataFrame, kind: str, *, payload: str = "payload") -> DataFrame:
    def back(m: np.ndarray) -> list:
        return list(blocks.decode(m, kind))

    return _codec(df, payload, "values", T.ArrayType(T.FloatType()), back, np.uint8)


def _codec(df: DataFrame, src: str, dst: str, out_type: T.DataType, fn, dtype) -> DataFrame:
    keep = [f for f in df.schema.fields if f.name != src]
    schema = T.StructType([*keep, T.StructField(dst, out_type)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = pdf.drop(columns=[src])
            cells = pdf[src].map(lambda v: np.frombuffer(v, dtype=np.uint8) if isinstance(v, (bytes, bytearray)) else np.asarray(v, dtype=dtype))
            res = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
            for _, part in cells.groupby(cells.map(len)):
                res.loc[part.index] = pd.Series(fn(np.stack(part.to_numpy())), index=part.index, dtype=object)
            out[dst] = res
            yield out

    return df.mapInPandas(run, schema)


def byte_shape(shape, kind) -> Column:
    """Shape in bytes of a shape in elements; null when the last dimension does not divide."""
    s = F.col(shape) if isinstance(shape, str) else shape
    last = F.element_at(s, -1)
    block, size = _type_col(kind, 0), _type_col(kind, 1)
    return F.when(last % block == 0, F.concat(F.slice(s, F.lit(1), F.size(s) - 1), F.array((last / block * size).cast("long"))))


def elem_shape(shape, kind) -> Column:
    s = F.col(shape) if isinstance(shape, str) else shape
    last = F.element_at(s, -1)
    block, size = _type_col(kind, 0), _type_col(kind, 1)
    return F.when(last % size == 0, F.concat(F.slice(s, F.lit(1), F.size(s) - 1), F.array((last / size * block).cast("long"))))


# Tensor kinds always kept in 32-bit floats: fixed values.
ALWAYS_F32 = (
    "ffn_gate_inp", "position_embd", "token_types", "ssm_conv1d", "time_mix_first", "time_mix_w1", "time_mix_w2",
    "time_mix_decay_w1", "time_mix_decay_w2", "time_mix_lerp_fused", "posnet.*.norm1", "posnet.*.norm2",
)


def plan_types(df: DataFrame, target: str) -> DataFrame:
    """Add ``planned``: the storage type of each tensor when converting to ``target``."""
    kinds = "|".join(k.replace(".", r"\.").replace("*", r"\d+") for k in ALWAYS_F32)
    name = F.col("tensor")
    planned = (
        F.when((F.size("shape") <= 1) | F.endswith(name, F.lit("_norm.weight")), "F32")
        .when(name.rlike(rf"^(blk\.\d+\.)?({kinds})\.weight$") | ~F.endswith(name, F.lit(".weight")), "F32")
        .otherwise("F16" if target in ("TQ1_0", "TQ2_0") else target)
    )
    if target in ("TQ1_0", "TQ2_0"):
        planned = F.when(planned == "F32", "F32").when(name.isin("token_embd.weight", "output.weight"), "F16").otherwise(target)
    rows = df.withColumn("planned", planned)
    fits = F.element_at("shape", -1) % _type_col("planned", 0) == 0
    return rows.withColumn("planned", F.when(fits, F.col("planned")).otherwise("F16"))


# Base type of each mix: fixed values.
MIX_BASE = {
    "Q2_K": "Q2_K", "Q2_K_S": "Q2_K", "Q3_K_S": "Q3_K", "Q3_K_M": "Q3_K", "Q3_K_L": "Q3_K", "Q4_K_S": "Q4_K", "Q4_K_M": "Q4_K", "Q5_K_S": "Q5_K",
    "Q5_K_M": "Q5_K", "Q6_K": "Q6_K", "Q4_0": "Q4_0", "Q4_1": "Q4_1", "Q5_0": "Q5_0", "Q5_1": "Q5_1", "Q8_0": "Q8_0",
    "IQ1_S": "IQ1_S", "IQ1_M": "IQ1_M", "IQ2_XXS": "IQ2_XXS", "IQ2_XS": "IQ2_XS", "IQ2_S": "IQ2_XS", "IQ2_M": "IQ2_S",
    "IQ3_XXS": "IQ3_XXS", "IQ3_XS": "IQ3_S", "IQ3_S": "IQ3_S", "IQ3_M": "IQ3_S", "IQ4_NL": "IQ4_NL", "IQ4_XS": "IQ4_XS", "TQ1_0": "TQ1_0", "TQ2_0": "TQ2_0",
}
# The smallest mixes have rules of their own: fixed values.
SMALL_MIXES = ("IQ1_S", "IQ1_M", "IQ2_XXS", "IQ2_XS", "IQ2_S", "IQ2_M")
OTHER_MIXES = tuple(m for m in MIX_BASE if m not in SMALL_MIXES)
# Types of the output and of the token table, where they are not the rule: fixed values.
HEAD_TYPES = {m: "Q5_K" for m in (*SMALL_MIXES, "IQ3_XXS")}
EMBEDDING_TYPES = {"IQ2_XXS": "Q2_K", "IQ2_XS": "Q2_K", "IQ1_S": "Q2_K", "IQ1_M": "Q2_K", "IQ2_S": "IQ3_S", "IQ2_M": "IQ3_S", "IQ3_XXS": "IQ3_S", "TQ1_0": "Q4_K", "TQ2_0": "Q4_K"}
# Exceptions by tensor kind: (kind, mixes, what has to hold, type); the first that holds wins, "base" is the mix's own type.  Fixed values.
MIX_RULES: list[tuple[str, tuple[str, ...], str, str]] = [
    ("attn_v", SMALL_MIXES, "gqa4", "Q4_K"),
    ("attn_v", SMALL_MIXES, "experts4", "Q4_K"),
    ("attn_v", ("IQ2_S", "IQ2_M"), "", "IQ3_S"),
    ("attn_v", SMALL_MIXES, "", "Q2_K"),
    ("attn_v", OTHER_MIXES, "experts8", "Q8_0"),
    ("attn_v", ("Q2_K", "Q2_K_S", "IQ3_XXS", "IQ3_XS", "IQ3_S"), "gqa4", "Q4_K"),
    ("attn_v", ("Q2_K",), "", "Q3_K"),
    ("attn_v", ("IQ3_XXS",), "!data", "IQ3_S"),
    ("attn_v", ("IQ3_M",), "", "Q4_K"),
    ("attn_v", ("Q3_K_M",), "first2", "Q5_K"),
    ("attn_v", ("Q3_K_M",), "", "Q4_K"),
    ("attn_v", ("Q3_K_L",), "", "Q5_K"),
    ("attn_v", ("IQ4_NL", "IQ4_XS"), "gqa4", "Q5_K"),
    ("attn_v", ("Q4_K_M", "Q5_K_M"), "more", "Q6_K"),
    ("attn_v", ("Q4_K_S",), "first4", "Q5_K"),
    ("attn_k", SMALL_MIXES, "experts8", "Q4_K"),
    ("attn_k", OTHER_MIXES, "experts8", "Q8_0"),
    ("attn_k", ("IQ3_XS",), "", "IQ3_XXS"),
    ("attn_k", ("IQ3_XXS",), "", "IQ2_S"),
    ("attn_q", ("IQ3_XS",), "", "IQ3_XXS"),
    ("attn_q", ("IQ3_XXS",), "", "IQ2_S"),
    ("ffn_down", ("IQ2_S", "IQ2_M"), "first8th", "IQ3_S"),
    ("ffn_down", SMALL_MIXES, "first8th", "Q2_K"),
    ("ffn_down", ("Q2_K",), "", "Q3_K"),
    ("ffn_down", ("Q2_K_S",), "first8th", "Q4_K"),
    ("ffn_down", ("IQ3_XXS",), "!data first8th", "Q4_K"),
    ("ffn_down", ("IQ3_XXS",), "!data", "Q3_K"),
    ("ffn_down", ("Q3_K_M",), "first16th", "Q5_K"),
    ("ffn_down", ("Q3_K_M",), "!falcon", "Q4_K"),
    ("ffn_down", ("Q3_K_M",), "more", "Q4_K"),
    ("ffn_down", ("IQ3_M",), "first8th", "Q4_K"),
    ("ffn_down", ("IQ3_M",), "experts8 more", "Q4_K"),
    ("ffn_down", ("Q3_K_L",), "falcon", "Q4_K"),
    ("ffn_down", ("Q3_K_L",), "", "Q5_K"),
    ("ffn_down", ("Q4_K_M",), "falcon first16th", "Q6_K"),
    ("ffn_down", ("Q4_K_M",), "falcon more", "Q5_K"),
    ("ffn_down", ("Q4_K_M",), "!falcon more", "Q6_K"),
    ("ffn_down", ("Q5_K_M",), "more", "Q6_K"),
    ("ffn_down", ("IQ4_NL", "IQ4_XS"), "!data first8th", "Q5_K"),
    ("ffn_down", ("Q4_K_S",), "!falcon first8th", "Q5_K"),
    ("ffn_down", ("Q4_0",), "data first8th", "Q4_1"),
    ("ffn_down", ("Q5_0",), "data first8th", "Q5_1"),
    ("attn_output", SMALL_MIXES, "experts8", "Q5_K"),
    ("attn_output", ("IQ1_S", "IQ1_M"), "", "IQ2_XXS"),
    ("attn_output", ("IQ2_S", "IQ2_M"), "", "IQ3_S"),
    ("attn_output", ("Q3_K_L",), "falcon", "Q4_K"),
    ("attn_output", OTHER_MIXES, "falcon", "base"),
    ("attn_output", ("Q2_K", "IQ3_XS", "IQ3_XXS", "Q3_K_S", "Q3_K_M", "IQ4_NL", "Q4_K_S", "Q4_K_M", "IQ3_S", "IQ3_M", "IQ4_XS"), "experts8", "Q5_K"),
    ("attn_output", OTHER_MIXES, "experts8", "base"),
    ("attn_output", ("Q2_K",), "", "Q3_K"),
    ("attn_output", ("IQ3_XXS",), "", "IQ3_S"),
    ("attn_output", ("Q3_K_M", "IQ3_M"), "", "Q4_K"),
    ("attn_output", ("Q3_K_L",), "", "Q5_K"),
    ("attn_qkv", ("Q3_K_M", "Q3_K_L", "IQ3_M"), "", "Q4_K"),
    ("attn_qkv", ("Q4_K_M",), "", "Q5_K"),
    ("attn_qkv", ("Q5_K_M",), "", "Q6_K"),
    ("ffn_gate", ("IQ3_XS",), "middle", "IQ3_XXS"),
    ("ffn_up", ("IQ3_XS",), "middle", "IQ3_XXS"),
]
# Types that the values of a shared key take instead in the 70B model: fixed values.
WIDE_TYPES = {"Q3_K": "Q5_K", "Q4_K": "Q5_K"}
# Types that need longer rows step down to: fixed values.
STEP_DOWN = {
    "TQ1_0": "Q4_0", "TQ2_0": "Q4_0", "Q4_K": "Q5_0", "Q5_K": "Q5_1", "Q6_K": "Q8_0",
    **dict.fromkeys(("Q2_K", "Q3_K", "IQ4_XS", "IQ1_S", "IQ1_M", "IQ2_XXS", "IQ2_XS", "IQ2_S", "IQ3_XXS", "IQ3_S"), "IQ4_NL"),
}


def use_more_bits(layer, layers) -> Column:
    """First and last eighth of the layers, and every third between."""
    eighth = F.floor(layers / 8)
    return (layer < eighth) | (layer >= F.floor(layers * 7 / 8)) | ((layer - eighth) % 3 == 2)


def _lookup(names: dict[str, str], key: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), key)


def plan_types_mixed(
    df: DataFrame,
    mix: str,
    *,
    gqa: int = 1,
    experts: int = 1,
    data: bool = False,
    arch: str = "",
    size: str = "",
    overrides: Sequence[tuple[str, str]] = (),
) -> DataFrame:
    """Add ``planned`` under a layer-aware mix; ``overrides`` are (regex, type) pairs, the first match wins.

    ``gqa`` heads share a key, ``experts`` is their number in a layer, ``data`` tells whether there is importance data.  Norms
    and 1-D tensors stay F32, and so do the gates that choose experts.  A layer is the rank of a tensor's block among the
    blocks of its file with that kind; with experts it is the block's number.
    """
    kind = F.regexp_extract("tensor", r"(attn_v|attn_k|attn_q|attn_qkv|attn_output|ffn_down|ffn_gate|ffn_up)(?:_exps|_shexp)?\.weight", 1)
    block = F.regexp_extract("tensor", r"^blk\.(\d+)\.", 1)
    rows = df.withColumn("__kind", kind).withColumn("__blk", F.when(block != "", block.cast("int")))
    seen = rows.filter("__kind != '' AND __blk IS NOT NULL").select("file", "__kind", "__blk").distinct()
    layer = Window.partitionBy("file", "__kind").orderBy("__blk")  # one row per block of a model
    ranked = seen.withColumn("__layer", F.row_number().over(layer) - 1)
    counts = seen.groupBy("file", "__kind").agg(F.count("*").alias("__n"))
    rows = rows.join(ranked, ["file", "__kind", "__blk"], "left").join(counts, ["file", "__kind"], "left")
    i, n = F.col("__blk") if experts > 1 else F.col("__layer"), F.col("__n")
    eighth = F.floor(n / 8)
    holds = {
        "gqa4": F.lit(gqa >= 4), "experts4": F.lit(experts >= 4), "experts8": F.lit(experts == 8), "data": F.lit(data), "falcon": F.lit(arch == "falcon"),
        "first2": i < 2, "first4": i < 4, "first8th": i < eighth, "first16th": i < F.floor(n / 16), "more": use_more_bits(i, n),
        "middle": (i >= eighth) & (i < F.floor(n * 7 / 8)),
    }
    base = MIX_BASE[mix]
    last = F.element_at("shape", -1)
    has_output = df.filter(F.col("tensor") == "output.weight").select("file").distinct().withColumn("__out", F.lit(True))
    rows = rows.join(has_output, "file", "left")
    is_output = (F.col("tensor") == "output.weight") | ((F.col("tensor") == "token_embd.weight") & F.col("__out").isNull())
    plain = HEAD_TYPES.get(mix, "Q8_0" if base == "Q8_0" else "Q6_K")
    head = F.when(F.lit(arch == "falcon") | (last % blocks.BLOCK_SIZES[base][0] != 0), "Q8_0").otherwise(plain)
    floats = (F.size("shape") <= 1) | F.endswith("tensor", F.lit("_norm.weight")) | ~F.endswith("tensor", F.lit("weight")) | F.col("tensor").contains("ffn_gate_inp.weight")
    out = F.when(floats, "F32")
    for pattern, to in overrides:
        out = out.when(F.col("tensor").rlike(pattern), to)
    out = out.when(is_output, head)
    if mix in EMBEDDING_TYPES:
        out = out.when(F.col("tensor").isin("token_embd.weight", "per_layer_token_embd.weight"), EMBEDDING_TYPES[mix])
    for k, mixes, when, to in MIX_RULES:
        if mix in mixes:
            to = base if to == "base" else to
            if size == "70B" and k == "attn_v" and mix in OTHER_MIXES:
                to = WIDE_TYPES.get(to, to)
            test = F.col("__kind") == k
            for word in when.split():
                test = test & (~holds[word[1:]] if word[0] == "!" else holds[word])
            out = out.when(test, to)
    if size == "70B" and mix in OTHER_MIXES:
        out = out.when(F.col("__kind") == "attn_v", WIDE_TYPES.get(base, base))
    rows = rows.withColumn("__t", out.otherwise(base))
    stepped = F.when(last % _type_col("__t", 0) == 0, F.col("__t")).otherwise(_lookup(STEP_DOWN, F.col("__t")))
    rows = rows.withColumn("__s", stepped)
    planned = F.when(F.col("__s").isNotNull() & (last % _type_col("__s", 0) == 0), F.col("__s")).otherwise("F16")
    return rows.withColumn("planned", planned).select(*df.columns, "planned")


def quant_error(df: DataFrame, *, include: Sequence[str] = (), exclude: Sequence[str] = (), x: str = "x", y: str = "y") -> DataFrame:
    """Round-trip error of ``(tensor, x, y)`` per tensor and over all: rmse, maximum, and 50/95 % bounds from a histogram."""
    keep = F.lit(True) if not include else F.lit(False)
    for pattern in include:
        keep = keep | F.col("tensor").rlike(pattern)
    for pattern in exclude:
        keep = ~F.col("tensor").rlike(pattern) & keep
    d = F.abs(F.col(x) - F.col(y))
    rows = df.filter(keep).select("tensor", d.alias("d"), F.least(F.floor(d / HIST_RANGE * HIST_BUCKETS), F.lit(HIST_BUCKETS - 1)).alias("bucket"))
    # at most 150 rows per tensor go on
    hist = rows.groupBy("tensor", "bucket").agg(F.count("*").alias("n"), F.sum(F.col("d") * F.col("d")).alias("ss"), F.max("d").alias("mx"))
    total = hist.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("ss").alias("ss"), F.max("mx").alias("mx"))
    both = hist.unionByName(total.select(F.lit("(all)").alias("tensor"), "bucket", "n", "ss", "mx"))
    w = Window.partitionBy("tensor").orderBy("bucket")
    run = both.withColumn("cum", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy("tensor")))
    edge = (F.col("bucket") + 1) * HIST_RANGE / HIST_BUCKETS
    bound = lambda q: F.min(F.when(F.col("cum") >= F.col("all") * q, edge))
    return run.groupBy("tensor").agg(
        F.sqrt(F.sum("ss") / F.sum("n")).alias("rmse"), F.max("mx").alias("max_error"), bound(0.5).alias("median"), bound(0.95).alias("pct95"), F.sum("n").alias("n")
    )


def size_report(df: DataFrame, *, before: str = "type", after: str = "planned") -> DataFrame:
    """Bytes per file before and after, and bits per weight."""
    n = n_elements()
    size = lambda k: F.sum((n * _type_col(k, 1) / _type_col(k, 0)).cast("long"))
    s = df.groupBy("file").agg(F.sum(n).alias("elements"), size(before).alias("bytes_before"), size(after).alias("bytes_after"))
    return s.withColumn("bits_per_weight", 8.0 * F.col("bytes_after") / F.col("elements"))


# ------------------------------------------------------------------ hashes

# Name space of the tensor-file UUIDs: fixed value.
UUID_SPACE = "ef001206-dadc-5f6d-a15f-3359e577d4e5"
SKIPPED_SUFFIXES = (".attention.masked_bias", ".attention.bias", ".rotary_emb.inv_freq")


def _hashed(df: DataFrame, skip: Sequence[str]) -> DataFrame:
    rows = df
    for s in skip:
        rows = rows.filter(~F.endswith("tensor", F.lit(s)))
    return rows


def hash_tensors(df: DataFrame, kinds: Sequence[str] = ("sha1", "sha256"), *, skip: Sequence[str] = SKIPPED_SUFFIXES) -> DataFrame:
    """``(file, tensor, kind, hash)`` of each tensor's bytes ``(file, idx, tensor, data)``.

    With a column ``part`` the rows are pieces of tensors, as the tensor source gives them: those of one tensor stream through
    one task in their order, so a tensor may be larger than a value.
    """
    rows = _hashed(df, skip)
    if "part" in df.columns:
        parts = rows.select("file", "tensor", "part", "data").repartition("file", "tensor").sortWithinPartitions("file", "tensor", "part")
        return _running_hashes(parts.drop("part"), ["file", "tensor"], kinds)
    fns = {"sha1": F.sha1("data"), "sha256": F.sha2("data", 256), "uuid": _uuid5("data"), "xxh64": _xxh64("data")}
    items = F.array(*[F.struct(F.lit(k).alias("kind"), fns[k].alias("hash")) for k in kinds])
    return rows.select("file", "tensor", F.explode(items).alias("h")).select("file", "tensor", "h.kind", "h.hash")


@F.pandas_udf(T.StringType())
def _xxh64(data: pd.Series) -> pd.Series:
    """XXH64 with seed 0 (the built-in function has another, fixed seed)."""
    import xxhash

    return data.map(lambda b: None if b is None else xxhash.xxh64_hexdigest(b))


def _uuid5(data) -> Column:
    """Version 5 UUID of the name space and the bytes."""
    raw = F.sha1(F.concat(F.unhex(F.lit(UUID_SPACE.replace("-", ""))), F.col(data) if isinstance(data, str) else data))
    hexed = F.substring(raw, 1, 32)
    variant = F.lower(F.hex(F.conv(F.substring(hexed, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3)).bitwiseOR(F.lit(8))))
    fixed = F.concat(F.substring(hexed, 1, 12), F.lit("5"), F.substring(hexed, 14, 3), variant, F.substring(hexed, 18, 15))
    cut = lambda a, n: F.substring(fixed, a, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


def hash_files(df: DataFrame, kinds: Sequence[str] = ("sha1", "sha256", "uuid"), *, skip: Sequence[str] = SKIPPED_SUFFIXES) -> DataFrame:
    """``(file, kind, hash)`` over all tensors of a file in order; rows may be pieces of tensors, with a column ``part``.

    A running hash needs its bytes in order: tasks work on files side by side, and a file's tensors stream through one task.
    """
    order = ["file", "idx", *[c for c in ("part",) if c in df.columns]]
    parts = _hashed(df, skip).select(*order, "data").repartition("file").sortWithinPartitions(*order)
    return _running_hashes(parts.select("file", "data"), ["file"], kinds)


def _running_hashes(parts: DataFrame, keys: Sequence[str], kinds: Sequence[str]) -> DataFrame:
    """``(*keys, kind, hash)`` of rows ``(*keys, data)`` that come in order within a task."""
    import hashlib
    import uuid

    import xxhash

    def start() -> dict:
        return {k: xxhash.xxh64() if k == "xxh64" else hashlib.sha256() if k == "sha256" else hashlib.sha1(uuid.UUID(UUID_SPACE).bytes if k == "uuid" else b"") for k in kinds}

    def finish(names: tuple, hs: dict) -> pd.DataFrame:
        out = {k: str(uuid.UUID(bytes=h.digest()[:16], version=5)) if k == "uuid" else h.hexdigest() for k, h in hs.items()}
        return pd.DataFrame({**dict(zip(keys, names)), "kind": list(out), "hash": list(out.values())})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, hashes = None, {}
        for pdf in batches:
            for *names, data in zip(*(pdf[c] for c in (*keys, "data"))):
                if tuple(names) != current:
                    if current is not None:
                        yield finish(current, hashes)
                    current, hashes = tuple(names), start()
                for h in hashes.values():
                    h.update(data)
        if current is not None:
            yield finish(current, hashes)

    return parts.mapInPandas(run, "".join(f"{k} string, " for k in keys) + "kind string, hash string")


def verify_manifest(actual: DataFrame, manifest: DataFrame) -> DataFrame:
    """``status`` of each ``(kind, name, hash)``: the manifest's first entry with that kind and name decides."""
    first = manifest.groupBy("kind", "name").agg(F.min_by("hash", "line").alias("want"))
    status = F.when(F.col("want").isNull(), "not found").when(F.col("want") == F.col("hash"), "ok").otherwise("mismatch")
    return actual.join(first, ["kind", "name"], "left").select("kind", "name", "hash", status.alias("status"))


def verify_checksums(listed: DataFrame, files: DataFrame) -> DataFrame:
    """``(filename, valid, missing)`` of a checksum list ``(hash, filename)`` against ``files(filename, content)``."""
    seen = files.select("filename", F.sha2("content", 256).alias("got"))
    rows = listed.join(seen, "filename", "left")
    return rows.select("filename", F.coalesce(F.col("got") == F.col("hash"), F.lit(False)).alias("valid"), F.col("got").isNull().alias("missing"))


# ------------------------------------------------------------------ shards


def plan_shards(df: DataFrame, *, mode: str, limit: int, empty_first: bool = False, width: int = 65_536) -> DataFrame:
    """Add ``shard``: every ``limit``-th tensor opens one, or padded bytes would exceed ``limit``; in tensor order."""
    rows = tensor_inventory(df)
    if mode == "tensors":
        out = rows.withColumn("shard", F.floor(F.col("idx") / limit).cast("long"))
    else:
        padded = F.ceil(F.col("n_bytes") / ALIGNMENT) * ALIGNMENT
        rows = rows.withColumn("padded", padded.cast("long"))
        # a tensor beyond the limit stands alone, as any total with it is over
        sized = rows.withColumn("__s", F.least("padded", F.lit(limit)))
        out = pack_greedy(sized, ["file"], "idx", "__s", limit, width=width).withColumnRenamed("batch", "shard").drop("__s", "padded")
        first_big = sized.filter((F.col("idx") == 0) & (F.col("padded") > limit)).select("file")
        if first_big.limit(1).count():
            raise ValueError("a shard would have no tensors; the limit is too small")
    return out.withColumn("shard", F.col("shard") + 1) if empty_first else out


def plan_shards_writer(df: DataFrame, *, max_tensors: int = 0, max_bytes: int = 0, stem: str = "model", width: int = 65_536) -> DataFrame:
    """Shards as the writer opens them: at least one tensor each, unpadded bytes, either limit; with shard file names."""
    rows = tensor_inventory(df)
    if max_bytes and max_tensors:
        raise ValueError("give one limit")
    if max_tensors:
        out = rows.withColumn("shard", F.floor(F.col("idx") / max_tensors).cast("long"))
    elif max_bytes:
        sized = rows.withColumn("__s", F.least("n_bytes", F.lit(max_bytes)))
        out = pack_greedy(sized, ["file"], "idx", "__s", max_bytes, width=width).withColumnRenamed("batch", "shard").drop("__s")
    else:
        out = rows.withColumn("shard", F.lit(0).cast("long"))
    counts = out.groupBy("file").agg((F.max("shard") + 1).alias("n_shards"))
    name = F.when(F.col("n_shards") == 1, F.lit(f"{stem}.gguf")).otherwise(F.format_string(f"{stem}-%05d-of-%05d.gguf", F.col("shard") + 1, F.col("n_shards")))
    return out.join(counts, "file").withColumn("shard_file", name)


SHARD_NAME = r"^(.*)-(\d{5})-of-(\d{5})\.gguf$"


def merge_shards(df: DataFrame) -> DataFrame:
    """Tensors of complete shard sets ``(file, idx, tensor, …, split_count)`` as one list per prefix.

    Shard 1 must carry a split count that matches its name, and every shard must be there.
    """
    rows = df.withColumn("prefix", F.regexp_extract("file", SHARD_NAME, 1)).withColumn("no", F.regexp_extract("file", SHARD_NAME, 2))
    rows = rows.withColumn("of", F.regexp_extract("file", SHARD_NAME, 3))
    rows = checked(rows, F.col("of") == "", "a shard's file name does not fit the pattern")
    rows = rows.withColumn("no", F.col("no").cast("int")).withColumn("of", F.col("of").cast("int"))
    sets = rows.groupBy("prefix").agg(
        F.count_distinct("no").alias("have"), F.max("of").alias("of_"), F.max(F.when(F.col("no") == 1, F.col("split_count"))).alias("split")
    )
    bad = ~F.coalesce(F.col("split") >= 1, F.lit(False)) | (F.col("split") != F.col("of_")) | (F.col("have") != F.col("split"))
    require(sets, bad, "a shard set is incomplete or its first shard has no split count")
    sizes = rows.groupBy("prefix", "no").agg(F.count("*").alias("__n"))
    offs = running_sums(sizes, ["prefix"], "no", {"__off": F.col("__n")}, inclusive=False).select("prefix", "no", "__off")
    return rows.join(offs, ["prefix", "no"]).withColumn("pos", F.col("__off") + F.col("idx")).drop("__off", "split_count", "no", "of")


# ------------------------------------------------------------------ adapters and pruning


def pair_adapters(df: DataFrame) -> DataFrame:
    """``(file, base, a, b)`` of adapter tensors; names that are neither A, B nor a norm are errors."""
    side = F.regexp_extract("tensor", r"\.lora_([ABab])(?:\.weight)?$|\.lora_embedding_([AB])$", 0)
    letter = F.lower(F.regexp_extract("tensor", r"\.lora_(?:embedding_)?([ABab])(?:\.weight)?$", 1))
    norm = F.col("tensor").rlike(r"(_layernorm|\bnorm)\.weight$")
    rows = df.withColumn("side", letter).withColumn("base", F.replace("tensor", side, F.lit("")))
    rows = checked(rows, (F.col("side") == "") & ~norm, "unexpected tensor name in an adapter")
    pairs = rows.filter("side != ''").groupBy("file", "base").pivot("side", ["a", "b"]).agg(F.first("tensor"))
    return checked(pairs, F.col("a").isNull() | F.col("b").isNull(), "an adapter tensor has no partner")


ADAPTER_BLOCK = 1_024


def merge_adapters(base: DataFrame, adapters: DataFrame, *, strength: str = "strength", block: int = ADAPTER_BLOCK) -> DataFrame:
    """``W + scale * B·A`` for weight rows ``(tensor, row, values)`` and adapters ``(tensor, a, b, alpha, strength)``.

    ``a`` is rank x inputs and ``b`` outputs x rank, as arrays of rows, one adapter per row.  Tables of token vectors are
    the other way round: their rows are those of ``a`` (tokens x rank), and ``b`` is width x rank, so ``A·B'`` is added.  scale =
    strength * alpha / rank, or strength when alpha is 0.  Weight rows meet, in blocks, their own rows of the long matrix and the
    other one; adapters add.
    """
    turned = F.startswith("tensor", F.lit("token_embd"))
    sides = adapters.select("tensor", "alpha", strength, turned.alias("turned"), F.when(turned, F.col("a")).otherwise(F.col("b")).alias("long"), F.when(turned, F.col("b")).otherwise(F.col("a")).alias("short"))
    rank = F.size(F.get("long", F.lit(0)))
    scale = F.when(F.col("alpha") != 0, F.col(strength) * F.col("alpha") / rank).otherwise(F.col(strength))
    last = F.floor((F.size("long") - 1) / block).cast("long")
    parts = sides.select("tensor", "turned", "long", "short", scale.alias("scale"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("blk"))
    parts = parts.select(F.col("tensor").alias("ad_tensor"), F.col("blk").alias("ad_blk"), "turned", "short", "scale", F.slice("long", (F.col("blk") * block + 1).cast("int"), F.lit(block)).alias("long"))
    rows = base.select("tensor", "row", "values", F.floor(F.col("row") / block).cast("long").alias("blk"))

    def add(weights: pd.DataFrame, ads: pd.DataFrame) -> pd.DataFrame:
        if weights.empty:
            return weights[["tensor", "row", "values"]]
        w = np.stack(weights["values"].to_numpy()).astype(np.float64)
        at = (weights["row"] - weights["blk"] * block).to_numpy()
        for ad in ads.itertuples(index=False):
            own, other = np.stack(ad.long).astype(np.float64), np.stack(ad.short).astype(np.float64)
            inside = at < len(own)
            w[inside] += ad.scale * own[at[inside]] @ (other.T if ad.turned else other)
        return weights[["tensor", "row"]].assign(values=list(w))

    return rows.groupBy("tensor", "blk").cogroup(parts.groupBy("ad_tensor", "ad_blk")).applyInPandas(add, "tensor string, row long, values array<double>")


def prune_layers(df: DataFrame, layers: Sequence[int], *, name: str = "tensor", file: str = "file") -> DataFrame:
    """Drop the listed blocks and number the later ones without gaps; works on tensor and importance names alike.

    Blocks in front of the first pruned one keep their number.
    """
    block = F.regexp_extract(name, r"blk\.(\d+)\.", 1)
    rows = df.withColumn("__b", F.when(block != "", block.cast("int")))
    kept = rows.filter(F.col("__b").isNull() | ~F.col("__b").isin(*layers))
    front = min(layers)
    blocks_ = kept.filter("__b IS NOT NULL").select(file, "__b").distinct()
    ends = blocks_.groupBy(file).agg(F.coalesce(F.max(F.when(F.col("__b") < front, F.col("__b"))) + 1, F.lit(0)).alias("__next"))
    late = blocks_.filter(F.col("__b") > front).withColumn("__r", F.row_number().over(Window.partitionBy(file).orderBy("__b")) - 1)  # one row per block
    numbers = late.join(ends, file).select(file, "__b", (F.col("__next") + F.col("__r")).alias("__new"))
    new = F.concat(F.lit("blk."), F.coalesce("__new", "__b").cast("string"), F.lit("."))
    renamed = F.when(F.col("__b").isNull(), F.col(name)).otherwise(F.regexp_replace(F.col(name), F.lit(r"blk\.\d+\."), new))
    return kept.join(numbers, [file, "__b"], "left").withColumn(name, renamed).drop("__b", "__new")
