"""Weight-table queries: ``part`` read as the tensors of many models, ``embeddings`` as their rows."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.catalog.function_queries import V, vecs
from loomspark.functions.blocks import BLOCK_SIZES
from loomspark.operators import weights as W
from loomspark.plans.bounds import spread

KINDS = ["attn_norm", "attn_q", "attn_k", "attn_v", "attn_output", "ffn_norm", "ffn_gate", "ffn_up", "ffn_down"]
TYPES = ["F32", "F16", "Q4_0", "Q8_0"]

TENSORS = f"""t0 AS (SELECT p_partkey, 'model-' || lpad((p_partkey // 64)::VARCHAR, 5, '0') AS file, (p_partkey % 64)::BIGINT AS idx, 32 * (1 + p_size % 7) AS d0, 64 * (1 + p_partkey % 5) AS d1 FROM part),
tensors AS (SELECT file, idx, CASE idx WHEN 0 THEN 'token_embd.weight' WHEN 1 THEN 'output.weight' WHEN 2 THEN 'output_norm.weight' ELSE 'blk.' || ((idx - 3) // 9) || '.' || {KINDS}[(idx - 3) % 9 + 1] || '.weight' END AS tensor,
 {TYPES}[p_partkey % 4 + 1] AS type, d0::BIGINT AS d0, d1::BIGINT AS d1 FROM t0),
ten AS (SELECT file, idx, tensor, type, CASE WHEN tensor LIKE '%norm.weight' THEN [d1] ELSE [d0, d1] END AS shape, CASE WHEN tensor LIKE '%norm.weight' THEN d1 ELSE d0 * d1 END AS n_elements FROM tensors)"""
SIZES = "CASE type WHEN 'F32' THEN n_elements * 4 WHEN 'F16' THEN n_elements * 2 WHEN 'Q4_0' THEN n_elements // 32 * 18 ELSE n_elements // 32 * 34 END"


def tensors(t):
    k = F.col("p_partkey")
    idx = k % 64
    kind = F.element_at(F.array(*map(F.lit, KINDS)), ((idx - 3) % 9 + 1).cast("int"))
    inner = F.concat(F.lit("blk."), F.floor((idx - 3) / 9).cast("string"), F.lit("."), kind, F.lit(".weight"))
    name = F.when(idx == 0, "token_embd.weight").when(idx == 1, "output.weight").when(idx == 2, "output_norm.weight").otherwise(F.when(idx >= 3, inner))
    d0, d1 = (32 * (1 + F.col("p_size") % 7)).cast("long"), (64 * (1 + k % 5)).cast("long")
    rows = t.part.select(
        F.format_string("model-%05d", F.floor(k / 64)).alias("file"), idx.alias("idx"), name.alias("tensor"),
        F.element_at(F.array(*map(F.lit, TYPES)), (k % 4 + 1).cast("int")).alias("type"), d0.alias("d0"), d1.alias("d1"),
    )
    shape = F.when(F.endswith("tensor", F.lit("norm.weight")), F.array("d1")).otherwise(F.array("d0", "d1"))
    return rows.select("file", "idx", "tensor", "type", shape.alias("shape"))


@query("g1_inventory", f"WITH {TENSORS} SELECT file, idx, tensor, type, array_to_string(shape, 'x') AS shape, n_elements, {SIZES} AS n_bytes FROM ten")
def _(t):
    rows = W.tensor_inventory(tensors(t))
    return rows.withColumn("shape", F.array_join(F.col("shape").cast("array<string>"), "x"))


GROUPS = "CASE WHEN tensor LIKE 'blk.%' THEN 'blk.' || split_part(tensor, '.', 2) ELSE 'base' END"


@query(
    "g2_group_rollup",
    f"WITH {TENSORS}, g AS (SELECT file, {GROUPS} AS grp, count(*) AS n_tensors, sum(n_elements)::BIGINT AS elements FROM ten GROUP BY 1, 2) SELECT file, grp, n_tensors, elements, round(100 * elements / sum(elements) OVER (PARTITION BY file), 6) AS pct FROM g",
)
def _(t):
    return W.group_rollup(tensors(t)).withColumn("pct", F.round("pct", 6))


@query(
    "g3_kv_listing",
    """WITH k AS (SELECT url, page_id, string_split(url, '/') AS items FROM pages)
SELECT 'site' AS file, page_id * 2 AS idx, 'url' AS key, 'STRING' AS pretty_type, 1::INTEGER AS n, CASE WHEN length(url) > 60 THEN '`' || left(url, 30) || '`...`' || right(url, 30) || '`' ELSE '`' || url || '`' END AS value FROM k
UNION ALL SELECT 'site', page_id * 2 + 1, 'parts', '[STRING]', len(items)::INTEGER, '[ ' || array_to_string(list_transform(items[:5], lambda s: CASE WHEN length(s) > 30 THEN '`' || left(s, 15) || '`...`' || right(s, 15) || '`' ELSE '`' || s || '`' END), ', ') || CASE WHEN len(items) > 5 THEN ', ...' ELSE '' END || ' ]' FROM k""",
)
def _(t):
    url = t.pages.select(F.lit("site").alias("file"), (F.col("page_id") * 2).alias("idx"), F.lit("url").alias("key"), F.lit("STRING").alias("type"), F.lit(False).alias("is_array"), F.array("url").alias("items"))
    parts = t.pages.select(F.lit("site").alias("file"), (F.col("page_id") * 2 + 1).alias("idx"), F.lit("parts").alias("key"), F.lit("STRING").alias("type"), F.lit(True).alias("is_array"), F.split("url", "/", -1).alias("items"))
    return W.kv_listing(url.unionByName(parts))


@query(
    "g4_count_labels",
    """WITH c AS (SELECT o_orderkey AS k, (o_orderkey * o_orderkey * o_custkey + o_custkey)::BIGINT AS c FROM orders)
SELECT k, CASE WHEN c > 1e12 THEN '~' || round_even(c * 1e-12, 0)::BIGINT || 'T' WHEN c > 1e9 THEN '~' || round_even(c * 1e-9, 0)::BIGINT || 'B' WHEN c > 1e6 THEN '~' || round_even(c * 1e-6, 0)::BIGINT || 'M' WHEN c > 1e3 THEN '~' || round_even(c * 1e-3, 0)::BIGINT || 'K' ELSE c::VARCHAR END AS label FROM c""",
)
def _(t):
    # Keys of some millions make counts that no long holds.
    k, c = (F.col(x).cast("decimal(38,0)") for x in ("o_orderkey", "o_custkey"))
    return t.orders.select(F.col("o_orderkey").alias("k"), W.count_label(k * k * c + c).alias("label"))


@query(
    "g4_size_labels",
    """WITH c AS (SELECT o_orderkey AS k, ((o_orderkey + 1) * (o_custkey + 1) * 1000)::BIGINT AS c FROM orders),
s AS (SELECT k, c, CASE WHEN c > 1e12 THEN c * 1e-12 WHEN c > 1e9 THEN c * 1e-9 WHEN c > 1e6 THEN c * 1e-6 ELSE c * 1e-3 END AS x, CASE WHEN c > 1e12 THEN 'T' WHEN c > 1e9 THEN 'B' WHEN c > 1e6 THEN 'M' ELSE 'K' END AS u FROM c)
SELECT k, (CASE WHEN k % 3 = 0 THEN '8x' ELSE '' END) || (CASE WHEN round_even(x, 0) >= 10 THEN printf('%.0f', round_even(x, 0)) WHEN round_even(x, 0) >= 1 THEN printf('%.1f', x) ELSE printf('%.2f', x) END) || u AS label FROM s""",
)
def _(t):
    c = ((F.col("o_orderkey") + 1) * (F.col("o_custkey") + 1) * 1000).cast("long")
    k = F.col("o_orderkey")
    return t.orders.select(k.alias("k"), W.size_label(c, c, F.lit(0).cast("long"), F.when(k % 3 == 0, 8).otherwise(0)).alias("label"))


ADAPT = """ad AS (SELECT 'ad-' || p_partkey // 64 AS file, p_partkey % 64 AS idx, 'blk.' || (p_partkey % 64) // 2 || '.w.' || CASE WHEN p_partkey % 2 = 0 THEN 'lora_a' ELSE 'lora_b' END AS tensor,
 CASE WHEN p_partkey % 2 = 0 THEN [8, 64 + p_partkey // 64] ELSE [32 + p_partkey % 7, 8] END AS shape FROM part)"""


@query(
    "g5_adapter_totals",
    f"""WITH {ADAPT}, b AS (SELECT y.file, y.shape[1] * x.shape[2] AS n FROM ad y JOIN ad x ON x.file = y.file AND x.idx = y.idx - 1 WHERE y.idx % 2 = 1)
SELECT file, -sum(n)::BIGINT AS total, sum(n)::BIGINT AS shared, 0::BIGINT AS expert, 0::BIGINT AS experts FROM b GROUP BY 1""",
)
def _(t):
    k = F.col("p_partkey")
    even = k % 2 == 0
    rows = t.part.select(
        F.concat(F.lit("ad-"), F.floor(k / 64).cast("string")).alias("file"), (k % 64).alias("idx"),
        F.concat(F.lit("blk."), F.floor(k % 64 / 2).cast("string"), F.lit(".w."), F.when(even, "lora_a").otherwise("lora_b")).alias("tensor"),
        F.when(even, F.array(F.lit(8).cast("long"), 64 + F.floor(k / 64))).otherwise(F.array((32 + k % 7).cast("long"), F.lit(8).cast("long"))).alias("shape"),
    )
    return W.param_totals(rows)


@query(
    "g5_expert_totals",
    f"""WITH {TENSORS}, x AS (SELECT file, n_elements AS n, tensor LIKE '%ffn_up%' AS e FROM ten)
SELECT file, sum(CASE WHEN e THEN n * 4 ELSE n END)::BIGINT AS total, sum(CASE WHEN e THEN 0 ELSE n END)::BIGINT AS shared, sum(CASE WHEN e THEN n ELSE 0 END)::BIGINT AS expert, (CASE WHEN bool_or(e) THEN 4 ELSE 0 END)::BIGINT AS experts FROM x GROUP BY 1""",
)
def _(t):
    up = F.contains("tensor", F.lit("ffn_up"))
    rows = tensors(t).withColumn("shape", F.when(up, F.concat(F.array(F.lit(4).cast("long")), "shape")).otherwise(F.col("shape")))
    return W.param_totals(rows.withColumn("tensor", F.when(up, F.replace("tensor", F.lit("ffn_up"), F.lit("ffn_up_exps"))).otherwise(F.col("tensor"))))


@query(
    "g6_model_catalogue",
    """WITH p AS (SELECT 'Base' || p_size % 5 AS base, (p_size % 3 + 1) || 'B' AS size, CASE WHEN p_partkey % 2 = 0 THEN lower(p_type) END AS finetune, p_brand AS org FROM part)
SELECT base, size, finetune, count(*) AS n, count(DISTINCT org) AS n_orgs FROM p GROUP BY 1, 2, 3""",
)
def _(t):
    tune = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("-"), F.lower("p_type"))).otherwise("")
    mid = F.concat("p_brand", F.lit("/Base"), (F.col("p_size") % 5).cast("string"), F.lit("-"), (F.col("p_size") % 3 + 1).cast("string"), F.lit("B"), tune, F.lit("-v"), (F.col("p_partkey") % 9).cast("string"))
    return W.model_catalogue(t.part.select(mid.alias("model_id")))


@query(
    "g7_file_names",
    """SELECT p_partkey, replace(p_name, ' ', '-') || '-' || p_size || 'B' || CASE WHEN p_partkey % 2 = 0 THEN '-chat-x' ELSE '' END || '-v1-' || upper(p_type) AS name FROM part""",
)
def _(t):
    rows = t.part.select(
        "p_partkey", F.lit("n").alias("name"), F.col("p_name").alias("base"), F.concat(F.col("p_size").cast("string"), F.lit("B")).alias("size"),
        F.when(F.col("p_partkey") % 2 == 0, "chat x").alias("finetune"), F.lit("v1").alias("version"), F.lower("p_type").alias("type"), F.lit(None).cast("string").alias("kind"),
    )
    return rows.select("p_partkey", W.model_file_name(rows).alias("name"))


@query(
    "g8_merge_metadata",
    """WITH o AS (SELECT p_partkey, p_brand AS author FROM part WHERE p_partkey % 2 = 0), d AS (SELECT p_partkey, 'direct ' || p_name AS name FROM part WHERE p_partkey % 3 = 0)
SELECT p.p_partkey, coalesce(d.name, p.p_name) AS name, coalesce(o.author, p.p_type) AS author FROM part p LEFT JOIN o USING (p_partkey) LEFT JOIN d USING (p_partkey)""",
)
def _(t):
    guess = t.part.select("p_partkey", F.col("p_name").alias("name"), F.col("p_type").alias("author"))
    over = t.part.filter("p_partkey % 2 = 0").select("p_partkey", F.col("p_brand").alias("author"))
    direct = t.part.filter("p_partkey % 3 = 0").select("p_partkey", F.concat(F.lit("direct "), "p_name").alias("name"))
    return W.merge_metadata("p_partkey", guess, over, direct)


@query("g9_map_names", f"WITH {TENSORS} SELECT file, idx, tensor AS mapped FROM ten")
def _(t):
    """Names are turned into the source form and mapped back."""
    spark = t.part.sparkSession
    rules = spark.createDataFrame(W.DECODER_NAMES, "source string, target string")
    back = rules.select(F.col("target").alias("source"), F.col("source").alias("target"))
    source = W.map_tensor_names(tensors(t), back).select("file", "idx", F.col("mapped").alias("tensor"))
    return W.map_tensor_names(source, rules).select("file", "idx", "mapped")


@query(
    "g10_edit_kv",
    """WITH kv AS (SELECT 'page ' || page_id AS file, unnest([0, 1, 2])::INTEGER AS idx, unnest(['url', 'n', 'kind']) AS key, unnest([url, length(html)::VARCHAR, 'html']) AS value FROM pages)
SELECT file, idx, key, CASE WHEN key = 'kind' THEN 'text' ELSE value END AS value FROM kv WHERE key <> 'n' UNION ALL SELECT 'page ' || page_id, 4, 'added', 'x' FROM pages""",
)
def _(t):
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.alias("value"))
    items = F.array(pair("url", F.col("url")), pair("n", F.length("html").cast("string")), pair("kind", F.lit("html")))
    rows = t.pages.select(F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("file"), F.posexplode(items).alias("idx", "kv")).select("file", "idx", "kv.key", "kv.value")
    return W.edit_kv(rows, ["n"], {"kind": "text", "added": "x"})


def blocks_of(t):
    return spread(vecs(t).select("vec_id", F.col("v").cast("array<float>").alias("values")), "vec_id")


@query("g11_g12_codecs")
def _(t):
    """Bytes and round-trip error of every codec whose blocks fit the vectors."""
    out = None
    for kind in ("F16", "BF16", "Q4_0", "Q4_1", "Q5_0", "Q5_1", "Q8_0"):
        coded = W.quantize(blocks_of(t).withColumn("orig", F.col("values")), kind)
        back = W.dequantize(coded.withColumn("size", F.length("payload")), kind)
        err = F.aggregate(F.zip_with("orig", "values", lambda a, b: F.abs(a - b).cast("double")), F.lit(0.0), lambda m, x: F.greatest(m, x))
        rows = back.select("vec_id", F.lit(kind).alias("kind"), "size", F.round(err, 6).alias("max_error"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    "g11_round_trip_bounds",
    f"""WITH {V} SELECT vec_id, kind, (CASE kind WHEN 'F16' THEN 128 WHEN 'Q8_0' THEN 68 ELSE 36 END)::INTEGER AS size, true AS close FROM e, (SELECT unnest(['F16', 'Q8_0', 'Q4_0']) AS kind)""",
)
def _(t):
    """Sizes follow the block layout, and errors stay within one step of the scale."""
    out = None
    for kind, step in (("F16", 1 / 1024), ("Q8_0", 1 / 127), ("Q4_0", 1 / 7)):
        coded = W.quantize(blocks_of(t).withColumn("orig", F.col("values")), kind)
        back = W.dequantize(coded.withColumn("size", F.length("payload")), kind)
        top = F.array_max(F.transform("orig", lambda x: F.abs(x)))
        ok = F.forall(F.zip_with("orig", "values", lambda a, b: F.abs(a - b) <= top * step), lambda x: x)
        rows = back.select("vec_id", F.lit(kind).alias("kind"), "size", ok.alias("close"))
        out = rows if out is None else out.unionByName(rows)
    return out


def sql_type(slot):
    return "CASE type " + " ".join(f"WHEN '{k}' THEN {v[slot]}" for k, v in BLOCK_SIZES.items()) + " END"


@query(
    "g13_shapes",
    f"""WITH {TENSORS}, s AS (SELECT file, idx, type, shape, {sql_type(0)} AS b, {sql_type(1)} AS z FROM ten), y AS (SELECT *, shape[-1] // b * z AS last FROM s)
SELECT file, idx, array_to_string(list_concat(shape[:-2], [last]), 'x') AS bytes, array_to_string(shape, 'x') AS elements FROM y""",
)
def _(t):
    rows = tensors(t).withColumn("b", W.byte_shape("shape", "type"))
    show = lambda c: F.array_join(c.cast("array<string>"), "x")
    return rows.select("file", "idx", show(F.col("b")).alias("bytes"), show(W.elem_shape("b", "type")).alias("elements"))


@query("g14_plan_types", f"WITH {TENSORS} SELECT file, idx, CASE WHEN tensor LIKE '%norm.weight' THEN 'F32' WHEN tensor IN ('token_embd.weight', 'output.weight') OR shape[-1] % 256 <> 0 THEN 'F16' ELSE 'TQ2_0' END AS planned FROM ten")
def _(t):
    return W.plan_types(tensors(t), "TQ2_0").select("file", "idx", "planned")


@query(
    "g15_plan_mixed",
    f"""WITH {TENSORS}, k AS (SELECT *, regexp_extract(tensor, '(attn_v|ffn_down)', 1) AS kind, CASE WHEN tensor LIKE 'blk.%' THEN split_part(tensor, '.', 2)::INTEGER END AS blk FROM ten),
n AS (SELECT *, count(*) FILTER (kind <> '') OVER (PARTITION BY file, kind) AS n, row_number() OVER (PARTITION BY file, kind ORDER BY blk) - 1 AS i FROM k),
p AS (SELECT *, CASE WHEN tensor LIKE '%norm.weight' THEN 'F32' WHEN tensor = 'output.weight' THEN CASE WHEN shape[-1] % 256 <> 0 THEN 'Q8_0' ELSE 'Q6_K' END
  WHEN kind <> '' AND (i < n // 8 OR i >= 7 * n // 8 OR (i - n // 8) % 3 = 2) THEN 'Q6_K' ELSE 'Q4_K' END AS p FROM n)
SELECT file, idx, CASE WHEN p IN ('F32', 'Q8_0') OR shape[-1] % 256 = 0 THEN p WHEN p = 'Q6_K' THEN 'Q8_0' ELSE 'Q5_0' END AS planned FROM p""",
)
def _(t):
    return W.plan_types_mixed(tensors(t), "Q4_K_M").select("file", "idx", "planned")


def _mixed(name: str, mix: str, base: str, head: str, rules: list[tuple[str, str]], **options) -> None:
    """A mix with its rules in SQL: kind, block b, rank i of the block among the n of its kind."""
    block = "CASE {} " + " ".join(f"WHEN '{k}' THEN {v[0]}" for k, v in BLOCK_SIZES.items()) + " END"
    lower = " ".join(f"WHEN p IN {kinds} THEN '{to}'" for kinds, to in (("('Q4_K')", "Q5_0"), ("('Q5_K')", "Q5_1"), ("('Q6_K')", "Q8_0"), ("('Q2_K', 'Q3_K', 'IQ2_S', 'IQ2_XS', 'IQ3_S', 'IQ3_XXS')", "IQ4_NL")))
    cases = " ".join(f"WHEN {test} THEN '{to}'" for test, to in rules)

    @query(
        name,
        f"""WITH {TENSORS}, k AS (SELECT *, regexp_extract(tensor, '(attn_v|attn_k|attn_q|attn_output|ffn_down|ffn_gate|ffn_up)', 1) AS kind, CASE WHEN tensor LIKE 'blk.%' THEN split_part(tensor, '.', 2)::INTEGER END AS b FROM ten),
m AS (SELECT *, count(*) FILTER (kind <> '') OVER (PARTITION BY file, kind) AS n, row_number() OVER (PARTITION BY file, kind ORDER BY b) - 1 AS i FROM k),
p AS (SELECT *, CASE WHEN tensor LIKE '%norm.weight' THEN 'F32' WHEN tensor = 'output.weight' THEN CASE WHEN shape[-1] % {BLOCK_SIZES[base][0]} <> 0 THEN 'Q8_0' ELSE '{head}' END {cases} ELSE '{base}' END AS p FROM m),
q AS (SELECT *, CASE WHEN p IN ('F32', 'F16') OR shape[-1] % {block.format('p')} = 0 THEN p {lower} END AS q FROM p)
SELECT file, idx, CASE WHEN q IS NOT NULL AND shape[-1] % {block.format('q')} = 0 THEN q ELSE 'F16' END AS planned FROM q""",
    )
    def _(t):
        return W.plan_types_mixed(tensors(t), mix, **options).select("file", "idx", "planned")


EIGHTHS = "({0} < n // 8 OR {0} >= 7 * n // 8 OR ({0} - n // 8) % 3 = 2)"
_mixed("g15_small_mix", "IQ2_M", "IQ2_S", "Q5_K", [("tensor = 'token_embd.weight'", "IQ3_S"), ("kind IN ('attn_v', 'attn_output')", "IQ3_S"), ("kind = 'ffn_down' AND i < n // 8", "IQ3_S")])
_mixed("g15_experts", "Q4_K_M", "Q4_K", "Q6_K", [("kind IN ('attn_v', 'attn_k')", "Q8_0"), ("kind = 'attn_output'", "Q5_K"), (f"kind = 'ffn_down' AND {EIGHTHS.format('b')}", "Q6_K")], experts=8)
_mixed("g15_importance_data", "Q4_0", "Q4_0", "Q6_K", [("kind = 'ffn_down' AND i < n // 8", "Q4_1")], data=True)
_mixed(
    "g15_architecture", "Q3_K_M", "Q3_K", "Q8_0",
    [("kind = 'attn_v' AND i < 2", "Q5_K"), ("kind = 'attn_v'", "Q4_K"), ("kind = 'ffn_down' AND i < n // 16", "Q5_K"), (f"kind = 'ffn_down' AND {EIGHTHS.format('i')}", "Q4_K")],
    arch="falcon",
)
_mixed("g15_wide_model", "Q3_K_S", "Q3_K", "Q6_K", [("kind = 'attn_v'", "Q5_K")], size="70B")
_mixed(
    "g15_middle_layers", "IQ3_XS", "IQ3_S", "Q6_K",
    [("kind = 'attn_v'", "Q4_K"), ("kind IN ('attn_k', 'attn_q')", "IQ3_XXS"), ("kind IN ('ffn_gate', 'ffn_up') AND i >= n // 8 AND i < 7 * n // 8", "IQ3_XXS")],
    gqa=4,
)


ERR = "x AS (SELECT 'label ' || label AS tensor, unnest(v) AS x FROM e), d AS (SELECT tensor, abs(x - round(x, 1)) AS d FROM x WHERE tensor <> 'label 3')"


@query(
    "g16_quant_error",
    f"""WITH {V}, {ERR}, a AS (SELECT tensor, d, least(floor(d / 0.03::DOUBLE * 150), 149)::BIGINT AS b FROM d UNION ALL SELECT '(all)', d, least(floor(d / 0.03::DOUBLE * 150), 149)::BIGINT FROM d),
h AS (SELECT tensor, b, count(*) AS n, sum(d * d) AS ss, max(d) AS mx FROM a GROUP BY 1, 2), c AS (SELECT *, sum(n) OVER (PARTITION BY tensor ORDER BY b) AS cum, sum(n) OVER (PARTITION BY tensor) AS al FROM h)
SELECT tensor, round(sqrt(sum(ss) / sum(n)), 9) AS rmse, round(max(mx), 9) AS max_error, round(min((b + 1) * 0.03::DOUBLE / 150) FILTER (cum >= al * 0.5), 9) AS median, round(min((b + 1) * 0.03::DOUBLE / 150) FILTER (cum >= al * 0.95), 9) AS pct95, sum(n)::BIGINT AS n FROM c GROUP BY 1""",
)
def _(t):
    rows = vecs(t).select(F.concat(F.lit("label "), F.col("label").cast("string")).alias("tensor"), F.explode("v").alias("x"))
    out = W.quant_error(rows.withColumn("y", F.round("x", 1)), exclude=["label 3"])
    return out.withColumns({c: F.round(c, 9) for c in ("rmse", "max_error", "median", "pct95")})


@query(
    "g17_size_report",
    f"WITH {TENSORS} SELECT file, sum(n_elements)::BIGINT AS elements, sum({SIZES})::BIGINT AS bytes_before, sum(n_elements // 32 * 34)::BIGINT AS bytes_after, round(8 * sum(n_elements // 32 * 34) / sum(n_elements), 6) AS bits_per_weight FROM ten GROUP BY 1",
)
def _(t):
    rows = W.size_report(tensors(t).withColumn("planned", F.lit("Q8_0")))
    return rows.withColumn("bits_per_weight", F.round("bits_per_weight", 6))


def contents(t):
    return t.documents.select("source", F.col("source").alias("file"), F.col("doc_id").alias("idx"), F.concat(F.lit("doc."), F.col("doc_id").cast("string")).alias("tensor"), F.encode("text", "UTF-8").alias("data"))


@query(
    "g18_tensor_hashes",
    "SELECT source AS file, 'doc.' || doc_id AS tensor, kind, CASE kind WHEN 'sha1' THEN sha1(text) ELSE sha256(text) END AS hash FROM documents, (SELECT unnest(['sha1', 'sha256']) AS kind)",
)
def _(t):
    return W.hash_tensors(contents(t))


@query(
    "g18_file_hashes",
    "WITH f AS (SELECT source AS file, string_agg(text, '' ORDER BY doc_id) AS all_text FROM documents GROUP BY 1) SELECT file, kind, CASE kind WHEN 'sha1' THEN sha1(all_text) ELSE sha256(all_text) END AS hash FROM f, (SELECT unnest(['sha1', 'sha256']) AS kind)",
)
def _(t):
    return W.hash_files(contents(t), ("sha1", "sha256"))


MANIFEST = "m AS (SELECT 'sha256' AS kind, 'doc.' || doc_id AS name, CASE WHEN doc_id % 7 = 0 THEN 'bad' ELSE sha256(text) END AS hash, doc_id AS line FROM documents WHERE doc_id % 5 <> 0)"


@query(
    "g19_verify_manifest",
    "SELECT 'sha256' AS kind, 'doc.' || doc_id AS name, sha256(text) AS hash, CASE WHEN doc_id % 5 = 0 THEN 'not found' WHEN doc_id % 7 = 0 THEN 'mismatch' ELSE 'ok' END AS status FROM documents",
)
def _(t):
    actual = W.hash_tensors(contents(t), ("sha256",)).select("kind", F.col("tensor").alias("name"), "hash")
    doc = F.substring("name", 5, 20).cast("long")
    manifest = actual.withColumn("line", doc).filter("line % 5 <> 0").withColumn("hash", F.when(F.col("line") % 7 == 0, "bad").otherwise(F.col("hash")))
    return W.verify_manifest(actual, manifest)


@query(
    "g20_verify_checksums",
    "SELECT 'page ' || page_id AS filename, page_id % 4 <> 0 AND page_id % 6 <> 0 AS valid, page_id % 6 = 0 AS missing FROM pages",
)
def _(t):
    name = F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("filename")
    listed = t.pages.select(name, F.when(F.col("page_id") % 4 == 0, "0").otherwise(F.sha2("html", 256)).alias("hash"))
    files = t.pages.filter("page_id % 6 <> 0").select(name, F.col("html").cast("binary").alias("content"))
    return W.verify_checksums(listed, files)


@query("g21_shards_by_count", f"WITH {TENSORS} SELECT file, idx, idx // 10 AS shard FROM ten")
def _(t):
    return W.plan_shards(tensors(t), mode="tensors", limit=10).select("file", "idx", "shard")


def sql_pack(size, limit):
    return f"""WITH RECURSIVE {TENSORS}, z AS MATERIALIZED (SELECT file, idx, {size} AS n FROM ten),
r AS (SELECT file, idx, n AS total, 0::BIGINT AS shard FROM z WHERE idx = 0 UNION ALL SELECT z.file, z.idx, CASE WHEN r.total + z.n > {limit} THEN z.n ELSE r.total + z.n END, CASE WHEN r.total + z.n > {limit} THEN r.shard + 1 ELSE r.shard END
 FROM r JOIN z ON z.file = r.file AND z.idx = r.idx + 1) SELECT file, idx, shard FROM r"""


@query("g21_shards_by_size", sql_pack(f"(({SIZES}) + 31) // 32 * 32", 600_000))
def _(t):
    return W.plan_shards(tensors(t), mode="size", limit=600_000, width=32).select("file", "idx", "shard")


@query("g22_writer_shards", sql_pack(SIZES, 500_000))
def _(t):
    return W.plan_shards_writer(tensors(t), max_bytes=500_000).select("file", "idx", "shard")


@query("g23_merge_shards", f"WITH {TENSORS} SELECT file AS prefix, idx AS pos, tensor FROM ten")
def _(t):
    """Files are cut in shards by count and joined again."""
    cut = W.plan_shards_writer(tensors(t), max_tensors=10)
    name = F.concat("file", F.format_string("-%05d-of-%05d.gguf", F.col("shard") + 1, F.col("n_shards")))
    rows = cut.select(name.alias("file"), (F.col("idx") % 10).alias("idx"), "tensor", F.when(F.col("shard") == 0, F.col("n_shards")).alias("split_count"))
    return W.merge_shards(rows).select("prefix", "pos", "tensor")


@query("g24_pair_adapters", f"WITH {ADAPT} SELECT file, replace(tensor, '.lora_a', '') AS base, tensor AS a, replace(tensor, 'lora_a', 'lora_b') AS b FROM ad WHERE idx % 2 = 0")
def _(t):
    k = F.col("p_partkey")
    rows = t.part.select(
        F.concat(F.lit("ad-"), F.floor(k / 64).cast("string")).alias("file"),
        F.concat(F.lit("blk."), F.floor(k % 64 / 2).cast("string"), F.lit(".w."), F.when(k % 2 == 0, "lora_a").otherwise("lora_b")).alias("tensor"),
    )
    return W.pair_adapters(rows)


@query(
    "g25_merge_adapters",
    f"""WITH {V}, o AS (SELECT label, v, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS row FROM e), a AS (SELECT label, v FROM o WHERE row = 0)
SELECT o.label::VARCHAR AS tensor, o.row, round(list_sum(list_transform(list_zip(o.v, a.v), lambda p: p[1] + 0.5 * o.v[1] * p[2])), 6) AS total FROM o JOIN a USING (label)""",
)
def _(t):
    """Rank-1 adapters: A is each label's first vector, B the first entry of every vector."""
    from loomspark.plans.prefix import running_sums

    pos = running_sums(vecs(t).select("label", "vec_id"), ["label"], "vec_id", {"row": F.lit(1).cast("long")}, inclusive=False)
    rows = vecs(t).join(pos.select("vec_id", "row"), "vec_id").select(F.col("label").cast("string").alias("tensor"), "row", F.col("v").alias("values"))
    first = rows.filter("row = 0").select("tensor", F.array("values").alias("a"))
    col = rows.groupBy("tensor").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", F.get("values", F.lit(0)).alias("x")))), lambda e: F.array(e["x"])).alias("b"))
    adapters = first.join(col, "tensor").select("tensor", "a", "b", F.lit(2.0).alias("alpha"), F.lit(0.25).alias("strength"))
    merged = W.merge_adapters(rows, adapters)
    return merged.select("tensor", "row", F.round(F.aggregate("values", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query(
    "g25_merge_embeddings",
    f"""WITH {V}, o AS (SELECT label, v, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS row FROM e), f AS (SELECT label, v FROM o WHERE row = 0)
SELECT 'token_embd.' || o.label AS tensor, o.row, round(list_sum(list_transform(list_zip(o.v, f.v), lambda p: p[1] + 0.25 * (o.v[1] * p[2] - o.v[2] * p[2]))), 6) AS total FROM o JOIN f USING (label)""",
)
def _(t):
    """Rank-2 adapters of token tables: A has the first two entries of every vector, B each label's first vector and its negative."""
    from loomspark.plans.prefix import running_sums

    pos = running_sums(vecs(t).select("label", "vec_id"), ["label"], "vec_id", {"row": F.lit(1).cast("long")}, inclusive=False)
    name = F.concat(F.lit("token_embd."), F.col("label").cast("string")).alias("tensor")
    rows = vecs(t).join(pos.select("vec_id", "row"), "vec_id").select(name, "row", F.col("v").alias("values"))
    b = rows.filter("row = 0").select("tensor", F.transform("values", lambda x: F.array(x, -x)).alias("b"))
    a = rows.groupBy("tensor").agg(F.transform(F.array_sort(F.collect_list(F.struct("row", F.slice("values", 1, 2).alias("x")))), lambda e: e["x"]).alias("a"))
    adapters = a.join(b, "tensor").select("tensor", "a", "b", F.lit(2.0).alias("alpha"), F.lit(0.25).alias("strength"))
    merged = W.merge_adapters(rows, adapters)
    return merged.select("tensor", "row", F.round(F.aggregate("values", F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


@query(
    "g26_prune_layers",
    f"""WITH {TENSORS}, k AS (SELECT file, idx, tensor, CASE WHEN tensor LIKE 'blk.%' THEN split_part(tensor, '.', 2)::INTEGER END AS b FROM ten)
SELECT file, idx, CASE WHEN b IS NULL THEN tensor ELSE 'blk.' || (b - (b > 2)::INTEGER - (b > 4)::INTEGER) || '.' || split_part(tensor, '.', 3) || '.weight' END AS tensor FROM k WHERE b IS NULL OR b NOT IN (2, 4)""",
)
def _(t):
    return W.prune_layers(tensors(t), [2, 4]).select("file", "idx", "tensor")
