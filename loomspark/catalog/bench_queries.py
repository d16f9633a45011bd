"""Benchmark and service queries: ``lineitem`` read as benchmark runs, ``events`` as requests and tool tests."""

from pyspark.sql import functions as F

from loomspark.catalog.base import query
from loomspark.operators import benchmarks as B

# benchmark rows from line items: two commits of different id length, two models, three tests
BENCH = """bench AS (SELECT CASE WHEN l_orderkey % 2 = 0 THEN 'abcd1234' ELSE 'ef5678901' END AS build_commit, l_orderkey % 2 AS build_number, 'cpu' AS cpu_info, 'NVIDIA GeForce ' || l_suppkey % 2 AS gpu_info, 'CUDA' AS backends,
 'm.bin' AS model_filename, 'llama ' || l_partkey % 2 || 'B Q4_K - Medium' AS model_type, 512 AS n_batch, (l_suppkey % 3) * 128 AS n_ubatch, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE '0.00' END AS tensor_split, 99 AS n_gpu_layers,
 [512, 0, 512][l_linenumber % 3 + 1]::BIGINT AS n_prompt, [0, 128, 128][l_linenumber % 3 + 1]::BIGINT AS n_gen, (CASE WHEN l_linenumber % 2 = 0 THEN 512 ELSE 0 END)::BIGINT AS n_depth, l_shipdate AS test_time, l_quantity AS avg_ts, l_partkey % 2 AS flash_attn FROM lineitem)"""


def bench_rows(t):
    ln, odd = F.col("l_linenumber"), F.col("l_orderkey") % 2
    known = {
        "build_commit": F.when(odd == 0, "abcd1234").otherwise("ef5678901"), "build_number": odd, "cpu_info": F.lit("cpu"),
        "gpu_info": F.concat(F.lit("NVIDIA GeForce "), (F.col("l_suppkey") % 2).cast("string")), "backends": F.lit("CUDA"), "model_filename": F.lit("m.bin"),
        "model_type": F.concat(F.lit("llama "), (F.col("l_partkey") % 2).cast("string"), F.lit("B Q4_K - Medium")), "n_batch": F.lit(512), "n_ubatch": (F.col("l_suppkey") % 3) * 128,
        "tensor_split": F.when(F.col("l_suppkey") % 7 != 0, "0.00"), "n_gpu_layers": F.lit(99), "n_prompt": F.when(ln % 3 == 1, 0).otherwise(512), "n_gen": F.when(ln % 3 == 0, 0).otherwise(128),
        "n_depth": F.when(ln % 2 == 0, 512).otherwise(0), "test_time": F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'"), "avg_ts": F.col("l_quantity"), "flash_attn": F.col("l_partkey") % 2,
    }
    default = {"string": F.lit("x"), "bigint": F.lit(0), "double": F.lit(0.0)}
    return t.lineitem.select(*[known.get(n, default[k]).cast(k).alias(n) for n, k in B.FIELDS])


HARM = f"{BENCH}, b AS (SELECT * REPLACE (substring(build_commit, 1, 8) AS build_commit) FROM bench)"
PAIRS = f"""{HARM}, tb AS (SELECT * FROM b WHERE build_commit = 'abcd1234'), tc AS (SELECT * FROM b WHERE build_commit = 'ef567890'),
k AS (SELECT gpu_info, model_type, n_ubatch, tensor_split, n_prompt, n_gen, n_depth, flash_attn, sum(avg_ts) FILTER (build_number = 0) AS bs, count(*) FILTER (build_number = 0) AS bn, sum(avg_ts) FILTER (build_number = 1) AS cs, count(*) FILTER (build_number = 1) AS cn FROM b WHERE tensor_split IS NOT NULL GROUP BY ALL),
p AS (SELECT *, bs * cn AS b_sum, bn * cn AS n, cs * bn AS c_sum FROM k WHERE bn > 0 AND cn > 0)"""


@query(
    "b1_bench_stats",
    """WITH s AS (SELECT l_orderkey, list(1e9 * 640 / (l_quantity * 1000000) ORDER BY l_linenumber, l_partkey) AS ts FROM lineitem GROUP BY 1)
SELECT l_orderkey, round(list_avg(ts), 4) AS avg_ts, round(coalesce(list_stddev_samp(ts), 0), 4) AS stddev_ts FROM s""",
)
def _(t):
    rows = t.lineitem.groupBy("l_orderkey").agg(F.collect_list(F.col("l_quantity") * 1000000).alias("samples_ns")).withColumn("n_prompt", F.lit(512)).withColumn("n_gen", F.lit(128))
    return B.bench_stats(rows).select("l_orderkey", F.round("avg_ts", 4).alias("avg_ts"), F.round("stddev_ts", 4).alias("stddev_ts"))


@query("b2_builds", f"WITH {HARM} SELECT build_commit, true AS mixed, count(*) AS n FROM b GROUP BY 1")
def _(t):
    return B.harmonise_builds(bench_rows(t)).groupBy("build_commit", "mixed").agg(F.count("*").alias("n"))


@query(
    "b3_compare_builds",
    f"WITH {PAIRS} SELECT model_type, gpu_info, n_gen, n_prompt, n_depth, round(sum(b_sum) / sum(n), 6) AS avg_ts_base, round(sum(c_sum) / sum(n), 6) AS avg_ts_compare FROM p GROUP BY 1, 2, 3, 4, 5",
)
def _(t):
    out = B.compare_builds(B.harmonise_builds(bench_rows(t)), "abcd1234", "ef567890", ["model_type", "gpu_info"])
    return out.withColumns({c: F.round(c, 6) for c in ("avg_ts_base", "avg_ts_compare")})


@query("b4_varying_columns", f"WITH {PAIRS}, c AS (SELECT count(DISTINCT gpu_info) > 1 AS g, count(DISTINCT n_ubatch) > 1 AS u, count(DISTINCT flash_attn) > 1 AS f FROM p) SELECT concat_ws(',', 'cpu_info_hidden', CASE WHEN g THEN 'gpu_info' END, 'model_type', CASE WHEN u THEN 'n_ubatch' END, CASE WHEN f THEN 'flash_attn' END) AS shown FROM c")
def _(t):
    show = B.varying_columns(B.harmonise_builds(bench_rows(t)), "abcd1234", "ef567890")
    lead = "cpu_info" if "cpu_info" in show else "cpu_info_hidden"
    names = ",".join([lead, *[c for c in show if c != "cpu_info"]])
    return bench_rows(t).limit(1).select(F.lit(names).alias("shown"))


LABEL = "CASE WHEN n_prompt <> 0 AND n_gen = 0 THEN 'pp' || n_prompt WHEN n_prompt = 0 AND n_gen <> 0 THEN 'tg' || n_gen ELSE 'pp' || n_prompt || '+tg' || n_gen END || CASE WHEN n_depth <> 0 THEN '@d' || n_depth ELSE '' END"


@query(
    "b5_speedup",
    f"WITH {PAIRS} SELECT model_type, {LABEL} AS test, round((sum(c_sum) / sum(n)) / (sum(b_sum) / sum(n)), 6) AS speedup FROM p GROUP BY model_type, n_prompt, n_gen, n_depth",
)
def _(t):
    out = B.with_speedup(B.compare_builds(B.harmonise_builds(bench_rows(t)), "abcd1234", "ef567890", ["model_type"]))
    return out.select("model_type", "test", F.round("speedup", 6).alias("speedup"))


@query(
    "b6_prettify",
    """SELECT 'llama ' || l_partkey % 2 || 'B Q4_K_M' AS model_type, CASE WHEN l_linenumber % 2 = 0 THEN '2x RTX' || l_suppkey % 3 ELSE 'RTX' || l_suppkey % 3 || ', P100' END AS gpu_info, CASE WHEN l_partkey % 2 = 1 THEN 'Yes' ELSE 'No' END AS flash_attn, round(l_partkey * 1000000 / 1073741824.0::DOUBLE, 9) AS model_size, count(*) AS n FROM lineitem GROUP BY ALL""",
)
def _(t):
    one = F.concat(F.lit("NVIDIA GeForce RTX"), (F.col("l_suppkey") % 3).cast("string"))
    gpu = F.when(F.col("l_linenumber") % 2 == 0, F.concat(one, F.lit(", "), one)).otherwise(F.concat(one, F.lit(", Tesla P100")))
    rows = t.lineitem.select(
        F.concat(F.lit("llama "), (F.col("l_partkey") % 2).cast("string"), F.lit("B Q4_K - Medium")).alias("model_type"), gpu.alias("gpu_info"), (F.col("l_partkey") % 2).alias("flash_attn"), (F.col("l_partkey") * 1000000).alias("model_size")
    )
    out = B.prettify(rows).withColumn("model_size", F.round("model_size", 9))
    return out.groupBy("model_type", "gpu_info", "flash_attn", "model_size").agg(F.count("*").alias("n"))


EDGES = "edges AS (SELECT o_orderkey AS commit, o_orderkey // 2 AS parent FROM orders WHERE o_orderkey > 0 UNION SELECT o_orderkey, o_orderkey // 3 FROM orders WHERE o_orderkey > 0 AND o_orderkey % 5 = 0)"


def edges(t):
    k = F.col("o_orderkey")
    rows = t.orders.filter(k > 0)
    first = rows.select(k.alias("commit"), F.floor(k / 2).alias("parent"))
    merge = rows.filter(k % 5 == 0).select(k.alias("commit"), F.floor(k / 3).alias("parent"))
    return first.unionByName(merge).distinct()


@query(
    "b7_ancestors",
    f"""WITH RECURSIVE {EDGES}, a AS (SELECT max(o_orderkey) AS commit, 0 AS depth FROM orders UNION SELECT e.parent, a.depth + 1 FROM a JOIN edges e ON e.commit = a.commit)
SELECT commit, min(depth)::INTEGER AS depth FROM a WHERE depth > 0 GROUP BY 1""",
)
def _(t):
    start = t.orders.agg(F.max("o_orderkey")).first()[0]
    return B.ancestors(edges(t), start)


@query(
    "b8_series",
    f"WITH {BENCH} SELECT model_type, {LABEL} AS test, n_ubatch::BIGINT AS n_ubatch, round(avg(avg_ts), 6) AS avg_ts FROM bench GROUP BY 1, 2, 3",
)
def _(t):
    return B.bench_series(bench_rows(t), "n_ubatch", ["model_type"]).withColumn("avg_ts", F.round("avg_ts", 6))


@query(
    "b9_batch_speeds",
    """SELECT l_orderkey, l_linenumber, l_partkey, round((CASE WHEN l_suppkey % 2 = 0 THEN 128 ELSE 128 * l_linenumber END) / l_quantity, 6) AS speed_pp, round(l_linenumber * 32 / (l_tax + 1), 6) AS speed_tg, round(l_partkey / (l_quantity + l_tax + 1), 6) AS speed FROM lineitem""",
)
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", F.lit(128).alias("pp"), F.lit(32).alias("tg"), F.col("l_linenumber").alias("pl"), F.col("l_partkey").alias("n_kv"),
        F.col("l_quantity").alias("t_pp"), (F.col("l_tax") + 1).alias("t_tg"), (F.col("l_suppkey") % 2 == 0).alias("is_pp_shared"),
    )
    out = B.batch_speeds(rows)
    return out.select("l_orderkey", "l_linenumber", "l_partkey", *[F.round(c, 6).alias(c) for c in ("speed_pp", "speed_tg", "speed")])


TRIES = """tries AS (SELECT 'm' || user_id % 3 AS model, 's' || user_id % 2 AS server_name, event_type AS test, CASE WHEN user_id % 4 = 0 THEN NULL ELSE (user_id % 4) / 2.0::DOUBLE END AS temp, event_id AS line_no, value > 5 AS ok, value AS secs, 'failure ' || event_id % 4 AS error FROM events)"""


def tries(t):
    u = F.col("user_id")
    return t.events.select(
        F.concat(F.lit("m"), (u % 3).cast("string")).alias("model"), F.concat(F.lit("s"), (u % 2).cast("string")).alias("server_name"), F.col("event_type").alias("test"), F.when(u % 4 != 0, (u % 4) / F.lit(2.0)).alias("temp"),
        F.col("event_id").alias("line_no"), (F.col("value") > 5).alias("ok"), F.col("value").alias("secs"), F.concat(F.lit("failure "), (F.col("event_id") % 4).cast("string")).alias("error"),
    )


@query(
    "b10_tool_bench_summary",
    f"""WITH {TRIES} SELECT model, server_name, test, temp, round(avg(ok::INTEGER), 9) AS success_ratio, round(avg(secs), 9) AS avg_time, round(median(secs), 9) AS median_time, sum(ok::INTEGER)::BIGINT AS success_count, sum((NOT ok)::INTEGER)::BIGINT AS failure_count,
 coalesce(string_agg(DISTINCT CASE WHEN NOT ok THEN error END, ',' ORDER BY CASE WHEN NOT ok THEN error END), '') AS failures FROM tries GROUP BY 1, 2, 3, 4""",
)
def _(t):
    out = B.tool_bench_summary(tries(t)).withColumn("failures", F.array_join("failures", ","))
    return out.withColumns({c: F.round(c, 9) for c in ("success_ratio", "avg_time", "median_time")})


def records(t):
    return tries(t).withColumn("success_ratio", F.round(F.col("secs") / 100, 6))


_CELLS = [f"s{s}\\n{e}" for s in (0, 1) for e in ("click", "error", "purchase", "signup", "view")]


@query(
    "b11_success_matrix",
    f"""WITH {TRIES}, l AS (SELECT model, temp, server_name || chr(10) || test AS cell, arg_max(round(secs / 100, 6), line_no) AS v FROM tries GROUP BY 1, 2, 3)
SELECT model || ' @ ' || coalesce(temp::VARCHAR, 'None') AS row, """
    + ", ".join(f"""coalesce(max(v) FILTER (cell = 's{s}' || chr(10) || '{e}'), 'nan'::DOUBLE) AS s{s}_{e}""" for s in (0, 1) for e in ("click", "error", "purchase", "signup", "view"))
    + " FROM l GROUP BY model, temp",
)
def _(t):
    out = B.success_matrix(records(t))
    return out.select("row", *[F.col(f"`{c}`").alias(c.replace("\n", "_")) for c in out.columns if c != "row"])


@query(
    "b11_success_maps",
    f"""WITH {TRIES}, l AS (SELECT model, temp, server_name || '/' || test AS cell, arg_max(round(secs / 100, 6), line_no) AS v FROM tries GROUP BY 1, 2, 3)
SELECT model || ' @ ' || coalesce(temp::VARCHAR, 'None') AS row, string_agg(cell || '=' || printf('%.6f', v), ',' ORDER BY cell) AS cells FROM l GROUP BY model, temp""",
)
def _(t):
    out = B.success_maps(records(t))
    cells = F.transform(F.map_entries("cells"), lambda e: F.concat(F.replace(e["key"], F.lit("\n"), F.lit("/")), F.lit("="), F.format_string("%.6f", e["value"])))
    return out.select("row", F.array_join(F.array_sort(cells), ",").alias("cells"))


REQ = """req AS (SELECT event_id, ts AS t_start, ts + to_milliseconds((props->>'$.k')::BIGINT % 10) AS t_first, ts + to_milliseconds((props->>'$.k')::BIGINT % 10 + floor(value * 100)::BIGINT) AS t_end, event_id % 500 AS prompt_n, user_id AS predicted_n,
 ['stop', 'length', 'eos'][event_id % 3 + 1] AS finish FROM events),
rates AS (SELECT *, epoch_ms(t_first) - epoch_ms(t_start) AS pp, epoch_ms(t_end) - epoch_ms(t_first) AS tg FROM req)"""


def requests(t):
    k = F.get_json_object("props", "$.k").cast("bigint") % 10
    ms = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n.cast("decimal(18,6)") / 1000).cast("decimal(18,6)"))
    end = k + F.floor(F.col("value") * 100)
    return t.events.select(
        "event_id", F.col("ts").alias("t_start"), (F.col("ts") + ms(k)).alias("t_first"), (F.col("ts") + ms(end)).alias("t_end"), (F.col("event_id") % 500).alias("prompt_n"), F.col("user_id").alias("predicted_n"),
        F.element_at(F.array(F.lit("stop"), F.lit("length"), F.lit("eos")), (F.col("event_id") % 3 + 1).cast("int")).alias("finish"),
    )


@query(
    "b12_load_summary",
    f"""WITH {REQ}, s AS (SELECT (pp + tg)::DOUBLE AS duration, CASE WHEN pp > 0 THEN prompt_n / pp * 1000 END AS prompt_rate, CASE WHEN predicted_n > 0 AND tg > 0 THEN predicted_n / tg * 1000 END AS gen_rate FROM rates)
SELECT """
    + ", ".join(f"round(quantile_cont({c}, 0.95), 2) AS {c}_p95, round(avg({c}), 2) AS {c}_avg" for c in ("duration", "prompt_rate", "gen_rate"))
    + " FROM s",
)
def _(t):
    rows = B.request_rates(requests(t)).withColumn("duration", (F.unix_millis(F.col("t_end").cast("timestamp")) - F.unix_millis(F.col("t_start").cast("timestamp"))).cast("double"))
    return B.load_summary(rows)


@query(
    "b13_request_rates",
    f"""WITH {REQ} SELECT event_id, pp / 1000 AS first_token_s, round(CASE WHEN pp > 0 THEN prompt_n / pp * 1000 END, 6) AS prompt_rate, round(CASE WHEN predicted_n > 0 AND tg > 0 THEN predicted_n / tg * 1000 END, 6) AS gen_rate, (finish = 'length')::INTEGER::DOUBLE AS truncated, (finish = 'stop')::INTEGER::DOUBLE AS stopped FROM rates""",
)
def _(t):
    out = B.request_rates(requests(t))
    return out.select("event_id", "first_token_s", F.round("prompt_rate", 6).alias("prompt_rate"), F.round("gen_rate", 6).alias("gen_rate"), "truncated", "stopped")


@query("b13_finish_rates", f"WITH {REQ} SELECT round(avg((finish = 'length')::INTEGER), 9) AS truncated_rate, round(avg((finish = 'stop')::INTEGER), 9) AS stop_rate FROM rates")
def _(t):
    out = B.finish_rates(B.request_rates(requests(t)))
    return out.withColumns({c: F.round(c, 9) for c in out.columns})


@query(
    "b14_request_timings",
    """SELECT event_id, round(value / nullif(event_id % 500, 0), 10) AS prompt_per_token_ms, round(1000 * (event_id % 500) / nullif(value, 0), 6) AS prompt_per_second, CASE WHEN user_id % 3 > 0 THEN user_id % 3 END AS draft_n, CASE WHEN user_id % 3 > 0 THEN 1::BIGINT END AS draft_n_accepted FROM events""",
)
def _(t):
    rows = t.events.select(
        "event_id", (F.col("event_id") % 500).alias("prompt_n"), F.col("value").alias("prompt_ms"), F.col("user_id").alias("predicted_n"), F.col("value").alias("predicted_ms"), (F.col("user_id") % 3).alias("draft_n"), F.lit(1).cast("bigint").alias("draft_n_accepted")
    )
    out = B.request_timings(rows)
    return out.select("event_id", F.round("prompt_per_token_ms", 10).alias("prompt_per_token_ms"), F.round("prompt_per_second", 6).alias("prompt_per_second"), "draft_n", "draft_n_accepted")


def steps(t):
    return t.events.select(
        "ts", "event_type", (F.col("event_id") % 500).alias("prompt_n"), F.col("value").alias("prompt_ms"), F.col("user_id").alias("predicted_n"), (F.col("value") * 2).alias("predicted_ms"), (F.col("user_id") % 8).alias("busy_slots"), F.lit(1).cast("bigint").alias("steps")
    )


SERVICE = """s AS (SELECT event_type, sum(event_id % 500)::BIGINT AS pn, sum(value) AS pm, sum(user_id)::BIGINT AS gn, sum(value * 2) AS gm, sum(user_id % 8)::BIGINT AS busy, count(*) AS steps FROM events GROUP BY 1)"""


@query(
    "b15_service_metrics",
    f"""WITH {SERVICE} SELECT event_type, pn AS prompt_tokens_total, round(pm / 1000, 6) AS prompt_seconds_total, gn AS tokens_predicted_total, round(gm / 1000, 6) AS tokens_predicted_seconds_total, steps AS n_decode_total, round(busy / steps, 9) AS n_busy_slots_per_decode,
 round(1000 * pn / pm, 6) AS prompt_tokens_seconds, round(1000 * gn / gm, 6) AS predicted_tokens_seconds FROM s""",
)
def _(t):
    out = B.service_metrics(steps(t), F.col("event_type"))
    places = {"prompt_seconds_total": 6, "tokens_predicted_seconds_total": 6, "n_busy_slots_per_decode": 9, "prompt_tokens_seconds": 6, "predicted_tokens_seconds": 6}
    return out.withColumns({c: F.round(c, p) for c, p in places.items()})


@query(
    "s21_exposition",
    f"""WITH {SERVICE} SELECT event_type, '# HELP model:prompt_tokens_total Number of prompt tokens processed.' || chr(10) || '# TYPE model:prompt_tokens_total counter' || chr(10) || 'model:prompt_tokens_total ' || pn || chr(10) ||
 '# HELP model:n_decode_total Total number of decode calls' || chr(10) || '# TYPE model:n_decode_total counter' || chr(10) || 'model:n_decode_total ' || steps || chr(10) AS text FROM s""",
)
def _(t):
    out = B.service_metrics(steps(t), F.col("event_type")).select("event_type", "prompt_tokens_total", "n_decode_total")
    return B.to_exposition(out, "event_type")


@query("b16_metric_series", "SELECT event_type, strftime(time_bucket(INTERVAL '2 seconds', ts), '%Y-%m-%d %H:%M:%S') AS start, round(avg(value), 6) AS value FROM events GROUP BY 1, time_bucket(INTERVAL '2 seconds', ts)")
def _(t):
    out = B.metric_series(t.events, "2 seconds", keys=("event_type",))
    return out.select("event_type", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), F.round("value", 6).alias("value"))


@query(
    "b17_param_grid",
    """WITH c AS (SELECT c_custkey, unnest([256, 256 + c_custkey % 3]) AS n_batch, unnest([0, 1]) AS j FROM customer), g AS (SELECT c_custkey, n_batch, unnest([4, 8]) AS n_threads FROM c),
t AS (SELECT c_custkey, n_batch, n_threads, unnest(['prompt', 'gen', 'both']) AS kind, unnest([512, 0, 64]) AS n_prompt, unnest([0, c_custkey % 2 * 128, 32]) AS n_gen FROM g)
SELECT c_custkey, n_batch::BIGINT AS n_batch, n_threads::INTEGER AS n_threads, kind, n_prompt::BIGINT AS n_prompt, n_gen::BIGINT AS n_gen FROM t WHERE NOT (kind = 'gen' AND n_gen = 0)""",
)
def _(t):
    k = F.col("c_custkey")
    rows = t.customer.select(
        k, F.array(F.lit(256).cast("bigint"), 256 + k % 3).alias("n_batch"), F.array(F.lit(4), F.lit(8)).alias("n_threads"), F.array(F.lit(512), F.lit(0)).alias("n_prompt"), F.array(k % 2 * 128).alias("n_gen"), F.array(F.struct(F.lit(64).alias("p"), F.lit(32).alias("g"))).alias("n_pg")
    )
    return B.param_grid(rows, "c_custkey", ["n_batch", "n_threads"])


@query(
    "b17_batched_grid",
    """WITH g AS (SELECT c_custkey, pp, tg, pl FROM customer, unnest([128, 256]) AS a(pp), unnest([32, 64]) AS b(tg), unnest([1, 8, 32]) AS c(pl)) SELECT c_custkey, pp::INTEGER AS pp, tg::INTEGER AS tg, pl::INTEGER AS pl, (pl * (pp + tg))::INTEGER AS n_kv FROM g WHERE pl * (pp + tg) <= 1024 + c_custkey""",
)
def _(t):
    lits = lambda *xs: F.array(*[F.lit(x) for x in xs])
    rows = t.customer.select("c_custkey", (F.col("c_custkey") + 1024).alias("n_kv_max"), lits(128, 256).alias("pp"), lits(32, 64).alias("tg"), lits(1, 8, 32).alias("pl"))
    return B.batched_grid(rows, "c_custkey", shared=False)
