"""Benchmark comparison, load-test summaries and service metrics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.quantiles import exact_quantiles, grouped_median
from loomspark.plans.bounds import collect_bounded
from loomspark.plans.scratch import written

# Columns and types of a benchmark row: fixed values.
FIELDS = [
    ("build_commit", "string"), ("build_number", "bigint"), ("cpu_info", "string"), ("gpu_info", "string"), ("backends", "string"),
    ("model_filename", "string"), ("model_type", "string"), ("model_size", "bigint"), ("model_n_params", "bigint"), ("n_batch", "bigint"),
    ("n_ubatch", "bigint"), ("n_threads", "bigint"), ("cpu_mask", "string"), ("cpu_strict", "bigint"), ("poll", "bigint"),
    ("type_k", "string"), ("type_v", "string"), ("n_gpu_layers", "bigint"), ("split_mode", "string"), ("main_gpu", "bigint"),
    ("no_kv_offload", "bigint"), ("flash_attn", "bigint"), ("tensor_split", "string"), ("tensor_buft_overrides", "string"),
    ("defrag_thold", "double"), ("use_mmap", "bigint"), ("embeddings", "bigint"), ("no_op_offload", "bigint"), ("n_prompt", "bigint"),
    ("n_gen", "bigint"), ("n_depth", "bigint"), ("test_time", "string"), ("avg_ns", "bigint"), ("stddev_ns", "bigint"),
    ("avg_ts", "double"), ("stddev_ts", "double"),
]
# Columns that must agree for two rows to be compared: fixed values.
KEYS = [
    "cpu_info", "gpu_info", "backends", "n_gpu_layers", "tensor_buft_overrides", "model_filename", "model_type", "n_batch", "n_ubatch",
    "embeddings", "cpu_mask", "cpu_strict", "poll", "n_threads", "type_k", "type_v", "use_mmap", "no_kv_offload", "split_mode",
    "main_gpu", "tensor_split", "flash_attn", "n_prompt", "n_gen", "n_depth",
]
TEST_KEYS = ("n_prompt", "n_gen", "n_depth")
BOOLS = ("embeddings", "cpu_strict", "use_mmap", "no_kv_offload", "flash_attn")
GPU_PREFIXES = ("NVIDIA GeForce ", "Tesla ", "AMD Radeon ")
SUFFIXES = {" - Small": "_S", " - Medium": "_M", " - Large": "_L"}


def bench_stats(df: DataFrame, *, samples: str = "samples_ns") -> DataFrame:
    """Add mean and sample deviation of tokens per second over ``samples_ns array<long>``; one sample deviates by 0."""
    ts = F.transform(samples, lambda ns: F.lit(1e9) * (F.col("n_prompt") + F.col("n_gen")) / ns)
    mean = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / F.size(a)
    rows = df.withColumn("__ts", ts).withColumn("avg_ts", mean("__ts"))
    n = F.size("__ts")
    sq = F.aggregate("__ts", F.lit(0.0), lambda s, x: s + (x - F.col("avg_ts")) * (x - F.col("avg_ts")))
    dev = F.when(n <= 1, 0.0).otherwise(F.sqrt(F.try_divide(sq, n - 1)))
    return rows.withColumn("stddev_ts", dev).drop("__ts")


def harmonise_builds(df: DataFrame) -> DataFrame:
    """Cut commit ids to the shortest length in the data; ``mixed`` marks data with several lengths."""
    lengths = df.agg(F.min(F.length("build_commit")).alias("lo"), F.max(F.length("build_commit")).alias("hi")).first()
    return df.withColumn("build_commit", F.substring("build_commit", 1, lengths.lo)).withColumn("mixed", F.lit(lengths.lo != lengths.hi))


def builds(df: DataFrame) -> DataFrame:
    return df.select("build_commit").distinct()


def _pairs(df: DataFrame, baseline: str, compare: str) -> DataFrame:
    """One row per key with the sums of both sides.

    Each side is summed per key before they meet, so rows that share a key never form pairs; the sums are weighted
    with the other side's count, as an average over all pairs would be.
    """
    side = lambda commit, p: (
        df.filter(F.col("build_commit") == commit).groupBy(*KEYS).agg(F.sum("avg_ts").alias(f"{p}_sum"), F.count("avg_ts").alias(f"{p}_n"), F.count("*").alias(f"{p}_rows"))
    )
    both = side(baseline, "b").join(side(compare, "c"), KEYS)  # an equality join: keys with nulls drop out
    return both.select(
        *KEYS,
        (F.col("b_sum") * F.col("c_rows")).alias("b_sum"), (F.col("b_n") * F.col("c_rows")).alias("b_n"),
        (F.col("c_sum") * F.col("b_rows")).alias("c_sum"), (F.col("c_n") * F.col("b_rows")).alias("c_n"),
    )


def compare_builds(df: DataFrame, baseline: str, compare: str, show: Sequence[str]) -> DataFrame:
    """Mean speeds of two builds over comparable rows, by the shown columns and test; ordered by them."""
    group = [*show, "n_gen", "n_prompt", "n_depth"]
    out = _pairs(df, baseline, compare).groupBy(*dict.fromkeys(group)).agg(
        (F.sum("b_sum") / F.sum("b_n")).alias("avg_ts_base"), (F.sum("c_sum") / F.sum("c_n")).alias("avg_ts_compare")
    )
    return out.orderBy(*dict.fromkeys(group))


def varying_columns(df: DataFrame, baseline: str, compare: str) -> list[str]:
    """Columns worth showing: those that vary, with the model type always in and the file name always out."""
    rows = _pairs(df, baseline, compare)
    names = [k for k in KEYS if k not in ("model_type", *TEST_KEYS)]
    s = rows.agg(*[(F.min(k) != F.max(k)).alias(k) for k in names], F.first("n_gpu_layers").alias("__ngl")).first()
    varies = [k for k in names if s[k]]
    show = []
    if s["__ngl"] is not None and "n_gpu_layers" not in varies and s["__ngl"] != 99 and "cpu_info" not in varies:
        show.append("cpu_info")
    show += varies
    at = sum(p in show for p in ("cpu_info", "gpu_info", "n_gpu_layers", "main_gpu"))
    return [c for c in [*show[:at], "model_type", *show[at:]] if c != "model_filename"]


def test_label() -> Column:
    """``pp512``, ``tg128``, ``pp512+tg128``, each with ``@d`` and a depth when there is one."""
    p, g, d = (F.col(c) for c in TEST_KEYS)
    s = lambda c: c.cast("string")
    name = (
        F.when((p != 0) & (g == 0), F.concat(F.lit("pp"), s(p)))
        .when((p == 0) & (g != 0), F.concat(F.lit("tg"), s(g)))
        .otherwise(F.concat(F.lit("pp"), s(p), F.lit("+tg"), s(g)))
    )
    return F.concat(name, F.when(d != 0, F.concat(F.lit("@d"), s(d))).otherwise(""))


def with_speedup(df: DataFrame) -> DataFrame:
    return df.withColumn("test", test_label()).withColumn("speedup", F.try_divide("avg_ts_compare", "avg_ts_base"))


def prettify(df: DataFrame) -> DataFrame:
    """Readable values in whichever of the known columns are there."""
    out = df
    for c in BOOLS:
        if c in df.columns:
            out = out.withColumn(c, F.when(F.col(c) == 1, "Yes").otherwise("No"))
    if "model_type" in df.columns:
        out = out.withColumn("model_type", reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), SUFFIXES.items(), F.col("model_type")))
    if "model_size" in df.columns:
        out = out.withColumn("model_size", F.col("model_size") / float(1 << 30))
    if "gpu_info" in df.columns:
        bare = reduce(lambda c, p: F.replace(c, F.lit(p), F.lit("")), GPU_PREFIXES, F.col("gpu_info"))
        names = F.split(bare, ", ", -1)
        many = (F.size(names) >= 2) & (F.size(F.array_distinct(names)) == 1)
        out = out.withColumn("gpu_info", F.when(many, F.concat(F.size(names).cast("string"), F.lit("x "), F.get(names, F.lit(0)))).otherwise(bare))
    return out


def _chains(edges: DataFrame, start) -> DataFrame:
    """``(node, head, off)``: the nearest commit below each one that is the start or has not exactly one child, and how far it is.

    A commit with one child is one step behind it, so pointers go from child to child; each round points twice as far, and
    the rounds follow the logarithm of the longest chain.
    """
    nodes = edges.select(F.col("commit").alias("node")).unionByName(edges.select(F.col("parent").alias("node"))).distinct()
    children = edges.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n"), F.min("commit").alias("child"))
    lone = (F.col("n") == 1) & (F.col("node") != F.lit(start))
    links = nodes.join(children, "node", "left").select("node", F.when(lone, F.col("child")).otherwise(F.col("node")).alias("head"), F.when(lone, 1).otherwise(0).alias("off"))
    links = written(links.withColumn("open", F.col("off") > 0), "chains")
    while True:
        going = links.filter("open")
        if going.isEmpty():
            return links.drop("open")
        there = links.select(F.col("node").alias("head"), F.col("head").alias("next"), F.col("off").alias("more"))
        moved = going.join(there, "head").select("node", F.col("next").alias("head"), (F.col("off") + F.col("more")).alias("off"), (F.col("more") > 0).alias("open"))
        links = written(moved.unionByName(links.filter("NOT open")), "chains")


def ancestors(edges: DataFrame, start) -> DataFrame:
    """``(commit, depth)`` of all ancestors of ``start`` in ``edges(commit, parent)``, at their smallest depth.

    Chains of commits with one child each are contracted first.  Depths then go from branch point to branch point, each round
    by one join with the branch points whose depth changed last, and every commit adds its place in its chain.
    """
    edges = edges.select("commit", "parent").filter("commit IS NOT NULL AND parent IS NOT NULL").distinct()
    chains = _chains(edges, start)
    # Steps between branch points: from the head of a child to the commit itself.
    ends = chains.filter("off = 0").select(F.col("node").alias("parent"))
    below = edges.join(ends, "parent", "left_semi").filter(F.col("parent") != F.lit(start))
    steps = below.join(chains.withColumnRenamed("node", "commit"), "commit").groupBy("head", F.col("parent").alias("to")).agg((F.min("off") + 1).alias("w"))
    steps = written(steps, "steps")
    known = written(chains.filter(F.col("node") == F.lit(start)).select(F.col("node").alias("head"), F.lit(0).alias("depth"), F.lit(True).alias("fresh")), "depths")
    while True:
        fresh = known.filter("fresh")
        if fresh.isEmpty():
            break
        reached = fresh.join(steps, "head").groupBy(F.col("to").alias("head")).agg(F.min(F.col("depth") + F.col("w")).alias("new"))
        both = known.join(reached, "head", "full_outer")
        better = F.col("new").isNotNull() & (F.col("depth").isNull() | (F.col("new") < F.col("depth")))
        known = written(both.select("head", F.least("depth", "new").alias("depth"), better.alias("fresh")), "depths")
    out = chains.join(known, "head").select(F.col("node").alias("commit"), (F.col("depth") + F.col("off")).cast("int").alias("depth"))
    return out.filter("depth > 0")


def pick_builds(rows: DataFrame, mainline: DataFrame) -> tuple[str | None, str | None]:
    """(baseline, compare): the nearest main-line commit with data, and the newest build off the main line.

    ``mainline(commit, depth)`` as :func:`ancestors` gives it.
    """
    on = rows.join(mainline, rows.build_commit == mainline.commit)
    base = on.agg(F.min_by("build_commit", F.struct("depth", "build_commit"))).first()[0]
    off = rows.join(mainline, rows.build_commit == mainline.commit, "left_anti")
    return base, off.agg(F.max_by("build_commit", F.struct("test_time", "build_commit"))).first()[0]


def bench_series(df: DataFrame, x: str, others: Sequence[str]) -> DataFrame:
    """Plot points ``(others, test, x, avg_ts)``: one per value of ``x`` in each series."""
    labelled = df.withColumn("test", test_label())
    return labelled.groupBy(*others, "test", x).agg(F.avg("avg_ts").alias("avg_ts"))


def batch_speeds(df: DataFrame) -> DataFrame:
    """Add prompt, generation and total speed of batched rows ``(pp, tg, pl, n_kv, t_pp, t_tg, is_pp_shared)``."""
    pp = F.when(F.col("is_pp_shared"), F.col("pp")).otherwise(F.col("pl") * F.col("pp"))
    return (
        df.withColumn("speed_pp", F.try_divide(pp.cast("double"), F.col("t_pp")))
        .withColumn("speed_tg", F.try_divide((F.col("pl") * F.col("tg")).cast("double"), F.col("t_tg")))
        .withColumn("speed", F.try_divide(F.col("n_kv").cast("double"), F.col("t_pp") + F.col("t_tg")))
    )


# ------------------------------------------------------------------ tool tests


def tool_bench_summary(tries: DataFrame) -> DataFrame:
    """Per model, server, test and temperature: ratio, times, counts and distinct failure texts.

    Failure texts are made distinct before they are gathered.
    """
    key = ["model", "server_name", "test", "temp"]
    ok = F.col("ok").cast("long")
    stats = tries.groupBy(*key).agg(
        F.avg(ok.cast("double")).alias("success_ratio"), F.avg("secs").alias("avg_time"),
        F.sum(ok).alias("success_count"), F.sum(1 - ok).alias("failure_count"),
    )
    texts = tries.filter(~F.col("ok")).select(*key, "error").distinct().groupBy(*key).agg(F.array_sort(F.collect_list("error")).alias("failures"))
    medians = grouped_median(tries, key, "secs")
    # one text per key, since a temperature may be null
    keyed = F.to_json(F.struct(*key)).alias("__k")
    joined = stats.select("*", keyed).join(medians.select(keyed, F.col("median").alias("median_time")), "__k", "left")
    joined = joined.join(texts.select(keyed, "failures"), "__k", "left").drop("__k")
    return joined.withColumn("failures", F.coalesce("failures", F.array().cast("array<string>")))


def _last_cells(df: DataFrame, test_regex: str | None, server_regex: str | None) -> DataFrame:
    """``(model, temp, cell, v)``: the last record of each server and test."""
    rows = df
    if test_regex:
        rows = rows.filter(F.col("test").rlike(test_regex))
    if server_regex:
        rows = rows.filter(F.col("server_name").rlike(server_regex))
    cell = F.concat_ws("\n", "server_name", "test")
    return rows.groupBy("model", "temp", cell.alias("cell")).agg(F.max_by("success_ratio", "line_no").alias("v"))


def _row_label() -> Column:
    return F.concat("model", F.lit(" @ "), F.coalesce(F.col("temp").cast("string"), F.lit("None"))).alias("row")


def success_maps(df: DataFrame, *, test_regex: str | None = None, server_regex: str | None = None) -> DataFrame:
    """``(row, cells)``: the success matrix with a map from server and test to the ratio in each row, for any number of them.

    ``df(model, temp, server_name, test, success_ratio, line_no)``.
    """
    last = _last_cells(df, test_regex, server_regex)
    cells = F.map_from_entries(F.sort_array(F.collect_list(F.struct("cell", "v"))))
    return last.groupBy("model", "temp").agg(cells.alias("cells")).select(_row_label(), "cells")


def success_matrix(df: DataFrame, *, test_regex: str | None = None, server_regex: str | None = None, max_cells: int = 10_000) -> DataFrame:
    """Rows ``model @ temp`` (null temperature first), one column per server and test; the last record of a cell wins.

    ``df(model, temp, server_name, test, success_ratio, line_no)``.  A table has so many columns at most; beyond them
    :func:`success_maps` has the same cells.
    """
    last = _last_cells(df, test_regex, server_regex)
    cells = sorted(r.cell for r in collect_bounded(last.select("cell").distinct(), max_cells, "server and test combinations"))
    wide = last.groupBy("model", "temp").pivot("cell", cells).agg(F.first("v"))
    nan = F.lit(float("nan"))
    return wide.orderBy("model", F.col("temp").asc_nulls_first()).select(_row_label(), *[F.coalesce(F.col(f"`{c}`"), nan).alias(c) for c in cells])


def totals_agree(df: DataFrame) -> DataFrame:
    """One row: whether all records counted the same number of tries."""
    n = F.col("success_count") + F.col("failure_count")
    return df.agg((F.min(n) == F.max(n)).alias("consistent"))


# ------------------------------------------------------------------ load tests and service


def request_rates(df: DataFrame) -> DataFrame:
    """Rates of requests ``(t_start, t_first, t_end, prompt_n, predicted_n, finish)``; a rate needs a span above 0."""
    at = lambda c: F.unix_millis(c.cast("timestamp"))
    ms = lambda a, b: at(b) - at(a)
    pp, tg = ms(F.col("t_start"), F.col("t_first")), ms(F.col("t_first"), F.col("t_end"))
    return (
        df.withColumn("first_token_s", pp / 1000.0)
        .withColumn("prompt_rate", F.when(pp > 0, F.col("prompt_n") / pp * 1000.0))
        .withColumn("gen_rate", F.when((F.col("predicted_n") > 0) & (tg > 0), F.col("predicted_n") / tg * 1000.0))
        .withColumn("truncated", (F.col("finish") == "length").cast("double"))
        .withColumn("stopped", (F.col("finish") == "stop").cast("double"))
    )


def finish_rates(rates: DataFrame) -> DataFrame:
    return rates.agg(F.avg("truncated").alias("truncated_rate"), F.avg("stopped").alias("stop_rate"))


def load_summary(df: DataFrame) -> DataFrame:
    """95th percentile and mean of duration and rates, two places: columns duration, prompt_rate, gen_rate."""
    names = ("duration", "prompt_rate", "gen_rate")
    p95 = exact_quantiles(df, {c: [0.95] for c in names})
    means = df.agg(*[F.round(F.avg(c), 2).alias(f"{c}_avg") for c in names])
    return means.select(*[x for c in names for x in (F.round(F.lit(p95[c][0]), 2).alias(f"{c}_p95"), f"{c}_avg")])


def request_timings(df: DataFrame) -> DataFrame:
    """Per-token and per-second figures of ``(prompt_n, prompt_ms, predicted_n, predicted_ms, draft_n, draft_n_accepted)``."""
    div = F.try_divide
    out = df
    for p in ("prompt", "predicted"):
        n, ms = F.col(f"{p}_n"), F.col(f"{p}_ms")
        out = out.withColumn(f"{p}_per_token_ms", div(ms, n)).withColumn(f"{p}_per_second", div(1e3 * n, ms))
    drafted = F.col("draft_n") > 0
    return out.withColumn("draft_n_accepted", F.when(drafted, F.col("draft_n_accepted"))).withColumn("draft_n", F.when(drafted, F.col("draft_n")))


def service_metrics(df: DataFrame, *keys: Column) -> DataFrame:
    """Counters and gauges of steps ``(prompt_n, prompt_ms, predicted_n, predicted_ms, busy_slots, steps)``."""
    s = df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("prompt_n", "prompt_ms", "predicted_n", "predicted_ms", "busy_slots", "steps")])
    rate = lambda n, ms: F.when(F.col(n) > 0, F.try_divide(1e3 * F.col(n), F.col(ms))).otherwise(0.0)
    keep = [c for c in s.columns if c not in ("prompt_n", "prompt_ms", "predicted_n", "predicted_ms", "busy_slots", "steps")]
    return s.select(
        *keep,
        F.col("prompt_n").alias("prompt_tokens_total"), (F.col("prompt_ms") / 1e3).alias("prompt_seconds_total"),
        F.col("predicted_n").alias("tokens_predicted_total"), (F.col("predicted_ms") / 1e3).alias("tokens_predicted_seconds_total"),
        F.col("steps").alias("n_decode_total"), (F.col("busy_slots") / F.greatest("steps", F.lit(1))).alias("n_busy_slots_per_decode"),
        rate("prompt_n", "prompt_ms").alias("prompt_tokens_seconds"), rate("predicted_n", "predicted_ms").alias("predicted_tokens_seconds"),
    )


# Help texts of the exposition format: fixed values.
METRICS = [
    ("counter", "prompt_tokens_total", "Number of prompt tokens processed."),
    ("counter", "prompt_seconds_total", "Prompt process time"),
    ("counter", "tokens_predicted_total", "Number of generation tokens processed."),
    ("counter", "tokens_predicted_seconds_total", "Predict process time"),
    ("counter", "n_decode_total", "Total number of decode calls"),
    ("counter", "n_busy_slots_per_decode", "Average number of busy slots per decode call"),
    ("gauge", "prompt_tokens_seconds", "Average prompt throughput in tokens/s."),
    ("gauge", "predicted_tokens_seconds", "Average generation throughput in tokens/s."),
]


def to_exposition(df: DataFrame, *keys: str, prefix: str = "model") -> DataFrame:
    """``(keys, text)``: metrics in exposition text."""
    lines = []
    for kind, name, help_ in METRICS:
        if name in df.columns:
            full = f"{prefix}:{name}"
            lines.append(F.concat(F.lit(f"# HELP {full} {help_}\n# TYPE {full} {kind}\n{full} "), F.col(name).cast("string"), F.lit("\n")))
    return df.select(*keys, F.concat(*lines).alias("text"))


def metric_series(df: DataFrame, step: str = "2 seconds", *, ts: str = "ts", value: str = "value", keys: Sequence[str] = ()) -> DataFrame:
    """Mean per step of a metric, as ``(keys, start, value)``."""
    out = df.groupBy(*keys, F.window(ts, step).alias("w")).agg(F.avg(value).alias("value"))
    return out.select(*keys, F.col("w.start").alias("start"), "value")


def series_mean(series: DataFrame, *keys: str) -> DataFrame:
    return series.groupBy(*keys).agg(F.avg("value").alias("mean"), F.count("*").alias("n"))


def param_grid(df: DataFrame, key: str, lists: Sequence[str]) -> DataFrame:
    """Test rows of each parameter set: all combinations of the listed array columns, with its tests.

    ``n_prompt``, ``n_gen`` are arrays of sizes and ``n_pg`` an array of pairs; zeros give no prompt-only or generation-only row.
    """
    rows = df
    for c in lists:
        rows = rows.withColumn(c, F.explode(c))
    zero = F.lit(0).cast("bigint")
    test = lambda kind, p, g: F.struct(F.lit(kind).alias("kind"), p.cast("bigint").alias("p"), g.cast("bigint").alias("g"))
    tests = F.concat(
        F.transform(F.filter("n_prompt", lambda x: x > 0), lambda x: test("prompt", x, zero)),
        F.transform(F.filter("n_gen", lambda x: x > 0), lambda x: test("gen", zero, x)),
        F.transform("n_pg", lambda x: test("both", x["p"], x["g"])),
    )
    return rows.withColumn("t", F.explode(tests)).select(key, *lists, "t.kind", F.col("t.p").alias("n_prompt"), F.col("t.g").alias("n_gen"))


def batched_grid(df: DataFrame, key: str, *, shared: bool, limit: str = "n_kv_max") -> DataFrame:
    """Combinations of arrays ``pp``, ``tg``, ``pl`` whose need fits the limit."""
    rows = df
    for c in ("pp", "tg", "pl"):
        rows = rows.withColumn(c, F.explode(c))
    pp, tg, pl = F.col("pp"), F.col("tg"), F.col("pl")
    need = pp + pl * tg if shared else pl * (pp + tg)
    return rows.withColumn("n_kv", need).filter(F.col("n_kv") <= F.col(limit)).select(key, "pp", "tg", "pl", "n_kv")
