"""Prefix sums, greedy batches, quantiles and bounds against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspark.functions import quantiles
from loomspark.operators import windows as W
from loomspark.plans import bounds, prefix


def test_running_sums_match_a_loop(spark):
    rng = random.Random(3)
    rows = [(k, p, rng.randint(0, 9)) for k in "ab" for p in rng.sample(range(500), 120)]
    df = spark.createDataFrame(rows, "k string, p long, v long").repartition(5)
    for levels in (1, 2):
        for inclusive in (True, False):
            got = prefix.running_sums(df, ["k"], "p", {"s": F.col("v")}, inclusive=inclusive, width=7, levels=levels)
            want = {}
            for k in "ab":
                total = 0
                for _, p, v in sorted(r for r in rows if r[0] == k):
                    want[(k, p)] = total + (v if inclusive else 0)
                    total += v
            assert {(r.k, r.p): r.s for r in got.collect()} == want


def greedy(sizes, budget):
    out, total, batch = [], 0, 0
    for s in sizes:
        if total + s > budget:
            batch, total = batch + 1, 0
        total += s
        out.append(batch)
    return out


@pytest.mark.parametrize("width,fan", [(1, 2), (3, 2), (8, 3), (64, 1024)])
def test_pack_greedy_is_exact(spark, width, fan):
    rng = random.Random(width)
    keys = {"hot": [rng.randint(0, 50) for _ in range(150)], "one": [50], "big": [50] * 9, "zero": [0] * 20}
    rows = [(k, i, s) for k, sizes in keys.items() for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "k string, i long, s long")
    got = W.pack_greedy(df, ["k"], "i", "s", 50, width=width, fan=fan).collect()
    for k, sizes in keys.items():
        assert [r.batch for r in sorted(got, key=lambda r: r.i) if r.k == k] == greedy(sizes, 50)


def test_pack_greedy_rejects_what_never_fits(spark):
    with pytest.raises(Exception, match="larger than the budget"):
        W.pack_greedy(spark.createDataFrame([(0, 51)], "i long, s long"), [], "i", "s", 50).collect()


def test_grouped_median(spark):
    rng = random.Random(8)
    rows = [(k, rng.choice([1.0, 2.5, rng.random()])) for k in ["hot"] * 5001 + ["b"] * 40 + [None] * 7 + ["one"]]
    got = quantiles.grouped_median(spark.createDataFrame(rows, "k string, x double").repartition(6), ["k"], "x").collect()
    want = {k: float(np.median([x for j, x in rows if j == k])) for k in {j for j, _ in rows}}
    assert {r.k: r.median for r in got} == pytest.approx(want)


def test_quantiles_are_exact_in_both_ways(spark, monkeypatch):
    rng = np.random.default_rng(5)
    xs = np.concatenate([rng.normal(size=700), np.full(400, 0.25), rng.exponential(size=300) * 1e6])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double").repartition(4)
    fs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0]
    want = np.quantile(xs, fs)
    assert np.allclose(quantiles.exact_quantiles(df, {"x": fs})["x"], want, rtol=1e-12)
    monkeypatch.setattr(quantiles, "DIRECT", 20)
    monkeypatch.setattr(quantiles, "BINS", 16)
    assert np.allclose(quantiles.exact_quantiles(df, {"x": fs})["x"], want, rtol=1e-12)


def test_bounds(spark):
    assert not bounds.fits(spark.range(11), 10)
    with pytest.raises(bounds.TooLarge):
        bounds.collect_bounded(spark.range(11), 10, "rows")


def test_chunks_do_not_depend_on_partitions(spark):
    docs = spark.createDataFrame([(i, list(range(i, i + 5 + i % 7))) for i in range(60)], "doc_id long, tokens array<int>")
    one = W.chunk_tokens(docs.repartition(1), 16).collect()
    many = W.chunk_tokens(docs.repartition(7), 16).collect()
    assert sorted(one) == sorted(many)


def test_common_prefix_and_run(spark):
    df = spark.createDataFrame([(list("abcxbcd"), list("bcd")), (list("ab"), list("ab")), ([], list("a"))], "a array<string>, b array<string>")
    got = W.longest_common_run(df, "a", "b", name="r").select(W.common_prefix("a", "b").alias("p"), "r").collect()
    assert [tuple(r) for r in got] == [(0, 3), (2, 2), (0, 0)]


def test_match_prefix_against_all_pairs(spark):
    rng = random.Random(11)
    seq = lambda: [rng.randint(0, 2) for _ in range(rng.randint(1, 9))]
    prompts, cached = {i: seq() for i in range(40)}, {i: seq() for i in range(30)}
    got = W.match_prefix(
        spark.createDataFrame(list(prompts.items()), "prompt_id long, tokens array<int>"),
        spark.createDataFrame([(i, 100 - i, s) for i, s in cached.items()], "cache_id long, last_used long, tokens array<int>"),
        0.4,
    ).collect()

    def shared(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    for r in got:
        options = [(-shared(prompts[r.prompt_id], s), i) for i, s in cached.items() if shared(prompts[r.prompt_id], s) / len(s) > 0.4]
        want = (min(options)[1], -min(options)[0]) if options else (29, 0)
        assert (r.cache_id, r.shared) == want


def test_prompts_list_only_prefixes_that_may_be_cached(spark, capsys):
    """Of two prompts of 1,000 tokens, one cached for 5 of them and one for none, the first lists 7 prefixes."""
    prompts = spark.createDataFrame([(1, list(range(1000))), (2, [7] * 1000)], "prompt_id long, tokens array<int>")
    cached = spark.createDataFrame([(10, 1, [0, 1, 2, 3, 4, 9, 9, 9])], "cache_id long, last_used long, tokens array<int>")
    near = W.reachable(prompts, cached)
    assert [(r.prompt_id, r.tokens) for r in near.collect()] == [(1, [0, 1, 2, 3, 4, 5, 6])]
    assert sorted(map(tuple, W.match_prefix(prompts, cached, 0.02).collect())) == [(1, 10, 5, False), (2, 10, 0, True)]


@pytest.mark.parametrize("odd", [[], [math.inf], [math.nan, -math.inf], [math.inf, math.inf, math.nan], [1e308, -1e308], [5e-324, 1e-323]])
@pytest.mark.parametrize("n", [40, 120_000])
def test_quantiles_with_odd_numbers(spark, odd, n):
    rows = spark.range(n).selectExpr("CAST((id * 7919) % 1009 AS DOUBLE) AS x")
    rows = rows.union(spark.createDataFrame([(v,) for v in odd], "x double"))
    values = sorted([float(k * 7919 % 1009) for k in range(n)] + [v for v in odd if not math.isnan(v)]) + [v for v in odd if math.isnan(v)]
    fractions = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = quantiles.exact_quantiles(rows, {"x": fractions})["x"]
    for f, g in zip(fractions, got):
        s = f * (len(values) - 1)
        a, b = values[int(s)], values[min(int(s) + 1, len(values) - 1)]
        want = a if s == int(s) or a == b else (1 - (s - int(s))) * a + (s - int(s)) * b
        assert g == pytest.approx(want, rel=1e-9, nan_ok=True), (f, g, want)


def test_quantiles_among_the_smallest_numbers(spark):
    tiny = spark.range(120_000).selectExpr("(id % 11) * 4.9E-324D AS x")
    assert quantiles.exact_quantiles(tiny, {"x": [0.5, 1.0]})["x"] == [5 * 5e-324, 10 * 5e-324]


def test_ranks_of_hashed_ids(spark):
    rows = spark.range(5000).selectExpr("xxhash64(id) AS id", "cast(xxhash64(id) AS string) AS name")
    for c in ("id", "name"):
        ids = sorted(r[0] for r in rows.select(c).collect())
        got = {r[c]: r.idx for r in prefix.dense_index(rows.select(c), c).collect()}
        assert [got[i] for i in ids] == list(range(5000))
