"""Decoding filters: probabilities in, survivors out, most likely first."""

import math
import re

import pytest

from loomspark.operators import dists as D

TEN = (0.1, 0.2, 0.3, 0.4)
CASES = [
    (TEN, lambda d: D.temperature(d, 1.0), (0.4, 0.3, 0.2, 0.1)),
    (TEN, lambda d: D.temperature(d, 0.0), (1.0, 0.0, 0.0, 0.0)),
    (TEN, lambda d: D.top_k(d, 1), (1.0,)),
    (TEN, lambda d: D.top_k(d, 3), (0.44444, 0.33333, 0.22222)),
    (TEN, lambda d: D.top_k(d, 4), (0.4, 0.3, 0.2, 0.1)),
    (TEN, lambda d: D.top_k(d, 0), (0.4, 0.3, 0.2, 0.1)),
    (TEN, lambda d: D.top_p(d, 0.0), (1.0,)),
    (TEN, lambda d: D.top_p(d, 0.7), (0.571429, 0.428571)),
    (TEN, lambda d: D.top_p(d, 0.8), (0.44444, 0.33333, 0.22222)),
    (TEN, lambda d: D.top_p(d, 1.0), (0.4, 0.3, 0.2, 0.1)),
    (TEN, lambda d: D.min_p(d, 0.24), (0.4, 0.3, 0.2, 0.1)),
    (TEN, lambda d: D.min_p(d, 0.26), (0.44444, 0.33333, 0.22222)),
    (TEN, lambda d: D.min_p(d, 0.49), (0.44444, 0.33333, 0.22222)),
    (TEN, lambda d: D.min_p(d, 0.51), (0.571429, 0.428571)),
    (TEN, lambda d: D.min_p(d, 0.76), (1.0,)),
    (TEN, lambda d: D.min_p(d, 1.05), (1.0,)),
    (TEN, lambda d: D.top_n_sigma(d, 1.0), (0.571429, 0.428571, 0.0, 0.0)),
    (TEN, lambda d: D.top_n_sigma(d, 0.0), (0.4, 0.3, 0.2, 0.1)),
    (TEN, lambda d: D.top_n_sigma(d, 3.0), (0.4, 0.3, 0.2, 0.1)),
]


def run(spark, probs, fn):
    rows = [(0, i, math.log(p)) for i, p in enumerate(probs)]
    out = fn(spark.createDataFrame(rows, "dist_id long, token_id int, logit double"))
    return [r.p for r in sorted(D.softmax(out.drop("p")).collect(), key=lambda r: (-r.logit, r.token_id))]


@pytest.mark.parametrize("i", range(len(CASES)))
def test_renormalised(spark, i):
    probs, fn, want = CASES[i]
    assert run(spark, probs, fn) == pytest.approx(want, abs=1e-4)


def kept(spark, probs, fn):
    rows = [(0, i, math.log(p)) for i, p in enumerate(probs)]
    out = fn(spark.createDataFrame(rows, "dist_id long, token_id int, logit double")).collect()
    return sorted(round(probs[r.token_id], 6) for r in out)


def test_typical_and_xtc_keep_their_candidates(spark):
    assert kept(spark, (0.97, 0.01, 0.01, 0.01), lambda d: D.typical(d, 0.5)) == [0.97]
    assert kept(spark, (0.4, 0.2, 0.2, 0.2), lambda d: D.typical(d, 0.5)) == [0.2, 0.2, 0.2]
    assert kept(spark, TEN, lambda d: D.xtc(d, 1.0, 0.09)) == [0.1]
    assert kept(spark, TEN, lambda d: D.xtc(d, 1.0, 0.19)) == [0.1, 0.2]
    assert kept(spark, TEN, lambda d: D.xtc(d, 1.0, 0.29)) == [0.1, 0.2, 0.3]
    assert kept(spark, TEN, lambda d: D.xtc(d, 1.0, 0.39)) == [0.1, 0.2, 0.3, 0.4]


def test_penalties_and_dry(spark):
    five = [(0, i, math.log(0.2)) for i in range(5)]
    df = spark.createDataFrame(five, "dist_id long, token_id int, logit double")
    hist = spark.createDataFrame([(0, [0])], "dist_id long, tokens array<int>")
    got = [r.p for r in sorted(D.softmax(D.penalties(df, hist, 1, 50.0)).collect(), key=lambda r: -r.p)]
    assert got == pytest.approx([0.25] * 4 + [0.0], abs=1e-4)
    four = spark.createDataFrame([(0, i, math.log(0.25)) for i in range(4)], "dist_id long, token_id int, logit double")
    hist = spark.createDataFrame([(0, [0, 1, 2, 0, 1])], "dist_id long, tokens array<int>")
    got = [r.p for r in sorted(D.softmax(D.dry(four, hist, 1.0, 1.1, 2, 5)).collect(), key=lambda r: -r.p)]
    assert got == pytest.approx([0.296923] * 3 + [0.109232], abs=1e-4)


def test_chain_takes_functions_and_draws_repeat(spark):
    df = spark.createDataFrame([(d, i, float((d * 7 + i * 3) % 5)) for d in range(50) for i in range(6)], "dist_id long, token_id int, logit double")
    out = D.chain(df, {"top_k": {"k": 4}}, ["top_k", lambda d: d.filter("token_id <> 0")])
    assert out.filter("token_id = 0").count() == 0
    assert sorted(D.draw(df, 3).collect()) == sorted(D.draw(df.repartition(5), 3).collect())


def _rows(spark, n):
    rows = [(d, i, float((d * 7 + i * 3) % 5)) for d in range(n) for i in range(6)]
    return spark.createDataFrame(rows, "dist_id long, token_id int, logit double")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _events(spark, path, rows):
    spark.createDataFrame(rows, "event_id long, user_id long, value double").write.parquet(f"{path}/events.parquet")
    return str(path)


def test_distributions_are_dealt_to_as_many_tasks_as_they_need(spark, tmp_path, monkeypatch):
    from loomspark.catalog import inputs
    from loomspark.catalog.base import Tables
    from loomspark.plans import bounds

    monkeypatch.setattr(inputs, "dealt", lambda df, *keys: bounds.dealt(df, *keys, rows=20))
    df = inputs.dists(Tables(spark, _events(spark, tmp_path, [(i, 0, 0.0) for i in range(1000)])))
    assert df.rdd.getNumPartitions() == 50 and df.count() == 16_000
    assert _plan(D.top_k(df, 3)).count("Exchange") == 1  # of the ids; candidates stay where they are


def test_histories_come_to_the_candidates(spark):
    """Penalties and DRY shuffle no candidate: a join goes by the distribution alone."""
    df = _rows(spark, 40).repartition(7, "dist_id")
    hist = spark.createDataFrame([(d, [0, 1, 2, 0, 1, d % 6]) for d in range(0, 40, 2)], "dist_id long, tokens array<int>")
    out = D.dry(D.penalties(df, hist, 4, 1.3, 0.2, 0.1), hist, 0.8, 1.75, 1)
    assert not re.search(r"hashpartitioning\(dist_id#\d+L?, token_id", _plan(out)) and out.count() == 240
    counts = {(r.dist_id, r.token_id): r.logit for r in D.penalties(df, hist, 4, 1.0, 1.0, 0.0).collect()}
    for r in df.collect():
        tail = [2, 0, 1, r.dist_id % 6] if r.dist_id % 2 == 0 else []
        assert counts[r.dist_id, r.token_id] == pytest.approx(r.logit - tail.count(r.token_id))


def test_a_bias_is_sent_to_the_candidates(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = D.logit_bias(_rows(spark, 20), spark.createDataFrame([(1, 0.5)], "token_id int, bias double"))
        assert "BroadcastHashJoin" in _plan(out) and "SortMergeJoin" not in _plan(out)
        assert out.count() == 120
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_draws_meet_without_a_broadcast(spark, tmp_path):
    from loomspark.catalog import QUERIES

    path = _events(spark, tmp_path, [(i, 0, 0.0) for i in range(500)])
    out = QUERIES["d14_draw_invariants"](spark, path)
    assert "BroadcastHashJoin" not in _plan(out)
    r = out.first()
    assert (r.n, r.n_possible, r.n_changed, r.by_weight) == (500, 500, 0, True)
    assert "BroadcastHashJoin" not in _plan(out)  # nor where the sides turn out small


def test_a_gate_that_holds_a_report_back_leaves_no_rows(spark, tmp_path):
    import duckdb

    from loomspark.catalog import ORACLES, QUERIES

    (tmp_path / "good").mkdir()
    (tmp_path / "bad").mkdir()
    for name, few in (("good", []), ("bad", [(0, 99, 0.0)])):
        # event 0 has logits from -5 on; chunk 99 is one position at the worst of them
        path = _events(spark, tmp_path / name / "t", [(i, i % 2, i % 16 / 100) for i in range(1, 400)] + few)
        with duckdb.connect() as c:
            c.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{path}/events.parquet/*.parquet')")
            want = c.sql(ORACLES["m15_gate"]).fetchall()
        got = QUERIES["m15_gate"](spark, path).collect()
        assert len(want) == (2 if name == "good" else 0) and sorted(tuple(r) for r in got) == sorted(want)
