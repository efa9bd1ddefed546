"""Ranks and sweeps over ranges: NULL groups, missing and continuous scores, many partitions; one-dimensional k-means."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators import evaluate as ev
from leadlens.operators.leads import batch_score, batch_summary, kmeans_cuts, kmeans_tiers, tier_rules
from leadlens.operators.split import class_rank
from leadlens.session import clear_scratch, materialize


def brute_auc(y, p) -> float:
    pos, neg = p[y == 1], p[y == 0]
    return ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def continuous():
    rng = np.random.default_rng(8)
    y = (rng.random(3000) < 0.3).astype(int)
    return y, np.clip(rng.normal(0.4 + 0.2 * y, 0.2), 0.0, 1.0)


def test_continuous_scores_over_many_partitions(spark, continuous):
    y, p = continuous
    df = spark.createDataFrame(pd.DataFrame({"y": y, "probability": p}))
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        row = ev.compute_metrics(df).first()
        curve = ev.roc_curve(df)
        assert curve.count() == len(set(p))
        assert curve.agg(F.max("tp"), F.max("fp")).first() == (y.sum(), (1 - y).sum())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert row.roc_auc == pytest.approx(brute_auc(y, p), abs=1e-12)
    steps = [(p >= t) for t in np.unique(p)[::-1]]
    recall, precision = (np.array([y[s].sum() / n for s in steps for n in [m(s)]]) for m in (lambda s: y.sum(), lambda s: s.sum()))
    assert row.pr_auc == pytest.approx((np.diff(recall, prepend=0) * precision).sum(), rel=1e-9)


def test_no_case_tree_and_no_checkpoint_in_the_plan(spark, continuous):
    y, p = continuous
    df = spark.createDataFrame(pd.DataFrame({"y": y, "probability": p}))
    plan = ev.roc_auc(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN") < 20 and "ExistingRDD" not in plan.replace("LogicalRDD", "")


@pytest.mark.parametrize("n_ranges", [1, 3, 16])
def test_null_group_is_a_group(spark, continuous, n_ranges):
    y, p = continuous
    model = np.where(np.arange(len(y)) % 3 == 0, None, np.where(np.arange(len(y)) % 3 == 1, "a", "b"))
    df = spark.createDataFrame([(m, int(a), float(b)) for m, a, b in zip(model, y, p)], "model string, y int, probability double")
    got = {r.model: r.roc_auc for r in ev.roc_auc(df, by="model", n_ranges=n_ranges).collect()}
    assert set(got) == {None, "a", "b"}
    for i, m in enumerate([None, "a", "b"]):
        assert got[m] == pytest.approx(brute_auc(y[i::3], p[i::3]), abs=1e-12)
    best = {r.model: (r.threshold, r.net_profit) for r in ev.find_optimal_threshold(df, by="model").collect()}
    assert set(best) == {None, "a", "b"}
    for i, m in enumerate([None, "a", "b"]):
        grid = np.linspace(0.05, 0.95, 200)
        yy, pp = y[i::3], p[i::3]
        profit = [((pp >= t) & (yy == 1)).sum() * 195.0 - ((pp >= t) & (yy == 0)).sum() * 5.0 - ((pp < t) & (yy == 1)).sum() * 200.0 for t in grid]
        assert best[m] == (grid[int(np.argmax(profit))], max(profit))


SWEEPS = [ev.find_optimal_threshold, ev.profit_curve, ev.recall_analysis, lambda d: ev.profit_curve(d, by="model"), lambda d: ev.model_comparison(d)]
LEADS = [lambda d: batch_score(d, 0.3), lambda d: batch_summary(d, 0.3), lambda d: tier_rules(d.withColumn("tier", F.lit("Hot")), 0.3)]


@pytest.mark.parametrize("bad", [None, float("nan")])
@pytest.mark.parametrize("job", range(len(SWEEPS + LEADS)))
def test_missing_scores_fail_every_job(spark, bad, job):
    df = spark.createDataFrame([("m", 0, 0.1), ("m", 1, 0.9), ("m", 1, bad), ("m", 0, bad)], "model string, y int, probability double")
    with pytest.raises(Exception, match="NULL or NaN"):
        (SWEEPS + LEADS)[job](df).collect()


def test_sweep_of_empty_and_single_rows(spark):
    none = spark.createDataFrame([], "model string, y int, probability double")
    assert ev.profit_curve(none, by="model").count() == 0
    one = spark.createDataFrame([(None, 1, 0.5)], none.schema)
    rows = ev.profit_curve(one, by="model", start=0.1, stop=0.9, n_steps=5).orderBy("threshold").collect()
    assert [(r.model, r.tp, r.fn) for r in rows] == [(None, 1, 0)] * 3 + [(None, 0, 1)] * 2


@pytest.mark.parametrize("prefix", [1, 2, 6])
def test_ranks_do_not_follow_the_buckets(spark, prefix):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else i % 2) for i in range(500)], "id long, y int")
    want = {(r.id, r.y, r.class_rank, r.class_n) for r in class_rank(df, "id").collect()}
    assert {(r.id, r.y, r.class_rank, r.class_n) for r in class_rank(df, "id", prefix=prefix).collect()} == want
    for y in (None, 0, 1):
        ranks = sorted(r[2] for r in want if r[1] == y)
        assert ranks == list(range(1, len(ranks) + 1))


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_kmeans_is_the_best_of_all_cuts(spark, k):
    rng = np.random.default_rng(k)
    p = np.round(np.clip(rng.choice([0.1, 0.3, 0.35, 0.8], 80) + rng.normal(0, 0.05, 80), 0, 1), 2)
    df = spark.createDataFrame(pd.DataFrame({"probability": p}))
    groups = kmeans_cuts(df, k=k, digits=2)
    values = np.unique(p)
    spread = lambda parts: sum(((x - x.mean()) ** 2).sum() for x in parts)
    options = [spread([p[(p >= lo) & (p < hi)] for lo, hi in zip([-1, *cut], [*cut, 2])]) for cut in combinations(values[1:], k - 1)]
    mine = [p[(p >= g["lo"] - 1e-9) & (p <= g["hi"] + 1e-9)] for g in groups]
    assert spread(mine) == pytest.approx(min(options), rel=1e-9)
    assert [g["n"] for g in groups] == [len(m) for m in mine]
    assert np.allclose([g["centre"] for g in groups], [m.mean() for m in mine])
    tiers = {r.probability: r.tier for r in kmeans_tiers(df, k=k, digits=2).collect()}
    names = ["Cold", "Warm", "Hot"] if k == 3 else [f"tier_{i}" for i in range(k)]
    assert all(tiers[x] == n for m, n in zip(mine, names) for x in m)


def test_kmeans_of_few_and_bad_values(spark):
    two = spark.createDataFrame([(0.1,), (0.9,), (0.9,)], "probability double")
    assert [g["n"] for g in kmeans_cuts(two)] == [1, 2]
    assert kmeans_cuts(two.limit(0)) == []
    with pytest.raises(Exception, match="outside"):
        kmeans_cuts(spark.createDataFrame([(1.5,)], "probability double"))


def test_scratch_is_cleared(spark):
    import os

    df = materialize(spark.range(5))
    path = df.inputFiles()[0].replace("file://", "")
    assert df.count() == 5 and os.path.exists(path)
    assert clear_scratch(spark) > 0 and not os.path.exists(path)
