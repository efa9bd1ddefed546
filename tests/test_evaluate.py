"""Evaluation: invariants of the reference's tests plus brute-force checks of
the distributed algorithms (grid bucketing, bucketed prefix sums)."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.operators import evaluate as ev
from tests.conftest import scored_frame


def brute_auc(y, p):
    y, p = np.asarray(y), np.asarray(p)
    pos, neg = p[y == 1], p[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def brute_ap(y, p):
    y, p = np.asarray(y), np.asarray(p)
    ap, prev_r, P = 0.0, 0.0, y.sum()
    for t in sorted(set(p), reverse=True):
        sel = p >= t
        tp = (y[sel] == 1).sum()
        r, prec = tp / P, tp / sel.sum()
        ap += (r - prev_r) * prec
        prev_r = r
    return ap


@pytest.fixture(scope="module")
def imbalanced():
    rng = np.random.default_rng(42)
    y = (rng.random(1000) < 0.11).astype(int)
    p = np.where(y == 1, rng.uniform(0.5, 1, 1000), rng.uniform(0, 0.5, 1000))
    return y, np.round(p, 3)


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(7)
    y = (rng.random(3000) < 0.3).astype(int)
    p = np.clip(np.round(rng.normal(0.3 + 0.25 * y, 0.2), 2), 0, 1)  # many ties
    return y, p


def test_metric_keys_and_ranges(spark, imbalanced):
    df = scored_frame(spark, *imbalanced)
    row = ev.compute_metrics(df, threshold=0.5).first().asDict()
    assert set(row) == {"accuracy", "precision", "recall", "f1", "mcc", "roc_auc", "pr_auc", "log_loss", "brier_score"}
    for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier_score"):
        assert 0.0 <= row[k] <= 1.0
    assert -1.0 <= row["mcc"] <= 1.0 and row["log_loss"] >= 0


def test_perfect_predictor(spark):
    y = [0] * 100 + [1] * 100
    row = ev.compute_metrics(scored_frame(spark, y, y), threshold=0.5).first()
    assert row.roc_auc == 1.0 and row.pr_auc == 1.0 and row.precision == 1.0 and row.recall == 1.0 and row.accuracy == 1.0


@pytest.mark.parametrize("n_ranges", [1, 7, 64])
def test_rank_metrics_match_brute_force(spark, noisy, n_ranges):
    y, p = noisy
    row = ev.compute_metrics(scored_frame(spark, y, p), threshold=0.5, n_ranges=n_ranges).first()
    assert row.roc_auc == pytest.approx(brute_auc(y, p), abs=1e-12)
    assert row.pr_auc == pytest.approx(brute_ap(y, p), abs=1e-12)


def test_grouped_metrics_equal_per_group(spark, noisy):
    y, p = noisy
    df = scored_frame(spark, y, p).withColumn("model", (F.col("id") % 3).cast("string"))
    got = {r.model: r.roc_auc for r in ev.roc_auc(df, by="model", n_ranges=5).collect()}
    for m in "012":
        idx = np.arange(len(y)) % 3 == int(m)
        assert got[m] == pytest.approx(brute_auc(y[idx], p[idx]), abs=1e-12)


def test_accounting_identity(spark, imbalanced):
    y, p = imbalanced
    r = ev.business_cost_analysis(scored_frame(spark, y, p), threshold=0.3).first()
    assert r.tp + r.fp + r.fn + r.tn == len(y) == r.total_clients
    assert r.net_profit == r.tp * 195 - r.fp * 5 - r.fn * 200
    assert r.calls_made == r.tp + r.fp


def test_threshold_sweep_matches_brute_force(spark, noisy):
    y, p = noisy
    grid = ev.linspace(0.05, 0.95, 200)
    p = np.concatenate([p, np.array(grid[::7])])  # scores exactly on grid values
    y = np.concatenate([y, np.ones(len(grid[::7]), dtype=int)])
    got = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in ev.threshold_sweep(scored_frame(spark, y, p), grid).collect()}
    assert len(got) == 200
    for t in grid:
        pred = p >= t
        want = (int((pred & (y == 1)).sum()), int((pred & (y == 0)).sum()), int((~pred & (y == 1)).sum()), int((~pred & (y == 0)).sum()))
        assert got[t] == want


def test_optimal_threshold_lowest_wins_ties_and_leans_low(spark, imbalanced):
    y, p = imbalanced
    best = ev.find_optimal_threshold(scored_frame(spark, y, p)).first()
    grid = ev.linspace(0.05, 0.95, 200)
    profits = [((p >= t) & (y == 1)).sum() * 195 - ((p >= t) & (y == 0)).sum() * 5 - ((p < t) & (y == 1)).sum() * 200 for t in grid]
    i = int(np.argmax(profits))  # first maximum = lowest threshold
    assert best.threshold == grid[i] and best.net_profit == profits[i]
    assert best.threshold <= 0.55  # 40:1 cost ratio favours recall


def test_recall_analysis_grid(spark, imbalanced):
    rows = ev.recall_analysis(scored_frame(spark, *imbalanced)).orderBy("threshold").collect()
    assert [r.threshold for r in rows] == [round(x, 2) for x in np.arange(0.05, 0.95, 0.05)]
    assert all(r.calls_made == r.subscribers_caught + r.false_alarms for r in rows)


def test_single_class_gives_zeros_not_errors(spark):
    r = ev.confusion(scored_frame(spark, [0, 0, 0], [0.1, 0.7, 0.9]), threshold=0.5).first()
    assert (r.tp, r.fn, r.fp, r.tn) == (0, 0, 2, 1)


def test_select_best_model_and_input_unchanged(spark):
    cmp = spark.createDataFrame(
        [("logistic_regression", 5000.0, 0.9, 0.8, 0.1), ("random_forest", 8000.0, 0.8, 0.82, 0.09),
         ("xgboost", 7500.0, 0.85, 0.81, 0.1), ("knn", 3500.0, 0.7, 0.75, 0.12)],
        "model string, net_profit double, test_recall double, test_roc_auc double, brier_score double",
    )
    before = cmp.collect()
    assert ev.select_best_model(cmp).first().model == "random_forest"
    assert cmp.collect() == before


def test_roc_curve_endpoints(spark, noisy):
    y, p = noisy
    rows = ev.roc_curve(scored_frame(spark, y, p), n_ranges=4).orderBy(F.desc("threshold")).collect()
    assert rows[-1].tpr == 1.0 and rows[-1].fpr == 1.0
    assert all(a.tpr <= b.tpr and a.fpr <= b.fpr for a, b in zip(rows, rows[1:]))
