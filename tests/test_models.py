"""Fitted models as tables, the fold store, isotonic calibration in blocks, the main flow."""

from __future__ import annotations

import json

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators import evaluate as ev
from leadlens.operators import flow as fl
from leadlens.operators import isotonic as iso
from leadlens.operators import train as tr
from leadlens.operators.folds import compare_on_folds, fold_scores, subset_sweep, tune_on_folds, write_folds
from leadlens.operators.model_table import encode, model_table, score_from_table, scoring_sql
from leadlens.operators.split import stratified_kfold, stratified_split, take_split

from .conftest import make_bank
from .test_ranges import brute_auc

CHEAP = {"logistic_regression": {}, "random_forest": {"n_estimators": 7, "max_depth": 5}, "gradient_boosting": {"n_estimators": 6, "max_depth": 3}}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(make_bank(300)).persist()


@pytest.mark.parametrize("name", sorted(CHEAP))
def test_table_scores_as_the_model_in_spark_and_in_sql(spark, rows, tmp_path, name):
    model = tr.fit(rows, name, CHEAP[name])
    model.write().save(f"{tmp_path}/model")
    table = model_table(spark, f"{tmp_path}/model")
    want = {r.client_id: r.probability for r in tr.score(model, rows, ["client_id"]).collect()}
    features = encode(model, rows, ["client_id"])
    assert {r.client_id: r.probability for r in score_from_table(features, table).collect()} == pytest.approx(want, abs=1e-12)
    con = duckdb.connect()
    con.register("t_", table.toPandas())
    con.register("x_", features.toPandas())
    con.execute("CREATE TABLE t AS SELECT * FROM t_")
    con.execute("CREATE TABLE x AS SELECT * FROM x_")
    found = con.execute(scoring_sql("t", "x", "client_id")).fetchall()
    assert dict(found) == pytest.approx(want, abs=1e-9)
    names = set(tr.vector_names(model))
    assert {r.feature for r in table.where("slot >= 0").collect()} <= names


def test_empty_table_and_too_many_nodes(spark, rows, monkeypatch, tmp_path):
    from leadlens.operators import model_table as mt

    model = tr.fit(rows, "random_forest", CHEAP["random_forest"])
    model.write().save(f"{tmp_path}/model")
    table, x = model_table(spark, f"{tmp_path}/model"), encode(model, rows, ["client_id"])
    assert score_from_table(x, table.limit(0)).where("probability IS NOT NULL").count() == 0
    monkeypatch.setattr(mt, "MOST_NODES", 10)
    with pytest.raises(ValueError, match="nodes"):
        score_from_table(x, table)


@pytest.fixture(scope="module")
def store(rows):
    return write_folds(stratified_kfold(rows, "client_id", k=3), "client_id")


def test_folds_hold_their_own_encoder(spark, rows, store):
    folds = {r.client_id: r.fold for r in stratified_kfold(rows, "client_id", k=3).collect()}
    assert store.n_folds == 3 and sum(len(folds) - n for n in store.n_train) == len(folds)
    for f in range(3):
        held = store.rows(f).where("held").collect()
        assert {r.client_id for r in held} == {i for i, g in folds.items() if g == f}
        train = store.rows(f).where("NOT held").collect()
        numeric = np.array([r.features.toArray()[:10] for r in train])
        assert np.allclose(numeric.mean(axis=0), 0, atol=1e-9) and np.allclose(numeric.std(axis=0), 1.0)  # of the training rows alone
        by_class = {c: [r for r in train if r.label == c] for c in (0.0, 1.0)}
        for c, some in by_class.items():
            assert some[0].weight_balanced == pytest.approx(len(train) / (2 * len(some)))
        assert by_class[1.0][0].weight_pos == round(len(by_class[0.0]) / len(by_class[1.0]), 2)
        assert all(len(r.features) == len(store.names[f]) for r in held)


@pytest.mark.parametrize("name", sorted(CHEAP))
def test_trials_follow_from_the_stored_scores(spark, store, name):
    draws = {"logistic_regression": tr.search_space}.get(name, lambda n, rng: {**CHEAP[name], "max_depth": int(rng.randint(2, 5))})
    trials, scores = tune_on_folds(store, name, n_trials=3, space=draws)
    pdf = scores.toPandas()
    assert len(pdf) == 3 * 300
    got = trials.orderBy("trial").collect()
    for r in got:
        aucs = [brute_auc(g.y.to_numpy(), g.probability.to_numpy()) for _, g in pdf[pdf.job == str(r.trial)].groupby("fold")]
        assert r.mean_cv_auc == pytest.approx(np.mean(aucs), abs=1e-12) and r.std_cv_auc == pytest.approx(np.std(aucs), abs=1e-12)
    assert [r.is_best for r in got].index(True) == int(np.argmax([r.mean_cv_auc for r in got])) and sum(r.is_best for r in got) == 1
    assert tr.best_params(trials) == json.loads(max(got, key=lambda r: r.mean_cv_auc).params)


def test_compare_and_sweep(spark, store):
    out = {r.model: r for r in compare_on_folds(store, ["logistic_regression", "linear_svc"], {}).collect()}
    assert set(out) == {"logistic_regression", "linear_svc"} and all(0 <= r.roc_auc_mean <= 1 and r.roc_auc_std >= 0 for r in out.values())
    ranked = store.names[0]
    sweep = subset_sweep(store, ranked, (2, 5, 999), params={"n_estimators": 5, "max_depth": 3}).collect()
    assert [r.k for r in sweep] == [2, 5, len(ranked)] and all(0 <= r.mean_cv_auc <= 1 and r.std_cv_auc >= 0 for r in sweep)
    with pytest.raises(ValueError, match="no such"):
        subset_sweep(store, ["nothing"])
    one = fold_scores(store, {"a": ("logistic_regression", {})}, slots=lambda job, names: [names.index("age")])
    assert one.count() == 300


def brute_isotonic(x, y, w):
    """(x, fitted) by the minimax formula."""
    order = np.argsort(x, kind="stable")
    x, y, w = x[order], y[order], w[order]
    cs, cw = np.concatenate([[0], np.cumsum(w * y)]), np.concatenate([[0], np.cumsum(w)])
    n = len(x)
    mean = lambda a, b: (cs[b] - cs[a]) / (cw[b] - cw[a])
    return x, np.array([max(min(mean(a, b) for b in range(i + 1, n + 1)) for a in range(i + 1)) for i in range(n)])


@pytest.mark.parametrize("n_ranges,fan", [(1, 16), (5, 2), (40, 3)])
def test_isotonic_equals_brute_force(spark, monkeypatch, n_ranges, fan):
    monkeypatch.setattr(iso, "FAN", fan)
    rng = np.random.default_rng(n_ranges)
    x = rng.permutation(90) / 7.0
    y = (rng.random(90) < 1 / (1 + np.exp(-(x - 6)))).astype(float)
    w = rng.integers(1, 4, 90).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "margin": x, "y": y, "w": w})).unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1.0), (None, 2.0, 0.0, 1.0), ("a", None, 1.0, 1.0), ("a", float("nan"), 0.0, 1.0), ("a", 3.0, 1.0, 0.0)], "g string, margin double, y double, w double"))
    pools = iso.isotonic_pools(df, weight="w", by=["g"], n_ranges=n_ranges).orderBy("g", "lo").collect()
    assert [(p.lo, p.hi, p.value) for p in pools if p.g is None] == [(1.0, 2.0, 0.5)]
    mine = [p for p in pools if p.g == "a"]
    xs, fit = brute_isotonic(x, y, w)
    assert all(a.value < b.value and a.hi < b.lo for a, b in zip(mine, mine[1:]))
    step = lambda v: next(p.value for p in mine if p.lo <= v <= p.hi)
    assert [step(v) for v in xs] == pytest.approx(fit)
    probes = [-1.0, *xs, *((xs[1:] + xs[:-1]) / 2), 99.0]
    ask = spark.createDataFrame([("a", float(v)) for v in probes] + [("a", None), (None, 1.5), ("b", 1.0)], "g string, margin double")
    got = iso.calibrated(ask, iso.isotonic_pools(df, weight="w", by=["g"], n_ranges=n_ranges), by=["g"], n_ranges=n_ranges).collect()
    knots = sorted({(v, p.value) for p in mine for v in (p.lo, p.hi)})
    want = np.interp(probes, [k for k, _ in knots], [v for _, v in knots])
    assert {r.margin: r.probability for r in got if r.g == "a" and r.margin is not None} == pytest.approx(dict(zip(probes, want)))
    assert [r.probability for r in got if r.g is None] == [0.5] and all(r.probability is None for r in got if r.g == "b" or r.margin is None)


def test_isotonic_of_ties_and_nothing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (1.0, 0.0), (2.0, 1.0)], "margin double, y double")
    assert [(r.lo, r.value) for r in iso.isotonic_pools(df).orderBy("lo").collect()] == [(1.0, pytest.approx(1 / 3)), (2.0, 1.0)]
    assert iso.isotonic_pools(df.limit(0)).count() == 0
    assert iso.calibrated(df.limit(0), iso.isotonic_pools(df)).count() == 0


def test_calibrated_svc_is_the_mean_of_five(spark, rows, monkeypatch):
    folds = stratified_kfold(rows, "client_id", k=3)
    seen = []
    real = iso.calibrated
    monkeypatch.setattr(iso, "calibrated", lambda *a, **k: seen.append(real(*a, **k)) or seen[-1])
    out = {r.client_id: r.probability for r in tr.calibrated_svc(folds, rows, "client_id", k=3).collect()}
    each = seen[0].toPandas()
    assert len(out) == 300 and each.groupby("client_id").size().eq(3).all()
    assert out == pytest.approx(each.groupby("client_id").probability.mean().to_dict())


def test_flow_over_fitted_models(spark, rows, tmp_path):
    from leadlens.sources.io import load_model

    s = stratified_split(rows, "client_id", "y")
    kept: dict = {}
    models = {n: fl.fitted(n, p, kept) for n, p in CHEAP.items()}
    flow = fl.run_flow(*(take_split(s, x).drop("split") for x in ("train", "val", "test")), models, "client_id", kept=kept)
    pdf = flow.scores.toPandas()
    grid = np.linspace(0.05, 0.95, 200)
    profits = {}
    for name, t in flow.thresholds.items():
        v = pdf[(pdf.model == name) & (pdf.split == "val")]
        gain = [((v.probability >= x) & (v.y == 1)).sum() * 195 - ((v.probability >= x) & (v.y == 0)).sum() * 5 - ((v.probability < x) & (v.y == 1)).sum() * 200 for x in grid]
        assert t == grid[int(np.argmax(gain))]
        d = pdf[(pdf.model == name) & (pdf.split == "test")]
        call = d.probability >= t
        profits[name] = float((call & (d.y == 1)).sum() * 195 - (call & (d.y == 0)).sum() * 5 - (~call & (d.y == 1)).sum() * 200)
    table = flow.comparison.collect()
    assert [r.model for r in table] == sorted(profits, key=lambda m: (-profits[m], m)) and [r.place for r in table] == [1, 2, 3]
    assert {r.model: r.net_profit for r in table} == profits and flow.best == table[0].model
    assert flow.recall_table().count() == 18
    fl.save_flow(flow, str(tmp_path))
    loaded, name, t = load_model(spark, str(tmp_path))
    assert (name, t) == (flow.best, flow.thresholds[flow.best])
    again = {r.client_id: r.probability for r in tr.score(loaded, rows, ["client_id"]).collect()}
    assert all(again[r.client_id] == pytest.approx(r.probability) for r in pdf[pdf.model == flow.best].itertuples())


def test_flow_notices_rows_without_a_score(spark, rows):
    s = stratified_split(rows, "client_id", "y")
    lossy = lambda train, rows, key: rows.limit(3).select(key, F.lit(0.5).alias("probability"))
    with pytest.raises(Exception, match="NULL or NaN"):
        fl.run_flow(*(take_split(s, x) for x in ("train", "val", "test")), {"lossy": lossy}, "client_id")


def test_sorted_table_puts_missing_profits_last(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", None), ("d", 9.0)], "model string, net_profit double")
    assert [r.model for r in fl.rank_models(df).collect()] == ["d", "a", "b", "c"]
    assert ev.select_best_model(df).first().model == "d"


def test_training_rows_are_cached_once_a_fold(spark, store, monkeypatch):
    """However many jobs: their scores are those of a job alone, and nothing stays cached."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    calls, persist = [], Frame.persist

    def noted(self, *args, **kw):
        calls.append(self)
        return persist(self, *args, **kw)

    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    monkeypatch.setattr(Frame, "persist", noted)
    jobs = {str(c): ("logistic_regression", {"C": c}) for c in (0.1, 1.0, 10.0)}
    got = {(r.job, r.client_id): r.probability for r in fold_scores(store, jobs).collect()}
    assert len(calls) == store.n_folds
    alone = {(r.job, r.client_id): r.probability for r in fold_scores(store, {"1.0": jobs["1.0"]}).collect()}
    assert {k: p for k, p in got.items() if k[0] == "1.0"} == pytest.approx(alone)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before
    with pytest.raises(ValueError):
        fold_scores(store, {"a": ("no such model", {})})
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= before


def test_a_split_that_many_passes_read_is_written_once(spark, monkeypatch):
    from leadlens.operators import clean
    from leadlens.operators import flow as fl
    from leadlens.plans import catalog  # noqa: F401
    from leadlens.plans.registry import QUERIES

    seen = []

    class Done(Exception):
        pass

    def caught(rows, *args, **kw):
        seen.append(kw.get("fit_on", rows))
        raise Done

    monkeypatch.setattr(clean, "clip_outliers", caught)
    monkeypatch.setattr(fl, "run_flow", caught)
    for name in ("clip_outliers_train", "fitted_flow", "flow_scores"):
        with pytest.raises(Done):
            QUERIES[name](spark, "/root/testdata/sf0.001")
    assert len(seen) == 3
    for df in seen:
        assert "Window" not in df._jdf.queryExecution().toString()
