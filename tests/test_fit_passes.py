"""What fits and calibration read, how often, and that it changes nothing."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.operators import isotonic as iso
from leadlens.operators import train as tr
from leadlens.operators.features import NOMINAL_FEATURES, build_pipeline
from leadlens.operators.split import stratified_kfold

from .conftest import make_bank

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(make_bank(300)).persist()


def test_calibration_sums_up_no_frame_anew(spark):
    ask = spark.createDataFrame([(float(i % 97),) for i in range(300)], "margin double")
    pools = spark.createDataFrame([(10.0, 20.0, 0.1), (30.0, 30.0, 0.4), (60.0, 70.0, 0.9)], "lo double, hi double, value double")
    out = iso.calibrated(ask, pools, n_ranges=4)
    assert "unboundedfollowing" not in out._jdf.queryExecution().toString().lower()
    got = out.collect()
    assert len(got) == 300
    knots = [(10.0, 0.1), (20.0, 0.1), (30.0, 0.4), (60.0, 0.9), (70.0, 0.9)]
    assert [r.probability for r in got] == pytest.approx([np.interp(r.margin, *zip(*knots)) for r in got])


def test_binary_columns_are_found_without_copies_of_the_rows(spark, monkeypatch):
    df = spark.createDataFrame(
        [("a", "x", None, "u", None, 1), ("b", "x", "m", "v", None, 2), ("a", None, "n", "w", None, 2), (None, "x", "m", "u", None, 1)],
        "two string, one string, gaps string, three string, none string, number int",
    )
    monkeypatch.setattr(F, "count_distinct", None)  # would hold every row once a column
    assert tr.binary_columns(df, ["two", "one", "gaps", "three", "none", "number"]) == ["two", "gaps", "number"]
    assert tr.binary_columns(df.limit(0), ["two"]) == [] and tr.binary_columns(df, []) == []


@pytest.mark.parametrize("name,params", [("logistic_regression", {}), ("random_forest", {"n_estimators": 5, "max_depth": 4})])
def test_classifier_reads_kept_rows_and_finds_the_same_model(spark, rows, monkeypatch, name, params):
    real, seen = tr.make_classifier, []

    def spied(*args):
        classifier = real(*args)
        fit = classifier.fit
        classifier.fit = lambda df, *more: seen.append(df.storageLevel.useMemory) or fit(df, *more)
        return classifier

    monkeypatch.setattr(tr, "make_classifier", spied)
    model = tr.fit(rows, name, params)
    assert seen == [True]
    prepared = tr.prepare(rows).persist()
    n = prepared.count()
    whole = build_pipeline(real(name, params, n), binary=tr.binary_columns(prepared, NOMINAL_FEATURES), n_rows=n).fit(prepared)
    assert [type(s) for s in model.stages] == [type(s) for s in whole.stages]
    want = {r.client_id: r.probability for r in tr.score(whole, rows, ["client_id"]).collect()}
    assert {r.client_id: r.probability for r in tr.score(model, rows, ["client_id"]).collect()} == pytest.approx(want, abs=1e-9)
    prepared.unpersist()


@pytest.mark.parametrize("n,most", [(300, 1_000_000), (300, 20)])
def test_classifier_reads_no_spare_partitions(spark, rows, monkeypatch, n, most):
    real, seen = tr.make_classifier, []

    def spied(*args):
        classifier = real(*args)
        fit = classifier.fit
        classifier.fit = lambda df, *more: seen.append((df.rdd.getNumPartitions(), df.count())) or fit(df, *more)
        return classifier

    monkeypatch.setattr(tr, "make_classifier", spied)
    monkeypatch.setattr(tr, "FIT_ROWS", most)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        model = tr.fit(rows, "random_forest", {"n_estimators": 3, "max_depth": 4})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    parts = max(tr.FIT_PARTS, spark.sparkContext.defaultParallelism, -(-n // most))
    assert parts < 64 and seen == [(parts, n)]  # every row, in as many partitions as cores or as the rows need
    assert model.stages[-1].getNumTrees == 3


def test_held_margins_are_scored_once(spark, rows, monkeypatch):
    real, seen = iso.isotonic_pools, []
    monkeypatch.setattr(iso, "isotonic_pools", lambda df, *a, **k: seen.append(df.inputFiles()) or real(df, *a, **k))
    make = tr.make_classifier
    monkeypatch.setattr(tr, "make_classifier", lambda name, params, *a: make(name, {**params, "max_iter": 2}, *a))
    folds = stratified_kfold(rows, "client_id", k=2)
    assert tr.calibrated_svc(folds, rows, "client_id", k=2).count() == 300
    assert len(seen) == 1 and seen[0] and all("held_margins" in f for f in seen[0])


def test_reloaded_scores_are_computed_once(spark, monkeypatch):
    from leadlens.plans import catalog  # noqa: F401  (registers queries)
    from leadlens.plans.model_queries import q_verify_roundtrip
    from leadlens.sources import io

    real, seen = io.verify_roundtrip, []
    monkeypatch.setattr(io, "verify_roundtrip", lambda a, b, *k: seen.append(b.inputFiles()) or real(a, b, *k))
    row = q_verify_roundtrip(spark, SMOKE).first()
    assert row["passed"] and not row["other_passes"] and row["unmatched"] == 0
    assert len(seen) == 2 and seen[0] == seen[1] and all("scores_again" in f for f in seen[0])
