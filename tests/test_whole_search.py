"""The tuning queries search the reference's whole spaces, in as many trials as it does."""

from __future__ import annotations

import inspect

import pytest

from leadlens.operators import folds
from leadlens.operators import train as tr


@pytest.mark.parametrize("query,model", [("tune_model", "logistic_regression"), ("tune_forest", "random_forest"), ("tune_boosting", "gradient_boosting")])
def test_queries_search_the_whole_space(monkeypatch, query, model):
    from leadlens.plans import catalog as cat
    from leadlens.plans import model_queries as mq
    from leadlens.plans.registry import ORACLE

    seen = []

    def caught(store, name, n_trials=30, seed=tr.SEED, space=tr.search_space, parallelism=4):
        seen.append((name, n_trials, space))
        return "trials", "scores"

    monkeypatch.setattr(folds, "tune_on_folds", caught)
    monkeypatch.setattr(folds, "write_folds", lambda *a: None)
    monkeypatch.setattr(cat, "_train_folds", lambda *a: None)
    monkeypatch.setattr(mq, "_trials_row", lambda trials, scores: None)
    getattr(mq, f"q_{query}")(None, "")
    n = inspect.signature(tr.tune_model).parameters["n_trials"].default
    assert n == 30 and seen == [(model, n, tr.search_space)]
    assert f"SELECT {n} AS n_trials" in ORACLE[query]
