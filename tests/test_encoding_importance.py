"""Level dictionaries, importance by slot exchange, p-values, attribution, cleaning reports."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from leadlens.operators import train as tr
from leadlens.operators.clean import clean_data, clean_with_reports
from leadlens.operators.encoding import fit_sparse_encoder, level_dictionary, to_vector
from leadlens.operators.features import NOMINAL_FEATURES, fit_preprocessor
from leadlens.operators.model_table import encode
from leadlens.operators.split import class_rank

from .conftest import make_bank
from .test_ranges import brute_auc


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(make_bank(240)).persist()


def by_name(enc, df, key) -> dict:
    names = {r.slot: r.feature for r in enc.names().collect()}
    assert sorted(names) == list(range(enc.size))
    out = {}
    for r in enc.encode(df, [key]).collect():
        assert r.size == enc.size and r.indices == sorted(set(r.indices)) and all(v != 0 for v in r["values"])
        out[r[key]] = {names[i]: v for i, v in zip(r.indices, r["values"])}
    return out


def test_equals_the_expression_form(spark, rows):
    numeric = ["age", "campaign", "emp.var.rate"]
    enc = fit_sparse_encoder(rows, numeric, "education", NOMINAL_FEATURES)
    pre = fit_preprocessor(rows, numeric, "education", NOMINAL_FEATURES)
    got = by_name(enc, rows, "client_id")
    for r in pre.transform(rows, ["client_id"]).collect():
        want = {c.split("__", 1)[1]: v for c, v in r.asDict().items() if "__" in c and v != 0}
        want = {("ord_" + n if n == "education" else n): v for n, v in want.items()}
        mine = {n.replace(".", "_").replace(" ", "_"): v for n, v in got[r.client_id].items()}
        assert mine == pytest.approx({n.replace(".", "_"): v for n, v in want.items()})
    vec = to_vector(enc.encode(rows, ["client_id"])).first().features
    assert vec.size == enc.size


def test_unseen_null_and_many_levels(spark):
    train = spark.createDataFrame([(i, f"user {i}", "a" if i % 2 else "b", None) for i in range(300)] + [(300, None, None, None)], "id int, who string, two string, none string")
    enc = fit_sparse_encoder(train, [], None, ["who", "two", "none"])
    assert enc.size == 301  # of two levels the second alone
    ask = spark.createDataFrame([(1, "user 7", "b", "x"), (2, "nobody", "a", None), (3, None, None, None)], train.schema)
    assert by_name(enc, ask, "id") == {1: {"who_user 7": 1.0, "two_b": 1.0}, 2: {}, 3: {}}
    assert level_dictionary(train.limit(0), ["who"]).count() == 0


@pytest.mark.parametrize("name,params", [("logistic_regression", {}), ("random_forest", {"n_estimators": 4, "max_depth": 3})])
def test_slot_exchange_equals_scoring_the_changed_rows(spark, rows, name, params):
    model = tr.fit(rows, name, params)
    features, repeats, seed = ["age", "pdays", "education", "job", "contact"], 2, 42
    got = {r.feature: (r.importance_mean, r.importance_std) for r in tr.permutation_importance(model, rows, "client_id", features, repeats, seed).collect()}
    pdf = rows.toPandas().set_index("client_id", drop=False)
    rank = {r.client_id: r["rank"] for r in tr.distributed_rank(rows.select("client_id"), "client_id", seed).collect()}
    reps = rows.select(F.col("client_id").alias("_k"), F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("_r"))
    partner = {(r._r, r.class_rank): r._k for r in class_rank(reps, ["_k", "_r"], "_r", seed).collect()}

    def auc(frame) -> float:
        scored = tr.score(model, spark.createDataFrame(frame), ["client_id", "y"]).toPandas()
        return brute_auc(scored.y.to_numpy(), scored.probability.to_numpy())

    base = auc(pdf)
    for f in features:
        drops = []
        for r in range(repeats):
            changed = pdf.copy()
            changed[f] = [pdf.at[partner[r, rank[i]], f] for i in pdf.index]
            drops.append(base - auc(changed))
        assert got[f] == (pytest.approx(np.mean(drops), abs=1e-9), pytest.approx(np.std(drops), abs=1e-9))
    with pytest.raises(ValueError, match="no slots"):
        tr.permutation_importance(model, rows, "client_id", ["nothing"], 1)


def simpson_f_survival(f: float, d1: float, d2: float) -> float:
    """Integral of the density of x = d2 / (d2 + d1 F), with both ends' powers substituted away."""
    a, b = d2 / 2, d1 / 2
    top = d2 / (d2 + d1 * f)
    t = np.linspace(0.0, math.asin(math.sqrt(top)), 200_001)  # x = sin(t) ** 2
    log = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    with np.errstate(divide="ignore"):
        g = 2 * np.exp(log + (2 * a - 1) * np.log(np.sin(t)) + (2 * b - 1) * np.log(np.cos(t)))
    h = t[1] - t[0]
    return float(h / 3 * (g[0] + g[-1] + 4 * g[1:-1:2].sum() + 2 * g[2:-1:2].sum()))


@pytest.mark.parametrize("d1,d2", [(1, 10), (1, 10_000), (2, 30), (5, 7), (40, 3)])
def test_f_survival(d1, d2):
    for f in (1e-3, 0.2, 1.0, 3.0, 12.0, 40.0):
        want = simpson_f_survival(f, d1, d2)
        assert tr.f_survival(f, d1, d2) == pytest.approx(want, rel=1e-9, abs=1e-15)
    assert tr.f_survival(0.0, d1, d2) == 1.0 and tr.f_survival(math.inf, d1, d2) == 0.0 and tr.f_survival(None, d1, d2) is None


def test_anova_of_slots(spark):
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(3)
    y = rng.integers(0, 3, 90)
    x = np.stack([rng.normal(y, 1.0), (rng.random(90) < 0.2).astype(float), np.full(90, 4.0)], axis=1)
    df = spark.createDataFrame([(int(a), Vectors.dense(v)) for a, v in zip(y, x)] + [(None, Vectors.dense([9.0, 9.0, 9.0]))], ["y", "features"])
    got = {r.feature: r for r in tr.anova_encoded(df, ["a", "b", "flat"]).collect()}
    for i, n in enumerate(("a", "b")):
        groups = [x[y == g, i] for g in range(3)]
        ssb = sum(len(g) * (g.mean() - x[:, i].mean()) ** 2 for g in groups)
        f = (ssb / 2) / (sum(((g - g.mean()) ** 2).sum() for g in groups) / 87)
        assert got[n].f_stat == pytest.approx(f) and got[n].p_value == pytest.approx(simpson_f_survival(f, 2, 87), rel=1e-8)
    assert got["flat"].f_stat is None and got["flat"].p_value is None
    assert tr.anova_encoded(df.limit(0), ["a"]).count() == 0


def test_attributions_add_up(spark, rows):
    model = tr.fit(rows, "logistic_regression")
    out, base = tr.fitted_attribution(model, rows, "client_id")
    got = out.collect()
    assert all(base + sum(r.attribution) == pytest.approx(r.margin) for r in got)
    assert np.mean([r.attribution for r in got], axis=0) == pytest.approx(0.0, abs=1e-9)
    p = {r.client_id: r.probability for r in tr.score(model, rows, ["client_id"]).collect()}
    assert all(1 / (1 + math.exp(-r.margin)) == pytest.approx(p[r.client_id]) for r in got)
    assert encode(model, rows, ["client_id"]).count() == 240


def test_cleaning_reports(spark):
    pdf = pd.DataFrame({"job": ["a", "unknown", "a", "b"] * 5, "age": [1.0, 2.0, np.nan, 90.0] * 5, "duration": range(20)})
    df = spark.createDataFrame(pdf)
    clean, reports = clean_with_reports(df, outlier_cols=["age"], impute_cols=["job"])
    got = {(r.report, r.column): r.value for r in reports.collect()}
    assert got["missing", "age"] == 5 and got["levels", "job"] == 3 and ("skewness", "age") in got
    assert sorted(map(str, clean.collect())) == sorted(map(str, clean_data(df, outlier_cols=["age"], impute_cols=["job"]).collect()))
    assert "duration" in clean_data(df, production=False, outlier_cols=["age"], impute_cols=["job"], write=False).columns
