"""Training smoke tests, the query catalog, the oracle and streaming."""

from __future__ import annotations

import pytest

from leadlens.operators import train as tr

SMOKE = "/root/testdata/sf0.001"


def test_class_weights(spark, bank, bank_pdf):
    rows = {r.y: r for r in tr.class_weights(bank).collect()}
    n, n1 = len(bank_pdf), int(bank_pdf.y.sum())
    assert rows[1].weight == pytest.approx(n / (2 * n1))
    assert rows[0].scale_pos_weight == round((n - n1) / n1, 2)


@pytest.mark.parametrize("name", ["logistic_regression", "random_forest"])
def test_pipeline_probabilities(spark, bank, name):
    model = tr.fit(bank, name, {"n_estimators": 10, "max_depth": 3})
    from pyspark.ml.functions import vector_to_array

    out = model.transform(tr.prepare(bank, "y", "none")).select(vector_to_array("probability").alias("p")).collect()
    assert len(out) == 200 and all(abs(sum(r.p) - 1) < 1e-9 for r in out)


def test_unknown_model_name():
    with pytest.raises(ValueError):
        tr.make_classifier("nope")


def test_catalog_contract():
    import __spark_entry__ as entry

    q, o = entry.queries(), entry.oracle_sql()
    assert len(q) > 90 and set(o) <= set(q)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["threshold", "net_profit"] and df.count() == 1


FAST_ORACLE = [
    "find_optimal_threshold", "compute_metrics", "recall_analysis", "roc_curve", "describe", "clean_data",
    "unknown_report", "cardinality_report", "stratified_split", "one_hot", "decision_zones", "tier_rules",
    "reason_codes", "conform_schema", "histogram", "zone_profile", "anova_f", "local_cases",
]


@pytest.mark.parametrize("name", FAST_ORACLE)
def test_oracle_parity_smoke(spark, name):
    from tests.oracle_util import compare

    res = compare(spark, SMOKE, name)
    assert res["match"], res


def test_stream_scoring_matches_batch(spark):
    from tests.oracle_util import compare

    assert compare(spark, SMOKE, "score_stream")["match"]
