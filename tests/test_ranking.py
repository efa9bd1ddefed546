"""ROC-AUC of many score columns against the grouped metric operator."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.operators import evaluate as ev
from leadlens.operators import ranking


def rows_of(spark, n=3000, seed=3):
    rng = np.random.RandomState(seed)
    rows = [
        ([None, "a", "b"][int(g)], int(r), None if y > 1 else int(y), [float(v) for v in s])
        for g, r, y, s in zip(rng.randint(0, 3, n), rng.randint(0, 2, n), rng.randint(0, 3, n), np.round(rng.randn(n, 3), 1))
    ]
    rows += [("one class", 0, 1, [0.5, -0.0, 0.0]), ("one class", 0, 1, [0.25, 0.0, 0.0]), ("no label", 1, None, [0.1, 0.2, 0.3])]
    return spark.createDataFrame(rows, "g string, r int, y int, scores array<double>")


@pytest.mark.parametrize("cuts", [[], [0.0], [-1.0, -0.5, 0.0, 0.1, 0.7], [-99.0, 99.0]])
def test_aucs_of_arrays_equal_the_grouped_metric(spark, monkeypatch, cuts):
    monkeypatch.setattr(ranking, "AT_ONCE", 500)  # several packed rows per range
    df = rows_of(spark)
    long = df.select("g", "r", "y", F.posexplode("scores").alias("place", "score"))
    want = {(x.g, x.r, x.place): x.roc_auc for x in ev.roc_auc(long, "y", "score", by=["g", "r", "place"]).collect()}
    names = ["p", "q", "s"]
    got = {(x.g, x.r, names.index(x.variant)): x.roc_auc for x in ranking.roc_aucs(df.repartition(3), names, cuts, by=["g", "r"]).collect()}
    assert got == want  # to the last bit
    whole = {(x.place): x.roc_auc for x in ev.roc_auc(long, "y", "score", by=["place"]).collect()}
    assert {names.index(x.variant): x.roc_auc for x in ranking.roc_aucs(df, names, cuts).collect()} == whole


def test_missing_scores_fail(spark):
    for bad in ([0.5, None], [0.5, float("nan")], None, [0.5]):
        df = spark.createDataFrame([(1, [0.5, 0.5]), (0, bad)], "y int, scores array<double>")
        with pytest.raises(Exception, match="NULL or NaN"):
            ranking.roc_aucs(df, ["a", "b"], []).collect()


def test_pairs_beyond_64_bits(spark):
    import pyarrow as pa

    n = 2**31 - 1
    packed = [pa.array([np.array([0.5] * 2, "f8").tobytes()]), pa.array([np.array([n, n], "i4").tobytes()])] * 2
    assert ranking._merged(packed) == (2 * n, 2 * n, 4 * n * n)


def test_no_row_per_permuted_score(spark, bank):
    """The permuted scores reach the ranking in arrays: the shuffled rows do not grow with the number of features."""
    from leadlens.operators import train as tr

    model = tr.fit(bank, "logistic_regression")
    seen = []
    real = ranking.roc_aucs
    try:
        ranking.roc_aucs = lambda df, names, *a, **k: (seen.append((df.count(), list(names))), real(df, names, *a, **k))[1]
        features = ["age", "campaign", "job"]
        out = tr.permutation_importance(model, bank, "client_id", features, repeats=2).collect()
    finally:
        ranking.roc_aucs = real
    assert seen == [(2 * bank.count(), features)] and {r.feature for r in out} == set(features)
