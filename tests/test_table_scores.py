"""Scores from a table of trees: lists of categories, missing values, and what reaches the tasks."""

import math

import pytest

from leadlens.operators.model_table import SCHEMA, score_from_table


def nodes(kind):
    inner = lambda t, n, s, th, cats, lo, hi, w: (kind, t, n, s, f"f{s}", th, cats, lo, hi, None, w)
    leaf = lambda t, n, v, w: (kind, t, n, -1, None, None, None, None, None, v, w)
    return [
        leaf(1, 2, 0.75, 0.5), inner(1, 0, 1, None, [0.0, 2.0], 1, 2, 0.5), leaf(1, 1, 0.25, 0.5),
        inner(0, 0, 0, 0.5, None, 1, 4, 0.25), inner(0, 1, 1, 1.0, None, 2, 3, 0.25), leaf(0, 2, 0.1, 0.25), leaf(0, 3, 0.2, 0.25), leaf(0, 4, 0.9, 0.25),
        leaf(2, 0, 0.4, 0.25),
    ]


@pytest.mark.parametrize("kind", ["forest", "boosted"])
def test_every_way_down(spark, kind):
    table = spark.createDataFrame(nodes(kind), SCHEMA).repartition(3)
    nan = float("nan")
    cases = {  # leaves of trees 0 and 1
        (0.0, 0.0): (0.1, 0.25), (0.5, 1.0): (0.1, 0.75), (0.5, 2.0): (0.2, 0.25), (0.6, 2.0): (0.9, 0.25),
        (nan, 2.0): (0.9, 0.25), (None, 0.0): (0.9, 0.25), (0.0, nan): (0.2, 0.75), (0.0, None): (0.2, 0.75), None: (0.9, 0.75),
    }
    rows = spark.createDataFrame([(i, None if x is None else list(x)) for i, x in enumerate(cases)], "i int, x array<double>")
    got = {r.i: r.probability for r in score_from_table(rows, table).collect()}
    for i, (a, b) in enumerate(cases.values()):
        total = 0.25 * a + 0.5 * b + 0.25 * 0.4
        assert got[i] == pytest.approx(total if kind == "forest" else 1 / (1 + math.exp(-2 * total)), abs=1e-15)
    alone = score_from_table(rows.where("x IS NULL"), table).collect()  # a batch of missing vectors alone
    assert [r.probability for r in alone] == [got[len(cases) - 1]]


def test_no_copy_of_the_forest_beside_each_row(spark):
    rows = spark.createDataFrame([(1, [0.0, 0.0])], "i int, x array<double>")
    plan = score_from_table(rows, spark.createDataFrame(nodes("forest"), SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "ArrowEvalPython" in plan


def test_shallow_boosted_trees_keep_no_node_ids(spark):
    from leadlens.operators.train import make_classifier

    kept = lambda name, depth: make_classifier(name, {"max_depth": depth}).getCacheNodeIds()
    assert not kept("gradient_boosting", 4) and kept("gradient_boosting", 9) and kept("random_forest", 8)
