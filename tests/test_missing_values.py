"""NULL and NaN in targets, numerics and probabilities; the encoder's slots and names."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadlens.functions.columns import cap_value
from leadlens.operators import evaluate as ev
from leadlens.operators.features import standard_scale
from leadlens.operators.profile import correlation_pairs, outlier_report, skewness_report
from leadlens.operators.split import stratified_kfold, stratified_split
from leadlens.operators.train import fit, mutual_information, vector_names

from .conftest import make_bank


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(i, float(i), float(2 * i)) for i in range(100)] + [(100, float("nan"), 1.0), (101, None, 2.0), (102, 3.0, float("nan"))]
    return spark.createDataFrame(rows, "id long, a double, b double")


def test_cap_value_keeps_missing_values(spark):
    df = spark.createDataFrame([(1.0,), (20.0,), (None,), (float("nan"),)], "x double")
    got = [r.y for r in df.select(cap_value("x", 10).alias("y")).collect()]
    assert got[:3] == [1.0, 10.0, None] and math.isnan(got[3])


def test_nan_is_missing_in_reports(dirty):
    row = outlier_report(dirty, ["a"]).first()
    x = np.array([*range(100), 3.0])
    low, high = np.quantile(x, [0.01, 0.99])
    assert (row.n_low, row.n_high) == ((x < low).sum(), (x > high).sum())
    assert {r.column: r.flag for r in skewness_report(dirty, ["a", "b"]).collect()} == {"a": "OK", "b": "OK"}
    assert correlation_pairs(dirty, ["a", "b"]).first().abs_r == pytest.approx(1.0)
    scaled = standard_scale(dirty.where("id < 101"), ["a"]).agg(F.avg(F.when(~F.isnan("num__a"), F.col("num__a")))).first()[0]
    assert abs(scaled) < 1e-9


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_probability_fails(spark, bad):
    df = spark.createDataFrame([(0, 0.1), (1, 0.9), (1, bad)], "y int, probability double")
    for frame in (ev.confusion(df, "y", "probability", 0.5), ev.log_loss(df, "y", "probability")):
        with pytest.raises(Exception, match="NULL or NaN"):
            frame.collect()


def test_rows_without_target_stay(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(200)], "id long, y int")
    assert stratified_split(df, "id").count() == 200
    assert stratified_kfold(df, "id").groupBy("y", "fold").count().count() == 15


def test_encoder_slots_have_their_names(spark):
    pdf = make_bank(300)
    pdf.loc[5, "education"] = None
    train = spark.createDataFrame(pdf)
    model = fit(train, "logistic_regression")
    names = vector_names(model)
    safe = [c.replace(".", "_") for c in train.columns]
    row = model.transform(train.toDF(*safe).limit(1)).first()
    assert len(names) == len(row.features)
    two = [c for c in ("default", "contact") if pdf[c].nunique() == 2]
    assert all(sum(n.startswith(c + "_") for n in names) == 1 for c in two)
    unseen = train.toDF(*safe).limit(1).withColumn("job", F.lit("no such job")).withColumn("education", F.lit(None).cast("string"))
    got = model.transform(unseen).first()
    vec = dict(zip(names, got.features.toArray()))
    assert all(v == 0 for n, v in vec.items() if n.startswith("job_")) and vec["ord_education"] == -1
    assert not math.isnan(got.probability[1])
    numeric = np.array([r.num_scaled.toArray() for r in model.transform(train.toDF(*safe)).collect()])
    assert np.allclose(numeric.std(axis=0), 1.0)


def test_mutual_information_with_many_levels(spark):
    pdf = make_bank(200)
    got = {r.feature: r.mutual_info for r in mutual_information(spark.createDataFrame(pdf), ["job", "client_id"]).collect()}
    p = pdf.y.mean()
    entropy = -(p * math.log(p) + (1 - p) * math.log(1 - p))
    assert got["client_id"] == pytest.approx(entropy) and 0 <= got["job"] < entropy
