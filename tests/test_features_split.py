"""Sentinel, encoders, schema conformance and the stratified split."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from leadlens.functions import columns as fc
from leadlens.operators import features as fe
from leadlens.operators import split as sp


def test_sentinel_split(spark):
    df = spark.createDataFrame([(999,), (6,), (999,), (6,)], "pdays int")
    rows = fc.sentinel_split(df).collect()
    assert [r.was_previously_contacted for r in rows] == [0, 1, 0, 1]
    assert rows[0].pdays_log == 0.0 and rows[1].pdays_log == pytest.approx(math.log1p(6))
    assert "pdays" not in fc.sentinel_split(df).columns


def test_cut_bins_right_closed(spark):
    df = spark.createDataFrame([(0,), (3,), (4,), (999,), (1000,)], "pdays int")
    got = [r.b for r in df.select(fc.cut_bins("pdays", [0, 3, 7, 14, 30, 999]).alias("b")).collect()]
    assert got == [None, 1, 2, 5, None]


def test_ordinal_unseen_is_minus_one(spark):
    df = spark.createDataFrame([("illiterate",), ("unknown",), ("phd",), (None,)], "education string")
    got = [r.ord__education for r in fe.ordinal_encode(df).collect()]
    assert got == [0, 7, -1, -1]


def test_one_hot_drops_first_of_binary_and_ignores_unseen(spark):
    train = spark.createDataFrame([("cellular", "a"), ("telephone", "b"), ("cellular", "c")], "contact string, k string")
    test = spark.createDataFrame([("telephone", "z")], "contact string, k string")
    out = fe.one_hot(test, ["contact", "k"], fit_on=train)
    cols = [c for c in out.columns if c.startswith("nom__")]
    assert cols == ["nom__contact_telephone", "nom__k_a", "nom__k_b", "nom__k_c"]
    r = out.first()
    assert r.nom__contact_telephone == 1 and (r.nom__k_a, r.nom__k_b, r.nom__k_c) == (0, 0, 0)


def test_standard_scale_population_std_and_constant(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    rows = fe.standard_scale(df, ["x", "c"]).collect()
    assert [r.num__x for r in rows] == [-1.0, 1.0]  # population std (1), not sample (sqrt 2)
    assert [r.num__c for r in rows] == [0.0, 0.0]


def test_conform_schema(spark, bank):
    messy = bank.select(
        F.col("client_id").alias(" ID "), F.col("age").alias("AGE"), "job", F.col("`emp.var.rate`").alias("EMP_VAR_RATE"),
        F.col("y").alias("Y"), F.lit(float("nan")).alias("campaign"),
    )
    out, warns, missing = fc_conform(messy)
    assert "y" not in out.columns and "id" not in out.columns
    assert out.schema["pdays"].dataType.simpleString() == "double" and out.first().pdays == 999.0
    assert out.first().campaign == 0.0
    assert any("NaN" in w for w in warns) and "marital" in missing


def fc_conform(df):
    from leadlens.operators.schema import conform_schema

    return conform_schema(df)


def test_stratified_split_exact_and_partition_independent(spark, bank, bank_pdf):
    a = sp.stratified_split(bank, "client_id").select("client_id", "split")
    b = sp.stratified_split(bank.repartition(7), "client_id").select("client_id", "split")
    assert sorted(a.collect()) == sorted(b.collect())
    n1 = int(bank_pdf.y.sum())
    counts = {(r.split, r.y): r.n for r in sp.stratified_split(bank, "client_id").groupBy("split", "y").agg(F.count("*").alias("n")).collect()}
    assert counts[("train", 1)] == round(n1 * 0.7)
    assert counts[("train", 1)] + counts[("val", 1)] == round(n1 * 0.85)


def test_kfold_balanced(spark, bank):
    folds = sp.stratified_kfold(bank, "client_id", k=5).groupBy("fold").count().collect()
    sizes = sorted(r["count"] for r in folds)
    assert len(sizes) == 5 and sizes[-1] - sizes[0] <= 2


def test_reason_codes(spark):
    df = spark.createDataFrame(
        [("success", "cellular", 1.0, "retired", "mar", 1, 65, 5, "no", "no", 5000.0)],
        "poutcome string, contact string, euribor3m double, job string, month string, campaign int, age int, pdays int, "
        "housing string, loan string, `nr.employed` double",
    )
    pos, neg = fc.reason_codes()
    r = df.select(pos.alias("p"), neg.alias("n")).first()
    assert r.p == ["Previous campaign: Success", "Mobile contact", "Low interest rates", "Retired - high-value",
                   "Strong month (Mar)", "Fresh lead (2 or fewer calls)", "Senior (60+)", "Recently contacted",
                   "No existing loans", "Receptive market"]
    assert r.n == []
