"""Hand-made edge frames (FIXTURES.md section 6)."""

import math

import pytest
from pyspark.sql import functions as F

from riskframe.functions.exprs import right_closed_cut, safe_ratio
from riskframe.operators import aggregates as A
from riskframe.operators import drift as K
from riskframe.operators import evaluation as V
from riskframe.operators import quality as Q
from riskframe.operators.encoding import fit_levels, collect_levels, one_hot
from riskframe.operators.features import add_flag, add_ratio
from riskframe.operators.rules import rule_classifier


def test_nan_and_null_both_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (4.0,)], "x double")
    assert Q.null_counts(df).first()["n_null"] == 2
    med = Q.fit_medians(df, ["x"]).first()["x"]
    assert med == 2.5
    filled = Q.apply_fill(df, Q.fit_medians(df, ["x"])).collect()
    assert sorted(r.x for r in filled) == [1.0, 2.5, 2.5, 4.0]


def test_zero_denominator_guarded_and_unguarded(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, 5.0), (0.0, 0.0), (None, 1.0)], "capital_prestado double, salario_cliente double")
    g = [r.ratio_capital_salario for r in add_ratio(df).collect()]
    assert g == [0.0, 2.0, 0.0, 0.0]
    u = [r.ratio_capital_salario for r in add_ratio(df, guarded=False).collect()]
    assert u[0] == float("inf") and u[1] == 2.0 and u[2] is None and u[3] is None


def test_right_closed_bin_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0, 30, 31, 45, 60, 150, 151, None]], "age int")
    labels = ["a", "b", "c", "d"]
    got = [r.b for r in df.select(right_closed_cut("age", [0, 30, 45, 60, 150], labels).alias("b")).collect()]
    assert got == [None, "a", "b", "b", "c", "d", None, None]


def test_flag_null_is_zero(spark):
    df = spark.createDataFrame([(None,), (0.0,), (3.0,)], "saldo_mora double")
    assert [r.tiene_mora for r in add_flag(df).collect()] == [0, 0, 1]


def test_tied_and_constant_scores_auc(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    assert V.roc_auc(df, "label", "score", 1).first()["roc_auc"] == 0.5
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (1, 0.4), (0, 0.4)], "label int, score double")
    assert V.roc_auc(df, "label", "score", 1).first()["roc_auc"] == pytest.approx(0.875)


def test_single_class_fold_zero_division(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 0)], "label int, prediction int")
    m = V.binary_metrics(df, "label", "prediction", 0).first()
    assert m["precision"] == 0.0 and m["recall"] == 0.0 and m["f1"] == 0.0
    # sklearn: mean recall over the classes present in y_true (only class 1 here): 2/3
    assert m["balanced_accuracy"] == pytest.approx(2 / 3)
    cm = {(r.actual, r.predicted): r["count"] for r in V.confusion_matrix(df, "label", "prediction").collect()}
    assert cm == {(0, 0): 0, (0, 1): 0, (1, 0): 1, (1, 1): 2}


def test_unseen_and_null_category_one_hot(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    levels = collect_levels(fit_levels(train, ["c"]))
    rows = one_hot(test, levels).collect()
    assert [(r["cat__c_a"], r["cat__c_b"]) for r in rows] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_constant_column_corr_is_nan(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, b double")
    r = A.corr_with(df, "b", ["a"]).first()["corr"]
    assert math.isnan(r)


def test_empty_and_one_row_batch_and_no_common_columns(spark):
    ref = spark.createDataFrame([(float(i),) for i in range(10)], "x double")
    one = spark.createDataFrame([(1.0,)], "x double")
    empty = spark.createDataFrame([], "x double")
    other = spark.createDataFrame([(1.0,), (2.0,)], "y double")
    assert K.ks_report(ref, one).count() == 0
    assert K.ks_report(ref, empty).count() == 0
    rep = K.ks_report(ref, other)
    assert rep.count() == 0 and "ks_statistic" in rep.columns


def test_rules_skip_absent_columns_and_nulls(spark):
    df = spark.createDataFrame([(None, 500.0), (1, 800.0), (0, None)], "tiene_mora int, puntaje_datacredito double")
    got = [(r.prediction, r.rule_hit) for r in rule_classifier(df).collect()]
    assert got == [(0, 2), (0, 1), (1, 0)]


def test_safe_ratio_null(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    assert df.select(safe_ratio("a", "b").alias("r")).first().r == 0.0


def test_whisker_and_outliers(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    b = A.box_stats(df, ["x"]).first()
    assert (b.q1, b.median, b.q3) == (2.0, 3.0, 4.0)
    assert b.whisker_hi == 4.0 and b.n_outliers == 1


def test_histogram_constant_column_like_numpy(spark):
    import numpy as np
    df = spark.createDataFrame([(3.0,), (3.0,), (3.0,)], "x double")
    h = {r.bin: r for r in A.histogram(df, ["x"], bins=4).collect()}
    counts, edges = np.histogram([3.0, 3.0, 3.0], bins=4)
    assert [h[i]["count"] for i in range(4)] == list(counts)
    assert [h[i].bin_lo for i in range(4)] == list(edges[:-1])


def test_histogram_max_in_last_bin_like_numpy(spark):
    import numpy as np
    vals = [0.0, 1.0, 2.5, 7.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    h = {r.bin: r["count"] for r in A.histogram(df, ["x"], bins=5).collect()}
    assert [h[i] for i in range(5)] == list(np.histogram(vals, bins=5)[0])
