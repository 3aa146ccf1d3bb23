from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator

from tabstudy.operators import metrics as M
from tabstudy.plans import experiment as E


def auc_by_pairs(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.mark.parametrize("kind", ["ties", "continuous", "crowded"])
def test_auc_and_curve(spark, kind):
    rng = np.random.default_rng(5)
    y = (rng.random(3000) < 0.3).astype(int)
    s = rng.normal(size=3000) + y
    if kind == "ties":
        s = np.round(s)
    if kind == "crowded":
        s[:1500] = 0.5
    df = spark.createDataFrame(pd.DataFrame({"y": y, "s": s})).repartition(6)
    auc = M.roc_auc(df, "y", "s").first()["auc"]
    assert auc == pytest.approx(auc_by_pairs(y, s), abs=1e-12)
    if kind == "continuous":
        ml = BinaryClassificationEvaluator(labelCol="y", rawPredictionCol="s", numBins=0).evaluate(df)
        assert auc == pytest.approx(ml, abs=1e-9)
    full = M.roc_curve(df, "y", "s", drop_collinear=False).toPandas().sort_values("threshold", ascending=False)
    kept = M.roc_curve(df, "y", "s").toPandas().sort_values("threshold", ascending=False)
    assert len(full) == len(np.unique(s)) + 1 and len(kept) <= len(full)
    for curve in (full, kept):
        assert tuple(curve.iloc[0]) == (0, 0, np.inf) and tuple(curve.iloc[-1][:2]) == (1, 1)
        assert np.trapezoid(curve["tpr"], curve["fpr"]) == pytest.approx(auc, abs=1e-12)


def test_curve_keeps_the_points_where_it_turns(spark):
    """Counts per score, highest first: (1,0) (1,0) (0,1) (0,1) (1,1)."""
    rows = [(1, 9.0), (1, 8.0), (0, 7.0), (0, 6.0), (1, 5.0), (0, 5.0)]
    got = M.roc_curve(spark.createDataFrame(rows, "y int, s double"), "y", "s").toPandas()
    assert sorted(got["threshold"], reverse=True) == [np.inf, 9.0, 8.0, 6.0, 5.0]


def test_one_class_and_empty(spark):
    one = spark.createDataFrame([(1, 0.5), (1, 0.7)], "y int, s double")
    assert M.roc_auc(one, "y", "s").first()["auc"] is None
    empty = spark.createDataFrame([], "y int, s double")
    assert M.roc_auc(empty, "y", "s").first()["auc"] is None


def test_no_predicted_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = M.classification_metrics(df, "y", "p").first()
    assert tuple(r) == (0.5, 0.0, 0.0, 0.0)
    cells = {(c["actual"], c["predicted"]): c["n"] for c in M.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_regression_metrics(spark):
    y, p = np.array([1.0, 2.0, 4.0]), np.array([1.5, 2.0, 3.0])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p, "q": y}))
    r = M.regression_metrics(df, "y", "p").first()
    mse = ((y - p) ** 2).mean()
    assert tuple(r) == pytest.approx((mse, np.sqrt(mse), np.abs(y - p).mean(), 1 - mse / y.var()))
    wide = {r["model"]: r for r in M.regression_metrics_wide(df, "y", {"a": "p", "b": "q"}).collect()}
    assert wide["a"]["mse"] == pytest.approx(mse) and wide["b"]["r2"] == 1.0
    flat = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, p double")
    assert M.regression_metrics(flat, "y", "p").first()["r2"] == 0.0


def test_selection_and_ranking(spark):
    table = spark.createDataFrame(
        [("a", "val", 2.0, 1.0, 0.5), ("b", "val", 1.0, 1.0, 0.5), ("a", "test", 0.1, 0.1, 0.9), ("b", "test", 3.0, 2.0, 0.1)],
        "model string, split string, rmse double, mae double, r2 double",
    )
    assert [r["model"] for r in E.rank_models(table).collect()] == ["b", "a"]
    assert E.select_then_test(table).first()["rmse"] == 3.0
    results = spark.createDataFrame(
        [("x", 0.50004, 0.7, 0.3), ("y", 0.5, 0.9, 0.3), ("z", 0.4, 0.9, 0.9)],
        "technique string, f1 double, recall double, precision double",
    )
    # equal after rounding, so recall decides
    assert [r["technique"] for r in E.rank_techniques(results).collect()] == ["y", "x", "z"]
    assert E.best_technique(results).first()["technique"] == "x"
