"""Iterative solvers against closed forms: ridge by LSQR, logistic regression by SAGA."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from tabstudy.models import iterative
from tabstudy.models.iterative import LogisticSAGA, RidgeLSQR


VECTOR_AND_LABEL = T.StructType().add("features", VectorUDT()).add("label", "double")


def vectors(spark, x, y):
    frame = pd.DataFrame({"id": range(len(y)), "x": list(x), "label": y})
    return spark.createDataFrame(frame).withColumn("features", array_to_vector("x")).drop("x")


def solved(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    return np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)


@pytest.mark.parametrize("lost", [iterative.LOST_DIGITS, 3.0])
def test_lsqr_equals_normal_equations(spark, monkeypatch, lost):
    """With scales three digits apart and far from the origin; also when it starts again every few steps."""
    monkeypatch.setattr(iterative, "LOST_DIGITS", lost)
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 6)) @ np.diag(10.0 ** np.linspace(0, -2, 6)) + 5
    y = x @ rng.normal(size=6) + rng.normal(size=200)
    model = RidgeLSQR(alpha=0.5).fit(vectors(spark, x, y))
    want = solved(x, y, 0.5)
    np.testing.assert_allclose(model.coefficients, want, rtol=1e-6, atol=1e-8)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-8)


def test_lsqr_takes_wide_sparse_rows(spark):
    """5000 slots, a dense row among sparse ones, nulls left out; scores agree with the coefficients."""
    rng = np.random.default_rng(2)
    x = np.zeros((60, 5000))
    for row in x:
        row[rng.choice(5000, 4, replace=False)] = rng.normal(size=4)
    y = rng.normal(size=60)
    rows = [(Vectors.sparse(5000, np.flatnonzero(r), r[r != 0]), float(v)) for r, v in zip(x, y)]
    rows[7] = (Vectors.dense(x[7]), float(y[7]))
    df = spark.createDataFrame([*rows, (None, 1.0), (rows[0][0], None)], VECTOR_AND_LABEL)
    model = RidgeLSQR().fit(df)
    want = solved(x, y, 1.0)
    np.testing.assert_allclose(model.coefficients, want, atol=1e-7)
    scores = model.transform(df.where("features IS NOT NULL AND label IS NOT NULL")).select("label", "prediction").toPandas()
    expected = dict(zip(y, x @ want + (y.mean() - x.mean(0) @ want)))
    np.testing.assert_allclose(scores["prediction"], [expected[v] for v in scores["label"]], atol=1e-6)


def test_lsqr_defined_cases(spark):
    flat = RidgeLSQR().fit(vectors(spark, np.arange(6.0).reshape(3, 2), np.ones(3)))
    assert flat.coefficients.tolist() == [0.0, 0.0] and flat.intercept == 1.0
    with pytest.raises(ValueError, match="no rows"):
        RidgeLSQR().fit(vectors(spark, np.ones((1, 1)), np.ones(1)).limit(0))


@pytest.mark.parametrize("shard_rows", [25_000, 150])
def test_saga_equals_newton(spark, monkeypatch, shard_rows):
    """One shard, and several whose weights are averaged, end at the same optimum."""
    monkeypatch.setattr(iterative, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 2))
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -2.0] - 0.7)))).astype(float)
    design, w, penalty = np.c_[x, np.ones(400)], np.zeros(3), np.diag([1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ w))
        w -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, design.T @ (p - y) + penalty @ w)
    df = vectors(spark, x, y)
    model = LogisticSAGA(key=["id"], tol=1e-6).fit(df)
    np.testing.assert_allclose([*model.coefficients, model.intercept], w, atol=1e-4)
    assert 1 < model.getOrDefault("passes") < 500
    scored = df.select("id", model.probability().alias("p")).orderBy("id").toPandas()["p"]
    np.testing.assert_allclose(scored, 1 / (1 + np.exp(-design @ w)), atol=1e-4)
    assert [r[0] for r in model.transform(df).orderBy("id").select("prediction").collect()] == (scored > 0.5).astype(float).tolist()


def test_saga_stops_and_leaves_nulls_out(spark):
    df = spark.createDataFrame(
        [(1, Vectors.dense([1.0]), 1.0), (2, Vectors.dense([-1.0]), 0.0), (3, None, 1.0), (4, Vectors.dense([5.0]), None)],
        T.StructType([T.StructField("id", T.LongType()), *VECTOR_AND_LABEL.fields]),
    )
    model = LogisticSAGA(key=["id"], maxIter=2, tol=0.0).fit(df)
    assert model.getOrDefault("passes") == 2 and model.coefficients[0] > 0
    with pytest.raises(ValueError, match="no rows"):
        LogisticSAGA(key=["id"]).fit(df.limit(0))


def test_saga_shards_abreast_take_their_own_steps():
    """Shards of uneven sizes, stepped through together, end where each ends alone, row by row."""
    rng = np.random.default_rng(6)
    sizes, n, rate, penalty = [7, 1, 30, 30, 12], 80, 0.2, 0.01
    xs = [np.c_[rng.normal(size=(m, 3)), np.ones(m)] for m in sizes]
    ys = [rng.integers(0, 2, m).astype(float) for m in sizes]
    seens = [rng.normal(size=m) for m in sizes]
    orders, start, mean = [rng.permutation(m) for m in sizes], rng.normal(size=4), rng.normal(size=4)
    ats, weights = iterative._saga_steps(xs, ys, seens, orders, start, mean, n, rate, penalty)
    for x, y, seen, order, at, own in zip(xs, ys, seens, orders, ats, weights):
        w, g, seen = start.copy(), mean.copy(), seen.copy()
        for i in order:
            new = 1 / (1 + np.exp(-(x[i] @ w))) - y[i]
            change = (new - seen[i]) * x[i]
            w -= rate * (change + g + penalty * np.append(w[:-1], 0.0))
            g += change / n
            seen[i] = new
        np.testing.assert_allclose(own, w, rtol=1e-9)
        np.testing.assert_allclose(at, seen, rtol=1e-9)


def test_saga_tasks_do_not_grow_with_the_shards(spark, monkeypatch):
    """Many small shards share the steps of a few tasks, and every row is in one of them."""
    monkeypatch.setattr(iterative, "SHARD_ROWS", 10)
    rng = np.random.default_rng(8)
    ran, epoch = [], iterative._epoch

    def counted(*args):
        out = epoch(*args)
        ran.append((out.count(), out.rdd.getNumPartitions()))
        return out

    monkeypatch.setattr(iterative, "_epoch", counted)
    LogisticSAGA(key=["id"], maxIter=1).fit(vectors(spark, rng.normal(size=(900, 1)), rng.integers(0, 2, 900).astype(float)))
    cores = spark.sparkContext.defaultParallelism
    assert len(ran) == 2 and all(shards >= 90 and tasks <= cores for shards, tasks in ran)
