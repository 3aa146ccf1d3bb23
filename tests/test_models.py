from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from fares import MARGINALS
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tabstudy.models import network
from tabstudy.models.linear import Logistic, Ridge
from tabstudy.models.mlp import NeuralNet
from tabstudy.models.target import ScaledTarget
from tabstudy.models.trees import boosting, forest
from tabstudy.operators import features as FE
from tabstudy.operators.metrics import regression_metrics
from tabstudy.operators.split import assign_splits, take_split
from tabstudy.plans import experiment as E

NUMERIC = ["duration", "days_left"]
CATEGORIES = list(MARGINALS)


@pytest.fixture(scope="module")
def prepared(small_fares):
    rows = small_fares.withColumn("label", F.col("price").cast("double"))
    parts = assign_splits(rows, ["_c0"])
    fitted = FE.preprocessor(NUMERIC, CATEGORIES, drop_first=True).fit(take_split(parts, "train"))
    keep = ["_c0", "label", "features"]
    out = {n: FE.encode(fitted, take_split(parts, n)).select(*keep).cache() for n in ("train", "val", "test")}
    return out, fitted


def test_encoded_widths(small_fares):
    fitted = FE.preprocessor(NUMERIC, CATEGORIES, drop_first=True).fit(small_fares)
    encoded = FE.encode(fitted, small_fares)
    assert FE.encoded_width(encoded) == 30
    names = FE.feature_names(encoded)
    assert names[:2] == NUMERIC and len(set(names)) == 30
    assert "airline_Vistara" in names and "airline_AirAsia" not in names
    assert FE.encoded_width(FE.encode(FE.preprocessor(NUMERIC, CATEGORIES).fit(small_fares), small_fares)) == 37
    no_class = [c for c in CATEGORIES if c != "class"]
    assert FE.encoded_width(FE.encode(FE.preprocessor(NUMERIC, no_class, impute=True).fit(small_fares), small_fares)) == 35


def test_unseen_category(spark):
    train = spark.createDataFrame([("a",), ("b",), ("c",)], "v string")
    other = spark.createDataFrame([("a",), ("z",)], "v string")
    kept = FE.dense(FE.encode(FE.preprocessor([], ["v"]).fit(train), other))
    assert [list(r["x"]) for r in kept.collect()] == [[1.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    with pytest.raises(Exception, match="Unseen label"):
        FE.encode(FE.preprocessor([], ["v"], drop_first=True).fit(train), other).collect()


def test_constant_column_and_imputation(spark):
    df = spark.createDataFrame([(1.0, 7.0, "b"), (2.0, 7.0, "a"), (3.0, 7.0, None), (5.0, 7.0, "b"), (None, 7.0, "a")], "x double, c double, s string")
    z = FE.ZScore(inputCols=["c"], outputCols=["z"]).fit(df).transform(df)
    assert {r["z"] for r in z.collect()} == {0.0}
    filled = FE.MedianImputer(inputCols=["x"], outputCols=["f"]).fit(df).transform(df)
    assert filled.where("x IS NULL").first()["f"] == 2.5
    mode = FE.ModeImputer(inputCols=["s"], outputCols=["f"]).fit(df).transform(df)
    assert mode.where("s IS NULL").first()["f"] == "a"


def test_statistics_come_from_training_rows_only(small_fares):
    train = small_fares.where("_c0 % 5 <> 0")
    a = FE.preprocessor(NUMERIC, ["class"]).fit(train)
    b = FE.preprocessor(NUMERIC, ["class"]).fit(train)
    other = small_fares.withColumn("duration", F.col("duration") * 100)
    x = FE.dense(FE.encode(a, other)).agg(F.max(F.get("x", F.lit(0)))).first()[0]
    y = FE.dense(FE.encode(b, other)).agg(F.max(F.get("x", F.lit(0)))).first()[0]
    assert x == y and a.stages[0].getOrDefault("means") == b.stages[0].getOrDefault("means")


def test_fitted_preprocessor_can_be_saved(prepared, small_fares, tmp_path):
    _, fitted = prepared
    fitted.write().overwrite().save(str(tmp_path / "pre"))
    again = PipelineModel.load(str(tmp_path / "pre"))
    a, b = (FE.dense(FE.encode(m, small_fares)).agg(F.sum(F.aggregate("x", F.lit(0.0), lambda s, v: s + v))).first()[0] for m in (fitted, again))
    assert a == pytest.approx(b)


def matrix(df):
    p = FE.dense(df).select("x", "label").toPandas()
    return np.stack(p["x"].to_numpy()), p["label"].to_numpy()


def test_ridge_equals_normal_equations(prepared):
    parts, _ = prepared
    x, y = matrix(parts["train"])
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + np.eye(30), xc.T @ yc)
    model = Ridge(alpha=1.0).fit(parts["train"])
    np.testing.assert_allclose(model.coefficients.toArray(), want, rtol=1e-6, atol=1e-6)
    assert model.intercept == pytest.approx(y.mean() - x.mean(0) @ want, rel=1e-9)


def test_logistic_equals_newton(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 3))
    y = (rng.random(800) < 1 / (1 + np.exp(-(x @ [1.0, -2.0, 0.5] - 0.7)))).astype(float)
    design = np.c_[x, np.ones(800)]
    w, penalty = np.zeros(4), np.diag([1.0, 1.0, 1.0, 0.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-design @ w))
        w -= np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + penalty, design.T @ (p - y) + penalty @ w)
    df = spark.createDataFrame(pd.DataFrame({"x": list(x), "label": y})).withColumn("features", array_to_vector("x"))
    model = Logistic(tol=1e-10).fit(df)
    np.testing.assert_allclose([*model.coefficients, model.intercept], w, atol=1e-5)


def test_weights_fit_what_copies_fit(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 2))
    frame = pd.DataFrame({"x": list(x), "label": (x[:, 0] + rng.normal(size=300) > 0.5).astype(float), "w": rng.integers(0, 4, 300)})
    df = spark.createDataFrame(frame).withColumn("features", array_to_vector("x"))
    copies = df.withColumn("i", F.explode(F.array_repeat(F.lit(1), F.col("w").cast("int"))))
    one = Logistic(tol=1e-12, weightCol="w").fit(df)
    two = Logistic(tol=1e-12).fit(copies)
    np.testing.assert_allclose([*one.coefficients, one.intercept], [*two.coefficients, two.intercept], atol=1e-6)


def test_forest_does_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(900, 3))
    frame = pd.DataFrame({"id": range(900), "x": list(x), "label": x[:, 0] * x[:, 1] + rng.normal(size=900)})
    df = spark.createDataFrame(frame).withColumn("features", array_to_vector("x"))
    learner = forest(trees=8, depth=6, key=["id"])
    learner.rows = 100  # nine random streams
    assert learner.dealt(df).rdd.getNumPartitions() == 9
    fits = [learner.fit(df.repartition(n)).transform(df).orderBy("id").toPandas()["prediction"] for n in (1, 7)]
    np.testing.assert_allclose(*fits, rtol=1e-9)
    other = forest(trees=8, depth=6, seed=1, key=["id"]).fit(df).transform(df).orderBy("id").toPandas()["prediction"]
    assert np.abs(other - fits[0]).max() > 1e-3


def test_boosting_is_least_squares_boosting(spark):
    """Against a hand-written loop of one-split trees on one feature, from the mean on."""
    rng = np.random.default_rng(6)
    x = rng.integers(0, 20, 600).astype(float)
    y = np.sin(x / 3) * 10 + rng.normal(size=600)

    def stump(r):
        best = max(((x <= c) for c in np.unique(x)[:-1]), key=lambda left: r[left].sum() ** 2 / left.sum() + r[~left].sum() ** 2 / (~left).sum())
        return np.where(best, r[best].mean(), r[~best].mean())

    f = np.full(600, y.mean())
    for _ in range(12):
        f = f + 0.1 * stump(y - f)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "label": y, "f": f}))
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = boosting(rounds=12, depth=1, rate=0.1).fit(df)
    got = model.transform(df).select("prediction", "f").toPandas()
    np.testing.assert_allclose(got["prediction"], got["f"], atol=1e-9)
    assert model.getNumTrees == 13 and model.treeWeights == [1.0] + [0.1] * 12
    none = boosting(rounds=0, depth=1).fit(df).transform(df).select("prediction").distinct().collect()
    assert [r["prediction"] for r in none] == pytest.approx([y.mean()])


@pytest.mark.parametrize("loss", ["mse", "logloss"])
@pytest.mark.parametrize("batch_norm", [False, True])
def test_gradient_by_finite_differences(loss, batch_norm):
    rng = np.random.default_rng(0)
    shape = network.Shape(4, (6, 5, 3), loss, batch_norm, l2=0.3)
    x, y = rng.normal(size=(20, 4)), (rng.random(20) < 0.5).astype(float)
    state = network.start_state(shape, 1)
    state["w"] += rng.normal(size=state["w"].size) * 0.1

    def objective(w):
        net = network.layers(shape, w, state["stats"].copy())
        _, out = network.gradient(shape, net, x, y)
        data = network.loss_sum(shape, out, y) / 20 * (0.5 if loss == "mse" else 1.0)
        return data + 0.3 / 20 / 2 * sum((layer["W"] ** 2).sum() for layer in net)

    grads, _ = network.gradient(shape, network.layers(shape, state["w"], state["stats"].copy()), x, y)
    flat = np.concatenate(
        [np.concatenate([g["W"].ravel(), g["b"], *([g["gain"], g["shift"]] if "gain" in g else [])]) for g in grads]
    )
    for i in rng.choice(state["w"].size, 40, replace=False):
        up, down = state["w"].copy(), state["w"].copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        assert flat[i] == pytest.approx((objective(up) - objective(down)) / 2e-6, abs=2e-6)


def test_models_in_quality_order(prepared):
    parts, _ = prepared
    models = {
        "ridge": Ridge(),
        "forest": forest(trees=10, depth=10),
        "boosting": boosting(rounds=20, depth=4),
        "net": ScaledTarget(NeuralNet(epochs=30, key=["_c0"], shards=2)),
    }
    fitted = E.fit_all(models, parts["train"])
    r2 = {r["model"]: r["r2"] for r in E.model_results(fitted, parts["test"]).collect()}
    assert r2["forest"] > r2["ridge"] and r2["net"] > r2["ridge"] and r2["boosting"] > r2["ridge"]
    assert all(f.seconds > 0 for f in fitted.values())


def test_training_repeats_and_reports_real_history(prepared):
    parts, _ = prepared
    net = NeuralNet(hidden=(16, 8), epochs=3, key=["_c0"], shards=3)
    scaled = {n: parts[n].withColumn("label", (F.col("label") - 20000) / 20000) for n in ("train", "val")}
    a = net.fit_with_history(scaled["train"], scaled["val"], label_sd=20000.0)
    b = net.fit_with_history(scaled["train"].repartition(5), scaled["val"], label_sd=20000.0)
    np.testing.assert_allclose(a.state["w"], b.state["w"], rtol=1e-5, atol=1e-7)
    last = a.rows[-1]
    mse = regression_metrics(a.transform(scaled["val"]), "label", "prediction").first()["mse"]
    assert last[2] == pytest.approx(mse, rel=1e-3)
    assert last[3] == pytest.approx(np.sqrt(mse) * 20000, rel=1e-3)
    assert a.history(parts["train"]).count() == 3


def test_many_shards_are_merged_in_groups(prepared):
    parts, _ = prepared
    scaled = parts["train"].withColumn("label", (F.col("label") - 20000) / 20000)
    model = NeuralNet(hidden=(8,), epochs=2, key=["_c0"], shards=40).fit(scaled)
    assert model.rows[1][1] < model.rows[0][1]


def test_shards_follow_from_the_rows_alone(prepared, monkeypatch):
    """One input partition or nine, whatever the cores: the same shards, and states merged in their order, bit by bit."""
    from tabstudy.models import mlp

    parts, _ = prepared
    scaled = parts["train"].withColumn("label", (F.col("label") - 20000) / 20000)
    monkeypatch.setattr(mlp, "SHARD_ROWS", 80)
    net = NeuralNet(hidden=(8,), epochs=2, key=["_c0"])
    assert net._shards(scaled) == -(-scaled.count() // 80) > mlp.MERGE_FAN
    one, nine = (net.fit(scaled.repartition(n)) for n in (1, 9))
    assert one.state["w"].tolist() == nine.state["w"].tolist()


def test_networks_trained_together_are_those_trained_alone(prepared, monkeypatch):
    from tabstudy.models import mlp

    parts, _ = prepared
    train, val = (parts[n].withColumn("label", (F.col("label") - 20000) / 20000) for n in ("train", "val"))
    nets = {
        "short": NeuralNet(hidden=(16,), epochs=2, key=["_c0"]),
        "fast": NeuralNet(hidden=(16, 8), epochs=4, lr=0.005, batch_size=100, key=["_c0"]),
        "deep": NeuralNet(hidden=(12, 8, 4), epochs=3, batch_norm=True, dropout=0.2, key=["_c0"]),
        "stale": NeuralNet(hidden=(4,), epochs=9, lr=1e-7, tol=10.0, patience=1, key=["_c0"]),
    }
    alone = {name: net.fit_with_history(train, val) for name, net in nets.items()}
    passes = []
    epoch = mlp._one_epoch
    monkeypatch.setattr(mlp, "_one_epoch", lambda *a: passes.append(len(a[2])) or epoch(*a))
    together = mlp.fit_together(nets, train, val)
    assert passes == [4, 4, 2, 1]
    for name, model in together.items():
        assert model.state["w"].tolist() == alone[name].state["w"].tolist()
        for a, b in zip(model.rows, alone[name].rows, strict=True):
            assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-12)
    with pytest.raises(ValueError, match="agree"):
        mlp.fit_together({"a": nets["short"], "b": NeuralNet(key=["_c0"], seed=7)}, train)


def test_early_stopping_restores_the_best_state(prepared):
    parts, _ = prepared
    noise = parts["train"].withColumn("label", F.pmod(F.xxhash64("_c0"), F.lit(2)).cast("double"))
    net = NeuralNet(hidden=(8,), loss="logloss", epochs=30, early_stopping=True, patience=3, key=["_c0"], shards=1)
    model = net.fit(noise)
    assert model.epochs < 30


def test_tuning_trains_every_configuration(prepared):
    parts, _ = prepared
    train, val = (parts[n].withColumn("label", (F.col("label") - 20000) / 20000) for n in ("train", "val"))
    configs = {
        "a": NeuralNet(hidden=(16,), epochs=2, key=["_c0"]),
        "b": NeuralNet(hidden=(16,), epochs=2, lr=0.005, key=["_c0"]),
    }
    table, fitted = E.tuning(configs, train, val, 20000.0)
    rows = {r["config"]: r for r in table.collect()}
    assert rows["a"]["val_mse"] != rows["b"]["val_mse"] and rows["a"]["seconds"] != rows["b"]["seconds"]
    assert E.histories(fitted, parts["train"].sparkSession).count() == 4


def test_the_restored_state_is_the_best_one_measured(prepared):
    parts, _ = prepared
    train = parts["train"].withColumn("label", (F.col("label") - 20000) / 20000)
    net = NeuralNet(hidden=(8,), lr=0.2, epochs=12, early_stopping=True, patience=3, key=["_c0"], shards=1)
    model = net.fit(train)
    hold = assign_splits(train, ["_c0"], [0.1], ["fit", "hold"], None, "hold42").where("split = 'hold'")
    mse = regression_metrics(model.transform(hold), "label", "prediction").first()["mse"]
    losses = [r[2] for r in model.rows]
    assert mse == pytest.approx(min(losses), rel=1e-3)
    assert losses[-1] > min(losses)
