from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tabstudy.models.linear import Ridge
from tabstudy.models.mlp import NeuralNet
from tabstudy.models.target import ScaledTarget
from tabstudy.models.trees import forest
from tabstudy.plans import experiment as E, study


def test_balancing_with_every_technique(small_fares):
    rows = small_fares.withColumn("duration", F.col("duration") + F.when(F.col("class") == "Business", 3.0).otherwise(0.0))
    techniques = ("none", "undersample", "oversample", "bootstrap", "smote")
    table, models, encoded = study.balancing_study(
        rows, study.FARES, (0.3, 0.5), ("train", "val", "test"), drop_first=False, techniques=techniques
    )
    got = {r["technique"]: r for r in table.collect()}
    n0, n1 = got["none"]["n0"], got["none"]["n1"]
    assert n0 > n1
    assert (got["oversample"]["n0"], got["oversample"]["n1"]) == (n0, n0) == (got["smote"]["n0"], got["smote"]["n1"])
    assert (got["undersample"]["n0"], got["undersample"]["n1"]) == (n1, n1)
    assert got["bootstrap"]["train_rows"] == n0 + n1
    # rebalancing trades precision for recall
    assert got["oversample"]["recall"] > got["none"]["recall"]
    best = E.best_technique(table).first()["technique"]
    test = E.test_metrics(models[best], encoded["test"]).first()
    assert 0.5 < test["auc"] <= 1
    assert E.balance_counts_text(table).where("technique = 'none'").first()["counts"] == f"{n0} / {n1}"


def test_network_balancing_with_early_stopping_on_drawn_rows(small_fares):
    net = lambda: NeuralNet(
        hidden=(16, 8), loss="logloss", epochs=4, early_stopping=True, patience=8, key=["_c0", "copy"]
    )
    table, models, _ = study.balancing_study(
        small_fares,
        study.FARES,
        (0.4, 0.5),
        ("train", "val", "test"),
        drop_first=False,
        classifier=net,
        with_auc=True,
        techniques=("none", "oversample", "bootstrap"),
    )
    assert {"auc", "iterations", "loss"} <= set(table.columns)
    assert all(0 <= r["auc"] <= 1 and r["iterations"] == 4 for r in table.collect())


def test_target_study_and_reports(spark, small_fares, tmp_path):
    models = {
        "ridge": Ridge(),
        "forest": forest(trees=5, depth=8),
        "neural net": ScaledTarget(NeuralNet(hidden=(32, 16), epochs=10, key=["_c0"], shards=2)),
    }
    result = study.target_study(small_fares, study.FARES, models)
    assert tuple(result["meta"].first()) == (30, 3500, 750, 750)
    assert {(r["model"], r["split"]) for r in result["by_split"].collect()} == {
        (m, s) for m in models for s in ("train", "val", "test")
    }
    chosen = result["chosen"].collect()
    assert len(chosen) == 1 and chosen[0]["split"] == "test"
    tuned, _ = study.tuning_study(result["encoded"], ["_c0"], epochs=2)
    assert tuned.count() == 3
    stratified = study.target_study(small_fares, study.FARES, {"ridge": Ridge()}, stratify=True)
    assert stratified["meta"].first()["num_features"] == 37


def test_table_without_a_key(small_fares):
    roles = study.Roles(("duration", "days_left"), ("class",), "price", "class", "Business", 1000)
    doubled = small_fares.union(small_fares)
    meta = study.target_study(doubled, roles, {"ridge": Ridge()})["meta"].first()
    assert meta["train_samples"] + meta["val_samples"] + meta["test_samples"] == 10_000


def test_profile_tables(small_fares):
    tables = study.profile_tables(small_fares, study.FARES)
    assert tables["duplicates"].first()[0] == 0
    assert all(t.count() > 0 for t in tables.values())
    assert json.dumps([r.asDict() for r in tables["outliers"].collect()])


def test_an_identifier_is_no_category(small_fares):
    roles = study.Roles(("duration",), ("_c0",), "price", "class", "Business", 1000)
    with pytest.raises(ValueError, match="_c0"):
        study.check_categories(small_fares, roles.categorical, roles.max_categories)
