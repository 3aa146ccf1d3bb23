"""Experiment tables: balancing techniques, model comparison, tuning, selection."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabstudy.functions.columns import round_half_even
from tabstudy.functions.text import count_pair
from tabstudy.models.mlp import NeuralNet, NeuralNetModel, fit_together
from tabstudy.operators.metrics import (
    classification_metrics,
    regression_metrics_wide,
    roc_auc,
)
from tabstudy.operators.order import best_row, sort_rows
from tabstudy.session import hold_spread, small_table

Sampler = Callable[[DataFrame], DataFrame]

RANK_KEYS = ("f1", "recall", "precision")


@dataclass
class Fitted:
    model: Model
    seconds: float


def fit_all(models: Mapping[str, Estimator], train: DataFrame) -> dict[str, Fitted]:
    """Fit every named estimator on the same training rows, read into memory once."""
    train = hold_spread(train)
    try:
        fitted = {}
        for name, estimator in models.items():
            began = time.perf_counter()
            model = estimator.copy().fit(train)
            fitted[name] = Fitted(model, time.perf_counter() - began)
        return fitted
    finally:
        train.unpersist()


def score_all(models: Mapping[str, Fitted], df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """One prediction column per model, all in one projection over ``df``."""
    columns = {}
    for i, (name, fitted) in enumerate(models.items()):
        columns[name] = f"prediction_{i}"
        scored = fitted.model.copy().setPredictionCol(columns[name]).transform(df)
        df = scored.select(*df.columns, columns[name])
    return df, columns


def model_results(
    models: Mapping[str, Fitted], test: DataFrame, label: str = "label"
) -> DataFrame:
    """(model, mse, rmse, mae, r2, fit_seconds), all models scored in one pass."""
    scored, columns = score_all(models, test)
    table = regression_metrics_wide(scored, label, columns)
    seconds = [(name, float(f.seconds)) for name, f in models.items()]
    times = small_table(test.sparkSession, seconds, "model string, fit_seconds double")
    return table.join(times, "model")


def compare_models(
    models: Mapping[str, Estimator], train: DataFrame, test: DataFrame, label: str = "label"
) -> DataFrame:
    """Fit on ``train``, report on the untouched ``test``."""
    return model_results(fit_all(models, train), test, label)


def model_split_metrics(
    models: Mapping[str, Fitted], df: DataFrame, label: str = "label", split: str = "split"
) -> DataFrame:
    """(model, split, rmse, mae, r2) for every part of ``df``, scored once."""
    scored, columns = score_all(models, df)
    table = regression_metrics_wide(scored, label, columns, by=[split])
    return table.select("model", F.col(split).alias("split"), "rmse", "mae", "r2")


def rank_models(metrics: DataFrame, split: str = "val") -> DataFrame:
    """Models of one part, best first: RMSE, then MAE, then R²."""
    rows = metrics.where(F.col("split") == F.lit(split))
    return sort_rows(rows, ["rmse", "mae", "r2", "model"], [True, True, False, True])


def select_then_test(metrics: DataFrame, choose_on: str = "val", report_on: str = "test") -> DataFrame:
    """The model that is best on ``choose_on``, with its figures on ``report_on``."""
    best = rank_models(metrics, choose_on).limit(1).select("model")
    return metrics.where(F.col("split") == F.lit(report_on)).join(best, "model", "left_semi")


def rank_techniques(results: DataFrame, decimals: int = 3) -> DataFrame:
    """Techniques by F1, recall, precision, rounded before they are compared."""
    rounded = results.withColumns({c: round_half_even(c, decimals) for c in RANK_KEYS})
    return sort_rows(rounded, [*RANK_KEYS, "technique"], [False, False, False, True])


def best_technique(results: DataFrame, by: Sequence[str] = ("f1",)) -> DataFrame:
    return best_row(results, [*by, "technique"], [False] * len(by) + [True])


def balancing(
    train: DataFrame,
    evaluation: DataFrame,
    samplers: Mapping[str, Sampler | str | None],
    classifier: Callable[[], Estimator],
    label: str = "label",
    with_auc: bool = False,
) -> tuple[DataFrame, dict[str, Model]]:
    """Result table and fitted models of one classifier per resampled training set.

    (technique, accuracy, precision, recall, f1[, auc, iterations, loss], n0, n1, train_rows,
    fit_seconds). Samplers only ever see ``train``; ``evaluation`` is scored as it is. In place of a sampler, the name of a
    column of ``train`` with row weights (``resampling_weights``) fits the classifier on the same rows in memory.
    """
    spark = train.sparkSession
    train = hold_spread(train)
    evaluation = evaluation.persist(StorageLevel.MEMORY_AND_DISK)
    rows, fitted = [], {}
    try:
        for name, sampler in samplers.items():
            estimator = classifier()
            drawn = callable(sampler)
            sample = hold_spread(sampler(train)) if drawn else train
            times = F.lit(1)
            if isinstance(sampler, str):
                estimator.setWeightCol(sampler)
                times = F.col(sampler).cast("bigint")
            counts = [F.coalesce(F.sum(F.when(c, times)), F.lit(0)) for c in (F.col(label) == 0, F.col(label) == 1)]
            n0, n1, n = sample.agg(*counts, F.sum(times)).first()
            began = time.perf_counter()
            model = estimator.fit(sample)
            seconds = time.perf_counter() - began
            if drawn:
                sample.unpersist()
            scored = model.transform(evaluation)
            m = classification_metrics(scored, label, model.getPredictionCol()).first()
            row = {"technique": name, **m.asDict()}
            if with_auc:
                row["auc"] = roc_auc(positive_scores(model, scored), label, "score").first()["auc"]
                row["iterations"], row["loss"] = _convergence(model)
            rows.append({**row, "n0": n0, "n1": n1, "train_rows": n, "fit_seconds": seconds})
            fitted[name] = model
    finally:
        train.unpersist()
        evaluation.unpersist()
    names = list(rows[0])
    kinds = {"technique": "string", "iterations": "int", "n0": "bigint", "n1": "bigint", "train_rows": "bigint"}
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in names)
    return small_table(spark, [tuple(r[c] for c in names) for r in rows], schema), fitted


def positive_scores(model: Model, scored: DataFrame, output: str = "score") -> DataFrame:
    """Probability of class 1 as a plain column, whichever kind the model writes."""
    from pyspark.ml.functions import vector_to_array

    column = model.probability if isinstance(model, NeuralNetModel) else model.getProbabilityCol()
    if scored.schema[column].dataType.typeName() == "double":
        return scored.withColumn(output, F.col(column))
    return scored.withColumn(output, F.get(vector_to_array(column), F.lit(1)))


def _convergence(model: Model) -> tuple[int, float]:
    if isinstance(model, NeuralNetModel):
        return model.epochs, float(model.rows[-1][1])
    history = model.summary.objectiveHistory
    return model.summary.totalIterations, float(history[-1])


def balance_counts_text(results: DataFrame) -> DataFrame:
    """(technique, counts as ``n0 / n1``, precision, recall, f1)."""
    pair = count_pair(F.col("n0"), F.col("n1"))
    return results.select("technique", pair.alias("counts"), "precision", "recall", "f1")


def tuning(
    configs: Mapping[str, NeuralNet], train: DataFrame, validation: DataFrame, label_sd: float = 1.0
) -> tuple[DataFrame, dict[str, NeuralNetModel]]:
    """(config, epochs, train_mse, val_mse, val_rmse, seconds): every configuration trained and timed.

    Configurations that see the same rows are trained together, in one scan per epoch; ``seconds`` is when each was done.
    """
    fitted: dict[str, NeuralNetModel] = {}
    for net in configs.values():
        together = {n: c for n, c in configs.items() if n not in fitted and c.shares_rows(net)}
        fitted |= fit_together(together, train, validation, label_sd) if together else {}
    rows = []
    for name in configs:
        last = fitted[name].rows[-1]
        rows.append((name, fitted[name].epochs, last[1], last[2], last[3], fitted[name].fit_seconds))
    schema = "config string, epochs int, train_mse double, val_mse double, val_rmse double, seconds double"
    return small_table(train.sparkSession, rows, schema), fitted


def histories(models: Mapping[str, NeuralNetModel], spark: SparkSession) -> DataFrame:
    """Training curves of several networks in one table."""
    rows = [(name, *r[:4]) for name, m in models.items() for r in m.rows]
    schema = "series string, epoch int, train_loss double, val_loss double, val_rmse double"
    return small_table(spark, rows, schema)


def test_metrics(model: Model, test: DataFrame, label: str = "label") -> DataFrame:
    """(accuracy, precision, recall, f1, auc) of the chosen classifier on the test rows."""
    scored = model.transform(test)
    auc = roc_auc(positive_scores(model, scored), label, "score").first()["auc"]
    return classification_metrics(scored, label, model.getPredictionCol()).withColumn("auc", F.lit(auc))

