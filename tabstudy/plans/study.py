"""The whole study of one table: profile, balancing experiment, model comparison.

``python -m tabstudy.plans.study fares.csv out/`` reads the fares schema and writes five
report documents. The functions take any table and column roles.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.ml import Estimator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from tabstudy.functions.columns import label_of
from tabstudy.models.linear import Logistic, Ridge
from tabstudy.models.mlp import NeuralNet
from tabstudy.models.target import ScaledTarget, label_scale
from tabstudy.models.trees import boosting, forest
from tabstudy.operators import features as FE, profile as P, resample as R
from tabstudy.operators.keyed import number_copies
from tabstudy.operators.split import assign_splits, split_metadata, take_split
from tabstudy.plans import experiment as E
from tabstudy.session import build_session, hold_spread
from tabstudy.sources.tables import (
    FARES_SCHEMA,
    console_table,
    read_csv,
    round_floats,
    write_json_document,
)


@dataclass(frozen=True)
class Roles:
    """Which column plays which part. Without a key, equal rows are numbered to get one.

    ``max_categories`` bounds the values of a categorical column; one that has more is refused.
    """

    numeric: Sequence[str]
    categorical: Sequence[str]
    target: str
    label: str
    positive: object
    max_categories: int
    key: Sequence[str] = ()


FARES = Roles(
    numeric=("duration", "days_left"),
    categorical=(
        "airline",
        "source_city",
        "departure_time",
        "stops",
        "arrival_time",
        "destination_city",
        "class",
    ),
    target="price",
    label="class",
    positive="Business",
    max_categories=10_000,
    key=("_c0",),
)


def keyed_rows(df: DataFrame, roles: Roles) -> tuple[DataFrame, list[str]]:
    """The columns of the study and those of them that identify a row."""
    columns = [*roles.numeric, *roles.categorical, roles.target]
    if roles.key:
        return df.select(*roles.key, *columns), list(roles.key)
    return number_copies(df.select(*columns)), [*columns, "copy_no"]


def check_categories(df: DataFrame, columns: Sequence[str], most: int) -> None:
    """Refuse identifiers as categories: a vocabulary lives on the driver and in every model."""
    found = P.approximate_distinct_counts(df, columns).where(F.col("cardinality") > most).collect()
    if found:
        raise ValueError(f"too many values for a category: {[r['column'] for r in found]}; drop them first")


def profile_tables(df: DataFrame, roles: Roles) -> dict[str, DataFrame]:
    """Quality counts, shares, outliers, summary and correlation."""
    numbers = [*roles.numeric, roles.target]
    rows = df.drop(*roles.key)
    return {
        "nulls": P.null_counts(rows),
        "duplicates": P.duplicate_count(rows),
        "categories": P.categorical_profile(df, roles.categorical),
        "dominant": P.dominant_categories(df, roles.categorical),
        "outliers": P.iqr_report(df, numbers),
        "summary": P.describe(df, numbers),
        "correlation": P.correlation(df, numbers),
        "group_means": P.group_means(df, roles.categorical[0], roles.target),
    }


def _smote_vectors(train: DataFrame, key: str, k: int) -> DataFrame:
    arrays = train.select(key, vector_to_array("features").alias("x"), "label")
    out = R.smote(arrays, "label", key, "x", k)
    number = F.coalesce(F.col("draw") + 1, F.lit(0))
    return out.select(key, array_to_vector("x").alias("features"), "label", number.alias("copy"))


def balancing_study(
    df: DataFrame,
    roles: Roles,
    holdout: Sequence[float] = (0.2,),
    names: Sequence[str] = ("train", "val"),
    drop_first: bool = True,
    classifier=lambda: Logistic(maxIter=1000),
    with_auc: bool = False,
    techniques: Sequence[str] = ("none", "oversample", "undersample"),
    neighbours: int = 5,
):
    """Result table, fitted models and encoded parts of the balancing experiment.

    Techniques: none, oversample, undersample, bootstrap (weighted), smote.
    """
    check_categories(df, roles.categorical, roles.max_categories)
    rows, key = keyed_rows(df, roles)
    rows = rows.withColumn("label", label_of(roles.label, roles.positive))
    parts = assign_splits(rows, key, holdout, names, stratify="label")
    cats = [c for c in roles.categorical if c != roles.label]
    fitted = FE.preprocessor(roles.numeric, cats, drop_first=drop_first, impute=not drop_first).fit(
        take_split(parts, names[0])
    )
    encoded = {n: FE.encode(fitted, take_split(parts, n)).select(*key, "label", "features") for n in names}
    samplers = {
        "none": lambda d: R.keep_all(d, copies="copy"),
        "oversample": lambda d: R.random_oversample(d, "label", key, copies="copy"),
        "undersample": lambda d: R.random_undersample(d, "label", key, copies="copy"),
        "bootstrap": lambda d: R.weighted_bootstrap(d, "label", key, copies="copy"),
        "smote": lambda d: _smote_vectors(d, key[0], neighbours),
    }
    chosen = {name: samplers[name] for name in techniques}
    train = encoded[names[0]]
    if hasattr(classifier(), "setWeightCol"):  # draws become weights of the same rows, synthetic points stay rows
        weighted = [name for name in techniques if name not in ("none", "smote")]
        train = R.resampling_weights(train, "label", key, weighted)
        chosen |= {name: name for name in weighted} | ({"none": None} if "none" in chosen else {})
    table, models = E.balancing(train, encoded[names[1]], chosen, classifier, with_auc=with_auc)
    return table, models, encoded


def default_models(key: Sequence[str]) -> dict[str, Estimator]:
    return {
        "neural net": ScaledTarget(NeuralNet(hidden=(128, 64, 32), epochs=40, key=key)),
        "ridge": Ridge(alpha=1.0),
        "forest": forest(trees=100, depth=15, key=key),
        "boosting": boosting(rounds=100, depth=6, rate=0.1),
    }


def target_study(
    df: DataFrame, roles: Roles, models: Mapping[str, Estimator] | None = None, stratify: bool = False
) -> dict[str, object]:
    """Leak-free split and encoding, every model fitted on train, compared on test.

    Tables: ``meta`` (sizes), ``results`` (test), ``by_split`` (all parts), ``chosen`` (best on
    validation, reported on test); and the fitted models.
    """
    check_categories(df, roles.categorical, roles.max_categories)
    rows, key = keyed_rows(df, roles)
    rows = rows.withColumn("label", F.col(roles.target).cast("double"))
    parts = assign_splits(rows, key, stratify=roles.label if stratify else None)
    train_rows = take_split(parts, "train")
    fitted = FE.preprocessor(roles.numeric, roles.categorical, drop_first=not stratify).fit(train_rows)
    encoded = hold_spread(FE.encode(fitted, parts).select(*key, "label", "features", "split"))
    train = take_split(encoded, "train")
    models = E.fit_all(models or default_models(key), train)
    by_split = E.model_split_metrics(models, encoded)
    return {
        "meta": split_metadata(parts, FE.encoded_width(encoded)),
        "results": E.model_results(models, take_split(encoded, "test")),
        "by_split": by_split,
        "chosen": E.select_then_test(by_split),
        "models": models,
        "encoded": encoded,
    }


def tuning_study(encoded: DataFrame, key: Sequence[str], epochs: int = 30, batch_norm: bool = True):
    """Three configurations of the deep network on the encoded parts, all trained and measured."""
    train = take_split(encoded, "train")
    mean, sd = label_scale(train, "label")
    scale = lambda d: d.withColumn("label", (F.col("label") - F.lit(mean)) / F.lit(sd))
    common = dict(
        epochs=epochs,
        batch_size=512,
        l2=0.0,
        weight_decay=1e-5,
        batch_norm=batch_norm,
        dropout=0.1 if batch_norm else 0.0,
        patience=epochs,
        key=tuple(key),
    )
    configs = {
        "128-64-32, lr 0.001": NeuralNet(hidden=(128, 64, 32), **common),
        "128-64-32, lr 0.005": NeuralNet(hidden=(128, 64, 32), lr=0.005, **common),
        "256-128-64, lr 0.001": NeuralNet(hidden=(256, 128, 64), **common),
    }
    return E.tuning(configs, scale(train), scale(take_split(encoded, "val")), sd)


def run(df: DataFrame, roles: Roles, out: str) -> None:
    """All reports of the study as documents in the folder ``out`` on the driver."""
    folder = Path(out)
    folder.mkdir(parents=True, exist_ok=True)
    write_json_document(P.nested_profile(df, roles.categorical), str(folder / "categories.json"))
    balance, _, _ = balancing_study(df, roles)
    write_json_document(round_floats(balance, 4), str(folder / "balancing.json"))
    study = target_study(df, roles)
    write_json_document(study["meta"].first().asDict(), str(folder / "splits.json"))
    write_json_document(round_floats(study["results"], 4), str(folder / "models.json"))
    tuned, _ = tuning_study(study["encoded"], roles.key)
    write_json_document(round_floats(tuned, 4), str(folder / "tuning.json"))
    for table in (balance, study["results"], study["by_split"], tuned):
        console_table(table)
    study["encoded"].unpersist()


if __name__ == "__main__":
    session = build_session("tabstudy")
    run(read_csv(session, sys.argv[1], FARES_SCHEMA), FARES, sys.argv[2])
    session.stop()
