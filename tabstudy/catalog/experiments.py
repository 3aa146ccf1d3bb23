"""Whole experiments: balancing, model comparison, timing."""

from __future__ import annotations

import time

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabstudy.catalog.modelling import event_rows, part_rows, ridge_sql
from tabstudy.catalog.registry import Tables, bind
from tabstudy.catalog.sampling import plain_split_sql
from tabstudy.functions.columns import label_of
from tabstudy.models.linear import Logistic, Ridge
from tabstudy.models.mlp import NeuralNet
from tabstudy.models.trees import boosting, forest
from tabstudy.operators import features as FE, resample as R
from tabstudy.operators.split import assign_splits, take_split
from tabstudy.plans import experiment as E
from tabstudy.session import hold_spread

BALANCED_SQL = """WITH s AS (SELECT label, count(*) AS n FROM
    (SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label FROM orders) GROUP BY 1),
  t AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) - ceil(sum(n) * 0.2) AS BIGINT) AS take FROM s),
  q AS (SELECT label, (take * n) // total AS base, (take * n) % total AS rem, take FROM s, t),
  k AS (SELECT label, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, label) <= take - sum(base) OVER ()
    THEN 1 ELSE 0 END AS n FROM q),
  c AS (SELECT CAST(sum(n) FILTER (WHERE label = 0) AS BIGINT) AS n0, CAST(sum(n) FILTER (WHERE label = 1) AS BIGINT) AS n1
    FROM k)"""


@bind(
    "exp_01_balancing",
    BALANCED_SQL
    + """ SELECT 'none' AS technique, n0, n1, n0 + n1 AS train_rows, true AS optimal, true AS plausible FROM c
    UNION ALL SELECT 'oversample', greatest(n0, n1), greatest(n0, n1), 2 * greatest(n0, n1), true, true FROM c
    UNION ALL SELECT 'undersample', least(n0, n1), least(n0, n1), 2 * least(n0, n1), true, true FROM c""",
)
def balancing(t: Tables):
    """Logistic regression after each technique: the objective's gradient vanishes at the fitted coefficients.

    Metrics come from the untouched validation part.
    """
    train, table, models = balancing_table(t)
    slopes = largest_slopes(train, models)
    small = F.create_map(*[F.lit(x) for name, slope in slopes.items() for x in (name, slope < 1e-6)])
    plausible = F.lit(True)
    for metric in ("accuracy", "precision", "recall", "f1"):
        plausible = plausible & F.col(metric).between(0, 1)
    return table.select(
        "technique", "n0", "n1", "train_rows", small[F.col("technique")].alias("optimal"), plausible.alias("plausible")
    )


def largest_slopes(train, models) -> dict[str, float]:
    """Per model the largest slope of its penalised mean log loss (C = 1), 0 at the optimum; one pass for all of them."""
    rows = train.withColumn("x", vector_to_array("features"))
    sums, width = [], len(next(iter(models.values())).coefficients)
    for name, model in models.items():
        w = "1D" if name == "none" else name
        z = " + ".join([repr(float(model.intercept)) + "D", *[f"{float(c)!r}D * x[{j}]" for j, c in enumerate(model.coefficients)]])
        error = f"{w} * (1 / (1 + exp(-({z}))) - label)"
        sums += [f"sum({w})", f"sum({error})", *[f"sum({error} * x[{j}])" for j in range(width)]]
    found = rows.agg(*[F.expr(text) for text in sums]).first()
    slopes = {}
    for i, (name, model) in enumerate(models.items()):
        total, free, *bound = found[i * (width + 2) : (i + 1) * (width + 2)]
        slopes[name] = float(max(abs(free), *[abs(s + c) for s, c in zip(bound, model.coefficients)]) / total)
    return slopes


def balancing_table(t: Tables):
    """Training rows with weights, result table and models. Draws are weights, so all fits share the rows in memory."""
    orders = t.orders.withColumn("label", label_of("o_orderpriority", "1-URGENT"))
    parts = assign_splits(orders, ["o_orderkey"], holdout=(0.2,), names=("train", "val"), stratify="label")
    fitted = FE.preprocessor(["o_totalprice"], ["o_orderstatus"], drop_first=True).fit(take_split(parts, "train"))
    keep = ["o_orderkey", "label", "features"]
    train = FE.encode(fitted, take_split(parts, "train")).select(*keep)
    val = FE.encode(fitted, take_split(parts, "val")).select(*keep)
    drawn = ["oversample", "undersample"]
    train = hold_spread(R.resampling_weights(train, "label", ["o_orderkey"], drawn))
    samplers = {"none": None, **{name: name for name in drawn}}
    table, models = E.balancing(train, val, samplers, lambda: Logistic(maxIter=1000, tol=1e-9))
    return train, table, models


@bind("exp_01_balancing_network", "SELECT * FROM (VALUES ('none', true), ('bootstrap', true)) x(technique, valid)")
def balancing_network(t: Tables):
    """The network classifier with and without a weighted bootstrap, with AUC and final loss."""
    rows = event_rows(t)
    train, val = rows.where("event_id % 5 <> 0"), rows.where("event_id % 5 = 0")
    key = ["event_id", "copy"]  # a drawn row may repeat: its copy number completes the key
    samplers = {
        "none": lambda d: R.keep_all(d, copies="copy"),
        "bootstrap": lambda d: R.weighted_bootstrap(d, "label", ["event_id"], copies="copy"),
    }
    net = lambda: NeuralNet(
        hidden=(64, 32), loss="logloss", epochs=3, early_stopping=True, patience=8, key=key
    )
    table, _ = E.balancing(train, val, samplers, net, with_auc=True)
    valid = F.col("auc").between(0, 1) & (F.col("iterations") == 3) & (F.col("loss") > 0)
    return table.select("technique", valid.alias("valid"))


PARTS = "(SELECT p_partkey AS id, p_size::DOUBLE AS a, (p_partkey % 13)::DOUBLE AS b, p_retailprice AS y FROM part)"
SPLIT_PARTS = plain_split_sql(f"(SELECT id, a AS x1, b AS x2, y FROM {PARTS})", "'42|' || id", "x1, x2, y")
#: Ridge (alpha 1) fitted on the training part in closed form, and its errors on the test part.
RIDGE_ON_TEST = f"""WITH parts AS ({SPLIT_PARTS}), {ridge_sql("(SELECT x1 AS a, x2 AS b, y FROM parts WHERE split = 'train')", "1.0")[5:]},
  e AS (SELECT y, y - (my + wa * (a - ma) + wb * (b - mb)) AS off FROM (SELECT x1 AS a, x2 AS b, y FROM parts WHERE split = 'test'), s, w),
  m AS (SELECT avg(off * off) AS mse, avg(abs(off)) AS mae, 1 - sum(off * off) / (var_pop(y) * count(*)) AS r2 FROM e)"""


@bind(
    "exp_02_model_comparison",
    RIDGE_ON_TEST
    + """ SELECT 'ridge' AS model, round(sqrt(mse), 4) AS rmse, round(mae, 4) AS mae, round(r2, 6) AS r2, true AS consistent FROM m
    UNION ALL SELECT 'forest', NULL, NULL, NULL, true FROM m UNION ALL SELECT 'boosting', NULL, NULL, NULL, true FROM m""",
)
def model_comparison(t: Tables):
    """Three regressors on one split: ridge has the figures of its closed form, RMSE, MAE and R² of a row fit together."""
    rows = part_rows(t).withColumnRenamed("y", "label")
    parts = assign_splits(rows, ["id"])
    models = {"ridge": Ridge(), "forest": forest(trees=5, depth=5, key=["id"]), "boosting": boosting(rounds=4, depth=3)}
    test = take_split(parts, "test")
    table = E.compare_models(models, take_split(parts, "train"), test)
    spread = test.agg(F.var_pop("label")).first()[0]
    consistent = (
        (F.abs(F.col("rmse") * F.col("rmse") / F.col("mse") - 1) < 1e-9)
        & (F.col("mae") <= F.col("rmse"))
        & (F.abs(1 - F.col("mse") / F.lit(spread) - F.col("r2")) < 1e-6)
    )
    stated = F.col("model") == "ridge"
    figures = [F.when(stated, F.round(c, d)).alias(c) for c, d in (("rmse", 4), ("mae", 4), ("r2", 6))]
    return table.select("model", *figures, consistent.alias("consistent"))


@bind(
    "met_11_fit_seconds",
    ridge_sql(PARTS, "1.0")
    + """ SELECT 'ridge' AS model, true AS timed, round(avg(power(y - (my + wa * (a - ma) + wb * (b - mb)), 2)), 2) AS mse
    FROM d, s, w""",
)
def fit_seconds(t: Tables):
    """The time is that of a real fit: its error is the closed form's, and it does not exceed the time around it."""
    rows = part_rows(t).withColumnRenamed("y", "label")
    began = time.perf_counter()
    fitted = E.fit_all({"ridge": Ridge()}, rows)
    passed = time.perf_counter() - began
    timed = F.col("fit_seconds").between(1e-6, passed)
    return E.model_results(fitted, rows).select("model", timed.alias("timed"), F.round("mse", 2).alias("mse"))
