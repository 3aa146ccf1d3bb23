"""Classification and regression metrics as one-row or curve DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabstudy.operators.keyed import totals_before
from tabstudy.session import small_table

BUCKET_ROWS = 1_000_000  # scores per running-sum bucket
BUCKETS = (16, 10_000)


def _hits(label: str, predicted: str, positive: object) -> tuple[Column, Column, Column, Column]:
    y, p = F.col(label) == F.lit(positive), F.col(predicted) == F.lit(positive)
    return F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p), F.count_if(~y & ~p)


def accuracy(label: str, predicted: str) -> Column:
    return F.avg((F.col(label) == F.col(predicted)).cast("int"))


def precision(label: str, predicted: str, positive: object = 1) -> Column:
    tp, fp, _, _ = _hits(label, predicted, positive)
    return F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))


def recall(label: str, predicted: str, positive: object = 1) -> Column:
    tp, _, fn, _ = _hits(label, predicted, positive)
    return F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))


def f1(label: str, predicted: str, positive: object = 1) -> Column:
    tp, fp, fn, _ = _hits(label, predicted, positive)
    return F.coalesce(F.try_divide(2 * tp, 2 * tp + fp + fn), F.lit(0.0))


def classification_columns(label: str, predicted: str, positive: object = 1) -> list[Column]:
    return [
        accuracy(label, predicted).alias("accuracy"),
        precision(label, predicted, positive).alias("precision"),
        recall(label, predicted, positive).alias("recall"),
        f1(label, predicted, positive).alias("f1"),
    ]


def classification_metrics(
    df: DataFrame, label: str, predicted: str, positive: object = 1, by: Sequence[str] = ()
) -> DataFrame:
    """(by…, accuracy, precision, recall, f1); undefined ratios are 0."""
    return df.groupBy(*by).agg(*classification_columns(label, predicted, positive))


def confusion_matrix(df: DataFrame, label: str, predicted: str, classes: Sequence = (0, 1)) -> DataFrame:
    """(actual, predicted, n) for every pair of ``classes``, zero cells included."""
    cells = [
        F.struct(
            F.lit(a).alias("actual"),
            F.lit(p).alias("predicted"),
            F.count_if((F.col(label) == F.lit(a)) & (F.col(predicted) == F.lit(p))).alias("n"),
        )
        for a in classes
        for p in classes
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def mse(label: str, predicted: str) -> Column:
    e = F.col(label) - F.col(predicted)
    return F.avg(e * e)


def mae(label: str, predicted: str) -> Column:
    return F.avg(F.abs(F.col(label) - F.col(predicted)))


def r2(label: str, predicted: str) -> Column:
    """1 - SSE/SST; 1 or 0 on a constant label, as it is met exactly or not."""
    spread = F.var_pop(F.col(label).cast("double"))
    error = mse(label, predicted)
    return F.when(spread == 0, F.when(error == 0, 1.0).otherwise(0.0)).otherwise(1 - F.try_divide(error, spread))


def regression_columns(label: str, predicted: str) -> list[Column]:
    return [
        mse(label, predicted).alias("mse"),
        F.sqrt(mse(label, predicted)).alias("rmse"),
        mae(label, predicted).alias("mae"),
        r2(label, predicted).alias("r2"),
    ]


def regression_metrics(df: DataFrame, label: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """(by…, mse, rmse, mae, r2)."""
    return df.groupBy(*by).agg(*regression_columns(label, predicted))


def regression_metrics_wide(
    df: DataFrame, label: str, predictions: Mapping[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """(model, by…, mse, rmse, mae, r2) of several prediction columns from one scan."""
    names = list(predictions)
    cells = []
    for i, name in enumerate(names):
        values = dict(zip(("mse", "rmse", "mae", "r2"), regression_columns(label, predictions[name])))
        cells.append(F.struct(F.lit(name).alias("model"), *[v.alias(k) for k, v in values.items()]).alias(f"m{i}"))
    wide = df.groupBy(*by).agg(*cells)
    return wide.select(*by, F.inline(F.array(*[F.col(f"m{i}") for i in range(len(names))])))


def score_counts(df: DataFrame, label: str, score: str, positive: object = 1) -> DataFrame:
    """Distinct scores with class counts and running counts from the highest score down.

    Columns: score, pos, neg, tp, fp (rows scoring at least this much), next_pos, next_neg
    (of the next lower score), all_pos, all_neg. Scores are cut at approximate quantiles into
    buckets; running sums are taken inside a bucket and shifted by the totals of the buckets
    above, so no window spans the table and a crowded score is a single row.
    """
    s = F.col(score).cast("double")
    rows = df.select(s.alias("score"), (F.col(label) == F.lit(positive)).cast("int").alias("y"))
    rows = rows.where(F.col("score").isNotNull() & ~F.isnan("score") & F.col("y").isNotNull())
    n_buckets = min(max(rows.count() // BUCKET_ROWS, BUCKETS[0]), BUCKETS[1])
    probs = [i / n_buckets for i in range(1, n_buckets)]
    marks = rows.approxQuantile("score", probs, 0.5 / n_buckets)
    edges = [float("-inf"), *sorted(set(marks) or {0.0}), float("inf")]
    bucketed = Bucketizer(splits=edges, inputCol="score", outputCol="bucket").transform(rows)
    counted = bucketed.groupBy("bucket", "score").agg(
        F.sum("y").cast("bigint").alias("pos"), F.sum(1 - F.col("y")).cast("bigint").alias("neg")
    )
    totals = counted.groupBy("bucket").agg(
        F.sum("pos").alias("__pos"), F.sum("neg").alias("__neg"), F.max(F.struct("score", "pos", "neg")).alias("top")
    )
    # buckets are numbered from the highest score down; the next lower bucket may be empty, so it is looked up by order
    totals = totals.withColumn("__down", F.lit(len(edges)) - F.col("bucket").cast("bigint"))
    order = Window.partitionBy(F.lit(0)).orderBy("__down")  # at most BUCKETS rows
    table = totals_before(totals, "__down", ["__pos", "__neg"]).select(
        "bucket",
        F.col("__before_pos").alias("above_pos"),
        F.col("__before_neg").alias("above_neg"),
        F.lead("top.pos").over(order).alias("below_pos"),
        F.lead("top.neg").over(order).alias("below_neg"),
        F.sum("__pos").over(Window.partitionBy(F.lit(0))).alias("all_pos"),
        F.sum("__neg").over(Window.partitionBy(F.lit(0))).alias("all_neg"),
    )
    down = Window.partitionBy("bucket").orderBy(F.desc("score"))
    upto = down.rowsBetween(Window.unboundedPreceding, 0)
    return (
        counted.withColumns(
            {
                "run_pos": F.sum("pos").over(upto),
                "run_neg": F.sum("neg").over(upto),
                "lead_pos": F.lead("pos").over(down),
                "lead_neg": F.lead("neg").over(down),
            }
        )
        .join(table, "bucket")
        .select(
            "score",
            "pos",
            "neg",
            (F.col("above_pos") + F.col("run_pos")).alias("tp"),
            (F.col("above_neg") + F.col("run_neg")).alias("fp"),
            F.coalesce("lead_pos", "below_pos").alias("next_pos"),
            F.coalesce("lead_neg", "below_neg").alias("next_neg"),
            "all_pos",
            "all_neg",
        )
    )


def roc_auc(df: DataFrame, label: str, score: str, positive: object = 1) -> DataFrame:
    """One row ``auc``; tied scores count half. Null when a class is missing."""
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0)))
    pairs = F.max("all_pos").cast("double") * F.max("all_neg")
    counts = score_counts(df, label, score, positive)
    return counts.agg(F.try_divide(area, pairs).alias("auc"))


def roc_curve(
    df: DataFrame, label: str, score: str, positive: object = 1, drop_collinear: bool = True
) -> DataFrame:
    """(fpr, tpr, threshold) from the corner (0, 0) at infinity down to (1, 1)."""
    c = score_counts(df, label, score, positive)
    if drop_collinear:
        first = F.col("tp") + F.col("fp") == F.col("pos") + F.col("neg")
        last = F.col("next_pos").isNull()
        turn = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        c = c.where(first | last | turn)
    points = c.select(
        F.try_divide("fp", "all_neg").alias("fpr"),
        F.try_divide("tp", "all_pos").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    corner = small_table(df.sparkSession, [(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double")
    return corner.unionByName(points)
