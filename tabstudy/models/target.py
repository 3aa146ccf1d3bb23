"""A regressor fitted on a standardised label whose predictions come back in its units."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, functions as F

from tabstudy.functions.columns import unscale


def label_scale(df: DataFrame, label: str) -> tuple[float, float]:
    """Mean and population sd of the label; a constant label has sd 1."""
    mean, sd = df.agg(F.avg(label), F.stddev_pop(label)).first()
    return float(mean or 0.0), float(sd or 1.0)


class ScaledTarget(Estimator):
    def __init__(self, regressor: Estimator):
        super().__init__()
        self.regressor = regressor

    def copy(self, extra=None):
        return ScaledTarget(self.regressor.copy(extra))

    def _fit(self, dataset: DataFrame) -> ScaledTargetModel:
        label = self.regressor.getLabelCol()
        mean, sd = label_scale(dataset, label)
        scaled = dataset.withColumn(label, (F.col(label) - F.lit(mean)) / F.lit(sd))
        return ScaledTargetModel(self.regressor.fit(scaled), mean, sd)


class ScaledTargetModel(Model):
    def __init__(self, inner: Model, mean: float, sd: float):
        super().__init__()
        self.inner, self.mean, self.sd = inner, mean, sd

    def copy(self, extra=None):
        return ScaledTargetModel(self.inner.copy(extra), self.mean, self.sd)

    def getPredictionCol(self) -> str:
        return self.inner.getPredictionCol()

    def setPredictionCol(self, name: str) -> ScaledTargetModel:
        self.inner.setPredictionCol(name)
        return self

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.inner.getPredictionCol()
        return self.inner.transform(dataset).withColumn(out, unscale(out, self.mean, self.sd))
