"""Ridge and logistic regression whose penalty is stated per study, not per row.

The built-in solvers penalise a per-row average; these estimators look up the row count
(and the label's spread) first and hand the equivalent ``regParam`` down.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasTol, HasWeightCol
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tabstudy.operators.features import encoded_width

NORMAL_EQUATION_WIDTH = 4096  # limit of the one-pass solver


class Ridge(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Minimises ``sum (y - xw - b)^2 + alpha |w|^2``; the intercept is free."""

    alpha = Param(Params._dummy(), "alpha", "weight of the squared norm", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, alpha=1.0, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(alpha=1.0)
        self._set(alpha=alpha, featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> LinearRegressionModel:
        label = F.col(self.getLabelCol()).cast("double")
        n, sd = dataset.agg(F.count(label), F.stddev_pop(label)).first()
        attributes = dataset.schema[self.getFeaturesCol()].metadata.get("ml_attr")
        width = encoded_width(dataset, self.getFeaturesCol()) if attributes else 0
        # one pass over the rows for the Gram matrix, unless it would be too wide
        solver = "normal" if width <= NORMAL_EQUATION_WIDTH else "l-bfgs"
        return LinearRegression(
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            solver=solver,
            elasticNetParam=0.0,
            standardization=False,
            regParam=self.getOrDefault("alpha") * (sd or 0.0) / max(n, 1),
            maxIter=1000,
            tol=1e-10,
        ).fit(dataset)


class Logistic(
    Estimator,
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    HasMaxIter,
    HasTol,
    HasWeightCol,
    DefaultParamsReadable,
    DefaultParamsWritable,
):
    """Minimises ``|w|^2 / 2 + C sum logloss``; the intercept is free. A row of weight k counts as k copies."""

    C = Param(Params._dummy(), "C", "weight of the summed loss", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self,
        *,
        C=1.0,
        maxIter=1000,
        tol=1e-8,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
        weightCol=None,
    ):
        super().__init__()
        if weightCol:
            self._set(weightCol=weightCol)
        self._set(
            C=C,
            maxIter=maxIter,
            tol=tol,
            featuresCol=featuresCol,
            labelCol=labelCol,
            predictionCol=predictionCol,
        )

    def setWeightCol(self, name: str) -> Logistic:
        return self._set(weightCol=name)

    def _fit(self, dataset: DataFrame) -> LogisticRegressionModel:
        weighted = self.isSet("weightCol")
        n = dataset.agg(F.sum(self.getWeightCol())).first()[0] or 0 if weighted else dataset.count()
        return LogisticRegression(
            **({"weightCol": self.getWeightCol()} if weighted else {}),
            featuresCol=self.getFeaturesCol(),
            labelCol=self.getLabelCol(),
            predictionCol=self.getPredictionCol(),
            elasticNetParam=0.0,
            standardization=False,
            regParam=1.0 / (self.getOrDefault("C") * max(n, 1)),
            maxIter=self.getMaxIter(),
            tol=self.getTol(),
        ).fit(dataset)


def linear_history(model: LogisticRegressionModel | LinearRegressionModel) -> DataFrame:
    """(epoch, loss) of an iterative linear fit."""
    from pyspark.sql import SparkSession

    values = [(i, float(v)) for i, v in enumerate(model.summary.objectiveHistory)]
    return SparkSession.active().createDataFrame(values, "epoch int, loss double")
