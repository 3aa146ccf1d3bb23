"""Tree ensembles: the built-in distributed tree learner set up for study-like use."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasSeed, HasStepSize
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tabstudy.operators.keyed import hash_key
from tabstudy.session import cut_lineage

MAX_BINS = 128
BAG_ROWS = 50_000  # rows that share one random stream of bags
LINEAGE_ROUNDS = 10  # rounds after which the current fit is cut from what it was computed from


class DealtForest(Estimator):
    """A forest whose bags follow from the rows' keys instead of where the rows happen to lie.

    The built-in learner draws how often a row is in a tree's bag per partition, in the order of its rows. So rows
    are dealt by a hash of their key, in its order, to partitions whose number follows from the number of rows.
    """

    def __init__(self, learner: RandomForestRegressor, key: Sequence[str], rows: int = BAG_ROWS):
        super().__init__()
        self.learner, self.key, self.rows = learner, list(key), rows

    def copy(self, extra=None) -> DealtForest:
        return DealtForest(self.learner.copy(extra), self.key, self.rows)

    def getLabelCol(self) -> str:
        return self.learner.getLabelCol()

    def dealt(self, dataset: DataFrame) -> DataFrame:
        learner = self.learner
        h = hash_key(self.key, f"bag{learner.getSeed()}").alias("__h")
        rows = dataset.select(learner.getFeaturesCol(), learner.getLabelCol(), h)
        parts = max(1, math.ceil(dataset.count() / self.rows))
        return rows.repartition(parts, "__h").sortWithinPartitions("__h").drop("__h")

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        return self.learner.fit(self.dealt(dataset))


def forest(
    trees: int = 100,
    depth: int = 15,
    seed: int = 42,
    label: str = "label",
    max_bins: int = MAX_BINS,
    key: Sequence[str] = (),
) -> RandomForestRegressor | DealtForest:
    """Bagged trees that consider every feature at every split; with ``key``, the same ones however rows are partitioned."""
    learner = RandomForestRegressor(
        labelCol=label,
        numTrees=trees,
        maxDepth=depth,
        featureSubsetStrategy="all",
        maxBins=max_bins,
        maxMemoryInMB=512,  # more nodes per pass over the rows
        cacheNodeIds=True,
        seed=seed,
    )
    return DealtForest(learner, key) if key else learner


class Boosting(
    Estimator,
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    HasMaxIter,
    HasStepSize,
    HasSeed,
    DefaultParamsReadable,
    DefaultParamsWritable,
):
    """Least-squares boosting from the mean of the label; every tree, the first too, enters at ``stepSize``.

    The built-in booster gives its first tree full weight. Here a round fits one tree to the residuals of the
    rounds before, with the same tree learner. The model is the built-in one: a leaf that holds the mean, then the trees.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "depth of every tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "most candidate cuts of a feature", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        maxIter=100,
        maxDepth=6,
        stepSize=0.1,
        maxBins=MAX_BINS,
        seed=42,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
    ):
        super().__init__()
        self._set(
            maxIter=maxIter,
            maxDepth=maxDepth,
            stepSize=stepSize,
            maxBins=maxBins,
            seed=seed,
            featuresCol=featuresCol,
            labelCol=labelCol,
            predictionCol=predictionCol,
        )

    def _tree(self, depth: int) -> DecisionTreeRegressor:
        return DecisionTreeRegressor(
            featuresCol="features",
            labelCol="rest",
            predictionCol="step",
            maxDepth=depth,
            maxBins=self.getOrDefault("maxBins"),
            maxMemoryInMB=512,
            seed=self.getSeed(),
        )

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        rate = self.getStepSize()
        label = F.col(self.getLabelCol()).cast("double").alias("rest")
        rows = dataset.select(F.col(self.getFeaturesCol()).alias("features"), label)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        trees, weights = [self._tree(0).fit(rows)], [1.0]
        for i in range(self.getMaxIter()):
            # what the last tree leaves over, at its weight
            left = trees[-1].transform(rows).select("features", (F.col("rest") - weights[-1] * F.col("step")).alias("rest"))
            if i % LINEAGE_ROUNDS == LINEAGE_ROUNDS - 1:
                left = cut_lineage(left)
            left = left.persist(StorageLevel.MEMORY_AND_DISK)
            trees.append(self._tree(self.getOrDefault("maxDepth")).fit(left))
            weights.append(rate)
            rows.unpersist()
            rows = left
        rows.unpersist()
        return self._ensemble(dataset, trees, weights)

    def _ensemble(self, dataset: DataFrame, trees: list, weights: list[float]) -> GBTRegressionModel:
        context = dataset.sparkSession.sparkContext
        jvm, package = context._jvm, context._jvm.org.apache.spark.ml.regression
        held = context._gateway.new_array(package.DecisionTreeRegressionModel, len(trees))
        shares = context._gateway.new_array(jvm.double, len(weights))
        for i, (tree, weight) in enumerate(zip(trees, weights, strict=True)):
            held[i], shares[i] = tree._java_obj, weight
        model = GBTRegressionModel(package.GBTRegressionModel(self.uid, held, shares))
        return model.setFeaturesCol(self.getFeaturesCol()).setPredictionCol(self.getPredictionCol())


def boosting(
    rounds: int = 100,
    depth: int = 6,
    rate: float = 0.1,
    seed: int = 42,
    label: str = "label",
    max_bins: int = MAX_BINS,
) -> Boosting:
    """Least-squares boosting; every round adds ``rate`` times a tree fitted to the residuals."""
    return Boosting(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed, labelCol=label, maxBins=max_bins)
