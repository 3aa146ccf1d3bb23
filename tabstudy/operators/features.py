"""Feature preparation as ``pyspark.ml`` stages fitted on the training rows only."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from tabstudy.operators.profile import long_categories
from tabstudy.operators.quantiles import exact_quantiles

FEATURES = "features"


class _Columns(HasInputCols, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    def pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols(), strict=True))


class ZScore(Estimator, _Columns):
    """(x - mean) / population sd per column; a constant column becomes 0."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ZScoreModel:
        names = self.getInputCols()
        cells = []
        for i, c in enumerate(names):
            x = F.col(c).cast("double")
            x = F.when(~F.isnan(x), x)
            cells += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
        row = dataset.agg(*cells).first()
        means = [row[f"m{i}"] if row[f"m{i}"] is not None else 0.0 for i in range(len(names))]
        sds = [row[f"s{i}"] or 1.0 for i in range(len(names))]
        model = ZScoreModel(inputCols=names, outputCols=self.getOutputCols(), means=means, sds=sds)
        return model._resetUid(self.uid)


class ZScoreModel(Model, _Columns):
    means = Param(Params._dummy(), "means", "fitted means", TypeConverters.toListFloat)
    sds = Param(Params._dummy(), "sds", "fitted population standard deviations", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, means=None, sds=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        means, sds = self.getOrDefault("means"), self.getOrDefault("sds")
        return dataset.withColumns(
            {
                out: (F.col(c).cast("double") - F.lit(m)) / F.lit(s)
                for (c, out), m, s in zip(self.pairs(), means, sds)
            }
        )


class MedianImputer(Estimator, _Columns):
    """Replace missing numbers by the exact, interpolated median of the fitted rows."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FillModel:
        names = self.getInputCols()
        rows = exact_quantiles(dataset, names, [0.5]).collect()  # one row per column
        known = {r["column"]: r["value"] for r in rows}
        fills = [str(known.get(c, 0.0)) for c in names]
        model = FillModel(inputCols=names, outputCols=self.getOutputCols(), fills=fills, numeric=True)
        return model._resetUid(self.uid)


class ModeImputer(Estimator, _Columns):
    """Replace missing texts by the most frequent one of the fitted rows, the smallest on a tie."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FillModel:
        names = self.getInputCols()
        counts = long_categories(dataset, names).groupBy("column", "value").count()
        top = counts.groupBy("column").agg(F.min(F.struct(-F.col("count"), F.col("value"))).alias("top"))
        known = {r["column"]: r["top"]["value"] for r in top.collect()}  # one row per column
        fills = [known.get(c, "") for c in names]
        model = FillModel(inputCols=names, outputCols=self.getOutputCols(), fills=fills, numeric=False)
        return model._resetUid(self.uid)


class FillModel(Model, _Columns):
    fills = Param(Params._dummy(), "fills", "fitted fill values as text", TypeConverters.toListString)
    numeric = Param(Params._dummy(), "numeric", "fill values are numbers", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, fills=None, numeric=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        numeric = self.getOrDefault("numeric")
        filled = {}
        for (c, out), fill in zip(self.pairs(), self.getOrDefault("fills")):
            if numeric:
                x = F.col(c).cast("double")
                filled[out] = F.coalesce(F.when(~F.isnan(x), x), F.lit(float(fill)))
            else:
                filled[out] = F.coalesce(F.col(c), F.lit(fill))
        return dataset.withColumns(filled)


def preprocessor(
    numeric: Sequence[str],
    categorical: Sequence[str],
    drop_first: bool = False,
    impute: bool = False,
    output: str = FEATURES,
) -> Pipeline:
    """Scaled numbers followed by one-hot categories in one vector column.

    ``drop_first`` leaves out the alphabetically first category of each column and refuses
    categories not seen in training; otherwise all are kept and an unseen one is all zeros.
    Columns not named are not part of the vector. The vector is sparse or dense row by row,
    whichever is smaller.
    """
    numeric, categorical = list(numeric), list(categorical)
    stages: list = []
    num_in, cat_in = numeric, categorical
    if impute:
        num_in, cat_in = [f"{c}__filled" for c in numeric], [f"{c}__filled" for c in categorical]
        if numeric:
            stages.append(MedianImputer(inputCols=numeric, outputCols=num_in))
        if categorical:
            stages.append(ModeImputer(inputCols=categorical, outputCols=cat_in))
    scaled = [f"{c}__z" for c in num_in]
    if numeric:
        stages.append(ZScore(inputCols=num_in, outputCols=scaled))
    hot = [f"{c}__hot" for c in cat_in]
    if categorical:
        index = [f"{c}__i" for c in categorical]
        order, invalid = ("alphabetDesc", "error") if drop_first else ("alphabetAsc", "keep")
        stages.append(
            StringIndexer(inputCols=cat_in, outputCols=index, stringOrderType=order, handleInvalid=invalid)
        )
        # the last index is dropped: the first category, or the slot of unseen ones
        stages.append(OneHotEncoder(inputCols=index, outputCols=hot, dropLast=True))
    stages.append(VectorAssembler(inputCols=[*scaled, *hot], outputCol=output))
    return Pipeline(stages=stages)


def encode(fitted: PipelineModel, df: DataFrame, output: str = FEATURES) -> DataFrame:
    """``df`` with the feature vector added and the helper columns dropped again."""
    return fitted.transform(df).select(*df.columns, output)


def feature_names(encoded: DataFrame, output: str = FEATURES) -> list[str]:
    """Slot names in vector order, from the column's ML attributes."""
    groups = encoded.schema[output].metadata["ml_attr"]["attrs"].values()
    slots = sorted((slot for group in groups for slot in group), key=lambda s: s["idx"])
    return [re.sub(r"__z$|__hot(?=_)", "", re.sub(r"__filled(?=__)", "", s["name"])) for s in slots]


def encoded_width(encoded: DataFrame, output: str = FEATURES) -> int:
    return int(encoded.schema[output].metadata["ml_attr"]["num_attrs"])


def dense(df: DataFrame, output: str = FEATURES, array: str = "x") -> DataFrame:
    """The vector as an ARRAY<DOUBLE> column."""
    return df.withColumn(array, vector_to_array(output))
