"""Solvers that go over the rows step by step: ridge by LSQR, logistic regression by SAGA.

Neither forms a matrix of features by features. What the driver holds is a few vectors as wide as the features.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel, TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasTol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabstudy.operators.keyed import hash_key
from tabstudy.session import hold_spread, scratch_path

SHARD_ROWS = 25_000  # rows of a shard of SAGA at most
SHARD_VALUES = 4_000_000  # and features times rows
ABREAST_VALUES = 2_000_000  # features times rows of the shards that one task steps through together
LOST_DIGITS = 1e5  # growth of the recurrence's factors at which LSQR starts again from where it is


def _rows(dataset: DataFrame, features: str, label: str) -> DataFrame:
    """(x, y): the vector's own parts and the label, where neither is null."""
    cast = dataset.select(F.unwrap_udt(features).alias("x"), F.col(label).cast("double").alias("y"))
    return cast.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def _width() -> Column:
    return F.coalesce(F.col("x.size"), F.size("x.values"))


def _entries(vectors: pa.StructArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of every stored entry of dense and sparse vectors."""
    values = vectors.field("values")
    sizes = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), sizes)
    slot = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    sparse = np.repeat(vectors.field("type").to_numpy(zero_copy_only=False) == 0, sizes)
    slot[sparse] = vectors.field("indices").flatten().to_numpy(zero_copy_only=False)
    return row, slot, values.flatten().to_numpy(zero_copy_only=False)


def _product_sums(rows: DataFrame, q: np.ndarray, c: float, b: float) -> tuple[np.ndarray, float, float]:
    """With r = x·q + c·y + b per row, the sums of r·x, of r and of r², in one pass."""
    width = len(q)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2)
        for batch in batches:
            row, slot, value = _entries(batch.column(0))
            r = np.bincount(row, value * q[slot], batch.num_rows) + c * batch.column(1).to_numpy() + b
            total[:width] += np.bincount(slot, value * r[row], width)
            total[width] += r.sum()
            total[width + 1] += r @ r
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled), pa.array(total[filled])], names=["slot", "part"])

    sums = np.zeros(width + 2)
    for slot, total in rows.mapInArrow(summed, "slot bigint, part double").groupBy("slot").agg(F.sum("part")).collect():
        sums[slot] = total
    return sums[:width], float(sums[width]), float(sums[width + 1])


class _Linear(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasTol, DefaultParamsReadable, DefaultParamsWritable):
    pass


class LinearScore(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """x·w + b, or with ``classify`` whether that is above 0; ``margin`` names a column for the value itself then."""

    weights = Param(Params._dummy(), "weights", "fitted coefficients", TypeConverters.toListFloat)
    offset = Param(Params._dummy(), "offset", "fitted intercept", TypeConverters.toFloat)
    classify = Param(Params._dummy(), "classify", "predict 0 or 1", TypeConverters.toBoolean)
    passes = Param(Params._dummy(), "passes", "passes over the rows that the fit took", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self, *, weights=None, offset=0.0, classify=False, passes=0, featuresCol="features", predictionCol="prediction"
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(offset=0.0, classify=False, passes=0)

    @property
    def coefficients(self) -> np.ndarray:
        return np.array(self.getOrDefault("weights"))

    @property
    def intercept(self) -> float:
        return self.getOrDefault("offset")

    def margin(self) -> Column:
        x = F.unwrap_udt(self.getFeaturesCol())
        w = F.lit([float(v) for v in self.getOrDefault("weights")])
        sparse = F.zip_with(x["indices"], x["values"], lambda i, v: v * F.get(w, i))
        terms = F.when(x["type"] == 0, sparse).otherwise(F.zip_with(x["values"], w, lambda v, k: v * k))
        return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) + F.lit(self.intercept)

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        value = self.margin()
        if self.getOrDefault("classify"):
            value = (value > 0).cast("double")
        return dataset.withColumn(self.getPredictionCol(), value)


class RidgeLSQR(Estimator, _Linear):
    """Minimises ``sum (y - xw - b)^2 + alpha |w|^2`` by bidiagonalisation (LSQR); the intercept is free.

    The matrix of the centred rows, with sqrt(alpha) times the identity below it, is never stored: the left vector of
    every step is x·p + c·y for a row, with p and c known to the driver, so a step is one pass that yields
    both of its norms and nothing is kept per row. As p and c grow, digits cancel; from ``LOST_DIGITS`` on, and
    whenever the recurrence takes itself for finished, it starts again at the residual of the solution so far.
    The fit ends when the gradient measured there is at most ``tol`` times what its rounding-free bound |A| |r| allows,
    no longer falls, or after ``maxIter`` passes.

    Rows with a null label or vector take no part; no row at all gives an error, a constant label zero weights.
    """

    alpha = Param(Params._dummy(), "alpha", "weight of the squared norm", TypeConverters.toFloat)

    @keyword_only
    def __init__(
        self, *, alpha=1.0, maxIter=1000, tol=1e-12, featuresCol="features", labelCol="label", predictionCol="prediction"
    ):
        super().__init__()
        self._setDefault(alpha=1.0)
        self._set(**self._input_kwargs)
        self._set(alpha=alpha, maxIter=maxIter, tol=tol)
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> LinearScore:
        rows = hold_spread(_rows(dataset, self.getFeaturesCol(), self.getLabelCol()))
        try:
            weights, offset, passes = self._solve(rows)
        finally:
            rows.unpersist()
        model = LinearScore(
            weights=weights.tolist(),
            offset=offset,
            passes=passes,
            featuresCol=self.getFeaturesCol(),
            predictionCol=self.getPredictionCol(),
        )
        return model._resetUid(self.uid)

    def _solve(self, rows: DataFrame) -> tuple[np.ndarray, float, int]:
        n, mean_y, width = rows.agg(F.count("y"), F.avg("y"), F.max(_width())).first()
        if not n:
            raise ValueError("no rows to fit")
        mean_x = _product_sums(rows, np.zeros(width), 0.0, 1.0)[0] / n
        alpha, passes = self.getOrDefault("alpha"), 0

        def step(p: np.ndarray, c: float) -> tuple[float, np.ndarray]:
            """Norm of the left vector u = A p + c y, and A'u, over the rows and the penalty below them."""
            nonlocal passes
            passes += 1
            along, total, square = _product_sums(rows, p, c, -(mean_x @ p) - c * mean_y)
            return math.sqrt(square + alpha * (p @ p)), along - mean_x * total + alpha * p

        w, bound, last = np.zeros(width), 0.0, math.inf
        while passes < self.getMaxIter():
            p, c = -w, 1.0
            beta, v = step(p, c)
            gradient = float(np.linalg.norm(v))
            if gradient == 0 or gradient <= self.getTol() * bound * beta or gradient > last / 2:
                break
            last = gradient
            p, c, v = p / beta, c / beta, v / beta
            a = float(np.linalg.norm(v))
            v = v / a
            start_c, direction, rho_bar, phi_bar = abs(c), v, a, beta
            squares = a * a
            while passes < self.getMaxIter():
                p, c = v - a * p, -a * c
                beta, u_along = step(p, c)
                if beta > 0:
                    p, c, u_along = p / beta, c / beta, u_along / beta
                new_v = u_along - beta * v
                new_a = float(np.linalg.norm(new_v))
                rho = math.hypot(rho_bar, beta)
                cos, sin = rho_bar / rho, beta / rho
                w = w + (cos * phi_bar / rho) * direction
                phi_bar *= sin
                squares += beta * beta + new_a * new_a
                bound = max(bound, math.sqrt(squares))
                if new_a * abs(cos) <= self.getTol() * bound or phi_bar == 0 or new_a == 0 or abs(c) > LOST_DIGITS * start_c:
                    break
                v, a = new_v / new_a, new_a
                direction = v - (sin * a / rho) * direction
                rho_bar = -cos * a
        return w, float(mean_y - mean_x @ w), passes


class LogisticSAGA(Estimator, _Linear):
    """Minimises ``|w|^2 / 2 + C sum logloss`` by SAGA; the intercept is free. Labels are 0 and 1.

    Rows are dealt by a hash of ``key`` into shards of at most ``SHARD_ROWS``; how many there are follows from the rows. Each
    row remembers the residual it had when last seen, in a table beside the shards. In an epoch every shard starts from the
    shared weights and visits its rows in a new order; a step follows the change of the row's remembered gradient plus
    the mean of all remembered ones. Then the shards' weights are averaged by their rows and the mean is summed anew.
    At the optimum every step is zero, however many shards there are. A task steps through its shards abreast, one row of each at
    a time, which leaves every shard the steps it takes alone. The length of a step follows from the largest row,
    as usual for SAGA, and is halved when the mean gradient has doubled.
    The fit ends when no weight moved by more than ``tol`` times the largest, or after ``maxIter`` epochs.

    Rows with a null label or vector take no part; no row at all gives an error. Shards are dense: rows times features.
    """

    C = Param(Params._dummy(), "C", "weight of the summed loss", TypeConverters.toFloat)
    key = Param(Params._dummy(), "key", "columns that tell rows apart", TypeConverters.toListString)
    seed = Param(Params._dummy(), "seed", "seed of the orders", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        key=None,
        C=1.0,
        maxIter=500,
        tol=1e-3,
        seed=42,
        featuresCol="features",
        labelCol="label",
        predictionCol="prediction",
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._set(C=C, maxIter=maxIter, tol=tol, seed=seed)
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol)

    def _fit(self, dataset: DataFrame) -> LinearScore:
        key = self.getOrDefault("key")
        h = hash_key(key, f"saga{self.getOrDefault('seed')}")
        rows = dataset.select(
            F.unwrap_udt(self.getFeaturesCol()).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"), h.alias("h")
        ).where(F.col("x").isNotNull() & F.col("y").isNotNull())
        square = F.aggregate("x.values", F.lit(0.0), lambda s, v: s + v * v)
        n, width, largest = rows.agg(F.count("y"), F.max(_width()), F.max(square)).first()
        if not n:
            raise ValueError("no rows to fit")
        shards, tasks = _shards(rows, n, width)
        shards = shards.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            w, epochs = self._descend(shards, tasks, n, width, largest)
        finally:
            shards.unpersist()
        model = LinearScore(
            weights=w[:-1].tolist(),
            offset=float(w[-1]),
            classify=True,
            passes=epochs,
            featuresCol=self.getFeaturesCol(),
            predictionCol=self.getPredictionCol(),
        )
        return model._resetUid(self.uid)

    def _descend(self, shards: DataFrame, tasks: int, n: int, width: int, largest: float) -> tuple[np.ndarray, int]:
        penalty = 1.0 / (self.getOrDefault("C") * n)
        smooth = 0.25 * (largest + 1) + penalty
        rate = 1.0 / (2 * smooth + min(2 * n * penalty, smooth))
        w, epoch = np.zeros(width + 1), 0
        seed = self.getOrDefault("seed")
        # two tables take turns: an epoch reads one and overwrites the other, so that no state outlives its use
        turns = [scratch_path(shards.sparkSession, "saga") for _ in range(2)]
        unseen = shards.select("shard", F.lit(None).cast("binary").alias("seen"))
        memory = _kept(_epoch(shards, unseen, tasks, w, None, n, 0.0, penalty, 0, seed), turns[0])
        moved, mean = _means(memory, n, width + 1)
        steep = math.inf
        for epoch in range(1, self.getMaxIter() + 1):
            memory = _kept(_epoch(shards, memory, tasks, w, mean, n, rate, penalty, epoch, seed), turns[epoch % 2])
            moved, mean = _means(memory, n, width + 1)
            change, w = np.abs(moved - w).max(), moved
            slope = np.abs(mean + penalty * np.append(w[:-1], 0.0)).max()
            if slope > 2 * steep:
                rate /= 2
            steep = min(steep, slope)
            if change <= self.getTol() * np.abs(w).max():
                break
        return w, epoch


def _shards(rows: DataFrame, n: int, width: int) -> tuple[DataFrame, int]:
    """(shard, n, x, y): rows packed into dense blocks, dealt and ordered by their hash, beside their shard's number.

    And the number of tasks that the blocks are dealt to.
    """
    most = max(1, min(SHARD_ROWS, SHARD_VALUES // max(width, 1)))
    parts = math.ceil(n / most)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = TaskContext.get().partitionId(), 0
        x, y, filled = np.zeros((most, width)), np.zeros(most), 0

        def block() -> pa.RecordBatch:
            cells = [[(blocks << 32) + part], [filled], [x[:filled].tobytes()], [y[:filled].tobytes()]]
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=["shard", "n", "x", "y"])

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                some = batch.slice(at, min(most - filled, batch.num_rows - at))
                row, slot, value = _entries(some.column(0))
                x[filled : filled + some.num_rows] = 0.0
                x[filled + row, slot] = value
                y[filled : filled + some.num_rows] = some.column(1).to_numpy()
                filled, at = filled + some.num_rows, at + some.num_rows
                if filled == most:
                    yield block()
                    blocks, filled = blocks + 1, 0
        if filled:
            yield block()

    dealt = rows.repartition(parts, "h").sortWithinPartitions("h").select("x", "y")
    blocks = dealt.mapInArrow(packed, "shard bigint, n int, x binary, y binary")
    tasks = _tasks(rows.sparkSession, parts, most * (width + 1))
    return blocks.repartition(tasks, "shard"), tasks


def _tasks(spark: SparkSession, shards: int, values: int) -> int:
    """Tasks of an epoch: rounds of all cores, with about ``ABREAST_VALUES`` each; it decides the time, not the result."""
    cores = spark.sparkContext.defaultParallelism
    return min(shards, cores * math.ceil(shards * values / (ABREAST_VALUES * cores)))


def _epoch(
    shards: DataFrame, memory: DataFrame, tasks: int, w: np.ndarray, mean: np.ndarray | None, n: int, rate: float, penalty: float, epoch: int, seed: int
) -> DataFrame:
    """(shard, seen, w, g): what the rows remember after an epoch, the shard's weights times its rows, its summed gradients.

    Without a ``mean`` the rows only take note of their residual at ``w``.
    """
    width = len(w) - 1

    def ran(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        abreast, longest = [], 0
        for batch in batches:
            for shard, size, xs, ys, seen in zip(*(c.to_pylist() for c in batch.columns)):
                x = np.c_[np.frombuffer(xs).reshape(size, width), np.ones(size)]
                y = np.frombuffer(ys)
                if mean is None:
                    yield from noted([(shard, x, _sigmoid(x @ w) - y, w)])
                    continue
                longest = max(longest, x.size)
                if abreast and (len(abreast) + 1) * longest > ABREAST_VALUES:
                    yield from stepped(abreast)
                    abreast, longest = [], x.size
                abreast.append((shard, x, y, np.frombuffer(seen)))
        if abreast:
            yield from stepped(abreast)

    def stepped(abreast: list[tuple]) -> Iterator[pa.RecordBatch]:
        orders = [np.random.default_rng([seed, epoch, shard]).permutation(len(y)) for shard, _, y, _ in abreast]
        xs, ys, seens = ([a[i] for a in abreast] for i in (1, 2, 3))
        ats, weights = _saga_steps(xs, ys, seens, orders, w, mean, n, rate, penalty)
        yield from noted([(shard, x, at, own) for (shard, x, *_), at, own in zip(abreast, ats, weights)])

    def noted(shards: list[tuple]) -> Iterator[pa.RecordBatch]:
        for shard, x, at, own in shards:
            cells = [[shard], [at.tobytes()], [own * len(x)], [at @ x]]
            types = [pa.int64(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=["shard", "seen", "w", "g"])

    # dealt like the shards, so that the join leaves those where they are
    dealt = memory.select("shard", "seen").repartition(tasks, "shard")
    met = shards.join(dealt, "shard").select("shard", "n", "x", "y", "seen")
    return met.mapInArrow(ran, "shard bigint, seen binary, w array<double>, g array<double>")


def _kept(state: DataFrame, path: str) -> DataFrame:
    """``state`` as a table in the shared folder, in place of what was there."""
    state.write.mode("overwrite").parquet(path)
    return state.sparkSession.read.schema(state.schema).parquet(path)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def _saga_steps(
    xs: list[np.ndarray], ys: list[np.ndarray], seens: list[np.ndarray], orders: list[np.ndarray],
    start: np.ndarray, mean: np.ndarray, n: int, rate: float, penalty: float,
) -> tuple[list[np.ndarray], np.ndarray]:
    """One visit of every row of every shard, each in its own order from the same start: the new residuals, and the weights per shard.

    Shards do not know of each other; the i-th rows of all are one step, so that its cost in Python is shared.
    """
    sizes = np.array([len(y) for y in ys])
    by_size = np.argsort(-sizes, kind="stable")  # those that still have rows come first
    longest, many, width = sizes.max(), len(ys), len(start)
    x, y, at = np.zeros((longest, many, width)), np.zeros((longest, many)), np.zeros((longest, many))
    for place, s in enumerate(by_size):
        x[: sizes[s], place], y[: sizes[s], place], at[: sizes[s], place] = xs[s][orders[s]], ys[s][orders[s]], seens[s][orders[s]]
    w, means = np.tile(start, (many, 1)), np.tile(mean, (many, 1))
    keep = np.full(width, 1.0 - rate * penalty)
    keep[-1] = 1.0
    left = many - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")
    for i, alive in enumerate(left.tolist()):
        row, own, mine = x[i, :alive], w[:alive], means[:alive]
        z = np.einsum("sf,sf->s", row, own)
        new = 1.0 / (1.0 + np.exp(-np.minimum(np.maximum(z, -500.0), 500.0))) - y[i, :alive]
        change = (new - at[i, :alive])[:, None] * row
        own *= keep
        own -= rate * (change + mine)
        mine += change / n
        at[i, :alive] = new
    ats, weights = [np.empty(size) for size in sizes], np.empty((many, width))
    for place, s in enumerate(by_size):
        ats[s][orders[s]] = at[: sizes[s], place]
        weights[s] = w[place]
    return ats, weights


def _means(memory: DataFrame, n: int, width: int) -> Sequence[np.ndarray]:
    """Weights averaged over the rows of the shards, and the mean of the remembered gradients."""
    cells = memory.select(F.posexplode(F.arrays_zip("w", "g")).alias("slot", "cell"))
    sums = np.zeros((2, width))
    for slot, w, g in cells.groupBy("slot").agg(F.sum("cell.w"), F.sum("cell.g")).collect():
        sums[:, slot] = w, g
    return sums / n
