"""Distributed training and scoring of a feed-forward network.

Rows are dealt once into shards, by a hash of their key and in its order. How many shards there are follows from the rows
alone, and a shard is a partition, so the model does not depend on the cores that happen to be there. An epoch is one
job: every shard runs mini-batch Adam over its rows from the shared state, and the shards' states are averaged by
their row counts in the order of the shards, ``MERGE_FAN`` at a time, on the executors until the driver merges the last few.

Networks that train on the same rows are trained together: a shard reads its rows once an epoch and shows every batch
to all of them.
"""

from __future__ import annotations

import math
import time
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tabstudy.models import network
from tabstudy.operators.keyed import hash_key
from tabstudy.operators.split import assign_splits
from tabstudy.session import small_table

MERGE_FAN = 32
SHARD_ROWS = 25_000  # rows of a shard, unless ``shards`` says otherwise
PASS_SCHEMA = "run int, slot int, n bigint, loss double, state array<double>"
SHARED = ("key", "features", "label", "seed", "shards", "loss", "early_stopping", "validation_fraction")


class NeuralNet(Estimator):
    """Network regressor (``loss="mse"``) or binary classifier (``loss="logloss"``).

    Training ends after ``epochs``, or when ``patience`` epochs bring no gain over ``tol``: in
    training loss, or with ``early_stopping`` in the score on a held-out ``validation_fraction``
    (R² or accuracy), in which case the best state is restored. ``validation`` rows given
    to ``fit_with_history`` are only measured. ``shards`` sets how many local runs are averaged per epoch.
    """

    def __init__(
        self,
        hidden: Sequence[int] = (128, 64, 32),
        loss: str = "mse",
        lr: float = 1e-3,
        epochs: int = 40,
        batch_size: int = 200,
        l2: float = 1e-4,
        weight_decay: float = 0.0,
        batch_norm: bool = False,
        dropout: float = 0.0,
        patience: int = 10,
        tol: float = 1e-4,
        early_stopping: bool = False,
        validation_fraction: float = 0.1,
        shards: int | None = None,
        seed: int = 42,
        key: Sequence[str] = (),
        features: str = "features",
        label: str = "label",
        prediction: str = "prediction",
        probability: str = "probability",
    ):
        super().__init__()
        self.options = {k: v for k, v in locals().items() if k not in ("self", "__class__")}
        for name, value in self.options.items():
            setattr(self, name, value)

    def copy(self, extra=None):
        return NeuralNet(**self.options)

    def getLabelCol(self) -> str:
        return self.label

    def _fit(self, dataset: DataFrame) -> NeuralNetModel:
        return self.fit_with_history(dataset)

    def fit_with_history(
        self, train: DataFrame, validation: DataFrame | None = None, label_sd: float = 1.0
    ) -> NeuralNetModel:
        """Fit and keep one history row per epoch; ``label_sd`` puts RMSE in label units."""
        return fit_together({"": self}, train, validation, label_sd)[""]

    def shares_rows(self, other: NeuralNet) -> bool:
        """Whether both would be shown the same rows in the same shards."""
        mine, theirs = ([list(v) if isinstance(v, tuple) else v for v in map(n.options.get, SHARED)] for n in (self, other))
        return mine == theirs

    def _keys(self, df: DataFrame) -> list:
        if self.key:
            return list(self.key)
        raise ValueError("name the key columns of the training rows")

    def _plain(self, df: DataFrame, *more: Column) -> DataFrame:
        x = F.col(self.features)
        if df.schema[self.features].dataType.typeName() != "array":
            x = vector_to_array(self.features, "float32")
        return df.select(x.cast("array<float>").alias("x"), F.col(self.label).cast("float").alias("y"), *more)

    def _shards(self, train: DataFrame) -> int:
        return self.shards or max(1, math.ceil(train.count() / SHARD_ROWS))

    def _dealt(self, train: DataFrame, shards: int) -> DataFrame:
        """Shards by row key, in key order, so that a rerun sees the same batches."""
        h = hash_key(self._keys(train), f"deal{self.seed}")
        keyed = self._plain(train, h.alias("h"))
        return keyed.repartition(shards, "h").sortWithinPartitions("h").select("x", "y")


def fit_together(
    nets: Mapping[str, NeuralNet], train: DataFrame, validation: DataFrame | None = None, label_sd: float = 1.0
) -> dict[str, NeuralNetModel]:
    """Fit several networks with one scan of the rows per epoch for all that still train.

    They must agree in ``SHARED``, which decides what rows they see. Each gets the model and history it gets alone,
    but for the seconds, which are those since the start of the joint fit.
    """
    first = next(iter(nets.values()))
    for net in nets.values():
        if not first.shares_rows(net):
            raise ValueError(f"networks trained together must agree in {', '.join(SHARED)}")
    measured = validation
    if first.early_stopping:
        stratify = first.label if first.loss == "logloss" else None
        parts = assign_splits(
            train, first._keys(train), [first.validation_fraction], ["fit", "hold"], stratify, f"hold{first.seed}"
        )
        train, measured = parts.where("split = 'fit'"), parts.where("split = 'hold'")
    began = time.perf_counter()
    shards = first._shards(train)
    rows = first._dealt(train, shards).persist(StorageLevel.MEMORY_AND_DISK)
    held = None
    try:
        one = rows.select(F.size("x")).first()
        if one is None:
            raise ValueError("no training rows")
        if measured is not None:
            held = first._plain(measured).persist(StorageLevel.MEMORY_AND_DISK)
        runs = {name: _Run(net, one[0]) for name, net in nets.items()}
        epoch = 0
        while active := [run for run in runs.values() if not run.done]:
            epoch += 1
            losses = _one_epoch(rows, shards, active, epoch)
            scores = _evaluate(held, active) if held is not None else [(None, None)] * len(active)
            for run, loss, (val_loss, val_score) in zip(active, losses, scores, strict=True):
                run.measured(epoch, loss, val_loss, val_score, label_sd, time.perf_counter() - began)
        return {name: run.model() for name, run in runs.items()}
    finally:
        rows.unpersist()
        if held is not None:
            held.unpersist()


class _Run:
    """A network while it is trained: its state, the best one so far and the history."""

    def __init__(self, net: NeuralNet, width: int):
        self.net = net
        self.shape = network.Shape(
            width, tuple(net.hidden), net.loss, net.batch_norm, net.dropout, net.l2, net.weight_decay
        )
        self.state = self.best = network.start_state(self.shape, net.seed)
        self.best_score, self.stale, self.history = -np.inf, 0, []
        self.done = net.epochs < 1

    def measured(
        self, epoch: int, loss: float, val_loss: float | None, val_score: float | None, label_sd: float, seconds: float
    ) -> None:
        net = self.net
        rmse = math.sqrt(val_loss) * label_sd if val_loss is not None and net.loss == "mse" else None
        self.history.append((epoch, loss, val_loss, rmse, seconds))
        score = val_score if net.early_stopping else -loss
        # patience counts from the last gain above tol, the best state from any gain
        self.stale = 0 if score > self.best_score + net.tol else self.stale + 1
        if score > self.best_score:
            self.best, self.best_score = self.state, score
        self.done = self.stale >= net.patience or epoch >= net.epochs

    def model(self) -> NeuralNetModel:
        net = self.net
        final = self.best if net.early_stopping else self.state
        return NeuralNetModel(self.shape, final, self.history, net.features, net.prediction, net.probability)


class _Learner:
    """A network inside a task: local state, moved batch by batch."""

    def __init__(self, shape: network.Shape, state: dict, lr: float, size: int, rng: np.random.Generator):
        self.shape, self.lr, self.size, self.rng, self.loss = shape, lr, size, rng, 0.0
        self.state = {k: v.astype(np.float32 if k != "t" else float) for k, v in state.items()}
        self.net = network.layers(shape, self.state["w"], self.state["stats"])

    def learn(self, x: np.ndarray, y: np.ndarray) -> None:
        order = self.rng.permutation(len(y))
        for part in np.array_split(order, max(1, math.ceil(len(y) / self.size))):
            grads, out = network.gradient(self.shape, self.net, x[part], y[part], self.rng)
            self.loss += network.loss_sum(self.shape, out, y[part])
            network.adam_step(self.shape, self.state, grads, self.lr)


def _one_epoch(rows: DataFrame, shards: int, runs: Sequence[_Run], epoch: int) -> list[float]:
    """Move every run's state by one pass over the rows; mean training losses."""
    context = rows.sparkSession.sparkContext
    given = [(run.shape, run.state, run.net.lr, run.net.batch_size) for run in runs]
    shared = context.broadcast(given)  # as large as the models, not the data
    seed = runs[0].net.seed

    def work(batches):
        shard = TaskContext.get().partitionId()
        learners = [_Learner(*start, np.random.default_rng([seed, epoch, shard])) for start in shared.value]
        n = 0
        for batch in batches:
            x, y = _arrays(batch)
            n += len(y)
            for learner in learners:
                learner.learn(x, y)
        if n:
            states = [network.pack(learner.state) for learner in learners]
            yield pa.RecordBatch.from_pydict(
                {
                    "run": pa.array(range(len(learners)), pa.int32()),
                    "slot": pa.array([shard] * len(learners), pa.int32()),
                    "n": pa.array([n] * len(learners), pa.int64()),
                    "loss": pa.array([learner.loss for learner in learners]),
                    "state": pa.array(states, pa.list_(pa.float64())),
                }
            )

    passed = rows.mapInArrow(work, PASS_SCHEMA)
    while shards > MERGE_FAN:
        passed = passed.groupBy("run", F.expr(f"slot div {MERGE_FAN}")).applyInPandas(_merge, PASS_SCHEMA)
        shards = math.ceil(shards / MERGE_FAN)
    last = passed.toPandas()  # at most MERGE_FAN rows per run
    shared.destroy()
    losses = []
    for i, run in enumerate(runs):
        merged = _merge(last[last["run"] == i]).iloc[0]
        run.state = network.unpack(np.asarray(merged["state"]), run.state)
        losses.append(float(merged["loss"] / merged["n"]))
    return losses


def _merge(parts: pd.DataFrame) -> pd.DataFrame:
    """Average of a run's states by row count, in slot order."""
    parts = parts.sort_values("slot")
    n = parts["n"].to_numpy()
    mean = sum(np.asarray(s, dtype=float) * w for s, w in zip(parts["state"], n / n.sum()))
    return pd.DataFrame(
        {
            "run": [parts["run"].iloc[0]],
            "slot": [parts["slot"].iloc[0] // MERGE_FAN],
            "n": [n.sum()],
            "loss": [parts["loss"].sum()],
            "state": [mean],
        }
    )


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    y = np.asarray(batch.column("y"))
    return np.asarray(batch.column("x").flatten()).reshape(len(y), -1), y


def _evaluate(held: DataFrame, runs: Sequence[_Run]) -> list[tuple[float, float]]:
    """Mean loss and score (R² or accuracy) of every run's state, in one pass over plain rows."""
    shared = held.sparkSession.sparkContext.broadcast([(run.shape, run.state) for run in runs])

    def work(batches):
        known = []
        for shape, state in shared.value:
            local = {k: v.astype(np.float32) for k, v in state.items()}
            known.append((shape, network.layers(shape, local["w"], local["stats"])))
        for batch in batches:
            x, y = _arrays(batch)
            y = y.astype(float)
            outs = [network.predict(shape, net, x) for shape, net in known]
            k = len(known)
            yield pa.RecordBatch.from_pydict(
                {
                    "run": pa.array(range(k), pa.int32()),
                    "n": pa.array([len(y)] * k, pa.int64()),
                    "loss": pa.array([network.loss_sum(shape, out, y) for (shape, _), out in zip(known, outs)]),
                    "hits": pa.array([int(((out > 0.5) == (y > 0.5)).sum()) for out in outs], pa.int64()),
                    "sy": pa.array([float(y.sum())] * k),
                    "syy": pa.array([float((y * y).sum())] * k),
                }
            )

    sums = held.mapInArrow(work, "run int, n bigint, loss double, hits bigint, sy double, syy double")
    found = sums.groupBy("run").agg(*[F.sum(c) for c in ("n", "loss", "hits", "sy", "syy")]).collect()  # one row per run
    shared.destroy()
    if not found:
        raise ValueError("no validation rows")
    out = []
    for run, (_, n, loss, hits, sy, syy) in zip(runs, sorted(found), strict=True):
        if run.shape.loss == "logloss":
            out.append((loss / n, hits / n))
        else:
            spread = syy - sy * sy / n
            out.append((loss / n, 1 - loss / spread if spread > 0 else 0.0))
    return out


class NeuralNetModel(Model):
    def __init__(self, shape, state, history, features, prediction, probability):
        super().__init__()
        self.shape, self.state, self.rows = shape, state, history
        self.features, self.prediction, self.probability = features, prediction, probability

    def copy(self, extra=None):
        return NeuralNetModel(
            self.shape, self.state, self.rows, self.features, self.prediction, self.probability
        )

    def getPredictionCol(self) -> str:
        return self.prediction

    def setPredictionCol(self, name: str) -> NeuralNetModel:
        self.prediction = name
        return self

    @property
    def epochs(self) -> int:
        return len(self.rows)

    @property
    def fit_seconds(self) -> float:
        return self.rows[-1][4]

    def history(self, df: DataFrame, series: str = "net") -> DataFrame:
        """(series, epoch, train_loss, val_loss, val_rmse)."""
        schema = "series string, epoch int, train_loss double, val_loss double, val_rmse double"
        return small_table(df.sparkSession, [(series, *r[:4]) for r in self.rows], schema)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        shape = self.shape
        kept = {k: self.state[k].astype(np.float32) for k in ("w", "stats")}

        @F.arrow_udf("double")
        def score(x: pa.Array) -> pa.Array:
            net = network.layers(shape, kept["w"], kept["stats"])
            values = np.asarray(x.flatten()).reshape(len(x), -1)
            return pa.array(network.predict(shape, net, values).astype(float))

        x = F.col(self.features)
        if dataset.schema[self.features].dataType.typeName() != "array":
            x = vector_to_array(self.features, "float32")
        scored = score(x.cast("array<float>"))
        if self.shape.loss == "mse":
            return dataset.withColumn(self.prediction, scored)
        return dataset.withColumn(self.probability, scored).withColumn(
            self.prediction, (F.col(self.probability) > 0.5).cast("double")
        )
