"""Rebalancing a class label: over- and undersampling, weighted bootstrap, synthetic points.

All functions take the training rows only and return training rows; nothing here accepts
evaluation rows, so they cannot be touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabstudy.operators.keyed import (
    class_sizes,
    dense_index,
    hash_key,
    hash_number,
    hash_unit,
    rank_thresholds,
)
from tabstudy.operators.neighbours import nearest_neighbours
from tabstudy.session import small_table

HASH = "__row_key"


def keep_all(train: DataFrame, copies: str = "") -> DataFrame:
    """The no-op baseline."""
    return train.withColumn(copies, F.lit(0)) if copies else train


def _draw_text(tag: str, seed: int | str, number: str = "id") -> Column:
    return F.concat(F.lit(f"{tag}|{seed}|"), F.col(number).cast("string"))


def _repeat(rows: DataFrame, times: str, copies: str) -> DataFrame:
    """Each row ``times`` times. Draws are spread evenly, so counts per row stay small."""
    return rows.withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(times).cast("int"))))


def random_oversample(
    train: DataFrame, label: str, key: Sequence[str | Column], seed: int | str = 42, copies: str = ""
) -> DataFrame:
    """All rows plus, per smaller class, draws with replacement up to the largest class.

    ``copies`` names a column for the copy number (0 for the rows themselves), which
    completes the key of a drawn row.
    """
    sizes = {c: n for c, n in class_sizes(train, label).items() if c is not None}
    target = max(sizes.values(), default=0)
    train = train.withColumn(copies, F.lit(0)) if copies else train
    out = train
    for cls in sorted(sizes, key=str):
        missing = target - sizes[cls]
        if missing:
            out = out.unionByName(_drawn(train, label, cls, sizes[cls], missing, key, seed, copies))
    return out


def _class_draws(train: DataFrame, n: int, draws: int, seed: int | str) -> DataFrame:
    """(idx, __times): how often each of ``n`` numbered rows is drawn."""
    picked = F.pmod(hash_number(_draw_text("ros", seed)), F.lit(n)).cast("bigint")
    return train.sparkSession.range(draws).groupBy(picked.alias("idx")).agg(F.count(F.lit(1)).alias("__times"))


def _drawn(
    train: DataFrame,
    label: str,
    cls: object,
    n: int,
    draws: int,
    key: Sequence[str | Column],
    seed: int | str,
    copies: str,
) -> DataFrame:
    """``draws`` rows of one class with replacement, by number of draws per row."""
    rows = train.where(F.col(label) == F.lit(cls)).withColumn(HASH, hash_key(key, seed))
    indexed = dense_index(rows, HASH, n)
    counts = _class_draws(train, n, draws, seed)
    return _repeat(indexed.join(counts, "idx"), "__times", copies or "__copy").select(*train.columns)


def random_undersample(
    train: DataFrame, label: str, key: Sequence[str | Column], seed: int | str = 42, copies: str = ""
) -> DataFrame:
    """Every class cut to the size of the smallest, without replacement."""
    train = train.withColumn(copies, F.lit(0)) if copies else train
    sizes = {c: n for c, n in class_sizes(train, label).items() if c is not None}
    target = min(sizes.values(), default=0)
    keyed = train.where(F.col(label).isNotNull()).withColumn(HASH, hash_key(key, seed))
    cuts = rank_thresholds(keyed, HASH, {c: [target] for c in sizes}, by=label, sizes=sizes)
    schema = T.StructType(
        [T.StructField("__cls", train.schema[label].dataType), T.StructField("__cut", T.StringType())]
    )
    table = small_table(train.sparkSession, [(c, t[0]) for c, t in cuts.items()], schema)
    return (
        keyed.join(table, F.col(label) == F.col("__cls"))
        .where(F.col(HASH) < F.col("__cut"))
        .select(*train.columns)
    )


def class_weights(sizes: dict) -> dict:
    """Weight of a class's rows: the share of all other rows (for two classes, of the other)."""
    total = sum(sizes.values())
    return {c: (total - n) / total for c, n in sizes.items()}


def _bootstrap_draws(train: DataFrame, label: str, sizes: dict, seed: int | str) -> DataFrame:
    """(__cls, __idx, __times): how often each numbered row of a class is drawn."""
    total = sum(sizes.values())
    if len(sizes) < 2:
        weights = {c: 1.0 for c in sizes}
    else:
        weights = class_weights(sizes)
    mass = sum(weights[c] * n for c, n in sizes.items())
    u = hash_unit(_draw_text("wbs-class", seed))
    v = hash_number(_draw_text("wbs-row", seed))
    classes = sorted(sizes, key=str)
    which, size, reached = None, None, 0.0
    for cls in classes[:-1]:
        reached += weights[cls] * sizes[cls] / mass
        test = u < F.lit(reached)
        which = F.when(test, F.lit(cls)) if which is None else which.when(test, F.lit(cls))
        size = F.when(test, F.lit(sizes[cls])) if size is None else size.when(test, F.lit(sizes[cls]))
    last = classes[-1]
    which = F.lit(last) if which is None else which.otherwise(F.lit(last))
    size = F.lit(sizes[last]) if size is None else size.otherwise(F.lit(sizes[last]))
    label_type = train.schema[label].dataType
    return (
        train.sparkSession.range(total)
        .select(which.cast(label_type).alias("__cls"), F.pmod(v, size).cast("bigint").alias("__idx"))
        .groupBy("__cls", "__idx")
        .agg(F.count(F.lit(1)).alias("__times"))
    )


def weighted_bootstrap(
    train: DataFrame, label: str, key: Sequence[str | Column], seed: int | str = 42, copies: str = ""
) -> DataFrame:
    """As many draws with replacement as there are rows, by class-balancing weights.

    A draw picks a class by the classes' weight mass and a row inside it evenly, which is
    the same distribution as picking one row by its own weight.
    """
    sizes = {c: n for c, n in class_sizes(train, label).items() if c is not None}
    counts = _bootstrap_draws(train, label, sizes, seed)
    keyed = train.where(F.col(label).isNotNull()).withColumn(HASH, hash_key(key, seed))
    indexed = dense_index(keyed, HASH, max(sizes.values()), by=label)
    hit = (F.col(label) == F.col("__cls")) & (F.col("idx") == F.col("__idx"))
    drawn = _repeat(indexed.join(counts, hit), "__times", copies or "__copy")
    return drawn.select(*[c for c in train.columns if c != copies], *([copies] if copies else []))


def resampling_weights(
    train: DataFrame,
    label: str,
    key: Sequence[str | Column],
    techniques: Sequence[str] = ("oversample", "undersample", "bootstrap"),
    seed: int | str = 42,
) -> DataFrame:
    """The rows once each, with a column per technique that says how often the technique's sample holds them.

    Same draws as ``random_oversample``, ``random_undersample`` and ``weighted_bootstrap``, so that a learner with row
    weights fits what it would fit on the copies. Rows are numbered once for all techniques. Rows without a class
    count as the functions treat them: kept by oversampling, left out by the others.
    """
    unknown = set(techniques) - {"oversample", "undersample", "bootstrap"}
    if unknown or set(techniques) & set(train.columns):
        raise ValueError(f"no such technique, or a column of that name: {techniques}")
    sizes = {c: n for c, n in class_sizes(train, label).items() if c is not None}
    most, least = max(sizes.values(), default=0), min(sizes.values(), default=0)
    kind = train.schema[label].dataType
    draws = None
    for name in techniques:
        found = []
        if name == "bootstrap" and sizes:
            found.append(_bootstrap_draws(train, label, sizes, seed))
        if name == "oversample":
            for cls, n in sizes.items():
                if n < most:
                    counts = _class_draws(train, n, most - n, seed)
                    found.append(counts.select(F.lit(cls).cast(kind).alias("__cls"), F.col("idx").alias("__idx"), "__times"))
        for counts in found:
            counts = counts.withColumn("__name", F.lit(name))
            draws = counts if draws is None else draws.unionByName(counts)
    keyed = train.withColumn(HASH, hash_key(key, seed))
    rows = dense_index(keyed, HASH, max(most, 1), "__no", by=label)
    if draws is None:
        rows = rows.withColumns({f"__drawn_{name}": F.lit(0) for name in techniques})
    else:
        times = [F.sum(F.when(F.col("__name") == name, F.col("__times"))).alias(f"__drawn_{name}") for name in techniques]
        hit = (F.col(label) == F.col("__cls")) & (F.col("__no") == F.col("__idx"))
        rows = rows.join(draws.groupBy("__cls", "__idx").agg(*times), hit, "left")
    drawn = {name: F.coalesce(F.col(f"__drawn_{name}"), F.lit(0)) for name in techniques}
    counted = {
        "oversample": lambda: F.lit(1) + drawn["oversample"],
        "undersample": lambda: (F.col(label).isNotNull() & (F.col("__no") < least)).cast("int"),
        "bootstrap": lambda: drawn["bootstrap"],
    }
    return rows.select(*train.columns, *[counted[name]().cast("double").alias(name) for name in techniques])


def smote(
    train: DataFrame,
    label: str,
    key: str,
    features: str,
    k: int = 5,
    seed: int | str = 42,
) -> DataFrame:
    """All rows plus synthetic ones for every smaller class, up to the largest class.

    ``features`` is an ARRAY<DOUBLE>. A synthetic row is x + u (neighbour - x) for a drawn
    base row x, one of its ``k`` nearest rows of the same class and a drawn gap u. The result
    has the columns (key, features, label, synthetic, draw); a synthetic row has a null key and
    the number of its draw, which is null for the rows themselves.
    """
    sizes = {c: n for c, n in class_sizes(train, label).items() if c is not None}
    target = max(sizes.values(), default=0)
    base = train.select(key, features, label)
    out = base.withColumns({"synthetic": F.lit(False), "draw": F.lit(None).cast("bigint")})
    for cls in sorted(sizes, key=str):
        missing = target - sizes[cls]
        if missing:
            if sizes[cls] <= k:
                raise ValueError(f"class {cls!r} has {sizes[cls]} rows, needs more than {k}")
            rows = base.where(F.col(label) == F.lit(cls))
            points = synthetic_points(rows, key, features, sizes[cls], missing, k, seed)
            out = out.unionByName(
                points.select(
                    F.lit(None).cast(train.schema[key].dataType).alias(key),
                    F.col("point").alias(features),
                    F.lit(cls).cast(train.schema[label].dataType).alias(label),
                    F.lit(True).alias("synthetic"),
                    "draw",
                )
            )
    return out


def synthetic_points(
    rows: DataFrame, key: str, features: str, n: int, draws: int, k: int = 5, seed: int | str = 42
) -> DataFrame:
    """(draw, base, neighbour, gap, point) for ``draws`` synthetic points among ``rows``."""
    keyed = rows.select(F.col(key).alias("base"), F.col(features).alias("x"))
    numbered = dense_index(keyed.withColumn(HASH, hash_key(["base"], seed)), HASH, n).drop(HASH)
    pairs = nearest_neighbours(rows, key, features, k).select(
        F.col("id").alias("base"), F.col("rank").alias("pick"), F.col("neighbour")
    )
    drawn = rows.sparkSession.range(draws).select(
        F.col("id").alias("draw"),
        F.pmod(hash_number(_draw_text("smote-base", seed)), F.lit(n)).cast("bigint").alias("idx"),
        (F.pmod(hash_number(_draw_text("smote-pick", seed)), F.lit(k)) + 1).cast("int").alias("pick"),
        hash_unit(_draw_text("smote-gap", seed)).alias("gap"),
    )
    other = keyed.select(F.col("base").alias("neighbour"), F.col("x").alias("y"))
    step = F.zip_with("x", "y", lambda a, b: a + F.col("gap") * (b - a))
    return (
        drawn.join(numbered, "idx")
        .join(pairs, ["base", "pick"])
        .join(other, "neighbour")
        .select("draw", "base", "neighbour", "gap", step.alias("point"))
    )
