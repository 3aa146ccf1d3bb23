"""Exact, repeatable train/validation/test splits, plain or stratified."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabstudy.operators.keyed import class_sizes, hash_key, rank_thresholds
from tabstudy.session import small_table

HASH = "__split_key"


def held_out(n: int, fraction: float) -> int:
    """Size of the held-out part: rounded up, from the decimal as written (0.3 is 3/10)."""
    return math.ceil(Fraction(str(fraction)) * n)


def largest_remainder(sizes: Mapping[object, int], take: int) -> dict[object, int]:
    """Share ``take`` rows over classes in proportion; leftovers by remainder, then by name."""
    total = sum(sizes.values())
    if total == 0:
        return {c: 0 for c in sizes}
    quotas = {c: take * n // total for c, n in sizes.items()}
    left = take - sum(quotas.values())
    order = sorted(sizes, key=lambda c: (-(take * sizes[c] % total), str(c)))
    for c in order[:left]:
        quotas[c] += 1
    return quotas


def split_quotas(sizes: Mapping[object, int], holdout: Sequence[float]) -> dict[object, list[int]]:
    """Rows per class and part for nested hold-outs.

    ``holdout=[0.3, 0.5]`` takes 30 % away from train, then half of those away from
    validation; each step rounds up and shares its size over the classes.
    """
    current = dict(sizes)
    parts: dict[object, list[int]] = {c: [] for c in sizes}
    for fraction in holdout:
        total = sum(current.values())
        kept = largest_remainder(current, total - held_out(total, fraction))
        for c in sizes:
            parts[c].append(kept[c])
            current[c] -= kept[c]
    for c in sizes:
        parts[c].append(current[c])
    return parts


def assign_splits(
    df: DataFrame,
    key: Sequence[str | Column],
    holdout: Sequence[float] = (0.3, 0.5),
    names: Sequence[str] = ("train", "val", "test"),
    stratify: str | None = None,
    seed: int | str = 42,
    output: str = "split",
) -> DataFrame:
    """Add the column ``output`` naming the part each row belongs to.

    Sizes are exact, parts are disjoint and complete, and the assignment depends only on
    ``key`` and ``seed``. The result is a narrow projection over ``df``.
    """
    if len(names) != len(holdout) + 1:
        raise ValueError("one name per part is needed")
    keyed = df.withColumn(HASH, hash_key(key, seed))
    sizes = class_sizes(df, stratify)
    quotas = split_quotas(sizes, holdout)
    ranks = {c: _running(parts[:-1]) for c, parts in quotas.items()}
    cuts = rank_thresholds(keyed, HASH, ranks, by=stratify, sizes=sizes)
    if stratify is None:
        marks = [F.lit(t) for t in cuts[None]]
        return keyed.withColumn(output, _part(marks, names)).drop(HASH)
    schema = T.StructType(
        [T.StructField("__cls", df.schema[stratify].dataType)]
        + [T.StructField(f"__t{i}", T.StringType()) for i in range(len(holdout))]
    )
    table = small_table(df.sparkSession, [(c, *ts) for c, ts in cuts.items()], schema)
    marks = [F.col(f"__t{i}") for i in range(len(holdout))]
    return keyed.join(table, F.col(stratify).eqNullSafe(F.col("__cls"))).select(
        *df.columns, _part(marks, names).alias(output)
    )


def _running(parts: Sequence[int]) -> list[int]:
    total, out = 0, []
    for p in parts:
        total += p
        out.append(total)
    return out


def _part(marks: Sequence[Column], names: Sequence[str]) -> Column:
    chain = None
    for mark, name in zip(marks, names):
        test = F.col(HASH) < mark
        chain = F.when(test, F.lit(name)) if chain is None else chain.when(test, F.lit(name))
    return chain.otherwise(F.lit(names[-1]))


def take_split(df: DataFrame, name: str, split: str = "split") -> DataFrame:
    return df.where(F.col(split) == F.lit(name)).drop(split)


def split_metadata(df: DataFrame, num_features: int, split: str = "split") -> DataFrame:
    """One row: encoded width and the size of every part."""
    count = lambda name: F.count_if(F.col(split) == F.lit(name))
    return df.agg(
        F.lit(num_features).cast("bigint").alias("num_features"),
        count("train").alias("train_samples"),
        count("val").alias("val_samples"),
        count("test").alias("test_samples"),
    )
