"""Sorting, best row, custom category order, completion by a key list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from tabstudy.session import small_table


def sort_rows(df: DataFrame, by: Sequence[str], ascending: Sequence[bool] | bool = True) -> DataFrame:
    """Multi-key sort with a direction per key, nulls last in either direction."""
    flags = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    keys = [F.asc_nulls_last(c) if up else F.desc_nulls_last(c) for c, up in zip(by, flags, strict=True)]
    return df.orderBy(*keys)


def best_row(df: DataFrame, by: Sequence[str], ascending: Sequence[bool] | bool = True) -> DataFrame:
    """The first row of the sort; planned as a top-1, no full sort."""
    return sort_rows(df, by, ascending).limit(1)


def sort_by_key(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(key))


def category_position(column: str, order: Sequence) -> Column:
    """1-based place of a value in ``order``; null when it is not listed."""
    listed = F.array(*[F.lit(v) for v in order])
    return F.nullif(F.array_position(listed, F.col(column)), F.lit(0))


def sort_by_category(df: DataFrame, column: str, order: Sequence, *then: str) -> DataFrame:
    return df.orderBy(F.asc_nulls_last(category_position(column, order)), *then)


def reindex(df: DataFrame, key: str, order: Sequence, missing: str = "null") -> DataFrame:
    """Exactly the rows named in ``order``, in that order.

    ``missing="null"`` keeps a listed key without a row as nulls, ``missing="raise"``
    makes it an error. ``df`` is a report, so the list is the larger side of nothing.
    """
    schema = T.StructType(
        [T.StructField("__pos", T.IntegerType()), T.StructField(key, df.schema[key].dataType)]
    )
    wanted = small_table(df.sparkSession, list(enumerate(order)), schema)
    if missing == "raise":
        found = {r[0] for r in df.join(wanted, key, "left_semi").select(key).distinct().collect()}
        absent = [v for v in order if v not in found]
        if absent:
            raise KeyError(f"not in {key}: {absent}")
    columns = [F.col(c) for c in df.columns]
    return wanted.join(df, key, "left").orderBy("__pos").select(*columns)
