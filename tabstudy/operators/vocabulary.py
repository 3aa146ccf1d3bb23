"""One-hot encoding whose vocabulary is a table: any number of categories, none of them on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tabstudy.operators.keyed import rank_rows
from tabstudy.operators.profile import long_categories


def vocabulary(df: DataFrame, columns: Sequence[str], drop_first: bool = False) -> DataFrame:
    """(column, value, slot): every category of ``columns`` and its slot from 0, column by column, each in alphabetical order.

    Distinct values are found with a map-side combine and numbered by sorted ranges. Nulls are no category; ``drop_first``
    leaves out the first category of each column.
    """
    words = long_categories(df, columns).distinct()
    if drop_first:
        first = words.groupBy("column").agg(F.min("value").alias("value"))
        words = words.join(first, ["column", "value"], "left_anti")
    place = F.array_position(F.lit(list(columns)), F.col("column"))
    return rank_rows(words, [place, F.col("value")]).select("column", "value", (F.col("position") - 1).alias("slot"))


def hot_slots(df: DataFrame, key: Sequence[str], columns: Sequence[str], words: DataFrame, output: str = "slots") -> DataFrame:
    """(key…, slots): the ascending slots that are 1 for a row, with ``words`` of ``vocabulary``; unseen values and nulls have none.

    ``key`` tells rows apart: rows that share one are encoded together, with the slots of all. Cells meet the vocabulary's unique
    (column, value) pairs in one join, so a value that most rows hold is split by the engine's skew handling; the array of
    a row is no longer than its columns.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    tall = df.select(*key, F.explode(cells).alias("__cell"))
    tall = tall.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(key)], "__cell.column", "__cell.value")
    keys = [f"__k{i}" for i in range(len(key))]
    slots = F.sort_array(F.collect_set("slot")).alias(output)
    rows = tall.join(words, ["column", "value"], "left").groupBy(*keys).agg(slots)
    return rows.select(*[F.col(k).alias(c) for k, c in zip(keys, key)], output)
