"""Column expressions and projections: labels, rounding, casts, lookups, filters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T
from tabstudy.session import small_table

# A dict becomes a chain of comparisons inside codegen up to this size, a join above it.
INLINE_LOOKUP = 64


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)


def drop_if_present(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]


def label_of(column: str, value: object) -> Column:
    """1 where ``column`` equals ``value``, 0 otherwise, nulls included."""
    return F.coalesce((F.col(column) == F.lit(value)).cast("int"), F.lit(0))


def round_half_even(column: Column | str, decimals: int) -> Column:
    """Nearest multiple of 10^-decimals, halves to even, in double arithmetic throughout."""
    c = F.col(column) if isinstance(column, str) else column
    scale = F.lit(float(10**decimals))
    return F.rint(c.cast("double") * scale) / scale


def to_int(column: Column | str, strict: bool = True) -> Column:
    """Cast to BIGINT. ``strict=False`` gives null for text that is no number."""
    c = F.col(column) if isinstance(column, str) else column
    return c.cast("bigint") if strict else c.try_cast("bigint")


def percent_of(part: Column, total: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), total)


def complement(column: Column | str, whole: float) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.lit(whole) - c


def replace_values(df: DataFrame, column: str, mapping: Mapping) -> DataFrame:
    """Exchange the values named in ``mapping``; keep all others."""
    return df.replace(dict(mapping), subset=[column])


def map_values(df: DataFrame, column: str, mapping: Mapping, output: str) -> DataFrame:
    """Look ``column`` up in ``mapping``; values it does not hold become null."""
    if len(mapping) <= INLINE_LOOKUP:
        chain = None
        for key, value in mapping.items():
            test = F.col(column) == F.lit(key)
            chain = F.when(test, F.lit(value)) if chain is None else chain.when(test, F.lit(value))
        return df.withColumn(output, F.lit(None) if chain is None else chain)
    key_type = df.schema[column].dataType
    probe = df.sparkSession.createDataFrame([(v,) for v in mapping.values()], [output])  # for its type
    schema = T.StructType(
        [T.StructField("__key", key_type), T.StructField(output, probe.schema[output].dataType)]
    )
    lookup = small_table(df.sparkSession, list(mapping.items()), schema)
    return df.join(lookup, F.col(column) == F.col("__key"), "left").drop("__key")


def outside(column: Column | str, low: Column | float, high: Column | float) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return (c < low) | (c > high)


def where_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def where_in(df: DataFrame, allowed: Mapping[str, Sequence]) -> DataFrame:
    """Rows whose every named column holds one of its allowed values."""
    for column, values in allowed.items():
        if len(values) <= INLINE_LOOKUP:
            df = df.where(F.col(column).isin(list(values)))
        else:
            schema = T.StructType([T.StructField(column, df.schema[column].dataType)])
            keys = small_table(df.sparkSession, [(v,) for v in values], schema)
            df = df.join(keys, column, "left_semi")
    return df


def within_axes(df: DataFrame, limits: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Rows inside the closed range of every named column."""
    for column, (low, high) in limits.items():
        df = df.where(F.col(column).between(low, high))
    return df


def square_root(column: Column | str) -> Column:
    return F.sqrt(column)


def choose(condition: Column, yes: Column | object, no: Column | object) -> Column:
    """Two-way choice; a null condition counts as false."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.when(condition, as_col(yes)).otherwise(as_col(no))


def unscale(column: Column | str, mean: float, sd: float) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return c * F.lit(float(sd)) + F.lit(float(mean))


def normalise_weights(df: DataFrame, weight: str, output: str) -> DataFrame:
    """Weights divided by their sum; the sum is one number fetched first."""
    total = df.agg(F.sum(weight)).first()[0]
    return df.withColumn(output, F.try_divide(F.col(weight), F.lit(total)))
