"""The numbers behind each figure: histogram, density, boxes, grids, bars, curves."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabstudy.functions.columns import percent_of, within_axes
from tabstudy.operators.keyed import hash_key, lowest_rows, rank_rows
from tabstudy.operators.profile import value_counts
from tabstudy.operators.quantiles import quantile_table
from tabstudy.session import hold_small, small_table

# A Gaussian this many bandwidths away adds less than 1e-17 of its peak.
KDE_REACH = 9.0
KDE_CELL = 0.25  # bandwidths that a cell spans
KDE_TERMS = 12  # moments kept per cell


def _clean(df: DataFrame, column: str) -> DataFrame:
    x = F.col(column).cast("double")
    return df.select(x.alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """(bin, left, right, count) over equal widths from min to max, the last bin closed."""
    x = _clean(df, column)
    lo, hi = x.agg(F.min("x"), F.max("x")).first()
    if lo is None:
        return small_table(df.sparkSession, [], "bin int, left double, right double, count bigint")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    place = F.least(F.lit(bins - 1), F.floor((F.col("x") - lo) / (hi - lo) * bins).cast("int"))
    counts = x.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / bins
    return (
        frame.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + F.col("bin") * width).alias("left"),
            (F.lit(lo) + (F.col("bin") + 1) * width).alias("right"),
            F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        )
        .orderBy("bin")
    )


def density_curve(df: DataFrame, column: str, points: int = 200, bins: int | None = None) -> DataFrame:
    """(point, x, density[, scaled]) of a Gaussian kernel estimate with Scott's bandwidth.

    Rows fold into cells a quarter of a bandwidth wide, each with the first moments of its rows about its centre, in one
    pass with a map-side combine; only cells meet grid points, those within reach of their kernels. So the work per row
    does not depend on the bandwidth or the number of points. A row's kernel is expanded about the centre in
    Hermite polynomials; by Cramér's bound what is left out is below 1.09 (KDE_CELL / 2)^KDE_TERMS / sqrt(KDE_TERMS!)
    of its peak, 1e-15. ``bins`` adds the curve scaled to the counts of a histogram with that many bins.
    """
    x = _clean(df, column)
    n, sd, lo, hi = x.agg(F.count("x"), F.stddev_samp("x"), F.min("x"), F.max("x")).first()
    if not n or n < 2 or not sd:
        return small_table(df.sparkSession, [], "point int, x double, density double")
    h = sd * n ** (-1 / 5)
    step, cell = (hi - lo) / (points - 1), KDE_CELL * h
    centre = F.lit(lo) + (F.col("cell") + 0.5) * cell
    away = (F.col("x") - centre) / h
    moments = [F.sum(F.pow("t", F.lit(float(k)))) / math.factorial(k) for k in range(1, KDE_TERMS)]
    cells = (
        x.withColumn("cell", F.floor((F.col("x") - lo) / cell))
        .select("cell", away.alias("t"))
        .groupBy("cell")
        .agg(F.array(F.count("t").cast("double"), *moments).alias("moments"))
        .select(centre.alias("centre"), "moments")
    )
    reach = KDE_REACH * h + cell
    first = F.greatest(F.ceil((F.col("centre") - lo - reach) / step), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col("centre") - lo + reach) / step), F.lit(points - 1)).cast("int")
    z = (F.lit(lo) + F.col("point") * step - F.col("centre")) / h
    sums = (
        cells.where(first <= last)
        .select("centre", "moments", F.explode(F.sequence(first, last)).alias("point"))
        .select("point", "moments", z.alias("z"))
        .groupBy("point")
        .agg(F.sum(F.exp(-F.col("z") * F.col("z") / 2) * _hermite_sum(F.col("moments"), F.col("z"))).alias("s"))
    )
    frame = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    density = F.coalesce("s", F.lit(0.0)) / (n * h * math.sqrt(2 * math.pi))
    curve = frame.join(sums, "point", "left").select(
        "point", (F.lit(lo) + F.col("point") * step).alias("x"), density.alias("density")
    )
    if bins is not None:
        curve = curve.withColumn("scaled", F.col("density") * (n * (hi - lo) / bins))
    return curve.orderBy("point")


def _hermite_sum(weights: Column, z: Column) -> Column:
    """The sum of weights[k] He_k(z), by He_k+1 = z He_k - k He_k-1."""
    zero = F.lit(0.0)
    start = F.struct(zero.alias("k"), F.lit(1.0).alias("he"), zero.alias("before"), zero.alias("total"))

    def term(at: Column, weight: Column) -> Column:
        return F.struct(
            (at["k"] + 1).alias("k"),
            (z * at["he"] - at["k"] * at["before"]).alias("he"),
            at["he"].alias("before"),
            (at["total"] + weight * at["he"]).alias("total"),
        )

    return F.aggregate(weights, start, term, lambda at: at["total"])


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, q1, median, q3, whisker_low, whisker_high, fliers) per group."""
    boxes = _boxes(df, group, value)
    low, high = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    v = F.col("v")
    return (
        _boxed(df, group, value, boxes)
        .groupBy("g", "q1", "median", "q3")
        .agg(
            F.min(F.when(v >= low, v)).alias("whisker_low"),
            F.max(F.when(v <= high, v)).alias("whisker_high"),
            F.count_if((v < low) | (v > high)).alias("fliers"),
        )
        .withColumnRenamed("g", group)
    )


def box_fliers(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, value) of the points drawn one by one beyond the whiskers."""
    boxes = _boxes(df, group, value)
    low, high = F.col("q1") - 1.5 * F.col("iqr"), F.col("q3") + 1.5 * F.col("iqr")
    beyond = (F.col("v") < low) | (F.col("v") > high)
    rows = _boxed(df, group, value, boxes).where(beyond)
    return rows.select(F.col("g").alias(group), F.col("v").alias(value))


def _boxes(df: DataFrame, group: str, value: str) -> DataFrame:
    rows = df.where(F.col(group).isNotNull())
    named = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    table = quantile_table(rows, [value], named, by=[group])
    table = table.select(F.col(group).alias("g"), "q1", "median", "q3", (F.col("q3") - F.col("q1")).alias("iqr"))
    return hold_small(table)


def _boxed(df: DataFrame, group: str, value: str, boxes: DataFrame) -> DataFrame:
    v = F.col(value).cast("double")
    rows = df.select(F.col(group).alias("g"), v.alias("v"))
    return rows.where(F.col("v").isNotNull() & ~F.isnan("v")).join(boxes, "g")


def scatter_points(
    df: DataFrame, x: str, y: str, hue: str, limits: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """All points inside the axes."""
    return within_axes(df.select(x, y, hue), limits or {})


def scatter_grid(df: DataFrame, x: str, y: str, hue: str, dx: float, dy: float) -> DataFrame:
    """(cell_x, cell_y, hue, n): every row counted in a grid of ``dx`` by ``dy`` cells."""
    cell = lambda c, d: F.floor(F.col(c) / F.lit(float(d))).cast("bigint")
    return (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(cell(x, dx).alias("cell_x"), cell(y, dy).alias("cell_y"), F.col(hue))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def scatter_sample(df: DataFrame, key: Sequence[str], x: str, y: str, hue: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` points drawn without replacement, the same ones on every run."""
    keyed = df.withColumn("__h", hash_key(key, seed))
    return lowest_rows(keyed, "__h", n).select(*key, x, y, hue)


def frequency_bars(df: DataFrame, column: str) -> DataFrame:
    """(column, count, position): bars in falling frequency, equal ones by value; any number of them."""
    order = [F.desc("count"), F.asc(column)]
    return rank_rows(value_counts(df, column), order).withColumn("position", F.col("position").cast("int"))


def matrix_cells(df: DataFrame, row: str, columns: Sequence[str]) -> DataFrame:
    """Wide table to (row, column, value) cells."""
    wide = df.select(row, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot([row], list(columns), "column", "value")


def grouped_bars(df: DataFrame, x: str, series: Sequence[str]) -> DataFrame:
    """(x, series, value) of a wide metric table."""
    return matrix_cells(df, x, series).withColumnRenamed("column", "series")


def pivot_bars(df: DataFrame, x: str, series: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long metric table to one column per named series."""
    return df.groupBy(x).pivot(series, list(names)).agg(F.first(value))


def stacked_bars(df: DataFrame, x: str, series: str, value: str, order: Column | None = None) -> DataFrame:
    """Adds ``offset``, the height already stacked below each segment of its bar."""
    below = Window.partitionBy(x).orderBy(F.col(series) if order is None else order)
    return df.withColumn("offset", F.sum(value).over(below) - F.col(value))


def share_labels(df: DataFrame, column: str, order: Sequence[str]) -> DataFrame:
    """(column, count, percentage) for the listed values in their order; absent ones null."""
    from tabstudy.operators.order import reindex

    counts = reindex(value_counts(df, column), column, order)
    total = df.where(F.col(column).isin(list(order))).count()
    return counts.withColumn("percentage", percent_of(F.col("count"), F.lit(total)))


def curve(df: DataFrame, step: str, series: Sequence[str]) -> DataFrame:
    """(series, step, value): one line per named column."""
    wide = df.select(F.col(step).alias("step"), *[F.col(c).cast("double").alias(c) for c in series])
    return wide.unpivot(["step"], list(series), "series", "value").select("series", "step", "value")
