"""Table profile: category shares, quality counts, outliers, summaries, correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabstudy.functions.columns import outside, percent_of, round_half_even
from tabstudy.functions.text import percent_text, thousands
from tabstudy.operators.quantiles import quantile_table
from tabstudy.session import SMALL_ROWS, collect_bounded, small_table

QUARTILES = {"q1": 0.25, "q3": 0.75}


def long_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) pairs of all ``columns`` from one scan, nulls dropped."""
    texts = [F.col(c).cast("string").alias(c) for c in columns]
    tall = df.select(*texts).unpivot([], list(columns), "column", "value")
    return tall.where(F.col("value").isNotNull())


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(column, count), most frequent first, equal counts by value; nulls dropped."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(column))
    )


def value_shares(df: DataFrame, column: str, decimals: int | None = 2) -> DataFrame:
    """(column, percentage) of the non-null rows, largest first."""
    total = df.agg(F.count(column)).first()[0]
    share = percent_of(F.col("count"), F.lit(total))
    if decimals is not None:
        share = round_half_even(share, decimals)
    return value_counts(df, column).select(column, share.alias("percentage"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, cardinality): exact, hot values collapse before the shuffle."""
    names = small_table(df.sparkSession, [(c,) for c in columns], "column string")
    counted = (
        long_categories(df, columns).distinct().groupBy("column").agg(F.count("value").alias("cardinality"))
    )
    return names.join(counted, "column", "left").na.fill(0, ["cardinality"])


def approximate_distinct_counts(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """One-scan sketch alternative of ``distinct_counts``."""
    row = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return row.unpivot([], list(columns), "column", "cardinality")


def _category_counts(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    counts = long_categories(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    totals = counts.groupBy("column").agg(
        F.sum("count").alias("total"), F.count(F.lit(1)).alias("cardinality")
    )
    # one row per profiled column, so never larger than the schema
    return counts, F.broadcast(totals)


def categorical_profile(df: DataFrame, columns: Sequence[str], decimals: int = 2) -> DataFrame:
    """(column, cardinality, value, count, percentage) of all ``columns`` from one scan."""
    counts, totals = _category_counts(df, columns)
    share = round_half_even(percent_of(F.col("count"), F.col("total")), decimals)
    return (
        counts.join(totals, "column")
        .select("column", "cardinality", "value", "count", share.alias("percentage"))
        .orderBy("column", F.desc("count"), "value")
    )


def nested_profile(df: DataFrame, columns: Sequence[str], limit: int = SMALL_ROWS) -> dict:
    """The profile as ``{column: {cardinality, distribution: {value: {count, percentage}}}}``.

    A report document: refused when the columns hold more than ``limit`` values together.
    """
    rows = collect_bounded(categorical_profile(df, columns), limit, "nested profile")
    document: dict = {c: {"cardinality": 0, "distribution": {}} for c in columns}
    for r in rows:
        entry = document[r["column"]]
        entry["cardinality"] = r["cardinality"]
        entry["distribution"][r["value"]] = {"count": r["count"], "percentage": r["percentage"]}
    return document


def dominant_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column with formatted count and share."""
    counts, totals = _category_counts(df, columns)
    top = counts.groupBy("column").agg(F.min(F.struct(-F.col("count"), F.col("value"))).alias("top"))
    count = -F.col("top.col1")
    return top.join(totals, "column").select(
        "column",
        "cardinality",
        F.col("top.value").alias("value"),
        thousands(count).alias("count_text"),
        percent_text(percent_of(count, F.col("total"))).alias("percent_text"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column in one scan; NaN counts as missing."""

    def missing(field: T.StructField) -> Column:
        test = F.col(field.name).isNull()
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            test = test | F.isnan(field.name)
        return F.count_if(test).alias(field.name)

    row = df.agg(*[missing(f) for f in df.schema.fields])
    return row.unpivot([], df.columns, "column", "nulls")


def duplicate_count(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """One row: rows that repeat an earlier one. Leave key columns out of ``subset``."""
    columns = list(subset or df.columns)
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def iqr_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, q1, q3, lower, upper, outliers, percent) by the 1.5 IQR rule."""
    spread = F.col("q3") - F.col("q1")
    bounds = (
        quantile_table(df, columns, QUARTILES)
        .withColumns({"lower": F.col("q1") - 1.5 * spread, "upper": F.col("q3") + 1.5 * spread})
        .collect()  # one row per column
    )
    cells = []
    for i, b in enumerate(bounds):
        cells.append(F.count_if(outside(b["column"], b["lower"], b["upper"])).alias(f"n{i}"))
    if not bounds:
        schema = "column string, q1 double, q3 double, lower double, upper double, outliers bigint, percent double"
        return small_table(df.sparkSession, [], schema)
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *cells)
    entries = [
        F.struct(
            F.lit(b["column"]).alias("column"),
            *[F.lit(b[c]).alias(c) for c in ("q1", "q3", "lower", "upper")],
            F.col(f"n{i}").alias("outliers"),
            percent_of(F.col(f"n{i}"), F.col("rows")).alias("percent"),
        )
        for i, b in enumerate(bounds)
    ]
    return counted.select(F.inline(F.array(*entries)))


def describe(
    df: DataFrame, columns: Sequence[str], decimals: int = 2
) -> DataFrame:
    """(statistic, one column per input): count, mean, std, min, quartiles, max, all exact."""
    basic = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    also = {name: f("value").cast("double") for name, f in basic.items()}
    rows = quantile_table(df, columns, {"25%": 0.25, "50%": 0.5, "75%": 0.75}, also=also).collect()  # one row per column
    known = {r["column"]: r for r in rows}
    order = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]

    def cell(statistic: str, column: str) -> Column:
        found = known[column][statistic] if column in known else 0.0 if statistic == "count" else None
        return round_half_even(F.lit(found).cast("double"), decimals).alias(column)

    entries = [F.struct(F.lit(s).alias("statistic"), *[cell(s, c) for c in columns]) for s in order]
    return df.sparkSession.range(1).select(F.inline(F.array(*entries)))


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r) for every ordered pair; rows with a null in the pair are left out of it."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = df.agg(*[F.corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    entries = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            entries.append(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"r{i}").alias("r")))
    return row.select(F.inline(F.array(*entries))).orderBy("x", "y")


def group_means(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, mean), ascending by mean; rows without a key are dropped."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(value).alias("mean"))
        .orderBy(F.asc_nulls_last("mean"), key)
    )


def column_total(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max"), F.sum(column).alias("sum"))


def label_mean(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.avg(label).alias("mean"))


def split_summary(df: DataFrame, split: str, label: str) -> DataFrame:
    """(split, n, pct_total, pct_positive, pct_negative) for a 0/1 label."""
    sizes = df.groupBy(split).agg(F.count(F.lit(1)).alias("n"), F.avg(label).alias("p"))
    total = df.count()
    return sizes.select(
        F.col(split).alias("split"),
        "n",
        percent_of(F.col("n"), F.lit(total)).alias("pct_total"),
        (F.col("p") * 100).alias("pct_positive"),
        ((1 - F.col("p")) * 100).alias("pct_negative"),
    )


def class_distribution(df: DataFrame, split: str, label: str, decimals: int = 4) -> DataFrame:
    """(split, label, n, share) sorted by split and class; shares are within the split."""
    cells = df.where(F.col(label).isNotNull()).groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    totals = cells.groupBy(split).agg(F.sum("n").alias("total"))
    return (
        cells.alias("c")
        .join(totals.alias("t"), F.col(f"c.{split}").eqNullSafe(F.col(f"t.{split}")))
        .select(
            F.col(f"c.{split}").alias(split),
            F.col(f"c.{label}").alias(label),
            "n",
            round_half_even(F.col("n") / F.col("total"), decimals).alias("share"),
        )
        .orderBy(split, label)
    )


def balance_summary(samples: dict[str, DataFrame], label: str) -> DataFrame:
    """(technique, n, pct_positive, pct_negative) of each named training sample."""
    tagged = None
    for name, sample in samples.items():
        part = sample.select(F.lit(name).alias("technique"), F.col(label).alias("label"))
        tagged = part if tagged is None else tagged.unionByName(part)
    share = F.avg("label") * 100
    return tagged.groupBy("technique").agg(
        F.count(F.lit(1)).alias("n"),
        share.alias("pct_positive"),
        (F.lit(100) - share).alias("pct_negative"),
    )


def balance_counts(samples: dict[str, DataFrame], label: str) -> DataFrame:
    """(technique, n0, n1) of each named training sample."""
    tagged = None
    for name, sample in samples.items():
        part = sample.select(F.lit(name).alias("technique"), F.col(label).alias("label"))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy("technique").agg(
        F.count_if(F.col("label") == 0).alias("n0"), F.count_if(F.col("label") == 1).alias("n1")
    )


def drop_identifiers(df: DataFrame, columns: Sequence[str], max_cardinality: int) -> DataFrame:
    """Drop those of ``columns`` whose distinct count exceeds ``max_cardinality``."""
    found = {r["column"]: r["cardinality"] for r in distinct_counts(df, columns).collect()}
    return df.drop(*[c for c in columns if found[c] > max_cardinality])

