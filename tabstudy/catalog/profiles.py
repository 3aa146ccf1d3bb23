"""Aggregations, quality counts and the profile of a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstudy.catalog.registry import Tables, bind
from tabstudy.functions.columns import label_of
from tabstudy.operators import profile as P
from tabstudy.operators.quantiles import approximate_quantiles, exact_quantiles

# orders with a fixed three-way part by key and a 0/1 label, for tables per split
SPLIT_SQL = """(SELECT CASE WHEN o_orderkey % 10 < 7 THEN 'train' WHEN o_orderkey % 10 < 9 THEN 'val' ELSE 'test' END
  AS split, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label FROM orders)"""


def with_split(t: Tables):
    digit = F.col("o_orderkey") % 10
    part = F.when(digit < 7, "train").when(digit < 9, "val").otherwise("test")
    return t.orders.select("o_orderkey", part.alias("split"), label_of("o_orderpriority", "1-URGENT").alias("label"))


def long_sql(pairs: list[tuple[str, str]], kind: str) -> str:
    """Union of (column, value) over (table, column) pairs."""
    parts = [f"SELECT '{c}' AS \"column\", CAST({c} AS {kind}) AS value FROM {table}" for table, c in pairs]
    return " UNION ALL ".join(parts)


ORDER_CATS = ["o_orderstatus", "o_orderpriority"]
PART_CATS = ["p_brand", "p_type"]
LINE_NUMS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


@bind(
    "agg_01_value_counts",
    """SELECT r AS flag, count(*) AS "count" FROM (SELECT nullif(l_returnflag, 'N') AS r FROM lineitem)
    WHERE r IS NOT NULL GROUP BY r""",
)
def value_counts(t: Tables):
    return P.value_counts(t.lineitem.select(F.nullif("l_returnflag", F.lit("N")).alias("flag")), "flag")


@bind(
    "agg_02_value_shares",
    """SELECT r AS flag, round_even(count(*) * 100.0::DOUBLE / sum(count(*)) OVER () * 100, 0) / 100 AS percentage
    FROM (SELECT nullif(l_returnflag, 'N') AS r FROM lineitem) WHERE r IS NOT NULL GROUP BY r""",
)
def value_shares(t: Tables):
    return P.value_shares(t.lineitem.select(F.nullif("l_returnflag", F.lit("N")).alias("flag")), "flag")


@bind(
    "agg_03_distinct_counts",
    f"""SELECT "column", count(DISTINCT value) AS cardinality
    FROM ({long_sql([("orders", c) for c in [*ORDER_CATS, "o_custkey"]], "VARCHAR")}) GROUP BY 1""",
)
def distinct_counts(t: Tables):
    return P.distinct_counts(t.orders, [*ORDER_CATS, "o_custkey"])


@bind(
    "agg_03_approximate_distinct",
    """SELECT 'o_custkey' AS "column", count(DISTINCT o_custkey) > 0 AS close FROM orders""",
)
def approximate_distinct(t: Tables):
    exact = t.orders.agg(F.count_distinct("o_custkey")).first()[0]
    near = F.abs(F.col("cardinality") / exact - 1) < 0.1
    return P.approximate_distinct_counts(t.orders, ["o_custkey"]).select("column", near.alias("close"))


def profile_sql(table: str, columns: list[str]) -> str:
    return f"""WITH counts AS (SELECT "column", value, count(*) AS "count"
      FROM ({long_sql([(table, c) for c in columns], "VARCHAR")}) WHERE value IS NOT NULL GROUP BY 1, 2)
    SELECT "column", count(*) OVER (PARTITION BY "column") AS cardinality, value, "count",
      round_even("count" * 100.0::DOUBLE / sum("count") OVER (PARTITION BY "column") * 100, 0) / 100 AS percentage
    FROM counts"""


@bind("agg_04_categorical_profile", profile_sql("part", PART_CATS))
def categorical_profile(t: Tables):
    return P.categorical_profile(t.part, PART_CATS)


@bind("agg_04_profile_events", profile_sql("events", ["event_type", "user_id"]))
def profile_events(t: Tables):
    return P.categorical_profile(t.events, ["event_type", "user_id"])


@bind("agg_04_profile_documents", profile_sql("documents", ["lang", "source"]))
def profile_documents(t: Tables):
    return P.categorical_profile(t.documents, ["lang", "source"])


@bind(
    "agg_05_dominant_category",
    f"""WITH counts AS (SELECT "column", value, count(*) AS n
      FROM ({long_sql([("orders", c) for c in ORDER_CATS], "VARCHAR")}) GROUP BY 1, 2),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) AS r,
      count(*) OVER (PARTITION BY "column") AS cardinality, sum(n) OVER (PARTITION BY "column") AS total FROM counts)
    SELECT "column", cardinality, value, replace(format('{{:,}}', n), ',', '.') AS count_text,
      replace(printf('%.2f %%', n * 100.0::DOUBLE / total), '.', ',') AS percent_text FROM ranked WHERE r = 1""",
)
def dominant(t: Tables):
    return P.dominant_categories(t.orders, ORDER_CATS)


@bind(
    "agg_06_null_counts",
    """SELECT 'p_partkey' AS "column", count(*) FILTER (WHERE p_partkey IS NULL) AS nulls FROM part
    UNION ALL SELECT 'size', count(*) FILTER (WHERE p_size % 7 = 0) FROM part
    UNION ALL SELECT 'price', count(*) FILTER (WHERE p_size % 5 = 0) FROM part""",
)
def null_counts(t: Tables):
    size = F.when(F.col("p_size") % 7 != 0, F.col("p_size"))
    price = F.when(F.col("p_size") % 5 != 0, F.col("p_retailprice")).otherwise(F.lit(float("nan")))
    return P.null_counts(t.part.select("p_partkey", size.alias("size"), price.alias("price")))


@bind(
    "agg_07_duplicates",
    """SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM
    (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def duplicates(t: Tables):
    return P.duplicate_count(t.lineitem, ["l_orderkey", "l_linenumber"])


@bind(
    "agg_07_duplicates_all_columns",
    "SELECT (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)) AS duplicates",
)
def duplicates_all(t: Tables):
    return P.duplicate_count(t.lineitem)


QUANTILE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({p} AS DOUBLE) AS prob, round(quantile_cont({c}, {p}), 6) AS value
    FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice")
    for p in (0.25, 0.5, 0.9)
)


@bind("agg_08_quantile", QUANTILE_SQL)
def quantile(t: Tables):
    table = exact_quantiles(t.lineitem, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.9])
    return table.select("column", "prob", F.round("value", 6).alias("value"))


@bind("agg_08_quantile_narrowed", QUANTILE_SQL)
def quantile_narrowed(t: Tables):
    """Few bins, so that brackets are narrowed in many scans: the same result."""
    table = exact_quantiles(t.lineitem, ["l_quantity", "l_extendedprice"], [0.25, 0.5, 0.9], bins=256)
    return table.select("column", "prob", F.round("value", 6).alias("value"))


@bind(
    "agg_08_quantile_approximate",
    """SELECT 'l_extendedprice' AS "column", CAST(0.5 AS DOUBLE) AS prob, true AS close""",
)
def quantile_approximate(t: Tables):
    table = approximate_quantiles(t.lineitem, ["l_extendedprice"], [0.5])
    exact = exact_quantiles(t.lineitem, ["l_extendedprice"], [0.5]).first()["value"]
    return table.select("column", "prob", (F.abs(F.col("value") / exact - 1) < 0.01).alias("close"))


IQR_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q1 - 1.5 * (q3 - q1), 6) AS lower,
    round(q3 + 1.5 * (q3 - q1), 6) AS upper,
    count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers,
    round(count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) * 100.0::DOUBLE / count(*), 6)
    AS percent FROM (SELECT {e} AS v FROM {t}), (SELECT quantile_cont({e}, 0.25) AS q1, quantile_cont({e}, 0.75) AS q3
    FROM {t}) GROUP BY q1, q3"""
    for t, c, e in (
        ("events", "value", "CAST(value AS DOUBLE)"),
        ("events", "squared", "value * value"),
    )
)


@bind("agg_09_iqr_report", IQR_SQL)
def iqr_report(t: Tables):
    rows = t.events.select("value", (F.col("value") * F.col("value")).alias("squared"))
    report = P.iqr_report(rows, ["value", "squared"])
    exact = ("column", "outliers")
    return report.select(*[F.col(c) if c in exact else F.round(c, 6).alias(c) for c in report.columns])


@bind(
    "agg_10_describe",
    """WITH s AS (SELECT statistic, any_value(a) FILTER (WHERE c = 'l_quantity') AS l_quantity,
      any_value(a) FILTER (WHERE c = 'l_extendedprice') AS l_extendedprice FROM ("""
    + " UNION ALL ".join(
        f"SELECT '{c}' AS c, '{n}' AS statistic, CAST({e.format(c)} AS DOUBLE) AS a FROM lineitem"
        for c in ("l_quantity", "l_extendedprice")
        for n, e in {
            "count": "count({})",
            "mean": "avg({})",
            "std": "stddev_samp({})",
            "min": "min({})",
            "25%": "quantile_cont({}, 0.25)",
            "50%": "quantile_cont({}, 0.5)",
            "75%": "quantile_cont({}, 0.75)",
            "max": "max({})",
        }.items()
    )
    + """) GROUP BY statistic)
    SELECT statistic, round_even(l_quantity * 100, 0) / 100 AS l_quantity,
    round_even(l_extendedprice * 100, 0) / 100 AS l_extendedprice FROM s""",
)
def describe(t: Tables):
    return P.describe(t.lineitem, ["l_quantity", "l_extendedprice"])


@bind(
    "agg_11_correlation",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 9) AS r FROM lineitem"
        for a in LINE_NUMS
        for b in LINE_NUMS
    ),
)
def correlation(t: Tables):
    return P.correlation(t.lineitem, LINE_NUMS).select("x", "y", F.round("r", 9).alias("r"))


@bind(
    "agg_11_correlation_with_nulls",
    """SELECT x, y, round(r, 9) AS r FROM (
      SELECT 'a' AS x, 'b' AS y, corr(CASE WHEN p_size % 7 <> 0 THEN p_size END, p_retailprice) AS r FROM part
      UNION ALL SELECT 'b', 'a', corr(CASE WHEN p_size % 7 <> 0 THEN p_size END, p_retailprice) FROM part
      UNION ALL SELECT 'a', 'a', 1.0 UNION ALL SELECT 'b', 'b', 1.0)""",
)
def correlation_nulls(t: Tables):
    a = F.when(F.col("p_size") % 7 != 0, F.col("p_size"))
    rows = t.part.select(a.alias("a"), F.col("p_retailprice").alias("b"))
    return P.correlation(rows, ["a", "b"]).select("x", "y", F.round("r", 9).alias("r"))


@bind(
    "agg_12_group_mean",
    "SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean FROM customer GROUP BY 1",
)
def group_mean(t: Tables):
    return P.group_means(t.customer, "c_mktsegment", "c_acctbal").select("c_mktsegment", F.round("mean", 6).alias("mean"))


@bind(
    "agg_13_split_summary",
    f"""SELECT split, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 6) AS pct_total,
    round(avg(label) * 100, 6) AS pct_positive, round((1 - avg(label)) * 100, 6) AS pct_negative
    FROM {SPLIT_SQL} GROUP BY split""",
)
def split_summary(t: Tables):
    table = P.split_summary(with_split(t), "split", "label")
    return table.select("split", "n", *[F.round(c, 6).alias(c) for c in table.columns[2:]])


@bind(
    "agg_14_class_distribution",
    f"""SELECT split, label, count(*) AS n,
    round_even(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY split) * 10000, 0) / 10000 AS share
    FROM {SPLIT_SQL} GROUP BY split, label""",
)
def class_distribution(t: Tables):
    return P.class_distribution(with_split(t), "split", "label")


@bind(
    "agg_15_balance_summary",
    f"""SELECT technique, count(*) AS n, round(avg(label) * 100, 6) AS pct_positive,
    round(100 - avg(label) * 100, 6) AS pct_negative FROM (
      SELECT 'none' AS technique, label FROM {SPLIT_SQL}
      UNION ALL SELECT 'train', label FROM {SPLIT_SQL} WHERE split = 'train') GROUP BY technique""",
)
def balance_summary(t: Tables):
    rows = with_split(t)
    table = P.balance_summary({"none": rows, "train": rows.where("split = 'train'")}, "label")
    return table.select("technique", "n", *[F.round(c, 6).alias(c) for c in table.columns[2:]])


@bind("agg_16_max_sum", "SELECT max(p_size) AS max, CAST(sum(p_size) AS BIGINT) AS sum FROM part")
def max_sum(t: Tables):
    return P.column_total(t.part, "p_size")


@bind(
    "agg_17_label_mean",
    "SELECT round(avg(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END), 9) AS mean FROM orders",
)
def label_mean(t: Tables):
    return P.label_mean(with_split(t), "label").select(F.round("mean", 9).alias("mean"))
