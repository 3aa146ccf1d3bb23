"""The numbers behind each figure."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstudy.catalog.profiles import LINE_NUMS
from tabstudy.catalog.registry import Tables, bind
from tabstudy.operators import plotdata as V
from tabstudy.operators.profile import correlation


def histogram_sql(table: str, column: str, bins: int) -> str:
    return f"""WITH b AS (SELECT min({column}) AS lo, max({column}) AS hi FROM {table}),
    c AS (SELECT least({bins - 1}, CAST(floor(({column} - lo) / (hi - lo) * {bins}) AS INTEGER)) AS bin, count(*) AS n
      FROM {table}, b GROUP BY 1)
    SELECT CAST(r.i AS INTEGER) AS bin, round(lo + r.i * ((hi - lo) / {bins}), 6) AS "left",
      round(lo + (r.i + 1) * ((hi - lo) / {bins}), 6) AS "right", coalesce(n, 0) AS "count"
    FROM range({bins}) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = r.i"""


@bind("viz_01_histogram_60", histogram_sql("orders", "o_totalprice", 60))
def histogram_60(t: Tables):
    h = V.histogram(t.orders, "o_totalprice", 60)
    return h.select("bin", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"), "count")


@bind("viz_01_histogram_30", histogram_sql("events", "value", 30))
def histogram_30(t: Tables):
    h = V.histogram(t.events, "value", 30)
    return h.select("bin", F.round("left", 6).alias("left"), F.round("right", 6).alias("right"), "count")


@bind(
    "viz_02_density",
    """WITH d AS (SELECT l_quantity AS v, count(*) AS c FROM lineitem GROUP BY 1),
    s AS (SELECT count(*) AS n, min(l_quantity) AS lo, max(l_quantity) AS hi,
      stddev_samp(l_quantity) * power(count(*), -1 / 5.0::DOUBLE) AS h FROM lineitem)
    SELECT CAST(g.i AS INTEGER) AS point, round(lo + g.i * ((hi - lo) / 199), 6) AS x,
      round(sum(c * exp(-power((lo + g.i * ((hi - lo) / 199) - v) / h, 2) / 2)) / (any_value(n) * any_value(h)
      * sqrt(2 * pi())), 8) AS density
    FROM range(200) g(i), s, d GROUP BY g.i, lo, hi""",
)
def density(t: Tables):
    curve = V.density_curve(t.lineitem, "l_quantity", 200)
    return curve.select("point", F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


BOX_SQL = """WITH q AS (SELECT o_orderpriority AS g, quantile_cont(o_totalprice, 0.25) AS q1,
  quantile_cont(o_totalprice, 0.5) AS median, quantile_cont(o_totalprice, 0.75) AS q3 FROM {0} GROUP BY 1)"""
SKEWED = """(SELECT o_orderpriority, (o_totalprice / 1e5) * (o_totalprice / 1e5) * (o_totalprice / 1e5)
  * (o_totalprice / 1e5) AS o_totalprice FROM orders)"""


@bind(
    "viz_03_box",
    BOX_SQL.format(SKEWED)
    + f"""SELECT g AS o_orderpriority, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
    round(min(o_totalprice) FILTER (WHERE o_totalprice >= q1 - 1.5 * (q3 - q1)), 4) AS whisker_low,
    round(max(o_totalprice) FILTER (WHERE o_totalprice <= q3 + 1.5 * (q3 - q1)), 4) AS whisker_high,
    count(*) FILTER (WHERE o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)) AS fliers
    FROM {SKEWED} JOIN q ON g = o_orderpriority GROUP BY g, q1, median, q3""",
)
def box(t: Tables):
    b = V.box_stats(_skewed(t), "o_orderpriority", "o_totalprice")
    exact = ("o_orderpriority", "fliers")
    return b.select(*[F.col(c) if c in exact else F.round(c, 4).alias(c) for c in b.columns])


def _skewed(t: Tables):
    x = F.col("o_totalprice") / 1e5
    return t.orders.select("o_orderpriority", (x * x * x * x).alias("o_totalprice"))


@bind(
    "viz_03_box_fliers",
    BOX_SQL.format(SKEWED)
    + f"""SELECT o_orderpriority, round(o_totalprice, 4) AS o_totalprice FROM {SKEWED} JOIN q ON g = o_orderpriority
    WHERE o_totalprice < q1 - 1.5 * (q3 - q1) OR o_totalprice > q3 + 1.5 * (q3 - q1)""",
)
def box_fliers(t: Tables):
    f = V.box_fliers(_skewed(t), "o_orderpriority", "o_totalprice")
    return f.select("o_orderpriority", F.round("o_totalprice", 4).alias("o_totalprice"))


@bind(
    "viz_04_scatter_grid",
    """SELECT CAST(floor(l_quantity / 2.0) AS BIGINT) AS cell_x, CAST(floor(l_extendedprice / 5000.0) AS BIGINT) AS cell_y,
    l_returnflag, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def scatter_grid(t: Tables):
    return V.scatter_grid(t.lineitem, "l_quantity", "l_extendedprice", "l_returnflag", 2, 5000)


@bind(
    "viz_04_scatter_points",
    """SELECT c_custkey AS x, c_acctbal AS y, c_mktsegment AS hue FROM customer
    WHERE c_custkey BETWEEN 0 AND 1000 AND c_acctbal BETWEEN 0 AND 5000""",
)
def scatter_points(t: Tables):
    limits = {"c_custkey": (0, 1000), "c_acctbal": (0, 5000)}
    points = V.scatter_points(t.customer, "c_custkey", "c_acctbal", "c_mktsegment", limits)
    return points.toDF("x", "y", "hue")


@bind(
    "viz_04_scatter_sample",
    """SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders
    ORDER BY md5('42|' || o_orderkey) LIMIT 500""",
)
def scatter_sample(t: Tables):
    return V.scatter_sample(t.orders, ["o_orderkey"], "o_custkey", "o_totalprice", "o_orderstatus", 500)


@bind(
    "viz_05_frequency_bars",
    """SELECT event_type, count(*) AS "count",
    CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) AS INTEGER) AS position FROM events GROUP BY 1""",
)
def frequency_bars(t: Tables):
    return V.frequency_bars(t.events, "event_type")


@bind(
    "viz_06_heatmap_cells",
    " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS \"column\", round(corr({a}, {b}), 9) AS value FROM lineitem"
        for a in LINE_NUMS[:3]
        for b in LINE_NUMS[:3]
    ),
)
def heatmap(t: Tables):
    matrix = V.pivot_bars(correlation(t.lineitem, LINE_NUMS[:3]), "x", "y", "r", LINE_NUMS[:3])
    return V.matrix_cells(matrix, "x", LINE_NUMS[:3]).select("x", "column", F.round("value", 9).alias("value"))


@bind(
    "viz_07_grouped_bars",
    """SELECT c_mktsegment, 'low' AS series, min(c_acctbal) AS value FROM customer GROUP BY 1
    UNION ALL SELECT c_mktsegment, 'high', max(c_acctbal) FROM customer GROUP BY 1""",
)
def grouped_bars(t: Tables):
    wide = t.customer.groupBy("c_mktsegment").agg(F.min("c_acctbal").alias("low"), F.max("c_acctbal").alias("high"))
    return V.grouped_bars(wide, "c_mktsegment", ["low", "high"])


@bind(
    "viz_07_pivot_bars",
    """SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'O') AS "O",
    count(*) FILTER (WHERE l_linestatus = 'F') AS "F" FROM lineitem GROUP BY 1""",
)
def pivot_bars(t: Tables):
    counts = t.lineitem.groupBy("l_returnflag", "l_linestatus").count()
    return V.pivot_bars(counts, "l_returnflag", "l_linestatus", "count", ["O", "F"]).na.fill(0)


@bind(
    "viz_08_stacked_bars",
    """WITH c AS (SELECT o_orderpriority AS x, o_orderstatus AS series, count(*) AS v FROM orders GROUP BY 1, 2)
    SELECT x, series, v, CAST(sum(v) OVER (PARTITION BY x ORDER BY series) - v AS BIGINT) AS "offset" FROM c""",
)
def stacked_bars(t: Tables):
    counts = t.orders.groupBy(F.col("o_orderpriority").alias("x"), F.col("o_orderstatus").alias("series"))
    return V.stacked_bars(counts.agg(F.count(F.lit(1)).alias("v")), "x", "series", "v")


@bind(
    "viz_09_curves",
    """SELECT 'lowest' AS series, l_linenumber AS step, min(l_extendedprice) AS value FROM lineitem GROUP BY 2
    UNION ALL SELECT 'highest', l_linenumber, max(l_extendedprice) FROM lineitem GROUP BY 2""",
)
def curves(t: Tables):
    wide = t.lineitem.groupBy("l_linenumber").agg(
        F.min("l_extendedprice").alias("lowest"), F.max("l_extendedprice").alias("highest")
    )
    return V.curve(wide, "l_linenumber", ["lowest", "highest"])


@bind(
    "viz_05_share_labels",
    """SELECT k.p AS o_orderpriority, c.n AS "count", round(c.n * 100.0::DOUBLE / sum(c.n) OVER (), 6) AS percentage
    FROM (VALUES ('5-LOW'), ('1-URGENT')) k(p)
    LEFT JOIN (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) c ON c.o_orderpriority = k.p""",
)
def share_labels(t: Tables):
    table = V.share_labels(t.orders, "o_orderpriority", ["5-LOW", "1-URGENT"])
    return table.withColumn("percentage", F.round("percentage", 6))
