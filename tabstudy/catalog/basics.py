"""Sources and sinks, projections, filters, sorts, text and arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstudy.catalog.registry import Tables, bind
from tabstudy.functions import columns as C, text as X
from tabstudy.operators import order as O
from tabstudy.operators.profile import categorical_profile, value_counts
from tabstudy.session import scratch_path
from tabstudy.sources import tables as S

ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@bind("src_01_csv_scan", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def csv_scan(t: Tables):
    path = scratch_path(t.spark, "orders-csv")
    S.write_csv(t.orders.select(*ORDER_COLUMNS), path)
    return S.read_csv(t.spark, path, ORDER_SCHEMA)


@bind("src_02_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def preview(t: Tables):
    return S.preview(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 5)


@bind(
    "src_03_shape",
    "SELECT count(*) AS n_rows, (SELECT count(*) FROM (DESCRIBE lineitem)) AS n_columns FROM lineitem",
)
def shape(t: Tables):
    return S.shape(t.lineitem)


PROFILE_SQL = """
WITH long AS (
  SELECT 'l_returnflag' AS "column", l_returnflag AS value FROM lineitem
  UNION ALL SELECT 'l_linestatus', l_linestatus FROM lineitem),
counts AS (SELECT "column", value, count(*) AS "count" FROM long WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT "column", count(*) OVER (PARTITION BY "column") AS cardinality, value, "count",
  round_even("count" * 100.0::DOUBLE / sum("count") OVER (PARTITION BY "column") * 100, 0) / 100 AS percentage
FROM counts"""


@bind("snk_01_json_lines", PROFILE_SQL)
def json_lines(t: Tables):
    profile = categorical_profile(t.lineitem, ["l_returnflag", "l_linestatus"])
    path = scratch_path(t.spark, "profile-json")
    S.write_json_lines(profile, path)
    return t.spark.read.schema(profile.schema).json(path)


@bind(
    "snk_02_csv_rounded",
    "SELECT c_custkey, c_name, round_even(c_acctbal * 10, 0) / 10 AS c_acctbal FROM customer",
)
def csv_rounded(t: Tables):
    path = scratch_path(t.spark, "customer-csv")
    S.write_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), path, decimals=1)
    return S.read_csv(t.spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@bind("prj_01_select", "SELECT c_custkey, c_mktsegment FROM customer")
def select(t: Tables):
    return C.select_columns(t.customer, ["c_custkey", "c_mktsegment"])


@bind("prj_02_drop", "SELECT p_partkey, p_brand, p_type, p_size, p_retailprice FROM part")
def drop(t: Tables):
    return C.drop_if_present(t.part, "p_name", "row_number")


@bind(
    "prj_03_binary_label",
    """SELECT o_orderkey, CASE WHEN nullif(o_orderpriority, '5-LOW') = '1-URGENT' THEN 1 ELSE 0 END AS urgent
    FROM orders""",
)
def binary_label(t: Tables):
    holes = t.orders.withColumn("p", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return holes.select("o_orderkey", C.label_of("p", "1-URGENT").alias("urgent"))


@bind("prj_04_numeric_columns", "SELECT p_partkey, p_size, p_retailprice FROM part")
def numeric(t: Tables):
    return t.part.select(*C.numeric_columns(t.part))


@bind("prj_04_other_columns", "SELECT p_name, p_brand, p_type FROM part")
def non_numeric(t: Tables):
    return t.part.select(*C.non_numeric_columns(t.part))


@bind(
    "prj_05_round",
    """SELECT o_orderkey, round_even(o_totalprice / 7 * 100, 0) / 100 AS r2,
    round_even(floor(o_totalprice) / 2, 0) AS half FROM orders""",
)
def rounding(t: Tables):
    half = C.round_half_even(F.floor("o_totalprice") / 2, 0)
    return t.orders.select(
        "o_orderkey", C.round_half_even(F.col("o_totalprice") / 7, 2).alias("r2"), half.alias("half")
    )


@bind(
    "prj_06_cast_int",
    """SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority,
    TRY_CAST(o_orderpriority AS BIGINT) AS dirty FROM orders""",
)
def cast_int(t: Tables):
    return t.orders.select(
        "o_orderkey",
        C.to_int(F.substring("o_orderpriority", 1, 1)).alias("priority"),
        C.to_int("o_orderpriority", strict=False).alias("dirty"),
    )


@bind(
    "prj_07_percent_of_total",
    """SELECT o_orderstatus, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 6) AS pct
    FROM orders GROUP BY o_orderstatus""",
)
def percent(t: Tables):
    total = t.orders.count()
    counts = t.orders.groupBy("o_orderstatus").count()
    return counts.select("o_orderstatus", F.round(C.percent_of(F.col("count"), F.lit(total)), 6).alias("pct"))


@bind(
    "prj_08_replace",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' ELSE o_orderstatus END
    AS o_orderstatus FROM orders""",
)
def replace(t: Tables):
    return C.replace_values(
        t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": "final", "O": "open"}
    )


@bind(
    "prj_09_map",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'now' WHEN '2-HIGH' THEN 'soon' END AS label
    FROM orders""",
)
def mapping(t: Tables):
    labels = {"1-URGENT": "now", "2-HIGH": "soon"}
    return C.map_values(t.orders, "o_orderpriority", labels, "label").select("o_orderkey", "label")


@bind(
    "prj_09_map_long",
    "SELECT c_custkey, CASE WHEN c_custkey % 1000 < 500 THEN 'bucket ' || (c_custkey % 1000) END AS label FROM customer",
)
def mapping_long(t: Tables):
    labels = {i: f"bucket {i}" for i in range(500)}
    rows = t.customer.select("c_custkey", (F.col("c_custkey") % 1000).alias("m"))
    return C.map_values(rows, "m", labels, "label").select("c_custkey", "label")


@bind("prj_10_complement", "SELECT l_orderkey, l_linenumber, round(1 - l_discount, 6) AS kept FROM lineitem")
def complement(t: Tables):
    kept = F.round(C.complement("l_discount", 1.0), 6).alias("kept")
    return t.lineitem.select("l_orderkey", "l_linenumber", kept)


@bind(
    "flt_01_out_of_range",
    "SELECT count(*) FILTER (WHERE l_quantity < 5 OR l_quantity > 45) AS outliers FROM lineitem",
)
def out_of_range(t: Tables):
    return t.lineitem.agg(F.count_if(C.outside("l_quantity", 5, 45)).alias("outliers"))


@bind("flt_02_equal", "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def equal(t: Tables):
    return C.where_equal(t.customer, "c_mktsegment", "BUILDING").select("c_custkey", "c_acctbal")


@bind(
    "flt_03_membership",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P')
    AND o_orderpriority IN ('1-URGENT', '5-LOW')""",
)
def membership(t: Tables):
    allowed = {"o_orderstatus": ["F", "P"], "o_orderpriority": ["1-URGENT", "5-LOW"]}
    return C.where_in(t.orders, allowed).select("o_orderkey")


@bind("flt_03_membership_long", "SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 AND c_custkey < 3000")
def membership_long(t: Tables):
    return C.where_in(t.customer, {"c_custkey": list(range(0, 3000, 3))}).select("c_custkey")


@bind(
    "flt_04_axis_range",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice BETWEEN 1000 AND 130000 AND o_custkey BETWEEN 0 AND 900""",
)
def axis_range(t: Tables):
    limits = {"o_totalprice": (1000, 130000), "o_custkey": (0, 900)}
    return C.within_axes(t.orders, limits).select("o_orderkey", "o_totalprice")


@bind(
    "srt_01_multi_key",
    "SELECT c_mktsegment, c_nationkey, c_acctbal FROM customer ORDER BY c_mktsegment, c_acctbal DESC",
)
def multi_key(t: Tables):
    rows = t.customer.select("c_mktsegment", "c_nationkey", "c_acctbal")
    return O.sort_rows(rows, ["c_mktsegment", "c_acctbal"], [True, False])


@bind("srt_02_best_row", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1")
def best(t: Tables):
    rows = t.orders.select("o_orderkey", "o_totalprice")
    return O.best_row(rows, ["o_totalprice", "o_orderkey"], [False, True])


@bind("srt_03_by_key", 'SELECT p_size, count(*) AS "count" FROM part GROUP BY p_size ORDER BY p_size')
def by_key(t: Tables):
    return O.sort_by_key(value_counts(t.part, "p_size"), "p_size")


@bind(
    "srt_04_category_order",
    """SELECT o_orderpriority, CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 END AS place,
    count(*) AS n FROM orders GROUP BY 1 ORDER BY 2 NULLS LAST, 1""",
)
def category_order(t: Tables):
    order = ["5-LOW", "1-URGENT"]
    counts = t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    placed = counts.withColumn("place", O.category_position("o_orderpriority", order).cast("int"))
    return O.sort_by_category(placed, "o_orderpriority", order, "o_orderpriority")


@bind(
    "srt_05_reindex",
    """SELECT k.p AS o_orderpriority, c.n AS "count" FROM (VALUES ('5-LOW'), ('9-NONE'), ('1-URGENT')) k(p)
    LEFT JOIN (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) c ON c.o_orderpriority = k.p""",
)
def reindex(t: Tables):
    counts = value_counts(t.orders, "o_orderpriority")
    return O.reindex(counts, "o_orderpriority", ["5-LOW", "9-NONE", "1-URGENT"])


@bind(
    "srt_05_reindex_strict",
    "SELECT o_orderpriority, count(*) AS \"count\" FROM orders WHERE o_orderpriority IN ('5-LOW', '1-URGENT') GROUP BY 1",
)
def reindex_strict(t: Tables):
    counts = value_counts(t.orders, "o_orderpriority")
    return O.reindex(counts, "o_orderpriority", ["5-LOW", "1-URGENT"], missing="raise")


@bind(
    "srt_06_keyed_rows",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'",
)
def keyed_rows(t: Tables):
    # rows carry their keys, so a filtered table needs no new row numbers
    return C.where_equal(t.orders, "o_orderstatus", "P").select("o_orderkey", "o_totalprice")


@bind(
    "str_01_split",
    """SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS rank, split_part(o_orderpriority, '-', 2) AS name
    FROM orders""",
)
def split(t: Tables):
    return X.split_columns(t.orders, "o_orderpriority", "-", ["rank", "name"]).select("o_orderkey", "rank", "name")


@bind(
    "str_02_strip",
    "SELECT c_custkey, regexp_replace(' ' || c_name || chr(9), '^\\s+|\\s+$', '', 'g') AS name FROM customer",
)
def strip(t: Tables):
    padded = F.concat(F.lit(" "), "c_name", F.lit("\t"))
    return t.customer.select("c_custkey", X.strip(padded).alias("name"))


@bind("str_03_replace_literal", "SELECT p_partkey, replace(p_brand, '#', '.') AS brand FROM part")
def replace_literal(t: Tables):
    return t.part.select("p_partkey", X.replace_literal("p_brand", "#", ".").alias("brand"))


@bind(
    "str_04_thousands",
    """SELECT o_orderkey, replace(format('{:,}', CAST(floor(o_totalprice) AS BIGINT)), ',', '.') AS price
    FROM orders""",
)
def thousands(t: Tables):
    return t.orders.select("o_orderkey", X.thousands(F.floor("o_totalprice")).alias("price"))


@bind(
    "str_05_percent",
    "SELECT l_orderkey, l_linenumber, replace(printf('%.2f %%', l_discount * 100), '.', ',') AS pct FROM lineitem",
)
def percent_text(t: Tables):
    shown = X.percent_text(F.col("l_discount") * 100).alias("pct")
    return t.lineitem.select("l_orderkey", "l_linenumber", shown)


@bind(
    "str_06_count_pair",
    """SELECT o_orderpriority, count(*) FILTER (WHERE o_orderstatus = 'P') || ' / ' ||
    coalesce(nullif(count(*) FILTER (WHERE o_orderstatus = 'X'), 0), 0) AS pair FROM orders GROUP BY 1""",
)
def count_pair(t: Tables):
    counts = t.orders.groupBy("o_orderpriority").pivot("o_orderstatus", ["P", "X"]).count()
    return counts.select("o_orderpriority", X.count_pair(F.col("P"), F.col("X")).alias("pair"))


@bind("str_07_prefix", "SELECT p_partkey FROM part WHERE starts_with(p_type, 'STANDARD') OR starts_with(p_brand, 'Brand#1')")
def prefix(t: Tables):
    return t.part.where(X.has_prefix("p_type", "STANDARD") | X.has_prefix("p_brand", "Brand#1")).select("p_partkey")


@bind(
    "str_08_metric_label",
    """SELECT c_mktsegment, printf('%s (AVG=%.3f)', c_mktsegment, avg(c_acctbal)) AS label
    FROM customer GROUP BY 1""",
)
def metric_label(t: Tables):
    means = t.customer.groupBy("c_mktsegment").agg(F.avg("c_acctbal").alias("m"))
    return means.select("c_mktsegment", X.metric_label("c_mktsegment", "AVG", "m").alias("label"))


@bind("mth_01_sqrt", "SELECT o_orderkey, round(sqrt(o_totalprice), 6) AS root FROM orders")
def root(t: Tables):
    return t.orders.select("o_orderkey", F.round(C.square_root("o_totalprice"), 6).alias("root"))


@bind(
    "mth_02_choose",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE -1.0 END AS v FROM orders",
)
def choose(t: Tables):
    v = C.choose(F.col("o_orderstatus") == "F", F.col("o_totalprice"), -1.0)
    return t.orders.select("o_orderkey", v.alias("v"))


@bind(
    "mth_03_normalise",
    "SELECT o_orderkey, round(o_totalprice / (SELECT sum(o_totalprice) FROM orders) * 1e6, 6) AS w FROM orders",
)
def normalise(t: Tables):
    weighted = C.normalise_weights(t.orders, "o_totalprice", "w")
    return weighted.select("o_orderkey", F.round(F.col("w") * 1e6, 6).alias("w"))


@bind(
    "mth_04_unscale",
    """SELECT o_orderkey, round(o_totalprice / 1e5 * s.sd + s.mean, 4) AS y FROM orders,
    (SELECT avg(o_totalprice) AS mean, stddev_pop(o_totalprice) AS sd FROM orders) s""",
)
def unscale(t: Tables):
    mean, sd = t.orders.agg(F.avg("o_totalprice"), F.stddev_pop("o_totalprice")).first()
    y = C.unscale(F.col("o_totalprice") / 1e5, mean, sd)
    return t.orders.select("o_orderkey", F.round(y, 4).alias("y"))
