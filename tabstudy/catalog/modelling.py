"""Feature preparation and model fitting over the given tables."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window, functions as F

from tabstudy.catalog.registry import Tables, bind
from tabstudy.functions.columns import label_of
from tabstudy.models.iterative import LogisticSAGA, RidgeLSQR
from tabstudy.models.linear import Logistic, Ridge, linear_history
from tabstudy.models.mlp import NeuralNet
from tabstudy.models.target import ScaledTarget, label_scale
from tabstudy.models.trees import boosting, forest
from tabstudy.operators import features as FE
from tabstudy.operators.profile import drop_identifiers
from tabstudy.operators.vocabulary import hot_slots, vocabulary
from tabstudy.plans import experiment as E
from tabstudy.session import hold_spread

SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def unfolded(encoded: DataFrame, keys: list[str]) -> DataFrame:
    """The feature vector as one column per slot."""
    x = encoded.select(*keys, vector_to_array(FE.FEATURES).alias("x"))
    names = FE.feature_names(encoded)
    return x.select(*keys, *[F.round(F.get("x", F.lit(i)), 6).alias(n) for i, n in enumerate(names)])


def hot_sql(column: str, values: list[str], table: str, key: str) -> str:
    cells = ", ".join(f"CASE WHEN {column} = '{v}' THEN 1.0 ELSE 0.0 END::DOUBLE AS \"{column}_{v}\"" for v in values)
    return f"SELECT {key}, {cells} FROM {table}"


@bind(
    "fe_01_z_score",
    """SELECT event_id, round((value - m) / s, 6) AS z, 0.0::DOUBLE AS constant
    FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS s FROM events)""",
)
def z_score(t: Tables):
    rows = t.events.select("event_id", "value", F.lit(7).alias("seven"))
    model = FE.ZScore(inputCols=["value", "seven"], outputCols=["z", "constant"]).fit(rows)
    return model.transform(rows).select("event_id", F.round("z", 6).alias("z"), "constant")


@bind("fe_02_one_hot_drop_first", hot_sql("c_mktsegment", SEGMENTS[1:], "customer", "c_custkey"))
def one_hot_drop_first(t: Tables):
    fitted = FE.preprocessor([], ["c_mktsegment"], drop_first=True).fit(t.customer)
    return unfolded(FE.encode(fitted, t.customer), ["c_custkey"])


@bind(
    "fe_03_one_hot_ignore_unknown",
    hot_sql("c_mktsegment", [s for s in SEGMENTS if s != "BUILDING"], "customer", "c_custkey"),
)
def one_hot_ignore_unknown(t: Tables):
    seen = t.customer.where("c_mktsegment <> 'BUILDING'")
    fitted = FE.preprocessor([], ["c_mktsegment"]).fit(seen)
    return unfolded(FE.encode(fitted, t.customer), ["c_custkey"])


@bind(
    "fe_03_one_hot_table",
    """SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS name_slot,
      (SELECT count(DISTINCT p_name) FROM part) + dense_rank() OVER (ORDER BY p_brand) - 1 AS brand_slot FROM part""",
)
def one_hot_table(t: Tables):
    """Slots of a column with very many categories and one with few, looked up in a vocabulary kept as a table."""
    columns = ["p_name", "p_brand"]
    rows = hot_slots(t.part, ["p_partkey"], columns, vocabulary(t.part, columns))
    return rows.select("p_partkey", F.get("slots", F.lit(0)).alias("name_slot"), F.get("slots", F.lit(1)).alias("brand_slot"))


@bind(
    "fe_04_column_composition",
    """SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS o_totalprice,
    (o_orderstatus = 'O')::INT::DOUBLE AS "o_orderstatus_O", (o_orderstatus = 'P')::INT::DOUBLE AS "o_orderstatus_P"
    FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)""",
)
def composition(t: Tables):
    fitted = FE.preprocessor(["o_totalprice"], ["o_orderstatus"], drop_first=True).fit(t.orders)
    return unfolded(FE.encode(fitted, t.orders), ["o_orderkey"])


@bind(
    "fe_05_median_imputation",
    """SELECT p_partkey, coalesce(v, (SELECT quantile_cont(v, 0.5) FROM
      (SELECT CASE WHEN p_size % 7 <> 0 THEN p_size::DOUBLE END AS v FROM part)))  AS filled
    FROM (SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_size::DOUBLE END AS v FROM part)""",
)
def median_imputation(t: Tables):
    rows = t.part.select("p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_size").cast("double")).alias("v"))
    return FE.MedianImputer(inputCols=["v"], outputCols=["filled"]).fit(rows).transform(rows).drop("v")


@bind(
    "fe_06_mode_imputation",
    """WITH r AS (SELECT o_orderkey, nullif(o_orderpriority, '3-MEDIUM') AS v FROM orders)
    SELECT o_orderkey, coalesce(v, (SELECT v FROM r WHERE v IS NOT NULL GROUP BY v ORDER BY count(*) DESC, v LIMIT 1))
    AS filled FROM r""",
)
def mode_imputation(t: Tables):
    rows = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("3-MEDIUM")).alias("v"))
    return FE.ModeImputer(inputCols=["v"], outputCols=["filled"]).fit(rows).transform(rows).drop("v")


@bind(
    "fe_07_fit_then_transform",
    """WITH r AS (SELECT p_partkey, CASE WHEN p_size % 7 <> 0 THEN p_size::DOUBLE END AS p_size,
      nullif(p_type, 'PROMO') AS p_type FROM part),
    f AS (SELECT * FROM r WHERE p_partkey % 10 < 7),
    d AS (SELECT quantile_cont(p_size, 0.5) AS med FROM f),
    s AS (SELECT avg(coalesce(p_size, med)) AS m, stddev_pop(coalesce(p_size, med)) AS s FROM f, d),
    k AS (SELECT p_type AS mode FROM f WHERE p_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, p_type LIMIT 1)
    SELECT p_partkey, round((coalesce(p_size, med) - m) / s, 6) AS p_size,
      (coalesce(p_type, mode) = 'STANDARD')::INT::DOUBLE AS standard FROM r, d, s, k""",
)
def fit_then_transform(t: Tables):
    size = F.when(F.col("p_size") % 7 != 0, F.col("p_size").cast("double"))
    rows = t.part.select("p_partkey", size.alias("p_size"), F.nullif("p_type", F.lit("PROMO")).alias("p_type"))
    fitted = FE.preprocessor(["p_size"], ["p_type"], impute=True).fit(rows.where("p_partkey % 10 < 7"))
    cells = unfolded(FE.encode(fitted, rows), ["p_partkey"])
    return cells.select("p_partkey", "p_size", F.col("p_type_STANDARD").alias("standard"))


@bind(
    "fe_08_dense_sparse",
    """SELECT CAST(5 AS BIGINT) AS width, count(*) AS filled FROM customer""",
)
def dense_sparse(t: Tables):
    fitted = FE.preprocessor([], ["c_mktsegment"]).fit(t.customer)
    encoded = FE.dense(FE.encode(fitted, t.customer))
    filled = F.sum(F.size(F.filter("x", lambda v: v != 0)))
    return encoded.agg(F.max(F.size("x")).cast("bigint").alias("width"), filled.alias("filled"))


@bind(
    "fe_09_target_scaling",
    """SELECT o_orderkey, round((o_totalprice - m) / s, 6) AS z, round(o_totalprice, 4) AS back
    FROM orders, (SELECT avg(o_totalprice) AS m, stddev_pop(o_totalprice) AS s FROM orders)""",
)
def target_scaling(t: Tables):
    mean, sd = label_scale(t.orders, "o_totalprice")
    z = (F.col("o_totalprice") - F.lit(mean)) / F.lit(sd)
    return t.orders.select("o_orderkey", F.round(z, 6).alias("z"), F.round(z * F.lit(sd) + F.lit(mean), 4).alias("back"))


def ridge_sql(rows: str, alpha: str) -> str:
    """Closed form of ridge with two features a, b and label y."""
    return f"""WITH d AS (SELECT * FROM {rows}),
    s AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(y) AS my FROM d),
    g AS (SELECT sum((a - ma) * (a - ma)) + {alpha} AS aa, sum((b - mb) * (b - mb)) + {alpha} AS bb,
      sum((a - ma) * (b - mb)) AS ab, sum((a - ma) * (y - my)) AS ga, sum((b - mb) * (y - my)) AS gb FROM d, s),
    w AS (SELECT (ga * bb - gb * ab) / (aa * bb - ab * ab) AS wa, (gb * aa - ga * ab) / (aa * bb - ab * ab) AS wb FROM g)"""


@bind(
    "fe_10_scaled_target_regressor",
    ridge_sql("(SELECT p_partkey AS id, p_size::DOUBLE AS a, (p_partkey % 13)::DOUBLE AS b, p_retailprice AS y FROM part)", "1.0")
    + " SELECT id, round(my + wa * (a - ma) + wb * (b - mb), 5) AS prediction FROM d, s, w",
)
def scaled_target(t: Tables):
    rows = part_rows(t)
    model = ScaledTarget(Ridge(alpha=1.0, labelCol="y")).fit(rows)
    return model.transform(rows).select("id", F.round("prediction", 5).alias("prediction"))


def part_rows(t: Tables) -> DataFrame:
    rows = t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_size").cast("double").alias("a"),
        (F.col("p_partkey") % 13).cast("double").alias("b"),
        F.col("p_retailprice").alias("y"),
    )
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


@bind(
    "fe_11_clone",
    "SELECT true AS same, count(*) AS n FROM part",
)
def clone(t: Tables):
    """A copied, unfitted chain fits to the same values."""
    chain = FE.preprocessor(["p_size"], ["p_type"])
    a = FE.encode(chain.fit(t.part), t.part, "features").withColumnRenamed("features", "first")
    b = FE.encode(chain.copy().fit(t.part), t.part, "features").select("p_partkey", F.col("features").alias("second"))
    same = F.bool_and(vector_to_array("first") == vector_to_array("second"))
    return a.select("p_partkey", "first").join(b, "p_partkey").agg(same.alias("same"), F.count(F.lit(1)).alias("n"))


@bind(
    "fe_12_encoded_width",
    """SELECT 1 + count(DISTINCT o_orderstatus) - 1 + count(DISTINCT o_orderpriority) - 1 AS drop_first,
    1 + count(DISTINCT o_orderstatus) + count(DISTINCT o_orderpriority) AS keep_all FROM orders""",
)
def encoded_width(t: Tables):
    numeric, cats = ["o_totalprice"], ["o_orderstatus", "o_orderpriority"]
    widths = [
        FE.encoded_width(FE.encode(FE.preprocessor(numeric, cats, drop_first=d).fit(t.orders), t.orders))
        for d in (True, False)
    ]
    return t.spark.createDataFrame([tuple(widths)], "drop_first bigint, keep_all bigint")


@bind("fe_13_drop_identifier", "SELECT c_custkey, c_mktsegment FROM customer")
def drop_identifier(t: Tables):
    rows = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    return drop_identifiers(rows, ["c_name", "c_mktsegment"], max_cardinality=100)


def logistic_sql(steps: int = 9) -> str:
    """Newton's method on counts per distinct feature value, C = 1, one feature x and an intercept."""
    sql = """WITH d AS (SELECT l_quantity / 50 AS x, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS pos
      FROM lineitem GROUP BY 1), w0 AS (SELECT 0.0::DOUBLE AS w, 0.0::DOUBLE AS b)"""
    for i in range(steps):
        sql += f""", g{i} AS (SELECT any_value(w) AS w, any_value(b) AS b,
          any_value(w) + sum((n * p - pos) * x) AS gw, sum(n * p - pos) AS gb, 1 + sum(n * p * (1 - p) * x * x) AS hww,
          sum(n * p * (1 - p) * x) AS hwb, sum(n * p * (1 - p)) AS hbb
          FROM (SELECT *, 1 / (1 + exp(-(w * x + b))) AS p FROM d, w{i})),
        w{i + 1} AS (SELECT w - (gw * hbb - gb * hwb) / (hww * hbb - hwb * hwb) AS w,
          b - (gb * hww - gw * hwb) / (hww * hbb - hwb * hwb) AS b FROM g{i})"""
    return sql + f" SELECT round(w, 5) AS weight, round(b, 5) AS intercept FROM w{steps}"


def returned(t: Tables) -> DataFrame:
    label = label_of("l_returnflag", "R").cast("double").alias("label")
    rows = t.lineitem.select((F.col("l_quantity") / 50).alias("x"), label)
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)


def fit_returned(t: Tables, classifier: Logistic):
    train = hold_spread(returned(t))
    try:
        return classifier.fit(train)
    finally:
        train.unpersist()


@bind("ml_01_logistic", logistic_sql())
def logistic(t: Tables):
    model = fit_returned(t, Logistic(tol=1e-12))
    found = [(round(float(model.coefficients[0]), 5), round(float(model.intercept), 5))]
    return t.spark.createDataFrame(found, "weight double, intercept double")


@bind("ml_02_logistic_loose", "SELECT true AS near, count(*) AS n FROM lineitem")
def logistic_loose(t: Tables):
    """The same objective with the looser stopping rule: probabilities agree to one per cent."""
    rows = hold_spread(returned(t))
    tight = Logistic(tol=1e-12, predictionCol="p1").fit(rows).setProbabilityCol("q1").setRawPredictionCol("r1")
    loose = Logistic(maxIter=500, tol=1e-3, predictionCol="p2").fit(rows).setProbabilityCol("q2").setRawPredictionCol("r2")
    both = loose.transform(tight.transform(rows))
    gap = F.abs(F.get(vector_to_array("q1"), F.lit(1)) - F.get(vector_to_array("q2"), F.lit(1)))
    return both.agg((F.max(gap) < 0.01).alias("near"), F.count(F.lit(1)).alias("n"))


@bind("ml_02_saga", f"SELECT round(weight, 2) AS weight, round(intercept, 2) AS intercept FROM ({logistic_sql()})")
def logistic_saga(t: Tables):
    """The same objective by a gradient memory per row: the optimum that Newton's method finds, to two digits."""
    label = label_of("l_returnflag", "R").cast("double").alias("label")
    rows = t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") / 50).alias("x"), label)
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = LogisticSAGA(key=["l_orderkey", "l_linenumber"], tol=1e-4).fit(rows)
    found = [(round(float(model.coefficients[0]), 2), round(model.intercept, 2))]
    return t.spark.createDataFrame(found, "weight double, intercept double")


LINES = "(SELECT l_quantity AS a, l_discount * 100 AS b, l_extendedprice AS y FROM lineitem)"


@bind(
    "ml_04_ridge",
    ridge_sql(LINES, "1000.0")
    + " SELECT round(wa, 4) AS wa, round(wb, 4) AS wb, round(my - wa * ma - wb * mb, 3) AS intercept FROM s, w",
)
def ridge(t: Tables):
    rows = t.lineitem.select(
        F.col("l_quantity").alias("a"), (F.col("l_discount") * 100).alias("b"), F.col("l_extendedprice").alias("y")
    )
    model = Ridge(alpha=1000.0, labelCol="y").fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows))
    wa, wb = (round(float(c), 4) for c in model.coefficients)
    return t.spark.createDataFrame([(wa, wb, round(float(model.intercept), 3))], "wa double, wb double, intercept double")


@bind(
    "ml_05_ridge_predictions",
    ridge_sql("(SELECT o_orderkey AS id, (o_custkey % 17)::DOUBLE AS a, (o_orderkey % 5)::DOUBLE AS b, o_totalprice AS y FROM orders)", "1.0")
    + " SELECT id, round(my + wa * (a - ma) + wb * (b - mb), 3) AS prediction FROM d, s, w",
)
def ridge_predictions(t: Tables):
    rows = t.orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 17).cast("double").alias("a"),
        (F.col("o_orderkey") % 5).cast("double").alias("b"),
        F.col("o_totalprice").alias("y"),
    )
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    model = Ridge(alpha=1.0, labelCol="y").fit(rows)
    return model.transform(rows).select("id", F.round("prediction", 3).alias("prediction"))


@bind(
    "ml_05_lsqr",
    ridge_sql(LINES, "1000.0")
    + " SELECT round(wa, 4) AS wa, round(wb, 4) AS wb, round(my - wa * ma - wb * mb, 3) AS intercept FROM s, w",
)
def ridge_lsqr(t: Tables):
    """Ridge by bidiagonalisation: the coefficients of the normal equations without forming them."""
    rows = t.lineitem.select(
        F.col("l_quantity").alias("a"), (F.col("l_discount") * 100).alias("b"), F.col("l_extendedprice").alias("y")
    )
    rows = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    model = RidgeLSQR(alpha=1000.0, labelCol="y").fit(rows)
    wa, wb = (round(float(c), 4) for c in model.coefficients)
    return t.spark.createDataFrame([(wa, wb, round(model.intercept, 3))], "wa double, wb double, intercept double")


def stump_sql(rounds: int, weight: float = 0.1, start: str = "sum(s) OVER () / sum(n) OVER ()") -> str:
    """Least-squares boosting with one-split trees over p_size, from the mean of the label on."""
    sql = f"""WITH d AS (SELECT p_size AS x, count(*)::DOUBLE AS n, sum(p_retailprice) AS s FROM part GROUP BY 1),
    f0 AS (SELECT x, ({start})::DOUBLE AS f FROM d)"""
    for i in range(rounds):
        sql += f""", r{i} AS (SELECT x, n, s - n * f AS e, f FROM d JOIN f{i} USING (x)),
        c{i} AS (SELECT x AS cut, sum(n) OVER (ORDER BY x) AS nl, sum(e) OVER (ORDER BY x) AS el,
          sum(n) OVER () AS nt, sum(e) OVER () AS et FROM r{i}),
        b{i} AS (SELECT * FROM c{i} WHERE nl < nt ORDER BY el * el / nl + (et - el) * (et - el) / (nt - nl) DESC, cut LIMIT 1),
        f{i + 1} AS (SELECT x, f + {weight} * CASE WHEN x <= cut THEN el / nl ELSE (et - el) / (nt - nl) END AS f
          FROM r{i}, b{i})"""
    return sql + f" SELECT p_partkey AS id, round(f, 4) AS prediction FROM part JOIN f{rounds} ON x = p_size"


def size_rows(t: Tables) -> DataFrame:
    rows = t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("x"), F.col("p_retailprice").alias("label")
    )
    return VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)


@bind("ml_06_single_split_forest", stump_sql(1, 1.0, "0.0"))
def single_split_forest(t: Tables):
    """Trees without row sampling all make the same, closed-form split."""
    rows = size_rows(t)
    model = forest(trees=3, depth=1).setParams(bootstrap=False).fit(rows)
    return model.transform(rows).select("id", F.round("prediction", 4).alias("prediction"))


@bind(
    "ml_06_random_forest",
    """SELECT count(*) AS n, round(var_pop(p_retailprice), 2) AS mean_loss, true AS bounded, true AS learned, true AS same
    FROM part""",
)
def random_forest(t: Tables):
    """Means of training labels stay within their range and beat the mean; bags do not depend on the partitions."""
    rows = part_rows(t).withColumnRenamed("y", "label")
    fitted = forest(trees=10, depth=8, key=["id"]).fit(rows)
    other = forest(trees=10, depth=8, key=["id"]).fit(rows.repartition(5))
    scored = other.setPredictionCol("other").transform(fitted.transform(rows))
    loss, spread = F.avg(F.pow(F.col("prediction") - F.col("label"), 2)), F.var_pop("label")
    low, high = rows.agg(F.min("label"), F.max("label")).first()
    return scored.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(spread, 2).alias("mean_loss"),
        F.bool_and(F.col("prediction").between(low, high)).alias("bounded"),
        (loss < spread).alias("learned"),
        (F.max(F.abs(F.col("prediction") - F.col("other"))) < 1e-6).alias("same"),
    )


@bind("ml_07_gradient_boosting", stump_sql(4))
def gradient_boosting(t: Tables):
    rows = size_rows(t)
    return boosting(rounds=4, depth=1).fit(rows).transform(rows).select("id", F.round("prediction", 4).alias("prediction"))


def event_rows(t: Tables) -> DataFrame:
    """Events with a binary label that their value explains in a non-linear way."""
    fitted = FE.preprocessor(["value"], ["event_type"]).fit(t.events)
    rows = FE.encode(fitted, t.events)
    mid = t.events.agg(F.percentile("value", [0.3, 0.7])).first()[0]
    between = F.col("value").between(mid[0], mid[1])
    return rows.select("event_id", "features", between.cast("double").alias("label"), F.col("value").alias("y"))


#: What the best linear function of ``value`` leaves of the label of ``event_rows``, and that a network leaves half as much.
NET_FACTS = """SELECT count(*) AS n, round(var_pop(y) * (1 - power(corr(value, y), 2)), 6) AS linear_loss, true AS learned
  FROM (SELECT value, (CASE WHEN value BETWEEN q[1] AND q[2] THEN 1 ELSE 0 END * {0} - {1})::DOUBLE AS y FROM events,
  (SELECT quantile_cont(value, [0.3, 0.7]) AS q FROM events))"""


def net_facts(model, rows: DataFrame, column: str) -> DataFrame:
    scored = model.transform(rows)
    linear = F.var_pop("label") * (1 - F.pow(F.corr("y", "label"), 2))
    return scored.agg(
        F.count(column).alias("n"),
        F.round(linear, 6).alias("linear_loss"),
        (F.avg(F.pow(F.col(column) - F.col("label"), 2)) < linear / 2).alias("learned"),
    )


@bind("ml_03_neural_classifier", NET_FACTS.format(1, 0))
def neural_classifier(t: Tables):
    rows = event_rows(t)
    net = NeuralNet(
        hidden=(64, 32), loss="logloss", lr=5e-3, epochs=20, l2=1e-4, early_stopping=True, patience=8, key=["event_id"]
    )
    return net_facts(net.fit(rows), rows, "probability")


@bind("ml_08_neural_regressor", NET_FACTS.format(2, 1))
def neural_regressor(t: Tables):
    rows = event_rows(t).withColumn("label", F.col("label") * 2 - 1)
    return net_facts(NeuralNet(lr=5e-3, epochs=4, key=["event_id"]).fit(rows), rows, "prediction")


@bind("ml_09_scaled_neural_regressor", "SELECT count(*) AS n, count(*) AS scored, true AS learned FROM part")
def scaled_neural_regressor(t: Tables):
    rows = part_rows(t).withColumnRenamed("y", "label")
    model = ScaledTarget(NeuralNet(hidden=(32, 16), epochs=8, patience=20, key=["id"])).fit(rows)
    learned = model.inner.rows[-1][1] < model.inner.rows[0][1]
    return model.transform(rows).agg(
        F.count(F.lit(1)).alias("n"), F.count("prediction").alias("scored"), F.lit(learned).alias("learned")
    )


@bind("ml_10_deep_network", NET_FACTS.format(1, 0))
def deep_network(t: Tables):
    rows = event_rows(t)
    net = NeuralNet(
        lr=5e-3, epochs=16, batch_size=512, l2=0.0, weight_decay=1e-5, batch_norm=True, dropout=0.1, key=["event_id"]
    )
    return net_facts(net.fit(rows), rows, "prediction")


@bind("ml_11_predict_class", "SELECT l_returnflag, 0.0::DOUBLE AS prediction, count(*) AS n FROM lineitem GROUP BY 1")
def predict_class(t: Tables):
    """The flag does not depend on the quantity, so every row gets the larger class."""
    model = fit_returned(t, Logistic(tol=1e-9))
    rows = t.lineitem.select((F.col("l_quantity") / 50).alias("x"), "l_returnflag")
    scored = model.transform(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows))
    return scored.groupBy("l_returnflag", "prediction").agg(F.count(F.lit(1)).alias("n"))


@bind(
    "ml_12_predict_probability",
    logistic_sql().rsplit(" SELECT ", 1)[0]
    + " SELECT x, round(1 / (1 + exp(-(w * x + b))), 4) AS probability, n FROM d, w9",
)
def predict_probability(t: Tables):
    model = fit_returned(t, Logistic(tol=1e-12))
    rows = returned(t).groupBy("x").agg(F.count(F.lit(1)).alias("n"))
    scored = model.transform(VectorAssembler(inputCols=["x"], outputCol="features").transform(rows))
    return E.positive_scores(model, scored).select("x", F.round("score", 4).alias("probability"), "n")


#: What predicting the mean of the label of ``event_rows`` costs, for rows that ``where`` selects.
MEAN_LOSS = """SELECT avg(y) * (1 - avg(y)) AS loss FROM (SELECT event_id, CASE WHEN value BETWEEN q[1] AND q[2] THEN 1 ELSE 0
  END::DOUBLE AS y FROM events, (SELECT quantile_cont(value, [0.3, 0.7]) AS q FROM events)) WHERE {where}"""


@bind(
    "ml_13_training_history",
    f"""SELECT 'net' AS series, e::INTEGER AS epoch, true AS finite, true AS rooted, e > 0 AS lower, round(loss, 6) AS mean_loss,
    true AS beats_mean FROM range(0, 3) r(e), ({MEAN_LOSS.format(where="true")})""",
)
def training_history(t: Tables):
    """Every epoch measured; losses fall below those before and end below a mean predictor's."""
    rows = event_rows(t)
    model = NeuralNet(epochs=3, key=["event_id"]).fit_with_history(rows, rows)
    history = model.history(rows)
    mean_loss = rows.agg(F.var_pop("label")).first()[0]
    order = Window.partitionBy("series").orderBy("epoch")
    last = F.last("val_loss").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    finite = F.coalesce(F.abs(F.col("train_loss")) + F.abs(F.col("val_loss")) < float("inf"), F.lit(False))
    return history.select(
        "series",
        (F.col("epoch") - F.min("epoch").over(Window.partitionBy("series"))).cast("int").alias("epoch"),
        finite.alias("finite"),
        (F.abs(F.col("val_rmse") * F.col("val_rmse") / F.col("val_loss") - 1) < 1e-6).alias("rooted"),
        F.coalesce(F.col("train_loss") < F.lag("train_loss").over(order), F.lit(False)).alias("lower"),
        F.lit(round(mean_loss, 6)).alias("mean_loss"),
        (last < F.lit(mean_loss)).alias("beats_mean"),
    )


@bind(
    "ml_13_objective_history",
    logistic_sql().rsplit(" SELECT ", 1)[0]
    + """ SELECT round(any_value(w * w) / 2 / sum(n) + sum(n * ln(1 + exp(w * x + b)) - pos * (w * x + b)) / sum(n), 6) AS final,
    true AS falls, round(ln(sum(n)) - (sum(pos) * ln(sum(pos)) + sum(n - pos) * ln(sum(n - pos))) / sum(n), 6) AS start
    FROM d, w9""",
)
def objective_history(t: Tables):
    """The objective starts at the label's entropy, never rises, and ends at its minimum."""
    history = linear_history(fit_returned(t, Logistic(maxIter=50, tol=1e-12)))
    values = [r["loss"] for r in history.orderBy("epoch").collect()]  # one per iteration
    falls = all(b <= a + 1e-12 for a, b in zip(values, values[1:], strict=False))
    found = [(round(values[-1], 6), falls, round(values[0], 6))]
    return t.spark.createDataFrame(found, "final double, falls boolean, start double")


@bind(
    "ml_14_tuning",
    f"""SELECT config, 8 AS epochs, round(t.loss, 6) AS train_mean_loss, round(v.loss, 6) AS val_mean_loss, true AS learned
    FROM (VALUES ('base'), ('faster'), ('wider')) x(config), ({MEAN_LOSS.format(where="event_id % 5 <> 0")}) t,
    ({MEAN_LOSS.format(where="event_id % 5 = 0")}) v""",
)
def tuning(t: Tables):
    """Each configuration is trained: on both parts it beats the part's own mean."""
    rows = event_rows(t)
    train, val = rows.where("event_id % 5 <> 0"), rows.where("event_id % 5 = 0")
    configs = {
        "base": NeuralNet(epochs=8, key=["event_id"]),
        "faster": NeuralNet(epochs=8, lr=0.005, key=["event_id"]),
        "wider": NeuralNet(hidden=(256, 128, 64), epochs=8, key=["event_id"]),
    }
    table, _ = E.tuning(configs, train, val)
    mean_train, mean_val = (d.agg(F.var_pop("label")).first()[0] for d in (train, val))
    learned = F.col("train_mse").between(0, mean_train) & F.col("val_mse").between(0, mean_val) & (F.col("seconds") > 0)
    return table.select(
        "config",
        "epochs",
        F.lit(round(mean_train, 6)).alias("train_mean_loss"),
        F.lit(round(mean_val, 6)).alias("val_mean_loss"),
        learned.alias("learned"),
    )


@bind(
    "ml_15_model_registry",
    """SELECT m.name AS model, count(*) AS n FROM part, (VALUES ('ridge'), ('forest'), ('boosting')) m(name) GROUP BY 1""",
)
def model_registry(t: Tables):
    rows = part_rows(t).withColumnRenamed("y", "label")
    models = {"ridge": Ridge(), "forest": forest(trees=3, depth=4), "boosting": boosting(rounds=3, depth=3)}
    scored, columns = E.score_all(E.fit_all(models, rows), rows)
    counts = scored.agg(*[F.count(c).alias(name) for name, c in columns.items()])
    return counts.unpivot([], list(columns), "model", "n")


@bind("ml_16_early_stopping", "SELECT true AS stopped, true AS best_kept FROM (SELECT count(*) FROM events)")
def early_stopping(t: Tables):
    """A label that nothing explains stops the training before the last epoch."""
    noise = F.pmod(F.xxhash64("event_id"), F.lit(2)).cast("double")
    rows = event_rows(t).withColumn("label", noise)
    net = NeuralNet(
        hidden=(8,), loss="logloss", epochs=40, early_stopping=True, patience=2, tol=0.05, key=["event_id"]
    )
    model = net.fit(rows)
    return t.spark.createDataFrame([(model.epochs < 40, model.state is not None)], "stopped boolean, best_kept boolean")


@bind("ml_17_batched_scoring", "SELECT true AS same, count(*) AS n FROM events")
def batched_scoring(t: Tables):
    """Scores do not depend on how the rows are batched or partitioned."""
    rows = event_rows(t)
    model = NeuralNet(epochs=1, key=["event_id"]).fit(rows)
    one = model.transform(rows).select("event_id", F.col("prediction").alias("p"))
    two = model.transform(rows.repartition(7, "event_id")).select("event_id", F.col("prediction").alias("q"))
    same = F.bool_and(F.abs(F.col("p") - F.col("q")) < 1e-5)
    return one.join(two, "event_id").agg(same.alias("same"), F.count(F.lit(1)).alias("n"))
