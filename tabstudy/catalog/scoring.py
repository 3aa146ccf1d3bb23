"""Metrics over a label and a prediction or score that the tables already hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstudy.catalog.registry import Tables, bind
from tabstudy.operators import metrics as M
from tabstudy.plans import experiment as E

CALLED = """(SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS p,
  l_quantity AS s FROM lineitem)"""
COUNTS = f"""(SELECT count(*) FILTER (WHERE y = 1 AND p = 1)::DOUBLE AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn FROM {CALLED})"""


def called(t: Tables):
    y = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    p = F.when(F.col("l_quantity") > 25, 1).otherwise(0)
    return t.lineitem.select(y.alias("y"), p.alias("p"), F.col("l_quantity").alias("s"))


def toxic(t: Tables):
    return t.labels.join(t.documents, "doc_id").select(F.col("toxic").alias("y"), F.col("n_chars").alias("s"))


TOXIC = "(SELECT toxic AS y, n_chars AS s FROM labels JOIN documents USING (doc_id))"


@bind("met_01_accuracy", f"SELECT round((tp + tn) / (tp + fp + fn + tn), 9) AS accuracy FROM {COUNTS}")
def accuracy(t: Tables):
    return called(t).agg(F.round(M.accuracy("y", "p"), 9).alias("accuracy"))


@bind("met_02_precision", f"SELECT round(tp / (tp + fp), 9) AS precision, 0.0::DOUBLE AS undefined FROM {COUNTS}")
def precision(t: Tables):
    rows = called(t).withColumn("never", F.lit(0))
    return rows.agg(
        F.round(M.precision("y", "p"), 9).alias("precision"), M.precision("y", "never").alias("undefined")
    )


@bind("met_03_recall", f"SELECT round(tp / (tp + fn), 9) AS recall FROM {COUNTS}")
def recall(t: Tables):
    return called(t).agg(F.round(M.recall("y", "p"), 9).alias("recall"))


@bind("met_04_f1", f"SELECT round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM {COUNTS}")
def f1(t: Tables):
    return called(t).agg(F.round(M.f1("y", "p"), 9).alias("f1"))


@bind(
    "met_04_all_by_group",
    """SELECT l_linestatus, round(avg(CASE WHEN y = p THEN 1 ELSE 0 END), 9) AS accuracy,
    round(sum(y * p) / sum(p)::DOUBLE, 9) AS precision, round(sum(y * p) / sum(y)::DOUBLE, 9) AS recall,
    round(2 * sum(y * p) / (sum(y) + sum(p))::DOUBLE, 9) AS f1 FROM (SELECT l_linestatus,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS p FROM lineitem)
    GROUP BY 1""",
)
def all_by_group(t: Tables):
    y = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    p = F.when(F.col("l_quantity") > 25, 1).otherwise(0)
    rows = t.lineitem.select("l_linestatus", y.alias("y"), p.alias("p"))
    m = M.classification_metrics(rows, "y", "p", by=["l_linestatus"])
    return m.select("l_linestatus", *[F.round(c, 9).alias(c) for c in m.columns[1:]])


def running_sql(rows: str) -> str:
    return f"""WITH c AS (SELECT s, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg
      FROM {rows} GROUP BY s),
    r AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, lead(pos) OVER w AS np, lead(neg) OVER w AS nn,
      row_number() OVER w AS rn, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg FROM c
      WINDOW w AS (ORDER BY s DESC))"""


AUC = "SELECT round(sum(neg * (tp - pos / 2.0::DOUBLE)) / (any_value(all_pos) * any_value(all_neg)::DOUBLE), 9) AS auc FROM r"
CURVE = """SELECT 0.0::DOUBLE AS fpr, 0.0::DOUBLE AS tpr, CAST('inf' AS DOUBLE) AS threshold
  UNION ALL SELECT round(fp / all_neg::DOUBLE, 9), round(tp / all_pos::DOUBLE, 9), s::DOUBLE FROM r
  WHERE rn = 1 OR np IS NULL OR pos <> np OR neg <> nn"""


@bind("met_05_roc_auc", running_sql(CALLED) + AUC)
def auc(t: Tables):
    return M.roc_auc(called(t), "y", "s").select(F.round("auc", 9).alias("auc"))


@bind("met_05_roc_auc_documents", running_sql(TOXIC) + AUC)
def auc_documents(t: Tables):
    return M.roc_auc(toxic(t), "y", "s").select(F.round("auc", 9).alias("auc"))


def _rounded(curve):
    return curve.select(F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"), "threshold")


@bind("met_06_roc_curve", running_sql(CALLED) + CURVE)
def curve(t: Tables):
    return _rounded(M.roc_curve(called(t), "y", "s"))


@bind("met_06_roc_curve_documents", running_sql(TOXIC) + CURVE)
def curve_documents(t: Tables):
    return _rounded(M.roc_curve(toxic(t), "y", "s"))


@bind(
    "met_07_confusion_matrix",
    f"""SELECT CAST(a AS INTEGER) AS actual, CAST(b AS INTEGER) AS predicted, (SELECT count(*) FROM {CALLED} WHERE y = a AND p = b) AS n
    FROM (VALUES (0), (1), (2)) x(a), (VALUES (0), (1), (2)) z(b)""",
)
def confusion(t: Tables):
    return M.confusion_matrix(called(t), "y", "p", classes=(0, 1, 2))


# two hand-made price rules stand in for fitted models: they read the table and need no fit
RULES = """(SELECT CASE WHEN p_partkey % 10 < 7 THEN 'train' WHEN p_partkey % 10 < 9 THEN 'val' ELSE 'test' END AS split,
  p_retailprice AS y, 900 + 10.0 * p_size AS a, 1400 + 0.1 * (p_partkey % 100) AS b FROM part)"""


def rules(t: Tables):
    digit = F.col("p_partkey") % 10
    part = F.when(digit < 7, "train").when(digit < 9, "val").otherwise("test")
    return t.part.select(
        part.alias("split"),
        F.col("p_retailprice").alias("y"),
        (900 + 10.0 * F.col("p_size")).alias("a"),
        (1400 + 0.1 * (F.col("p_partkey") % 100)).alias("b"),
    )


def error_sql(p: str) -> str:
    return f"""round(avg((y - {p}) * (y - {p})), 4) AS mse, round(sqrt(avg((y - {p}) * (y - {p}))), 6) AS rmse,
    round(avg(abs(y - {p})), 6) AS mae, round(1 - avg((y - {p}) * (y - {p})) / var_pop(y), 8) AS r2"""


def _round_errors(m):
    places = {"mse": 4, "rmse": 6, "mae": 6, "r2": 8}
    return m.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in m.columns])


@bind(
    "met_08_mse_rmse",
    f"""SELECT round(avg((y - a) * (y - a)), 4) AS mse, round(sqrt(avg((y - a) * (y - a))), 6) AS rmse
    FROM {RULES}""",
)
def mse_rmse(t: Tables):
    return _round_errors(rules(t).agg(M.mse("y", "a").alias("mse"), F.sqrt(M.mse("y", "a")).alias("rmse")))


@bind("met_09_mae", f"SELECT round(avg(abs(y - a)), 6) AS mae FROM {RULES}")
def mae(t: Tables):
    return _round_errors(rules(t).agg(M.mae("y", "a").alias("mae")))


@bind("met_10_r2", f"SELECT round(1 - avg((y - b) * (y - b)) / var_pop(y), 8) AS r2 FROM {RULES}")
def r2(t: Tables):
    return _round_errors(rules(t).agg(M.r2("y", "b").alias("r2")))


SPLIT_METRICS = f"""SELECT 'a' AS model, split, {error_sql("a")} FROM {RULES} GROUP BY split
  UNION ALL SELECT 'b', split, {error_sql("b")} FROM {RULES} GROUP BY split"""


@bind("exp_03_model_split_metrics", SPLIT_METRICS)
def split_metrics(t: Tables):
    return _round_errors(M.regression_metrics_wide(rules(t), "y", {"a": "a", "b": "b"}, by=["split"]))


@bind(
    "exp_04_select_then_test",
    f"""WITH m AS ({SPLIT_METRICS})
    SELECT * FROM m WHERE split = 'test' AND model = (SELECT model FROM m WHERE split = 'val'
    ORDER BY rmse, mae, r2 DESC LIMIT 1)""",
)
def select_then_test(t: Tables):
    table = M.regression_metrics_wide(rules(t), "y", {"a": "a", "b": "b"}, by=["split"])
    return _round_errors(E.select_then_test(table))


@bind(
    "exp_05_rank_techniques",
    f"""SELECT l_linestatus AS technique, round_even(sum(y * p) / sum(p)::DOUBLE * 1000, 0) / 1000 AS precision,
    round_even(sum(y * p) / sum(y)::DOUBLE * 1000, 0) / 1000 AS recall,
    round_even(2 * sum(y * p) / (sum(y) + sum(p))::DOUBLE * 1000, 0) / 1000 AS f1
    FROM (SELECT l_linestatus, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
      CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS p FROM lineitem)
    GROUP BY 1 ORDER BY f1 DESC, recall DESC, precision DESC, technique""",
)
def rank_techniques(t: Tables):
    y = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    p = F.when(F.col("l_quantity") > 25, 1).otherwise(0)
    rows = t.lineitem.select(F.col("l_linestatus").alias("technique"), y.alias("y"), p.alias("p"))
    table = M.classification_metrics(rows, "y", "p", by=["technique"])
    return E.rank_techniques(table).select("technique", "precision", "recall", "f1")
