"""Exact splits and resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabstudy.catalog.registry import Tables, bind
from tabstudy.functions.columns import label_of
from tabstudy.operators import profile as P, resample as R, split as S
from tabstudy.operators.keyed import number_copies
from tabstudy.operators.neighbours import nearest_neighbours


def plain_split_sql(rows: str, text: str, columns: str, holdout: tuple[str, str] = ("0.3", "0.5")) -> str:
    return f"""WITH s AS (SELECT count(*) AS n, CAST(ceil(count(*) * {holdout[0]}) AS BIGINT) AS rest FROM {rows}),
    z AS (SELECT n - rest AS a, n - CAST(ceil(rest * {holdout[1]}) AS BIGINT) AS b FROM s),
    r AS (SELECT *, row_number() OVER (ORDER BY md5({text})) AS rn FROM {rows})
    SELECT {columns}, CASE WHEN rn <= a THEN 'train' WHEN rn <= b THEN 'val' ELSE 'test' END AS split FROM r, z"""


def quota_sql(rows: str, cls: str, first: str, second: str) -> str:
    """CTEs giving per class the last rank of train (a) and of validation (b)."""
    return f"""s AS (SELECT {cls} AS cls, count(*) AS n FROM {rows} GROUP BY 1),
    t1 AS (SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n) - ceil(sum(n) * {first}) AS BIGINT) AS take FROM s),
    q1 AS (SELECT cls, n, (take * n) // total AS base, (take * n) % total AS rem, take FROM s, t1),
    k1 AS (SELECT cls, n, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, cls)
      <= take - sum(base) OVER () THEN 1 ELSE 0 END AS a FROM q1),
    t2 AS (SELECT CAST(sum(n - a) AS BIGINT) AS total, CAST(sum(n - a) - ceil(sum(n - a) * {second}) AS BIGINT) AS take
      FROM k1),
    q2 AS (SELECT cls, n, a, (take * (n - a)) // total AS base, (take * (n - a)) % total AS rem, take FROM k1, t2),
    k2 AS (SELECT cls, a, a + base + CASE WHEN row_number() OVER (ORDER BY rem DESC, cls)
      <= take - sum(base) OVER () THEN 1 ELSE 0 END AS b FROM q2)"""


def stratified_sql(first: str, second: str) -> str:
    return f"""WITH {quota_sql("orders", "o_orderpriority", first, second)},
    r AS (SELECT o_orderkey, o_orderpriority,
      row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('42|' || o_orderkey)) AS rn FROM orders)
    SELECT o_orderkey, CASE WHEN rn <= a THEN 'train' WHEN rn <= b THEN 'val' ELSE 'test' END AS split
    FROM r JOIN k2 ON cls = o_orderpriority"""


@bind("spl_01_random_split", plain_split_sql("orders", "'42|' || o_orderkey", "o_orderkey"))
def random_split(t: Tables):
    return S.assign_splits(t.orders.select("o_orderkey"), ["o_orderkey"])


@bind(
    "spl_01_split_without_key",
    plain_split_sql(
        """(SELECT l_orderkey, l_linenumber,
        row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS copy_no FROM lineitem)""",
        "'42|' || l_orderkey || '|' || l_linenumber || '|' || copy_no",
        "l_orderkey, l_linenumber, copy_no",
    ),
)
def split_without_key(t: Tables):
    rows = number_copies(t.lineitem.select("l_orderkey", "l_linenumber"))
    return S.assign_splits(rows, ["l_orderkey", "l_linenumber", "copy_no"])


@bind("spl_02_stratified_split", stratified_sql("0.3", "0.5"))
def stratified_split(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    return S.assign_splits(rows, ["o_orderkey"], stratify="o_orderpriority").drop("o_orderpriority")


@bind("spl_03_split_60_20_20", stratified_sql("0.4", "0.5"))
def split_60_20_20(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    out = S.assign_splits(rows, ["o_orderkey"], holdout=(0.4, 0.5), stratify="o_orderpriority")
    return out.drop("o_orderpriority")


@bind(
    "spl_03_split_80_20",
    """WITH r AS (SELECT event_id, row_number() OVER (ORDER BY md5('42|' || event_id)) AS rn,
      count(*) OVER () AS n FROM events)
    SELECT event_id, CASE WHEN rn <= n - ceil(n * 0.2) THEN 'train' ELSE 'val' END AS split FROM r""",
)
def split_80_20(t: Tables):
    return S.assign_splits(t.events.select("event_id"), ["event_id"], holdout=(0.2,), names=("train", "val"))


@bind(
    "spl_04_split_metadata",
    f"""WITH p AS ({plain_split_sql("orders", "'42|' || o_orderkey", "o_orderkey")})
    SELECT CAST(30 AS BIGINT) AS num_features, count(*) FILTER (WHERE split = 'train') AS train_samples,
    count(*) FILTER (WHERE split = 'val') AS val_samples, count(*) FILTER (WHERE split = 'test') AS test_samples FROM p""",
)
def split_metadata(t: Tables):
    return S.split_metadata(S.assign_splits(t.orders.select("o_orderkey"), ["o_orderkey"]), 30)


LABELLED = """(SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS label FROM orders)"""
DRAW = "CAST('0x' || substr(md5('{0}|42|' || i), 1, 15) AS BIGINT)"


def labelled(t: Tables):
    return t.orders.select("o_orderkey", label_of("o_orderpriority", "1-URGENT").alias("label"))


@bind(
    "smp_01_oversample",
    f"""WITH l AS (SELECT * FROM {LABELLED}),
    s AS (SELECT count(*) FILTER (WHERE label = 1) AS few, count(*) FILTER (WHERE label = 0) AS many FROM l),
    d AS (SELECT {DRAW.format("ros")} % few AS idx, count(*) AS c FROM s, range((SELECT many - few FROM s)) x(i) GROUP BY 1),
    m AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey)) - 1 AS idx FROM l WHERE label = 1)
    SELECT l.o_orderkey, l.label, 1 + coalesce(c, 0) AS copies
    FROM l LEFT JOIN m ON l.o_orderkey = m.o_orderkey LEFT JOIN d ON d.idx = m.idx""",
)
def oversample(t: Tables):
    out = R.random_oversample(labelled(t), "label", ["o_orderkey"])
    return out.groupBy("o_orderkey", "label").agg(F.count(F.lit(1)).alias("copies"))


@bind(
    "smp_02_undersample",
    f"""WITH r AS (SELECT o_orderkey, label, row_number() OVER (PARTITION BY label ORDER BY md5('42|' || o_orderkey)) AS rn
      FROM {LABELLED})
    SELECT o_orderkey, label FROM r WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM r GROUP BY label))""",
)
def undersample(t: Tables):
    return R.random_undersample(labelled(t), "label", ["o_orderkey"])


@bind(
    "smp_02_undersample_multiclass",
    """WITH r AS (SELECT p_partkey, p_type, row_number() OVER (PARTITION BY p_type ORDER BY md5('42|' || p_partkey)) AS rn
      FROM part)
    SELECT p_partkey, p_type FROM r WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM r GROUP BY p_type))""",
)
def undersample_multiclass(t: Tables):
    return R.random_undersample(t.part.select("p_partkey", "p_type"), "p_type", ["p_partkey"])


@bind(
    "smp_03_weighted_bootstrap",
    f"""WITH l AS (SELECT * FROM {LABELLED}),
    s AS (SELECT count(*) FILTER (WHERE label = 1) AS n1, count(*) FILTER (WHERE label = 0) AS n0 FROM l),
    d AS (SELECT label, {DRAW.format("wbs-row")} % CASE WHEN label = 0 THEN n0 ELSE n1 END AS idx, count(*) AS copies
      FROM (SELECT i, n0, n1, CASE WHEN {DRAW.format("wbs-class")} / power(16.0::DOUBLE, 15) < 0.5 THEN 0 ELSE 1 END AS label
        FROM s, range((SELECT n0 + n1 FROM s)) x(i)) GROUP BY 1, 2),
    m AS (SELECT o_orderkey, label,
      row_number() OVER (PARTITION BY label ORDER BY md5('42|' || o_orderkey)) - 1 AS idx FROM l)
    SELECT o_orderkey, label, copies FROM m JOIN d USING (label, idx)""",
)
def weighted_bootstrap(t: Tables):
    out = R.weighted_bootstrap(labelled(t), "label", ["o_orderkey"])
    return out.groupBy("o_orderkey", "label").agg(F.count(F.lit(1)).alias("copies"))


DISTANCE = """list_sum(list_transform(list_zip(a.embedding, b.embedding),
  lambda z: power(CAST(z[1] AS DOUBLE) - CAST(z[2] AS DOUBLE), 2)))"""


@bind(
    "smp_04_nearest_neighbours",
    f"""WITH p AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, {DISTANCE} AS d FROM embeddings a
      JOIN embeddings b ON a.vec_id <> b.vec_id),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS rank FROM p)
    SELECT id, CAST(rank AS INTEGER) AS rank, neighbour, round(d, 6) AS dist2 FROM r WHERE rank <= 5""",
)
def neighbours(t: Tables):
    near = nearest_neighbours(t.embeddings, "vec_id", "embedding", 5)
    return near.withColumn("dist2", F.round("dist2", 6))


SMOTE_SQL = f"""WITH few AS (SELECT * FROM embeddings WHERE label = 0),
  s AS (SELECT (SELECT count(*) FROM few) AS n, (SELECT count(*) FROM embeddings) AS total),
  m AS (SELECT vec_id, embedding, row_number() OVER (ORDER BY md5('42|' || vec_id)) - 1 AS idx FROM few),
  p AS (SELECT a.vec_id AS base, b.vec_id AS neighbour, {DISTANCE} AS d FROM few a JOIN few b ON a.vec_id <> b.vec_id),
  k AS (SELECT base, neighbour, row_number() OVER (PARTITION BY base ORDER BY d, neighbour) AS pick FROM p),
  w AS (SELECT i AS draw, {DRAW.format("smote-base")} % n AS idx, {DRAW.format("smote-pick")} % 5 + 1 AS pick,
    {DRAW.format("smote-gap")} / power(16.0::DOUBLE, 15) AS gap FROM s, range((SELECT total - 2 * n FROM s)) x(i)),
  j AS (SELECT draw, m.vec_id AS base, k.neighbour, gap, list_transform(list_zip(m.embedding, o.embedding),
    lambda z: CAST(z[1] AS DOUBLE) + gap * (CAST(z[2] AS DOUBLE) - CAST(z[1] AS DOUBLE))) AS point
    FROM w JOIN m USING (idx) JOIN k ON k.base = m.vec_id AND k.pick = w.pick JOIN few o ON o.vec_id = k.neighbour)"""


@bind(
    "smp_04_synthetic_points",
    SMOTE_SQL
    + """ SELECT draw, base, neighbour, round(gap, 9) AS gap, round(point[1], 6) AS first, round(point[64], 6) AS last,
    round(list_sum(point), 6) AS total FROM j""",
)
def synthetic_points(t: Tables):
    few = t.embeddings.where("label = 0").withColumn("x", F.col("embedding").cast("array<double>"))
    n, total = few.count(), t.embeddings.count()
    points = R.synthetic_points(few, "vec_id", "x", n, total - 2 * n)
    sums = F.aggregate("point", F.lit(0.0), lambda a, b: a + b)
    return points.select(
        "draw",
        "base",
        "neighbour",
        F.round("gap", 9).alias("gap"),
        F.round(F.get("point", F.lit(0)), 6).alias("first"),
        F.round(F.get("point", F.lit(63)), 6).alias("last"),
        F.round(sums, 6).alias("total"),
    )


@bind(
    "smp_04_smote",
    SMOTE_SQL
    + """ SELECT CASE WHEN label = 0 THEN 1 ELSE 0 END AS few, false AS synthetic, count(*) AS n,
    round(sum(CAST(embedding[1] AS DOUBLE)), 5) AS total FROM embeddings GROUP BY 1
    UNION ALL SELECT 1, true, count(*), round(sum(point[1]), 5) FROM j""",
)
def smote(t: Tables):
    x = F.col("embedding").cast("array<double>").alias("x")
    rows = t.embeddings.select("vec_id", x, label_of("label", 0).alias("few"))
    out = R.smote(rows, "few", "vec_id", "x")
    return out.groupBy("few", "synthetic").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.get("x", F.lit(0))), 5).alias("total")
    )


@bind("smp_05_no_resampling", f"SELECT o_orderkey, label FROM {LABELLED}")
def no_resampling(t: Tables):
    return R.keep_all(labelled(t))


@bind(
    "smp_06_train_only",
    f"""WITH p AS ({plain_split_sql(LABELLED, "'42|' || o_orderkey", "o_orderkey, label", ("0.2", "0.0"))})
    SELECT 'kept' AS part, count(*) FILTER (WHERE split <> 'train') AS rows, CAST(0 AS BIGINT) AS shared FROM p""",
)
def train_only(t: Tables):
    parts = S.assign_splits(labelled(t), ["o_orderkey"], holdout=(0.2,), names=("train", "val"))
    train, val = S.take_split(parts, "train"), S.take_split(parts, "val")
    resampled = R.random_oversample(train, "label", ["o_orderkey"])
    shared = resampled.join(val, "o_orderkey", "left_semi").count()
    return val.agg(F.lit("kept").alias("part"), F.count(F.lit(1)).alias("rows"), F.lit(shared).cast("bigint").alias("shared"))


@bind(
    "agg_15_balance_by_technique",
    f"""WITH s AS (SELECT count(*) FILTER (WHERE label = 1) AS n1, count(*) FILTER (WHERE label = 0) AS n0 FROM {LABELLED})
    SELECT 'none' AS technique, n0, n1 FROM s UNION ALL SELECT 'oversample', greatest(n0, n1), greatest(n0, n1) FROM s
    UNION ALL SELECT 'undersample', least(n0, n1), least(n0, n1) FROM s""",
)
def balance_by_technique(t: Tables):
    rows = labelled(t)
    samples = {
        "none": R.keep_all(rows),
        "oversample": R.random_oversample(rows, "label", ["o_orderkey"]),
        "undersample": R.random_undersample(rows, "label", ["o_orderkey"]),
    }
    return P.balance_counts(samples, "label")
