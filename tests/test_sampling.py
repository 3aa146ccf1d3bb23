from __future__ import annotations

import math

import numpy as np
import pytest
from fares import ROWS, expanded
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabstudy.functions.columns import label_of
from tabstudy.operators import keyed as K, resample as R, split as S
from tabstudy.operators.neighbours import nearest_neighbours


@given(st.dictionaries(st.text(max_size=3), st.integers(1, 10_000), min_size=1, max_size=8), st.floats(0, 1))
@settings(max_examples=200, deadline=None)
def test_quotas_add_up_and_stay_near_proportion(sizes, share):
    take = int(sum(sizes.values()) * share)
    quotas = S.largest_remainder(sizes, take)
    assert sum(quotas.values()) == take
    for c, n in sizes.items():
        assert abs(quotas[c] - take * n / sum(sizes.values())) < 1
        assert 0 <= quotas[c] <= n


def test_tiny_remainders_by_name():
    assert S.largest_remainder({"a": 5, "b": 3, "c": 2}, 7) == {"a": 4, "b": 2, "c": 1}


@pytest.mark.parametrize("holdout,sizes", [((0.3, 0.5), [210107, 45023, 45023]), ((0.4, 0.5), [180091, 60031, 60031])])
def test_published_split_sizes(spark, holdout, sizes):
    df = spark.range(ROWS)
    counts = {r["split"]: r["count"] for r in S.assign_splits(df, ["id"], holdout).groupBy("split").count().collect()}
    assert [counts[n] for n in ("train", "val", "test")] == sizes


def test_published_stratified_and_resampled_sizes(spark):
    df = expanded(spark, "class").withColumn("label", label_of("class", "Business"))
    parts = S.assign_splits(df, ["id"], (0.2,), ("train", "val"), stratify="class")
    train = S.take_split(parts, "train").cache()
    assert K.class_sizes(train, "class") == {"Economy": 165333, "Business": 74789}
    assert R.random_oversample(train, "label", ["id"]).count() == 330666
    assert R.random_undersample(train, "label", ["id"]).count() == 149578
    assert R.weighted_bootstrap(train, "label", ["id"]).count() == 240122
    train.unpersist()


def test_split_does_not_depend_on_partitioning(spark):
    df = spark.range(3000).withColumn("g", F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id") % 3))
    seen = []
    for n in (1, 4, 200):
        rows = S.assign_splits(df.repartition(n), ["id"], stratify="g").select("id", "split").collect()
        seen.append(sorted(map(tuple, rows)))
    assert seen[0] == seen[1] == seen[2]
    assert len(seen[0]) == 3000


def test_thresholds_by_narrowing_equal_a_sort(spark):
    df = spark.range(20_000).withColumn("g", F.col("id") % 3 == 0).withColumn("h", K.hash_key(["id"], 1))
    hashes = {True: [], False: []}
    for r in df.collect():
        hashes[r["g"]].append(r["h"])
    ranks = {True: [1, 3000, 6666], False: [0, 10_000, 99_999]}
    cuts = K.rank_thresholds(df, "h", ranks, by="g", bracket_rows=60)
    for g, ks in ranks.items():
        for k, t in zip(ks, cuts[g]):
            assert sum(h < t for h in hashes[g]) == min(k, len(hashes[g]))


def test_repeated_key_is_refused_where_it_matters(spark):
    df = spark.range(100).select(F.lit(1).alias("k"))
    with pytest.raises(ValueError, match="do not identify"):
        S.assign_splits(df, ["k"])


def test_copies_become_a_key(spark):
    rows = [("a",)] * 250_001 + [("b",)] * 3 + [(None,)] * 2
    df = spark.createDataFrame(rows, "v string")
    keyed = K.number_copies(df)
    assert keyed.count() == len(rows) == keyed.distinct().count()
    assert keyed.where("v = 'a'").agg(F.min("copy_no"), F.max("copy_no")).first()[:] == (1, 250_001)
    sizes = S.assign_splits(keyed, ["v", "copy_no"]).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in sizes}["test"] == math.ceil(math.ceil(len(rows) * 0.3) / 2)


def test_dense_index_is_a_permutation(spark):
    df = spark.range(5000).withColumn("h", K.hash_key(["id"], 42)).withColumn("c", F.col("id") % 2)
    got = K.dense_index(df, "h", 5000).orderBy("h").select("idx").collect()
    assert [r[0] for r in got] == list(range(5000))
    per = K.dense_index(df, "h", 2500, by="c").groupBy("c").agg(F.min("idx"), F.max("idx"), F.count_distinct("idx"))
    assert {tuple(r) for r in per.collect()} == {(0, 0, 2499, 2500), (1, 0, 2499, 2500)}


@pytest.fixture(scope="module")
def imbalance(spark):
    return spark.createDataFrame([(i, int(i >= 7), [float(i), float(i * i % 5)]) for i in range(10)], "id int, y int, x array<double>")


def test_tiny_imbalance(imbalance):
    over = R.random_oversample(imbalance, "y", ["id"], copies="copy")
    assert over.count() == 14 and over.where("y = 1").count() == 7
    assert over.where("copy = 0").count() == 10
    assert over.select("id", "copy").distinct().count() == 14
    assert {r["id"] for r in over.where("copy > 0").collect()} <= {7, 8, 9}
    under = R.random_undersample(imbalance, "y", ["id"])
    assert under.count() == 6 and under.exceptAll(imbalance).count() == 0
    assert R.weighted_bootstrap(imbalance, "y", ["id"]).count() == 10
    assert R.keep_all(imbalance).count() == 10


def test_weights_are_the_numbers_of_copies(spark):
    rows = [(i, "abbccccc"[i % 8] if i % 11 else None) for i in range(400)]
    train = spark.createDataFrame(rows, "id int, y string").repartition(5)
    weighted = {r["id"]: r for r in R.resampling_weights(train, "y", ["id"]).collect()}
    assert len(weighted) == 400
    for name, f in (("oversample", R.random_oversample), ("undersample", R.random_undersample), ("bootstrap", R.weighted_bootstrap)):
        copies = {r["id"]: r["count"] for r in f(train, "y", ["id"]).groupBy("id").count().collect()}
        assert copies == {i: r[name] for i, r in weighted.items() if r[name]}
    for one in (train.where("y = 'a'"), train.where("y IS NULL")):
        got = R.resampling_weights(one, "y", ["id"], ["oversample", "undersample"]).collect()
        assert len(got) == one.count() and {r["oversample"] for r in got} == {1.0}
    with pytest.raises(ValueError):
        R.resampling_weights(train, "y", ["id"], ["smote"])


def test_smote_points_lie_between_neighbours(imbalance):
    out = R.smote(imbalance, "y", "id", "x", k=2)
    assert out.count() == 14 and out.where("synthetic").count() == 4
    few = imbalance.where("y = 1")
    points = R.synthetic_points(few, "id", "x", 3, 4, k=2).collect()
    x = {r["id"]: np.array(r["x"]) for r in few.collect()}
    assert len(points) == 4
    for p in points:
        a, b = x[p["base"]], x[p["neighbour"]]
        assert 0 <= p["gap"] < 1 and p["base"] != p["neighbour"]
        np.testing.assert_allclose(p["point"], a + p["gap"] * (b - a))
    with pytest.raises(ValueError):
        R.smote(imbalance, "y", "id", "x", k=3).count()


@pytest.mark.parametrize("dims,leaf,fan", [(2, 2048, 32), (3, 12, 3), (12, 60, 8)])
def test_neighbours_equal_brute_force_with_a_crowd_of_copies(spark, dims, leaf, fan):
    rng = np.random.default_rng(dims)
    x = rng.integers(0, 5, (400, dims)) / 2.0
    x[50:190] = x[3]
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(400)], "id bigint, x array<double>")
    near: dict = {}
    for r in nearest_neighbours(df, "id", "x", 5, leaf=leaf, fan=fan).collect():
        near.setdefault(r["id"], {})[r["rank"]] = (r["neighbour"], r["dist2"])
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    for i in range(400):
        order = [j for j in np.lexsort((np.arange(400), d[i])) if j != i][:5]
        assert [near[i][r][0] for r in range(1, 6)] == order
        np.testing.assert_allclose([near[i][r][1] for r in range(1, 6)], d[i][order])


def test_one_class_needs_no_resampling(spark):
    df = spark.createDataFrame([(i, 1) for i in range(5)], "id int, y int")
    for f in (R.random_oversample, R.random_undersample):
        assert f(df, "y", ["id"]).count() == 5
    assert R.weighted_bootstrap(df, "y", ["id"]).count() == 5


@pytest.mark.parametrize("stretch", [1, 3, 4096])
def test_totals_before(spark, stretch):
    from tabstudy.operators.keyed import totals_before

    rows = [(g, b, b + len(g)) for g in ("x", "yy") for b in (0, 1, 2, 5, 9, 40, 41)]
    frame = spark.createDataFrame(rows, "g string, b long, c long").repartition(3)
    got = {(r["g"], r["b"]): r["__before_c"] for r in totals_before(frame, "b", ["c"], ["g"], stretch).collect()}
    assert got == {(g, b): sum(c for h, k, c in rows if h == g and k < b) for g, b, _ in rows}


def test_dense_index_with_small_buckets(spark, monkeypatch):
    from tabstudy.operators import keyed

    monkeypatch.setattr(keyed, "PREFIX_ROWS", 2)
    frame = spark.range(500).withColumn("h", keyed.hash_key(["id"], 1)).withColumn("g", F.col("id") % 2)
    for by in (None, "g"):
        got = keyed.dense_index(frame, "h", 500, by=by).collect()
        for g in (0, 1) if by else (None,):
            part = sorted((r["h"], r["idx"]) for r in got if g is None or r["g"] == g)
            assert [i for _, i in part] == list(range(len(part)))


def plain_neighbours(x: np.ndarray, k: int) -> list[list[int]]:
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    return [np.argsort(row, kind="stable")[:k].tolist() for row in d]


def tree_neighbours(spark, x: np.ndarray, k: int, **tree) -> list[list[int]]:
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, x array<double>")
    got = [[-1] * k for _ in x]
    for r in nearest_neighbours(frame, "id", "x", k, **tree).collect():
        got[r["id"]][r["rank"] - 1] = r["neighbour"]
    return got


SHAPES = {
    "clusters": lambda rng: np.repeat(rng.normal(size=(30, 2)) * 100, 30, axis=0) + rng.normal(size=(900, 2)),
    "scales": lambda rng: (2.0 ** rng.uniform(0, 40, 700))[:, None] * np.eye(2)[rng.integers(0, 2, 700)],
    "equidistant": lambda rng: np.eye(220),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_pivot_tree_of_several_levels(spark, shape):
    x = SHAPES[shape](np.random.default_rng(4))
    assert tree_neighbours(spark, x, 4, leaf=25, fan=4) == plain_neighbours(x, 4)


def test_leaves_far_away_are_not_searched(spark):
    from pyspark.sql import functions as F

    from tabstudy.operators import neighbours

    x = SHAPES["clusters"](np.random.default_rng(4))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "rep long, x array<double>")
    frame = frame.withColumn("ids", F.array("rep"))
    placed, levels = neighbours._grow(frame, 5, 25, 4)
    assert len(levels) >= 3 and placed.count() == 900
    assert placed.groupBy("cell").count().agg(F.max("count")).first()[0] <= 25
    near = neighbours._search(placed, placed.select("cell", F.col("rep").alias("cand"), "ids", "x"), 5)
    balls = neighbours._balls(placed, near, levels, 5)
    assert balls.count() == placed.select("cell").distinct().count()
    sent = neighbours._sent(placed, balls, levels).count()
    assert 0 < sent < 900 * balls.count() / 5


@pytest.mark.parametrize("shape", [*SHAPES, "directions"])
def test_leaves_read_past_each_other(spark, monkeypatch, shape):
    """The same neighbours if no point is sent, with several packed leaves per task and several tasks per leaf."""
    from tabstudy.operators import neighbours

    monkeypatch.setattr(neighbours, "SENT", 0)
    monkeypatch.setattr(neighbours, "PASSING", 1 << 15)
    rng = np.random.default_rng(5)
    x = SHAPES[shape](rng) if shape in SHAPES else rng.normal(size=(300, 32))
    assert tree_neighbours(spark, x, 4, leaf=25, fan=4) == plain_neighbours(x, 4)


def test_points_sent_do_not_grow_with_the_leaves(spark, monkeypatch):
    """Random directions prune nothing: sending would make a copy of every point for every other leaf."""
    from tabstudy.operators import neighbours

    x = np.random.default_rng(6).normal(size=(800, 32))
    looked_at, search = [], neighbours._search

    def counted(queries, candidates, want):
        looked_at.append(candidates.count())
        return search(queries, candidates, want)

    monkeypatch.setattr(neighbours, "_search", counted)
    assert tree_neighbours(spark, x, 3, leaf=25, fan=8) == plain_neighbours(x, 3)
    assert sum(looked_at) <= (neighbours.SENT + 1) * len(x)


def test_distances_within_reach_are_not_missed():
    """Products lose all digits far from the origin; copies, infinite and undefined components are kept."""
    from tabstudy.operators import neighbours

    rng = np.random.default_rng(7)
    a, b = rng.normal(size=(40, 8)) + 1e8, rng.normal(size=(50, 8)) + 1e8
    b[:5] = a[:5]
    d = neighbours._distances(a, b)
    reach = np.sort(d, axis=1)[:, 3]
    who, where, dist2 = neighbours._within(a, b, reach)
    assert sorted(zip(who, where, dist2)) == [(i, j, d[i, j]) for i in range(40) for j in range(50) if d[i, j] <= reach[i]]
    b[7, 2], b[9, 3] = np.nan, np.inf
    who, where, _ = neighbours._within(a, b, np.full(40, np.inf))
    assert len(who) == 40 * 50


def test_small_state_is_the_same_held_either_way(spark):
    from tabstudy.session import hold_small

    frame = spark.range(20).selectExpr("id", "cast(id as string) AS s", "array(id) AS a")
    assert sorted(hold_small(frame, 100).collect()) == sorted(hold_small(frame, 3).collect())


def test_scratch_needs_a_shared_folder():
    from types import SimpleNamespace

    from tabstudy.session import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session)


def test_bars_are_ranked_over_many_ranges(spark):
    from tabstudy.operators.plotdata import frequency_bars

    rows = [(i % 700,) for i in range(3000)] + [(None,)] * 50 + [(7,)] * 400
    got = frequency_bars(spark.createDataFrame(rows, "v int").repartition(6), "v").collect()
    counts: dict = {}
    for (v,) in rows:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    order = sorted(counts, key=lambda v: (-counts[v], v))
    assert sorted(map(tuple, got)) == sorted((v, counts[v], i + 1) for i, v in enumerate(order))
    assert frequency_bars(spark.createDataFrame([], "v int"), "v").collect() == []
