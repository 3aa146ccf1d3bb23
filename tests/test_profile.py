from __future__ import annotations

import json
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from fares import MARGINALS, ROWS, expanded
from pyspark.sql import functions as F

from tabstudy.functions import columns as C, text as X
from tabstudy.operators import order as O, plotdata as V, profile as P
from tabstudy.operators.quantiles import exact_quantiles
from tabstudy.sources import tables as S


@pytest.fixture(scope="module")
def tiny(spark):
    return spark.createDataFrame([("a",), ("a",), ("b",), ("b",), ("c",), (None,)], "v string")


def test_value_counts_drop_nulls_and_break_ties(tiny):
    assert [tuple(r) for r in P.value_counts(tiny, "v").collect()] == [("a", 2), ("b", 2), ("c", 1)]
    shares = {r["v"]: r["percentage"] for r in P.value_shares(tiny, "v").collect()}
    assert shares == {"a": 40.0, "b": 40.0, "c": 20.0}
    assert P.dominant_categories(tiny, ["v"]).first()["value"] == "a"
    assert P.distinct_counts(tiny, ["v"]).first()["cardinality"] == 3
    assert P.null_counts(tiny).first()["nulls"] == 1


@pytest.mark.parametrize("column", sorted(MARGINALS))
def test_published_shares(spark, column):
    """Counts and two-digit shares of the 300,153-row table."""
    profile = P.nested_profile(expanded(spark, column), [column])[column]
    assert profile["cardinality"] == len(MARGINALS[column])
    for value, count in MARGINALS[column].items():
        entry = profile["distribution"][value]
        assert entry == {"count": count, "percentage": float(np.round(count / ROWS * 100, 2))}


def test_profile_document_round_trip(tiny, tmp_path):
    path = tmp_path / "profile.json"
    S.write_json_document(P.nested_profile(tiny, ["v"]), str(path))
    text = path.read_text(encoding="utf-8")
    assert json.loads(text)["v"]["distribution"]["a"] == {"count": 2, "percentage": 40.0}
    assert "\n  " in text


def test_quantiles_and_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4, 100)], "x double")
    row = P.iqr_report(df, ["x"]).first()
    assert (row["q1"], row["q3"], row["outliers"], row["percent"]) == (2.0, 4.0, 1, 20.0)
    four = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 5)], "x double")
    assert exact_quantiles(four, ["x"], [0.5]).first()["value"] == 2.5


def test_narrowed_quantiles_equal_numpy_with_a_hot_value_and_groups(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=30_000)
    x[:10_000] = 0.25
    g = np.where(rng.random(30_000) < 0.6, "big", "small")
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": g})).repartition(5)
    probs = [0.0, 0.001, 0.25, 0.5, 0.75, 1.0]
    for r in exact_quantiles(df, ["x"], probs, bins=7).collect():
        assert r["value"] == pytest.approx(np.quantile(x, r["prob"]), abs=1e-12)
    found = exact_quantiles(df, ["x"], [0.1, 0.9], by=["g"], bins=2).collect()
    assert len(found) == 4
    for r in found:
        assert r["value"] == pytest.approx(np.quantile(x[g == r["g"]], r["prob"]), abs=1e-12)


@pytest.mark.parametrize("bins", [64, 4096])
def test_quantiles_do_not_depend_on_the_number_of_bins(spark, bins):
    """Values over hundreds of orders of magnitude, both signs, and the ends of the range of doubles."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.choice([-1, 1], 3000) * 10.0 ** rng.uniform(-300, 300, 3000), [1.7e308, -1.7e308, 0.0, 0.0, 5e-324]])
    df = spark.createDataFrame(pd.DataFrame({"x": x})).repartition(4)
    ranks = [0, 1, 700, 1502, 1503, 3004]
    for r in exact_quantiles(df, ["x"], [k / 3004 for k in ranks], bins=bins).collect():
        position = 3004 * r["prob"]
        low, high = np.sort(x)[[int(np.floor(position)), int(np.ceil(position))]]
        part = position - np.floor(position)
        assert r["value"] == pytest.approx((1 - part) * low + part * high, rel=1e-12)


@pytest.mark.parametrize("error", [0.0, 0.002])
def test_brackets_that_miss_the_rank_are_noticed(spark, error):
    """With no or too little room around the sketch's guess the counts still lead to the right value."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=60_000), np.full(4000, 0.5), rng.integers(0, 3, 4000)])
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": np.where(np.arange(len(x)) % 9, "a", None)})).repartition(6)
    probs = [0.5, 0.01, 0.011, 0.3, 0.69, 0.7, 0.999]
    for by in ((), ("g",)):
        found = exact_quantiles(df, ["x"], probs, by=by, bins=500, error=error).collect()
        assert len(found) == len(probs) * (2 if by else 1)
        for r in found:
            part = x if not by else x[(np.arange(len(x)) % 9 > 0) == (r["g"] == "a")]
            assert r["value"] == pytest.approx(np.quantile(part, r["prob"]), abs=1e-12)


def test_two_scans_do(spark, monkeypatch):
    from tabstudy.operators import quantiles

    scans = []
    narrower = quantiles._narrower
    monkeypatch.setattr(quantiles, "_narrower", lambda *a: scans.append(1) or narrower(*a))
    x = np.random.default_rng(5).integers(0, 10**6, 50_000) / 100
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    found = exact_quantiles(df, ["x"], [0.25, 0.5, 0.75]).collect()
    assert [r["value"] for r in found] == pytest.approx(np.quantile(x, [0.25, 0.5, 0.75]).tolist()) and len(scans) == 1


def test_bracket_of_a_gap_ends(spark):
    """The two ranks of a median may lie at the far ends of a range with nothing between."""
    df = spark.createDataFrame([(x,) for x in [0.0] * 50 + [1e9] * 50], "x double")
    assert exact_quantiles(df, ["x"], [0.5], bins=3).first()["value"] == 5e8


def test_describe_matches_pandas(spark):
    frame = pd.DataFrame({"a": [1.0, 2.0, 4.0, None, 9.5], "b": [3.0, 3.0, 3.0, 1.0, 2.0]})
    got = P.describe(spark.createDataFrame(frame.astype(object).where(frame.notna(), None), "a double, b double"), ["a", "b"])
    got = got.toPandas().set_index("statistic")
    want = frame.describe().round(2)
    for s in want.index:
        for c in want.columns:
            assert got.loc[s, c] == pytest.approx(want.loc[s, c], abs=1e-9)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "v string, x double")
    assert P.value_counts(empty, "v").count() == 0
    assert P.categorical_profile(empty, ["v"]).count() == 0
    assert P.iqr_report(empty, ["x"]).count() == 0
    assert P.duplicate_count(empty).first()[0] == 0
    assert V.histogram(empty, "x", 5).count() == 0
    assert V.density_curve(empty, "x").count() == 0


def test_duplicates_with_and_without_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c")], "k int, v string")
    assert P.duplicate_count(df).first()[0] == 0
    assert P.duplicate_count(df, ["v"]).first()[0] == 2


@pytest.mark.parametrize("decimals", [1, 12])
def test_density_matches_brute_force(spark, decimals):
    rng = np.random.default_rng(2)
    x = np.round(rng.gamma(2.0, 3.0, 4000), decimals)
    curve = V.density_curve(spark.createDataFrame(pd.DataFrame({"x": x})), "x", 200, bins=30).toPandas()
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min(), x.max(), 200)
    want = np.exp(-(((grid[:, None] - x) / h) ** 2) / 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    np.testing.assert_allclose(curve["density"], want, rtol=1e-9, atol=1e-15)
    np.testing.assert_allclose(curve["scaled"], want * len(x) * (x.max() - x.min()) / 30, rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("far", [0.5, 40.0, 1e6])
def test_density_is_near_the_sum_of_kernels(spark, far):
    """Below 1e-12 of the peak, whether the far value lies beside the others or a million units off, with nulls about."""
    x = np.append(np.random.default_rng(5).normal(size=700), [far, far])
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    got = V.density_curve(df, "x", 50).toPandas()["density"]
    h = x.std(ddof=1) * len(x) ** -0.2
    want = np.exp(-(((np.linspace(x.min(), x.max(), 50)[:, None] - x) / h) ** 2) / 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))
    assert np.abs(got - want).max() < 1e-12 * want.max()


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(3).normal(size=1000)
    got = V.histogram(spark.createDataFrame(pd.DataFrame({"x": x})), "x", 60).toPandas()
    counts, edges = np.histogram(x, bins=60)
    assert got["count"].sum() == 1000
    assert got["count"].tolist() == counts.tolist()
    np.testing.assert_allclose(got["left"], edges[:-1])


def test_box_stats(spark):
    df = spark.createDataFrame([("g", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    r = V.box_stats(df, "g", "v").first()
    assert (r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"], r["fliers"]) == (2, 3, 4, 1, 4, 1)
    assert [f["v"] for f in V.box_fliers(df, "g", "v").collect()] == [100.0]


def test_orders(spark):
    df = spark.createDataFrame([("b", 2), ("a", None), ("c", 2), ("d", 5)], "k string, v int")
    assert [r["k"] for r in O.sort_rows(df, ["v", "k"], [False, True]).collect()] == ["d", "b", "c", "a"]
    assert [r["k"] for r in O.sort_rows(df, ["v", "k"]).collect()] == ["b", "c", "d", "a"]
    assert O.best_row(df, ["v", "k"], [False, True]).first()["k"] == "d"
    assert [r["k"] for r in O.sort_by_category(df, "k", ["c", "a"], "k").collect()] == ["c", "a", "b", "d"]
    assert [tuple(r) for r in O.reindex(df, "k", ["d", "x"]).collect()] == [("d", 5), ("x", None)]
    with pytest.raises(KeyError):
        O.reindex(df, "k", ["d", "x"], missing="raise")


def test_text(spark):
    df = spark.createDataFrame([("10 / 5", " 1.234 ")], "a string, b string")
    parts = X.split_columns(df, "a", "/", ["l", "r", "none"])
    row = parts.select(
        C.to_int(X.strip("l")).alias("l"),
        C.to_int(X.strip("r")).alias("r"),
        "none",
        C.to_int(X.replace_literal(X.strip("b"), ".", "")).alias("b"),
        X.thousands(F.lit(1234567)).alias("t"),
        X.percent_text(F.lit(12.5)).alias("p"),
        X.count_pair(F.lit(None), F.lit(3)).alias("c"),
    ).first()
    assert tuple(row) == (10, 5, None, 1234, "1.234.567", "12,50 %", "0 / 3")


def test_rounding_is_half_even_like_numpy(spark):
    values = [0.125, 0.135, 2.5, 3.5, -0.5, 1.005, 0.575]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(C.round_half_even("v", 2)).collect()]
    assert got == np.round(values, 2).tolist()


def test_label_of_null_is_zero(spark):
    df = spark.createDataFrame([("x",), (None,), ("y",)], "v string")
    assert [r[0] for r in df.select(C.label_of("v", "x")).collect()] == [1, 0, 0]


def test_csv_with_blank_header(spark, tmp_path):
    (tmp_path / "f.csv").write_text(
        ",airline,flight,source_city,departure_time,stops,arrival_time,destination_city,class,duration,days_left,price\n"
        "0,Vistara,UK-1,Delhi,Morning,zero,Night,Mumbai,Economy,2.17,1,5953\n"
    )
    df = S.read_csv(spark, str(tmp_path / "f.csv"), S.FARES_SCHEMA)
    assert C.drop_if_present(df, "_c0", "Unnamed: 0").first()["price"] == 5953
    assert S.read_csv(spark, str(tmp_path / "f.csv")).columns[0] == "_c0"
    assert S.preview(df, "_c0", 3).count() == 1
    S.console_table(df)


def test_csv_rounds_floats(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.23456)], "k string, v double").coalesce(1)
    S.write_csv(df, str(tmp_path / "out"), decimals=2)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text.split() == ["k,v", "a,1.23"]


def test_profile_counts_agree_with_counter(small_fares):
    rows = small_fares.select("airline").toPandas()["airline"]
    got = {r["airline"]: r["count"] for r in P.value_counts(small_fares, "airline").collect()}
    assert got == dict(Counter(rows))
