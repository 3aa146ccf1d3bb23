"""Raking against a plain loop, and the draw against its probabilities."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import pytest
from odd import no_documents, odd_documents, odd_rows
from pyspark.sql import functions as F

import corpus_pipeline
from tabstudy.llm import mixing
from tabstudy.llm.queries import table


def fitted(cells: dict[tuple, float], targets: list[dict], sweeps: int) -> dict[tuple, float]:
    weight = dict(cells)
    for _ in range(sweeps):
        for axis, target in enumerate(targets):
            total = defaultdict(float)
            for cell, w in weight.items():
                total[cell[axis]] += w
            weight = {c: w * target[c[axis]] / total[c[axis]] if total[c[axis]] else w for c, w in weight.items()}
    return weight


CELLS = {("a", "x"): 10.0, ("a", "y"): 30.0, ("b", "x"): 5.0, ("b", "y"): 1.0, ("c", "y"): 7.0}
TARGETS = [{"a": 20.0, "b": 20.0, "c": 13.0}, {"x": 25.0, "y": 28.0}]


def test_rake_meets_both_margins(spark):
    cells = spark.createDataFrame([(*k, v) for k, v in CELLS.items()], "s string, t string, cell_tokens double")
    tables = {
        m: spark.createDataFrame(list(t.items()), "__value string, __target double")
        for m, t in zip("st", TARGETS, strict=True)
    }
    got = {(r["s"], r["t"]): r["weight"] for r in mixing.rake(cells, ["s", "t"], tables, sweeps=25).collect()}
    want = fitted(CELLS, TARGETS, 25)
    assert all(math.isclose(got[c], want[c], rel_tol=1e-9) for c in CELLS)
    for axis, target in enumerate(TARGETS):
        for value, wanted in target.items():
            assert sum(w for c, w in got.items() if c[axis] == value) == pytest.approx(wanted, rel=1e-3)


def test_given_targets_decide_the_sample(spark):
    rows = [(i, "w " * 10, "big" if i % 10 else "small", "en") for i in range(4000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    even = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "__value string, __target double")
    got = mixing.mix_sources(frame, {"source": F.col("source")}, targets={"source": even})
    kept = got.where("mix_kept").groupBy("source").agg(F.sum("mix_tokens").alias("n")).collect()
    tokens = {r["source"]: r["n"] for r in kept}
    assert tokens["small"] == 4000
    assert abs(tokens["big"] - 4000) < 5 * 10 * math.sqrt(3600 / 9)


def test_bounded_rake_meets_the_margins(spark):
    """The targets and the budget are met with a cell at its bound; scarce values are taken whole."""
    cells = spark.createDataFrame([(*k, v) for k, v in CELLS.items()], "s string, t string, cell_tokens double")
    for targets, want in (
        ([{"a": 20.0, "b": 5.0, "c": 5.0}, {"x": 13.0, "y": 17.0}], [{"a": 20.0, "b": 5.0, "c": 5.0}, {"x": 13.0, "y": 17.0}]),
        ([{"a": 10.0, "b": 10.0, "c": 10.0}, {"x": 1.0, "y": 1.0}], [{"a": 17.0, "b": 6.0, "c": 7.0}, {"x": 15.0, "y": 15.0}]),
    ):
        tables = {
            m: spark.createDataFrame(list(t.items()), "__value string, __target double")
            for m, t in zip("st", targets, strict=True)
        }
        got = {(r["s"], r["t"]): r["weight"] for r in mixing.rake_within(cells, ["s", "t"], tables, 30 / 53, sweeps=25).collect()}
        assert all(0 < got[c] <= CELLS[c] for c in CELLS)
        assert sum(got.values()) == pytest.approx(30.0)
        for axis, wanted in enumerate(want):
            for value, weight in wanted.items():
                assert sum(w for c, w in got.items() if c[axis] == value) == pytest.approx(weight, rel=1e-3)


def test_rare_source_leaves_the_kept_share(spark):
    """One short document of a source of its own does not change what the pipeline's stage keeps."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    odd = spark.createDataFrame([(-1, "three short words", "xx", "own", 17)], docs.schema)
    total = docs.count()
    share = [corpus_pipeline.mixing_stage(spark, d, "").count() / total for d in (docs, docs.unionByName(odd))]
    assert abs(share[0] - share[1]) < 0.02
    got = mixing.mix_sources(docs.unionByName(odd), budget=0.6)
    row = got.agg(F.sum(F.col("mix_tokens") * F.col("mix_probability")) / F.sum("mix_tokens"), F.max("mix_probability")).first()
    assert row[0] == pytest.approx(0.6) and row[1] == 1


def test_budget_takes_odd_documents(spark):
    got = mixing.mix_sources(odd_documents(spark), budget=0.5).collect()
    tokens = sum(r["mix_tokens"] for r in got)
    assert all(0 < r["mix_probability"] <= 1 for r in got)
    assert sum(r["mix_tokens"] * r["mix_probability"] for r in got) == pytest.approx(0.5 * tokens)
    assert mixing.mix_sources(no_documents(spark), budget=0.5).collect() == []


def test_draw_is_a_hash_of_the_key(spark):
    got = mixing.mix_sources(odd_documents(spark)).collect()
    for r in got:
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        draw = int(hashlib.md5(f"mix|{key}".encode()).hexdigest()[:13], 16) / 16**13
        assert r["mix_kept"] == (draw < r["mix_probability"])


def test_odd_documents(spark):
    frame = odd_documents(spark).withColumn("mix_topic", F.lit("old"))
    got = mixing.mix_sources(frame).collect()
    assert len(got) == len(odd_rows())
    assert all(0 < r["mix_probability"] <= 1 for r in got)
    assert max(r["mix_probability"] for r in got) == 1
    tokens = {r["doc_id"]: r["mix_tokens"] for r in got}
    assert tokens[2] == 0 and tokens[3] == 0 and tokens[6] == 80 and tokens[8] == 1
    assert {r["mix_topic"] for r in got if not r["text"]} == {"empty"}


def test_empty_table(spark):
    assert mixing.mix_sources(no_documents(spark)).collect() == []
