"""The factorisation machine: its identity, its gradient's effect, held-out accuracy."""

from __future__ import annotations

import numpy as np
from odd import no_documents, odd_documents
from pyspark.sql import functions as F

from tabstudy.llm import quality
from tabstudy.llm.queries import op9_quality, table


def test_pairwise_term_is_the_double_sum():
    draw = np.random.default_rng(1)
    model = quality.FactorisationMachine(0.3, draw.normal(size=50), draw.normal(size=(50, 4)))
    slot, value = draw.permutation(50)[:9], draw.normal(size=9)
    direct = model.bias + (model.linear[slot] * value).sum()
    for i in range(9):
        for j in range(i + 1, 9):
            direct += model.factors[slot[i]] @ model.factors[slot[j]] * value[i] * value[j]
    assert np.isclose(model.raw(slot, value, np.array([0, 9]))[0], direct)


def test_learns_an_interaction():
    """Neither feature alone tells the label, their product does."""
    draw = np.random.default_rng(2)
    a, b = draw.integers(0, 2, 800), draw.integers(0, 2, 800)
    slot = np.tile(np.array([0, 1]), 800)
    value = np.stack([a * 2.0 - 1, b * 2.0 - 1], 1).reshape(-1)
    model = quality.fit_machine(slot, value, np.arange(801) * 2, (a == b).astype(float), epochs=30)
    assert (((model.score(slot, value, np.arange(801) * 2)) > 0.5) == (a == b)).mean() > 0.98


def test_one_class_gives_its_share():
    slot, value = np.zeros(4, dtype=int), np.ones(4)
    model = quality.fit_machine(slot, value, np.arange(5), np.ones(4))
    assert model.score(slot, value, np.arange(5)).min() > 0.9


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = op9_quality(spark, folder)
    labels = table(spark, folder, "labels")
    held = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    assert len(held) > 500
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.98
    assert all(r["predicted"] == 1 for r in held if r["quality"] == 1)


def test_held_out_labels_teach_nothing(spark):
    """Labels that are held out may say anything."""
    folder = "/root/testdata/sf0.001"
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    turned = labels.withColumn(
        "quality", F.when(quality.learnable(), F.col("quality")).otherwise(1 - F.col("quality"))
    )
    a, b = quality.fit_quality(documents, labels), quality.fit_quality(documents, turned)
    assert a.bias == b.bias and np.array_equal(a.factors, b.factors)


def test_odd_documents(spark):
    folder = "/root/testdata/sf0.001"
    model = quality.fit_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    documents = odd_documents(spark)
    got = quality.score_quality(documents, model)
    assert got.columns == [*[c for c in documents.columns if c != "score"], "score"]
    rows = got.collect()
    assert len(rows) == documents.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if r["doc_id"] == 5}) == 1
    assert quality.score_quality(no_documents(spark), model).collect() == []


def test_no_labels(spark):
    documents = odd_documents(spark)
    labels = spark.createDataFrame([(None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit_quality(documents, labels)
    assert {round(r["score"], 6) for r in quality.score_quality(documents, model).collect()}
