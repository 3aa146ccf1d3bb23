"""One-hot slots by a vocabulary table against a dictionary."""

from __future__ import annotations

import pytest

from tabstudy.operators.vocabulary import hot_slots, vocabulary

SCHEMA = "id long, z string, a string, column string"


@pytest.mark.parametrize("drop_first", [False, True])
def test_slots_follow_columns_then_values(spark, drop_first):
    """Nulls, a value of most rows, values that two columns share, and a column named like a helper."""
    rows = [(i, "hot" if i % 3 else f"z{i}", ["hot", None, "a"][i % 3], f"c{i % 2}") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    columns = ["z", "a", "column"]
    want = {}
    for i, c in enumerate(columns, 1):
        for value in sorted({r[i] for r in rows} - {None})[drop_first:]:
            want[c, value] = len(want)
    words = vocabulary(df, columns, drop_first)
    assert {(r["column"], r["value"]): r["slot"] for r in words.collect()} == want
    seen = df.where("id < 50").unionByName(spark.createDataFrame([(99, "unseen", None, None)], SCHEMA))
    got = {r["id"]: r["slots"] for r in hot_slots(seen, ["id"], columns, words).collect()}
    assert got == {
        r[0]: [want[k] for k in zip(columns, r[1:]) if k in want] for r in [*rows[:50], (99, "unseen", None, None)]
    }


def test_many_categories_and_none(spark):
    df = spark.range(300_000).selectExpr("id", "concat('v', id) AS v")
    words = vocabulary(df, ["v"])
    slots = hot_slots(df, ["id"], ["v"], words).selectExpr("slots[0] AS s")
    assert slots.selectExpr("count(DISTINCT s)", "min(s)", "max(s)").first() == (300_000, 0, 299_999)
    empty = df.limit(0)
    assert hot_slots(empty, ["id"], ["v"], vocabulary(empty, ["v"])).collect() == []
