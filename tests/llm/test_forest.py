"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tabstudy.llm import hashforest
from tabstudy.llm.queries import op6_forest, table


def exact(rows: dict[int, np.ndarray], query: int, n: int = 10) -> list[tuple[float, int]]:
    near = [(float(np.sqrt(((v - rows[query]) ** 2).sum())), i) for i, v in rows.items() if i != query]
    return sorted(near)[:n]


def lists(frame) -> dict[int, list[tuple[float, int]]]:
    out: dict[int, dict] = {}
    for r in frame.collect():
        out.setdefault(r["query_id"], {})[r["rank"]] = (r["score"], r["vec_id"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [v[k] for k in sorted(v)] for q, v in out.items()}


def test_recall_on_the_given_vectors(spark):
    for folder in ("/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        vectors = {r[0]: np.array(r[1], dtype=float) for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()}
        got = lists(op6_forest(spark, folder))
        asked = [i for i in vectors if i % 100 == 0]
        assert sorted(got) == sorted(asked)
        hits = 0
        for q in asked:
            want = exact(vectors, q)
            hits += len({i for _, i in want} & {i for _, i in got[q]})
            for score, i in got[q]:
                assert np.isclose(score, np.sqrt(((vectors[i] - vectors[q]) ** 2).sum()), rtol=1e-12)
            assert got[q] == sorted(got[q])
        assert hits / (10 * len(asked)) >= 0.9


def test_shards_and_blocks_cover_all_pairs(spark):
    """With every row a candidate, any cut into shards and blocks gives the exact answer."""
    draw = np.random.default_rng(6)
    rows = {i: draw.normal(size=5) for i in range(300)}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in rows.items()], "vec_id long, embedding array<double>")
    got = lists(
        hashforest.nearest_vectors(frame, F.col("vec_id") % 7 == 0, trees=8, shard_rows=40, block_rows=9, share=8.0)
    )
    for q, found in got.items():
        want = exact(rows, q)
        assert [i for _, i in found] == [i for _, i in want]
        assert np.allclose([s for s, _ in found], [s for s, _ in want], rtol=1e-12)


def test_ranges_are_prefix_matches():
    draw = np.random.default_rng(7)
    planes = hashforest.Projections(np.zeros(6), trees=3, bits=10)
    vectors, queries = draw.normal(size=(200, 6)), draw.normal(size=(9, 6))
    forest = hashforest.Forest(vectors, planes)
    stored, asked = planes.strings(vectors), planes.strings(queries)
    for length in (0, 3, 10):
        begin, end = forest.ranges(asked, length)
        for q in range(9):
            for t in range(3):
                same = np.flatnonzero(stored[:, t] >> (10 - length) == asked[q, t] >> (10 - length))
                assert sorted(forest.order[begin[q, t] : end[q, t], t]) == sorted(same)


def test_ties_and_copies(spark):
    """Vectors that very many rows share: the smallest ids win, the query is left out."""
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(i, [0.0, 1.0]) for i in range(100, 103)] + [(7, [1.0, 0.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lists(hashforest.nearest_vectors(frame, F.col("vec_id").isin(0, 5, 39, 101)))
    assert [i for _, i in got[0]] == list(range(1, 11))
    assert [i for _, i in got[5]] == [0, 1, 2, 3, 4, 6, 7, 8, 9, 10]
    assert [i for _, i in got[39]] == list(range(10))
    assert [i for _, i in got[101]] == [100, 102, 0, 1, 2, 3, 4, 5, 6, 7]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, None), (3, []), (4, [0.0, -0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0, 2.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS point", "3 AS rank")
    got = lists(hashforest.nearest_vectors(frame, F.lit(True)))
    assert got == {1: [(0.5, 8)], 8: [(0.5, 1)]}
    assert hashforest.nearest_vectors(frame.limit(0), F.lit(True)).collect() == []
    assert hashforest.nearest_vectors(frame, F.lit(None).cast("boolean")).collect() == []
    assert hashforest.nearest_vectors(frame.where("vec_id = 1"), F.lit(True)).collect() == []
