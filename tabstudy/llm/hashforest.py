"""Approximate nearest neighbours by a forest of sorted hash strings.

Every vector has one long bit string per tree (signs of random projections, centred on a sample).
A tree is the sorted array of its strings. A query descends to the longest prefix it shares with the tree, then
ascends all trees together, one bit at a time, until the ranges that share a prefix of that length hold
enough candidates. Candidates are ranked by their exact distance.

Vectors are dealt into shards of bounded size; each shard is a forest of its own, searched
with blocks of queries, and the shards' best are merged. Equal vectors are folded first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabstudy.session import cut_lineage

TREES = 64
BITS = 24
SHARD_ROWS = 8192
BLOCK_ROWS = 4096
CANDIDATE_SHARE = 0.6  # the ascent stops when ranges hold this share of the shard, counted over all trees,
LEAST_CANDIDATES = 3000  # and at least so many vectors, so that small tables are searched more widely
FIT_ROWS = 4096
MOST_TASKS = 20_000
SEED = 11


def valid_vector(vector: Column) -> Column:
    """Neither null, empty nor zero, and every component finite."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(wide, lambda x: x != 0)


class Projections:
    """Random hyperplanes through the middle of a sample."""

    def __init__(self, middle: np.ndarray, trees: int = TREES, bits: int = BITS, seed: int = SEED):
        self.middle, self.trees, self.bits = middle, trees, bits
        self.planes = np.random.default_rng(seed).normal(size=(len(middle), trees * bits)).astype(np.float32)
        self.weights = (1 << np.arange(bits - 1, -1, -1)).astype(np.int64)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """One integer of ``bits`` bits per vector and tree; the first bit is the highest."""
        out = np.empty((len(vectors), self.trees), dtype=np.int64)
        for begin in range(0, len(vectors), 1024):
            part = (vectors[begin : begin + 1024] - self.middle).astype(np.float32) @ self.planes
            out[begin : begin + 1024] = (part > 0).reshape(len(part), self.trees, self.bits) @ self.weights
        return out


class Forest:
    """The sorted arrays of one shard."""

    def __init__(self, vectors: np.ndarray, projections: Projections):
        self.vectors, self.projections = vectors, projections
        strings = projections.strings(vectors)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=0)

    def ranges(self, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query and tree, the run of the sorted array that shares the first ``length`` bits."""
        shift = self.projections.bits - length
        low = (strings >> shift) << shift
        begin, end = np.empty_like(strings), np.empty_like(strings)
        for t in range(strings.shape[1]):
            begin[:, t] = np.searchsorted(self.sorted[:, t], low[:, t], "left")
            end[:, t] = np.searchsorted(self.sorted[:, t], low[:, t] + (1 << shift), "left")
        return begin, end

    def candidates(self, queries: np.ndarray, enough: int) -> Iterator[np.ndarray]:
        """Row numbers for each query, by synchronous ascent from the longest shared prefixes."""
        strings = self.projections.strings(queries)
        begin, end = np.zeros_like(strings), np.zeros_like(strings)
        waiting = np.arange(len(queries))
        for length in range(self.projections.bits, -1, -1):
            b, e = self.ranges(strings[waiting], length)
            begin[waiting], end[waiting] = b, e
            waiting = waiting[(e - b).sum(axis=1) < enough]
            if not len(waiting):
                break
        for i in range(len(queries)):
            taken = np.zeros(len(self.vectors), dtype=bool)
            for t in range(strings.shape[1]):
                taken[self.order[begin[i, t] : end[i, t], t]] = True
            yield np.flatnonzero(taken)


def nearest_of(forest: Forest, queries: np.ndarray, keep: int, enough: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per query the rows and distances of its ``keep`` nearest candidates, and all that tie with the last."""
    for query, rows in zip(queries, forest.candidates(queries, enough), strict=True):
        gaps = forest.vectors[rows] - query
        distances = np.sqrt(np.einsum("ij,ij->i", gaps, gaps))
        if len(rows) > keep:
            limit = np.partition(distances, keep - 1)[keep - 1]
            near = distances <= limit
            rows, distances = rows[near], distances[near]
        yield rows, distances


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def fit_projections(points: DataFrame, column: str, total: int, fit_rows: int = FIT_ROWS, **options) -> Projections:
    """Centre the hyperplanes on the mean of about ``fit_rows`` of ``total`` vectors.

    The sample is the points whose hash falls below a share of its range, so its size is binomial around ``fit_rows``, all points
    if there are no more; nothing is sorted.
    """
    share = F.pmod(F.xxhash64(column), F.lit(1 << 20)) < F.lit(-(-fit_rows * (1 << 20) // total))
    sample = points.where(share).select(column).toPandas()
    if sample.empty:
        sample = points.select(column).limit(1).toPandas()
    return Projections(_matrix(sample[column]).mean(axis=0), **options)


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    neighbours: int = 10,
    trees: int = TREES,
    bits: int = BITS,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    share: float = CANDIDATE_SHARE,
    least: int = LEAST_CANDIDATES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``neighbours`` nearest found for every row that ``is_query`` marks.

    ``score`` is the Euclidean distance in double precision; ties go to the smaller id. Every valid row
    is indexed; a query never finds itself. Vectors must share one length.

    Equal vectors become one point that keeps its ``neighbours + 1`` smallest ids, which are all that a result
    can show, so a vector that a third of all rows share is searched and found once. Points are dealt to shards by
    hash; a task holds one shard and one block of queries. Every (block, shard) pair is met once, as the queries are
    a stated set against all rows, and returns at most ``neighbours + 1`` points a query (more only where distances tie).

    Defined cases: null, empty, zero or non-finite vectors and rows without an id take no part; a query without
    other rows has no result; repeated ids with equal vectors are one row; an empty table gives an empty
    table; other columns are not read.
    """
    spark = vectors.sparkSession
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    rows = vectors.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.transform(F.col(vector_column), lambda x: x.cast("double") + F.lit(0.0)).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & valid_vector(F.col("vector")))
    rows = rows.distinct()
    by_vector = Window.partitionBy("point").orderBy("id")
    marked = cut_lineage(rows.withColumn("point", F.unhex(F.md5(F.to_json(F.col("vector"))))))
    members = (
        marked.withColumn("__k", F.row_number().over(by_vector))
        .where(F.col("__k") <= neighbours + 1)
        .select("point", F.col("id").alias("member"))
    )
    points = marked.groupBy("point").agg(F.first("vector").alias("vector"))
    asking = marked.where("asks").select("point", F.col("id").alias("query_id"))
    searched = asking.select("point").distinct().join(points, "point")

    n_points, n_queries = points.count(), searched.count()
    if not n_points or not n_queries:
        return spark.createDataFrame([], schema)
    shards = -(-n_points // shard_rows)
    blocks = -(-n_queries // block_rows)
    projections = spark.sparkContext.broadcast(fit_projections(points, "vector", n_points, trees=trees, bits=bits))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    dealt = lambda n: F.pmod(F.xxhash64("point"), F.lit(n))
    shard_side = points.select("point", "vector", dealt(shards).alias("shard"), every(blocks).alias("block"))
    query_side = searched.select(
        F.col("point").alias("asked"),
        F.col("vector").alias("asked_vector"),
        dealt(blocks).alias("asked_block"),
        every(shards).alias("asked_shard"),
    )

    def search(shard: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_point": [], "found_point": [], "score": []}
        if len(shard) and len(queries):
            forest = Forest(_matrix(shard["vector"]), projections.value)
            # one more than asked for, as the query's own point is found too and may have a single member
            found = nearest_of(forest, _matrix(queries["asked_vector"]), neighbours + 1, max(least, int(share * len(shard))))
            for asked, (near, distances) in zip(queries["asked"], found, strict=True):
                out["query_point"] += [asked] * len(near)
                out["found_point"] += list(shard["point"].to_numpy()[near])
                out["score"] += list(distances)
        return pd.DataFrame(out)

    # a pair of shard and block is work for a task of its own, however few bytes it holds
    tasks = min(shards * blocks, MOST_TASKS)
    found = (
        shard_side.repartition(tasks, "shard", "block")
        .groupBy("shard", "block")
        .cogroup(query_side.repartition(tasks, "asked_shard", "asked_block").groupBy("asked_shard", "asked_block"))
        .applyInPandas(search, "query_point binary, found_point binary, score double")
    )
    # a point may stand for several ids, but the nearest neighbours + 1 points always suffice
    best = found.withColumn("__k", F.rank().over(Window.partitionBy("query_point").orderBy("score"))).where(
        F.col("__k") <= neighbours + 1
    )
    listed = best.join(members, best["found_point"] == members["point"]).select("query_point", "score", "member")
    per_point = Window.partitionBy("query_point").orderBy("score", "member")
    listed = listed.withColumn("__k", F.row_number().over(per_point)).where(F.col("__k") <= neighbours + 1)
    answered = asking.join(listed, asking["point"] == listed["query_point"]).where(F.col("member") != F.col("query_id"))
    last = Window.partitionBy("query_id").orderBy("score", "member")
    return (
        answered.withColumn("rank", F.row_number().over(last))
        .where(F.col("rank") <= neighbours)
        .select("query_id", "rank", F.col("member").alias("vec_id"), "score")
    )
