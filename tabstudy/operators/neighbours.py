"""Exact k nearest neighbours within one set of vectors, by equi-joins on the cells of a pivot tree.

Copies of a vector are folded into one first, so a crowd of equal points costs one point. A cell with many points is cut
by a few of them, drawn as pivots, and its points go to the nearest one; the children are cut again until they are
small. All cells of a level are cut at once. Cells, pivots and what is known of them are tables; the driver
only learns whether a level had a cell to cut.

Points are first compared inside their leaf. That, or the points around the centres of the cells beside it, bounds how far the
neighbours of a leaf's points can be. Every leaf then goes down the tree as one ball, and by the triangle inequality leaves
out cells that lie beyond its reach; of the leaves it arrives at, the points within reach are sent to it. The bound never
drops a true neighbour, so the result is exact; it only decides how much is sent. Where it prunes little, as for
random directions in many dimensions, the work nears all pairs. Nothing is sent then: leaves are packed into one row each, and
the packed leaves are read past every leaf, which keeps its best so far. Disk then grows with the points, time with their pairs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tabstudy.operators.keyed import hash_key
from tabstudy.session import cut_lineage, hold_small

LEAF = 2048  # points of a cell that is not cut
FAN = 32  # pivots that cut a cell
LEVELS = 10  # a cell that is still large then is searched in pieces
QUERIES = 2048  # points that look for neighbours in one task
CANDIDATES = 4096  # points they look at
BALLS = 32  # leaves that points are sent to in one task
BLOCK = 4_000_000  # distances held at once
SENT = 16  # copies of a point that are sent on average at most; beyond, leaves are read past each other
PASSING = 64 << 20  # bytes of packed leaves that one task reads past its own
SLACK = 1e-9  # relative room for rounding in the bounds


def nearest_neighbours(
    df: DataFrame, key: str, features: str, k: int, leaf: int = LEAF, fan: int = FAN
) -> DataFrame:
    """(id, rank, neighbour, dist2): the ``k`` nearest other rows of every row.

    Squared Euclidean distance in double precision, equal distances by key, self excluded. Cells of more than
    ``leaf`` distinct vectors are cut by ``fan`` pivots; neither changes the result.
    """
    rows = df.select(F.col(key).alias("id"), F.col(features).cast("array<double>").alias("x"))
    folded, members = _fold_copies(rows, k + 1)
    near = _nearest_vectors(folded, k + 1, max(leaf, k + 1), fan)
    # ids behind the nearest vectors, best k + 1 of them per vector
    best = Window.partitionBy("rep").orderBy("dist2", "neighbour")
    lists = (
        near.select("rep", "dist2", F.explode("ids").alias("neighbour"))
        .withColumn("r", F.row_number().over(best))
        .where(F.col("r") <= k + 1)
    )
    per_rep = lists.groupBy("rep").agg(
        F.array_sort(F.collect_list(F.struct("r", "neighbour", "dist2"))).alias("near")  # k + 1 entries
    )
    others = F.slice(F.filter("near", lambda e: e["neighbour"] != F.col("id")), 1, k)
    return members.join(per_rep, "rep").select(
        "id", F.posexplode(others).alias("pos", "e")
    ).select("id", (F.col("pos") + 1).alias("rank"), F.col("e.neighbour").alias("neighbour"), F.col("e.dist2").alias("dist2"))


def _fold_copies(rows: DataFrame, keep: int) -> tuple[DataFrame, DataFrame]:
    """Distinct vectors (rep, x, ids) with the ``keep`` smallest ids, and (id, rep) of all rows."""
    first = Window.partitionBy("x").orderBy("id")
    ids = (
        rows.withColumn("r", F.row_number().over(first))
        .where(F.col("r") <= keep)  # limited per task before the shuffle
        .groupBy("x")
        .agg(F.array_sort(F.collect_list("id")).cast(T.ArrayType(rows.schema["id"].dataType)).alias("ids"))
    )
    folded = cut_lineage(ids.select(F.element_at("ids", 1).alias("rep"), "x", "ids"))
    members = rows.join(folded.select("x", "rep"), "x").select("id", "rep")
    return folded, members


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    n = len(column)
    return np.asarray(column.combine_chunks().flatten()).reshape(n, -1) if n else np.zeros((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all rows of ``b``, summed dimension by dimension."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        d = a[:, j, None] - b[None, :, j]
        out += d * d
    return out


def _blocks(n: int, across: int) -> range:
    """Starts of row slices with at most ``BLOCK`` distances each."""
    return range(0, n, _rows(across))


def _rows(across: int) -> int:
    return max(1, BLOCK // max(1, across))


def _meet(
    left: DataFrame,
    right: DataFrame,
    key: str,
    deal: tuple[str, str],
    pieces: tuple[int, int],
    work: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """``work`` on all rows of both sides that share ``key``, in tasks of about ``pieces`` rows of each side.

    Rows are dealt to pieces by a hash of their ``deal`` column, and every piece of one side meets every piece of the other.
    """
    sizes = [df.groupBy(key).agg(F.count(F.lit(1)).alias(n)) for df, n in ((left, "__ln"), (right, "__rn"))]
    counts = [F.ceil(F.col(n) / p).cast("int").alias(n) for n, p in zip(("__ln", "__rn"), pieces)]
    parts = hold_small(sizes[0].join(sizes[1], key).select(key, *counts))

    def dealt(df: DataFrame, column: str, own: str, other: str) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        mine = F.pmod(F.xxhash64(column), F.col(own)).cast("int")
        names = {"__ln": "__lp", "__rn": "__rp"}
        kept = [F.col(c).alias(c) for c in df.columns]  # columns of its own, as both sides may stem from one table
        return df.join(parts, key).select(*kept, mine.alias(names[own]), copies.alias(names[other]))

    groups = [key, "__lp", "__rp"]
    one, two = dealt(left, deal[0], "__ln", "__rn"), dealt(right, deal[1], "__rn", "__ln")
    return one.groupBy(*groups).cogroup(two.groupBy(*groups)).applyInArrow(work, schema)


def _nearest_vectors(points: DataFrame, want: int, leaf: int, fan: int) -> DataFrame:
    """(rep, cand, ids, dist2): the ``want`` nearest distinct vectors of each, itself included, with the ids behind them."""
    placed, levels = _grow(points, want, leaf, fan)
    near = _search(placed, placed.select("cell", F.col("rep").alias("cand"), "ids", "x"), want)
    if levels:
        near = cut_lineage(near)
        balls = _balls(placed, near, levels, want)
        sent = _sent(placed, balls, levels, SENT * placed.count())
        far = _passed(placed, near, balls, levels, want, leaf) if sent is None else _search(placed, sent, want)
        near = near.unionByName(far)
    best = Window.partitionBy("rep").orderBy("dist2", "cand")
    return near.withColumn("r", F.row_number().over(best)).where(F.col("r") <= want).drop("r")


def _search(queries: DataFrame, candidates: DataFrame, want: int) -> DataFrame:
    """(rep, cand, ids, dist2): per query the ``want`` nearest candidates of its cell, from every piece of them."""
    rep_type = queries.schema["rep"].dataType.simpleString()

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("cand")  # equal distances stay in this order
        a, b = _matrix(left["x"]), _matrix(right["x"])
        take = min(want, len(b))
        order, near = [], []
        for at in _blocks(len(a), len(b)):
            d = _distances(a[at : at + _rows(len(b))], b)
            best = np.argsort(d, axis=1, kind="stable")[:, :take]
            order.append(best.ravel())
            near.append(np.take_along_axis(d, best, axis=1).ravel())
        who = pa.array(np.repeat(np.arange(len(a)), take))
        found = right.select(["cand", "ids"]).take(pa.array(np.concatenate(order)))
        columns = [left["rep"].take(who), *found.columns, pa.array(np.concatenate(near))]
        return pa.table(columns, names=["rep", "cand", "ids", "dist2"])

    schema = f"rep {rep_type}, cand {rep_type}, ids array<{rep_type}>, dist2 double"
    return _meet(queries.select("cell", "rep", "x"), candidates, "cell", ("rep", "cand"), (QUERIES, CANDIDATES), nearest, schema)


def _grow(points: DataFrame, want: int, leaf: int, fan: int) -> tuple[DataFrame, list[DataFrame]]:
    """Points (rep, ids, x, cell) in their leaves, and per level its cells.

    A level's cells have (parent, cell, centre, n, radius, near): ``near`` are the ``want`` smallest distances to
    the centre, and cells are numbered so that a child's number tells its parent's.
    """
    rep_type = points.schema["rep"].dataType.simpleString()

    def nearest_pivot(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("child")
        x, pivots, child = _matrix(left["x"]), _matrix(right["centre"]), np.asarray(right["child"])
        turn = np.asarray(left["turn"])
        cell, own = np.empty(len(x), dtype=np.int64), np.empty(len(x))
        for at in _blocks(len(x), len(pivots)):
            d = _distances(x[at : at + _rows(len(pivots))], pivots)
            rows = np.arange(len(d))
            least = d == d.min(axis=1)[:, None]
            # pivots at the same distance share the points, so that equidistant points are cut, too
            pick = turn[at : at + len(d)] % least.sum(axis=1)
            which = (least.cumsum(axis=1) == pick[:, None] + 1).argmax(axis=1)
            cell[at : at + len(d)] = child[which]
            own[at : at + len(d)] = np.sqrt(d[rows, which])
        kept = left.select(["rep", "ids", "x"])
        return kept.append_column("cell", pa.array(cell)).append_column("d", pa.array(own))

    placed = points.select("rep", "ids", "x", F.lit(0).cast("bigint").alias("cell"))
    levels: list[DataFrame] = []
    for level in range(LEVELS):
        large = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > leaf)
        large = hold_small(large)
        if large.isEmpty():
            break
        open_points = placed.join(large, "cell")
        order = Window.partitionBy("cell").orderBy(hash_key(["rep"], f"pivot{level}"))  # limited before the shuffle
        pivots = cut_lineage(
            open_points.withColumn("r", F.row_number().over(order))
            .where(F.col("r") <= F.least(F.lit(fan), F.ceil(2 * F.col("n") / leaf)))  # no more than fill half a leaf
            .select("cell", (F.col("cell") * fan + F.col("r")).alias("child"), F.col("x").alias("centre"))
        )
        turn = F.pmod(F.xxhash64("rep", F.lit(level)), F.lit(1 << 20)).alias("turn")
        cut = _meet(
            open_points.select("cell", "rep", "ids", "x", turn),
            pivots,
            "cell",
            ("rep", "child"),
            (CANDIDATES, fan),
            nearest_pivot,
            f"rep {rep_type}, ids array<{rep_type}>, x array<double>, cell bigint, d double",
        )
        cut = cut_lineage(cut)
        levels.append(cut_lineage(_described(cut, pivots, want)))
        placed = cut_lineage(placed.join(large, "cell", "left_anti").unionByName(cut.drop("d")))
    return placed, levels


def _described(cut: DataFrame, pivots: DataFrame, want: int) -> DataFrame:
    order = Window.partitionBy("cell").orderBy("d")
    ranked = cut.select("cell", "d").withColumn("r", F.row_number().over(order)).where(F.col("r") <= want)
    near = ranked.groupBy("cell").agg(F.array_sort(F.collect_list("d")).alias("near"))
    totals = cut.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("radius"))
    centres = pivots.select(F.col("cell").alias("parent"), F.col("child").alias("cell"), "centre")
    return centres.join(totals, "cell").join(near, "cell")


def _balls(placed: DataFrame, near: DataFrame, levels: list[DataFrame], want: int) -> DataFrame:
    """(ball, centre, bound) per leaf: no neighbour of its points is further from the centre than ``bound``."""
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    parents = nodes.select(F.col("parent").alias("cell")).distinct()

    def beside(cells: pd.DataFrame) -> pd.DataFrame:
        """Points around the centres of a parent's cells, of which there are enough, bound the reach of each of them."""
        centres = np.stack(cells["centre"].to_numpy())
        between = np.sqrt(_distances(centres, centres))
        reach = []
        for row in between:
            known = np.sort(np.concatenate([d + np.asarray(n) for d, n in zip(row, cells["near"])]))
            reach.append(known[want - 1] if len(known) >= want else np.inf)
        return pd.DataFrame({"cell": cells["cell"], "around": reach})

    around = nodes.groupBy("parent").applyInPandas(beside, "cell bigint, around double")
    order = Window.partitionBy("rep").orderBy("dist2", "cand")
    last = near.withColumn("r", F.row_number().over(order)).where(F.col("r") == want)
    inside = (
        placed.join(last, "rep", "left")  # cells with too few points have none
        .groupBy("cell")
        .agg(F.max(F.coalesce(F.sqrt("dist2"), F.lit(float("inf")))).alias("inside"))
    )
    reach = F.least("inside", F.col("around") + F.col("radius"))
    return cut_lineage(
        nodes.join(parents, "cell", "left_anti")
        .join(around, "cell")
        .join(inside, "cell")
        .select(F.col("cell").alias("ball"), "centre", (reach + F.col("radius")).alias("bound"))
    )


def _sent(placed: DataFrame, balls: DataFrame, levels: list[DataFrame], most: float = float("inf")) -> DataFrame | None:
    """(cell, cand, ids, x): per leaf the points of other leaves within its bound.

    None if the leaves that the balls arrive at hold more than ``most`` points, counted once per ball.
    """
    rep_type = placed.schema["rep"].dataType.simpleString()

    def within(left: pa.Table, right: pa.Table) -> pa.Table:
        """Children that a ball's bound touches."""
        d = np.sqrt(_distances(_matrix(left["centre"]), _matrix(right["centre"])))
        room = np.asarray(left["bound"])[:, None] + np.asarray(right["radius"])[None, :]
        who, where = np.nonzero(d <= room * (1 + SLACK) + SLACK)
        found = left.select(["ball", "centre", "bound"]).take(pa.array(who))
        return found.append_column("cell", right["child"].take(pa.array(where)))

    def reached(left: pa.Table, right: pa.Table) -> pa.Table:
        d = np.sqrt(_distances(_matrix(left["x"]), _matrix(right["centre"])))
        near = d <= np.asarray(right["bound"])[None, :] * (1 + SLACK) + SLACK
        who, where = (pa.array(i) for i in np.nonzero(near & _other(left, right)))
        sent = left.select(["rep", "ids", "x"]).take(who).rename_columns(["cand", "ids", "x"])
        return sent.add_column(0, "cell", right["ball"].take(where))

    def _other(left: pa.Table, right: pa.Table) -> np.ndarray:
        return np.asarray(left["cell"])[:, None] != np.asarray(right["ball"])[None, :]

    at = balls.withColumn("cell", F.lit(0).cast("bigint"))
    arrived = None
    for level in levels:
        children = level.select(F.col("parent").alias("cell"), F.col("cell").alias("child"), "centre", "radius")
        step = _meet(
            at, children, "cell", ("ball", "child"), (LEAF, CANDIDATES), within,
            "ball bigint, centre array<double>, bound double, cell bigint",
        )
        stay = at.join(children.select("cell").distinct(), "cell", "left_anti")
        arrived = stay if arrived is None else arrived.unionByName(stay)
        at = cut_lineage(step)
    pairs = arrived.unionByName(at).where(F.col("ball") != F.col("cell"))
    if most < float("inf"):
        arrivals = pairs.groupBy("cell").agg(F.count(F.lit(1)).alias("times"))
        held = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        copies = arrivals.join(held, "cell").agg(F.sum(F.col("times") * F.col("n"))).first()[0]
        if (copies or 0) > most:
            return None
    return _meet(
        placed, pairs, "cell", ("rep", "ball"), (LEAF, BALLS), reached,
        f"cell bigint, cand {rep_type}, ids array<{rep_type}>, x array<double>",
    )


def _passed(placed: DataFrame, near: DataFrame, balls: DataFrame, levels: list[DataFrame], want: int, leaf: int) -> DataFrame:
    """(rep, cand, ids, dist2): per point the ``want`` nearest points of other leaves, of those no further than its own leaf's.

    Leaves are packed into a row each and meet all others in a nested loop, in which a task holds ``PASSING`` bytes of them.
    Points are shuffled once into their leaves; what a task returns is bounded by its own points, not by those that pass.
    """
    rep_type = placed.schema["rep"].dataType.simpleString()
    nodes = levels[0]
    for level in levels[1:]:
        nodes = nodes.unionByName(level)
    # a leaf is one piece, unless it could not be cut
    pieces = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / leaf).cast("int").alias("pieces"))
    marks = balls.withColumnRenamed("ball", "cell").join(nodes.select("cell", "radius"), "cell").join(pieces, "cell")
    marks = hold_small(marks)
    order = Window.partitionBy("rep").orderBy("dist2", "cand")
    last = near.withColumn("r", F.row_number().over(order)).where(F.col("r") == want).select("rep", "dist2")
    rows = placed.join(last, "rep", "left").join(marks.select("cell", "pieces"), "cell")
    piece = F.pmod(F.xxhash64("rep"), "pieces").cast("int").alias("piece")
    own = F.coalesce("dist2", F.lit(float("inf"))).alias("own")

    def packed(points: pa.Table) -> pa.Table:
        lists = [
            pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), points[name].combine_chunks())
            for name in ("rep", "ids")
        ]
        raw = [pa.array([m.tobytes()], pa.binary()) for m in (_matrix(points["x"]), np.asarray(points["own"]))]
        names = ["cell", "piece", "reps", "ids", "x", "own"]
        return pa.table([points["cell"].slice(0, 1), points["piece"].slice(0, 1), *lists, *raw], names=names)

    leaves = rows.select("cell", piece, "rep", "ids", "x", own).groupBy("cell", "piece").applyInArrow(
        packed, f"cell bigint, piece int, reps array<{rep_type}>, ids array<array<{rep_type}>>, x binary, own binary"
    )
    leaves = cut_lineage(leaves.join(marks.drop("pieces"), "cell"))
    n, held = leaves.agg(F.count("cell"), F.sum(F.length("x"))).first()
    cores = placed.sparkSession.sparkContext.defaultParallelism
    one = leaves.repartition(min(n, max(4 * cores, math.ceil(n / 4))))
    others = leaves.select(*(F.col(c).alias(f"other_{c}") for c in ("cell", "reps", "ids", "x", "centre", "radius")))
    others = others.repartition(math.ceil(held / PASSING))
    gap = F.zip_with("centre", "other_centre", lambda a, b: (a - b) * (a - b))
    apart = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, v: s + v))
    within = ~(apart > (F.col("bound") + F.col("other_radius")) * (1 + SLACK) + SLACK)
    met = one.join(others.hint("shuffle_replicate_nl"), (F.col("cell") != F.col("other_cell")) & within)

    def best(found: pa.Table) -> tuple[pa.Table, np.ndarray]:
        """The ``want`` first of every point, and where the last of them are."""
        found = found.sort_by([(c, "ascending") for c in ("point", "dist2", "cand")])
        point = np.asarray(found["point"])
        rank = np.arange(len(point)) - np.searchsorted(point, point)
        return found.filter(pa.array(rank < want)), np.flatnonzero(rank[rank < want] == want - 1)

    def pass_by(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leaf_at, found = None, None

        def out() -> list[pa.RecordBatch]:
            if found is None:
                return []
            columns = [reps.take(found["point"]), *(found[c] for c in ("cand", "ids", "dist2"))]
            return pa.table(columns, names=["rep", "cand", "ids", "dist2"]).combine_chunks().to_batches()

        for batch in batches:
            for i in range(batch.num_rows):
                cells = {name: batch.column(name)[i] for name in batch.schema.names}
                if leaf_at != (cells["cell"], cells["piece"]):
                    yield from out()
                    leaf_at, found, reps = (cells["cell"], cells["piece"]), None, cells["reps"].values
                    x = np.frombuffer(cells["x"].as_buffer()).reshape(len(reps), -1)
                    reach = np.frombuffer(cells["own"].as_buffer()).copy()
                    centre, bound = np.asarray(cells["centre"].values)[None, :], cells["bound"].as_py()
                b = np.frombuffer(cells["other_x"].as_buffer()).reshape(-1, x.shape[1])
                near_ball = np.flatnonzero(~(np.sqrt(_distances(b, centre)[:, 0]) > bound * (1 + SLACK) + SLACK))
                who, where, dist2 = _within(x, b[near_ball], reach)
                if len(who):
                    where = pa.array(near_ball[where])
                    columns = [pa.array(who), *(cells[c].values.take(where) for c in ("other_reps", "other_ids")), pa.array(dist2)]
                    new = pa.table(columns, names=["point", "cand", "ids", "dist2"])
                    found, ends = best(new if found is None else pa.concat_tables([found, new]))
                    point = np.asarray(found["point"])[ends]
                    reach[point] = np.fmin(reach[point], np.asarray(found["dist2"])[ends])
        yield from out()

    seen = met.select(
        "cell", "piece", "reps", "x", "own", "centre", "bound", "other_reps", "other_ids", "other_x"
    )
    return cut_lineage(seen.mapInArrow(pass_by, f"rep {rep_type}, cand {rep_type}, ids array<{rep_type}>, dist2 double"))


def _within(a: np.ndarray, b: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of ``a``, row of ``b``, squared distance) of pairs not further than the row's squared ``reach``.

    Scalar products, less what they may be off, leave most pairs out; the others get their distance as everywhere.
    """
    room = 8 * (a.shape[1] + 8) * np.finfo(float).eps
    with np.errstate(all="ignore"):
        most = reach - (1 - room) * (a * a).sum(axis=1) + np.finfo(float).tiny
        left, right = np.c_[a, np.ones(len(a))], np.c_[-2 * b, (1 - room) * (b * b).sum(axis=1)].T
        found = []
        for at in _blocks(len(a), len(b)):
            rows = slice(at, at + _rows(len(b)))
            who, where = np.nonzero(~(left[rows] @ right > most[rows, None]))  # also what is no number
            who += at
            dist2 = np.zeros(len(who))
            for j in range(a.shape[1]):
                d = a[who, j] - b[where, j]
                dist2 += d * d
            kept = ~(dist2 > reach[who])
            found.append((who[kept], where[kept], dist2[kept]))
    return tuple(np.concatenate(c) for c in zip(*found))
