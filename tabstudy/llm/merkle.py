"""Merkle manifest of a table: a tree of digests per group, a tree over the groups, a witness per row.

Rows of a group, in order, are dealt to aligned blocks of ``FANOUT ** BLOCK_LEVELS`` leaves. A task
appends the leaves of a block one by one: a leaf's partial witness is attached to the open subtree it
lies in, and every time a run of siblings is completed the witnesses below it grow by one level. The
roots of the blocks are the leaves of the next round, so a group of any size is appended in a few
rounds, and the roots of the groups are appended in the same way. A row's witness is the
one of its block continued by the one of the block's root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabstudy.session import scratch_path

FANOUT = 3
BLOCK_LEVELS = 6
DIGEST_CHARS = 64


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class WitnessedTree:
    """Append-only tree whose leaves' witnesses are kept up while it grows.

    ``siblings[i]`` and ``places[i]`` hold one entry per level already completed above leaf ``i``: the
    digests of the run's other nodes, and how many of them stand left and right.
    """

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.open: list[list[tuple[str, list[int]]]] = [[]]  # per level: completed nodes of the unfinished run
        self.siblings: list[list[str]] = []
        self.places: list[list[str]] = []

    def append(self, leaf: str) -> None:
        node, level = (leaf, [len(self.siblings)]), 0
        self.siblings.append([])
        self.places.append([])
        while True:
            self._hang(node, level)
            if len(self.open[level]) < self.fanout:
                return
            node, level = self._close(level), level + 1

    def _hang(self, node: tuple[str, list[int]], level: int) -> None:
        if level == len(self.open):
            self.open.append([])
        self.open[level].append(node)

    def _close(self, level: int) -> tuple[str, list[int]]:
        """Turn the run into its parent and extend every witness below it."""
        run, self.open[level] = self.open[level], []
        digests = [d for d, _ in run]
        below: list[int] = []
        for i, (_, leaves) in enumerate(run):
            others = "".join(digests[:i] + digests[i + 1 :])
            place = f"{i}{len(run) - 1 - i}"
            for leaf in leaves:
                self.siblings[leaf].append(others)
                self.places[leaf].append(place)
            below += leaves
        return digest("".join(digests)), below

    def finish(self, height: int | None = None) -> str:
        """Close the unfinished runs up to ``height`` levels, or until a single node remains; its digest."""
        level = 0
        while level != height:
            run = self.open[level]
            if height is None and len(run) == 1 and not any(self.open[level + 1 :]):
                break
            if run:
                self._hang(self._close(level), level + 1)
            level += 1
        return self.open[level][0][0]


def fold_witness(leaf: str, siblings: str, places: str) -> str:
    """The root that a leaf leads to: level by level it is hashed between its siblings."""
    at = 0
    for i in range(0, len(places), 2):
        middle = at + int(places[i]) * DIGEST_CHARS
        end = middle + int(places[i + 1]) * DIGEST_CHARS
        leaf = digest(siblings[at:middle] + leaf + siblings[middle:end])
        at = end
    return leaf


def folded(leaf: str, siblings: str, places: str) -> Column:
    """``fold_witness`` of three columns."""

    @F.arrow_udf("string")
    def fold(leaf: pa.Array, siblings: pa.Array, places: pa.Array) -> pa.Array:
        rows = zip(leaf.to_pylist(), siblings.to_pylist(), places.to_pylist(), strict=True)
        return pa.array([fold_witness(*row) for row in rows], pa.string())

    return fold(leaf, siblings, places)


def leaf_digest(*values: Column) -> Column:
    """sha256 over the values, each ``-`` if null, else its UTF-8 byte count, ``:`` and itself."""
    told = []
    for value in values:
        text = value.cast("string")
        told.append(F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text), F.lit(":"), text)))
    return F.sha2(F.concat(*told), 256)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with ``gid`` (ascends with ``grp``, null first), ``pos`` in the group and ``total`` of the group.

    Rows are sorted into ranges once; what is counted is one row per range and group, so a group may fill
    any number of ranges. A count of rows breaks full ties, so that repeated rows can be dealt to several ranges.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order, "tie")]
    ranges = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys)
    numbered = ranges.sortWithinPartitions(*keys).drop("tie").select(
        "*", F.monotonically_increasing_id().alias("seq"), F.spark_partition_id().alias("part")
    )
    held = _stored(numbered, "merkle-ranges")
    spans = held.groupBy("part", "grp").agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("grp")  # one row per range that the group reaches into
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("part").alias("s_part"),
        F.col("grp").alias("s_grp"),
        F.min("first").over(group).alias("gid"),
        F.sum("n").over(group).alias("total"),
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift"),
    )
    met = held.join(spans, (F.col("part") == F.col("s_part")) & F.col("grp").eqNullSafe(F.col("s_grp")))
    return met.withColumn("pos", F.col("seq") + F.col("shift")).drop("seq", "part", "s_part", "s_grp", "shift")


def _appended(nodes: DataFrame, levels: int) -> DataFrame:
    """One round: nodes (gid, pos, total, digest, …) with ``block``, ``siblings``, ``places`` up to the block's root.

    ``top`` is the root of the block in its first row and null in the others. Blocks are whole in one task,
    which holds one block at a time.
    """
    size = FANOUT**levels
    dealt = nodes.withColumn("block", F.expr(f"pos div {size}")).repartition("gid", "block")
    names = [*dealt.columns, "siblings", "places", "top"]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in dealt.schema])
    for name in names[-3:]:
        schema = schema.add(name, "string")
    kept = names[:-3]

    def append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def close() -> pa.RecordBatch:
            tree = WitnessedTree()
            for row in held:
                tree.append(row["digest"])
            top = tree.finish(None if held[0]["total"] <= size else levels)
            columns = {c: [row[c] for row in held] for c in kept}
            columns["siblings"] = ["".join(s) for s in tree.siblings]
            columns["places"] = ["".join(p) for p in tree.places]
            columns["top"] = [top] + [None] * (len(held) - 1)
            arrays = [pa.array(columns[c], types[c]) if c in types else pa.array(columns[c], pa.string()) for c in names]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        types: dict[str, pa.DataType] = {}
        for batch in batches:
            types = {f.name: f.type for f in batch.schema}
            for row in batch.to_pylist():
                if held and (row["gid"], row["block"]) != (held[0]["gid"], held[0]["block"]):
                    yield close()
                    held = []
                held.append(row)
        if held:
            yield close()

    return _stored(dealt.sortWithinPartitions("gid", "block", "pos").mapInArrow(append, schema), "merkle-blocks")


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Rounds until every group is a single node. Each has one row per block of the one before."""
    rounds = [_appended(nodes, levels)]
    while not rounds[-1].where(F.col("total") > FANOUT**levels).isEmpty():
        rounds.append(_appended(_tops(rounds[-1], levels), levels))
    return rounds


def _tops(done: DataFrame, levels: int) -> DataFrame:
    size = FANOUT**levels
    return done.where(F.col("top").isNotNull()).select(
        "gid",
        F.col("block").alias("pos"),
        F.expr(f"(total + {size - 1}) div {size}").alias("total"),
        F.col("top").alias("digest"),
    )


def _continued(rounds: list[DataFrame], above: DataFrame | None = None) -> DataFrame:
    """Witnesses of the first round's nodes up to their group's root, and on with those of ``above``.

    ``above`` has one row (gid, pos 0, siblings, places, subroot) per group. A block's root meets the rows of its block.
    """
    for done in reversed(rounds):
        if above is not None:
            longer = above.select(
                F.col("gid").alias("a_gid"),
                F.col("pos").alias("a_pos"),
                F.col("siblings").alias("a_siblings"),
                F.col("places").alias("a_places"),
                "subroot",
            )
            met = done.join(longer, (F.col("gid") == F.col("a_gid")) & (F.col("block") == F.col("a_pos")))
            done = met.withColumn("siblings", F.concat("siblings", "a_siblings")).withColumn(
                "places", F.concat("places", "a_places")
            ).drop("a_gid", "a_pos", "a_siblings", "a_places")
        else:
            done = done.withColumn("subroot", F.col("digest"))
        above = done
    return above


def build_manifest(
    documents: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    group: str = "source",
    order: str = "doc_id",
    carried: Mapping[str, Column] | None = None,
    block_levels: int = BLOCK_LEVELS,
) -> DataFrame:
    """Per row: ``order``, ``group``, ``carried`` columns, ``leaf``, ``subroot``, ``root``, ``siblings``, ``places``.

    ``leaf`` is the digest of ``columns``; ``subroot`` is its group's root and ``root`` that of the table.
    ``siblings`` joins the digests beside the path to the root, level by level and left to right; ``places``
    has two digits per level, the numbers of siblings on the left and on the right. ``fold_witness`` leads from
    a leaf to the root with them, so that a single row can be checked without the table.

    Leaves ascend by ``order`` and groups by their UTF-8 bytes, nulls first in both. Groups of any size are
    spread over blocks; the driver sees the table's root and nothing else. Only digests are shuffled.

    Defined cases: nulls are told apart from empty texts; rows that repeat ``order`` ascend by their leaves,
    equal rows are leaves of their own with one proof each; a group of one row has its leaf as subroot; an empty
    table gives an empty table; other columns play no part, whatever their names.
    """
    carried = dict(carried or {})
    leaves = documents.select(
        F.col(order).alias("ord"),
        F.col(group).cast("string").alias("grp"),
        leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
        *[c.alias(f"c_{name}") for name, c in carried.items()],
    )
    rounds = _rounds(_placed(_stored(leaves, "merkle-leaves"), ["ord", "digest"]), block_levels)
    subroots = _tops(rounds[-1], block_levels).select(F.lit("").alias("grp"), F.col("gid").alias("ord"), "digest")
    crown = _rounds(_placed(subroots, ["ord"]), block_levels)
    first = _tops(crown[-1], block_levels).first()
    root = first["digest"] if first else None
    over = _continued(crown).select(
        F.col("ord").alias("gid"), F.lit(0).cast("bigint").alias("pos"), "siblings", "places", F.col("digest").alias("subroot")
    )
    return _continued(rounds, over).select(
        F.col("ord").alias(order),
        F.col("grp").alias(group),
        *[F.col(f"c_{name}").alias(name) for name in carried],
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(root).cast("string").alias("root"),
        "siblings",
        "places",
    )
