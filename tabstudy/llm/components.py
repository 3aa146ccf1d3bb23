"""Connected components of a table of links, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabstudy.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage is cut, and its size is known to the optimizer."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def relabelled(rows: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``column`` of ``rows`` replaced by its root where ``labels`` (node, root) has one."""
    new = labels.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return rows.join(new, F.col(column) == F.col("__n"), "left").select(
        *[F.coalesce("__r", c).alias(c) if c == column else F.col(c) for c in rows.columns]
    )


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.where(F.col("a") != F.col("b"))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )


def component_roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b) that is not its own root.

    Every round hooks each root below its smallest neighbour, follows the hooks to their ends, and
    rewrites the links between roots that remain. Roots are the smallest nodes of their component.
    The number of links falls by a factor per round; a node with very many links is combined
    map-side by the minimum and its joins are against unique keys.
    """
    left = written(_ordered(links), "links")
    roots = None
    while not left.isEmpty():
        hooks = written(left.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root")), "hooks")
        while True:
            above = hooks.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
            chained = hooks.join(above, F.col("root") == F.col("__n"))
            if chained.isEmpty():
                break
            hooks = written(relabelled(hooks, hooks, "root"), "hooks")
        roots = hooks if roots is None else written(relabelled(roots, hooks, "root").unionByName(hooks), "roots")
        left = written(_ordered(relabelled(relabelled(left, hooks, "a"), hooks, "b")), "links")
    if roots is None:
        roots = left.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots
