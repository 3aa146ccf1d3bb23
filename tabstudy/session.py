"""Session settings and the bounds on what may live on the driver."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Rows of derived state (statistics, quotas, vocabularies) that may be held on
# the driver. Anything that can exceed this is kept as a table.
SMALL_ROWS = 100_000


def build_session(app: str = "tabstudy", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a session whose executors are threads of the driver may do without that setting; it then uses a private folder.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tabstudy-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once, so later passes read instead of recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def hold_spread(df: DataFrame, few: int = 10_000) -> DataFrame:
    """Persist rows that will be read many times, on all cores.

    Rows from one small file sit in one partition; they are dealt out once so that every
    later pass runs in parallel. Data that already fills the cluster is not shuffled.
    """
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    cores = df.sparkSession.sparkContext.defaultParallelism
    used, n = (
        held.select(F.spark_partition_id().alias("p"))
        .groupBy("p")
        .count()
        .agg(F.count("p"), F.coalesce(F.sum("count"), F.lit(0)))
        .first()
    )
    if n < few or used >= cores:
        return held
    spread = held.repartition(cores).persist(StorageLevel.MEMORY_AND_DISK)
    spread.count()
    held.unpersist()
    return spread


def small_table(spark: SparkSession, rows: Sequence, schema: T.StructType | str) -> DataFrame:
    """Driver-held rows as a local relation.

    Handing the rows over as an Arrow table keeps their exact size known to the optimizer, so
    it is this side that gets broadcast in a join, and only while it is below the threshold.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    columns = [
        pa.array([r[i] for r in rows], type=field.type) for i, field in enumerate(to_arrow_schema(schema))
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, names=schema.names), schema)


def hold_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """Derived state, computed once.

    Up to ``limit`` rows it becomes a local relation, whose exact size lets Catalyst
    decide on a broadcast join by itself. Above that it is checkpointed and joins
    to it shuffle.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) <= limit:
        return small_table(df.sparkSession, rows, df.schema)
    return cut_lineage(df)


def collect_bounded(df: DataFrame, limit: int, what: str) -> list:
    """Collect rows whose number the caller's definition bounds; refuse otherwise."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{what}: more than {limit} rows")
    return rows
