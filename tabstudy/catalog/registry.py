"""Collects the bound queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """``t.orders`` reads the table of that name below one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def bind(name: str, sql: str | None = None):
    def add(query: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is bound twice")
        QUERIES[name] = lambda spark, folder: query(Tables(spark, folder))
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add
