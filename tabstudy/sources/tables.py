"""Reading tables and writing results."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabstudy.functions.columns import round_half_even
from tabstudy.session import SMALL_ROWS, collect_bounded

# Semantic schema of the fares study table. A blank CSV header is called _c0.
FARES_SCHEMA = T.StructType(
    [
        T.StructField("_c0", T.IntegerType()),
        T.StructField("airline", T.StringType()),
        T.StructField("flight", T.StringType()),
        T.StructField("source_city", T.StringType()),
        T.StructField("departure_time", T.StringType()),
        T.StructField("stops", T.StringType()),
        T.StructField("arrival_time", T.StringType()),
        T.StructField("destination_city", T.StringType()),
        T.StructField("class", T.StringType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("days_left", T.IntegerType()),
        T.StructField("price", T.IntegerType()),
    ]
)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    sep: str = ",",
) -> DataFrame:
    """CSV with a header. Give ``schema`` at scale: inference costs one more pass.

    With a schema the header is checked against it by name and order, except that
    the unnamed row-number column may be written blank.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.option("enforceSchema", True).schema(schema).csv(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def preview(df: DataFrame, key: str | list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in an explicit order (a table has none of its own)."""
    keys = [key] if isinstance(key, str) else key
    return df.orderBy(*keys).limit(n)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def write_csv(df: DataFrame, path: str, decimals: int | None = None) -> None:
    """CSV with header and without a row index, floats rounded half to even."""
    out = df if decimals is None else round_floats(df, decimals)
    out.write.mode("overwrite").option("header", True).csv(path)


def write_json_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def round_floats(df: DataFrame, decimals: int) -> DataFrame:
    """Round every float column half to even; other columns unchanged."""
    floats = (T.DoubleType, T.FloatType)
    return df.select(
        *[
            round_half_even(f.name, decimals).alias(f.name) if isinstance(f.dataType, floats) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def json_document(records: DataFrame | dict | list, limit: int = SMALL_ROWS) -> str:
    """Indented UTF-8 JSON text of a report. Large tables go to ``write_json_lines``."""
    if isinstance(records, DataFrame):
        records = [r.asDict(recursive=True) for r in collect_bounded(records, limit, "JSON document")]
    return json.dumps(records, indent=2, ensure_ascii=False)


def write_json_document(records: DataFrame | dict | list, path: str) -> None:
    """Put one small report document on the driver's file system."""
    Path(path).write_text(json_document(records), encoding="utf-8")


def console_table(df: DataFrame, n: int = 100) -> None:
    df.show(n, truncate=False)
