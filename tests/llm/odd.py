"""Documents that are hard to handle, and small helpers for the corpus tests."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame, SparkSession

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma".split()
SHARED = "this very line is found in more than five documents of the table"


def sentence(n: int, step: int = 1, start: int = 0) -> str:
    return " ".join(WORDS[(start + i * step + i // len(WORDS)) % len(WORDS)] + str(i % 7) for i in range(n))


def odd_rows() -> list[tuple]:
    rows = [
        (1, None, "en", "a", None),
        (2, "", "en", "a", 0),
        (3, "   \n\t\n", None, "a", 6),
        (4, "one", "en", None, 3),
        (5, sentence(80), "en", "a", None),
        (5, sentence(80), "en", "a", None),  # a row given twice
        (6, sentence(80), "de", "b", 1),
        (7, sentence(80).replace("iota", "IOTA"), "de", "b", 1),
        (None, sentence(60, 5), "en", "a", 9),
        (None, None, None, None, None),
        (8, "é𝄞" * 400, "fr", "c", 800),
        (9, "x" * 5000, "fr", "c", 5000),
        (10, sentence(30_000, 7), "en", "a", None),
        (2**40, "a" * 199, "en", "a", 199),
        (-3, "The the the\r\nTHE THE THE\x0b", "en", "a", 1),
    ]
    rows += [(100 + i, f"{SHARED.upper() if i % 2 else SHARED}\nown line {i}\n {SHARED} ", "en", "hot", 5) for i in range(7)]
    return rows


def odd_documents(spark: SparkSession, extra: bool = True) -> DataFrame:
    made = spark.createDataFrame(odd_rows(), SCHEMA).repartition(3)
    if extra:
        for name in ("id", "node", "hash", "n", "last", "root", "bucket", "label", "place", "score", "path", "n_lines"):
            made = made.selectExpr("*", f"'x' AS {name}")
    return made


def no_documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def duck_rows(sql: str, folder: str = FOLDER) -> list[tuple]:
    con = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con.execute(sql).fetchall()
