"""Synthetic fares table for tests, derived from row numbers and md5 only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Row counts per value in the 300,153-row study table (fixed values).
MARGINALS = {
    "airline": {"Vistara": 127859, "Air_India": 80892, "Indigo": 43120, "GO_FIRST": 23173, "AirAsia": 16098, "SpiceJet": 9011},
    "source_city": {"Delhi": 61343, "Mumbai": 60896, "Bangalore": 52061, "Kolkata": 46347, "Hyderabad": 40806, "Chennai": 38700},
    "departure_time": {"Morning": 71146, "Early_Morning": 66790, "Evening": 65102, "Night": 48015, "Afternoon": 47794, "Late_Night": 1306},
    "stops": {"one": 250863, "zero": 36004, "two_or_more": 13286},
    "arrival_time": {"Night": 91538, "Evening": 78323, "Morning": 62735, "Afternoon": 38139, "Early_Morning": 15417, "Late_Night": 14001},
    "destination_city": {"Mumbai": 59097, "Delhi": 57360, "Bangalore": 51068, "Kolkata": 49534, "Hyderabad": 42726, "Chennai": 40368},
    "class": {"Economy": 206666, "Business": 93487},
}
ROWS = 300153


def unit(tag: str) -> Column:
    text = F.concat(F.lit(f"fares|{tag}|"), F.col("id").cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return number / F.lit(float(16**13))


def drawn(column: str) -> Column:
    """A value of ``column`` with its share in the study table."""
    u, reached, chain = unit(column), 0, None
    values = list(MARGINALS[column].items())
    for value, count in values[:-1]:
        reached += count
        test = u < reached / ROWS
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return chain.otherwise(values[-1][0])


def fares(spark: SparkSession, n: int) -> DataFrame:
    carriers = list(MARGINALS["airline"])
    rank = F.when(F.col("stops") == "zero", 0).when(F.col("stops") == "one", 1).otherwise(2)
    step = F.array_position(F.array(*[F.lit(c) for c in carriers]), F.col("airline"))
    base = F.when(F.col("class") == "Business", 57000 - 2000 * step).otherwise(7400 - 400 * step)
    noise = lambda tag: unit(tag) + unit(tag + "2") - 1
    return (
        spark.range(n)
        .select("id", *[drawn(c).alias(c) for c in MARGINALS])
        .withColumn("flight", F.concat(F.lit("F-"), (unit("flight") * 1561).cast("int").cast("string")))
        .withColumn("days_left", (unit("days") * 49).cast("int") + 1)
        .withColumn("duration", F.round(2 + 8 * rank + 2 * noise("duration"), 2))
        .withColumn(
            "price",
            (base * (1 + 1.2 * F.exp(-F.col("days_left") / 10)) + 60 * F.col("duration") + 400 * noise("price")).cast("int"),
        )
        .withColumnRenamed("id", "_c0")
    )


def expanded(spark: SparkSession, column: str) -> DataFrame:
    """(id, column) with exactly the study table's counts of that column."""
    reached, chain = 0, None
    values = list(MARGINALS[column].items())
    for value, count in values[:-1]:
        reached += count
        test = F.col("id") < reached
        chain = F.when(test, value) if chain is None else chain.when(test, value)
    return spark.range(ROWS).withColumn(column, chain.otherwise(values[-1][0]))
