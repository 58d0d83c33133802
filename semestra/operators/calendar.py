"""Calendar generators; every span includes both ends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def years(spark: SparkSession, first: int, last: int) -> DataFrame:
    year = F.col("id").cast("int")
    return spark.range(first, last + 1).select(year.alias("year_sk"), year.alias("year_value"))


def _parts_of_years(spark: SparkSession, first: int, last: int, per_year: int) -> DataFrame:
    # Counting periods and dividing yields years x periods without a product.
    return spark.range((last - first + 1) * per_year).select(
        (F.expr(f"id div {per_year}") + first).cast("int").alias("year_val"),
        (F.col("id") % per_year + 1).cast("int").alias("part"),
    )


def semesters(spark: SparkSession, first: int, last: int) -> DataFrame:
    return _parts_of_years(spark, first, last, 2).select(
        F.format_string("%d-S%d", "year_val", "part").alias("semester_sk"),
        "year_val",
        F.col("part").alias("semester_num"),
    )


def months(spark: SparkSession, first: int, last: int) -> DataFrame:
    return _parts_of_years(spark, first, last, 12).select(
        F.format_string("%d-%02d", "year_val", "part").alias("month_sk"),
        "year_val",
        F.col("part").alias("month_num"),
    )
