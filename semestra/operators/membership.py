"""Membership histories as one row per member and year."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def expand_membership(
    history: DataFrame, years: DataFrame, geo: DataFrame, code: str = "eurostat_code"
) -> DataFrame:
    """``geo_sk, year_sk`` for every calendar year with entry <= year < exit.

    ``history`` holds ``code, entry_year, exit_year``; no exit means still a
    member. Codes absent from ``geo`` are skipped. Each interval is unfolded into
    its years and joined on equality, so no range join is needed.
    """
    span = years.agg(F.min("year_value").alias("first"), F.max("year_value").alias("last"))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    intervals = history.select(
        "code",
        F.greatest(F.col("entry_year"), first).alias("from_year"),
        F.least(F.col("exit_year") - 1, last).alias("to_year"),  # least() skips NULL
    ).filter(F.col("from_year") <= F.col("to_year"))
    return (
        intervals.join(geo.select(F.col(code).alias("code"), "geo_sk"), "code")
        .select("geo_sk", F.explode(F.sequence("from_year", "to_year")).alias("year_value"))
        .join(years, "year_value")
        .select("geo_sk", "year_sk")
        .distinct()
    )
