"""Row selections for reports. Ties at a cut are broken by a named column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def extremes(rows: DataFrame, by: str, tiebreak: str, highest: int, lowest: int) -> DataFrame:
    """The highest and the lowest rows, each row once. Both ends are found by
    per-task heaps, without a full sort."""
    present = rows.filter(F.col(by).isNotNull())
    top = present.orderBy(F.col(by).desc(), tiebreak).limit(highest)
    bottom = present.orderBy(F.col(by).asc(), tiebreak).limit(lowest)
    return top.unionByName(bottom).distinct()


def zeros_and_highest(rows: DataFrame, by: str, tiebreak: str, highest: int) -> DataFrame:
    """All rows at zero, plus the highest others."""
    zeros = rows.filter(F.col(by) == 0)
    others = rows.filter(F.col(by) != 0)
    return zeros.unionByName(others.orderBy(F.col(by).desc(), tiebreak).limit(highest)).distinct()


def sign_class(value: Column) -> Column:
    return F.when(value >= 0, "non_negative").when(value < 0, "negative")
