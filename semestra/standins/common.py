"""Helpers shared by the registered queries and their reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


def doubles(result: DataFrame) -> DataFrame:
    """Decimals as doubles and small integers as int, the types the SQL side produces."""
    casts = {T.DecimalType: "double", T.ShortType: "int"}
    return result.select(
        *[
            F.col(f"`{f.name}`").cast(casts[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in casts else F.col(f"`{f.name}`")
            for f in result.schema
        ]
    )


def sql_rounded(total: str, count: str, digits: int) -> str:
    """Exact mean of 4-decimal values given as integers, rounded half away from zero."""
    m = 10 ** (4 - digits)
    return (
        f"CAST(sign({total})*((2*abs({total})+{m}*{count})//(2*{m}*{count})) AS DOUBLE)"
        f"/{10 ** digits}.0"
    )


def sql_total(column: str) -> str:
    return f"sum(CAST({column}*10000 AS HUGEINT))"


def sql_mean(column: str, digits: int) -> str:
    return sql_rounded(sql_total(column), f"count({column})", digits)
