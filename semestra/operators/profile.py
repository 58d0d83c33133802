"""Source profiles, each taken in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from semestra.sources.wide_tsv import missing_marker


def profile_shape(wide: DataFrame) -> DataFrame:
    """Rows, columns, name of the composite column, largest number of key parts."""
    composite = wide.columns[0]
    return wide.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.max(F.size(F.split(F.col(f"`{composite}`"), ","))), F.lit(0)).alias("key_parts"),
    ).select(
        "n_rows",
        F.lit(len(wide.columns)).alias("n_columns"),
        F.lit(composite).alias("composite_column"),
        "key_parts",
    )


def profile_missing(wide: DataFrame) -> DataFrame:
    """Cells that are exactly the missing marker, over all columns."""
    return _sum_cells(wide, missing_marker).select(F.col("cells").alias("missing_cells"))


def profile_nulls(rows: DataFrame) -> DataFrame:
    """Empty cells and their share of all cells in percent."""
    width = len(rows.columns)
    cells = F.col("n_rows") * width
    return _sum_cells(rows, lambda cell: cell.isNull()).select(
        cells.alias("total_cells"),
        F.col("cells").alias("null_cells"),
        F.when(
            F.col("n_rows") > 0,
            F.round(F.col("cells").cast("decimal(20,0)") * 100 / cells.cast("decimal(20,0)"), 2),
        ).alias("null_pct"),
    )


def profile_coverage(rows: DataFrame, column: str) -> DataFrame:
    return rows.agg(
        F.min(column).alias("first_period"), F.max(column).alias("last_period")
    )


def present_columns(rows: DataFrame, wanted: list[str]) -> list[str]:
    """Which of the wanted columns the header has, in exactly this spelling."""
    return [name for name in wanted if name in rows.columns]


def _sum_cells(rows: DataFrame, test) -> DataFrame:
    per_column = rows.agg(
        F.count("*").alias("n_rows"),
        *[
            F.count(F.when(test(F.col(f"`{name}`")), F.lit(1))).alias(f"c{i}")
            for i, name in enumerate(rows.columns)
        ],
    )
    total = sum((F.col(f"c{i}") for i in range(len(rows.columns))), F.lit(0).cast("bigint"))
    return per_column.select("n_rows", total.alias("cells"))
