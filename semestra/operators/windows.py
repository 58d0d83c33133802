"""Operators that look at neighbouring rows or at a row's place among all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from semestra.functions.numeric import half_up, percent_change
from semestra.operators.numbering import BELOW, NUMBER, PART, with_value_numbers
from semestra.reference_data import literal_frame


def moving_mean(
    rows: DataFrame, series: list[str], order: str, measure: str, length: int, digits: int, alias: str
) -> DataFrame:
    """Mean over the current and the preceding ``length - 1`` rows of a series.

    Rows count, not calendar periods. A series holds one row per period of the
    calendar, which bounds what one task has to order.
    """
    frame = Window.partitionBy(*series).orderBy(order).rowsBetween(1 - length, 0)
    value = F.col(measure)
    mean = F.sum(value).over(frame) / F.count(value).over(frame)
    return rows.withColumn(alias, half_up(mean, digits))


def change_from_previous(
    rows: DataFrame, series: list[str], order: str, measure: str, digits: int, alias: str
) -> DataFrame:
    """Percent change from the previous row of the series."""
    previous = F.lag(measure, 1).over(Window.partitionBy(*series).orderBy(order))
    change = percent_change(F.col(measure), previous)
    return rows.withColumn(alias, half_up(change, digits))


def _ranges_below(totals: list) -> tuple[list[tuple], int, int]:
    """For every range, what its numbers need to be numbers among all rows; and how many
    values and rows there are. A value that goes on from the range before is the same one."""
    out, rows, values, run, last = [], 0, 0, 0, None
    for t in sorted(totals, key=lambda t: t[PART]):
        joined = last is not None and t.least == last
        before = values - joined
        out.append((t[PART], rows, run if joined else rows, before))
        values = before + t.n_values
        if not (joined and t.n_values == 1):
            # Where the rows of the range's last value begin
            run = rows + t.last_below
        rows, last = rows + t.n_rows, t.greatest
    return out, values, rows


def global_rank(
    rows: DataFrame, measure: str, rank: str, percentile: str, digits: int = 2, buckets: int | None = None
) -> DataFrame:
    """Dense rank from the highest value and percent rank from the lowest.

    A window without partitions would sort everything in one task. Instead the rows are
    cut into ranges of the measure (``buckets`` of them, or as many as the session has
    shuffle partitions), each is numbered as a stream, and the totals of the ranges below
    are added. Rows move once. The result is exact wherever the ranges are cut.
    """
    spark = rows.sparkSession
    numbered = with_value_numbers(rows.filter(F.col(measure).isNotNull()), measure, buckets)
    # One row for each range
    totals = numbered.groupBy(PART).agg(
        F.count("*").alias("n_rows"), F.max(NUMBER).alias("n_values"), F.max(BELOW).alias("last_below"),
        F.min(measure).alias("least"), F.max(measure).alias("greatest"),
    ).collect()
    below, n_values, n_rows = _ranges_below(totals)
    offsets = literal_frame(spark, below, f"{PART} int, rows_below long, first_below long, values_below long")
    smaller = F.when(F.col(NUMBER) == 1, F.col("first_below")).otherwise(F.col("rows_below") + F.col(BELOW))
    share = F.lit(0) if n_rows < 2 else smaller.cast("decimal(20,0)") * 100 / F.lit(n_rows - 1).cast("decimal(20,0)")
    return numbered.join(offsets, PART).select(
        *[F.col(f"`{name}`") for name in rows.columns],
        (F.lit(n_values + 1) - F.col(NUMBER) - F.col("values_below")).cast("bigint").alias(rank),
        half_up(share.cast("decimal(38,18)"), digits).alias(percentile),
    )
