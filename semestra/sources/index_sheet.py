"""The monthly risk-index sheet, exported as CSV or parquet."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from semestra.functions.text import month_key, parse_number
from semestra.reference_data import INDEX_SCOPE_START
from semestra.sources.wide_tsv import LayoutError

MEASURES = ["gpr", "gprt", "gpra"]
STORED = "decimal(10,4)"


def read_sheet(spark: SparkSession, path: str, file_format: str = "csv") -> DataFrame:
    """The exported sheet; ``header`` only matters to CSV."""
    return spark.read.format(file_format).option("header", True).load(path)


def date_column(columns: list[str]) -> str:
    """``month``, else ``date``, else the first column."""
    for name in ("month", "date"):
        if name in columns:
            return name
    return columns[0]


def normalise(sheet: DataFrame) -> DataFrame:
    """``month_sk`` and the three measures, whatever the header's case.

    A measure is there as a number, which tells whether the cell holds one, and as
    ``<measure>_val``, rounded once from the text to the stored digits.
    """
    sheet = sheet.toDF(*[name.strip().lower() for name in sheet.columns])
    missing = [name for name in MEASURES if name not in sheet.columns]
    if missing:
        raise LayoutError("Missing index columns: " + ", ".join(missing))
    return sheet.select(
        month_key(F.col(date_column(sheet.columns)).cast("string")).alias("month_sk"),
        *[parse_number(F.col(name).cast("string")).alias(name) for name in MEASURES],
        *[parse_number(F.col(name).cast("string"), STORED).alias(f"{name}_val") for name in MEASURES],
    )


def has_measure() -> Column:
    return F.coalesce(*MEASURES).isNotNull()


def invalid_date() -> Column:
    return F.col("month_sk").isNull()


def partly_populated() -> Column:
    return reduce(or_, [F.col(name).isNull() for name in MEASURES])


def usable_rows(rows: DataFrame, scope_start: str = INDEX_SCOPE_START) -> DataFrame:
    """Rows with a date and all measures, from the start of the scope on."""
    complete = rows.filter(has_measure()).filter(~invalid_date() & ~partly_populated())
    return complete.filter(F.col("month_sk") >= scope_start)
