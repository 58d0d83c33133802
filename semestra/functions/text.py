"""Column expressions that turn published cell text into numbers, flags and period keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def numeric_text(cell: Column) -> Column:
    """The cell without anything but digits, dots and minus signs."""
    return F.regexp_replace(cell, r"[^\d.-]+", "")


def parse_number(text: Column, data_type: str = "double") -> Column:
    """Lenient parse: malformed or out-of-range text becomes NULL."""
    return text.try_cast(data_type)


def observation_flag(cell: Column) -> Column:
    """All letters of the cell joined together, NULL when there are none."""
    return F.when(cell.rlike("[A-Za-z]"), F.regexp_replace(cell, r"[^A-Za-z]+", ""))


def month_key(text: Column) -> Column:
    """``YYYY-MM`` of date text; NULL when it is not a date."""
    return F.substring(text.try_cast("date").cast("string"), 1, 7)


# Periods of date columns. Grouping on the number and spelling it out afterwards
# keeps strings out of the aggregation.


def month_number(date: Column) -> Column:
    return F.year(date) * 100 + F.month(date)


def month_text(number: Column) -> Column:
    """``YYYY-MM`` of a month number."""
    digits = number.cast("string")
    return F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2))


def semester_number(date: Column) -> Column:
    return F.year(date) * 10 + F.when(F.month(date) <= 6, 1).otherwise(2)


def semester_text(number: Column) -> Column:
    """``YYYY-S1`` or ``YYYY-S2`` of a semester number."""
    digits = number.cast("string")
    return F.concat(F.substring(digits, 1, 4), F.lit("-S"), F.substring(digits, 5, 1))


def period_year(period: Column) -> Column:
    """The year a period key starts with."""
    return F.substring(period.cast("string"), 1, 4).cast("int")
