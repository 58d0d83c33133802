"""Dimensional analytics for period-keyed statistics, written as Spark DataFrame plans."""
