"""Exact averages, rounding and guarded statistics.

Averages are kept as decimal sum over count, so a result does not depend on how
rows were spread over partitions, and rounding is half away from zero.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Means entering a ratio are narrowed first: dividing two wide decimals would
# leave only six fractional digits in the quotient.
RATIO_OPERAND = "decimal(24,12)"


def exact_mean(value: Column) -> Column:
    """Mean of the non-null values of a decimal column, unrounded; NULL if there are none."""
    return F.sum(value) / F.count(value)


def half_up(value: Column, digits: int) -> Column:
    """Round a decimal half away from zero."""
    return F.round(value, digits)


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; NULL when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    x = F.when(both, x.cast("double"))
    y = F.when(both, y.cast("double"))
    varies = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when(varies, F.covar_pop(x, y) / F.sqrt(F.var_pop(x) * F.var_pop(y)))


def percent_change(current: Column, previous: Column) -> Column:
    """Relative change in percent, NULL without a previous value or from a zero base."""
    now, before = current.cast(RATIO_OPERAND), previous.cast(RATIO_OPERAND)
    return F.when(previous.isNotNull() & (previous != 0), (now - before) / before * 100)
