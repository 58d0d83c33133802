"""Blocks of consecutive keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def key_blocks(rows: DataFrame, order: Column) -> Column:
    """The number of a row's block, cut at approximate quantiles of an integer ``order``.

    Equal values are in one block and blocks rise with the order. As many blocks are made
    as the session has shuffle partitions; only their bounds come to the driver, and only
    the column itself is read for them.
    """
    blocks = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [n / blocks for n in range(1, blocks)]
    cuts = rows.agg(F.percentile_approx(order, shares, 20 * blocks)).first()[0]
    if not cuts:
        return F.lit(0)
    bounds = F.array(*map(F.lit, sorted(set(cuts))))
    return F.size(F.filter(bounds, lambda c: c <= order))
