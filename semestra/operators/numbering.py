"""Places of rows in a global order, without a task that sees all of them.

Rows are cut into ranges and sorted within them, once, and written with the number of
their range and what is before them there. One row for each range tells the totals below
it; adding these makes places in a range places among all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from semestra.session import materialise

PART, PLACE = "__part", "__place"
NUMBER, BELOW = "__number", "__below"


def in_ranges(rows: DataFrame, order: list[Column], ranges: int | None = None) -> DataFrame:
    """Rows in as many ranges as the session has shuffle partitions, sorted in each, with
    the range's number. Small neighbouring ranges are put together at run time."""
    split = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    return split.sortWithinPartitions(*order).withColumn(PART, F.spark_partition_id())


def placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Rows in ranges with their place in the range, from 0; written to the shared folder."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return materialise(in_ranges(rows, order).withColumn(PLACE, place), "placed")


def _value_numbers(measure: str, schema: T.StructType):
    """The number of each row's value in its range, and the rows before that value."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = number = below = 0
        last = None
        for batch in batches:
            size = batch.num_rows
            if not size:
                continue
            column = batch.column(measure)
            new = np.ones(size, bool)
            new[1:] = pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            if pa.types.is_floating(column.type):
                empty = pc.is_nan(column).to_numpy(zero_copy_only=False)
                new[1:] &= ~(empty[1:] & empty[:-1])
            new[0] = last is None or not (column[0].equals(last) or (column[0].as_py() != column[0].as_py() and last.as_py() != last.as_py()))
            numbers = number + np.cumsum(new)
            starts = np.maximum.accumulate(np.where(new, place + np.arange(size), below))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int64()), pa.array(starts, pa.int64())],
                [*batch.schema.names, NUMBER, BELOW],
            )
            place, number, below, last = place + size, int(numbers[-1]), int(starts[-1]), column[-1]

    return run


def with_value_numbers(rows: DataFrame, measure: str, ranges: int | None = None) -> DataFrame:
    """Rows in ranges of ``measure`` with the number of their value in the range, from 1, and
    the rows of the range before that value; written to the shared folder.

    Rows of a frequent value spread over as many ranges as they need: a hash of the whole
    row comes second in the order.
    """
    names = [F.col(f"`{name}`") for name in rows.columns]
    ranged = in_ranges(rows, [F.col(f"`{measure}`"), F.xxhash64(*names)], ranges)
    schema = T.StructType([
        *ranged.schema.fields, T.StructField(NUMBER, T.LongType()), T.StructField(BELOW, T.LongType()),
    ])
    return materialise(ranged.mapInArrow(_value_numbers(measure, schema), schema), "numbered")
