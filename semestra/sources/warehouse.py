"""Warehouse tables as partitioned Parquet below one folder, written by Spark.

A full refresh overwrites a table, a slice refresh the partitions of some values. Both
happen only after a load has passed its gates, and in an order that keeps keys resolvable:
dimensions, which only gain members, come before the facts that refer to them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession, functions as F

from semestra.reference_data import literal_frame
from semestra.schemas import TABLES


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._staged: list[str] = []

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> DataFrame:
        """The current content under its declared schema; empty before the first load."""
        schema = TABLES[name].schema
        try:
            return self.spark.read.schema(schema).parquet(self.path(name))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return literal_frame(self.spark, [], schema)

    def write(self, name: str, rows: DataFrame) -> None:
        """Replace a whole table by rows that do not come from it."""
        self._writer(name, rows).mode("overwrite").option("partitionOverwriteMode", "static").parquet(self.path(name))

    def replace(self, tables: dict[str, DataFrame]) -> None:
        """Replace whole tables, in the given order, by rows that may come from them."""
        staged = {name: self.stage(name, declared(name, rows)) for name, rows in tables.items()}
        for name, rows in staged.items():
            self.write(name, rows)

    def replace_slice(self, name: str, rows: DataFrame, values: list) -> None:
        """Replace the partitions of the given values, and only these, by ``rows``.

        A value without rows ends up empty; rows of other values are refused.
        """
        [column] = TABLES[name].partition_by
        rows = self.stage(name, declared(name, rows))
        there = {row[0] for row in rows.select(column).distinct().limit(len(values) + 1).collect()}
        if not there <= set(values):
            raise ValueError(f"Rows beside the slice of {name}: {sorted(map(str, there - set(values)))}")
        self._writer(name, rows).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(self.path(name))
        for value in set(values) - there:
            rows.limit(0).drop(column).write.mode("overwrite").parquet(f"{self.path(name)}/{column}={value}")

    def _writer(self, name: str, rows: DataFrame) -> DataFrameWriter:
        """Rows of one partition come together, so that it gets few files; a rebalance lets
        AQE split a partition that holds too many over several tasks. In a file they are
        sorted by what is filtered on, so that row groups can be passed over."""
        table, rows = TABLES[name], declared(name, rows)
        if not table.partition_by:
            return rows.write
        rows = rows.hint("rebalance", *[F.col(c) for c in table.partition_by])
        return rows.sortWithinPartitions(*table.partition_by, *table.sort_by).write.partitionBy(*table.partition_by)

    # staging ----------------------------------------------------------------

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows written to a folder of this load alone, and read back."""
        path = f"{self.root}/_staging/{name}-{uuid.uuid4().hex}"
        self._staged.append(path)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def drop_staged(self) -> None:
        """Delete what was staged through this object."""
        for staged in self._staged:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(staged)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._staged = []


def declared(name: str, rows: DataFrame) -> DataFrame:
    """The declared columns of a table in their declared types."""
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in TABLES[name].schema])
