"""Query results as CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(
    result: DataFrame, path: str, null_text: str = "", single_file: bool = False
) -> None:
    """Write in parallel by default; ``single_file`` is for a report known to be small."""
    if single_file:
        result = result.coalesce(1)
    (
        result.write.mode("overwrite").option("header", True)
        .option("nullValue", null_text).option("emptyValue", '""')
        .csv(path)
    )
