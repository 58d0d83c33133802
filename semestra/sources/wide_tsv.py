"""Wide statistical extracts: one composite key column, then one column per period."""

from __future__ import annotations

from functools import reduce
from multiprocessing.pool import ThreadPool
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from semestra.functions.periods import period_columns
from semestra.functions.text import numeric_text, observation_flag, parse_number


class LayoutError(ValueError):
    """The header of a source does not have the expected layout."""


def file_headers(spark: SparkSession, path: str) -> dict[str, str]:
    """The first line of every file. Only the start of its first block is read."""
    files = [unquote(file) for file in spark.read.text(path).inputFiles()]
    if not files:
        return {}
    with ThreadPool(min(16, len(files))) as pool:
        firsts = pool.map(lambda file: spark.read.text(file).head(), files)
    return {file: first.value for file, first in zip(files, firsts) if first}


def _split_lines(spark: SparkSession, path: str) -> list[tuple[list[str], DataFrame]]:
    """Column names and ``value, cells`` of the lines, for every different header."""
    groups: dict[str, list[str]] = {}
    for file, header in sorted(file_headers(spark, path).items()):
        groups.setdefault(header, []).append(file)
    if not groups:
        raise LayoutError(f"No header found in {path}")
    parts = []
    for header, files in groups.items():
        # Without differing headers the folder is read as it is
        lines = spark.read.text(files if len(groups) > 1 else path)
        lines = lines.filter((F.col("value") != "") & (F.col("value") != header))
        parts.append((header.split("\t"), lines.withColumn("cells", F.split("value", "\t"))))
    return parts


def read_wide(spark: SparkSession, path: str, surplus: str | None = None) -> DataFrame:
    """Every cell as text, header and blanks untouched; empty cells are null.

    Files of a folder that order or choose their columns otherwise are aligned by name.
    ``surplus`` names a further column that is true for lines with more cells than their
    header, whose last cells have no column. The source is read once.
    """
    first: DataFrame | None = None
    named: dict[str, str] = {}
    for names, lines in _split_lines(spark, path):
        marked = [(F.size("cells") > len(names)).alias(surplus)] if surplus else []
        if first is not None:
            names = [named.get(name.strip(), name) for name in names]
        cells = [F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(names)]
        part = lines.select(*marked, *cells)
        if first is None:
            first, named = part, {name.strip(): name for name in names}
        else:
            first = first.unionByName(part, allowMissingColumns=True)
    return first.select(*[f"`{c}`" for c in first.columns if c != surplus], *([surplus] if surplus else []))


def surplus_cells(spark: SparkSession, path: str) -> DataFrame:
    """Lines with more cells than the header of their file."""
    parts = [lines.filter(F.size("cells") > len(names)).select("value") for names, lines in _split_lines(spark, path)]
    return reduce(DataFrame.unionByName, parts)


def key_names(composite_header: str) -> list[str]:
    """Dimension names written in the header of the composite column."""
    return [name.strip() for name in composite_header.split("\\")[0].split(",")]


def missing_keys(columns: list[str], required: set[str]) -> list[str]:
    """Required dimensions that the composite column, the first one, does not name."""
    return sorted(required - set(key_names(columns[0])))


def split_key(
    wide: DataFrame, required: set[str] = frozenset(), names: list[str] | None = None
) -> DataFrame:
    """Replace the composite column by one trimmed column per dimension.

    ``names`` overrides the names found in the header. ``key_parts`` keeps the
    number of parts each row really had, for the arity gate.
    """
    composite, *others = wide.columns
    missing = missing_keys(wide.columns, required)
    if missing:
        raise LayoutError("Missing key columns: " + ", ".join(missing))
    names = names or key_names(composite)
    wide = wide.toDF("series_key", *[name.strip() for name in others])
    parts = F.split("series_key", ",")
    return wide.select(
        *[F.trim(F.get(parts, F.lit(i))).alias(name) for i, name in enumerate(names)],
        F.size(parts).alias("key_parts"),
        *[F.col(f"`{name.strip()}`") for name in others],
    )


def unpivot_periods(wide: DataFrame, keys: list[str], granularity: str, period: str) -> DataFrame:
    """One row per series and period, with the cell text in ``raw_val``."""
    periods = period_columns(wide.columns, granularity)
    if not periods:
        raise LayoutError(f"No {granularity} column found")
    return wide.unpivot(
        [F.col(f"`{key}`") for key in keys],
        [F.col(f"`{name}`") for name in periods],
        period, "raw_val",
    )


def clean_observations(
    cells: DataFrame, value: str, value_type: str, keep: Column | None = None
) -> DataFrame:
    """Parse the cells, keep those holding a number, add the flag.

    A number too large for ``value_type`` is kept with a NULL value and marked in
    ``out_of_range``: losing it silently is for a gate to prevent. Rows meeting
    ``keep`` stay even without a number, so that a gate sees them in the same pass.
    """
    text = numeric_text(F.col("raw_val"))
    # No digit, no number: looking for one is far cheaper than a parse that fails.
    wanted = F.col("raw_val").rlike(r"\d") & parse_number(text).isNotNull()
    return (
        cells.filter(wanted if keep is None else wanted | keep)
        .select(
            "*",
            parse_number(text, value_type).alias(value),
            observation_flag(F.col("raw_val")).alias("eurostat_flag"),
        )
        # A projection of its own: the parse is then one step of generated code.
        .withColumn("out_of_range", F.col(value).isNull())
    )


def union_sources(parts: list[tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Concatenate frames after stamping each with its own constants."""
    stamped = [
        frame.withColumns({name: F.lit(value) for name, value in constants.items()})
        for frame, constants in parts
    ]
    return reduce(DataFrame.unionByName, stamped)


def missing_marker(cell: Column) -> Column:
    """True for the bare missing marker; a flagged marker is not bare."""
    return cell == ": "
