"""Reports on a loaded warehouse; every count but the row counts should be zero."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from semestra.operators import gates
from semestra.reference_data import literal_frame
from semestra.schemas import TABLES, Table

# Table -> subject the reports call it by
SUBJECTS = {
    "fact_gpr": "GPR",
    "fact_import_dependency": "Import dependency",
    "fact_energy_price": "Energy price",
    "fact_oil_stocks": "Oil stocks",
    "br_geo_eu_membership": "EU membership bridge",
}
# Table -> its period column
PERIODS = {
    "fact_gpr": "month_sk",
    "fact_import_dependency": "year_sk",
    "fact_energy_price": "semester_sk",
    "fact_oil_stocks": "month_sk",
    "br_geo_eu_membership": "year_sk",
}
# Micro-consumption bands where fixed credits can exceed the price
NEGATIVE_PRICE_BANDS = ("KWH_LT1000", "KWH1000-2499")


def verify_counts(wh) -> DataFrame:
    """Rows and first and last period per fact and bridge."""
    return gates.combine([
        wh.table(name).agg(
            F.count("*").alias("row_count"),
            F.min(period).cast("string").alias("first_period"),
            F.max(period).cast("string").alias("last_period"),
        ).select(F.lit(name.upper()).alias("table_name"), "row_count", "first_period", "last_period")
        for name, period in PERIODS.items()
    ])


def verify_duplicates(wh) -> DataFrame:
    return gates.combine([
        gates.duplicate_groups(f"{subject} duplicates", wh.table(name), list(TABLES[name].key))
        for name, subject in SUBJECTS.items()
    ])


def verify_orphans(wh) -> DataFrame:
    return gates.combine([
        gates.report(
            f"{subject} orphan dimensions",
            gates.orphans(wh.table(name), [(wh.table(parent), key) for key, parent in TABLES[name].references]),
        )
        for name, subject in SUBJECTS.items()
    ])


def verify_sanity(wh, exempt_bands: tuple[str, ...] = NEGATIVE_PRICE_BANDS) -> DataFrame:
    """Values that cannot be. The gas check has no exempt bands."""
    negative = F.col("price_val") < 0
    prices = wh.table("fact_energy_price").filter(negative).join(
        wh.table("dt_consumption_band").select("consumption_band_sk", "band_code", "commodity_type"),
        "consumption_band_sk",
    )
    index = wh.table("fact_gpr")
    any_negative = (F.col("gpr_val") < 0) | (F.col("gprt_val") < 0) | (F.col("gpra_val") < 0)
    return gates.combine([
        gates.count_violations(prices, {
            "Unexpected negative energy prices": ~F.col("band_code").isin(*exempt_bands),
            "Negative gas prices": F.col("commodity_type") == "GAS",
        }),
        gates.count_violations(
            wh.table("fact_oil_stocks"), {"Negative oil stock values": F.col("indicator_value") < 0}
        ),
        gates.count_violations(index, {"Negative GPR values": any_negative}),
    ])


def row_constraints(table: Table) -> dict[str, Column]:
    """Rules for single rows, by name; true where one is violated. References need the
    flags of ``with_parents``."""
    rules = {f"{table.name}.{column} is null": F.col(column).isNull() for column in table.required}
    for check, condition in table.checks.items():
        rules[f"{table.name} {check}"] = ~F.expr(condition)
    for key, parent in table.references:
        rules[f"{table.name}.{key} not in {parent}"] = F.col(key).isNotNull() & F.col(f"known_{key}").isNull()
    return rules


def key_constraints(table: Table) -> dict[str, list[str]]:
    """Keys that may occur once, by name."""
    return {f"{table.name} duplicate {', '.join(key)}": list(key) for key in (table.key, *table.unique)}


def with_parents(wh, table: Table) -> DataFrame:
    rows = wh.table(table.name)
    for key, parent in table.references:
        members = wh.table(parent).select(key).distinct().withColumn(f"known_{key}", F.lit(True))
        rows = rows.join(members, key, "left")
    return rows


def table_constraints(wh, table: Table) -> DataFrame:
    """``check_name, issue_count`` of all declared constraints of one table, from one pass.

    Every row gives an entry for each rule it violates, and one for each of its keys, told
    by a hash of 96 bits. All are counted by one grouping, which combines before it
    shuffles: violations of a rule come down to one row a task. A rule has as many issues
    as entries; a key as many as it has hashes that occur more than once. Keys with a null
    are not compared, as their columns are found by the rules.
    """
    rules, keys = row_constraints(table), key_constraints(table)
    entry = lambda name, high, low: F.struct(F.lit(name).alias("check_name"), high.alias("high"), low.alias("low"))
    entries = [F.when(rule, entry(name, F.lit(None).cast("long"), F.lit(None).cast("int"))) for name, rule in rules.items()]
    for name, key in keys.items():
        there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
        entries.append(F.when(there, entry(name, F.xxhash64(*key), F.hash(*key))))
    found = with_parents(wh, table).select(
        F.explode(F.filter(F.array(*entries), lambda e: e.isNotNull())).alias("entry")
    ).groupBy("entry.check_name", "entry.high", "entry.low").agg(F.count("*").alias("n"))
    issues = F.when(F.col("high").isNull(), F.col("n")).otherwise((F.col("n") > 1).cast("long"))
    counted = found.select("check_name", issues.alias("issue_count"))
    # Constraints without a finding are rows too
    spark = counted.sparkSession
    none = literal_frame(spark, [(name, 0) for name in [*rules, *keys]], "check_name string, issue_count long")
    return counted.unionByName(none).groupBy("check_name").agg(F.sum("issue_count").alias("issue_count"))


def constraint_report(wh, names: list[str] | None = None) -> DataFrame:
    return gates.combine([table_constraints(wh, TABLES[name]) for name in names or list(TABLES)])
