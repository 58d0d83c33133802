"""Loading the warehouse: stage, gate, then write.

Each fact load reads its source once, into a staging table; counters of the lines and of
the observations are taken on the way. The gates of the load are one report on that table
and on the few combinations of codes in it (``price_gates`` and its like), which anybody
may look at and which the load refuses to go on from. Only then are dimensions and fact
written.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce, wraps
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from semestra import reference_data as fixed
from semestra.functions.periods import period_columns
from semestra.functions.text import period_year
from semestra.operators import calendar, gates
from semestra.operators.dimensions import extract_members, insert_absent, resolve, upsert
from semestra.operators.membership import expand_membership
from semestra.sources import index_sheet
from semestra.sources.codelists import labels_of, read_codelists
from semestra.sources.warehouse import Warehouse, declared
from semestra.sources.wide_tsv import (
    clean_observations,
    missing_keys,
    read_wide,
    split_key,
    union_sources,
    unpivot_periods,
)

# Key columns and code lists each source must have
PRICE_KEYS = ["freq", "siec", "nrg_cons", "unit", "tax", "currency", "geo"]
PRICE_CODELISTS = ["SIEC", "NRG_CONS", "UNIT", "TAX", "CURRENCY"]
DEPENDENCY_KEYS = ["freq", "siec", "unit", "geo"]
DEPENDENCY_CODELISTS = ["SIEC", "UNIT"]
STOCK_KEYS = ["freq", "stk_flow", "unit", "geo"]

PRICE_GRAIN = [
    "semester_sk", "geo_code", "commodity_type", "consumer_type", "band_code",
    "tax_code", "energy_unit_code", "currency_code",
]
DEPENDENCY_GRAIN = ["year_sk", "geo_code", "siec_code"]
STOCK_GRAIN = ["month_sk", "geo_code", "indicator_code", "unit_code"]

# What a price series is made of besides its geography
PRICE_CODES = [
    "freq", "dataset", "commodity_type", "consumer_type", "expected_siec", "siec_code", "band_code",
    "tax_code", "energy_unit_code", "currency_code",
]
BAND_KEY = ["commodity_type", "consumer_type", "band_code"]
BAND_COLUMNS = [*BAND_KEY, "siec_code", "siec_label", "band_label", "band_order", "is_total_band"]
TAX_COLUMNS = ["tax_code", "tax_label", "tax_inclusion_order"]
UNIT_KEY = ["energy_unit_code", "currency_code"]
UNIT_COLUMNS = [*UNIT_KEY, "energy_unit_label", "currency_label", "price_basis"]
PRODUCT_COLUMNS = ["siec_code", "siec_label", "product_order", "is_total"]


@dataclass(frozen=True)
class PriceSource:
    """One price extract with the constants its file stands for."""

    dataset: str
    path: str
    codelists: str
    commodity: str
    consumer: str
    siec: str


@dataclass(frozen=True)
class Inputs:
    """Where the sources of a whole warehouse are."""

    prices: list[PriceSource]
    dependency: str
    dependency_codelists: str
    stocks: str
    index: str


def staged_load(load: Callable) -> Callable:
    """A load whose staging tables are deleted when it is done, written or refused."""
    @wraps(load)
    def run(wh: Warehouse, *args, **kwargs):
        try:
            return load(wh, *args, **kwargs)
        finally:
            wh.drop_staged()

    return run


# dimensions and calendars -----------------------------------------------------


@staged_load
def load_calendars(
    wh: Warehouse, years=fixed.YEAR_SPAN, semesters=fixed.SEMESTER_SPAN, months=fixed.MONTH_SPAN
) -> None:
    """Add the periods that are not there yet."""
    wanted = {
        "dt_year": (calendar.years(wh.spark, *years), ["year_sk"]),
        "dt_semester": (calendar.semesters(wh.spark, *semesters), ["semester_sk"]),
        "dt_month": (calendar.months(wh.spark, *months), ["month_sk"]),
    }
    wh.replace({n: insert_absent(wh.table(n), rows, key) for n, (rows, key) in wanted.items()})


@staged_load
def load_geography(wh: Warehouse, members: DataFrame | None = None) -> None:
    members = members if members is not None else fixed.geo_entities(wh.spark)
    wh.replace({"dim_geo_entity": upsert(wh.table("dim_geo_entity"), members, ["eurostat_code"], "geo_sk")})


@staged_load
def load_membership(wh: Warehouse, history: DataFrame | None = None) -> None:
    """Add memberships; rows already there stay, even if the history was corrected."""
    history = history if history is not None else fixed.eu_history(wh.spark)
    rows = expand_membership(history, wh.table("dt_year"), wh.table("dim_geo_entity"))
    name = "br_geo_eu_membership"
    wh.replace({name: insert_absent(wh.table(name), rows, ["geo_sk", "year_sk"])})


# shared steps -----------------------------------------------------------------


def add_labels(rows: DataFrame, codelists: DataFrame, lookups: dict[str, tuple[str, str]]) -> DataFrame:
    """Add a label column per lookup ``code list -> (code column, label column)``.

    Code lists that carry further columns, such as the dataset, match on those too.
    """
    for codelist, (code, label) in lookups.items():
        labels = labels_of(codelists, codelist, code, label)
        rows = rows.join(labels, [c for c in labels.columns if c != label], "left")
    return rows


def add_positions(rows: DataFrame, codelists: DataFrame, codelist: str, code: str, order: str, first: int) -> DataFrame:
    """Rank of a code in its list, counted from ``first``."""
    positions = codelists.filter(F.col("codelist") == codelist).drop("codelist", "label").select(
        *[c for c in codelists.columns if c not in ("codelist", "position", "code", "label")],
        F.col("code").alias(code),
        (F.col("position") + first).cast("smallint").alias(order),
    )
    return rows.join(positions, [c for c in positions.columns if c != order], "left")


def add_geo(rows: DataFrame, wh: Warehouse) -> DataFrame:
    members = wh.table("dim_geo_entity").withColumnRenamed("eurostat_code", "geo_code")
    return resolve(rows, members, ["geo_code"], "geo_sk")


def add_period(rows: DataFrame, members: DataFrame, period: str) -> DataFrame:
    """``known_period`` tells whether the calendar has the period."""
    known = members.select(period, F.lit(True).alias("known_period"))
    return rows.join(known, period, "left").withColumn(
        "known_period", F.coalesce("known_period", F.lit(False))
    )


def wrong_arity(parts: int) -> Column:
    """True where a key does not have the expected number of parts."""
    return F.col("key_parts") != parts


def line_rules(parts: int) -> dict[str, Column]:
    """Rules for the lines of an extract whose keys must have so many parts."""
    return {"key arity": wrong_arity(parts), "surplus cells": F.col("surplus_cells")}


def layout_issues(source: str, columns: list[str], required: list[str], granularity: str) -> list[tuple[str, int, str | None]]:
    """What the header of an extract lacks, as rows of a gate report."""
    missing = missing_keys(columns, set(required))
    no_period = not period_columns(columns, granularity)
    return [
        (f"missing key columns of {source}", len(missing), ", ".join(missing) or None),
        (f"missing {granularity} columns of {source}", int(no_period), None),
    ]


def empty_issue(name: str, counters: dict[str, int | str | None]) -> tuple[str, int, None]:
    """A row of a gate report: a source must have observations."""
    return name, int(not counters["observations"]), None


def codelist_offenders(codelists: DataFrame, required: list[str], source: str) -> DataFrame:
    """Code lists that a source has to bring, by name."""
    wanted = fixed.literal_frame(codelists.sparkSession, [(name,) for name in required], "codelist string")
    return gates.missing_codes(f"missing code lists of {source}", wanted, codelists, ["codelist"])


def counted_codes(staged: DataFrame, columns: list[str]) -> DataFrame:
    """The combinations of codes that occur, with the ``n`` observations of each."""
    return staged.groupBy(*columns).agg(F.count("*").alias("n"))


def conflicts(name: str, members: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """Members given under one key with different attributes, by name."""
    return gates.repeated_codes(f"conflicting members of {name}", extract_members(members, columns), key)


class Counters:
    """Counts that a frame gathers while it is written, instead of in a pass of their own."""

    def __init__(self, **counts: Column):
        self.observation, self.counts = Observation(), counts

    def on(self, rows: DataFrame) -> DataFrame:
        return rows.observe(self.observation, *[value.alias(name) for name, value in self.counts.items()])

    def get(self) -> dict[str, int | str | None]:
        return self.observation.get


def lines_counted(wide: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Counters]:
    """A split extract that counts its lines, and those at fault."""
    counters = Counters(source_rows=F.count("*"), **{name: F.count(F.when(rule, 1)) for name, rule in rules.items()})
    return counters.on(wide), counters


def period_counters(period: str, kept: Column, prefix: str = "") -> dict[str, Column]:
    """Counters of the observations kept, and of their first and last period."""
    value = F.when(kept, F.col(period).cast("string"))
    return {
        f"{prefix}observations": F.count(value), f"{prefix}first_period": F.min(value), f"{prefix}last_period": F.max(value),
    }


@dataclass
class Gated:
    """A staged source and what its gates say.

    ``report`` has ``check_name, issue_count, codes``; nothing may be at fault. ``named``
    has all codes at fault, with the ``n`` observations of each. ``counters``
    were taken when the source was staged: source_rows, observations, excluded,
    first_period and last_period, for each extract.
    """

    report: DataFrame
    counters: dict[str, dict[str, int | str | None]]
    rows: DataFrame | None = None
    members: DataFrame | None = None
    grain: list[str] = field(default_factory=list)
    scope: Column | None = None
    offenders: DataFrame | None = None
    named: DataFrame | None = None

    def in_scope(self) -> DataFrame:
        return self.rows.filter(self.scope) if self.scope is not None else self.rows

    def enforce(self) -> dict[str, int]:
        """Refuse what is at fault. Exact duplicates are looked for only where hashes of
        the grain collide."""
        counts = gates.enforce(self.report, self.offenders, informative=("duplicate grain",))
        if counts.get("duplicate grain"):
            exact = gates.duplicate_rows("duplicate grain", self.in_scope(), self.grain)
            counts |= gates.enforce(exact, gates.duplicates(self.in_scope(), self.grain))
        return counts


def gated(
    spark: SparkSession, literal: list[tuple[str, int, str | None]], counters: dict, staged: DataFrame | None = None,
    row_rules: dict[str, Column] | None = None, grain: list[str] = (), sampled: list[str] = (),
    members: DataFrame | None = None, code_rules: dict[str, tuple[str, Column]] | None = None,
    named: list[DataFrame] = (), names: list[str] = (), scope: Column | None = None, others: list[DataFrame] = (),
) -> Gated:
    """One report of all gates of a load.

    Row rules take one pass over ``staged``, code rules one over ``members``, the few
    combinations of codes that occur. ``literal`` are rows known from headers and counters,
    ``named`` further offenders by name, ``others`` further counts. ``scope`` narrows the
    grain check.
    """
    checks = [fixed.literal_frame(spark, literal, "check_name string, issue_count long, codes string"), *others]
    offenders = list(named)
    result = Gated(checks[0], counters, staged, members, list(grain), scope)
    if staged is not None:
        checks.append(gates.count_violations(staged, row_rules))
        checks.append(gates.suspected_duplicates("duplicate grain", result.in_scope(), result.grain))
        at_fault = reduce(or_, row_rules.values()) if row_rules else F.lit(False)
        result.offenders = gates.sample(staged.filter(at_fault), list(sampled))
    if members is not None:
        offenders.append(gates.offending_codes(members, code_rules))
    result.report = gates.gate_report(spark, checks, offenders, [*(code_rules or ()), *names])
    if offenders:
        result.named = reduce(DataFrame.unionByName, offenders)
    return result


# energy prices ----------------------------------------------------------------


def price_cells(spark: SparkSession, source: PriceSource) -> tuple[DataFrame, int]:
    """The split extract and the number of parts its keys must have."""
    raw = read_wide(spark, source.path)
    wide = split_key(raw, set(PRICE_KEYS))
    return wide, wide.columns.index("key_parts")


def price_observations(wide: DataFrame, parts: int | None = None) -> DataFrame:
    """Long observations. Given the expected key parts, series with another number of
    parts are kept and marked for the gates, whether observed or not."""
    cells = unpivot_periods(wide, [*PRICE_KEYS, "key_parts"], "semester", "semester_sk")
    malformed = wrong_arity(parts) if parts else F.lit(False)
    rows = clean_observations(cells, "price_val", "decimal(10,4)", keep=malformed)
    return rows.withColumn("malformed_key", malformed).drop("key_parts", "raw_val").withColumnsRenamed({
        "geo": "geo_code", "siec": "siec_code", "nrg_cons": "band_code", "tax": "tax_code",
        "unit": "energy_unit_code", "currency": "currency_code",
    })


def price_constants(source: PriceSource) -> dict[str, str]:
    return {
        "dataset": source.dataset, "commodity_type": source.commodity,
        "consumer_type": source.consumer, "expected_siec": source.siec,
    }


def all_price_observations(spark: SparkSession, sources: list[PriceSource]) -> DataFrame:
    """Observations of all price files, each under the constants of its file."""
    return union_sources([
        (price_observations(*price_cells(spark, source)), price_constants(source)) for source in sources
    ])


def price_codelists(spark: SparkSession, sources: list[PriceSource]) -> DataFrame:
    return union_sources([(read_codelists(spark, s.codelists), {"dataset": s.dataset}) for s in sources])


def conform_prices(codes: DataFrame, codelists: DataFrame) -> DataFrame:
    """Labels, orders and derived attributes of price codes.

    Meant for the distinct code combinations: labels belong to dimension members,
    so observations never carry them.
    """
    rows = add_labels(codes, codelists, {
        "SIEC": ("siec_code", "siec_label"),
        "NRG_CONS": ("band_code", "band_label"),
        "TAX": ("tax_code", "tax_label"),
        "UNIT": ("energy_unit_code", "energy_unit_label"),
        "CURRENCY": ("currency_code", "currency_label"),
    })
    rows = add_positions(rows, codelists, "NRG_CONS", "band_code", "band_order", 0)
    return rows.join(fixed.tax_order(rows.sparkSession), "tax_code", "left").withColumns({
        "is_total_band": F.startswith("band_code", F.lit("TOT_")),
        "price_basis": F.concat_ws(" per ", "currency_code", "energy_unit_code"),
    })


def price_rules() -> dict[str, Column]:
    """Rules for single observations; true where one is at fault."""
    return {"value out of range": F.col("out_of_range")}


def price_member_rules() -> dict[str, tuple[str, Column]]:
    """Rules for combinations of codes: the code they are about, and where it is at fault."""
    return {
        "unexpected frequency": ("freq", ~F.col("freq").eqNullSafe("S")),
        "unexpected siec": ("siec_code", ~F.col("siec_code").eqNullSafe(F.col("expected_siec"))),
        "siec without label": ("siec_code", F.col("siec_label").isNull()),
        "band without label": ("band_code", F.col("band_label").isNull()),
        "tax without label": ("tax_code", F.col("tax_label").isNull()),
        "tax without order": ("tax_code", F.col("tax_inclusion_order").isNull()),
        "unit without label": ("energy_unit_code", F.col("energy_unit_label").isNull()),
        "currency without label": ("currency_code", F.col("currency_label").isNull()),
        "unknown semester": ("semester_sk", ~F.col("known_period")),
    }


def unknown_geographies(staged: DataFrame, wh: Warehouse) -> DataFrame:
    """Geographies that the warehouse lacks, by name."""
    members = wh.table("dim_geo_entity").withColumnRenamed("eurostat_code", "geo_code")
    return gates.missing_codes("unknown geography", staged, members, ["geo_code"])


PRICE_DIMENSIONS = [
    ("dt_consumption_band", BAND_COLUMNS, BAND_KEY, "consumption_band_sk"),
    ("dt_tax_level", TAX_COLUMNS, ["tax_code"], "tax_level_sk"),
    ("dt_price_unit", UNIT_COLUMNS, UNIT_KEY, "price_unit_sk"),
]


def price_gates(wh: Warehouse, sources: list[PriceSource]) -> Gated:
    """Stage all price files and report on them.

    Files whose header lacks a column are not read further; they are in the report.
    """
    literal, parts, counters = [], [], {}
    for source in sources:
        wide = read_wide(wh.spark, source.path, surplus="surplus_cells")
        found = layout_issues(source.dataset, wide.columns, PRICE_KEYS, "semester")
        literal += found
        if any(count for _, count, _ in found):
            continue
        cells = split_key(wide, set(PRICE_KEYS))
        cells, counters[source.dataset] = lines_counted(cells, line_rules(cells.columns.index("key_parts")))
        parts.append((price_observations(cells).drop("malformed_key"), price_constants(source)))
    if not parts:
        return gated(wh.spark, literal, {})
    kept = Counters(**{
        name: value for dataset in counters
        for name, value in period_counters("semester_sk", F.col("dataset") == dataset, f"{dataset} ").items()
    })
    codelists = wh.stage("price_codelists", price_codelists(wh.spark, sources))
    staged = wh.stage("prices", kept.on(union_sources(parts)))
    codes = conform_prices(counted_codes(staged, [*PRICE_CODES, "semester_sk"]), codelists)
    members = wh.stage("price_members", add_period(codes, wh.table("dt_semester"), "semester_sk"))
    result = {}
    for dataset, lines in counters.items():
        found = lines.get()
        own = {name: kept.get()[f"{dataset} {name}"] for name in ("observations", "first_period", "last_period")}
        result[dataset] = {"source_rows": found.pop("source_rows"), "excluded": 0, **own}
        literal += [(name, count, dataset if count else None) for name, count in found.items()]
        literal.append(empty_issue(f"no observations in {dataset}", own))
    return gated(
        wh.spark, literal, result, staged, price_rules(), PRICE_GRAIN,
        ["dataset", "band_code", "tax_code", "semester_sk", "geo_code"], members, price_member_rules(),
        [
            unknown_geographies(staged, wh),
            *(conflicts(name, members, columns, key) for name, columns, key, _ in PRICE_DIMENSIONS),
            *(codelist_offenders(codelists.filter(F.col("dataset") == d), PRICE_CODELISTS, d) for d in counters),
        ],
        ["unknown geography", *(f"conflicting members of {name}" for name, *_ in PRICE_DIMENSIONS),
         *(f"missing code lists of {d}" for d in counters)],
    )


@staged_load
def load_prices(wh: Warehouse, sources: list[PriceSource]) -> dict[str, dict]:
    """Full refresh from all price files; returns the counters of each dataset."""
    source = price_gates(wh, sources)
    source.enforce()
    facts = add_geo(source.rows, wh)
    for name, columns, key, surrogate in PRICE_DIMENSIONS:
        facts = resolve(facts, merge_members(wh, name, extract_members(source.members, columns), key, surrogate), key, surrogate)
    wh.write("fact_energy_price", facts.withColumn("period_year", period_year(F.col("semester_sk"))))
    return source.counters


def merge_members(wh: Warehouse, name: str, members: DataFrame, key: list[str], surrogate: str) -> DataFrame:
    """Merge members into a dimension and give it for key resolution."""
    merged = wh.stage(name, declared(name, upsert(wh.table(name), members, key, surrogate)))
    wh.write(name, merged)
    return merged


# import dependency --------------------------------------------------------------


def dependency_observations(wide: DataFrame) -> DataFrame:
    cells = unpivot_periods(wide, DEPENDENCY_KEYS, "year", "year_sk")
    return (
        clean_observations(cells, "dep_rate_val", "decimal(12,4)").drop("raw_val")
        .withColumnsRenamed({"geo": "geo_code", "siec": "siec_code"})
        .withColumn("year_sk", F.col("year_sk").cast("int"))
    )


def conform_products(codes: DataFrame, codelists: DataFrame) -> DataFrame:
    rows = add_labels(codes, codelists, {"SIEC": ("siec_code", "siec_label")})
    rows = add_positions(rows, codelists, "SIEC", "siec_code", "product_order", 1)
    return rows.withColumn("is_total", F.col("siec_code") == "TOTAL")


def dependency_rules() -> dict[str, Column]:
    return {"value out of range": F.col("out_of_range")}


def dependency_member_rules() -> dict[str, tuple[str, Column]]:
    return {
        "unexpected frequency": ("freq", ~F.col("freq").eqNullSafe("A")),
        "unexpected unit": ("unit", ~F.col("unit").eqNullSafe("PC")),
        "siec without label": ("siec_code", F.col("siec_label").isNull()),
        "unknown year": ("year_sk", ~F.col("known_period")),
    }


def dependency_gates(wh: Warehouse, path: str, codelists_path: str) -> Gated:
    """Stage the extract and report on it."""
    source = "import dependency"
    wide = read_wide(wh.spark, path, surplus="surplus_cells")
    literal = layout_issues(source, wide.columns, DEPENDENCY_KEYS, "year")
    if any(count for _, count, _ in literal):
        return gated(wh.spark, literal, {})
    cells = split_key(wide, set(DEPENDENCY_KEYS))
    parts = cells.columns.index("key_parts")
    cells, lines = lines_counted(cells, line_rules(parts))
    kept = Counters(**period_counters("year_sk", F.lit(True)))
    codelists = wh.stage("dependency_codelists", read_codelists(wh.spark, codelists_path))
    staged = wh.stage("dependency", kept.on(dependency_observations(cells)))
    codes = conform_products(counted_codes(staged, ["freq", "unit", "siec_code", "year_sk"]), codelists)
    members = wh.stage("dependency_members", add_period(codes, wh.table("dt_year"), "year_sk"))
    found = lines.get()
    counters = {"source_rows": found.pop("source_rows"), "excluded": 0, **kept.get()}
    literal += [(name, count, None) for name, count in found.items()]
    literal.append(empty_issue("no observations", counters))
    return gated(
        wh.spark, literal, {source: counters}, staged, dependency_rules(), DEPENDENCY_GRAIN,
        ["siec_code", "year_sk", "geo_code"], members, dependency_member_rules(),
        [
            unknown_geographies(staged, wh), conflicts("dt_energy_product", members, PRODUCT_COLUMNS, ["siec_code"]),
            codelist_offenders(codelists, DEPENDENCY_CODELISTS, source),
        ],
        ["unknown geography", "conflicting members of dt_energy_product", f"missing code lists of {source}"],
    )


@staged_load
def load_dependency(wh: Warehouse, path: str, codelists_path: str) -> dict[str, int | str]:
    """Full refresh; returns the counters of the extract."""
    source = dependency_gates(wh, path, codelists_path)
    source.enforce()
    products = extract_members(source.members, PRODUCT_COLUMNS)
    merged = merge_members(wh, "dt_energy_product", products, ["siec_code"], "product_sk")
    wh.write("fact_import_dependency", resolve(add_geo(source.rows, wh), merged, ["siec_code"], "product_sk"))
    return source.counters["import dependency"]


# oil stocks -----------------------------------------------------------------------


def stock_cells(spark: SparkSession, path: str) -> DataFrame:
    return split_key(read_wide(spark, path, surplus="surplus_cells"), names=STOCK_KEYS)


def stock_observations(spark: SparkSession, path: str, wide: DataFrame | None = None) -> DataFrame:
    wide = stock_cells(spark, path) if wide is None else wide
    cells = unpivot_periods(wide, STOCK_KEYS, "month", "month_sk")
    return clean_observations(cells, "indicator_value", "decimal(14,4)").drop("raw_val").withColumnsRenamed(
        {"stk_flow": "indicator_code", "unit": "unit_code", "geo": "geo_code"}
    )


def is_method() -> Column:
    """True for the categorical method codes, which are no quantities."""
    return F.col("indicator_code").isin(*fixed.METHOD_CODES)


def mark_supported(observations: DataFrame, geo: DataFrame, months: DataFrame) -> DataFrame:
    """``supported``: geography, indicator, unit and month are known and the unit is
    the one expected of the indicator."""
    expected = fixed.expected_units(observations.sparkSession)
    rows = resolve(observations, geo.withColumnRenamed("eurostat_code", "geo_code"), ["geo_code"], "geo_sk")
    rows = add_period(rows.join(expected, "indicator_code", "left"), months, "month_sk")
    matches = F.coalesce(F.col("unit_code") == F.col("expected_unit"), F.lit(False))
    return rows.withColumn("supported", F.col("geo_sk").isNotNull() & matches & F.col("known_period"))


def stock_rules() -> dict[str, Column]:
    quantity = ~is_method()
    return {"unsupported combination": quantity & ~F.col("supported"), "value out of range": quantity & F.col("out_of_range")}


def stock_gates(wh: Warehouse, path: str) -> Gated:
    """Stage the extract and report on it; method codes are counted and left out."""
    wide = read_wide(wh.spark, path, surplus="surplus_cells")
    literal = [issue for issue in layout_issues("stocks", wide.columns, [], "month") if "month" in issue[0]]
    if any(count for _, count, _ in literal):
        return gated(wh.spark, literal, {})
    cells, lines = lines_counted(split_key(wide, names=STOCK_KEYS), line_rules(len(STOCK_KEYS)))
    quantity = ~is_method()
    kept = Counters(excluded=F.count(F.when(is_method(), 1)), **period_counters("month_sk", quantity))
    marked = mark_supported(
        stock_observations(wh.spark, path, cells), wh.table("dim_geo_entity"), wh.table("dt_month")
    )
    staged = wh.stage("stocks", kept.on(marked))
    found = lines.get()
    counters = {"source_rows": found.pop("source_rows"), **kept.get()}
    literal += [(name, count, None) for name, count in found.items()]
    literal.append(empty_issue("no observations", counters))
    return gated(
        wh.spark, literal, {"stocks": counters}, staged, stock_rules(), STOCK_GRAIN,
        ["indicator_code", "unit_code", "geo_code", "month_sk"], scope=quantity,
    )


@staged_load
def load_stocks(wh: Warehouse, path: str) -> dict[str, int | str]:
    """Full refresh of the quantities; returns the counters of the extract."""
    source = stock_gates(wh, path)
    source.enforce()
    facts = source.in_scope()
    for name, members, key, surrogate in [
        ("dt_stock_indicator", fixed.stock_indicators(wh.spark), ["indicator_code"], "indicator_sk"),
        ("dt_measure_unit", fixed.measure_units(wh.spark), ["unit_code"], "measure_unit_sk"),
    ]:
        facts = resolve(facts, merge_members(wh, name, members, key, surrogate), key, surrogate)
    wh.write("fact_oil_stocks", facts.withColumn("period_year", period_year(F.col("month_sk"))))
    return source.counters["stocks"]


# risk index -----------------------------------------------------------------------


def index_rules(scope_start: str = fixed.INDEX_SCOPE_START) -> tuple[dict[str, Column], Column]:
    """Rules for the rows of the sheet, and which rows are in scope. Dates and
    completeness are judged before the scope filter."""
    populated = index_sheet.has_measure()
    rules = {
        "invalid date": populated & index_sheet.invalid_date(),
        "partial measures": populated & index_sheet.partly_populated(),
    }
    return rules, populated & F.coalesce(F.col("month_sk") >= scope_start, F.lit(False))


def index_gates(wh: Warehouse, path: str, scope_start: str = fixed.INDEX_SCOPE_START) -> Gated:
    """Stage the sheet and report on it; empty rows and those before the scope are counted
    and left out."""
    rows = index_sheet.normalise(index_sheet.read_sheet(wh.spark, path))
    rules, in_scope = index_rules(scope_start)
    populated = index_sheet.has_measure()
    kept = Counters(
        source_rows=F.count("*"), excluded_empty=F.count(F.when(~populated, 1)),
        out_of_scope=F.count(F.when(populated & (F.col("month_sk") < scope_start), 1)), **period_counters("month_sk", in_scope),
    )
    staged = wh.stage("index", kept.on(add_period(rows, wh.table("dt_month"), "month_sk")))
    rules["unknown month"] = in_scope & ~F.col("known_period")
    for m in index_sheet.MEASURES:
        rules[f"{m} out of range"] = in_scope & F.col(m).isNotNull() & F.col(f"{m}_val").isNull()
    is_global = F.col("eurostat_code") == fixed.GLOBAL_CODE
    members = wh.table("dim_geo_entity").agg((F.count(F.when(is_global, 1)) == 0).cast("long").alias("issue_count"))
    counters = kept.get()
    counters["excluded"] = counters["excluded_empty"] + counters["out_of_scope"]
    literal = [empty_issue("no rows in scope", counters)]
    return gated(
        wh.spark, literal, {"index": counters}, staged, rules, ["month_sk"], ["month_sk", *index_sheet.MEASURES],
        scope=in_scope, others=[members.withColumn("check_name", F.lit("no global member"))],
    )


@staged_load
def load_index(wh: Warehouse, path: str, scope_start: str = fixed.INDEX_SCOPE_START) -> dict[str, int | str]:
    """Replace the global series only; other members' series stay. Returns the counters of
    the sheet."""
    source = index_gates(wh, path, scope_start)
    source.enforce()
    # The gate has made sure that there is one
    is_global = F.col("eurostat_code") == fixed.GLOBAL_CODE
    member = wh.table("dim_geo_entity").filter(is_global).select("geo_sk").first().geo_sk
    stored = [f"{m}_val" for m in index_sheet.MEASURES]
    facts = source.in_scope().select("month_sk", *stored, F.lit(member).alias("geo_sk"))
    wh.replace_slice("fact_gpr", facts, [member])
    counters = source.counters["index"]
    return {**counters, "rows in scope": counters["observations"], "excluded empty": counters["excluded_empty"]}


# whole warehouse --------------------------------------------------------------------


def build_warehouse(
    spark: SparkSession, root: str, inputs: Inputs, members: DataFrame | None = None,
    history: DataFrame | None = None, calendars: dict[str, tuple[int, int]] | None = None,
) -> Warehouse:
    """Load everything in dependency order; the first failure stops the run."""
    wh = Warehouse(spark, root)
    load_calendars(wh, **(calendars or {}))
    load_geography(wh, members)
    load_membership(wh, history)
    load_index(wh, inputs.index)
    load_dependency(wh, inputs.dependency, inputs.dependency_codelists)
    load_prices(wh, inputs.prices)
    load_stocks(wh, inputs.stocks)
    return wh
