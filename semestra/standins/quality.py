"""Gates, verification reports and profiles over the stand-ins, with reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from semestra.functions.periods import period_columns
from semestra.functions.text import month_number, month_text, semester_number, semester_text
from semestra.operators import gates, profile
from semestra.plans import loading, verification
from semestra.plans.loading import PriceSource
from semestra.reference_data import literal_frame
from semestra.schemas import TABLES
from semestra.sources import index_sheet
from semestra.sources.codelists import read_codelists
from semestra.session import new_folder
from semestra.sources.warehouse import Warehouse
from semestra.sources.wide_tsv import read_wide, union_sources
from semestra.standins.common import doubles
from semestra.standins import landing
from semestra.standins.ingest import BAND_SQL, CELLS, DIRTY_INDEX, SEMESTER_SQL, STOCK_CELLS, sql_supported
from semestra.standins.landing import DATASETS, DIRTY_FLOW, DIRTY_GEO, DIRTY_UNIT, landed, price_sources, supplier_members
from semestra.standins.olap import BRIDGE, INDEX, PRICE, STOCK
from semestra.standins.stored import LATECOMER_SK, stored_warehouse
from semestra.standins.tables import GLOBAL_SK, YEARS, StandInWarehouse, raw

HEADER = "freq,siec,nrg_cons,unit,tax,currency,geo\\TIME_PERIOD"


#: Nation whose suppliers are not in the geography of the gates.
UNKNOWN_NATION = 5
#: Calendars of the gates: the last year, and the first year of months, are lacking.
GATE_CALENDARS = {"years": (1990, YEARS[1] - 1), "semesters": (YEARS[0], YEARS[1] - 1), "months": (1996, YEARS[1])}

_gated: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, make):
    """Made on first use in a session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _gated:
        _gated[key] = make()
    return _gated[key]


def gate_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Calendars and geographies, some lacking, that the faulty sources are held against."""

    def make():
        wh = Warehouse(spark, new_folder(spark, "gates"))
        unknown = raw(spark, sf_dir, "supplier").filter(F.col("s_nationkey") == UNKNOWN_NATION).select(
            F.concat(F.lit("S"), "s_suppkey").alias("eurostat_code")
        )
        loading.load_calendars(wh, **GATE_CALENDARS)
        loading.load_geography(wh, supplier_members(spark, sf_dir).join(unknown, "eurostat_code", "left_anti"))
        return wh

    return _once(spark, sf_dir, "warehouse", make)


def empty_source(spark: SparkSession, sf_dir: str) -> PriceSource:
    """An extract without a number."""
    lists = landed(spark, sf_dir, "faulty_codelists")
    return PriceSource("nrg_pc_206", landed(spark, sf_dir, "prices_empty"), lists, "GAS", "HOUSEHOLD", "G3000")


def faulty_sources(spark: SparkSession, sf_dir: str) -> list[PriceSource]:
    """Extracts breaking rules of keys, codes and cells; one without a number; and one with
    the header of another subject."""
    at = lambda name: landed(spark, sf_dir, name)
    lists = at("faulty_codelists")
    return [
        PriceSource("nrg_pc_204", at("prices_dirty"), lists, "ELECTRICITY", "HOUSEHOLD", "E7000"),
        PriceSource("nrg_pc_205", at("prices_faulty"), lists, "ELECTRICITY", "NON_HOUSEHOLD", "E7000"),
        empty_source(spark, sf_dir),
        PriceSource("nrg_pc_299", at("dependency"), lists, "GAS", "NON_HOUSEHOLD", "G3000"),
    ]


def gated_prices(spark: SparkSession, sf_dir: str) -> loading.Gated:
    wh = gate_warehouse(spark, sf_dir)
    return _once(spark, sf_dir, "prices", lambda: loading.price_gates(wh, faulty_sources(spark, sf_dir)))


def price_gate_report(spark, sf_dir):
    """What the gates of the price load say about faulty extracts."""
    return gated_prices(spark, sf_dir).report


def dependency_gate_report(spark, sf_dir):
    """What the gates of the dependency load say about a faulty extract."""
    return loading.dependency_gates(
        gate_warehouse(spark, sf_dir), landed(spark, sf_dir, "dependency_dirty"), landed(spark, sf_dir, "faulty_products")
    ).report


def stock_gate_report(spark, sf_dir):
    """What the gates of the stock load say about a faulty extract."""
    return loading.stock_gates(gate_warehouse(spark, sf_dir), landed(spark, sf_dir, "stocks_dirty")).report


def gate_schema(spark, sf_dir):
    """Per extract: key columns a dependency file would need but this lacks, period columns, rows."""
    reports = []
    for source in price_sources(spark, sf_dir):
        wide = read_wide(spark, source.path)
        (_, _, missing), _ = loading.layout_issues(source.dataset, wide.columns, [*loading.PRICE_KEYS, "stk_flow"], "semester")
        reports.append(wide.agg(F.count("*").alias("n_rows")).select(
            F.lit(source.dataset).alias("dataset"), F.lit(missing).alias("missing_columns"),
            F.lit(len(period_columns([c.strip() for c in wide.columns], "semester"))).alias("n_periods"), "n_rows",
        ))
    return gates.combine(reports)


def gate_arity(spark, sf_dir):
    report = price_gate_report(spark, sf_dir)
    return report.filter("check_name = 'key arity'").select("check_name", "issue_count")


def gate_nonempty(spark, sf_dir):
    """Datasets expected against datasets holding observations."""
    sources = [*price_sources(spark, sf_dir), empty_source(spark, sf_dir)]
    found = loading.price_gates(gate_warehouse(spark, sf_dir), sources)
    counted = literal_frame(
        spark, [(f"no observations in {name}", name, counters["observations"]) for name, counters in found.counters.items()],
        "check_name string, dataset string, observations long",
    )
    return counted.join(found.report, "check_name").select(
        "dataset", "observations", F.col("issue_count").cast("int").alias("issue_count")
    )


def gate_domain(spark, sf_dir):
    """Unexpected frequencies and products among the observations."""
    about = literal_frame(
        spark, [("unexpected frequency", "freq"), ("unexpected siec", "siec_code")], "check_name string, dimension string"
    )
    return gated_prices(spark, sf_dir).named.join(about, "check_name").select("dimension", "code", "n")


def gate_tax_order(spark, sf_dir):
    """Tax codes without a rank."""
    named = gated_prices(spark, sf_dir).named
    return named.filter("check_name = 'tax without order'").select(F.col("code").alias("tax_code"), "n")


def gate_codelists(spark, sf_dir):
    """Brands whose code list is missing."""
    codelists = read_codelists(spark, landed(spark, sf_dir, "part_codelists"))
    required = raw(spark, sf_dir, "part").select(F.col("p_brand").alias("codelist")).distinct()
    return gates.missing_codes("missing code lists", required, codelists, ["codelist"]).select(F.col("code").alias("codelist"))


def gate_unlabelled(spark, sf_dir):
    """Codes in use without a label."""
    codelists = read_codelists(spark, landed(spark, sf_dir, "part_codelists"))
    parts = raw(spark, sf_dir, "part").groupBy(
        F.col("p_brand").alias("codelist"), F.col("p_size").cast("string").alias("code")
    ).agg(F.count("*").alias("n"))
    return parts.join(codelists, ["codelist", "code"], "left_anti")


def gate_duplicates(spark, sf_dir):
    key = ["l_orderkey", "l_linenumber"]
    lines = raw(spark, sf_dir, "lineitem")
    return gates.combine([
        gates.duplicate_rows("rows of duplicated keys", lines, key),
        gates.duplicate_groups("duplicated keys", lines, key),
    ])


def gate_missing_members(spark, sf_dir):
    """Parts on line items that a dimension without the largest parts lacks."""
    members = raw(spark, sf_dir, "part").filter("p_size <= 45").select(F.col("p_partkey").alias("l_partkey"))
    return gates.missing_members(raw(spark, sf_dir, "lineitem"), members, ["l_partkey"])


def gpr_gates(spark, sf_dir):
    """What the gates of the index load say about a faulty sheet, and its empty rows."""
    sheet = landed(spark, sf_dir, "index_dirty")
    found = loading.index_gates(gate_warehouse(spark, sf_dir), sheet, "1996-01")
    empty = literal_frame(
        spark, [("excluded empty", found.counters["index"]["excluded_empty"])], "check_name string, issue_count long"
    )
    checks = found.report.filter(F.col("check_name").isin("invalid date", "partial measures", "duplicate grain"))
    return checks.select("check_name", "issue_count").unionByName(empty)


def load_metrics(spark, sf_dir):
    """The counters of all loads: rows read, observations kept, records excluded, periods."""
    wh, inputs = gate_warehouse(spark, sf_dir), landing.inputs(spark, sf_dir)
    counters = {
        **loading.price_gates(wh, inputs.prices).counters, **loading.stock_gates(wh, inputs.stocks).counters,
        **loading.dependency_gates(wh, inputs.dependency, inputs.dependency_codelists).counters,
        **loading.index_gates(wh, inputs.index, "1997-01").counters,
    }
    names = ["source_rows", "observations", "excluded", "first_period", "last_period"]
    return literal_frame(
        spark, [(dataset, *(found[name] for name in names)) for dataset, found in counters.items()],
        "dataset string, source_rows long, observations long, excluded long, first_period string, last_period string",
    )


# verification ---------------------------------------------------------------------


#: What stocks and the index are lowered by.
LOWERED_STOCK, LOWERED_INDEX = 100, 5000


class Overridden:
    """A warehouse with some tables replaced by faulty ones."""

    def __init__(self, warehouse: StandInWarehouse | Warehouse, tables: dict[str, DataFrame]):
        self.warehouse, self.tables = warehouse, tables

    def table(self, name: str) -> DataFrame:
        return self.tables[name] if name in self.tables else self.warehouse.table(name)


def _incomplete(spark, sf_dir) -> Overridden:
    """A member is missing from each dimension; the bridge still has the missing nation,
    and the geography lists every other member twice."""
    wh, whole = StandInWarehouse(spark, sf_dir, without="NATION_5"), StandInWarehouse(spark, sf_dir)
    return Overridden(wh, {
        "dim_geo_entity": wh.geo().unionByName(wh.geo()),
        "br_geo_eu_membership": whole.bridge(),
        "dt_energy_product": wh.products().filter("siec_code <> 'TOTAL'"),
        "dt_consumption_band": wh.bands().filter("band_code <> 'B4'"),
        "dt_tax_level": wh.taxes().filter("tax_code <> 'I_TAX'"),
        "dt_stock_indicator": wh.indicators().filter("indicator_code <> 'A'"),
        "dt_semester": wh.table("dt_semester").filter("semester_sk <> '1996-S2'"),
        "dt_month": wh.table("dt_month").filter("month_sk <> '1997-03'"),
        "dt_year": wh.table("dt_year").filter("year_sk <> 1998"),
    })


def verify_counts(spark, sf_dir):
    return verification.verify_counts(StandInWarehouse(spark, sf_dir))


def verify_duplicates(spark, sf_dir):
    """Index and stock facts taken at the grain of orders and line items, which repeats keys;
    some rows of the other tables stand twice."""
    wh = stored_warehouse(spark, sf_dir)
    index = raw(spark, sf_dir, "orders").select(
        month_text(month_number(F.col("o_orderdate"))).alias("month_sk"), F.lit(GLOBAL_SK).alias("geo_sk")
    )
    stocks = raw(spark, sf_dir, "lineitem").select(
        month_text(month_number(F.col("l_shipdate"))).alias("month_sk"), F.col("l_suppkey").alias("geo_sk"),
        F.col("l_returnflag").alias("indicator_sk"), F.lit(1).alias("measure_unit_sk"),
    )
    twice = {
        name: wh.table(name).unionByName(wh.table(name).filter(PLANTED[name]))
        for name in ("fact_import_dependency", "fact_energy_price", "br_geo_eu_membership")
    }
    return verification.verify_duplicates(Overridden(wh, {"fact_gpr": index, "fact_oil_stocks": stocks, **twice}))


def verify_orphans(spark, sf_dir):
    """Every dimension lacks some member that the facts refer to."""
    return verification.verify_orphans(_incomplete(spark, sf_dir))


def verify_sanity(spark, sf_dir):
    """Prices, stocks and the index lowered until some turn negative; two bands are exempt."""
    wh = StandInWarehouse(spark, sf_dir, offset=-20000)
    lowered = {
        "fact_oil_stocks": wh.stocks().withColumn("indicator_value", F.col("indicator_value") - LOWERED_STOCK),
        "fact_gpr": wh.index().withColumn("gprt_val", F.col("gprt_val") - LOWERED_INDEX),
    }
    return verification.verify_sanity(Overridden(wh, lowered), ("B1", "B2"))


#: Which rows of each table are planted again with faults: a condition, or the periods of
#: a table.
PLANTED = {
    "dim_geo_entity": f"entity_type = 'Country' AND geo_sk <> {LATECOMER_SK}",
    "dt_year": "orders",
    "dt_semester": "orders",
    "dt_month": "orders",
    "br_geo_eu_membership": "year_sk = 1998",
    "dt_energy_product": "siec_code <> 'TOTAL'",
    "dt_price_unit": "energy_unit_code = 'KWH' AND currency_code = 'EUR'",
    "dt_consumption_band": "commodity_type = 'GAS'",
    "dt_tax_level": "tax_code <> 'I_TAX'",
    "dt_stock_indicator": "indicator_code <> 'A'",
    "dt_measure_unit": "unit_code = 'NR'",
    "fact_gpr": f"month_sk LIKE '1997%' AND geo_sk = {GLOBAL_SK}",
    "fact_import_dependency": "geo_sk = 3",
    "fact_energy_price": "geo_sk = 3 AND price_unit_sk = 1",
    "fact_oil_stocks": "geo_sk = 3",
}


class Planted:
    """A warehouse in which some rows of every table stand again: as they are, with every
    required column null, and with keys that no dimension has. The latter have months
    before the scope."""

    def __init__(self, warehouse: Warehouse, orders: DataFrame):
        self.warehouse, self.orders = warehouse, orders
        date = F.col("o_orderdate")
        self.periods = {
            "dt_year": F.year(date), "dt_semester": semester_text(semester_number(date)), "dt_month": month_text(month_number(date)),
        }

    def chosen(self, name: str, rows: DataFrame) -> DataFrame:
        if name not in self.periods:
            return rows.filter(PLANTED[name])
        key = TABLES[name].key[0]
        return rows.join(self.orders.select(self.periods[name].alias(key)).distinct(), key, "left_semi")

    def table(self, name: str) -> DataFrame:
        table, rows = TABLES[name], self.warehouse.table(name)
        again = self.chosen(name, rows)
        nulls = again.withColumns({c: F.lit(None).cast(again.schema[c].dataType) for c in table.required})
        rows, parts = rows, [again, nulls]
        if table.references:
            unknown = {
                key: F.concat(F.lit("0"), key) if again.schema[key].dataType.simpleString() == "string" else -1 - F.col(key)
                for key, _ in table.references
            }
            parts.append(again.withColumns(unknown))
        for part in parts:
            rows = rows.unionByName(part.select(*rows.columns))
        return rows


def constraint_report(spark, sf_dir):
    """Declared constraints of all tables, each violated by some rows of the table."""
    return verification.constraint_report(Planted(stored_warehouse(spark, sf_dir), raw(spark, sf_dir, "orders")))


# profiles -------------------------------------------------------------------------


def profile_shape(spark, sf_dir):
    return union_sources([
        (profile.profile_shape(read_wide(spark, s.path)), {"dataset": s.dataset})
        for s in price_sources(spark, sf_dir)
    ])


def profile_missing(spark, sf_dir):
    return union_sources([
        (profile.profile_missing(read_wide(spark, s.path)), {"dataset": s.dataset})
        for s in price_sources(spark, sf_dir)
    ])


def profile_coverage(spark, sf_dir):
    """Raw time coverage of the sheet, and which indicators its header has."""
    sheet = index_sheet.read_sheet(spark, landed(spark, sf_dir, "index"))
    found = ", ".join(profile.present_columns(sheet, ["GPR", "GPRT", "GPRA", "gpr"]))
    return profile.profile_coverage(sheet, "month").withColumn("indicators", F.lit(found))


def profile_nulls(spark, sf_dir):
    return doubles(profile.profile_nulls(index_sheet.read_sheet(spark, landed(spark, sf_dir, "index_dirty"))))


QUERIES = {
    f.__name__: f
    for f in [
        price_gate_report, dependency_gate_report, stock_gate_report, gate_schema, gate_arity, gate_nonempty, gate_domain, gate_tax_order, gate_codelists,
        gate_unlabelled, gate_duplicates, gate_missing_members, gpr_gates, load_metrics,
        verify_counts, verify_duplicates, verify_orphans, verify_sanity, constraint_report,
        profile_shape, profile_missing, profile_coverage, profile_nulls,
    ]
}

# Reference SQL ---------------------------------------------------------------

DIRTY = f"""
lines AS (
  SELECT CASE WHEN s_acctbal > 9000 THEN 'A' ELSE 'S' END AS freq,
         CASE WHEN s_nationkey = 3 THEN 'G3000' ELSE 'E7000' END AS siec, s_acctbal >= 0 AS whole,
         CASE WHEN l_linenumber = 7 THEN 'Z_TAX' ELSE
           CASE l_linenumber % 3 WHEN 0 THEN 'X_TAX' WHEN 1 THEN 'X_VAT' ELSE 'I_TAX' END END AS tax,
         {BAND_SQL} AS band, l_suppkey, {SEMESTER_SQL} AS semester
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
  JOIN supplier ON l_suppkey = s_suppkey),
dirty AS (SELECT DISTINCT * FROM lines)"""

DEPENDENCY = """
px_rate AS (
  SELECT CAST(year(l_shipdate) AS INT) AS year, s_nationkey AS geo_sk, p_brand AS product
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY ALL
  UNION ALL
  SELECT CAST(year(l_shipdate) AS INT), s_nationkey, 'TOTAL'
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)"""

_BAD = "(SELECT n_nationkey FROM nation WHERE n_name = 'NATION_5')"
# How many rows of each table are planted
_PLANTED = {
    "dim_geo_entity": "SELECT count(*) FROM nation",
    "dt_year": "SELECT count(DISTINCT year(o_orderdate)) FROM orders",
    "dt_semester": "SELECT count(DISTINCT (year(o_orderdate), month(o_orderdate) <= 6)) FROM orders",
    "dt_month": "SELECT count(DISTINCT strftime(o_orderdate, '%Y-%m')) FROM orders",
    "br_geo_eu_membership": "SELECT count(*) FROM px_bridge WHERE year = 1998",
    "dt_energy_product": "SELECT count(DISTINCT p_brand) FROM part",
    "dt_price_unit": "SELECT count(DISTINCT 'KWH') FROM lineitem",
    "dt_consumption_band": f"SELECT 2 * count(DISTINCT {BAND_SQL}) FROM part",
    "dt_tax_level": "SELECT count(DISTINCT l_linenumber % 3) FROM lineitem WHERE l_linenumber % 3 <> 2",
    "dt_stock_indicator": "SELECT count(DISTINCT l_returnflag) FROM lineitem WHERE l_returnflag <> 'A'",
    "dt_measure_unit": "SELECT count(DISTINCT 'NR') FROM lineitem",
    "fact_gpr": "SELECT count(*) FROM px_index WHERE month_sk LIKE '1997%'",
    "fact_import_dependency": "SELECT count(*) FROM px_rate WHERE geo_sk = 3",
    "fact_energy_price": "SELECT count(*) FROM px_all WHERE geo_sk = 3",
    "fact_oil_stocks": "SELECT count(*) FROM px_stock WHERE geo_sk = 3",
}


def _constraint_counts() -> list[str]:
    """Every constraint is broken by each row that is planted for it."""
    out = []
    for table in TABLES.values():
        names = [f"{table.name}.{column} is null" for column in table.required]
        names += [f"{table.name} {check}" for check in table.checks]
        names += [f"{table.name}.{key} not in {parent}" for key, parent in table.references]
        names += [f"{table.name} duplicate {', '.join(key)}" for key in (table.key, *table.unique)]
        out += [f"SELECT '{name}' AS check_name, CAST(({_PLANTED[table.name]}) AS BIGINT) AS issue_count" for name in names]
    return out


_CONSTRAINTS = " UNION ALL ".join(_constraint_counts())
_DATASETS = "(VALUES " + ", ".join(f"('{name}')" for name in [*DATASETS, "nrg_pc_206"]) + ") AS t(dataset)"


def _none(*names: str) -> str:
    """Checks without a finding."""
    return " UNION ALL ".join(f"SELECT '{name}' AS check_name, CAST(0 AS BIGINT) AS issue_count, CAST(NULL AS VARCHAR) AS codes" for name in names)


def _counted(name: str, source: str, codes: str | None = None) -> str:
    """A check with a count; ``codes`` names it where there is one."""
    told = f"CASE WHEN count(*) > 0 THEN '{codes}' END" if codes else "CAST(NULL AS VARCHAR)"
    return f"SELECT '{name}', count(*), {told} FROM {source}"


def _codes(name: str, code: str, source: str) -> str:
    """A check that names its first ten codes and counts the rows that have any."""
    return f"""SELECT '{name}', count(*), CASE WHEN count(*) > 0 THEN
        array_to_string(list_slice(list_sort(list(DISTINCT coalesce({code}, '(none)'))), 1, 10), ', ') END FROM {source}"""


_REPEATED = "(SELECT unnest(range(copies)) FROM (SELECT count(*) AS copies FROM {0} GROUP BY {1} HAVING count(*) > 1))"

_PRICE_REPORT = f"""WITH {DIRTY},
  faulty_cells AS (
    SELECT DISTINCT {BAND_SQL} AS band, l_suppkey, s_nationkey, {SEMESTER_SQL} AS semester
    FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey
    JOIN supplier ON l_suppkey = s_suppkey),
  faulty AS (SELECT * FROM faulty_cells UNION ALL SELECT * FROM faulty_cells WHERE s_nationkey = 7),
  obs AS (
    SELECT freq, siec, band, tax, semester, CASE WHEN whole THEN 'EUR' ELSE 'S' || l_suppkey END AS currency,
           CASE WHEN whole THEN 'S' || l_suppkey END AS geo, s_nationkey, 'HOUSEHOLD' AS consumer
    FROM dirty JOIN supplier ON l_suppkey = s_suppkey
    UNION ALL
    SELECT 'S', 'E7000', band, 'X_VAT', semester, 'EUR', 'S' || l_suppkey, s_nationkey, 'NON_HOUSEHOLD' FROM faulty),
  conflict AS (
    SELECT 'ELECTRICITY ' || consumer || ' ' || band AS code, count(DISTINCT siec) AS n FROM obs GROUP BY consumer, band
    HAVING count(DISTINCT siec) > 1),
  conflicts AS (SELECT code, unnest(range(n)) FROM conflict)
{_none(
    *(f"missing {what} columns of nrg_pc_{n}" for what in ("key", "semester") for n in (204, 205, 206)),
    "no observations in nrg_pc_204", "no observations in nrg_pc_205",
    "conflicting members of dt_tax_level", "conflicting members of dt_price_unit",
)}
UNION ALL SELECT 'missing key columns of nrg_pc_299', 3, 'currency, nrg_cons, tax'
UNION ALL SELECT 'missing semester columns of nrg_pc_299', 1, NULL
UNION ALL SELECT 'no observations in nrg_pc_206', 1, NULL
UNION ALL SELECT 'missing code lists of nrg_pc_' || n, 1, 'CURRENCY' FROM range(204, 207) t(n)
UNION ALL {_counted("key arity", "(SELECT DISTINCT freq, siec, tax, band, l_suppkey FROM dirty WHERE NOT whole)", "nrg_pc_204")}
UNION ALL {_counted("surplus cells", "(SELECT DISTINCT band, l_suppkey FROM faulty WHERE s_nationkey = 11)", "nrg_pc_205")}
UNION ALL {_counted("value out of range", "faulty WHERE s_nationkey = 9")}
UNION ALL {_counted("duplicate grain", _REPEATED.format("obs", "consumer, band, tax, semester, currency, geo"))}
UNION ALL {_codes("unexpected frequency", "freq", "obs WHERE freq <> 'S'")}
UNION ALL {_codes("unexpected siec", "siec", "obs WHERE siec <> 'E7000'")}
UNION ALL {_codes("siec without label", "siec", "obs WHERE siec <> 'E7000'")}
UNION ALL {_codes("band without label", "band", "obs WHERE band = 'B4'")}
UNION ALL {_codes("tax without label", "tax", "obs WHERE tax = 'I_TAX'")}
UNION ALL {_codes("tax without order", "tax", "obs WHERE tax = 'Z_TAX'")}
UNION ALL {_codes("unit without label", "'KWH'", "obs")}
UNION ALL {_codes("currency without label", "currency", "obs")}
UNION ALL {_codes("unknown semester", "semester", f"obs WHERE semester >= '{YEARS[1]}'")}
UNION ALL {_codes("unknown geography", "geo", f"obs WHERE geo IS NULL OR s_nationkey = {UNKNOWN_NATION}")}
UNION ALL {_codes("conflicting members of dt_consumption_band", "code", "conflicts")}"""

_DEPENDENCY_REPORT = f"""WITH cells AS (
    SELECT DISTINCT CASE WHEN s_acctbal > 9000 THEN 'Q' ELSE 'A' END AS freq,
           CASE WHEN l_linenumber = 7 THEN 'X' ELSE '' END || p_brand AS siec, s_nationkey, l_suppkey, s_acctbal >= 0 AS whole,
           CASE WHEN s_acctbal < 0 THEN 'S' || l_suppkey WHEN s_nationkey = 3 THEN 'THS' ELSE 'PC' END AS unit,
           CASE WHEN s_acctbal >= 0 THEN 'S' || l_suppkey END AS geo, year(l_shipdate) AS year
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
  obs AS (SELECT * FROM cells UNION ALL SELECT * FROM cells WHERE s_nationkey = 7),
  series AS (
    SELECT DISTINCT siec, l_suppkey, s_nationkey FROM cells WHERE NOT whole
    UNION ALL SELECT DISTINCT siec, l_suppkey, s_nationkey FROM cells WHERE NOT whole AND s_nationkey = 7)
{_none(
    "missing key columns of import dependency", "missing year columns of import dependency", "surplus cells", "no observations",
    "conflicting members of dt_energy_product",
)}
UNION ALL SELECT 'missing code lists of import dependency', 1, 'UNIT'
UNION ALL {_counted("key arity", "series")}
UNION ALL {_counted("value out of range", "obs WHERE s_nationkey = 9")}
UNION ALL {_counted("duplicate grain", _REPEATED.format("obs", "year, geo, siec"))}
UNION ALL {_codes("unexpected frequency", "freq", "obs WHERE freq <> 'A'")}
UNION ALL {_codes("unexpected unit", "unit", "obs WHERE unit <> 'PC'")}
UNION ALL {_codes("siec without label", "siec", "obs WHERE siec LIKE 'X%'")}
UNION ALL {_codes("unknown year", "CAST(year AS VARCHAR)", f"obs WHERE year >= {YEARS[1]}")}
UNION ALL {_codes("unknown geography", "geo", f"obs WHERE geo IS NULL OR s_nationkey = {UNKNOWN_NATION}")}"""

_METHOD_CODES = ", ".join(f"'{code}'" for code in loading.fixed.METHOD_CODES)

_STOCK_REPORT = f"""WITH c AS (
    SELECT {DIRTY_FLOW} AS indicator_code, {DIRTY_UNIT} AS unit_code, {DIRTY_GEO} AS geo,
           strftime(l_shipdate, '%Y-%m') AS month_sk, any_value(s_nationkey) AS nation
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
{_none("missing month columns of stocks", "key arity", "surplus cells", "no observations", "value out of range", "duplicate grain")}
UNION ALL {_counted("unsupported combination", f"""c WHERE indicator_code NOT IN ({_METHOD_CODES})
    AND NOT ({sql_supported("1996-01")} AND nation <> {UNKNOWN_NATION})""")}"""

ORACLES = {
    "price_gate_report": _PRICE_REPORT,
    "dependency_gate_report": _DEPENDENCY_REPORT,
    "stock_gate_report": _STOCK_REPORT,
    "gate_schema": f"""WITH {CELLS}
        SELECT dataset, 'stk_flow' AS missing_columns, 14 AS n_periods, count(DISTINCT (band, tax, l_suppkey)) AS n_rows
        FROM prices GROUP BY dataset""",
    "gate_arity": f"""WITH {DIRTY}
        SELECT 'key arity' AS check_name, count(DISTINCT (freq, siec, tax, band, l_suppkey)) AS issue_count
        FROM dirty WHERE NOT whole""",
    "gate_nonempty": f"""WITH {CELLS}, f AS (SELECT dataset, count(*) AS n FROM prices GROUP BY dataset)
        SELECT dataset, coalesce(n, 0) AS observations, CASE WHEN n > 0 THEN 0 ELSE 1 END AS issue_count
        FROM {_DATASETS} LEFT JOIN f USING (dataset)""",
    "gate_domain": f"""WITH {DIRTY}
        SELECT 'freq' AS dimension, freq AS code, count(*) AS n FROM dirty WHERE freq <> 'S' GROUP BY freq
        UNION ALL
        SELECT 'siec_code', siec, count(*) FROM dirty WHERE siec <> 'E7000' GROUP BY siec""",
    "gate_tax_order": f"""WITH {DIRTY}
        SELECT tax AS tax_code, count(*) AS n FROM dirty WHERE tax = 'Z_TAX' GROUP BY tax""",
    "gate_codelists": "SELECT DISTINCT p_brand AS codelist FROM part WHERE p_brand = 'Brand#2'",
    "gate_unlabelled": """SELECT p_brand AS codelist, CAST(p_size AS VARCHAR) AS code, count(*) AS n
        FROM part WHERE p_brand = 'Brand#2' OR p_size >= 50 GROUP BY ALL""",
    "gate_duplicates": """WITH d AS (
          SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1)
        SELECT 'rows of duplicated keys' AS check_name, CAST(coalesce(sum(copies), 0) AS BIGINT) AS issue_count FROM d
        UNION ALL SELECT 'duplicated keys', count(*) FROM d""",
    "gate_missing_members": """SELECT DISTINCT l_partkey FROM lineitem
        WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 45)""",
    "gpr_gates": f"""WITH {DIRTY_INDEX}, p AS (SELECT * FROM sheet WHERE NOT blank),
        d AS (SELECT month_sk, count(*) AS copies FROM p WHERE NOT undated AND month_sk >= '1996-01'
              GROUP BY month_sk HAVING count(*) > 1)
        SELECT 'excluded empty' AS check_name, count(*) AS issue_count FROM sheet WHERE blank
        UNION ALL SELECT 'invalid date', count(*) FROM p WHERE undated
        UNION ALL SELECT 'partial measures', count(*) FROM p WHERE partial
        UNION ALL SELECT 'duplicate grain', CAST(coalesce(sum(copies), 0) AS BIGINT) FROM d""",
    "load_metrics": f"""WITH {CELLS}, {STOCK_CELLS}, {DEPENDENCY},
        m AS (SELECT *, indicator_code LIKE '%MTH' AS method FROM stock),
        d AS (SELECT DISTINCT product, l_suppkey, year FROM (
          SELECT p_brand AS product, l_suppkey, year(l_shipdate) AS year FROM lineitem JOIN part ON l_partkey = p_partkey
          UNION ALL SELECT 'TOTAL', l_suppkey, year(l_shipdate) FROM lineitem)),
        i AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month_sk FROM orders)
        SELECT dataset, count(DISTINCT (band, tax, l_suppkey)) AS source_rows, count(*) AS observations,
               CAST(0 AS BIGINT) AS excluded, min(semester) AS first_period, max(semester) AS last_period
        FROM prices GROUP BY dataset
        UNION ALL
        SELECT 'stocks', count(DISTINCT (indicator_code, l_suppkey)), count(*) FILTER (WHERE NOT method),
               count(*) FILTER (WHERE method), min(month_sk) FILTER (WHERE NOT method),
               max(month_sk) FILTER (WHERE NOT method) FROM m
        UNION ALL
        SELECT 'import dependency', count(DISTINCT (product, l_suppkey)), count(*), 0,
               CAST(min(year) AS VARCHAR), CAST(max(year) AS VARCHAR) FROM d
        UNION ALL
        SELECT 'index', count(*), count(*) FILTER (WHERE month_sk >= '1997-01'), count(*) FILTER (WHERE month_sk < '1997-01'),
               min(month_sk) FILTER (WHERE month_sk >= '1997-01'), max(month_sk) FILTER (WHERE month_sk >= '1997-01') FROM i""",
    "verify_counts": f"""WITH {PRICE}, {DEPENDENCY}, {INDEX}, {STOCK}, {BRIDGE}
        SELECT 'FACT_GPR' AS table_name, count(*) AS row_count, min(month_sk) AS first_period, max(month_sk) AS last_period FROM px_index
        UNION ALL SELECT 'FACT_IMPORT_DEPENDENCY', count(*), CAST(min(year) AS VARCHAR), CAST(max(year) AS VARCHAR) FROM px_rate
        UNION ALL SELECT 'FACT_ENERGY_PRICE', count(*), min(semester), max(semester) FROM px_all
        UNION ALL SELECT 'FACT_OIL_STOCKS', count(*), min(month_sk), max(month_sk) FROM px_stock
        UNION ALL SELECT 'BR_GEO_EU_MEMBERSHIP', count(*), CAST(min(year) AS VARCHAR), CAST(max(year) AS VARCHAR) FROM px_bridge""",
    "verify_duplicates": f"""WITH {PRICE}, {DEPENDENCY}, {BRIDGE}
        SELECT 'GPR duplicates' AS check_name, count(*) AS issue_count FROM (
          SELECT 1 FROM orders GROUP BY strftime(o_orderdate, '%Y-%m') HAVING count(*) > 1)
        UNION ALL SELECT 'Oil stocks duplicates', count(*) FROM (
          SELECT 1 FROM lineitem GROUP BY strftime(l_shipdate, '%Y-%m'), l_suppkey, l_returnflag HAVING count(*) > 1)
        UNION ALL SELECT 'Import dependency duplicates', count(*) FROM px_rate WHERE geo_sk = 3
        UNION ALL SELECT 'Energy price duplicates', count(*) FROM px_all WHERE geo_sk = 3
        UNION ALL SELECT 'EU membership bridge duplicates', count(*) FROM px_bridge WHERE year = 1998""",
    "verify_orphans": f"""WITH {PRICE}, {DEPENDENCY}, {STOCK}, {INDEX}, {BRIDGE}
        SELECT 'GPR orphan dimensions' AS check_name, count(*) AS issue_count FROM px_index WHERE month_sk = '1997-03'
        UNION ALL SELECT 'Import dependency orphan dimensions', count(*) FROM px_rate
          WHERE geo_sk IN {_BAD} OR product = 'TOTAL' OR year = 1998
        UNION ALL SELECT 'Energy price orphan dimensions', count(*) FROM px_all
          WHERE geo_sk IN {_BAD} OR band_code = 'B4' OR tax_code = 'I_TAX' OR semester = '1996-S2'
        UNION ALL SELECT 'Oil stocks orphan dimensions', count(*) FROM px_stock
          WHERE geo_sk IN {_BAD} OR indicator = 'Stock A' OR month_sk = '1997-03'
        UNION ALL SELECT 'EU membership bridge orphan dimensions', count(*) FROM px_bridge
          WHERE geo_sk IN {_BAD} OR year = 1998""",
    "verify_sanity": f"""WITH {PRICE}, {STOCK}, n AS (SELECT * FROM px_all WHERE price_val < 20000)
        SELECT 'Unexpected negative energy prices' AS check_name, count(*) AS issue_count
        FROM n WHERE band_code NOT IN ('B1', 'B2')
        UNION ALL SELECT 'Negative gas prices', count(*) FROM n WHERE commodity_type = 'GAS'
        UNION ALL SELECT 'Negative oil stock values', count(*) FROM px_stock WHERE indicator_value < {LOWERED_STOCK}
        UNION ALL SELECT 'Negative GPR values', count(*) FROM (
          SELECT 1 FROM orders GROUP BY strftime(o_orderdate, '%Y-%m') HAVING min(o_totalprice) < {LOWERED_INDEX})""",
    "constraint_report": f"WITH {PRICE}, {DEPENDENCY}, {STOCK}, {INDEX}, {BRIDGE} {_CONSTRAINTS}",
    "profile_shape": f"""WITH {CELLS}
        SELECT dataset, count(DISTINCT (band, tax, l_suppkey)) AS n_rows, 15 AS n_columns,
               '{HEADER}' AS composite_column, 7 AS key_parts FROM prices GROUP BY dataset""",
    "profile_missing": f"""WITH {CELLS}
        SELECT dataset, 14 * count(DISTINCT (band, tax, l_suppkey)) - count(*) AS missing_cells
        FROM prices WHERE band <> 'TOT_B' GROUP BY dataset""",
    "profile_coverage": """SELECT min(strftime(o_orderdate, '%Y-%m')) || '-01' AS first_period,
        max(strftime(o_orderdate, '%Y-%m')) || '-01' AS last_period, 'GPR, GPRT, GPRA' AS indicators FROM orders""",
    "profile_nulls": f"""WITH {DIRTY_INDEX}, c AS (
          SELECT 5 * count(*) AS total_cells,
                 3 * count(*) FILTER (WHERE blank) + count(*) FILTER (WHERE partial AND NOT blank) AS null_cells FROM sheet)
        SELECT total_cells, null_cells,
               CAST((20000 * null_cells + total_cells) // (2 * total_cells) AS DOUBLE) / 100.0 AS null_pct FROM c""",
}
