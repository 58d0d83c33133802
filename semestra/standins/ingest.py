"""Reading, reshaping and conforming the stand-in sources, with reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from semestra.functions.text import period_year
from semestra.operators.dimensions import assign_keys, extract_members, resolve
from semestra.plans import loading
from semestra.reference_data import METHOD_CODES, TAX_ORDER, literal_frame
from semestra.session import materialise
from semestra.sources import index_sheet
from semestra.sources.codelists import read_codelists
from semestra.sources.wide_tsv import missing_marker, read_wide, union_sources
from semestra.standins.common import doubles
from semestra.standins.landing import (
    CLEAN_FLOW, DIRTY_FLOW, DIRTY_GEO, DIRTY_UNIT, MONTHS, SEMESTERS, landed, price_sources,
)
from semestra.standins.tables import raw

def all_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loading.all_price_observations(spark, price_sources(spark, sf_dir))


def priced_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code combinations of the price files with their attributes, and ``n``
    observations each; counting comes before the label joins."""
    counted = all_prices(spark, sf_dir).groupBy(*loading.PRICE_CODES).agg(F.count("*").alias("n"))
    return loading.conform_prices(counted, loading.price_codelists(spark, price_sources(spark, sf_dir)))


def _column(period: str) -> str:
    return "p" + period.replace("-", "_").lower()


def _each_extract(spark: SparkSession, sf_dir: str, read) -> DataFrame:
    """Something read from every price extract, with its ``dataset``."""
    return union_sources([(read(source), {"dataset": source.dataset}) for source in price_sources(spark, sf_dir)])


def wide_tsv_scan(spark, sf_dir):
    """The extracts as scanned, header trimmed and made SQL-friendly."""
    def scanned(source):
        wide = read_wide(spark, source.path)
        return wide.toDF("series_key", *[_column(name.strip()) for name in wide.columns[1:]])

    return _each_extract(spark, sf_dir, scanned)


def composite_key_split(spark, sf_dir):
    present = sum(
        (F.when(missing_marker(F.col(f"`{s}`")) | (F.col(f"`{s}`") == ": c"), 0).otherwise(1) for s in SEMESTERS),
        F.lit(0),
    )
    return _each_extract(spark, sf_dir, lambda source: loading.price_cells(spark, source)[0].select(
        *loading.PRICE_KEYS, "key_parts", present.alias("observed")
    ))


def unpivot_periods(spark, sf_dir):
    return _each_extract(spark, sf_dir, lambda source: loading.unpivot_periods(
        loading.price_cells(spark, source)[0], ["geo", "nrg_cons", "tax"], "semester", "semester_sk"
    ))


def clean_observations(spark, sf_dir):
    return doubles(_each_extract(spark, sf_dir, lambda source: loading.price_observations(
        loading.price_cells(spark, source)[0]
    ).select("geo_code", "band_code", "tax_code", "semester_sk", "price_val", "eurostat_flag", "out_of_range")))


def flag_extraction(spark, sf_dir):
    return all_prices(spark, sf_dir).groupBy("dataset", "eurostat_flag").agg(F.count("*").alias("n"))


def multi_source_union(spark, sf_dir):
    return doubles(
        all_prices(spark, sf_dir).groupBy("commodity_type", "consumer_type", "siec_code", "semester_sk")
        .agg(F.count("*").alias("n"), F.min("price_val").alias("lowest"), F.max("price_val").alias("highest"))
    )


def tax_order(spark, sf_dir):
    return doubles(
        priced_codes(spark, sf_dir).groupBy("tax_code", "tax_label", "tax_inclusion_order").agg(F.sum("n").alias("n"))
    )


def derived_flags(spark, sf_dir):
    return priced_codes(spark, sf_dir).groupBy("band_code", "is_total_band", "price_basis").agg(F.sum("n").alias("n"))


def dim_extraction(spark, sf_dir):
    return doubles(extract_members(priced_codes(spark, sf_dir), loading.BAND_COLUMNS))


def codelist_labels(spark, sf_dir):
    """Parts labelled from one code list per brand."""
    codelists = read_codelists(spark, landed(spark, sf_dir, "part_codelists"))
    parts = raw(spark, sf_dir, "part").groupBy(
        F.col("p_brand").alias("codelist"), F.col("p_size").cast("string").alias("code")
    ).agg(F.count("*").alias("n_parts"))
    return parts.join(codelists, ["codelist", "code"], "left").select(
        "codelist", "code", "position", "label", "n_parts"
    )


def fact_key_resolution(spark, sf_dir):
    """Facts of all price files with every natural key resolved."""
    sources = price_sources(spark, sf_dir)
    staged = materialise(loading.all_price_observations(spark, sources), "observations")
    codes = extract_members(staged, loading.PRICE_CODES)
    combinations = materialise(
        loading.conform_prices(codes, loading.price_codelists(spark, sources)), "members"
    )
    geo = raw(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("geo_code"), (F.col("s_suppkey") + 1).cast("int").alias("geo_sk")
    )
    facts = resolve(staged, geo, ["geo_code"], "geo_sk")
    for _, columns, key, surrogate in loading.PRICE_DIMENSIONS:
        members = extract_members(combinations, columns)
        none_yet = members.limit(0).withColumn(surrogate, F.lit(0))
        facts = resolve(facts, assign_keys(members, none_yet, key, surrogate), key, surrogate)
    return doubles(facts.select(
        "semester_sk", "geo_sk", "consumption_band_sk", "tax_level_sk", "price_unit_sk",
        "eurostat_flag", "price_val", period_year(F.col("semester_sk")).alias("period_year"),
    ))


def exclude_codes(spark, sf_dir):
    observations = loading.stock_observations(spark, landed(spark, sf_dir, "stocks"))
    return doubles(
        observations.filter(~loading.is_method()).groupBy("indicator_code")
        .agg(F.count("*").alias("n"), F.max("indicator_value").alias("highest"))
    )


def admissibility_split(spark, sf_dir):
    """Supported and unsupported stock records by code, unit and whether the geography is known."""
    observations = loading.stock_observations(spark, landed(spark, sf_dir, "stocks_dirty"))
    geo = raw(spark, sf_dir, "supplier").select(
        F.concat(F.lit("S"), "s_suppkey").alias("eurostat_code"), F.col("s_suppkey").alias("geo_sk")
    )
    months = literal_frame(spark, [(m,) for m in MONTHS if m >= "1996-01"], "month_sk string")
    marked = loading.mark_supported(observations.filter(~loading.is_method()), geo, months)
    return marked.groupBy("indicator_code", "unit_code", "supported").agg(F.count("*").alias("n"))


def gpr_prepare(spark, sf_dir):
    """Usable rows of the sheet per month within scope."""
    rows = index_sheet.normalise(index_sheet.read_sheet(spark, landed(spark, sf_dir, "index_dirty")))
    return doubles(
        index_sheet.usable_rows(rows, "1996-01").groupBy("month_sk")
        .agg(F.count("*").alias("n"), F.max("gpr").alias("highest"), F.min("gprt").alias("lowest"))
    )


QUERIES = {
    f.__name__: f
    for f in [
        wide_tsv_scan, composite_key_split, unpivot_periods, clean_observations, flag_extraction,
        multi_source_union, tax_order, derived_flags, dim_extraction, codelist_labels,
        fact_key_resolution, exclude_codes, admissibility_split, gpr_prepare,
    ]
}

# Reference SQL ---------------------------------------------------------------

BAND_SQL = """CASE WHEN p_size <= 10 THEN 'B1' WHEN p_size <= 20 THEN 'B2' WHEN p_size <= 30 THEN 'B3'
              WHEN p_size <= 40 THEN 'B4' ELSE 'TOT_B' END"""
TAX_SQL = "CASE l_linenumber % 3 WHEN 0 THEN 'X_TAX' WHEN 1 THEN 'X_VAT' ELSE 'I_TAX' END"
SEMESTER_SQL = "CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN month(o_orderdate) <= 6 THEN '-S1' ELSE '-S2' END"
FLAG_SQL = "CASE n WHEN 1 THEN NULL WHEN 2 THEN 'e' WHEN 3 THEN 'p' ELSE 'ep' END"

CELLS = f"""
lines AS (
  SELECT CASE WHEN l_linestatus <> 'O' AND l_returnflag = 'R' THEN 'nrg_pc_202'
              WHEN l_linestatus <> 'O' THEN 'nrg_pc_203'
              WHEN l_returnflag = 'R' THEN 'nrg_pc_204' ELSE 'nrg_pc_205' END AS dataset,
         {BAND_SQL} AS band, {TAX_SQL} AS tax, l_suppkey, {SEMESTER_SQL} AS semester,
         CAST(l_extendedprice AS DECIMAL(14,4)) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
cells AS (SELECT dataset, band, tax, l_suppkey, semester, min(price) AS price, count(*) AS n FROM lines GROUP BY ALL),
prices AS (
  SELECT *, CASE WHEN dataset IN ('nrg_pc_202', 'nrg_pc_203') THEN 'G3000' ELSE 'E7000' END AS siec_code,
         CASE WHEN dataset IN ('nrg_pc_202', 'nrg_pc_203') THEN 'GAS' ELSE 'ELECTRICITY' END AS commodity_type,
         CASE WHEN dataset IN ('nrg_pc_202', 'nrg_pc_204') THEN 'HOUSEHOLD' ELSE 'NON_HOUSEHOLD' END AS consumer_type,
         'S' || l_suppkey AS geo_code, {FLAG_SQL} AS eurostat_flag,
         CAST(price AS VARCHAR) || CASE n WHEN 1 THEN '' WHEN 2 THEN ' e' WHEN 3 THEN ' p' ELSE ' e p' END AS cell
  FROM cells)"""

_MISSING = "CASE WHEN band = 'TOT_B' THEN ': c' ELSE ': ' END"
_PERIODS = ", ".join(
    f"coalesce(max(CASE WHEN semester = '{s}' THEN cell END), {_MISSING}) AS {_column(s)}" for s in SEMESTERS
)
_SEMESTERS = "(VALUES " + ", ".join(f"('{s}')" for s in SEMESTERS) + ") AS t(semester)"


def sql_numbered(key: str, order: str) -> str:
    """The numbering of new members: by hash bucket, then by key."""
    return f"row_number() OVER (ORDER BY substr(md5({key}), 1, 2), {order})"


_BAND_TEXT = "commodity_type || chr(31) || consumer_type || chr(31) || band"

STOCK_CELLS = f"""
stock AS (
  SELECT {CLEAN_FLOW} AS indicator_code, l_suppkey, strftime(l_shipdate, '%Y-%m') AS month_sk,
         CAST(sum(l_quantity) AS DECIMAL(14,4)) AS v
  FROM lineitem GROUP BY ALL)"""

_METHODS = ", ".join(f"'{code}'" for code in METHOD_CODES)
_TAXES = " ".join(f"WHEN '{code}' THEN {order}" for code, order in TAX_ORDER.items())
_BAND_ORDER = "CASE band WHEN 'TOT_B' THEN 0 WHEN 'B1' THEN 1 WHEN 'B2' THEN 2 WHEN 'B3' THEN 3 ELSE 4 END"

DIRTY_INDEX = """
sheet AS (
  SELECT o_orderpriority = '4-NOT SPECIFIED' AS blank,
         o_orderpriority = '5-LOW' AND o_orderstatus = 'P' AS partial,
         o_orderpriority = '1-URGENT' AND o_orderstatus = 'P' AS undated,
         strftime(o_orderdate, '%Y-%m') AS month_sk, CAST(o_totalprice AS DECIMAL(14,4)) AS v
  FROM orders)"""


def sql_supported(first_month: str) -> str:
    """Whether a stock record's codes go together and are known."""
    return f"""(geo LIKE 'S%' AND month_sk >= '{first_month}' AND indicator_code <> 'STK_OTHER'
        AND unit_code = CASE indicator_code WHEN 'STK_EUE_DIR' THEN 'NR' ELSE 'THS_T' END)"""


ORACLES = {
    "wide_tsv_scan": f"""WITH {CELLS}
        SELECT dataset, 'S,' || siec_code || ',' || band || ',KWH,' || tax || ',EUR,S' || l_suppkey AS series_key, {_PERIODS}
        FROM prices GROUP BY dataset, siec_code, band, tax, l_suppkey""",
    "composite_key_split": f"""WITH {CELLS}
        SELECT dataset, 'S' AS freq, siec_code AS siec, band AS nrg_cons, 'KWH' AS unit, tax, 'EUR' AS currency,
               'S' || l_suppkey AS geo, 7 AS key_parts, CAST(count(*) AS INT) AS observed
        FROM prices GROUP BY dataset, siec_code, band, tax, l_suppkey""",
    "unpivot_periods": f"""WITH {CELLS},
        series AS (SELECT DISTINCT dataset, band, tax, l_suppkey FROM prices)
        SELECT dataset, 'S' || l_suppkey AS geo, band AS nrg_cons, tax, semester AS semester_sk,
               coalesce(cell, {_MISSING}) AS raw_val
        FROM series CROSS JOIN {_SEMESTERS}
        LEFT JOIN (SELECT dataset, band, tax, l_suppkey, semester, cell FROM prices)
          USING (dataset, band, tax, l_suppkey, semester)""",
    "clean_observations": f"""WITH {CELLS}
        SELECT dataset, geo_code, band AS band_code, tax AS tax_code, semester AS semester_sk,
               CAST(price AS DOUBLE) AS price_val, eurostat_flag, false AS out_of_range
        FROM prices""",
    "flag_extraction": f"WITH {CELLS} SELECT dataset, eurostat_flag, count(*) AS n FROM prices GROUP BY ALL",
    "multi_source_union": f"""WITH {CELLS}
        SELECT commodity_type, consumer_type, siec_code, semester AS semester_sk, count(*) AS n,
               CAST(min(price) AS DOUBLE) AS lowest, CAST(max(price) AS DOUBLE) AS highest FROM prices GROUP BY ALL""",
    "tax_order": f"""WITH {CELLS}
        SELECT tax AS tax_code, 'Code ' || tax AS tax_label, CASE tax {_TAXES} END AS tax_inclusion_order, count(*) AS n
        FROM prices GROUP BY ALL""",
    "derived_flags": f"""WITH {CELLS}
        SELECT band AS band_code, starts_with(band, 'TOT_') AS is_total_band, 'EUR per KWH' AS price_basis,
               count(*) AS n FROM prices GROUP BY ALL""",
    "dim_extraction": f"""WITH {CELLS}
        SELECT DISTINCT commodity_type, consumer_type, band AS band_code, siec_code, 'Code ' || siec_code AS siec_label,
               'Code ' || band AS band_label, {_BAND_ORDER} AS band_order, starts_with(band, 'TOT_') AS is_total_band
        FROM prices""",
    "codelist_labels": """
        WITH p AS (SELECT p_brand AS codelist, p_size, count(*) AS n_parts FROM part GROUP BY ALL),
        l AS (SELECT codelist, p_size, CAST(row_number() OVER (PARTITION BY codelist ORDER BY p_size) - 1 AS INT) AS position,
                     CASE WHEN p_size <= 40 THEN 'Class ' ELSE 'Classe ' END || p_size AS label
              FROM p WHERE codelist <> 'Brand#2' AND p_size < 50)
        SELECT codelist, CAST(p_size AS VARCHAR) AS code, position, label, n_parts
        FROM p LEFT JOIN l USING (codelist, p_size)""",
    "fact_key_resolution": f"""WITH {CELLS},
        b AS (SELECT commodity_type, consumer_type, band,
                     {sql_numbered(_BAND_TEXT, "commodity_type, consumer_type, band")} AS bsk
              FROM (SELECT DISTINCT commodity_type, consumer_type, band FROM prices)),
        t AS (SELECT tax, {sql_numbered("tax", "tax")} AS tsk FROM (SELECT DISTINCT tax FROM prices))
        SELECT semester AS semester_sk, CAST(l_suppkey + 1 AS INT) AS geo_sk, CAST(bsk AS BIGINT) AS consumption_band_sk,
               CAST(tsk AS BIGINT) AS tax_level_sk, CAST(1 AS BIGINT) AS price_unit_sk, eurostat_flag, CAST(price AS DOUBLE) AS price_val,
               CAST(substr(semester, 1, 4) AS INT) AS period_year
        FROM prices JOIN b USING (commodity_type, consumer_type, band) JOIN t USING (tax)""",
    "exclude_codes": f"""WITH {STOCK_CELLS}
        SELECT indicator_code, count(*) AS n, CAST(max(v) AS DOUBLE) AS highest FROM stock
        WHERE indicator_code NOT IN ({_METHODS}) GROUP BY ALL""",
    "admissibility_split": f"""WITH c AS (
          SELECT {DIRTY_FLOW} AS indicator_code, {DIRTY_UNIT} AS unit_code, {DIRTY_GEO} AS geo,
                 strftime(l_shipdate, '%Y-%m') AS month_sk
          FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
        SELECT indicator_code, unit_code,
               geo LIKE 'S%' AND month_sk >= '1996-01' AND indicator_code <> 'STK_OTHER'
                 AND unit_code = CASE indicator_code WHEN 'STK_EUE_DIR' THEN 'NR' ELSE 'THS_T' END AS supported,
               count(*) AS n
        FROM c WHERE indicator_code NOT IN ({_METHODS}) GROUP BY ALL""",
    "gpr_prepare": f"""WITH {DIRTY_INDEX}
        SELECT month_sk, count(*) AS n, CAST(max(v) AS DOUBLE) AS highest, CAST(min(v) AS DOUBLE) AS lowest
        FROM sheet WHERE NOT blank AND NOT partial AND NOT undated AND month_sk >= '1996-01' GROUP BY month_sk""",
}
