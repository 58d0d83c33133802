"""Calendars, dimension maintenance, sinks and whole loads, with reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from semestra.functions.text import month_number, month_text, semester_number, semester_text
from semestra.operators import calendar
from semestra.operators.dimensions import assign_keys, insert_absent, upsert
from semestra.operators.membership import expand_membership
from semestra.plans import analysis, loading, verification
from semestra.reference_data import GEO_ENTITIES, geo_entities
from semestra.session import new_folder
from semestra.sources.csv_export import write_csv
from semestra.sources.warehouse import Warehouse
from semestra.standins import landing
from semestra.standins.common import doubles
from semestra.standins.ingest import CELLS, STOCK_CELLS, sql_numbered
from semestra.standins.olap import GAS_TAXED, ORACLES as OLAP_ORACLES
from semestra.standins.stored import stored_warehouse
from semestra.standins.tables import GLOBAL_SK, StandInWarehouse, money, raw


# calendars and history ------------------------------------------------------------


def _orders_per(spark: SparkSession, sf_dir: str, periods: DataFrame, key: str, value) -> DataFrame:
    """A generated calendar with the orders falling into each of its periods."""
    counts = raw(spark, sf_dir, "orders").groupBy(value.alias(key)).agg(F.count("*").alias("n"))
    return periods.join(counts, key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


def calendar_year(spark, sf_dir):
    years = calendar.years(spark, 1990, 2005)
    return _orders_per(spark, sf_dir, years, "year_sk", F.year("o_orderdate"))


def calendar_semester(spark, sf_dir):
    semesters = calendar.semesters(spark, 1990, 2005)
    return _orders_per(spark, sf_dir, semesters, "semester_sk", semester_text(semester_number(F.col("o_orderdate"))))


def calendar_month(spark, sf_dir):
    months = calendar.months(spark, 1990, 2005)
    return _orders_per(spark, sf_dir, months, "month_sk", month_text(month_number(F.col("o_orderdate"))))


def eu_membership_bridge(spark, sf_dir):
    """Customers are members from their first order to their last, those still ordering
    in 2001 without an end; customers in debt are not in the geography and are skipped."""
    year = F.year("o_orderdate")
    history = raw(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(year).alias("entry_year"), F.max(year).alias("last_year")
    ).select(
        F.concat(F.lit("C"), "o_custkey").alias("code"), "entry_year",
        F.when(F.col("last_year") < 2001, F.col("last_year") + 1).alias("exit_year"),
    )
    geo = raw(spark, sf_dir, "customer").filter("c_acctbal >= 0").select(
        F.concat(F.lit("C"), "c_custkey").alias("eurostat_code"), F.col("c_custkey").alias("geo_sk")
    )
    return expand_membership(history, calendar.years(spark, 1990, 2005), geo)


# dimensions -----------------------------------------------------------------------


def geo_dimension(spark, sf_dir):
    """The fixed geographies, with nations and regions upserted and customers counted."""
    columns = ["eurostat_code", "iso_alpha2", "iso_alpha3", "country_name", "entity_type", "is_eu"]
    fixed = geo_entities(spark)
    none_yet = fixed.limit(0).withColumn("geo_sk", F.lit(0))
    existing = assign_keys(fixed, none_yet, ["eurostat_code"], "geo_sk")
    incoming = StandInWarehouse(spark, sf_dir).geo().select(*columns)
    members = upsert(existing, incoming, ["eurostat_code"], "geo_sk")
    customers = raw(spark, sf_dir, "customer").groupBy(
        F.concat(F.lit("N"), "c_nationkey").alias("eurostat_code")
    ).agg(F.count("*").alias("n_customers"))
    return members.join(customers, "eurostat_code", "left").fillna(0, ["n_customers"])


def _seen(spark: SparkSession, sf_dir: str, condition) -> DataFrame:
    """Customers in the selected orders with the month they were last seen."""
    return (
        raw(spark, sf_dir, "orders").filter(condition)
        .groupBy(F.concat(F.lit("C"), "o_custkey").alias("code"))
        .agg(F.max(month_text(month_number(F.col("o_orderdate")))).alias("last_seen"))
    )


def _before(year: int):
    return F.col("o_orderdate") < F.lit(f"{year}-01-01").cast("timestamp_ntz")


def _since(year: int):
    return F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp_ntz")


def dim_surrogate_key(spark, sf_dir):
    """A first load: every customer seen gets a key."""
    members = _seen(spark, sf_dir, _since(1995))
    none_yet = members.limit(0).withColumn("customer_sk", F.lit(0))
    return assign_keys(members, none_yet, ["code"], "customer_sk")


def dim_upsert(spark, sf_dir):
    """A second load: known customers keep their key, absent ones stay, new ones follow."""
    first = _seen(spark, sf_dir, _before(1997))
    existing = assign_keys(first, first.limit(0).withColumn("customer_sk", F.lit(0)), ["code"], "customer_sk")
    return upsert(existing, _seen(spark, sf_dir, _since(1998)), ["code"], "customer_sk")


def insert_if_absent(spark, sf_dir):
    """Customer-years of a second load added to those of the first, which stay untouched."""
    def load(condition, label):
        return raw(spark, sf_dir, "orders").filter(condition).select(
            "o_custkey", F.year("o_orderdate").alias("year_sk")
        ).distinct().withColumn("load", F.lit(label))

    return insert_absent(load(_before(1999), "first"), load(_since(1997), "second"), ["o_custkey", "year_sk"])


# sinks and loads ------------------------------------------------------------------


def csv_sink_roundtrip(spark, sf_dir):
    """A query result written as CSV with NULL spelled out, and read back."""
    years = (1997, 2000)
    wh = stored_warehouse(spark, sf_dir)
    result = doubles(analysis.gas_price_change(wh, GAS_TAXED, years))
    path = new_folder(spark, "csv")
    write_csv(result, path, null_text="NULL")
    return spark.read.schema(result.schema).option("header", True).option("nullValue", "NULL").csv(path)


def fact_full_refresh(spark, sf_dir):
    """A stock fact loaded from part of its source, then refreshed from all of it."""
    wh = Warehouse(spark, new_folder(spark, "refresh"))
    wh.write("fact_oil_stocks", StandInWarehouse(spark, sf_dir).stocks().filter("period_year <= 1997"))
    wh.write("fact_oil_stocks", StandInWarehouse(spark, sf_dir).stocks())
    stored = Warehouse(spark, wh.root).table("fact_oil_stocks")
    return doubles(stored.select(
        "month_sk", "geo_sk", "indicator_sk", "measure_unit_sk", "indicator_value", "period_year"
    ))


def _index_of(spark: SparkSession, sf_dir: str, condition, geo_sk) -> DataFrame:
    value = money("o_totalprice")
    return (
        raw(spark, sf_dir, "orders").filter(condition)
        .groupBy(month_text(month_number(F.col("o_orderdate"))).alias("month_sk"), geo_sk.cast("int").alias("geo_sk"))
        .agg(F.max(value).alias("gpr_val"), F.min(value).alias("gprt_val"), F.max(value).alias("gpra_val"))
    )


def fact_slice_refresh(spark, sf_dir):
    """Index series of three order states; then the global one alone is replaced."""
    wh = Warehouse(spark, new_folder(spark, "slice"))
    states = F.expr(f"CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE {GLOBAL_SK} END")
    wh.write("fact_gpr", _index_of(spark, sf_dir, F.lit(True), states))
    wh.replace_slice("fact_gpr", _index_of(spark, sf_dir, F.lit(True), F.lit(GLOBAL_SK)), [GLOBAL_SK])
    stored = Warehouse(spark, wh.root).table("fact_gpr")
    return doubles(stored.select("month_sk", "geo_sk", "gpr_val", "gprt_val"))


def warehouse_row_counts(spark, sf_dir):
    """All sources loaded in order, then counted."""
    wh = loading.build_warehouse(
        spark, new_folder(spark, "warehouse"), landing.inputs(spark, sf_dir),
        landing.supplier_members(spark, sf_dir), landing.supplier_history(spark, sf_dir), landing.CALENDARS,
    )
    return verification.verify_counts(wh)


QUERIES = {
    f.__name__: f
    for f in [
        calendar_year, calendar_semester, calendar_month, eu_membership_bridge, geo_dimension,
        dim_surrogate_key, dim_upsert, insert_if_absent, csv_sink_roundtrip, fact_full_refresh,
        fact_slice_refresh, warehouse_row_counts,
    ]
}

# Reference SQL ---------------------------------------------------------------

_MONTHS = "(SELECT CAST(y AS INT) AS year_val, CAST(m AS INT) AS m FROM range(1990, 2006) t(y), range(1, 13) u(m))"


def _text(value: str | None) -> str:
    return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"


_FIXED_GEO = ", ".join(
    "(" + ", ".join([*(_text(cell) for cell in row[:5]), "true" if row[5] else "false"]) + ")"
    for row in GEO_ENTITIES
)

ORACLES = {
    "calendar_year": """
        WITH o AS (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY ALL)
        SELECT CAST(r.y AS INT) AS year_sk, CAST(r.y AS INT) AS year_value, coalesce(n, 0) AS n
        FROM range(1990, 2006) r(y) LEFT JOIN o ON o.y = r.y""",
    "calendar_semester": f"""
        WITH o AS (SELECT year(o_orderdate) AS y, CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 2 END AS s, count(*) AS n
                   FROM orders GROUP BY ALL)
        SELECT year_val || '-S' || m AS semester_sk, year_val, m AS semester_num, coalesce(n, 0) AS n
        FROM {_MONTHS} LEFT JOIN o ON y = year_val AND s = m WHERE m <= 2""",
    "calendar_month": f"""
        WITH o AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS k, count(*) AS n FROM orders GROUP BY ALL)
        SELECT year_val || '-' || lpad(CAST(m AS VARCHAR), 2, '0') AS month_sk, year_val, m AS month_num,
               coalesce(n, 0) AS n
        FROM {_MONTHS} LEFT JOIN o ON y = year_val AND k = m""",
    "eu_membership_bridge": """
        WITH h AS (SELECT o_custkey, min(year(o_orderdate)) AS a, max(year(o_orderdate)) AS z FROM orders GROUP BY ALL)
        SELECT o_custkey AS geo_sk, CAST(y AS INT) AS year_sk
        FROM h JOIN customer ON c_custkey = o_custkey, range(1990, 2006) r(y)
        WHERE c_acctbal >= 0 AND y >= a AND (z = 2001 OR y < z + 1)""",
    "geo_dimension": f"""
        WITH f(eurostat_code, iso_alpha2, iso_alpha3, country_name, entity_type, is_eu) AS (VALUES {_FIXED_GEO}),
        e AS (SELECT *, {sql_numbered('eurostat_code', 'eurostat_code')} AS sk FROM f),
        i AS (SELECT 'N' || n_nationkey AS eurostat_code, n_name AS country_name, 'Country' AS entity_type FROM nation
              UNION ALL SELECT 'R' || r_regionkey, r_name, 'Aggregate' FROM region
              UNION ALL SELECT 'GLOBAL', 'GLOBAL', 'Global'),
        n AS (SELECT *, 46 + {sql_numbered('eurostat_code', 'eurostat_code')} AS sk FROM i WHERE eurostat_code <> 'GLOBAL'),
        m AS (SELECT eurostat_code, iso_alpha2, iso_alpha3, country_name, entity_type, is_eu, sk FROM e
              WHERE eurostat_code <> 'GLOBAL'
              UNION ALL SELECT i.eurostat_code, NULL, NULL, i.country_name, i.entity_type, false, sk
              FROM i JOIN e ON e.eurostat_code = i.eurostat_code
              UNION ALL SELECT eurostat_code, NULL, NULL, country_name, entity_type, false, sk FROM n),
        c AS (SELECT 'N' || c_nationkey AS eurostat_code, count(*) AS n FROM customer GROUP BY ALL)
        SELECT eurostat_code, iso_alpha2, iso_alpha3, country_name, entity_type, is_eu, CAST(sk AS BIGINT) AS geo_sk,
               coalesce(n, 0) AS n_customers FROM m LEFT JOIN c USING (eurostat_code)""",
    "dim_surrogate_key": f"""
        WITH s AS (SELECT 'C' || o_custkey AS code, max(strftime(o_orderdate, '%Y-%m')) AS last_seen
                   FROM orders GROUP BY ALL)
        SELECT code, last_seen, CAST({sql_numbered('code', 'code')} AS BIGINT) AS customer_sk FROM s""",
    "dim_upsert": f"""
        WITH a AS (SELECT 'C' || o_custkey AS code, max(strftime(o_orderdate, '%Y-%m')) AS last_seen
                   FROM orders WHERE year(o_orderdate) < 1997 GROUP BY ALL),
        e AS (SELECT *, {sql_numbered('code', 'code')} AS sk FROM a),
        b AS (SELECT 'C' || o_custkey AS code, max(strftime(o_orderdate, '%Y-%m')) AS last_seen
              FROM orders WHERE year(o_orderdate) >= 1998 GROUP BY ALL),
        n AS (SELECT *, (SELECT count(*) FROM a) + {sql_numbered('code', 'code')} AS sk FROM b
              WHERE code NOT IN (SELECT code FROM a))
        SELECT code, last_seen, CAST(sk AS BIGINT) AS customer_sk FROM e WHERE code NOT IN (SELECT code FROM b)
        UNION ALL SELECT code, b.last_seen, CAST(sk AS BIGINT) FROM b JOIN e USING (code)
        UNION ALL SELECT code, last_seen, CAST(sk AS BIGINT) FROM n""",
    "insert_if_absent": """
        WITH a AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INT) AS year_sk FROM orders WHERE year(o_orderdate) < 1999),
        b AS (SELECT DISTINCT o_custkey, CAST(year(o_orderdate) AS INT) AS year_sk FROM orders WHERE year(o_orderdate) >= 1997)
        SELECT o_custkey, year_sk, 'first' AS load FROM a
        UNION ALL SELECT o_custkey, year_sk, 'second' FROM b ANTI JOIN a USING (o_custkey, year_sk)""",
    "csv_sink_roundtrip": OLAP_ORACLES["yoy_change"],
    "fact_full_refresh": """
        SELECT strftime(l_shipdate, '%Y-%m') AS month_sk, CAST(s_nationkey AS BIGINT) AS geo_sk,
               CAST(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS BIGINT) AS indicator_sk,
               CAST(1 AS BIGINT) AS measure_unit_sk,
               sum(l_quantity) AS indicator_value, CAST(year(l_shipdate) AS INT) AS period_year
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL""",
    "fact_slice_refresh": f"""
        SELECT strftime(o_orderdate, '%Y-%m') AS month_sk, CAST(CASE o_orderstatus WHEN 'F' THEN 1 ELSE 2 END AS BIGINT) AS geo_sk,
               max(o_totalprice) AS gpr_val, min(o_totalprice) AS gprt_val
        FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY ALL
        UNION ALL
        SELECT strftime(o_orderdate, '%Y-%m'), {GLOBAL_SK}, max(o_totalprice), min(o_totalprice) FROM orders GROUP BY ALL""",
    "warehouse_row_counts": f"""WITH {CELLS}, {STOCK_CELLS},
        d AS (SELECT CAST(year(l_shipdate) AS INT) AS y, l_suppkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey
              GROUP BY ALL
              UNION ALL SELECT CAST(year(l_shipdate) AS INT), l_suppkey, 'TOTAL' FROM lineitem GROUP BY ALL),
        h AS (SELECT l_suppkey, min(year(l_shipdate)) AS a FROM lineitem GROUP BY l_suppkey),
        b AS (SELECT y FROM h JOIN supplier ON l_suppkey = s_suppkey, range(1990, 2006) r(y)
              WHERE y >= a AND (s_acctbal >= 0 OR y < 2000)),
        m AS (SELECT month_sk FROM stock WHERE indicator_code NOT LIKE '%MTH'),
        i AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month_sk FROM orders)
        SELECT 'FACT_GPR' AS table_name, count(*) AS row_count, min(month_sk) AS first_period, max(month_sk) AS last_period FROM i
        UNION ALL SELECT 'FACT_IMPORT_DEPENDENCY', count(*), CAST(min(y) AS VARCHAR), CAST(max(y) AS VARCHAR) FROM d
        UNION ALL SELECT 'FACT_ENERGY_PRICE', count(*), min(semester), max(semester) FROM prices
        UNION ALL SELECT 'FACT_OIL_STOCKS', count(*), min(month_sk), max(month_sk) FROM m
        UNION ALL SELECT 'BR_GEO_EU_MEMBERSHIP', count(*), CAST(min(y) AS VARCHAR), CAST(max(y) AS VARCHAR) FROM b""",
}
