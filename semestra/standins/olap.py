"""The analytical queries over the stand-in warehouse, with reference SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from semestra.functions.numeric import exact_mean, half_up
from semestra.operators.olap import PriceContext
from semestra.operators.selection import extremes, sign_class, zeros_and_highest
from semestra.operators.windows import global_rank
from semestra.plans import analysis
from semestra.standins.common import doubles, sql_mean, sql_rounded, sql_total
from semestra.standins.stored import LATECOMER, LATECOMER_SK, LATECOMER_YEARS, stored_warehouse
from semestra.standins.tables import money, raw

BASE = PriceContext("ELECTRICITY", band="B2")
ALL_BANDS = PriceContext("ELECTRICITY")
HOUSEHOLD = PriceContext("ELECTRICITY", consumer="HOUSEHOLD")
BUSINESS = PriceContext("ELECTRICITY", consumer="NON_HOUSEHOLD", band="B3")
GAS = PriceContext("GAS", bands={"HOUSEHOLD": "B2", "NON_HOUSEHOLD": "B4"})
GAS_TAXED = PriceContext("GAS", consumer="HOUSEHOLD", band="B2", tax="I_TAX")
SLICED = "NATION_7"
DICED = ("NATION_7", "NATION_12")
CROSSED = ("NATION_3", "NATION_7", "NATION_12")
SERIES = ("N3", "N7", "N12", "N20")


def olap_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubles(analysis.price_by_semester(stored_warehouse(spark, sf_dir), BASE))


def olap_rollup(spark, sf_dir):
    return doubles(analysis.price_by_year(stored_warehouse(spark, sf_dir), BASE))


def olap_drilldown(spark, sf_dir):
    return doubles(analysis.price_by_consumer(stored_warehouse(spark, sf_dir), ALL_BANDS))


def olap_slice(spark, sf_dir):
    return doubles(analysis.price_slice(stored_warehouse(spark, sf_dir), ALL_BANDS, SLICED))


def olap_dice(spark, sf_dir):
    return doubles(analysis.price_dice(stored_warehouse(spark, sf_dir), HOUSEHOLD, DICED, (1996, 1998)))


def drill_across(spark, sf_dir):
    wh = stored_warehouse(spark, sf_dir)
    return doubles(analysis.price_and_dependency(wh, HOUSEHOLD, CROSSED, (1996, 2000)))


def drill_across_left(spark, sf_dir):
    """Prices of every country and year, with the rate where there is one."""
    wh = stored_warehouse(spark, sf_dir)
    return doubles(analysis.price_and_dependency(wh, HOUSEHOLD, (*CROSSED, LATECOMER), (1996, 2000), how="left"))


def index_price_correlation(spark, sf_dir):
    return doubles(analysis.index_price_correlation(stored_warehouse(spark, sf_dir), BUSINESS, min_years=7))


def global_index_by_year(spark, sf_dir):
    return doubles(analysis.global_index_by_year(stored_warehouse(spark, sf_dir)))


def moving_average(spark, sf_dir):
    return doubles(analysis.stock_moving_average(stored_warehouse(spark, sf_dir), SERIES, "N"))


def dependency_vs_price(spark, sf_dir):
    return doubles(analysis.dependency_and_gas_prices(stored_warehouse(spark, sf_dir), GAS))


def membership_averages(spark, sf_dir):
    return doubles(analysis.membership_averages(stored_warehouse(spark, sf_dir), BUSINESS))


def yoy_change(spark, sf_dir):
    return doubles(analysis.gas_price_change(stored_warehouse(spark, sf_dir), GAS_TAXED, (1997, 2000)))


def dependency_ranking(spark, sf_dir):
    return doubles(analysis.dependency_ranking(stored_warehouse(spark, sf_dir), 2000))


def order_value_ranking(spark, sf_dir):
    """The ranking operator over every order, where one task could not sort them all."""
    orders = raw(spark, sf_dir, "orders").select("o_orderkey", money("o_totalprice").alias("total_price"))
    return doubles(global_rank(orders, "total_price", "value_rank", "value_percentile"))


def annual_level_stats(spark, sf_dir):
    return doubles(analysis.annual_stock_levels(stored_warehouse(spark, sf_dir), (1996, 2000), "N"))


def _year_2000(column: str):
    return F.col(column).between(
        F.lit("2000-01-01").cast("timestamp_ntz"), F.lit("2000-12-31 23:59:59.999999").cast("timestamp_ntz")
    )


def topk_bottomk(spark, sf_dir):
    """Highest ten and lowest five products of one year above an outlier cut."""
    rate = F.max(money("l_extendedprice")) - F.lit(60000).cast("decimal(14,4)")
    rates = (
        raw(spark, sf_dir, "lineitem").filter(_year_2000("l_shipdate"))
        .groupBy("l_partkey").agg(rate.alias("rate_pct")).filter("rate_pct > -50000")
    )
    chosen = extremes(rates, "rate_pct", "l_partkey", highest=10, lowest=5)
    return doubles(
        chosen.withColumn("sign", sign_class(F.col("rate_pct"))).orderBy("rate_pct", "l_partkey")
    )


def zero_plus_topk(spark, sf_dir):
    """Every customer without orders in one year, plus the ten with the highest mean."""
    value = half_up(exact_mean(money("o_totalprice")), 2)
    means = (
        raw(spark, sf_dir, "orders").filter(_year_2000("o_orderdate"))
        .groupBy(F.col("o_custkey").alias("c_custkey")).agg(value.alias("mean_value"))
    )
    customers = raw(spark, sf_dir, "customer").select("c_custkey").join(means, "c_custkey", "left")
    customers = customers.fillna(0, ["mean_value"])
    return doubles(zeros_and_highest(customers, "mean_value", "c_custkey", 10).orderBy("mean_value", "c_custkey"))


QUERIES = {
    f.__name__: f
    for f in [
        olap_base, olap_rollup, olap_drilldown, olap_slice, olap_dice, drill_across, drill_across_left,
        index_price_correlation, global_index_by_year, moving_average, dependency_vs_price,
        membership_averages, yoy_change, dependency_ranking, order_value_ranking,
        annual_level_stats, topk_bottomk, zero_plus_topk,
    ]
}

# Reference SQL ---------------------------------------------------------------

PRICE = f"""
px_all AS (
  SELECT CAST(year(o_orderdate) AS VARCHAR) || CASE WHEN month(o_orderdate) <= 6 THEN '-S1' ELSE '-S2' END AS semester,
         CAST(year(o_orderdate) AS INT) AS year, c_nationkey AS geo_sk, n_name AS country,
         CASE WHEN l_linestatus = 'O' THEN 'ELECTRICITY' ELSE 'GAS' END AS commodity_type,
         CASE WHEN l_returnflag = 'R' THEN 'HOUSEHOLD' ELSE 'NON_HOUSEHOLD' END AS consumer_type,
         CASE WHEN p_size <= 10 THEN 'B1' WHEN p_size <= 20 THEN 'B2' WHEN p_size <= 30 THEN 'B3'
              WHEN p_size <= 40 THEN 'B4' ELSE 'TOT_B' END AS band_code,
         CASE l_linenumber % 3 WHEN 0 THEN 'X_TAX' WHEN 1 THEN 'X_VAT' ELSE 'I_TAX' END AS tax_code,
         min(CAST(l_extendedprice AS DECIMAL(14,4))) AS price_val
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY ALL),
px_price AS (
  SELECT * FROM px_all UNION ALL
  SELECT * REPLACE ({LATECOMER_SK} AS geo_sk, '{LATECOMER}' AS country) FROM px_all
  WHERE geo_sk = 1 AND year < (SELECT min(year) FROM px_all) + {LATECOMER_YEARS})"""

TOTAL_RATE = """
px_dep AS (
  SELECT CAST(year(l_shipdate) AS INT) AS year, s_nationkey AS geo_sk, n_name AS country,
         max(CAST(l_extendedprice AS DECIMAL(12,4))) - 60000 AS dep_rate_val
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL)"""

INDEX = """
px_index AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month_sk, CAST(year(o_orderdate) AS INT) AS year,
         max(CAST(o_totalprice AS DECIMAL(14,4))) AS gpr_val
  FROM orders GROUP BY ALL)"""

STOCK = """
px_stock AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS month_sk, CAST(year(l_shipdate) AS INT) AS year,
         s_nationkey AS geo_sk, n_name AS country, 'Stock ' || l_returnflag AS indicator,
         CAST(sum(l_quantity) AS DECIMAL(14,4)) AS indicator_value
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  GROUP BY ALL)"""

BRIDGE = """
px_bridge AS (
  SELECT n_nationkey AS geo_sk, CAST(y AS INT) AS year
  FROM nation, range(1995, 2002) AS t(y)
  WHERE y >= 1994 + n_nationkey % 5 AND (n_nationkey % 7 <> 0 OR y < 2000))"""

ELECTRICITY = "commodity_type = 'ELECTRICITY' AND tax_code = 'X_VAT'"
MEAN_PRICE = f"{sql_mean('price_val', 4)} AS avg_price_eur_kwh"


def _in(names) -> str:
    return "(" + ", ".join(f"'{name}'" for name in names) + ")"


ORACLES = {
    "olap_base": f"""WITH {PRICE} SELECT country, semester, {MEAN_PRICE} FROM px_price
        WHERE {ELECTRICITY} AND band_code = 'B2' GROUP BY country, semester""",
    "olap_rollup": f"""WITH {PRICE} SELECT country, year, {MEAN_PRICE} FROM px_price
        WHERE {ELECTRICITY} AND band_code = 'B2' GROUP BY country, year""",
    "olap_drilldown": f"""WITH {PRICE} SELECT country, year, consumer_type, {MEAN_PRICE} FROM px_price
        WHERE {ELECTRICITY} GROUP BY country, year, consumer_type""",
    "olap_slice": f"""WITH {PRICE} SELECT country, year, consumer_type, {MEAN_PRICE} FROM px_price
        WHERE {ELECTRICITY} AND country = '{SLICED}' GROUP BY country, year, consumer_type""",
    "olap_dice": f"""WITH {PRICE} SELECT country, year, {MEAN_PRICE} FROM px_price
        WHERE {ELECTRICITY} AND consumer_type = 'HOUSEHOLD' AND country IN {_in(DICED)}
          AND year BETWEEN 1996 AND 1998 GROUP BY country, year""",
    "drill_across": f"""WITH {PRICE}, {TOTAL_RATE},
        p AS (SELECT country, year, {MEAN_PRICE} FROM px_price
              WHERE {ELECTRICITY} AND consumer_type = 'HOUSEHOLD' GROUP BY country, year),
        d AS (SELECT country, year, {sql_mean('dep_rate_val', 2)} AS import_dependency_pct
              FROM px_dep GROUP BY country, year)
        SELECT country, year, avg_price_eur_kwh, import_dependency_pct FROM p JOIN d USING (country, year)
        WHERE country IN {_in(CROSSED)} AND year BETWEEN 1996 AND 2000""",
    "drill_across_left": f"""WITH {PRICE}, {TOTAL_RATE},
        p AS (SELECT country, year, {MEAN_PRICE} FROM px_price
              WHERE {ELECTRICITY} AND consumer_type = 'HOUSEHOLD' GROUP BY country, year),
        d AS (SELECT country, year, {sql_mean('dep_rate_val', 2)} AS import_dependency_pct
              FROM px_dep GROUP BY country, year)
        SELECT country, year, avg_price_eur_kwh, import_dependency_pct FROM p LEFT JOIN d USING (country, year)
        WHERE country IN {_in((*CROSSED, LATECOMER))} AND year BETWEEN 1996 AND 2000""",
    "index_price_correlation": f"""WITH {PRICE}, {INDEX},
        i AS (SELECT year, CAST({sql_total('gpr_val')} AS DOUBLE) / count(*) / 10000 AS x FROM px_index GROUP BY year),
        p AS (SELECT country, year, CAST({sql_total('price_val')} AS DOUBLE) / count(*) / 10000 AS y FROM px_price
              WHERE {ELECTRICITY} AND consumer_type = 'NON_HOUSEHOLD' AND band_code = 'B3' GROUP BY country, year)
        SELECT country, count(*) AS comparable_years, min(year) AS first_year, max(year) AS last_year,
               CASE WHEN var_pop(x) > 0 AND var_pop(y) > 0 THEN round(corr(x, y), 3) END
                 AS pearson_correlation_gpr_price
        FROM p JOIN i USING (year) GROUP BY country HAVING count(*) >= 7""",
    "global_index_by_year": f"""WITH {INDEX} SELECT year, {sql_mean('gpr_val', 2)} AS average_global_gpr
        FROM px_index GROUP BY year""",
    "moving_average": f"""WITH {STOCK},
        w AS (SELECT month_sk, country, indicator, indicator_value,
                     sum(CAST(indicator_value * 10000 AS HUGEINT)) OVER f AS t, count(*) OVER f AS c
              FROM px_stock WHERE geo_sk IN (3, 7, 12, 20) AND indicator = 'Stock N'
              WINDOW f AS (PARTITION BY geo_sk ORDER BY month_sk ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))
        SELECT month_sk AS month, country, indicator, CAST(indicator_value AS DOUBLE) AS equivalent_days,
               {sql_rounded('t', 'c', 2)} AS three_month_moving_average_days FROM w""",
    "dependency_vs_price": f"""WITH {PRICE}, {TOTAL_RATE},
        h AS (SELECT year, geo_sk, CASE WHEN consumer_type = 'HOUSEHOLD' THEN price_val END AS hh,
                     CASE WHEN consumer_type = 'NON_HOUSEHOLD' THEN price_val END AS nh
              FROM px_price WHERE commodity_type = 'GAS' AND tax_code = 'X_VAT'
                AND ((consumer_type = 'HOUSEHOLD' AND band_code = 'B2')
                  OR (consumer_type = 'NON_HOUSEHOLD' AND band_code = 'B4'))),
        p AS (SELECT year, geo_sk, {sql_mean('hh', 4)} AS household_gas_price,
                     {sql_mean('nh', 4)} AS non_household_gas_price FROM h GROUP BY year, geo_sk),
        d AS (SELECT year, geo_sk, country, {sql_mean('dep_rate_val', 2)} AS import_dependency_rate_pct
              FROM px_dep GROUP BY year, geo_sk, country)
        SELECT year, country, import_dependency_rate_pct, household_gas_price, non_household_gas_price
        FROM d JOIN p USING (year, geo_sk)""",
    # 27720 is divisible by every count up to 12, so member means stay whole numbers.
    "membership_averages": f"""WITH {PRICE}, {TOTAL_RATE}, {BRIDGE},
        m AS (SELECT year, count(DISTINCT geo_sk) AS eu_member_count FROM px_bridge GROUP BY year),
        dm AS (SELECT year, geo_sk, {sql_total('dep_rate_val')} * 27720 // count(*) AS v
               FROM px_dep JOIN px_bridge USING (year, geo_sk) GROUP BY year, geo_sk),
        d AS (SELECT year, count(*) AS dependency_contributor_count, sum(v) AS t FROM dm GROUP BY year),
        pm AS (SELECT year, geo_sk, {sql_total('price_val')} * 27720 // count(*) AS v
               FROM px_price JOIN px_bridge USING (year, geo_sk)
               WHERE {ELECTRICITY} AND consumer_type = 'NON_HOUSEHOLD' AND band_code = 'B3' GROUP BY year, geo_sk),
        p AS (SELECT year, count(*) AS electricity_price_contributor_count, sum(v) AS t FROM pm GROUP BY year)
        SELECT year, eu_member_count, dependency_contributor_count, electricity_price_contributor_count,
               {sql_rounded('d.t', '(27720 * dependency_contributor_count)', 2)} AS average_eu_import_dependency_pct,
               {sql_rounded('p.t', '(27720 * electricity_price_contributor_count)', 4)} AS average_eu_electricity_price
        FROM m JOIN d USING (year) JOIN p USING (year)""",
    "yoy_change": f"""WITH {PRICE}, {INDEX},
        i AS (SELECT year, {sql_mean('gpr_val', 2)} AS average_global_gpr FROM px_index GROUP BY year),
        p AS (SELECT country, year, {sql_total('price_val')} AS t, CAST(count(*) AS HUGEINT) AS c FROM px_price
              WHERE commodity_type = 'GAS' AND consumer_type = 'HOUSEHOLD' AND band_code = 'B2'
                AND tax_code = 'I_TAX' AND year BETWEEN 1997 AND 2000 GROUP BY country, year),
        l AS (SELECT *, lag(t) OVER w AS pt, lag(c) OVER w AS pc FROM p
              WINDOW w AS (PARTITION BY country ORDER BY year)),
        n AS (SELECT *, 10000 * (t * pc - pt * c) AS num, pt * c AS den FROM l)
        SELECT year, country, average_global_gpr, {sql_rounded('t', 'c', 4)} AS household_gas_price,
               CASE WHEN pt IS NULL OR pt = 0 THEN NULL
                    ELSE CAST(sign(num) * sign(den) * ((2 * abs(num) + abs(den)) // (2 * abs(den))) AS DOUBLE) / 100.0
               END AS gas_price_variation_pct
        FROM n JOIN i USING (year)""",
    "dependency_ranking": f"""WITH {TOTAL_RATE},
        r AS (SELECT country, dep_rate_val, dense_rank() OVER (ORDER BY dep_rate_val DESC) AS dependency_rank,
                     rank() OVER (ORDER BY dep_rate_val) - 1 AS k, count(*) OVER () - 1 AS n
              FROM px_dep WHERE year = 2000)
        SELECT country, CAST(dep_rate_val AS DOUBLE) AS import_dependency_rate_2000_pct, dependency_rank,
               CASE WHEN n = 0 THEN 0.0 ELSE CAST((20000 * k + n) // (2 * n) AS DOUBLE) / 100.0 END AS dependency_percentile
        FROM r""",
    "order_value_ranking": """
        WITH o AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(14,4)) AS v FROM orders),
        r AS (SELECT o_orderkey, v, dense_rank() OVER (ORDER BY v DESC) AS value_rank,
                     rank() OVER (ORDER BY v) - 1 AS k, count(*) OVER () - 1 AS n FROM o)
        SELECT o_orderkey, CAST(v AS DOUBLE) AS total_price, value_rank,
               CASE WHEN n = 0 THEN 0.0 ELSE CAST((20000 * k + n) // (2 * n) AS DOUBLE) / 100.0 END AS value_percentile
        FROM r""",
    "annual_level_stats": f"""WITH {STOCK} SELECT year, country,
               {sql_mean('indicator_value', 2)} AS average_equivalent_days,
               CAST(min(indicator_value) AS DOUBLE) AS minimum_equivalent_days,
               CAST(max(indicator_value) AS DOUBLE) AS maximum_equivalent_days
        FROM px_stock WHERE indicator = 'Stock N' AND year BETWEEN 1996 AND 2000 GROUP BY year, country""",
    "topk_bottomk": """
        WITH r AS (SELECT l_partkey, max(CAST(l_extendedprice AS DECIMAL(14,4))) - 60000 AS rate_pct
                   FROM lineitem WHERE year(l_shipdate) = 2000 GROUP BY l_partkey),
        f AS (SELECT *, row_number() OVER (ORDER BY rate_pct DESC, l_partkey) AS hi,
                     row_number() OVER (ORDER BY rate_pct, l_partkey) AS lo FROM r WHERE rate_pct > -50000)
        SELECT l_partkey, CAST(rate_pct AS DOUBLE) AS rate_pct,
               CASE WHEN rate_pct >= 0 THEN 'non_negative' ELSE 'negative' END AS sign
        FROM f WHERE hi <= 10 OR lo <= 5""",
    "zero_plus_topk": f"""
        WITH o AS (SELECT o_custkey AS c_custkey, CAST(o_totalprice AS DECIMAL(14,4)) AS v
                   FROM orders WHERE year(o_orderdate) = 2000),
        a AS (SELECT c_custkey, {sql_mean('v', 2)} AS mean_value FROM o GROUP BY c_custkey),
        c AS (SELECT c_custkey, coalesce(mean_value, 0.0) AS mean_value FROM customer LEFT JOIN a USING (c_custkey)),
        f AS (SELECT *, row_number() OVER (ORDER BY mean_value DESC, c_custkey) AS hi FROM c)
        SELECT c_custkey, mean_value FROM f WHERE mean_value = 0 OR hi <= 10""",
}
