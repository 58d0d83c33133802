"""A warehouse derived on the fly from the driver's tables.

The real sources are not at hand, so the facts are stood in for by order and
line-item measures at the same grains, always from the whole raw tables. ``stored``
keeps them as a real warehouse for the analytical queries.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from semestra.functions.text import month_number, month_text, semester_number, semester_text
from semestra.operators import calendar
from semestra.operators.membership import expand_membership
from semestra.reference_data import literal_frame, tax_order

YEARS = (1995, 2001)
COMMODITIES = ["ELECTRICITY", "GAS"]
CONSUMERS = ["HOUSEHOLD", "NON_HOUSEHOLD"]
# Band code -> part sizes it covers
BANDS = {"B1": (1, 10), "B2": (11, 20), "B3": (21, 30), "B4": (31, 40), "TOT_B": (41, 50)}
# Tax code -> remainder of the line number by three
TAXES = {"X_TAX": 0, "X_VAT": 1, "I_TAX": 2}
INDICATORS = ["A", "N", "R"]
GLOBAL_SK = 999
GEO_SCHEMA = (
    "geo_sk int, eurostat_code string, iso_alpha2 string, iso_alpha3 string, "
    "country_name string, entity_type string, is_eu boolean"
)


# Declared, so that opening a table costs no look into its files
RAW_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def money(column: str, data_type: str = "decimal(14,4)") -> Column:
    return F.col(column).cast(data_type)


def band_code(size: Column) -> Column:
    code = F.lit("TOT_B")
    for band, (low, high) in reversed(list(BANDS.items())[:-1]):
        code = F.when(size <= high, band).otherwise(code)
    return code


class StandInWarehouse:
    """``offset`` shifts prices so that checks find something; ``without`` leaves out a
    geography by name."""

    def __init__(self, spark: SparkSession, sf_dir: str, offset: int = 0, without: str | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.offset, self.without = offset, without

    def raw(self, name: str) -> DataFrame:
        return raw(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        builders: dict[str, Callable[[], DataFrame]] = {
            "dim_geo_entity": self.geo,
            "dt_year": lambda: calendar.years(self.spark, 1990, 2005),
            "dt_semester": lambda: calendar.semesters(self.spark, *YEARS),
            "dt_month": lambda: calendar.months(self.spark, *YEARS),
            "br_geo_eu_membership": self.bridge,
            "dt_energy_product": self.products,
            "dt_price_unit": self.units,
            "dt_consumption_band": self.bands,
            "dt_tax_level": self.taxes,
            "dt_stock_indicator": self.indicators,
            "dt_measure_unit": self.measure_units,
            "fact_gpr": self.index,
            "fact_import_dependency": self.dependency,
            "fact_energy_price": self.prices,
            "fact_oil_stocks": self.stocks,
        }
        return builders[name]()

    # dimensions -------------------------------------------------------------

    def geo(self) -> DataFrame:
        none = F.lit(None).cast("string")

        def members(keys: Column, code: Column, name: Column, kind: str, frame: DataFrame):
            return frame.select(
                keys.cast("int").alias("geo_sk"), code.alias("eurostat_code"),
                none.alias("iso_alpha2"), none.alias("iso_alpha3"),
                name.alias("country_name"), F.lit(kind).alias("entity_type"),
                F.lit(False).alias("is_eu"),
            )

        nation, region = F.col("n_nationkey"), F.col("r_regionkey")
        geo = (
            members(nation, F.concat(F.lit("N"), nation), F.col("n_name"), "Country", self.raw("nation"))
            .unionByName(
                members(region + 100, F.concat(F.lit("R"), region), F.col("r_name"), "Aggregate",
                        self.raw("region"))
            )
            .unionByName(literal_frame(
                self.spark, [(GLOBAL_SK, "GLOBAL", None, None, "GLOBAL", "Global", False)], GEO_SCHEMA
            ))
        )
        return geo.filter(F.col("country_name") != self.without) if self.without else geo

    def bridge(self) -> DataFrame:
        key = F.col("n_nationkey")
        history = self.raw("nation").select(
            F.concat(F.lit("N"), key).alias("code"),
            (key % 5 + 1994).alias("entry_year"),
            F.when(key % 7 == 0, 2000).alias("exit_year"),
        )
        return expand_membership(history, calendar.years(self.spark, *YEARS), self.geo())

    def products(self) -> DataFrame:
        """One product per brand (``Brand#12`` has key 12), and the total with key 0."""
        brands = self.raw("part").select("p_brand").distinct().select(
            brand_key(F.col("p_brand")).alias("product_sk"), F.col("p_brand").alias("siec_code")
        )
        total = literal_frame(self.spark, [(0, "TOTAL")], "product_sk int, siec_code string")
        return brands.unionByName(total).select(
            "product_sk", "siec_code", F.col("siec_code").alias("siec_label"),
            F.col("product_sk").cast("smallint").alias("product_order"),
            (F.col("siec_code") == "TOTAL").alias("is_total"),
        )

    def units(self) -> DataFrame:
        return literal_frame(
            self.spark, [(1, "KWH", "EUR", "Kilowatt-hour", "Euro", "EUR per KWH")],
            "price_unit_sk int, energy_unit_code string, currency_code string, "
            "energy_unit_label string, currency_label string, price_basis string",
        )

    def bands(self) -> DataFrame:
        rows = [
            (
                band_key_of(i, j, k), commodity, "E7000" if commodity == "ELECTRICITY" else "G3000",
                commodity.title(), consumer, band, f"Band {band}", k, band.startswith("TOT_"),
            )
            for i, commodity in enumerate(COMMODITIES)
            for j, consumer in enumerate(CONSUMERS)
            for k, band in enumerate(BANDS)
        ]
        return literal_frame(
            self.spark, rows,
            "consumption_band_sk int, commodity_type string, siec_code string, siec_label string, "
            "consumer_type string, band_code string, band_label string, band_order smallint, "
            "is_total_band boolean",
        )

    def taxes(self) -> DataFrame:
        return tax_order(self.spark).select(
            F.col("tax_inclusion_order").cast("int").alias("tax_level_sk"), "tax_code",
            F.col("tax_code").alias("tax_label"), "tax_inclusion_order",
        )

    def indicators(self) -> DataFrame:
        rows = [(i + 1, code, f"Stock {code}", "Stock", "Compliance") for i, code in enumerate(INDICATORS)]
        return literal_frame(
            self.spark, rows,
            "indicator_sk int, indicator_code string, indicator_label string, "
            "indicator_class string, obligation_basis string",
        )

    def measure_units(self) -> DataFrame:
        return literal_frame(
            self.spark, [(1, "NR", "Number")],
            "measure_unit_sk int, unit_code string, unit_label string",
        )

    # facts ------------------------------------------------------------------

    def prices(self) -> DataFrame:
        """Lowest price per semester, nation, band and tax level.

        Orders meet customers before they meet line items, so the largest table is
        shuffled for two joins only and customers never meet it.
        """
        sized = self.raw("part").select(
            F.col("p_partkey").alias("l_partkey"), band_index(F.col("p_size")).alias("band_index")
        )
        placed = (
            self.raw("orders").join(self.raw("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select(
                F.col("o_orderkey").alias("l_orderkey"),
                semester_number(F.col("o_orderdate")).alias("semester"),
                F.col("c_nationkey").alias("geo_sk"),
            )
        )
        commodity = F.when(F.col("l_linestatus") == "O", 0).otherwise(1)
        consumer = F.when(F.col("l_returnflag") == "R", 0).otherwise(1)
        keyed = (
            self.raw("lineitem")
            .join(sized, "l_partkey").join(placed, "l_orderkey")
            .select(
                "semester", "geo_sk",
                band_key_of(commodity, consumer, F.col("band_index")).cast("int").alias("consumption_band_sk"),
                tax_key(F.col("l_linenumber")).alias("tax_level_sk"),
                constant(1, "l_linenumber").alias("price_unit_sk"),
                F.col("l_extendedprice"),
            )
        )
        lowest = F.min(money("l_extendedprice")) + F.lit(self.offset).cast("decimal(10,4)")
        return (
            keyed.groupBy("semester", "geo_sk", "consumption_band_sk", "tax_level_sk", "price_unit_sk")
            .agg(lowest.cast("decimal(14,4)").alias("price_val"))
            .select(
                semester_text(F.col("semester")).alias("semester_sk"), "geo_sk", "consumption_band_sk",
                "tax_level_sk", "price_unit_sk", F.lit(None).cast("string").alias("eurostat_flag"),
                "price_val", F.expr("semester div 10").cast("int").alias("period_year"),
            )
        )

    @cached_property
    def _shipped(self) -> DataFrame:
        lines = self.raw("lineitem").join(
            self.raw("supplier")
            .select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("geo_sk")),
            "l_suppkey",
        )
        return lines.withColumn("year_sk", F.year("l_shipdate"))

    def dependency(self) -> DataFrame:
        """Highest price less a base per year, nation and brand, plus the total."""
        parts = self.raw("part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
        by_brand = self._shipped.join(parts, "l_partkey").select(
            "year_sk", "geo_sk", brand_key(F.col("p_brand")).alias("product_sk"), "l_extendedprice"
        )
        total = self._shipped.select("year_sk", "geo_sk", constant(0, "l_linenumber").alias("product_sk"), "l_extendedprice")

        def rates(rows):
            rate = F.max(money("l_extendedprice", "decimal(12,4)")) - F.lit(60000).cast("decimal(12,4)")
            return rows.groupBy("year_sk", "geo_sk", "product_sk").agg(
                rate.cast("decimal(12,4)").alias("dep_rate_val")
            )

        return rates(by_brand).unionByName(rates(total)).withColumn("eurostat_flag", F.lit(None).cast("string"))

    def index(self) -> DataFrame:
        high = F.max(money("o_totalprice")).alias("gpr_val")
        low = F.min(money("o_totalprice")).alias("gprt_val")
        spread = (F.max(money("o_totalprice")) - F.min(money("o_totalprice"))).cast("decimal(14,4)")
        return (
            self.raw("orders").groupBy(month_number(F.col("o_orderdate")).alias("month"))
            .agg(high, low, spread.alias("gpra_val"))
            .select(
                month_text(F.col("month")).alias("month_sk"), constant(GLOBAL_SK, "gpr_val").alias("geo_sk"),
                "gpr_val", "gprt_val", "gpra_val",
            )
        )

    def stocks(self) -> DataFrame:
        indicator = F.expr("CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END")
        return (
            self._shipped
            .groupBy(
                month_number(F.col("l_shipdate")).alias("month"), "geo_sk",
                indicator.alias("indicator_sk"), constant(1, "l_linenumber").alias("measure_unit_sk"),
            )
            .agg(F.sum("l_quantity").cast("decimal(14,4)").alias("indicator_value"))
            .select(
                month_text(F.col("month")).alias("month_sk"), "geo_sk", "indicator_sk", "measure_unit_sk",
                F.lit(None).cast("string").alias("eurostat_flag"), "indicator_value",
                F.expr("month div 100").cast("int").alias("period_year"),
            )
        )


def constant(value: int, column: str) -> Column:
    """A key that is the same everywhere, as a stored column would hold it. A plain
    literal would be folded out of join conditions and leave a nested-loop join."""
    return F.when(F.col(column).isNotNull(), value)


def brand_key(brand: Column) -> Column:
    return F.regexp_extract(brand, r"(\d+)$", 1).try_cast("int")


def band_index(size: Column) -> Column:
    index = F.lit(len(BANDS) - 1)
    for k, (_, high) in reversed(list(enumerate(list(BANDS.values())[:-1]))):
        index = F.when(size <= high, k).otherwise(index)
    return index


def band_key_of(commodity, consumer, band):
    """Key of a band from its place in the hierarchy; works on ints and on columns."""
    return (commodity * len(CONSUMERS) + consumer) * len(BANDS) + band + 1


def tax_key(line_number: Column) -> Column:
    return (line_number % 3 + 1).cast("int")
