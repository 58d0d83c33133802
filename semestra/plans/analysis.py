"""The analytical queries over a loaded warehouse.

Every query takes an object with ``table(name)`` and defaults to the European
context it was written for; other contexts, years and countries are parameters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from semestra.functions.numeric import exact_mean, half_up
from semestra.operators.dimensions import star_join, with_known_keys
from semestra.operators.olap import (
    PriceContext,
    Summary,
    drill_across,
    level_stats,
    mean_by,
    mean_of_means,
    mean_where,
    members_only,
    paired_correlation,
    summarise,
)
from semestra.operators.windows import change_from_previous, global_rank, moving_mean

# The contexts of the reported queries
HOUSEHOLD_BAND = PriceContext("ELECTRICITY", band="KWH2500-4999")
ALL_ELECTRICITY = PriceContext("ELECTRICITY")
HOUSEHOLD_ELECTRICITY = PriceContext("ELECTRICITY", consumer="HOUSEHOLD")
BUSINESS_ELECTRICITY = PriceContext("ELECTRICITY", consumer="NON_HOUSEHOLD", band="MWH500-1999")
GAS_COMPARISON = PriceContext(
    "GAS", bands={"HOUSEHOLD": "GJ20-199", "NON_HOUSEHOLD": "GJ10000-99999"}
)
HOUSEHOLD_GAS_WITH_TAX = PriceContext("GAS", consumer="HOUSEHOLD", band="GJ20-199", tax="I_TAX")


def _geo(wh, entity_type=None, countries=None, codes=None) -> DataFrame:
    geo = wh.table("dim_geo_entity")
    if entity_type:
        geo = geo.filter(F.col("entity_type") == entity_type)
    if countries:
        geo = geo.filter(F.col("country_name").isin(*countries))
    if codes:
        geo = geo.filter(F.col("eurostat_code").isin(*codes))
    return geo.select("geo_sk", F.col("country_name").alias("country"))


def _years(facts: DataFrame, column: str, years: tuple[int, int] | None) -> DataFrame:
    return facts.filter(F.col(column).between(*years)) if years else facts


def _prices(wh, ctx: PriceContext, geo: DataFrame | None = None, years=None) -> DataFrame:
    """Prices of one context joined to their dimensions. ``years`` prune partitions, and the
    keys of the context row groups, as the facts are stored in their order."""
    bands = wh.table("dt_consumption_band").filter(ctx.band_condition())
    taxes = wh.table("dt_tax_level").filter(ctx.tax_condition())
    units = wh.table("dt_price_unit").filter(ctx.unit_condition())
    facts = with_known_keys(
        _years(wh.table("fact_energy_price"), "period_year", years),
        {"consumption_band_sk": bands, "tax_level_sk": taxes, "price_unit_sk": units},
    )
    dimensions = [
        (wh.table("dt_semester").select("semester_sk", F.col("year_val").alias("year")), "semester_sk"),
        (bands.select("consumption_band_sk", "consumer_type"), "consumption_band_sk"),
        (taxes.select("tax_level_sk"), "tax_level_sk"),
        (units.select("price_unit_sk"), "price_unit_sk"),
    ]
    if geo is not None:
        dimensions.append((geo, "geo_sk"))
    return star_join(facts, dimensions)


def _dependency(wh, geo: DataFrame | None, product: str, years=None) -> DataFrame:
    facts = _years(wh.table("fact_import_dependency"), "year_sk", years)
    products = wh.table("dt_energy_product").filter(F.col("siec_code") == product)
    dimensions = [
        (wh.table("dt_year").select("year_sk", F.col("year_value").alias("year")), "year_sk"),
        (products.select("product_sk"), "product_sk"),
    ]
    if geo is not None:
        dimensions.append((geo, "geo_sk"))
    return star_join(facts, dimensions)


def _stocks(wh, geo: DataFrame, indicator: str, unit: str, years=None) -> DataFrame:
    indicators = wh.table("dt_stock_indicator").filter(F.col("indicator_code") == indicator)
    units = wh.table("dt_measure_unit").filter(F.col("unit_code") == unit)
    return star_join(
        _years(wh.table("fact_oil_stocks"), "period_year", years),
        [
            (wh.table("dt_month").select("month_sk", F.col("year_val").alias("year")), "month_sk"),
            (geo, "geo_sk"),
            (indicators.select("indicator_sk", F.col("indicator_label").alias("indicator")), "indicator_sk"),
            (units.select("measure_unit_sk"), "measure_unit_sk"),
        ],
    )


def global_index(wh, years: tuple[int, int] | None = None, code: str = "GLOBAL") -> Summary:
    """Annual mean of the monthly index of one member."""
    months = wh.table("dt_month").select("month_sk", F.col("year_val").alias("year"))
    facts = star_join(
        wh.table("fact_gpr"), [(months, "month_sk"), (_geo(wh, codes=[code]).select("geo_sk"), "geo_sk")]
    )
    return summarise(_years(facts, "year", years), ["year"], index_mean=exact_mean(F.col("gpr_val")))


def global_index_by_year(wh, years=None) -> DataFrame:
    return global_index(wh, years).rows.select(
        "year", half_up(F.col("index_mean"), 2).alias("average_global_gpr")
    ).orderBy("year")


def price_by_semester(wh, ctx: PriceContext = HOUSEHOLD_BAND) -> DataFrame:
    """Base cube: price by country and semester."""
    facts = _prices(wh, ctx, _geo(wh, "Country")).withColumnRenamed("semester_sk", "semester")
    keys = ["country", "semester"]
    return mean_by(facts, keys, "price_val", 4, "avg_price_eur_kwh").orderBy(*keys)


def price_by_year(wh, ctx: PriceContext = HOUSEHOLD_BAND) -> DataFrame:
    """Roll-up of the base rows from semester to year."""
    facts = _prices(wh, ctx, _geo(wh, "Country"))
    keys = ["country", "year"]
    return mean_by(facts, keys, "price_val", 4, "avg_price_eur_kwh").orderBy(*keys)


def price_by_consumer(wh, ctx: PriceContext = ALL_ELECTRICITY) -> DataFrame:
    """Drill-down to consumer type, over all bands."""
    facts = _prices(wh, ctx, _geo(wh, "Country"))
    keys = ["country", "year", "consumer_type"]
    return mean_by(facts, keys, "price_val", 4, "avg_price_eur_kwh").orderBy(*keys)


def price_slice(wh, ctx: PriceContext = ALL_ELECTRICITY, country: str = "Italy") -> DataFrame:
    """One country; any entity type."""
    facts = _prices(wh, ctx, _geo(wh, countries=[country]))
    keys = ["country", "year", "consumer_type"]
    return mean_by(facts, keys, "price_val", 4, "avg_price_eur_kwh").orderBy("year", "consumer_type")


def price_dice(
    wh, ctx: PriceContext = HOUSEHOLD_ELECTRICITY,
    countries: tuple[str, ...] = ("Italy", "Germany"), years: tuple[int, int] = (2021, 2023),
) -> DataFrame:
    """A sub-cube of countries and years."""
    facts = _prices(wh, ctx, _geo(wh, countries=countries), years)
    keys = ["country", "year"]
    return mean_by(facts, keys, "price_val", 4, "avg_price_eur_kwh").orderBy(*keys)


def price_and_dependency(
    wh, ctx: PriceContext = HOUSEHOLD_ELECTRICITY,
    countries: tuple[str, ...] = ("Italy", "Germany", "France"),
    years: tuple[int, int] = (2019, 2024), product: str = "TOTAL", how: str = "inner",
) -> DataFrame:
    """Drill-across by country name and year; ``how="left"`` keeps prices without a rate."""
    geo = _geo(wh, countries=countries)
    keys = ["country", "year"]
    prices = summarise(
        _prices(wh, ctx, geo, years), keys,
        avg_price_eur_kwh=half_up(exact_mean(F.col("price_val")), 4),
    )
    rates = summarise(
        _dependency(wh, geo, product, years), keys,
        import_dependency_pct=half_up(exact_mean(F.col("dep_rate_val")), 2),
    )
    return drill_across(prices, rates, keys, how).rows.orderBy(*keys)


def index_price_correlation(
    wh, ctx: PriceContext = BUSINESS_ELECTRICITY, min_years: int = 18
) -> DataFrame:
    """Correlation of the global index with each country's annual price."""
    prices = summarise(
        _prices(wh, ctx, _geo(wh, "Country")), ["year", "country"],
        price_mean=exact_mean(F.col("price_val")),
    )
    pairs = drill_across(prices, global_index(wh), ["year"]).rows
    alias = "pearson_correlation_gpr_price"
    return paired_correlation(
        pairs, "country", "year", "index_mean", "price_mean", min_years, 3, alias
    ).orderBy(F.col(alias).desc_nulls_last(), "country")


def stock_moving_average(
    wh, codes: tuple[str, ...] = ("IT", "DE", "FR", "ES"),
    indicator: str = "STK_EUE_DIR", unit: str = "NR",
) -> DataFrame:
    """Three-month moving average, keeping the monthly rows."""
    facts = _stocks(wh, _geo(wh, codes=codes), indicator, unit)
    alias = "three_month_moving_average_days"
    moved = moving_mean(facts, ["geo_sk", "indicator_sk"], "month_sk", "indicator_value", 3, 2, alias)
    return moved.select(
        F.col("month_sk").alias("month"), "country", "indicator",
        F.col("indicator_value").alias("equivalent_days"), alias,
    ).orderBy("country", F.col("month").desc())


def dependency_and_gas_prices(
    wh, ctx: PriceContext = GAS_COMPARISON, product: str = "TOTAL"
) -> DataFrame:
    """Drill-across by geography key: dependency against two gas prices."""
    rates = summarise(
        _dependency(wh, _geo(wh, "Country"), product), ["year", "geo_sk", "country"],
        rate=exact_mean(F.col("dep_rate_val")),
    )
    prices = summarise(
        _prices(wh, ctx), ["year", "geo_sk"],
        household=mean_where(F.col("consumer_type") == "HOUSEHOLD", "price_val"),
        non_household=mean_where(F.col("consumer_type") == "NON_HOUSEHOLD", "price_val"),
    )
    return (
        drill_across(rates, prices, ["year", "geo_sk"]).rows
        .select(
            "year", "country",
            half_up(F.col("rate"), 2).alias("import_dependency_rate_pct"),
            half_up(F.col("household"), 4).alias("household_gas_price"),
            half_up(F.col("non_household"), 4).alias("non_household_gas_price"),
        )
        .orderBy(F.col("year").desc(), F.col("import_dependency_rate_pct").desc(), "country")
    )


def membership_averages(
    wh, ctx: PriceContext = BUSINESS_ELECTRICITY, product: str = "TOTAL"
) -> DataFrame:
    """Means over the members of each year, with members and contributors counted apart."""
    bridge = wh.table("br_geo_eu_membership")
    members = summarise(bridge, ["year_sk"], eu_member_count=F.countDistinct("geo_sk"))
    years = wh.table("dt_year").select("year_sk", F.col("year_value").alias("year"))
    members = Summary(members.rows.join(years, "year_sk"), ("year_sk",))
    keys = ["year_sk", "geo_sk"]
    rates = members_only(_dependency(wh, None, product), bridge, keys)
    prices = members_only(
        _prices(wh, ctx).withColumn("year_sk", F.col("year")), bridge, keys
    )
    rate = mean_of_means(
        rates, keys, ["year_sk"], "dep_rate_val", "rate", "dependency_contributor_count"
    )
    price = mean_of_means(
        prices, keys, ["year_sk"], "price_val", "price", "electricity_price_contributor_count"
    )
    joined = drill_across(drill_across(members, rate, ["year_sk"]), price, ["year_sk"])
    return joined.rows.select(
        "year", "eu_member_count", "dependency_contributor_count",
        "electricity_price_contributor_count",
        half_up(F.col("rate"), 2).alias("average_eu_import_dependency_pct"),
        half_up(F.col("price"), 4).alias("average_eu_electricity_price"),
    ).orderBy(F.col("year").desc())


def gas_price_change(
    wh, ctx: PriceContext = HOUSEHOLD_GAS_WITH_TAX, years: tuple[int, int] = (2021, 2023)
) -> DataFrame:
    """Change from the previous year within the selected years, next to the global index."""
    prices = summarise(
        _prices(wh, ctx, _geo(wh, "Country"), years), ["country", "year"],
        price_mean=exact_mean(F.col("price_val")),
    )
    changed = change_from_previous(
        prices.rows, ["country"], "year", "price_mean", 2, "gas_price_variation_pct"
    )
    joined = drill_across(Summary(changed, prices.keys), global_index(wh, years), ["year"])
    return joined.rows.select(
        "year", "country",
        half_up(F.col("index_mean"), 2).alias("average_global_gpr"),
        half_up(F.col("price_mean"), 4).alias("household_gas_price"),
        "gas_price_variation_pct",
    ).orderBy("country", "year")


def dependency_ranking(wh, year: int = 2024, product: str = "TOTAL") -> DataFrame:
    """Dense rank and percentile of the countries in one year."""
    facts = _dependency(wh, _geo(wh, "Country"), product, (year, year))
    ranked = global_rank(
        facts.select("country", "dep_rate_val"), "dep_rate_val",
        "dependency_rank", "dependency_percentile",
    )
    return ranked.select(
        "country",
        half_up(F.col("dep_rate_val"), 2).alias(f"import_dependency_rate_{year}_pct"),
        "dependency_rank", "dependency_percentile",
    ).orderBy("dependency_rank", "country")


def annual_stock_levels(
    wh, years: tuple[int, int] = (2020, 2025), indicator: str = "STK_EUE_DIR", unit: str = "NR"
) -> DataFrame:
    """Annual mean, minimum and maximum of the equivalent days."""
    names = ["average_equivalent_days", "minimum_equivalent_days", "maximum_equivalent_days"]
    facts = _stocks(wh, _geo(wh, "Country"), indicator, unit, years)
    return level_stats(facts, ["year", "country"], "indicator_value", 2, names).orderBy(
        F.col("year").desc(), F.col(names[0]).desc(), "country"
    )
