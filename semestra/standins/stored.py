"""The stand-in facts as a stored warehouse, with rows that the queries must leave out.

It is written once per session and scale factor. Besides the stand-ins it holds prices in
other units and currencies, facts of an aggregate geography, a second index series, and a
country with few years: a query that forgets one of its filters gives another result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from semestra.reference_data import literal_frame
from semestra.schemas import TABLES
from semestra.session import new_folder
from semestra.sources.warehouse import Warehouse
from semestra.standins.tables import GEO_SCHEMA, StandInWarehouse

#: A country with prices of its first years only, copied from nation 1.
LATECOMER_SK, LATECOMER, LATECOMER_YEARS = 50, "LATECOMER", 3
#: The aggregate that gets facts, copied from nation 3.
AGGREGATE_SK = 100
#: Other price units: each gets the prices of a third of the geographies, shifted.
OTHER_UNITS = [
    (2, "MWH", "EUR", "Megawatt-hour", "Euro", "EUR per MWH"),
    (3, "KWH", "USD", "Kilowatt-hour", "Dollar", "USD per KWH"),
    (4, "MWH", "USD", "Megawatt-hour", "Dollar", "USD per MWH"),
]

_written: dict[tuple[str, str], str] = {}


def stored_warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        wh = Warehouse(spark, new_folder(spark, "analysis"))
        standin = StandInWarehouse(spark, sf_dir)
        for name in TABLES:
            wh.write(name, _with_others(spark, name, standin.table(name)))
        _written[key] = wh.root
    return Warehouse(spark, _written[key])


def _with_others(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    geo, shift = F.col("geo_sk"), F.lit(1000).cast("decimal(10,4)")

    def copied(source: int, target: int, *measures: str) -> DataFrame:
        moved = rows.filter(geo == source).withColumn("geo_sk", F.lit(target))
        return moved.withColumns({m: F.col(m) + shift for m in measures})

    if name == "dim_geo_entity":
        country = (LATECOMER_SK, "L0", None, None, LATECOMER, "Country", False)
        return rows.unionByName(literal_frame(spark, [country], GEO_SCHEMA))
    if name == "dt_price_unit":
        return rows.unionByName(literal_frame(spark, OTHER_UNITS, rows.schema))
    if name == "fact_energy_price":
        others = rows.withColumn("price_unit_sk", geo % 3 + 2).withColumn("price_val", F.col("price_val") + shift)
        first = rows.agg(F.min("period_year")).scalar()
        late = copied(1, LATECOMER_SK).filter(F.col("period_year") < first + LATECOMER_YEARS)
        return rows.unionByName(others).unionByName(copied(3, AGGREGATE_SK, "price_val")).unionByName(late)
    if name == "fact_import_dependency":
        return rows.unionByName(copied(3, AGGREGATE_SK, "dep_rate_val"))
    if name == "fact_oil_stocks":
        return rows.unionByName(copied(3, AGGREGATE_SK, "indicator_value"))
    if name == "fact_gpr":
        other = rows.withColumn("geo_sk", F.lit(AGGREGATE_SK))
        return rows.unionByName(other.withColumn("gpr_val", F.col("gpr_val") + shift))
    return rows
