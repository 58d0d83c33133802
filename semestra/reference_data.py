"""Fixed values the warehouse starts from, and how to turn them into frames."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Statistical code | ISO alpha-2 | ISO alpha-3 | name | entity type | EU member today
GEO_ENTITIES = [
    ("AL", "AL", "ALB", "Albania", "Country", False),
    ("AT", "AT", "AUT", "Austria", "Country", True),
    ("BE", "BE", "BEL", "Belgium", "Country", True),
    ("BG", "BG", "BGR", "Bulgaria", "Country", True),
    ("CY", "CY", "CYP", "Cyprus", "Country", True),
    ("CZ", "CZ", "CZE", "Czechia", "Country", True),
    ("DE", "DE", "DEU", "Germany", "Country", True),
    ("DK", "DK", "DNK", "Denmark", "Country", True),
    ("EE", "EE", "EST", "Estonia", "Country", True),
    ("EL", "GR", "GRC", "Greece", "Country", True),
    ("ES", "ES", "ESP", "Spain", "Country", True),
    ("FI", "FI", "FIN", "Finland", "Country", True),
    ("FR", "FR", "FRA", "France", "Country", True),
    ("GE", "GE", "GEO", "Georgia", "Country", False),
    ("HR", "HR", "HRV", "Croatia", "Country", True),
    ("HU", "HU", "HUN", "Hungary", "Country", True),
    ("IE", "IE", "IRL", "Ireland", "Country", True),
    ("IT", "IT", "ITA", "Italy", "Country", True),
    ("LT", "LT", "LTU", "Lithuania", "Country", True),
    ("LU", "LU", "LUX", "Luxembourg", "Country", True),
    ("LV", "LV", "LVA", "Latvia", "Country", True),
    ("MD", "MD", "MDA", "Moldova", "Country", False),
    ("ME", "ME", "MNE", "Montenegro", "Country", False),
    ("MK", "MK", "MKD", "North Macedonia", "Country", False),
    ("MT", "MT", "MLT", "Malta", "Country", True),
    ("NL", "NL", "NLD", "Netherlands", "Country", True),
    ("NO", "NO", "NOR", "Norway", "Country", False),
    ("PL", "PL", "POL", "Poland", "Country", True),
    ("PT", "PT", "PRT", "Portugal", "Country", True),
    ("RO", "RO", "ROU", "Romania", "Country", True),
    ("RS", "RS", "SRB", "Serbia", "Country", False),
    ("SE", "SE", "SWE", "Sweden", "Country", True),
    ("SI", "SI", "SVN", "Slovenia", "Country", True),
    ("SK", "SK", "SVK", "Slovakia", "Country", True),
    ("TR", "TR", "TUR", "Türkiye", "Country", False),
    ("UK", "GB", "GBR", "United Kingdom", "Country", False),
    ("BA", "BA", "BIH", "Bosnia and Herzegovina", "Country", False),
    ("EA", None, None, "Euro area (variable composition)", "Aggregate", True),
    ("EA19", None, None, "Euro area - 19 countries (2015-2022)", "Aggregate", True),
    ("EA20", None, None, "Euro area - 20 countries (from 2023)", "Aggregate", True),
    ("EU27_2020", None, None, "European Union - 27 countries (from 2020)", "Aggregate", True),
    ("GLOBAL", "WO", "WLD", "Global / World", "Global", False),
    ("IS", "IS", "ISL", "Iceland", "Country", False),
    ("LI", "LI", "LIE", "Liechtenstein", "Country", False),
    ("UA", "UA", "UKR", "Ukraine", "Country", False),
    ("XK", "XK", "XKX", "Kosovo", "Country", False),
]

# Statistical code | first year in the union | first year out of it
EU_HISTORY = [
    ("BE", 1957, None),
    ("DE", 1957, None),
    ("FR", 1957, None),
    ("IT", 1957, None),
    ("LU", 1957, None),
    ("NL", 1957, None),
    ("DK", 1973, None),
    ("IE", 1973, None),
    ("UK", 1973, 2020),
    ("EL", 1981, None),
    ("ES", 1986, None),
    ("PT", 1986, None),
    ("AT", 1995, None),
    ("FI", 1995, None),
    ("SE", 1995, None),
    ("CY", 2004, None),
    ("CZ", 2004, None),
    ("EE", 2004, None),
    ("HU", 2004, None),
    ("LT", 2004, None),
    ("LV", 2004, None),
    ("MT", 2004, None),
    ("PL", 2004, None),
    ("SI", 2004, None),
    ("SK", 2004, None),
    ("BG", 2007, None),
    ("RO", 2007, None),
    ("HR", 2013, None),
]

# Indicator code | label | class | obligation basis | unit it is published in
STOCK_INDICATORS = [
    ("IC_DC", "Daily inland consumption for compliance", "Compliance consumption", "Compliance", "THS_T"),
    ("IMP_DNC", "Daily net imports for compliance", "Compliance import flow", "Compliance", "THS_T"),
    ("STK_EUE_DIR", "Emergency stocks held under EU Directive (days equivalent)", "Emergency stock", "EU Directive", "NR"),
    ("STK_MIN_CAL", "Minimum stock level for compliance - calculated", "Minimum stock requirement", "Compliance", "THS_T"),
]

# Unit code | label
MEASURE_UNITS = [
    ("THS_T", "Thousand tonnes"),
    ("NR", "Number"),
]

# Stock codes that name a calculation method, not a quantity
METHOD_CODES = ("STK_EUE_DNY_MTH", "STK_EUE_MIN_MTH", "STK_EUE_MTH")

# Tax code -> rank by how much tax the price includes
TAX_ORDER = {"X_TAX": 1, "X_VAT": 2, "I_TAX": 3}

# Dataset | commodity | consumer | product code its series must carry
PRICE_DATASETS = [
    ("nrg_pc_202", "GAS", "HOUSEHOLD", "G3000"),
    ("nrg_pc_203", "GAS", "NON_HOUSEHOLD", "G3000"),
    ("nrg_pc_204", "ELECTRICITY", "HOUSEHOLD", "E7000"),
    ("nrg_pc_205", "ELECTRICITY", "NON_HOUSEHOLD", "E7000"),
]

# Calendar spans, both ends included
YEAR_SPAN = (1900, 2030)
SEMESTER_SPAN = (2007, 2026)
MONTH_SPAN = (1900, 2026)

GLOBAL_CODE = "GLOBAL"
INDEX_SCOPE_START = "1985-01"


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A frame of literal rows whose exact size the optimizer can see.

    Going through Arrow makes it a local relation, so a join against it is
    broadcast by size rather than by a hint.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    arrow = to_arrow_schema(struct)
    columns = [
        pa.array([row[i] for row in rows], type=field.type) for i, field in enumerate(arrow)
    ]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=struct)


def geo_entities(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark, GEO_ENTITIES,
        "eurostat_code string, iso_alpha2 string, iso_alpha3 string, "
        "country_name string, entity_type string, is_eu boolean",
    )


def eu_history(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, EU_HISTORY, "code string, entry_year int, exit_year int")


def stock_indicators(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark, [row[:4] for row in STOCK_INDICATORS],
        "indicator_code string, indicator_label string, indicator_class string, "
        "obligation_basis string",
    )


def expected_units(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark, [(row[0], row[4]) for row in STOCK_INDICATORS],
        "indicator_code string, expected_unit string",
    )


def measure_units(spark: SparkSession) -> DataFrame:
    return literal_frame(spark, MEASURE_UNITS, "unit_code string, unit_label string")


def tax_order(spark: SparkSession) -> DataFrame:
    return literal_frame(
        spark, list(TAX_ORDER.items()), "tax_code string, tax_inclusion_order smallint"
    )
