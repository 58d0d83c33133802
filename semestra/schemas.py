"""The fifteen warehouse tables: columns, keys, references and checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "smallint": T.ShortType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "decimal(10,4)": T.DecimalType(10, 4),
    "decimal(12,4)": T.DecimalType(12, 4),
    "decimal(14,4)": T.DecimalType(14, 4),
}


@dataclass(frozen=True)
class Table:
    """A declared table. ``checks`` maps a name to a SQL condition that must hold."""

    name: str
    columns: tuple[tuple[str, str, bool], ...]
    key: tuple[str, ...]
    comment: str
    unique: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, str], ...] = ()
    checks: dict[str, str] = field(default_factory=dict)
    column_comments: dict[str, str] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    sort_by: tuple[str, ...] = ()
    surrogate: str | None = None

    @property
    def schema(self) -> T.StructType:
        struct = T.StructType()
        for name, type_name, required in self.columns:
            note = self.column_comments.get(name)
            struct.add(
                name, _TYPES[type_name], not required,
                metadata={"comment": note} if note else None,
            )
        return struct

    @property
    def names(self) -> list[str]:
        return [name for name, _, _ in self.columns]

    @property
    def required(self) -> list[str]:
        return [name for name, _, required in self.columns if required]


def _columns(*specs: str) -> tuple[tuple[str, str, bool], ...]:
    """``"geo_sk bigint!"`` is a required int column; without ``!`` it may be NULL."""
    parsed = []
    for spec in specs:
        name, type_name = spec.rstrip("!").split(" ")
        parsed.append((name, type_name, spec.endswith("!")))
    return tuple(parsed)


# Semester and month facts carry ``period_year`` next to the period key: it is
# the storage partition, so a range of years prunes directories.
_DECLARED = [
    Table(
        "dim_geo_entity",
        _columns(
            "geo_sk bigint!", "eurostat_code string!", "iso_alpha2 string", "iso_alpha3 string",
            "country_name string!", "entity_type string!", "is_eu boolean",
        ),
        key=("geo_sk",),
        unique=(("eurostat_code",),),
        comment="Countries, country aggregates and the global member",
        surrogate="geo_sk",
    ),
    Table(
        "dt_year",
        _columns("year_sk int!", "year_value int!"),
        key=("year_sk",),
        unique=(("year_value",),),
        comment="Annual calendar",
    ),
    Table(
        "dt_semester",
        _columns("semester_sk string!", "year_val int!", "semester_num int!"),
        key=("semester_sk",),
        comment="Half-yearly calendar, e.g. 2007-S1",
    ),
    Table(
        "dt_month",
        _columns("month_sk string!", "year_val int!", "month_num int!"),
        key=("month_sk",),
        comment="Monthly calendar, e.g. 2013-01",
    ),
    Table(
        "br_geo_eu_membership",
        _columns("geo_sk bigint!", "year_sk int!"),
        key=("geo_sk", "year_sk"),
        references=(("geo_sk", "dim_geo_entity"), ("year_sk", "dt_year")),
        comment="One row per member and year of membership",
    ),
    Table(
        "dt_energy_product",
        _columns(
            "product_sk bigint!", "siec_code string!", "siec_label string!",
            "product_order smallint!", "is_total boolean!",
        ),
        key=("product_sk",),
        unique=(("siec_code",),),
        comment="Energy products of the import-dependency series",
        surrogate="product_sk",
    ),
    Table(
        "dt_price_unit",
        _columns(
            "price_unit_sk bigint!", "energy_unit_code string!", "currency_code string!",
            "energy_unit_label string", "currency_label string", "price_basis string",
        ),
        key=("price_unit_sk",),
        unique=(("energy_unit_code", "currency_code"),),
        comment="Energy unit and currency a price is quoted in",
        surrogate="price_unit_sk",
    ),
    Table(
        "dt_consumption_band",
        _columns(
            "consumption_band_sk bigint!", "commodity_type string!", "siec_code string!",
            "siec_label string!", "consumer_type string!", "band_code string!",
            "band_label string!", "band_order smallint!", "is_total_band boolean!",
        ),
        key=("consumption_band_sk",),
        unique=(("commodity_type", "consumer_type", "band_code"),),
        comment="Consumption bands under commodity and consumer type",
        surrogate="consumption_band_sk",
    ),
    Table(
        "dt_tax_level",
        _columns(
            "tax_level_sk bigint!", "tax_code string!", "tax_label string!",
            "tax_inclusion_order smallint!",
        ),
        key=("tax_level_sk",),
        unique=(("tax_code",),),
        comment="How much tax a price includes",
        surrogate="tax_level_sk",
    ),
    Table(
        "dt_stock_indicator",
        _columns(
            "indicator_sk bigint!", "indicator_code string!", "indicator_label string",
            "indicator_class string", "obligation_basis string",
        ),
        key=("indicator_sk",),
        unique=(("indicator_code",),),
        comment="Quantitative emergency-stock indicators",
        surrogate="indicator_sk",
    ),
    Table(
        "dt_measure_unit",
        _columns("measure_unit_sk bigint!", "unit_code string!", "unit_label string"),
        key=("measure_unit_sk",),
        unique=(("unit_code",),),
        comment="Units of the stock indicators",
        surrogate="measure_unit_sk",
    ),
    Table(
        "fact_gpr",
        _columns(
            "month_sk string!", "gpr_val decimal(10,4)!", "gprt_val decimal(10,4)!",
            "gpra_val decimal(10,4)!", "geo_sk bigint!",
        ),
        key=("month_sk", "geo_sk"),
        references=(("month_sk", "dt_month"), ("geo_sk", "dim_geo_entity")),
        checks={"scope_start": "month_sk >= '1985-01'"},
        comment="Monthly risk index; averages only, never sums",
        column_comments={
            "gpr_val": "Risk index",
            "gprt_val": "Threats index",
            "gpra_val": "Acts index",
        },
        partition_by=("geo_sk",),
    ),
    Table(
        "fact_import_dependency",
        _columns(
            "geo_sk bigint!", "product_sk bigint!", "eurostat_flag string",
            "dep_rate_val decimal(12,4)!", "year_sk int!",
        ),
        key=("year_sk", "geo_sk", "product_sk"),
        references=(
            ("year_sk", "dt_year"), ("geo_sk", "dim_geo_entity"),
            ("product_sk", "dt_energy_product"),
        ),
        comment="Annual import dependency; averages only, never sums",
        column_comments={"dep_rate_val": "Percentage"},
        partition_by=("year_sk",),
        sort_by=("product_sk",),
    ),
    Table(
        "fact_energy_price",
        _columns(
            "semester_sk string!", "geo_sk bigint!", "consumption_band_sk bigint!",
            "tax_level_sk bigint!", "price_unit_sk bigint!", "eurostat_flag string",
            "price_val decimal(10,4)!", "period_year int!",
        ),
        key=("semester_sk", "geo_sk", "consumption_band_sk", "tax_level_sk", "price_unit_sk"),
        references=(
            ("semester_sk", "dt_semester"), ("geo_sk", "dim_geo_entity"),
            ("consumption_band_sk", "dt_consumption_band"),
            ("tax_level_sk", "dt_tax_level"), ("price_unit_sk", "dt_price_unit"),
        ),
        comment="Half-yearly prices; averages only, never sums",
        partition_by=("period_year",),
        sort_by=("consumption_band_sk", "tax_level_sk", "price_unit_sk"),
    ),
    Table(
        "fact_oil_stocks",
        _columns(
            "month_sk string!", "geo_sk bigint!", "indicator_sk bigint!", "measure_unit_sk bigint!",
            "eurostat_flag string", "indicator_value decimal(14,4)!", "period_year int!",
        ),
        key=("month_sk", "geo_sk", "indicator_sk", "measure_unit_sk"),
        references=(
            ("month_sk", "dt_month"), ("geo_sk", "dim_geo_entity"),
            ("indicator_sk", "dt_stock_indicator"), ("measure_unit_sk", "dt_measure_unit"),
        ),
        comment="Monthly stock levels; averages only, never sums",
        column_comments={"indicator_value": "Compare only within one indicator and unit"},
        partition_by=("period_year",),
        sort_by=("indicator_sk", "measure_unit_sk"),
    ),
]

TABLES: dict[str, Table] = {table.name: table for table in _DECLARED}
FACTS = ("fact_gpr", "fact_import_dependency", "fact_energy_price", "fact_oil_stocks")
