"""Every filter of the analytical queries matters: without it the reference SQL differs."""

import os
from glob import glob

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

from check import _rows
from semestra.operators.olap import PriceContext
from semestra.plans import analysis
from semestra.sources.warehouse import Warehouse
from semestra.standins import registry

TRUE = lambda self: F.lit(True)
GEO, YEARS, CORRELATION, TABLE = analysis._geo, analysis._years, analysis.paired_correlation, Warehouse.table


def _all_products(self, name):
    rows = TABLE(self, name)
    return rows.withColumn("siec_code", F.lit("TOTAL")) if name == "dt_energy_product" else rows


SWITCHES = {
    "band": (PriceContext, "band_condition", TRUE, ["olap_base", "olap_rollup", "olap_drilldown", "yoy_change", "dependency_vs_price"]),
    "tax": (PriceContext, "tax_condition", TRUE, ["olap_base", "olap_slice", "index_price_correlation", "membership_averages"]),
    "unit": (PriceContext, "unit_condition", TRUE, ["olap_base", "olap_dice", "drill_across", "membership_averages", "yoy_change"]),
    "entity type": (
        analysis, "_geo", lambda wh, entity_type=None, **other: GEO(wh, None, **other),
        ["olap_base", "olap_drilldown", "dependency_vs_price", "dependency_ranking", "annual_level_stats"],
    ),
    "countries": (
        analysis, "_geo", lambda wh, entity_type=None, countries=None, codes=None: GEO(wh, entity_type, None, codes),
        ["olap_slice", "olap_dice", "drill_across"],
    ),
    "codes": (
        analysis, "_geo", lambda wh, entity_type=None, countries=None, codes=None: GEO(wh, entity_type, countries, None),
        ["global_index_by_year", "moving_average", "yoy_change"],
    ),
    "years": (analysis, "_years", lambda facts, column, years: facts, ["olap_dice", "drill_across", "yoy_change", "dependency_ranking", "annual_level_stats"]),
    "least years": (
        analysis, "paired_correlation", lambda pairs, group, period, x, y, least, *other: CORRELATION(pairs, group, period, x, y, 0, *other),
        ["index_price_correlation"],
    ),
    "product": (Warehouse, "table", _all_products, ["drill_across", "dependency_vs_price", "membership_averages", "dependency_ranking"]),
}


@pytest.fixture(scope="module")
def expected():
    db = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    found = {}

    def rows(name):
        if name not in found:
            result = db.execute(registry.ORACLES[name])
            found[name] = _rows([d[0] for d in result.description], result.fetchall())
        return found[name]

    return rows


@pytest.mark.parametrize("switch", SWITCHES)
def test_filter_matters(spark, expected, monkeypatch, switch):
    owner, name, replacement, queries = SWITCHES[switch]
    registry.QUERIES["olap_base"](spark, SF)  # stores the facts as they are
    monkeypatch.setattr(owner, name, replacement)
    for query in queries:
        frame = registry.QUERIES[query](spark, SF)
        assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) != expected(query), query
