"""Every registered query against its reference SQL, and what its plan may not contain."""

import os
from glob import glob

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as contract
from check import _rows
from semestra.standins import registry

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    actual = _rows(frame.columns, [tuple(r) for r in frame.collect()])
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert actual == _rows(columns, result.fetchall())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    plan = QUERIES["olap_dice"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "price_val" in line)
    assert "eurostat_flag" not in scan and "period_year#" in scan.split("PartitionFilters")[1].split("PushedFilters")[0]
    bands = next(line for line in plan.splitlines() if "FileScan" in line and "band_label" not in line and "consumption_band_sk" in line and "commodity_type" in line)
    assert "EqualTo(commodity_type,ELECTRICITY)" in bands and "EqualTo(consumer_type,HOUSEHOLD)" in bands
