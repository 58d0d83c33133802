"""Facts are stored so that the keys of a context pass over row groups."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from semestra.operators.dimensions import with_known_keys
from semestra.operators.olap import PriceContext
from semestra.plans import analysis
from semestra.session import new_folder
from semestra.sources.warehouse import Warehouse
from semestra.standins.stored import stored_warehouse


def scanned(frame) -> int:
    """Rows that the scan of the price facts gave."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    found = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "FileSourceScanExec" and "price_val" in node.output().toString():
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return sum(found)


@pytest.fixture
def warehouse(spark):
    """The stored facts again in files of many small row groups."""
    stored = stored_warehouse(spark, SF)
    wh = Warehouse(spark, new_folder(spark, "pruned"))
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    settings = {"parquet.block.size": "2048", "parquet.page.size": "512", "parquet.page.row.count.limit": "64"}
    for name, value in settings.items():
        hadoop.set(name, value)
    for name in ("dim_geo_entity", "dt_semester", "dt_consumption_band", "dt_tax_level", "dt_price_unit", "fact_energy_price"):
        wh.write(name, stored.table(name))
    for name in settings:
        hadoop.unset(name)
    return wh


def test_a_context_reads_fewer_rows(spark, warehouse, monkeypatch):
    context = PriceContext("ELECTRICITY", band="B2")
    whole = warehouse.table("fact_energy_price").count()
    pruned = analysis.price_by_semester(warehouse, context)
    expected = sorted(map(str, pruned.collect()))
    read = scanned(analysis.price_by_semester(warehouse, context))
    assert expected and 0 < read < whole / 3
    monkeypatch.setattr(analysis, "with_known_keys", lambda facts, members: facts)
    joined = analysis.price_by_semester(warehouse, context)
    assert sorted(map(str, joined.collect())) == expected
    assert scanned(analysis.price_by_semester(warehouse, context)) == whole


def test_many_members_are_left_to_the_join(spark):
    facts = spark.range(100).withColumnRenamed("id", "a").withColumn("b", F.col("a") % 3)
    few, many = spark.range(2).withColumnRenamed("id", "b"), spark.range(50).withColumnRenamed("id", "a")
    assert with_known_keys(facts, {"a": many, "b": few}, most=10).count() == 67
    assert with_known_keys(facts, {"a": many.limit(0)}).count() == 0
    assert with_known_keys(facts, {}).count() == 100
