"""Building the extracts: what is put together where, and what is built at all."""

from pyspark.sql import functions as F

from semestra.operators import gates
from semestra.standins import landing, quality

from conftest import SF


def below_exchange(frame):
    """The plan below the exchange that is deepest in it."""
    parts = frame._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")
    assert len(parts) > 1
    return parts[-1]


def test_cells_are_put_together_behind_their_shuffle(spark):
    stocks = landing._stock_cells(spark, SF, landing.CLEAN_FLOW, landing.UNIT, landing.GEO)
    assert "Aggregate" not in below_exchange(stocks)
    assert "SortAggregate" not in stocks._jdf.queryExecution().executedPlan().toString()


def test_hashes_are_counted_behind_their_shuffle(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, None), (None, None)], "k int, v string")
    found = gates.suspected_duplicates("twice", rows, ["k", "v"])
    assert "Aggregate" not in below_exchange(found)
    assert [tuple(r) for r in found.collect()] == [("twice", 4)]


def test_cells_of_odd_series(spark):
    rows = spark.createDataFrame(
        [("a", 1, 5.0), ("a", 1, 3.0), ("a", 2, None), ("a", None, 9.0), ("b", 7, 1.0), (None, 2, 4.0)], "k string, p int, v double"
    )
    wide = landing._series(
        rows, ["k"], "p", {"one": 1, "two": 2},
        lambda here: landing._flagged(F.min(F.when(here, F.col("v"))), F.count(F.when(here, 1))),
    )
    # A value that is null, a period that is null, and one that has no column leave a series without the cell
    assert {tuple(r) for r in wide.collect()} == {("a", "3.0 e", None), ("b", None, None), (None, None, "4.0")}


def test_only_the_extracts_in_use_are_built(spark):
    folder = f"{SF}/."
    quality.gate_nonempty(spark, folder).collect()
    built = {name for _, at, name in landing._written if at == folder}
    assert "prices_empty" in built and not built & {"prices_dirty", "prices_faulty", "dependency", "line_items"}


def test_line_items_are_joined_once(spark):
    folder = f"{SF}/./."
    for name in ("prices_dirty", "prices_faulty"):
        landing.landed(spark, folder, name)
    assert [name for _, at, name in landing._written if at == folder].count("line_items") == 1
