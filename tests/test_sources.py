from pathlib import Path

import pytest
from pyspark.sql import functions as F
from sources import PRICE_HEADER, index_file, price_source, write_tsv

from semestra.plans import loading
from semestra.session import new_folder
from semestra.sources import index_sheet
from semestra.sources.codelists import read_codelists
from semestra.sources.csv_export import write_csv
from semestra.sources.warehouse import Warehouse
from semestra.sources.wide_tsv import LayoutError, read_wide, split_key, surplus_cells
from semestra.standins.tables import literal_frame


def test_scan_keeps_text(spark, tmp_path):
    wide = read_wide(spark, price_source(tmp_path).path)
    assert wide.columns == [PRICE_HEADER, "2007-S1 ", "2007-S2 ", "2008-S1 "]
    first = next(r for r in wide.collect() if r[0].endswith("KWH2500-4999,KWH,X_VAT,EUR,DE"))
    assert tuple(first[1:]) == ("0.2 ep", ": c", "0.30005 ")


def test_observations(spark, tmp_path, rows):
    wide, parts = loading.price_cells(spark, price_source(tmp_path))
    assert parts == 7
    got = rows(loading.price_observations(wide, parts).select(
        "geo_code", "band_code", "semester_sk", F.col("price_val").cast("string"), "eurostat_flag", "out_of_range"
    ))
    assert got == sorted([
        ("IT", "KWH2500-4999", "2007-S1", "0.0969", None, False),
        ("IT", "KWH2500-4999", "2007-S2", "0.1234", "e", False),
        ("DE", "KWH2500-4999", "2007-S1", "0.2000", "ep", False),
        ("DE", "KWH2500-4999", "2008-S1", "0.3001", None, False),
        ("IT", "KWH_LT1000", "2007-S1", "-0.1000", None, False),
        ("EU27_2020", "TOT_KWH", "2007-S1", "0.5000", "ep", False),
        ("EU27_2020", "TOT_KWH", "2007-S2", "0.2500", None, False),
    ], key=lambda r: tuple(str(v) for v in r))


def test_key_parts_beyond_and_short(spark, tmp_path):
    path = write_tsv(tmp_path / "a.tsv", ["freq, geo\\TIME_PERIOD", "2007"], [["A", "1"], ["A, IT ,x", "2"]])
    got = [tuple(r) for r in split_key(read_wide(spark, path)).orderBy("2007").collect()]
    assert got == [("A", None, 1, "1"), ("A", "IT", 3, "2")]


def test_layout_errors(spark, tmp_path):
    with pytest.raises(LayoutError, match="currency"):
        loading.price_cells(spark, price_source(tmp_path / "a", header="freq,siec,nrg_cons,unit,tax,geo\\TIME_PERIOD"))
    wide, _ = loading.price_cells(spark, price_source(tmp_path / "b", periods=("2007", "2008", "x")))
    with pytest.raises(LayoutError, match="semester"):
        loading.price_observations(wide)


def test_codelists(spark, tmp_path, rows):
    path = tmp_path / "c.xml"
    path.write_text(
        '<r xmlns:s="urn:s" xmlns:c="urn:c"><s:Codelist id="A">'
        '<s:Code id="a1"><c:Name xml:lang="de">eins</c:Name><c:Name xml:lang="en"> one </c:Name></s:Code>'
        '<s:Code id="a2"><c:Name xml:lang="en"></c:Name></s:Code>'
        '<s:Code id="a3"><c:Name xml:lang="fr">trois</c:Name></s:Code>'
        '<s:Code id="a4"/></s:Codelist>'
        '<s:Codelist id="B"><s:Code id="b1"><c:Name>bare</c:Name></s:Code></s:Codelist></r>'
    )
    assert rows(read_codelists(spark, str(path))) == [
        ("A", 0, "a1", "one"), ("A", 1, "a3", "trois"), ("B", 0, "b1", "bare"),
    ]


def test_index_sheet(spark, tmp_path, rows):
    sheet = index_sheet.normalise(index_sheet.read_sheet(spark, index_file(tmp_path)))
    assert sheet.count() == 6
    assert rows(index_sheet.usable_rows(sheet).select("month_sk")) == [("1985-01",), ("1985-02",)]
    assert index_sheet.date_column(["x", "date", "month"]) == "month"
    assert index_sheet.date_column(["x", "date"]) == "date"
    assert index_sheet.date_column(["x", "y"]) == "x"
    with pytest.raises(LayoutError, match="gpra"):
        index_sheet.normalise(spark.createDataFrame([("1985-01", "1", "2")], ["month", "GPR", "GPRT"]))


def test_csv_spells_out_null(spark, tmp_path):
    frame = spark.createDataFrame([("a", None), ("b", 1.5)], "k string, v double")
    path = str(tmp_path / "out")
    write_csv(frame, path, null_text="NULL", single_file=True)
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("*.csv"))
    assert text.splitlines() == ["k,v", "a,NULL", "b,1.5"]


def test_refresh_replaces_the_table(spark, rows):
    wh = Warehouse(spark, new_folder(spark, "t"))
    years = lambda *ys: literal_frame(spark, [(y, y) for y in ys], "year_sk int, year_value int")
    assert wh.table("dt_year").count() == 0
    wh.write("dt_year", years(2000, 2001))
    assert rows(Warehouse(spark, wh.root).table("dt_year").select("year_sk")) == [(2000,), (2001,)]
    wh.replace({"dt_year": wh.table("dt_year").filter("year_sk > 2000").unionByName(years(2002))})
    assert rows(Warehouse(spark, wh.root).table("dt_year").select("year_sk")) == [(2001,), (2002,)]
    wh.write("dt_year", years())
    assert wh.table("dt_year").collect() == []


def test_full_refresh_drops_partitions(spark, rows):
    wh = Warehouse(spark, new_folder(spark, "t"))
    fact = lambda *keys: literal_frame(
        spark, [(m, g) for m, g in keys], "month_sk string, geo_sk int"
    ).selectExpr("month_sk", "geo_sk", "1 AS gpr_val", "2 AS gprt_val", "3 AS gpra_val")
    wh.write("fact_gpr", fact(("2000-01", 1), ("2000-01", 2)))
    wh.write("fact_gpr", fact(("2000-02", 2)))
    assert rows(wh.table("fact_gpr").select("month_sk", "geo_sk")) == [("2000-02", 2)]


def test_slice_refresh_leaves_other_slices(spark, rows):
    wh = Warehouse(spark, new_folder(spark, "t"))
    fact = lambda data: literal_frame(
        spark, data, "month_sk string, geo_sk int, v int"
    ).selectExpr("month_sk", "geo_sk", "v AS gpr_val", "v AS gprt_val", "v AS gpra_val")
    wh.replace_slice("fact_gpr", fact([]), [1])
    assert wh.table("fact_gpr").collect() == []
    wh.write("fact_gpr", fact([("2000-01", 1, 1), ("2000-02", 1, 2), ("2000-01", 2, 3)]))
    wh.replace_slice("fact_gpr", fact([("2000-03", 1, 9)]), [1])
    shown = lambda frame: rows(frame.selectExpr("geo_sk", "month_sk", "int(gpr_val)"))
    assert shown(Warehouse(spark, wh.root).table("fact_gpr")) == [(1, "2000-03", 9), (2, "2000-01", 3)]
    # A value without rows ends up empty
    wh.replace_slice("fact_gpr", fact([]), [2])
    assert shown(Warehouse(spark, wh.root).table("fact_gpr")) == [(1, "2000-03", 9)]
    wh.replace_slice("fact_gpr", fact([("2001-01", 1, 4), ("2001-01", 3, 5)]), [1, 3])
    assert shown(wh.table("fact_gpr")) == [(1, "2001-01", 4), (3, "2001-01", 5)]
    # Rows taken from the slice itself
    wh.replace_slice("fact_gpr", wh.table("fact_gpr").filter("geo_sk = 3").withColumn("month_sk", F.lit("2001-02")), [3])
    assert shown(wh.table("fact_gpr")) == [(1, "2001-01", 4), (3, "2001-02", 5)]
    with pytest.raises(ValueError, match="beside the slice"):
        wh.replace_slice("fact_gpr", fact([("2001-01", 2, 4)]), [1])
    wh.write("fact_gpr", fact([("2002-01", 2, 6)]))
    assert shown(Warehouse(spark, wh.root).table("fact_gpr")) == [(2, "2002-01", 6)]


def test_staging_is_apart_and_goes(spark):
    wh = Warehouse(spark, new_folder(spark, "t"))
    one, two = wh.stage("x", spark.range(3)), wh.stage("x", spark.range(5))
    assert (one.count(), two.count()) == (3, 5)
    files = one.inputFiles()
    wh.drop_staged()
    assert not Path(files[0].removeprefix("file://")).exists()


def test_files_are_aligned_by_name(spark, tmp_path, rows):
    write_tsv(tmp_path / "a.tsv", ["freq,geo\\TIME_PERIOD", "2007 ", "2008 "], [["A,IT", "1", "2"]])
    write_tsv(tmp_path / "b.tsv", ["freq,geo\\TIME_PERIOD", "2008", "2007", "2009"], [["A,DE", "3", "4", "5"]])
    wide = split_key(read_wide(spark, str(tmp_path)))
    assert rows(wide.select("geo", "2007", "2008", "2009")) == [("DE", "4", "3", "5"), ("IT", "1", "2", None)]
    assert surplus_cells(spark, str(tmp_path)).count() == 0


def test_surplus_cells_are_seen(spark, tmp_path):
    write_tsv(tmp_path / "a.tsv", ["freq,geo\\TIME_PERIOD", "2007", "2008"], [["A,IT", "3", "4", "5"], ["A,DE", "1"], ["A,FR", "1", "2"]])
    assert [r.value for r in surplus_cells(spark, str(tmp_path)).collect()] == ["A,IT\t3\t4\t5"]


def test_codes_listed_twice_close_up(spark, tmp_path, rows):
    path = tmp_path / "c.xml"
    entry = '<Code id="{}"><Name xml:lang="en">{}</Name></Code>'
    path.write_text('<r><Codelist id="A">' + entry.format("a", "x") + entry.format("a", "y") + entry.format("b", "z") + "</Codelist></r>")
    assert rows(read_codelists(spark, str(path))) == [("A", 0, "a", "y"), ("A", 1, "b", "z")]


def test_index_values_are_rounded_once(spark):
    sheet = spark.createDataFrame([("2000-01-01", "80.123449999999", "1", "1")], ["month", "GPR", "GPRT", "GPRA"])
    assert str(index_sheet.normalise(sheet).first().gpr_val) == "80.1234"
