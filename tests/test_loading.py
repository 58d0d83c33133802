from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from sources import (
    CODELISTS, INDEX_LINES, PRICE_HEADER, PRICE_LINES, all_inputs, dependency_files, index_file, price_source,
    stock_file,
)

from semestra.operators.gates import GateFailure
from semestra.plans import analysis, loading, verification
from semestra.session import new_folder
from semestra.sources.warehouse import Warehouse


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A warehouse loaded with the default calendars and geographies, and its sources."""
    folder = tmp_path_factory.mktemp("inputs")
    wh = loading.build_warehouse(spark, new_folder(spark, "t"), all_inputs(folder))
    return wh, folder


@pytest.fixture
def empty(spark, built):
    """Calendars and geographies only, shared by the failing loads."""
    return built[0]


def test_counts(built):
    wh, _ = built
    got = {r.table_name: tuple(r)[1:] for r in verification.verify_counts(wh).collect()}
    assert got == {
        "FACT_GPR": (2, "1985-01", "1985-02"),
        "FACT_IMPORT_DEPENDENCY": (5, "2007", "2008"),
        "FACT_ENERGY_PRICE": (7, "2007-S1", "2008-S1"),
        "FACT_OIL_STOCKS": (8, "2013-01", "2013-03"),
        "BR_GEO_EU_MEMBERSHIP": (1191, "1957", "2030"),
    }


def test_reports_are_clean(built):
    wh, _ = built
    for report in (verification.verify_duplicates, verification.verify_orphans, verification.verify_sanity):
        assert report(wh).filter("issue_count > 0").count() == 0
    assert verification.constraint_report(wh).filter("issue_count > 0").count() == 0


def test_values_are_rounded_and_resolved(built):
    wh, _ = built
    fact = wh.table("fact_energy_price").join(wh.table("dim_geo_entity"), "geo_sk").join(
        wh.table("dt_consumption_band"), "consumption_band_sk"
    )
    row = fact.filter("eurostat_code = 'DE' AND semester_sk = '2008-S1'").first()
    assert (row.price_val, row.period_year, row.band_label) == (Decimal("0.3001"), 2008, "Label KWH2500-4999")
    orders = {r.band_code: (r.band_order, r.is_total_band) for r in wh.table("dt_consumption_band").collect()}
    assert orders == {"TOT_KWH": (0, True), "KWH_LT1000": (1, False), "KWH2500-4999": (3, False)}
    products = {r.siec_code: (r.product_order, r.is_total) for r in wh.table("dt_energy_product").collect()}
    assert products == {"G3000": (1, False), "TOTAL": (3, True)}
    units = [tuple(r) for r in wh.table("dt_price_unit").select("price_basis", "currency_label").collect()]
    assert units == [("EUR per KWH", "Label EUR")]


def test_reload_changes_nothing(spark, built):
    wh, folder = built
    names = ["dim_geo_entity", "br_geo_eu_membership", "dt_consumption_band", "dt_tax_level", "dt_month",
             "fact_energy_price", "fact_oil_stocks", "fact_import_dependency", "fact_gpr"]
    before = {n: sorted(map(str, wh.table(n).collect())) for n in names}
    again = loading.build_warehouse(spark, wh.root, all_inputs(folder))
    assert {n: sorted(map(str, again.table(n).collect())) for n in names} == before


def test_queries_with_their_own_context(built, rows):
    wh, _ = built
    base = [(r.country, r.semester, str(r.avg_price_eur_kwh)) for r in analysis.price_by_semester(wh).collect()]
    assert base == [
        ("Germany", "2007-S1", "0.2000"), ("Germany", "2008-S1", "0.3001"),
        ("Italy", "2007-S1", "0.0969"), ("Italy", "2007-S2", "0.1234"),
    ]
    yearly = {(r.country, r.year): str(r.avg_price_eur_kwh) for r in analysis.price_by_year(wh).collect()}
    assert yearly["Italy", 2007] == "0.1102"  # 0.11015 rounds away from zero
    cross = analysis.price_and_dependency(wh, years=(2007, 2008)).collect()
    assert [(r.country, r.year, str(r.import_dependency_pct)) for r in cross] == [
        ("Germany", 2007, "-12.50"), ("Germany", 2008, "60.10"), ("Italy", 2007, "73.46"),
    ]
    moved = analysis.stock_moving_average(wh).collect()
    assert [(r.country, r.month, str(r.three_month_moving_average_days)) for r in moved] == [
        ("Germany", "2013-03", "3.50"), ("Germany", "2013-01", "0.00"),
        ("Italy", "2013-03", "63.50"), ("Italy", "2013-02", "50.25"), ("Italy", "2013-01", "100.50"),
    ]
    levels = analysis.annual_stock_levels(wh, (2013, 2013)).collect()
    assert [(r.country, str(r.minimum_equivalent_days)) for r in levels] == [("Italy", "0.00"), ("Germany", "0.00")]


def bad(line: int, text: str) -> list[list[str]]:
    return [[text, *cells[1:]] if i == line else cells for i, cells in enumerate(PRICE_LINES)]


@pytest.mark.parametrize(("change", "issue"), [
    ({"lines": bad(0, "A,E7000,KWH2500-4999,KWH,X_VAT,EUR,IT")}, "unexpected frequency"),
    ({"lines": bad(0, "S,G3000,KWH2500-4999,KWH,X_VAT,EUR,IT")}, "unexpected siec"),
    ({"lines": bad(0, "S,E7000,KWH9,KWH,X_VAT,EUR,IT")}, "band without label"),
    ({"lines": bad(0, "S,E7000,KWH2500-4999,KWH,Z_TAX,EUR,IT")}, "tax without order"),
    ({"lines": bad(0, "S,E7000,KWH2500-4999,MJ,X_VAT,EUR,IT")}, "unit without label"),
    ({"lines": bad(0, "S,E7000,KWH2500-4999,KWH,X_VAT,NAC,IT")}, "currency without label"),
    ({"lines": bad(0, "S,E7000,KWH2500-4999,KWH,X_VAT,EUR,XX")}, "unknown geography"),
    ({"lines": bad(0, PRICE_LINES[1][0])}, "duplicate grain"),
    ({"lines": bad(0, "S,E7000,KWH2500-4999,KWH,X_VAT,IT")}, "key arity"),
    ({"lines": [*PRICE_LINES, ["S,E7000,TOT_KWH,KWH,X_VAT,EUR,IT,more", ": ", ": ", ": "]]}, "key arity"),
    ({"lines": [["S,E7000,KWH2500-4999,KWH,X_VAT,EUR,IT", "1234567 ", "1 ", "1 "]]}, "value out of range"),
    ({"lines": [["S,E7000,KWH2500-4999,KWH,X_VAT,EUR,IT", ": ", ": ", ": c"]]}, "no observations in nrg_pc_204"),
    ({"periods": ("2007-S1 ", "2007-S2 ", "2099-S1 ")}, "unknown semester"),
    ({"codelists": {k: v for k, v in CODELISTS.items() if k != "CURRENCY"}}, "missing code lists of nrg_pc_204"),
])
def test_price_violations_abort(spark, empty, tmp_path, change, issue):
    before = sorted(map(str, empty.table("fact_energy_price").collect()))
    with pytest.raises(GateFailure) as failure:
        loading.load_prices(empty, [price_source(tmp_path, **change)])
    assert issue in failure.value.issues
    assert sorted(map(str, Warehouse(spark, empty.root).table("fact_energy_price").collect())) == before


@pytest.mark.parametrize(("line", "issue"), [
    (["M,TOTAL,PC,IT", "1 ", "2 "], "unexpected frequency"),
    (["A,TOTAL,XX,IT", "1 ", "2 "], "unexpected unit"),
    (["A,NOPE,PC,IT", "1 ", "2 "], "siec without label"),
    (["A,TOTAL,PC,XX", "1 ", "2 "], "unknown geography"),
    (["A,TOTAL,PC,DE", "1 ", "2 "], "duplicate grain"),
])
def test_dependency_violations_abort(empty, tmp_path, line, issue):
    path, codelists = dependency_files(tmp_path, [["A,TOTAL,PC,DE", "1 ", "2 "], line])
    with pytest.raises(GateFailure) as failure:
        loading.load_dependency(empty, path, codelists)
    assert issue in failure.value.issues


@pytest.mark.parametrize(("line", "issue"), [
    (["M,STK_EUE_DIR,THS_T,FR", "1 ", "2 ", "3 "], "unsupported combination"),
    (["M,STK_NEW,NR,FR", "1 ", "2 ", "3 "], "unsupported combination"),
    (["M,STK_EUE_DIR,NR,XX", "1 ", "2 ", "3 "], "unsupported combination"),
    (["M,STK_EUE_DIR,NR,IT", "1 ", "2 ", "3 "], "duplicate grain"),
])
def test_stock_violations_abort(empty, tmp_path, line, issue):
    with pytest.raises(GateFailure) as failure:
        loading.load_stocks(empty, stock_file(tmp_path, [["M,STK_EUE_DIR,NR,IT", "1 ", "2 ", "3 "], line]))
    assert issue in failure.value.issues
    assert "sample" in str(failure.value)


def test_stock_methods_only_is_empty(empty, tmp_path):
    with pytest.raises(GateFailure) as failure:
        loading.load_stocks(empty, stock_file(tmp_path, [["M,STK_EUE_MTH,NR,IT", "1 ", "2 ", "3 "]]))
    assert failure.value.issues == {"no observations": 1}


@pytest.mark.parametrize(("line", "issue"), [
    ("bad,1,2,3,x", "invalid date"),
    ("1950-01-01,1,,3,x", "partial measures"),
    ("1985-02-20,1,2,3,x", "duplicate grain"),
    ("2090-01-01,1,2,3,x", "unknown month"),
    ("1986-01-01,1234567,2,3,x", "gpr out of range"),
])
def test_index_violations_abort(empty, tmp_path, line, issue):
    with pytest.raises(GateFailure) as failure:
        loading.load_index(empty, index_file(tmp_path, [*INDEX_LINES, line]))
    assert issue in failure.value.issues


def test_index_needs_rows_and_global_member(spark, empty, tmp_path):
    with pytest.raises(GateFailure, match="no rows in scope"):
        loading.load_index(empty, index_file(tmp_path, INDEX_LINES[:2]))
    wh = Warehouse(spark, new_folder(spark, "t"))
    loading.load_calendars(wh)
    with pytest.raises(GateFailure, match="no global member"):
        loading.load_index(wh, index_file(tmp_path))


def test_index_counters(empty, tmp_path):
    counts = loading.load_index(empty, index_file(tmp_path))
    assert counts["rows in scope"] == 2 and counts["excluded empty"] == 2
    assert PRICE_HEADER.startswith("freq")


def test_constraints_find_faults(spark, built):
    wh, _ = built

    class Faulty:
        def table(self, name):
            rows = wh.table(name)
            if name == "fact_gpr":
                extra = rows.limit(1).withColumn("month_sk", F.lit("1984-01")).withColumn("geo_sk", F.lit(777))
                return rows.unionByName(extra).unionByName(extra)
            return rows

    got = {r.check_name: r.issue_count for r in verification.constraint_report(Faulty(), ["fact_gpr"]).collect()}
    assert got["fact_gpr scope_start"] == 2
    assert got["fact_gpr.geo_sk not in dim_geo_entity"] == 2
    assert got["fact_gpr duplicate month_sk, geo_sk"] == 1
    assert got["fact_gpr.gpr_val is null"] == 0
