"""Every gate matters: without it the registered rows differ from their reference SQL."""

import os
from glob import glob

import duckdb
import pytest
from conftest import SF

from check import _rows
from semestra.operators import gates
from semestra.plans import loading, verification
from semestra.schemas import TABLES
from semestra.standins import quality, registry

REPORTS = ["price_gate_report", "dependency_gate_report", "stock_gate_report"]


@pytest.fixture(scope="module")
def expected():
    db = duckdb.connect()
    for path in glob(f"{SF}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")

    def rows(name):
        result = db.execute(registry.ORACLES[name])
        return [d[0] for d in result.description], result.fetchall()

    return rows


@pytest.fixture
def fresh(monkeypatch):
    """Nothing that was gated before is used, and nothing gated here stays."""
    monkeypatch.setattr(quality, "_gated", {})


def report(spark, name):
    return {r.check_name: r.issue_count for r in registry.QUERIES[name](spark, SF).collect()}


SWITCHES = {
    "price rules": (loading, "price_rules", lambda: {}, {"price_gate_report": ["value out of range"]}),
    "price member rules": (loading, "price_member_rules", lambda: {}, {"price_gate_report": [
        "unexpected frequency", "unexpected siec", "siec without label", "band without label", "tax without label",
        "tax without order", "unit without label", "currency without label", "unknown semester",
    ]}),
    "dependency rules": (loading, "dependency_rules", lambda: {}, {"dependency_gate_report": ["value out of range"]}),
    "dependency member rules": (loading, "dependency_member_rules", lambda: {}, {"dependency_gate_report": [
        "unexpected frequency", "unexpected unit", "siec without label", "unknown year",
    ]}),
    "stock rules": (loading, "stock_rules", lambda: {}, {"stock_gate_report": ["unsupported combination"]}),
    "line rules": (loading, "line_rules", lambda parts: {}, {
        "price_gate_report": ["key arity", "surplus cells"], "dependency_gate_report": ["key arity"],
    }),
    "layout": (loading, "missing_keys", lambda columns, required: [], {"price_gate_report": ["missing key columns of nrg_pc_299"]}),
    "periods": (loading, "period_columns", lambda columns, granularity: ["x"], {"price_gate_report": ["missing semester columns of nrg_pc_299"]}),
    "missing members": (
        gates, "missing_members", lambda rows, members, key, n=None: rows.groupBy(*key).count().withColumnRenamed("count", n or "n").limit(0),
        {"price_gate_report": ["unknown geography", "missing code lists of nrg_pc_204"],
         "dependency_gate_report": ["unknown geography", "missing code lists of import dependency"]},
    ),
    "repeated members": (
        gates, "duplicates", lambda rows, key: rows.groupBy(*key).count().withColumnRenamed("count", "copies").limit(0),
        {"price_gate_report": ["conflicting members of dt_consumption_band", "duplicate grain"], "dependency_gate_report": ["duplicate grain"]},
    ),
    "empty sources": (
        loading, "empty_issue", lambda name, counters: (name, 0, None), {"price_gate_report": ["no observations in nrg_pc_206"]},
    ),
}
OLD_ROWS = {
    "price member rules": ["gate_domain", "gate_tax_order"], "line rules": ["gate_arity"], "layout": ["gate_schema"],
    "empty sources": ["gate_nonempty"], "missing members": ["gate_codelists"],
}


def test_every_fault_is_switched_off_below(expected):
    for name in REPORTS:
        columns, rows = expected(name)
        at = columns.index("check_name"), columns.index("issue_count")
        planted = {r[at[0]] for r in rows if r[at[1]]}
        switched = {check for *_, checks in SWITCHES.values() for check in checks.get(name, [])}
        assert {c for c in planted if not c.startswith("missing code lists")} <= switched


@pytest.mark.parametrize("switch", SWITCHES)
def test_gate_matters(spark, expected, fresh, monkeypatch, switch):
    owner, attribute, replacement, checks = SWITCHES[switch]
    monkeypatch.setattr(owner, attribute, replacement)
    # A header of another subject can't be read as prices once its gate is off
    if switch in ("layout", "periods"):
        wide = quality.faulty_sources(spark, SF)[3]
        columns = quality.read_wide(spark, wide.path).columns
        found = loading.layout_issues("nrg_pc_299", columns, loading.PRICE_KEYS, "semester")
        assert {name: count for name, count, _ in found}[checks["price_gate_report"][0]] == 0
    else:
        for name, switched in checks.items():
            found = report(spark, name)
            assert not any(found.get(check) for check in switched), found
    for name in OLD_ROWS.get(switch, []):
        frame = registry.QUERIES[name](spark, SF)
        columns, rows = expected(name)
        assert _rows(frame.columns, [tuple(r) for r in frame.collect()]) != _rows(columns, rows), name


def test_codes_at_fault_are_in_the_error(spark, fresh):
    source = quality.gated_prices(spark, SF)
    with pytest.raises(gates.GateFailure) as failure:
        source.enforce()
    assert "currency, nrg_cons, tax" in str(failure.value)
    assert "'unknown semester': '2001-S1, 2001-S2'" in str(failure.value)
    assert failure.value.issues["no observations in nrg_pc_206"] == 1


def test_a_report_names_ten_codes_at_most(spark):
    rows = spark.range(40).selectExpr("CAST(id AS string) AS code", "id % 2 = 0 AS bad", "2 AS n")
    named = gates.offending_codes(rows, {"even": ("code", rows.bad), "none": ("code", rows.code == "x")})
    found = {r.check_name: tuple(r)[1:] for r in gates.gate_report(spark, [], [named], ["even", "none"]).collect()}
    assert found == {"even": (40, "0, 10, 12, 14, 16, 18, 2, 20, 22, 24"), "none": (0, None)}


KINDS = {
    "null": lambda rules, keys: ({n: r for n, r in rules.items() if not n.endswith(" is null")}, keys),
    "check": lambda rules, keys: ({n: r for n, r in rules.items() if n != "fact_gpr scope_start"}, keys),
    "reference": lambda rules, keys: ({n: r for n, r in rules.items() if " not in " not in n}, keys),
    "duplicate": lambda rules, keys: (rules, {}),
}


def test_every_constraint_of_every_table_is_violated(spark, expected):
    columns, rows = expected("constraint_report")
    frame = registry.QUERIES["constraint_report"](spark, SF)
    found = [tuple(r) for r in frame.collect()]
    assert _rows(frame.columns, found) == _rows(columns, rows)
    assert len(found) == 101 and min(r.issue_count for r in frame.collect()) > 0
    assert {name.split(".")[0].split(" ")[0] for name, _ in rows} == set(TABLES)


@pytest.mark.parametrize("kind", KINDS)
def test_constraint_matters(spark, expected, monkeypatch, kind):
    row, key = verification.row_constraints, verification.key_constraints
    monkeypatch.setattr(verification, "row_constraints", lambda table: KINDS[kind](row(table), key(table))[0])
    monkeypatch.setattr(verification, "key_constraints", lambda table: KINDS[kind](row(table), key(table))[1])
    columns, rows = expected("constraint_report")
    found = {r.check_name for r in registry.QUERIES["constraint_report"](spark, SF).collect()}
    marks = {"null": " is null", "check": " scope_start", "reference": " not in ", "duplicate": " duplicate "}
    lost = {name for name, _ in rows} - found
    assert lost and lost == {name for name, _ in rows if marks[kind] in name}


def test_keys_with_nulls_and_repeated_entries(spark):
    class Faulty:
        def table(self, name):
            return spark.createDataFrame([(None, 1), (None, 1), (1, 1), (2, 2), (2, 2), (2, 3)], "year_sk int, year_value int")

    got = {r.check_name: r.issue_count for r in verification.table_constraints(Faulty(), TABLES["dt_year"]).collect()}
    assert got == {
        "dt_year.year_sk is null": 2, "dt_year.year_value is null": 0, "dt_year duplicate year_sk": 1, "dt_year duplicate year_value": 2,
    }
